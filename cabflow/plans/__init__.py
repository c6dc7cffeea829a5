"""End-to-end plans: gold build, the analytical questions, the query catalog."""
