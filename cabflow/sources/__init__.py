"""Readers (S1-S7) and the fixture adapter over the test tables."""

from cabflow.sources.generators import (  # noqa: F401
    month_partitions, slice_grid, slice_grid_from, static_dim,
)
from cabflow.sources.trips import read_trips, read_zones, read_csv, slice_path  # noqa: F401
