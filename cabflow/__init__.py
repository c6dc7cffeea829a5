"""cabflow: a PySpark medallion pipeline for city taxi trips.

Raw monthly trip slices -> bronze (typed) -> silver (cleaned, zone names)
-> gold star schema (seven dimensions and a trip fact) -> analytical
questions, data-quality checks, coverage reports and incremental ingest.

Every operator is a function from DataFrame(s) to a lazy DataFrame built
from built-in Spark expressions; nothing row-sized passes through the
driver.
"""

from cabflow.params import FIXTURE_PARAMS, Params

__all__ = ["Params", "FIXTURE_PARAMS"]
