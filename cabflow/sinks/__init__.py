"""Sinks and materializations."""

from cabflow.sinks.writers import (  # noqa: F401
    check_partition_domain, hash_bucket, materialize, replace_slice, replace_table,
    write_csv, write_fact, write_hash_bucketed, write_list_partitioned,
)
