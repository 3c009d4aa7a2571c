"""Scans, sinks and table metadata."""

from cohort_effects.sources.io import (  # noqa: F401
    TABLES,
    describe_schema,
    freshness,
    read_partition,
    read_table,
    read_tables,
    table_volumes,
    write_csv_by,
    read_current,
    replace_table,
    write_partitioned,
)
