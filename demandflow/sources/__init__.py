"""Sources and sinks (S1-S6) and the stand-in input built from the driver tables."""

from demandflow.sources.catalog import (  # noqa: F401
    load_dataset, resolve_table, read_parquet, write_parquet, write_csv, read_csv_semi,
    REFERENCE_SCHEMAS,
)
