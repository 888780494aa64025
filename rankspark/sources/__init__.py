"""Scans (Parquet/CSV), the search-log adapter over the driver tables, sinks."""

from .tables import (  # noqa: F401
    load_table, search_log, train_frame, test_frame, load_dataset,
    sample_by_groups, read_search_csv, convert_csv_to_parquet, SEARCH_LOG_SCHEMA,
)
