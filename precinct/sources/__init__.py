"""Readers, writers and the mapping from the star-schema tables."""

from precinct.sources.readers import (
    csv_headers,
    data_files,
    describe_schema,
    read_incidents_csv,
    read_incidents_parquet,
    read_metrics,
    read_result_csv,
    read_run_summaries,
    resolve_col,
    trim_names,
)
from precinct.sources.star import incident_persons, incident_properties, incidents, load_tables, runs
from precinct.sources.writers import publish_metrics, write_csv, write_incidents_parquet, write_metrics, write_summary, write_text

__all__ = [
    "csv_headers",
    "data_files",
    "describe_schema",
    "incident_persons",
    "incident_properties",
    "incidents",
    "load_tables",
    "publish_metrics",
    "read_incidents_csv",
    "read_incidents_parquet",
    "read_metrics",
    "read_result_csv",
    "read_run_summaries",
    "resolve_col",
    "runs",
    "trim_names",
    "write_csv",
    "write_incidents_parquet",
    "write_metrics",
    "write_summary",
    "write_text",
]
