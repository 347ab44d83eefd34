"""Sources: contract CSV, catalog table, Parquet, JSON Lines, JDBC."""

from lakelayer.sources.csv import read_csv_contract, read_csv_raw, with_source_file
from lakelayer.sources.readers import read_jdbc, read_json, read_parquet, read_table

__all__ = [
    "read_csv_contract",
    "read_csv_raw",
    "with_source_file",
    "read_jdbc",
    "read_json",
    "read_parquet",
    "read_table",
]
