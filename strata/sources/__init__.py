"""Sources and sinks: file formats, JDBC, literal and empty tables, writers."""

from strata.sources.frames import as_field, as_row, as_schema, conform, create_df, create_empty_df, parse_as
from strata.sources.readers import (
    read_avro, read_csv, read_jdbc, read_json, read_or_empty, read_parquet, read_table,
    read_text, read_xml, register_view,
)
from strata.sources.writers import shape, write_table, write_with_count

__all__ = [
    "as_field", "as_row", "as_schema", "conform", "create_df", "create_empty_df", "parse_as",
    "read_avro", "read_csv", "read_jdbc", "read_json", "read_or_empty", "read_parquet",
    "read_table", "read_text", "read_xml", "register_view",
    "shape", "write_table", "write_with_count",
]
