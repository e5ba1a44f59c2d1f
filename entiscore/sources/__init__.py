"""Scans and sinks."""

from entiscore.sources.readers import (
    int_schema,
    parse_sparse_lines,
    read_csv_raw,
    read_csv_typed,
    read_dense_text,
    read_labeled_csv,
    read_partition,
    read_sparse_text,
    sparse_dimension,
)
from entiscore.sources.sinks import overwrite_partition, save_table, write_sparse_text

__all__ = [
    "int_schema", "parse_sparse_lines", "read_csv_raw", "read_csv_typed", "read_dense_text",
    "read_labeled_csv", "read_partition", "read_sparse_text", "sparse_dimension",
    "overwrite_partition", "save_table", "write_sparse_text",
]
