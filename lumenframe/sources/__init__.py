"""Readers and writers."""
from .readers import (  # noqa: F401
    enforce_schema,
    extract_elements,
    paired_review_rows,
    read_array_records,
    read_csv,
    read_fixed_width,
    read_libsvm,
    read_list_skipping,
    read_multiline_csv,
    read_points,
    read_ragged,
    read_words,
)
from .writers import write_csv, write_lines  # noqa: F401
