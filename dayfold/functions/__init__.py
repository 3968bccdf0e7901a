"""Column functions made of Spark built-ins.

Hashes of text, and charsets that Spark cannot decode, take Arrow batches to Python.
"""

from dayfold.functions.binary import (
    byte_slice,
    bytes_equal,
    bytes_to_text,
    decode_i32,
    decode_u32,
    encode_u32,
    put_u32,
)
from dayfold.functions.dates import batch_date, resolve_batch_date
from dayfold.functions.hashing import row_hash
from dayfold.functions.numbers import safe_abs
from dayfold.functions.text import csv_list, csv_map, json_escape, null_or_empty, replace_suffix

__all__ = [
    "batch_date",
    "byte_slice",
    "bytes_equal",
    "bytes_to_text",
    "csv_list",
    "csv_map",
    "decode_i32",
    "decode_u32",
    "encode_u32",
    "json_escape",
    "null_or_empty",
    "put_u32",
    "replace_suffix",
    "resolve_batch_date",
    "row_hash",
    "safe_abs",
]
