"""Binary columns: big-endian 32-bit integers, slices and text."""

from __future__ import annotations

import codecs

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.functions.numbers import UINT_MASK, wrap_int

# What texts of these charsets can begin with to tell the order of their bytes.
BYTE_ORDER_MARKS = {
    "UTF-16": (codecs.BOM_UTF16_BE, codecs.BOM_UTF16_LE),
    "UTF-32": (codecs.BOM_UTF32_BE, codecs.BOM_UTF32_LE),
}


def byte_slice(data: Column, offset: int, size: int) -> Column:
    """``size`` bytes from ``offset`` (0-based); an error if they are not all there."""
    if offset < 0 or size < 0:
        raise ValueError("offset and size must not be negative")
    return F.when(
        F.length(data) < F.lit(offset + size),
        F.raise_error(
            F.format_string(
                f"bytes {offset}..{offset + size} asked of a value of %d", F.length(data)
            )
        ).cast("binary"),
    ).otherwise(F.substring(data, offset + 1, size))


def decode_u32(data: Column, offset: int = 0) -> Column:
    """Big-endian unsigned 32-bit integer at ``offset``, as a long."""
    return F.conv(F.hex(byte_slice(data, offset, 4)), 16, 10).cast("long")


def decode_i32(data: Column, offset: int = 0) -> Column:
    """Big-endian signed 32-bit integer at ``offset``."""
    return wrap_int(decode_u32(data, offset))


def encode_u32(value: Column) -> Column:
    """The low 32 bits of a long as four big-endian bytes; the rest is cut off."""
    low = value.cast("long").bitwiseAND(F.lit(UINT_MASK))
    return F.unhex(F.lpad(F.hex(low), 8, "0"))


def put_u32(data: Column, offset: int, value: Column) -> Column:
    """``data`` with the four bytes at ``offset`` replaced by ``encode_u32(value)``."""
    checked = F.when(byte_slice(data, offset, 4).isNotNull(), data)
    return F.overlay(checked, encode_u32(value), offset + 1, 4)


def bytes_equal(left: Column, right: Column) -> Column:
    """Whether two binary values hold the same bytes."""
    return left == right


def bytes_to_text(data: Column, charset: str = "UTF-8") -> Column:
    """Decode bytes from any charset; what is malformed becomes U+FFFD.

    UTF-8, US-ASCII and ISO-8859-1 stay in the JVM; others are decoded in Arrow batches. Where
    UTF-16 or UTF-32 says nothing about the order of bytes, the high one comes first.
    """
    name = charset.upper()
    if name in ("UTF-8", "UTF8"):
        return F.make_valid_utf8(data.cast("string"))
    if name in ("US-ASCII", "ASCII"):
        return F.regexp_replace(F.decode(data, "ISO-8859-1"), "[\\x{80}-\\x{ff}]", "�")
    if name in ("ISO-8859-1", "LATIN1", "LATIN-1"):
        return F.decode(data, "ISO-8859-1")
    codecs.lookup(charset)  # an unknown one is an error right away
    marks = BYTE_ORDER_MARKS.get(name.replace("_", "-"), ())

    @F.arrow_udf(T.StringType())
    def lenient(values: pa.Array) -> pa.Array:
        def text(raw: bytes) -> str:
            own = charset if not marks or raw.startswith(marks) else f"{charset}-be"
            return raw.decode(own, "replace")

        return pa.array([None if v is None else text(v) for v in values.to_pylist()], pa.string())

    return lenient(data)
