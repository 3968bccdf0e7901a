"""Row hash with JVM semantics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.functions.numbers import UINT_MASK, wrap_int

# Multiplier of the JVM's string and list hashes, and its boolean hashes.
MULTIPLIER = 31
TRUE_HASH = 1231
FALSE_HASH = 1237
# Values that are hashed in one go, which bounds the memory for their units.
TOGETHER = 512
DAY_MILLIS = 86_400_000
# Types with a hash, besides arrays, maps and structs of them.
HASHED = (
    T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
    T.FloatType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType,
    T.NullType,
)


def _step(hashed: Column, item: Column) -> Column:
    # Both operands stay below 2^32, so the product fits a long before it is cut.
    return (hashed * F.lit(MULTIPLIER) + item).bitwiseAND(F.lit(UINT_MASK))


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def _fold(items: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Per run of ``items`` (uint32): each times the multiplier to the number of items after it."""
    hashes = np.zeros(len(sizes), np.uint32)
    filled = np.flatnonzero(sizes)
    if len(filled):
        starts = _starts(sizes)
        from_end = np.repeat(starts + sizes - 1, sizes) - np.arange(len(items))
        weighted = items * _powers(int(sizes.max()))[from_end]
        hashes[filled] = np.add.reduceat(weighted, starts[filled], dtype=np.uint32)
    return hashes


def _powers(count: int) -> np.ndarray:
    powers = np.ones(max(count, 1), np.uint32)
    np.multiply.accumulate(np.full(len(powers) - 1, MULTIPLIER, np.uint32), out=powers[1:])
    return powers


def _fold_from_one(items: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The JVM's list hash of each run: as ``_fold``, but it begins with 1."""
    return _fold(items, sizes) + _powers(int(sizes.max(initial=0)) + 1)[sizes]


def hash_units(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each of the texts that lie one after another in UTF-8 ``data``.

    A hash is the sum of the text's UTF-16 units times powers of the multiplier, all in 32 bits.
    """
    lengths = np.diff(ends)
    filled = np.flatnonzero(lengths)
    sizes = np.zeros(len(lengths), np.int64)
    if not len(filled):
        return sizes.astype(np.uint32)
    data = data[ends[0] : ends[-1]]
    units = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-16-le"), "<u2")
    # A byte that begins a character is a unit, and one that begins a wide one is two.
    of_byte = ((data & 0xC0) != 0x80).astype(np.int64) + (data >= 0xF0)
    sizes[filled] = np.add.reduceat(of_byte, _starts(lengths)[filled])
    return _fold(units.astype(np.uint32), sizes)


def _fixed(values: pa.Array, kind: str, per: int = 1) -> np.ndarray:
    """The numbers of an array of fixed width, ``per`` to an item; any number for null."""
    _, data = values.buffers()
    start, end = values.offset * per, (values.offset + len(values)) * per
    return np.frombuffer(data or b"", kind)[start:end]


def _of_longs(numbers: np.ndarray) -> np.ndarray:
    bits = numbers.view(np.uint64)
    return (bits ^ bits >> np.uint64(32)).astype(np.uint32)


def _of_floats(values: pa.Array) -> np.ndarray:
    wide = pa.types.is_float64(values.type)
    numbers = _fixed(values, "<f8" if wide else "<f4").copy()
    numbers[np.isnan(numbers)] = np.nan  # all of them have one hash
    return _of_longs(numbers) if wide else numbers.view(np.uint32)


def _of_decimals(values: pa.Array) -> np.ndarray:
    """Sign times the fold of the unscaled number's 32-bit words, then the scale."""
    words = _fixed(values, "<u4", per=4).reshape(-1, 4)
    negative = (words[:, 3] >> np.uint32(31)).astype(bool)
    positive, carry = np.empty_like(words), negative.astype(np.uint64)
    for word in range(4):  # two's complement: the inverse of all bits, and one
        inverse = np.where(negative, ~words[:, word], words[:, word]) + carry
        positive[:, word], carry = inverse.astype(np.uint32), inverse >> np.uint64(32)
    hashes = _fold(positive[:, ::-1].reshape(-1), np.full(len(words), 4))
    hashes = np.where(negative, np.uint32(0) - hashes, hashes)
    return hashes * np.uint32(MULTIPLIER) + np.uint32(values.type.scale)


def _bytes_of(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    _, offsets, data = values.buffers()
    ends = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    return np.frombuffer(data or b"", np.uint8), ends


def _within(items: pa.Array, ends: np.ndarray) -> pa.Array:
    return items.slice(ends[0], ends[-1] - ends[0])


def hash_values(values: pa.Array) -> np.ndarray:
    """Unsigned 32-bit hash of each value, 0 for null; ``row_hash`` says which."""
    kind, rows = values.type, len(values)
    if not rows or pa.types.is_null(kind):
        return np.zeros(rows, np.uint32)
    if pa.types.is_string(kind) or pa.types.is_large_string(kind):
        hashes = hash_units(*_bytes_of(values.cast(pa.large_string()).fill_null("")))
    elif pa.types.is_binary(kind) or pa.types.is_large_binary(kind):
        data, ends = _bytes_of(values.cast(pa.large_binary()).fill_null(b""))
        signed = data[ends[0] : ends[-1]].view(np.int8).astype(np.int64).astype(np.uint32)
        hashes = _fold_from_one(signed, np.diff(ends))
    elif pa.types.is_boolean(kind):
        true = np.asarray(values.fill_null(False))
        hashes = np.where(true, TRUE_HASH, FALSE_HASH)
    elif pa.types.is_int64(kind):
        hashes = _of_longs(_fixed(values, "<i8"))
    elif pa.types.is_integer(kind):
        hashes = _fixed(values, f"<i{kind.bit_width // 8}").astype(np.int64).astype(np.uint32)
    elif pa.types.is_floating(kind):
        hashes = _of_floats(values)
    elif pa.types.is_decimal128(kind):
        hashes = _of_decimals(values)
    elif pa.types.is_date32(kind):
        hashes = _of_longs(_fixed(values, "<i4").astype(np.int64) * DAY_MILLIS)
    elif pa.types.is_timestamp(kind) and kind.unit == "us":
        hashes = _of_longs(_fixed(values, "<i8") // 1000)
    elif pa.types.is_struct(kind):
        hashes = np.ones(rows, np.uint32)
        for field in values.flatten():
            more = hashes * np.uint32(MULTIPLIER) + hash_values(field)
            hashes = np.where(np.asarray(field.is_valid()), more, hashes)
    elif pa.types.is_map(kind):
        ends = np.asarray(values.offsets, np.int64)
        pairs = hash_values(_within(values.keys, ends)) ^ hash_values(_within(values.items, ends))
        total = np.concatenate([[0], np.cumsum(pairs, dtype=np.uint32)]).astype(np.uint32)
        hashes = np.diff(total[ends - ends[0]])
    elif pa.types.is_list(kind) or pa.types.is_large_list(kind):
        ends = np.asarray(values.offsets, np.int64)
        hashes = _fold_from_one(hash_values(_within(values.values, ends)), np.diff(ends))
    else:
        raise TypeError(f"row_hash does not support {kind}")
    return np.where(np.asarray(values.is_valid()), hashes, 0).astype(np.uint32)


@F.arrow_udf(T.LongType())
def value_hash(value: pa.Array) -> pa.Array:
    """Hash of each value as an unsigned 32-bit number in a long; some values together."""
    slices = [value.slice(start, TOGETHER) for start in range(0, len(value), TOGETHER)]
    hashes = np.concatenate([np.zeros(0, np.uint32), *map(hash_values, slices)])
    return pa.array(hashes.astype(np.int64), mask=np.asarray(value.is_null()))


def _supported(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_supported(field.dataType) for field in kind)
    if isinstance(kind, T.ArrayType):
        return _supported(kind.elementType)
    if isinstance(kind, T.MapType):
        return _supported(kind.keyType) and _supported(kind.valueType)
    return isinstance(kind, HASHED)


def _item_hash(value: Column, kind: T.DataType) -> Column:
    if not _supported(kind):
        raise TypeError(f"row_hash does not support columns of type {kind.simpleString()}")
    if isinstance(kind, T.BooleanType):
        return F.when(value, F.lit(TRUE_HASH)).otherwise(F.lit(FALSE_HASH)).cast("long")
    if isinstance(kind, T.LongType):
        return value.bitwiseXOR(F.shiftrightunsigned(value, 32)).bitwiseAND(F.lit(UINT_MASK))
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return value.cast("long").bitwiseAND(F.lit(UINT_MASK))
    return value_hash(value)


def row_hash(frame: DataFrame, columns: Sequence[str]) -> Column:
    """Signed 32-bit hash of the named columns of ``frame``: ``h = 1``, then ``31 * h + item``.

    Null items are skipped. Texts, booleans and numbers have the JVM's hashes; a decimal keeps the
    scale of its column. Dates (as midnight) and timestamps have that of their milliseconds since
    1970, in UTC where they have no zone. Binary values and arrays are hashed as lists of their
    items, null as 0; a map by the sum of its entries (key xor value), in any order; a struct as a
    row is. Booleans and integers stay in the JVM, the rest goes through Arrow batches.
    """
    unsigned = reduce(
        lambda hashed, name: F.when(F.col(name).isNull(), hashed).otherwise(
            _step(hashed, _item_hash(F.col(name), frame.schema[name].dataType))
        ),
        columns,
        F.lit(1).cast("long"),
    )
    return wrap_int(unsigned) if columns else F.lit(1)
