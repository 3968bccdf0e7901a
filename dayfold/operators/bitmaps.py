"""Exact distinct counts that can be merged: terms are numbered once, and kept as bitmaps.

The bitmaps of a day are written with that day. Weeks, months or sliding windows are then counted
from bitmaps, and no (key, term) of an earlier day is read or shuffled again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayfold.sinks.shared import write_aside

# Ids of rows count up from a multiple of 2 to this power in each range.
ROW_BITS = 33
# A word of a bitmap has 2 to this power bits.
WORD_BITS = 6


def number_terms(
    frame: DataFrame, term: str, near: str | Sequence[str], known: DataFrame | None = None
) -> DataFrame:
    """(term, number) of the distinct terms of ``frame``: 1, 2, 3 and so on, without gaps.

    Terms of the smallest ``near`` (the key that will be counted by) come first, so terms that
    occur with one key have neighbouring numbers and share bitmaps. With ``known``, an earlier
    result, its terms keep their numbers, only new ones are added after them, and all are
    returned. Null is no term. No task sees more than a range of the terms.
    """
    keys = [near] if isinstance(near, str) else list(near)
    found = (
        frame.where(F.col(term).isNotNull())
        .groupBy(F.col(term).alias("term"))
        .agg((F.min(keys[0]) if len(keys) == 1 else F.min(F.struct(*keys))).alias("_near"))
    )
    last = F.lit(0).cast("long")
    if known is not None:
        found = found.join(known, ["term"], "left_anti")
        last = F.lit(known.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0]).cast("long")
    placed = (
        found.repartitionByRange("_near", "term")
        .sortWithinPartitions("_near", "term")
        .select("term", F.monotonically_increasing_id().alias("_row"))
    )
    written = write_aside(placed, "terms").withColumn("_range", F.shiftright("_row", ROW_BITS))
    # One row per range, so its size is bounded by the number of partitions.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = written.groupBy("_range").agg(F.count("*").alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    place = F.col("_row") - F.shiftleft("_range", ROW_BITS)
    numbered = written.join(starts, ["_range"]).select(
        "term", (last + F.col("_before") + place + 1).alias("number")
    )
    return numbered if known is None else known.select("term", "number").unionByName(numbered)


def term_bitmaps(
    frame: DataFrame, keys: str | Sequence[str], term: str, numbers: DataFrame
) -> DataFrame:
    """(keys, bucket, bits): the terms of each key as bits, 32,768 numbers to a bucket.

    ``numbers`` must hold every term of ``frame``. A (key, term) is shuffled once, reduced before
    that. ``bits`` are the words of 64 numbers that have any, (word, bits), at most 512 of them: so
    a key of few terms takes a few bytes, and words are put together as numbers, not as arrays. A
    key without any term has a bucket of its own (null), so that it is counted as 0. Null keys are
    one key.
    """
    own = [keys] if isinstance(keys, str) else list(keys)
    pairs = frame.select(*own, F.col(term).alias("term")).distinct()
    known = pairs.join(numbers, ["term"], "left")
    missing = F.col("term").isNotNull() & F.col("number").isNull()
    number = F.when(missing, F.raise_error(F.lit("a term has no number")).cast("long")).otherwise(
        F.col("number")
    )
    place = F.bitmap_bit_position("number")
    words = known.withColumn("number", number).select(
        *own,
        F.bitmap_bucket_number("number").alias("bucket"),
        F.shiftright(place, WORD_BITS).cast("smallint").alias("_word"),
        F.call_function(
            "shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(1 << WORD_BITS)).cast("int")
        ).alias("_bits"),
    )
    return _gathered(words, own)


def _words(bitmaps: DataFrame, *keys: str | Column) -> DataFrame:
    """(keys, bucket, _word, _bits): the words of bitmaps; of one without any, a row of nulls."""
    return bitmaps.select(*keys, "bucket", F.explode_outer("bits").alias("_held")).select(
        "*", F.col("_held.word").alias("_word"), F.col("_held.bits").alias("_bits")
    ).drop("_held")


def _together(words: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Each word of the keys once, with the bits of all of its rows."""
    return words.groupBy(*keys, "bucket", "_word").agg(F.bit_or("_bits").alias("_bits"), *more)


def _gathered(words: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, bucket, bits) from words that may come in several rows."""
    held = F.struct(F.col("_word").alias("word"), F.col("_bits").alias("bits"))
    return _together(words, keys).groupBy(*keys, "bucket").agg(
        F.collect_list(F.when(F.col("_word").isNotNull(), held)).alias("bits")
    )


def merge_bitmaps(bitmaps: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """(keys, bucket, bits) for fewer keys: bitmaps of the same bucket put together."""
    own = [keys] if isinstance(keys, str) else list(keys)
    return _gathered(_words(bitmaps, *own), own)


def _number_of_bits() -> Column:
    return F.sum(F.coalesce(F.bit_count("_bits"), F.lit(0)))


def count_bitmaps(
    bitmaps: DataFrame, keys: str | Sequence[str], name: str = "distinct_num"
) -> DataFrame:
    """(keys, name): how many different terms the bitmaps of each key hold together."""
    own = [keys] if isinstance(keys, str) else list(keys)
    return _together(_words(bitmaps, *own), own).groupBy(*own).agg(_number_of_bits().alias(name))


def rolling_distinct(
    bitmaps: DataFrame,
    keys: str | Sequence[str],
    day: str,
    days: int,
    name: str = "distinct_num",
) -> DataFrame:
    """(keys, day, name): distinct terms of each key on a day and the ``days`` - 1 days before.

    ``bitmaps`` are those by keys and ``day`` (a date). A key has a row for each day that it has
    bitmaps for. Each word of a bitmap goes to the ``days`` windows that it lies in.
    """
    if days < 1:
        raise ValueError(f"a window has at least one day, not {days}")
    own = [keys] if isinstance(keys, str) else list(keys)
    ahead = F.explode(F.sequence(F.lit(0), F.lit(days - 1)))
    words = _words(bitmaps.where(F.col(day).isNotNull()), *own, day).withColumn("_ahead", ahead)
    windows = words.withColumn(day, F.date_add(day, F.col("_ahead")))
    nearest = F.min("_ahead").alias("_ahead")
    counted = _together(windows, [*own, day], nearest).groupBy(*own, day).agg(
        _number_of_bits().alias(name), nearest
    )
    return counted.where(F.col("_ahead") == 0).drop("_ahead")
