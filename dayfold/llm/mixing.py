"""Mixing sources to target weights, by a curriculum that changes over the training.

Each source has a target of words. Its documents stand in a fixed random order; going through
them again and again until the target is reached says how often each one is taken. When they are
taken follows from the source's weight schedule: the integral of the schedule up to a time is
what the source has to have given by then, so the time of a document is that integral inverted at
the words that come before its middle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.common import (
    batch_of,
    exact_columns,
    in_order,
    packed,
    slices,
    text_bytes,
    unpacked,
)
from dayfold.sinks.shared import write_aside

# Weights of the sources in order, share of all words, and how often at most.
WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
# How far the share of a source tilts over the training: heavier sources come earlier.
TILT = 0.5

SIZED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("source", pa.string()),
        ("key", pa.binary()),
        ("size", pa.int64()),
        ("task", pa.int32()),
        ("row", pa.int64()),
    ]
)


def targets(
    sizes: Sequence[float], weights: Sequence[float], total: float, most: float
) -> list[float]:
    """Shares of ``total`` by weight; none above ``most`` times its size, the rest shared again.

    The rule for a list of sources; ``water_level`` is the same over a table.
    """
    found = [0.0] * len(sizes)
    free = [i for i, size in enumerate(sizes) if size > 0]
    left = total
    while free:
        weight = sum(weights[i] for i in free)
        share = {i: left * weights[i] / weight for i in free}
        above = [i for i in free if share[i] > most * sizes[i]]
        if not above:
            for i in free:
                found[i] = share[i]
            break
        for i in above:
            found[i] = most * sizes[i]
        left = max(0.0, left - sum(found[i] for i in above))
        free = [i for i in free if i not in set(above)]
    return found


def water_level(sources: DataFrame, total: float, most: float) -> float:
    """Words per unit of weight at which the sources (size, weight) take ``total`` together.

    A source takes its weight times the level, and at most ``most`` times its size. The level
    starts where nothing is limited and rises by what the limits leave over, until no further
    source is above its limit; each round is one small aggregation.
    """
    limit, level = F.col("size") * F.lit(float(most)), 0.0
    while True:
        full = F.col("weight") * F.lit(level) > limit
        found = sources.agg(
            F.sum(F.when(full, limit).otherwise(0.0)).alias("taken"),
            F.sum(F.when(full | (F.col("size") == 0), 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if not found.free:
            return float("inf")
        higher = max(0.0, total - found.taken) / found.free
        if higher <= level:
            return level
        level = higher


def planned(
    ordered: DataFrame, weights: Sequence[float], share: float, most: float, tilt: float
) -> DataFrame:
    """(source, source_size, offset, target, tilt) of each source of the ordered rows.

    The sources are ordered by code point, null last, and take the weights in turn; ``offset`` is
    the words of the sources before. A schedule is linear in time,
    ``target * (1 + tilt * (2 t - 1))``; the tilts are such that the targets times the tilts add up
    to nothing, so that the mix as a whole gives words at a steady rate. No list of sources goes
    to the driver: they may be as many as there are domains.
    """
    sizes = ordered.groupBy("last", "source").agg(
        F.sum("size").alias("size"), F.min("before").alias("offset"), F.lit(1).alias("one")
    )
    numbered = in_order(sizes, ["last", "source"], "one", "mixing-sources")
    cycle = F.array(*[F.lit(float(weight)) for weight in weights])
    turn = (F.col("before") % len(weights)).cast("int")
    own = numbered.select("source", "size", "offset", F.get(cycle, turn).alias("weight"))
    words = own.agg(F.sum("size")).first()[0] or 0
    level = water_level(own, share * words, most)
    aims = own.withColumn(
        "target", F.least(F.col("weight") * F.lit(level), F.col("size") * F.lit(float(most)))
    )
    total = aims.agg(
        (F.sum(F.col("target") * F.col("weight")) / F.nullif(F.sum("target"), F.lit(0.0))).alias("mean"),
        F.min("weight").alias("least"),
        F.max("weight").alias("largest"),
    ).first()
    mean = total.mean or 0.0
    spread = max(mean - total.least, total.largest - mean) if total.mean else 0.0
    leaning = F.lit(-tilt) * (F.col("weight") - F.lit(mean)) / F.lit(spread or 1.0)
    return aims.select(
        "source", F.col("size").alias("source_size"), "offset", "target", leaning.alias("tilt")
    )


def times(demand: np.ndarray, tilt: np.ndarray) -> np.ndarray:
    """When a schedule has given the share ``demand`` of its target: the integral inverted.

    The integral of a linear schedule is ``(1 - tilt) t + tilt t^2``. For arrays; ``_time`` is the
    same for columns.
    """
    slope = 1 - tilt
    root = np.sqrt(slope * slope + 4 * tilt * demand)
    return np.clip(2 * demand / np.maximum(slope + root, 1e-12), 0.0, 1.0)


def _time(demand: Column, tilt: Column) -> Column:
    """``times`` as a column, for demands up to 1."""
    slope = F.lit(1.0) - tilt
    root = F.sqrt(slope * slope + F.lit(4.0) * tilt * demand)
    return F.least(F.lit(2.0) * demand / F.greatest(slope + root, F.lit(1e-12)), F.lit(1.0))


def _key(doc_id: int | None, source: str | None, text: bytes) -> bytes:
    head = f"{doc_id}\x00{'' if source is None else 's' + source}\x00".encode()
    return xxhash.xxh3_128_digest(head + text)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, key, size, task, row) of every row; copies of one row have one key."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, given = TaskContext.get().partitionId(), 0
        for batch in slices(batches):
            ids, sources = batch.column("doc_id").to_pylist(), batch.column("source").to_pylist()
            data = list(text_bytes(batch.column("text")))
            yield batch_of(
                SIZED,
                doc_id=ids,
                source=sources,
                key=[_key(*row) for row in zip(ids, sources, data)],
                size=[len(text.split()) for text in data],
                task=[task] * len(data),
                row=range(given, given + len(data)),
            )
            given += len(data)

    return exact_columns(docs, "doc_id", "source", "text").mapInArrow(
        count, "doc_id bigint, source string, key binary, size bigint, task int, row bigint"
    )


def _mixed(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    tilt: float = TILT,
) -> DataFrame:
    """``mix``, with ``before``: the words of all rows before this one in the order."""
    rows = write_aside(sized(docs), "mixing-sizes").withColumn("last", F.col("source").isNull())
    # Copies are told apart by where they were read, so that a group of any size can be cut.
    order = ["last", "source", "key", "task", "row"]
    ordered = in_order(rows, order, "size", "mixing-order")
    plan = planned(ordered, weights, share, most, tilt).withColumnRenamed("source", "_name")
    whole, target = F.col("source_size"), F.col("target")
    middle = F.col("before") - F.col("offset") + F.col("size") / 2
    often = F.when(whole > 0, target / whole).otherwise(0.0)
    extra = (middle < (often - F.floor(often)) * whole).cast("int")
    copies = F.when(F.col("size") > 0, F.floor(often) + extra).otherwise(0).cast("int")
    positions = F.transform(
        F.slice(F.sequence(F.lit(0), F.col("copies")), F.lit(1), F.col("copies")),
        lambda i: _time(
            F.least((i * whole + middle) / F.greatest(target, F.lit(1e-12)), F.lit(1.0)),
            F.col("tilt"),
        ),
    )
    joined = ordered.join(plan, F.col("source").eqNullSafe(F.col("_name")))
    return joined.withColumn("copies", copies).withColumn("positions", positions).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
        "positions",
        "key",
        "before",
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    tilt: float = TILT,
) -> DataFrame:
    """How often and when each row of ``docs`` (doc_id, source, text, ...) is taken.

    (doc_id, source, size, source_size, target, taken, copies, positions, key): ``size`` counts
    words, ``taken`` is ``copies`` times it, ``positions`` are times in the training from 0 to 1.

    A null text is empty and never taken, nor is one of white space; a null source is a source,
    the last one; a null doc_id is an id. Copies of a row (equal in doc_id, source and text) stand
    side by side in the order, and each is a row of its own there: some may be taken once more
    than others. The order is that of a hash, so reruns agree. What a source gives differs from
    its target by at most half a document. An empty table gives none.

    A source of any size, and a group of copies of any size, is spread over tasks by ranges.
    Targets are a table that is joined: only sums over all sources go to the driver.
    """
    return _mixed(docs, weights, share, most, tilt).drop("before")


def training_order(docs: DataFrame, **options) -> DataFrame:
    """The documents that are taken, with all columns of ``docs``, as often and when ``mix`` says.

    The rows are sorted by position over ranges: the files of what is written are the training
    order. Rows that are equal in doc_id, source and text take the places of their group in the
    order in which they are read.
    """
    names = docs.columns
    rows = _mixed(docs, **options).where(F.col("size") > 0)
    groups = rows.groupBy("key").agg(F.count("*").alias("_n"), F.min("before").alias("_first"))
    several = groups.where(F.col("_n") > 1)
    number = F.coalesce((F.col("before") - F.col("_first")) / F.col("size"), F.lit(0.0))
    decided = write_aside(
        rows.join(several, ["key"], "left").select(
            "key", number.cast("long").alias("_number"), "_n", "copies", "positions"
        ),
        "mixing-decided",
    )
    whole = packed(docs, "doc_id", "source", "text")

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, sources = batch.column("doc_id").to_pylist(), batch.column("source").to_pylist()
            keys = [_key(*row) for row in zip(ids, sources, text_bytes(batch.column("text")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(keys, pa.binary())], names=["_row", "key"]
            )

    kinds = T.StructType([whole.schema["_row"], T.StructField("key", T.BinaryType())])
    found = whole.mapInArrow(keyed, kinds)
    taken = decided.where(F.col("copies") > 0)
    single = found.join(taken.where(F.col("_n").isNull()), ["key"])
    copies = _numbered(found.join(several.select("key"), ["key"], "left_semi"))
    shared = copies.join(taken.where(F.col("_n").isNotNull()), ["key", "_number"])
    columns = ["_row", "key", F.explode("positions").alias("_position")]
    placed = single.select(*columns).unionByName(shared.select(*columns))
    ordered = placed.repartitionByRange("_position", "key").sortWithinPartitions("_position", "key")
    return unpacked(ordered, names)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``_number``: which of the rows with its key each one is, from 0."""
    told = rows.select("*", F.monotonically_increasing_id().alias("_id"), F.lit(1).alias("_one"))
    counted = in_order(told, ["key", "_id"], "_one", "mixing-copies")
    first = counted.groupBy("key").agg(F.min("before").alias("_first"))
    return counted.join(first, ["key"]).select(
        "_row", "key", (F.col("before") - F.col("_first")).alias("_number")
    )
