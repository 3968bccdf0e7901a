"""What several of these operators need: exact columns, Arrow batches, ordered offsets, groups."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.sinks.shared import remove_path, shared_path, write_to

# Rows taken at a time where texts become much larger intermediate arrays.
SLICE_ROWS = 256


def exact_columns(frame: DataFrame, *names: str) -> DataFrame:
    """The named columns, told by exact spelling (the first of them), whatever others there are."""
    have = frame.columns
    places = [have.index(name) for name in names]
    plain = frame.toDF(*[f"_{i}" for i in range(len(have))])
    return plain.select(*[F.col(f"_{i}").alias(name) for i, name in zip(places, names)])


def packed(frame: DataFrame, *names: str) -> DataFrame:
    """The named columns and ``_row``, a struct of all columns by position (see ``unpacked``)."""
    have = frame.columns
    plain = frame.toDF(*[f"_{i}" for i in range(len(have))])
    return plain.select(
        *[F.col(f"_{have.index(name)}").alias(name) for name in names],
        F.struct(*[F.col(f"_{i}") for i in range(len(have))]).alias("_row"),
    )


def unpacked(frame: DataFrame, names: Sequence[str]) -> DataFrame:
    """Back to the columns that ``packed`` put away."""
    return frame.select(*[F.col(f"_row._{i}").alias(name) for i, name in enumerate(names)])


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """Each text as UTF-8; null as empty."""
    for value in column.cast(pa.large_binary()):
        yield value.as_py() or b""


def texts(column: pa.Array) -> list[str]:
    """Each text; null as empty."""
    return [value or "" for value in column.to_pylist()]


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows; empty ones are left out."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def sized_slices(
    batches: Iterable[pa.RecordBatch], column: str, most: int
) -> Iterator[pa.RecordBatch]:
    """The batches in pieces whose ``column`` has at most ``most`` bytes, or a single row more."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(column)).fill_null(0)
        ends = np.cumsum(np.asarray(lengths, np.int64))
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    """A record batch from one sequence per column."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[field.name], field.type) for field in schema], schema=schema
    )


def in_order(
    frame: DataFrame,
    order: Sequence[str],
    value: str,
    name: str,
    compression: str | None = None,
    folder: str | None = None,
) -> DataFrame:
    """Rows sorted over the whole frame and written aside, with a running total.

    Adds ``before``: the sum of the non-negative whole number ``value`` over all earlier rows.
    The rows are dealt out by ranges of ``order`` and sorted there; each task keeps its own
    running total, and only one sum per range is put in order afterwards. No task sees more
    than its range, however the rows are distributed over keys: end ``order`` with columns that
    tell rows apart.

    The order is that of the files, and of ``part`` and ``place``. With a new ``folder`` the rows go
    to its ``files`` and the sums before each range to its ``starts``, for ``ordered_files``.
    """
    dealt = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    fields = [*frame.schema.fields]
    added = [
        T.StructField("part", T.IntegerType()),
        T.StructField("place", T.LongType()),
        T.StructField("within", T.LongType()),
    ]

    def total(batches):
        from pyspark import TaskContext

        part, place, carried = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = np.asarray(batch.column(value).cast(pa.int64()).to_numpy(False), np.int64)
            sums = carried + np.cumsum(values)
            within = sums - values
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(np.arange(place, place + n, dtype=np.int64)),
                    pa.array(within),
                ],
                names=[*batch.schema.names, "part", "place", "within"],
            )
            place, carried = place + n, int(sums[-1])

    path = f"{folder}/files" if folder else shared_path(frame.sparkSession, name)
    totalled = dealt.mapInArrow(total, T.StructType([*fields, *added]))
    written = write_to(totalled, path, compression=compression)
    parts = written.groupBy("part").agg(F.sum(value).alias("_sum"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        "part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).cast("long").alias("_offset")
    )
    return _placed(written, write_to(offsets, f"{folder}/starts") if folder else offsets)


def ordered_files(spark: SparkSession, folder: str) -> DataFrame:
    """What ``in_order`` has written to a folder, from its files alone."""
    return _placed(*[spark.read.parquet(f"{folder}/{name}") for name in ("files", "starts")])


def _placed(written: DataFrame, offsets: DataFrame) -> DataFrame:
    # One row per range, so its size is bounded by the number of partitions.
    placed = written.join(F.broadcast(offsets), ["part"])
    fields = [c for c in written.columns if c not in ("part", "place", "within")]
    return placed.withColumn("before", F.col("_offset") + F.col("within")).select(
        *[f"`{name}`" for name in fields], "part", "place", "before"
    )


class Scratch:
    """Steps written to the shared folder, which leave nothing else behind and can be dropped.

    The shuffle files of a step go as soon as it is written. By itself Spark deletes them when the
    driver's garbage collector finds that nothing refers to them any more, and a driver with little
    to do seldom collects, however full the executors' disks are.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def write(self, frame: DataFrame, name: str, partitions: Sequence[str] = ()) -> DataFrame:
        path = shared_path(self.spark, name)
        before = self.spark.conf.get(self.CLEANUP)
        self.spark.conf.set(self.CLEANUP, "true")
        try:
            written = write_to(frame, path, partitions, compression="zstd")
        finally:
            self.spark.conf.set(self.CLEANUP, before)
        self.paths[id(written)] = path
        return written

    def drop(self, *written: DataFrame) -> None:
        """Delete the files of steps that nothing reads any more."""
        for frame in written:
            remove_path(self.spark, self.paths.pop(id(frame)))


def whole_groups(batches: Iterable[pa.RecordBatch], key: Sequence[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``.

    Only the rows of the last group of a batch are kept for the next one.
    """
    carried: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changes = key_changes(batch, key)
        if carried:
            seam = [carried[-1].slice(carried[-1].num_rows - 1), batch.slice(0, 1)]
            if len(key_changes(pa.Table.from_batches(seam), key)):
                # The carried group ended with the batch before.
                yield pa.Table.from_batches(carried)
                carried = []
        if len(changes):
            last = int(changes[-1])
            yield pa.Table.from_batches([*carried, batch.slice(0, last)])
            carried = [batch.slice(last)]
        else:
            carried.append(batch)
    if carried:
        yield pa.Table.from_batches(carried)


def key_changes(rows: pa.RecordBatch | pa.Table, key: Sequence[str]) -> np.ndarray:
    """The places (from 1) where a row's key differs from the row before."""
    differs = np.zeros(max(0, rows.num_rows - 1), bool)
    for name in key:
        column = rows.column(name)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        unequal = pc.not_equal(column.slice(1), column.slice(0, rows.num_rows - 1))
        differs |= np.asarray(unequal.fill_null(False))
        if column.null_count:
            missing = np.asarray(column.is_null())
            differs |= missing[1:] != missing[:-1]
    return np.flatnonzero(differs) + 1


def group_bounds(rows: pa.Table, key: Sequence[str]) -> list[tuple[int, int]]:
    """Start and end of each group of a table that is sorted by ``key``."""
    edges = [0, *key_changes(rows, key).tolist(), rows.num_rows]
    return list(zip(edges[:-1], edges[1:]))


def ragged(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), ends


Kernel = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]
