"""Exact duplicates by a tree merge of sorted runs of digests.

Each task turns its documents into a run: one row per text with the row to keep and a count.
The owners of runs then exchange parts of them in rounds, as in a recursive halving: in round
k an owner's k-th digit becomes that of the text's bucket, so that a few runs meet, are merged,
and each merged run is cut up again by the next round. After the last round an owner has the
whole of its bucket and of nothing else. A text that a third of all rows share is one row of
each run from the first round on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.common import batch_of, exact_columns, packed, slices, text_bytes, unpacked
from dayfold.sinks.shared import write_aside

# How many runs meet in a round, and how many texts an owner is meant to hold.
FAN_IN = 8
OWNER_TEXTS = 2_000_000
# Below every doc_id: stands for a missing one, which is kept only where there is no other.
NO_ID = -(2**63)
# What tells texts apart: a digest, verified by a second hash and the length in bytes.
IDENTITY = ["digest", "check", "length"]

DIGESTED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("digest", pa.binary()),
        ("check", pa.int64()),
        ("length", pa.int64()),
    ]
)
RUN = pa.schema(
    [
        ("digest", pa.binary()),
        ("check", pa.int64()),
        ("length", pa.int64()),
        ("keep", pa.int64()),
        ("copies", pa.int64()),
        ("same", pa.int64()),
    ]
)
RUN_KINDS = "digest binary, check bigint, length bigint, keep bigint, copies bigint, same bigint"


def _identity(text: bytes) -> tuple[bytes, int, int]:
    """Digest, second hash and length of a text in which A-Z is lower-cased."""
    plain = text.lower()  # of bytes: only A-Z
    check = xxhash.xxh3_64_intdigest(plain)
    return hashlib.sha256(plain).digest(), check - (1 << 64) * (check >> 63), len(plain)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, check, length) of every row."""

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [_identity(text) for text in text_bytes(batch.column("text"))]
            yield batch_of(
                DIGESTED,
                doc_id=batch.column("doc_id").to_pylist(),
                digest=[x[0] for x in found],
                check=[x[1] for x in found],
                length=[x[2] for x in found],
            )

    return exact_columns(docs, "doc_id", "text").mapInArrow(
        digest, "doc_id bigint, digest binary, check bigint, length bigint"
    )


def _merged(rows: pa.Table) -> pa.RecordBatch:
    """One row per text of rows (IDENTITY, keep, copies, same), sorted by text."""
    order = [(name, "ascending") for name in [*IDENTITY, "keep"]]
    rows = rows.sort_by(order).combine_chunks()
    n = rows.num_rows
    digest = np.array(rows.column("digest").to_pylist(), object)
    numbers = {name: np.asarray(rows.column(name)) for name in RUN.names[1:]}
    new = np.ones(n, bool)
    new[1:] = (
        (digest[1:] != digest[:-1])
        | (numbers["check"][1:] != numbers["check"][:-1])
        | (numbers["length"][1:] != numbers["length"][:-1])
    )
    starts = np.flatnonzero(new)
    keep = np.maximum.reduceat(numbers["keep"], starts)
    group = np.cumsum(new) - 1
    same = np.where(numbers["keep"] == keep[group], numbers["same"], 0)
    return batch_of(
        RUN,
        digest=digest[starts].tolist(),
        check=numbers["check"][starts],
        length=numbers["length"][starts],
        keep=keep,
        copies=np.add.reduceat(numbers["copies"], starts),
        same=np.add.reduceat(same, starts),
    )


def _merge_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge batches that are sorted by text; the last text of a batch waits for the next."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            merged = _merged(pa.Table.from_batches([*waiting, batch.select(RUN.names).cast(RUN)]))
            yield merged.slice(0, merged.num_rows - 1)
            waiting = [merged.slice(merged.num_rows - 1)]
    yield from waiting


def _digit(number: Column, k: int) -> Column:
    return F.pmod(F.floor(number / F.lit(FAN_IN**k)), F.lit(FAN_IN)).cast("int")


def merged_runs(hashed: DataFrame) -> DataFrame:
    """One row (digest, check, length, keep, copies, same) per text of ``hashed``.

    ``keep`` is the largest doc_id, ``copies`` the number of rows, ``same`` how many of those
    have that doc_id. ``hashed`` is read twice, so it should be a written table.
    """
    owners = max(FAN_IN, hashed.count() / OWNER_TEXTS)
    rounds = max(2, ceil(log(owners, FAN_IN)))
    owners = FAN_IN**rounds
    ids = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    rows = hashed.select(*IDENTITY, ids.alias("keep"), F.lit(1).cast("long").alias("copies"))
    runs = (
        rows.withColumn("same", F.col("copies"))
        .mapInArrow(_merge_unsorted, RUN_KINDS)
        .withColumn("owner", F.pmod(F.spark_partition_id(), F.lit(owners)).cast("int"))
    )
    bucket = F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(owners))
    for k in range(rounds):
        change = _digit(bucket, k) - _digit(F.col("owner"), k)
        sent = runs.withColumn("owner", (F.col("owner") + change * F.lit(FAN_IN**k)).cast("int"))
        met = sent.repartition(owners, "owner").sortWithinPartitions("owner", *IDENTITY)
        runs = met.mapInArrow(_merge_owned, f"{RUN_KINDS}, owner int")
    return runs.drop("owner")


def _merge_unsorted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's own run, in pieces of one batch each."""
    for batch in batches:
        if batch.num_rows:
            yield _merged(pa.Table.from_batches([batch.select(RUN.names).cast(RUN)]))


def _merge_owned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge the runs of each owner in a task; the rows are sorted by owner, then by text."""
    waiting: tuple[int, pa.RecordBatch] | None = None

    def with_owner(run: pa.RecordBatch, owner: int) -> pa.RecordBatch:
        return run.append_column("owner", pa.array(np.full(run.num_rows, owner, np.int32)))

    for batch in batches:
        owned = np.asarray(batch.column("owner"))
        edges = [0, *(np.flatnonzero(owned[1:] != owned[:-1]) + 1).tolist(), len(owned)]
        for a, b in zip(edges[:-1], edges[1:]):
            if a == b:
                continue
            piece = [batch.slice(a, b - a).select(RUN.names).cast(RUN)]
            if waiting is not None and waiting[0] == owned[a]:
                piece.insert(0, waiting[1])
            elif waiting is not None:
                yield with_owner(waiting[1], waiting[0])
            merged = _merged(pa.Table.from_batches(piece))
            yield with_owner(merged.slice(0, merged.num_rows - 1), int(owned[a]))
            waiting = int(owned[a]), merged.slice(merged.num_rows - 1)
    if waiting is not None:
        yield with_owner(waiting[1], waiting[0])


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, copies_of_id) for each row of ``docs``.

    Texts are equal when they are identical after lower-casing A-Z; a null text is empty, and
    empty texts are equal. The largest doc_id of equal texts stays; a null doc_id stays only
    where its group has no other. Rows that repeat a doc_id with an equal text are one document
    and have the same result (``drop_duplicates`` retains one of them). An empty table gives
    none; whole texts count, of any length; other columns are ignored.

    Texts are read once. What moves are digests; a group of any size is one row per run, and
    the join that tells each row its group is one that adaptive execution splits.
    """
    hashed = write_aside(digests(docs), "digests")
    merged = write_aside(merged_runs(hashed), "digest-runs")
    joined = hashed.join(merged, IDENTITY)
    own = F.coalesce(F.col("doc_id"), F.lit(NO_ID))
    return joined.select(
        "doc_id",
        F.when(F.col("keep") > NO_ID, F.col("keep")).alias("keep_id"),
        F.col("copies").alias("group_size"),
        (own == F.col("keep")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.col("same").alias("copies_of_id"),
    )


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row per text.

    As ``exact_duplicates``; of rows that repeat a doc_id with an equal text one stays.
    """
    names = docs.columns
    hashed = write_aside(digests(docs), "digests")
    merged = write_aside(merged_runs(hashed), "digest-runs")

    whole = packed(docs, "doc_id", "text")
    added = [DIGESTED.field(name) for name in IDENTITY]

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [_identity(text) for text in text_bytes(batch.column("text"))]
            columns = [pa.array([x[i] for x in found], f.type) for i, f in enumerate(added)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_row"), *columns],
                names=["doc_id", "_row", *IDENTITY],
            )

    kinds = T.StructType(
        [
            whole.schema["doc_id"],
            whole.schema["_row"],
            T.StructField("digest", T.BinaryType()),
            T.StructField("check", T.LongType()),
            T.StructField("length", T.LongType()),
        ]
    )
    rows = whole.mapInArrow(digest, kinds).join(merged, IDENTITY)
    stay = rows.where(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("keep"))
    if merged.where(F.col("same") > 1).isEmpty():
        return unpacked(stay, names)
    single = stay.where(F.col("same") == 1)
    repeated = stay.where(F.col("same") > 1).groupBy(*IDENTITY).agg(F.first("_row").alias("_row"))
    return unpacked(single.select("_row").unionByName(repeated.select("_row")), names)
