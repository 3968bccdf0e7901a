"""Near duplicates of embeddings by binary codes.

Vectors are normalised and turned by random rotations; the signs are a binary code, and the
inner product of a rotated vector with its own code is stored as a correction factor. Dividing by
it makes the inner product of another rotated vector with the code an unbiased estimate of the
cosine, with a known deviation; that other vector is stored in eight bits a component. The bits
are cut into bands whose equality puts vectors in a bucket; vectors of a bucket whose codes differ
in few bits are candidates. In the groups that candidates form, each pair is estimated from what is
stored, and full vectors are only read for pairs where the confidence bound does not exclude a
link: their cosine is computed in double precision.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b
from math import acos, ceil, log, log2, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import exact_columns, group_bounds, whole_groups
from dayfold.llm.links import components, in_blocks, linked
from dayfold.sinks.shared import write_aside

THRESHOLD = 0.9
# The probability with which a pair exactly at the threshold meets in a bucket.
RECALL = 0.995
# Vectors that meet in a bucket by chance.
CHANCE = 8
# Deviations of the estimate, and of the number of differing bits, that still count as possible.
CONFIDENCE = 4.0
BLOCK = 100
SEED = 5


@lru_cache(maxsize=8)
def rotation(dims: int, number: int) -> np.ndarray:
    """A random rotation (or reflection): orthogonal, and the same in every task."""
    drawn = np.random.default_rng([SEED, dims, number]).standard_normal((dims, dims))
    q, r = np.linalg.qr(drawn)
    return q * np.sign(np.diag(r))


def bands(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """Bits per band and number of bands for so many vectors."""
    width = min(40, max(6, ceil(log2(max(2, vectors / CHANCE)))))
    equal = (1 - acos(threshold) / pi) ** width
    return width, ceil(log(1 - recall) / log(1 - equal))


def usable(values: np.ndarray | None) -> bool:
    """Whether a vector can be linked: not null, not zero, all components finite."""
    return values is not None and len(values) > 0 and np.isfinite(values).all() and values.any()


def _unit(values: np.ndarray) -> np.ndarray:
    scaled = values / np.abs(values).max(axis=-1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=-1, keepdims=True)


def coded(vectors: DataFrame) -> DataFrame:
    """(vec_id, node, vector): vectors as doubles; no node for one that cannot be linked."""

    def code(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, data = [], []
            for value in batch.column("embedding").to_pylist():
                row = None
                if value is not None and None not in value:
                    row = np.array(value, np.float64)
                good = usable(row)
                data.append(row.tobytes() if good else None)
                nodes.append(blake2b(data[-1], digest_size=16).digest() if good else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").cast(pa.int64()),
                    pa.array(nodes, pa.binary()),
                    pa.array(data, pa.binary()),
                ],
                names=["vec_id", "node", "vector"],
            )

    return exact_columns(vectors, "vec_id", "embedding").mapInArrow(
        code, "vec_id bigint, node binary, vector binary"
    )


def _by_dims(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and matrix of the vectors of each dimension in a batch."""
    data = column.to_pylist()
    dims = np.array([len(x) // 8 for x in data])
    for d in np.unique(dims):
        rows = np.flatnonzero(dims == d)
        yield rows, np.frombuffer(b"".join(data[i] for i in rows), np.float64).reshape(-1, d)


def banded(nodes: DataFrame, width: int, number: int) -> DataFrame:
    """(node, code, factors, small, buckets) of rows (node, vector).

    ``code`` has the signs of all rotations; ``factors`` the correction factor of each, then the
    step and the error of ``small``, which is the unit vector in whole steps of eight bits.
    """

    def band(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            codes: list[bytes] = [b""] * batch.num_rows
            factors, small = codes.copy(), codes.copy()
            buckets: list[list[int]] = [[]] * batch.num_rows
            for rows, matrix in _by_dims(batch.column("vector")):
                dims = matrix.shape[1]
                unit = _unit(matrix)
                turns = ceil(width * number / dims)
                turned = np.stack([unit @ rotation(dims, k) for k in range(turns)], axis=1)
                bits = (turned > 0).reshape(len(rows), -1)
                step = np.abs(unit).max(1, keepdims=True) / 127
                whole = np.rint(unit / step).astype(np.int8)
                error = np.linalg.norm(unit - whole * step, axis=1, keepdims=True)
                kept = np.concatenate([np.abs(turned).sum(2) / sqrt(dims), step, error], axis=1)
                packed = np.packbits(bits, axis=1)
                cut = bits[:, : width * number].reshape(len(rows), number, width)
                keys = np.packbits(cut, axis=2)
                for at, i in enumerate(rows.tolist()):
                    codes[i] = packed[at].tobytes()
                    factors[i], small[i] = kept[at].tobytes(), whole[at].tobytes()
                    buckets[i] = [
                        xxhash.xxh3_64_intdigest(keys[at, b].tobytes(), seed=b * 65536 + dims)
                        - (1 << 63)
                        for b in range(number)
                    ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array(codes, pa.binary()),
                    pa.array(factors, pa.binary()),
                    pa.array(small, pa.binary()),
                    pa.array(buckets, pa.list_(pa.int64())),
                ],
                names=["node", "code", "factors", "small", "buckets"],
            )

    return nodes.select("node", "vector").mapInArrow(
        band, "node binary, code binary, factors binary, small binary, buckets array<bigint>"
    )


def _few_bits(threshold: float):
    """Pairs whose codes differ in as few bits as a pair at the threshold may."""

    def pairs(table: pa.Table, rows: np.ndarray, others: np.ndarray | None):
        column = table.column("code")

        def codes(places):
            data = b"".join(column[i].as_py() for i in places.tolist())
            return np.frombuffer(data, np.uint8).reshape(len(places), -1)

        own = codes(rows)
        size = own.shape[1] * 8
        share = acos(threshold) / pi
        most = share * size + CONFIDENCE * sqrt(size * share * (1 - share))
        second = own if others is None else codes(others)
        differ = np.bitwise_count(own[:, None, :] ^ second[None, :, :]).sum(2, dtype=np.int64)
        close = differ <= most
        if others is None:
            close = np.triu(close, 1)
            others = rows
        a, b = np.nonzero(close)
        return rows[a], others[b]

    return pairs


def estimates(codes_of: np.ndarray, against: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated cosines of rotated unit vectors ``against`` (rows) with those that codes stand
    for (columns), and the deviation of the estimates of each column."""
    factor = np.abs(codes_of).sum(1) / sqrt(codes_of.shape[1])
    return from_codes(codes_of > 0, factor, against)


def from_codes(
    bits: np.ndarray, factor: np.ndarray, against: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """As ``estimates``, from the signs and factors of one rotation."""
    dims = bits.shape[1]
    signs = np.where(bits, 1.0, -1.0) / sqrt(dims)
    estimate = (against @ signs.T) / factor
    if dims < 2:
        return estimate, np.full(len(factor), np.inf)
    return estimate, np.sqrt(np.maximum(0.0, 1 - factor**2) / (factor**2 * (dims - 1)))


def _matrix(table: pa.Table, name: str, places: np.ndarray, kind: type) -> np.ndarray:
    data = table.column(name).take(pa.array(places)).to_pylist()
    return np.frombuffer(b"".join(data), kind).reshape(len(places), -1)


def possible(
    table: pa.Table, queries: np.ndarray, others: np.ndarray, threshold: float
) -> np.ndarray:
    """For rows ``queries`` by ``others``: whether the bound leaves a link open.

    The estimates of the rotations are independent, so their mean deviates less. What the eight
    bits of a query can add to it is bounded by their error over the factors.
    """
    stored = _matrix(table, "factors", others, np.float64)[:, :-2]
    turns = stored.shape[1]
    step, error = _matrix(table, "factors", queries, np.float64)[:, -2:].T
    against = _matrix(table, "small", queries, np.int8) * step[:, None]
    dims = against.shape[1]
    bits = np.unpackbits(_matrix(table, "code", others, np.uint8), axis=1)[:, : turns * dims]
    bits = bits.reshape(len(others), turns, dims).astype(bool)
    total, variance = np.zeros((len(queries), len(others))), np.zeros(len(others))
    for k in range(turns):
        found = from_codes(bits[:, k], stored[:, k], against @ rotation(dims, k))
        total, variance = total + found[0], variance + found[1] ** 2
    slack = error[:, None] * (1 / stored).mean(1)
    return total / turns + CONFIDENCE * np.sqrt(variance) / turns + slack >= threshold


PLACE = ["component", "lo", "hi"]


def open_pairs(blocks: DataFrame, threshold: float) -> DataFrame:
    """(component, lo, hi, block, node, open) of the rows of blocks that have an open pair.

    ``open`` has a bit for each of these rows of the same place, in the order of their nodes.
    """

    def estimate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, PLACE):
            table = table.combine_chunks()
            lo, hi, block = (np.asarray(table.column(c)) for c in ("lo", "hi", "block"))
            kept: list[int] = []
            masks: list[bytes] = []
            for start, end in group_bounds(table, PLACE):
                open_here = np.zeros((end - start, end - start), bool)
                rows = np.arange(start, end)
                if lo[start] == hi[start]:
                    open_here = np.triu(possible(table, rows, rows, threshold), 1)
                else:
                    own = block[start:end] == lo[start]
                    if own.any() and not own.all():
                        found = possible(table, rows[own], rows[~own], threshold)
                        open_here[np.ix_(own, ~own)] = found
                open_here |= open_here.T
                keep = np.flatnonzero(open_here.any(1))
                kept += rows[keep].tolist()
                masks += [m.tobytes() for m in np.packbits(open_here[np.ix_(keep, keep)], axis=1)]
            taken = table.select([*PLACE, "block", "node"]).take(pa.array(kept, pa.int64()))
            yield from taken.append_column("open", pa.array(masks, pa.binary())).to_batches()

    return blocks.mapInArrow(
        estimate, "component binary, lo int, hi int, block int, node binary, open binary"
    )


def _close(threshold: float):
    """Open pairs with at least the threshold's cosine, in double precision."""

    def pairs(table: pa.Table, rows: np.ndarray, others: np.ndarray | None):
        # Together the rows are all of a place, and the bits are in that order.
        place = rows if others is None else np.sort(np.concatenate([rows, others]))
        first = place[0]
        masks = np.unpackbits(_matrix(table, "open", place, np.uint8), axis=1)[:, : len(place)]
        if others is None:
            a, b = np.nonzero(np.triu(masks, 1))
        else:
            some, rest = np.nonzero(masks[np.ix_(rows - first, others - first)])
            a, b = rows[some] - first, others[rest] - first
        vectors = _matrix(table, "vector", place, np.float64)
        x, y = vectors[a], vectors[b]
        products = np.einsum("ij,ij->i", x, y)
        norms = np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))
        if not np.isfinite(norms).all() or not norms.all():
            products, norms = np.einsum("ij,ij->i", _unit(x), _unit(y)), np.ones(len(a))
        linked_pairs = products >= threshold * norms
        return place[a[linked_pairs]], place[b[linked_pairs]]

    return pairs


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept, n_same) of each row of ``vectors``.

    ``vectors`` has vec_id, embedding (an array of numbers) and any other columns. Two rows are
    linked when the cosine of their vectors, in double precision, is at least ``threshold``;
    vectors of different length are not. ``n_links`` counts the other rows a row is linked to,
    ``component_id`` is the smallest vec_id that links lead to, ``kept`` says that it is the
    row's own, ``n_same`` counts rows with the same vector.

    A vector that is null, empty or zero or has null or non-finite components is linked with
    nothing. Rows with equal vectors are linked and are compared as one. Rows that repeat a
    vec_id count by themselves; a null vec_id counts as larger than any other. An empty table
    gives none.

    A link at the threshold is found with probability ``recall`` at least, and a closer one
    with more; in a group of candidates every pair that the bound leaves open is decided exactly.
    """
    rows = write_aside(coded(vectors), "embedding-rows")
    able = rows.where(F.col("node").isNotNull())
    nodes = write_aside(
        able.groupBy("node").agg(
            F.first("vector").alias("vector"),
            F.min("vec_id").alias("first_id"),
            F.count("*").alias("weight"),
        ),
        "embedding-nodes",
    )
    width, number = bands(nodes.count(), threshold, recall)
    one = F.lit(1).cast("long").alias("weight")
    codes = write_aside(banded(nodes, width, number), "embedding-codes")
    placed = codes.select("node", F.explode("buckets").alias("bucket"))
    counts = placed.groupBy("bucket").agg(F.count("*").alias("members"))
    # Written, so that the join has shuffles of its own, which can be split where skewed.
    counts = write_aside(counts.where(F.col("members") > 1), "embedding-buckets")
    met = placed.join(counts, ["bucket"])
    met = met.join(codes.select("node", "code", one), ["node"])
    candidates = linked(in_blocks(met, "bucket", "members", BLOCK), "bucket", _few_bits(threshold))
    groups = components(candidates, "embedding-candidates")
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    grouped = groups.join(sizes, ["component"]).join(
        codes.select("node", "code", "factors", "small"), ["node"]
    )
    blocks = in_blocks(grouped, "component", "members", BLOCK)
    left_open = write_aside(open_pairs(blocks, threshold), "embedding-open")
    exact = left_open.join(nodes.select("node", "vector", "weight"), ["node"])
    exact = exact.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE, "node")
    found = write_aside(linked(exact, "component", _close(threshold)), "embedding-links")
    classes = components(found, "embedding-classes")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = write_aside(
        nodes.select("node", "first_id", "weight")
        .join(links, ["node"], "left")
        .join(classes, ["node"], "left")
        .withColumn("component", F.coalesce("component", "node")),
        "embedding-known",
    )
    lowest = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    told = known.join(lowest, ["component"]).select(
        "node",
        "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        "weight",
    )
    joined = able.select("vec_id", "node").join(told, ["node"]).select(
        "vec_id",
        "n_links",
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
        F.col("weight").alias("n_same"),
    )
    alone = rows.where(F.col("node").isNull()).select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
        F.lit(True).alias("kept"),
        F.lit(1).cast("long").alias("n_same"),
    )
    return joined.unionByName(alone)
