"""Similarity join of documents on word shingles: a chosen-path join.

A document is the set of its runs of five words. In a run of the join every set chooses a few of
its tokens at random, by a hash that all sets share, and goes to the bucket of each; similar sets
share most tokens, so they probably meet. A bucket that is still large is split again by tokens
chosen at the next level, along a path of chosen tokens, until it is small or the path is long
enough; then its members are compared by their MinHash sketches. Runs are repeated until a pair
at the threshold is found with the target probability.

What is found that way only says which sets may be alike: it puts them in groups. Within a group
all pairs are compared exactly, by the sets themselves, so a pair that was missed is still found
where other links lead to it.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from math import ceil, exp, log, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import Scratch, exact_columns, slices, text_bytes
from dayfold.llm.links import (
    components,
    in_blocks,
    in_places,
    joined,
    linked,
    of_different_groups,
    once,
)

WORDS = 5
THRESHOLD = 0.8
# The probability with which a pair at the threshold is to be found.
RECALL = 0.999
# How many tokens a set chooses on average, how long a path can get, and what is a small bucket.
CHOSEN = 2.0
DEPTH = 3
SMALL = 64
# Members of a bucket, by sketch, and of a group, by their sets, that are compared in one place.
COMPARED = 1024
BLOCK = 100
# Sketches that are compared with others in one go.
TILE = 64
# Slots of a sketch, and how far below the threshold (in deviations) a pair is still kept.
SLOTS = 64
SLACK = 4.0
# Word hashes that a worker remembers.
MEMO_WORDS = 1_000_000
# Sets that a task remembers to have given to their group.
MEMO_SETS = 100_000
NO_ID = -(2**63)

_WORD_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WORDS)], np.uint64)


def runs_needed(threshold: float = THRESHOLD, recall: float = RECALL) -> int:
    """Runs after which a pair at the threshold has met with probability ``recall``.

    Two sets share at least ``t`` of the tokens of the larger one (just so many where it holds
    the other), so at least as many of those that it chooses. What a set chooses at a level is
    the same on all paths of a run, so the levels are three independent draws: where no bucket
    on the way is small, the pair meets when each of them has a shared token.
    """
    met = (1 - exp(-CHOSEN * threshold)) ** DEPTH
    return ceil(log(1 - recall) / log(1 - met))


def _odd(seed: int, number: int) -> np.ndarray:
    """Odd factors, two for each hash function."""
    drawn = np.random.default_rng(seed).integers(0, 2**63, number, dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def _mixed(values: np.ndarray, factors: np.ndarray) -> np.ndarray:
    mixed = values * factors[0]
    mixed ^= mixed >> np.uint64(29)
    return mixed * factors[1]


_ODD = _odd(11, SLOTS + 2)


class Shingler:
    """Sets of hashed runs of words, lower-cased in A-Z."""

    def __init__(self):
        self.words: dict[bytes, int] = {}

    def __call__(self, text: bytes) -> np.ndarray:
        """The sorted distinct shingles; a text of fewer words is one shingle."""
        words = text.lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.words) > MEMO_WORDS:
            self.words.clear()
        known = self.words
        hashes = list(map(known.get, words))
        for i, value in enumerate(hashes):
            if value is None:
                hashes[i] = known[words[i]] = xxhash.xxh3_64_intdigest(words[i])
        hashed = np.array(hashes, np.uint64)
        size = min(WORDS, len(hashed))
        total = np.zeros(len(hashed) - size + 1, np.uint64)
        for k in range(size):
            total += (hashed[k : k + len(total)] ^ (hashed[k : k + len(total)] >> np.uint64(31))) * (
                _WORD_POWERS[k]
            )
        total ^= total >> np.uint64(32)
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(29)
        return np.unique(total)


def node_of(shingles: np.ndarray) -> bytes:
    """The name of a set."""
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def signatures(docs: DataFrame, runs: int) -> DataFrame:
    """(doc_id, said, node, size, sketch, level0..): the tokens chosen per run at each level.

    ``said`` is a hash of the text, which finds a row among those of its doc_id.
    """
    levels = ", ".join(f"level{d} array<array<bigint>>" for d in range(DEPTH))
    nested = pa.list_(pa.list_(pa.int64()))
    factors = _odd(12, 2 * runs * DEPTH)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler()
        for batch in slices(batches):
            sets = [shingler(text) for text in text_bytes(batch.column("text"))]
            sizes = np.array([len(s) for s in sets])
            tokens = np.concatenate(sets)
            filled = np.flatnonzero(sizes)
            starts = (np.cumsum(sizes) - sizes)[filled]
            sketch = np.zeros((len(sets), SLOTS), "<u2")
            if len(filled):
                for slot in range(SLOTS):
                    lowest = np.minimum.reduceat(tokens * _ODD[slot], starts)
                    sketch[filled, slot] = (_mixed(lowest, _ODD[SLOTS:]) >> np.uint64(48)).astype("<u2")
            share = np.minimum(1.0, CHOSEN / np.maximum(sizes, 1))
            below = np.repeat((share * float(2**63)).astype(np.uint64) * np.uint64(2), sizes)
            all_of = np.repeat(share >= 1.0, sizes)
            place = np.repeat(np.arange(len(sets)), sizes)
            chosen = []
            for depth in range(DEPTH):
                per_doc: list[list[list[int]]] = [[] for _ in sets]
                for run in range(runs):
                    kept = (_mixed(tokens, factors[2 * (run * DEPTH + depth) :]) < below) | all_of
                    found = tokens[kept].view(np.int64).tolist()
                    ends = np.searchsorted(place[kept], np.arange(len(sets) + 1)).tolist()
                    for i, own in enumerate(per_doc):
                        own.append(found[ends[i] : ends[i + 1]])
                chosen.append(pa.array(per_doc, nested))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    batch.column("said"),
                    pa.array([node_of(s) for s in sets], pa.binary()),
                    pa.array(sizes, pa.int64()),
                    pa.array([row.tobytes() for row in sketch], pa.binary()),
                    *chosen,
                ],
                names=[
                    "doc_id", "said", "node", "size", "sketch",
                    *[f"level{d}" for d in range(DEPTH)],
                ],
            )

    plain = exact_columns(docs, "doc_id", "text").withColumn("said", F.xxhash64("text"))
    return plain.mapInArrow(
        sign, f"doc_id bigint, said bigint, node binary, size bigint, sketch binary, {levels}"
    )


def _alike(table: pa.Table, rows: np.ndarray, others: np.ndarray | None):
    """Pairs of different groups whose sketches agree nearly as the threshold wants, by tiles."""
    every = rows if others is None else np.concatenate([rows, others])
    groups = table.column("group").take(pa.array(every)).combine_chunks().dictionary_encode()
    if len(groups.dictionary) < 2:
        return every[:0], every[:0]
    group = np.asarray(groups.indices)
    least = (THRESHOLD - SLACK * sqrt(THRESHOLD * (1 - THRESHOLD) / SLOTS)) * SLOTS
    column = table.column("sketch")

    def sketches(places):
        data = b"".join(column[i].as_py() for i in places.tolist())
        return np.frombuffer(data, "<u2").reshape(-1, SLOTS)

    own = sketches(rows)
    theirs = own if others is None else sketches(others)
    their_group = group if others is None else group[len(rows) :]
    found_a, found_b = [], []
    for start in range(0, len(rows), TILE):
        tile = own[start : start + TILE]
        # Among themselves, only rows that come later.
        skipped = start if others is None else 0
        # What is in one group already is not compared again.
        news = group[start : start + len(tile), None] != their_group[None, skipped:]
        if not news.any():
            continue
        agree = news & ((tile[:, None, :] == theirs[None, skipped:, :]).sum(2) >= least)
        if others is None:
            agree = np.triu(agree, 1)
        a, b = np.nonzero(agree)
        found_a.append(a + start)
        found_b.append(b + skipped)
    none = [np.zeros(0, np.int64)]
    a, b = np.concatenate(found_a or none), np.concatenate(found_b or none)
    return rows[a], (rows if others is None else others)[b]


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of the sets share."""
    n = len(sets)
    tokens, places = np.unique(np.concatenate(sets), return_inverse=True)
    owners = np.repeat(np.arange(n), [len(s) for s in sets])
    often = np.bincount(places, minlength=len(tokens))
    shared = np.full((n, n), float((often == n).sum()), np.float64)
    rank = np.full(len(tokens), -1)
    some = np.flatnonzero((often > 1) & (often < n))
    rank[some] = np.arange(len(some))
    column = rank[places]
    used = column >= 0
    column, owners = column[used], owners[used]
    order = np.argsort(column, kind="stable")
    column, owners = column[order], owners[order]
    for start in range(0, len(some), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        held = np.zeros((n, min(4096, len(some) - start)), np.float32)
        held[owners[a:b], column[a:b] - start] = 1
        shared += held @ held.T
    return np.rint(shared).astype(np.int64)


def _similar(threshold: float):
    """Pairs of sets with the threshold's similarity or more, by the sets themselves.

    Rows that repeat a set stand side by side; the first of them counts for all.
    """

    def pairs(table: pa.Table, rows: np.ndarray, others: np.ndarray | None):
        column, names = table.column("shingles"), table.column("node")

        def firsts(places: np.ndarray) -> np.ndarray:
            own = [names[i].as_py() for i in places.tolist()]
            return places[[i == 0 or own[i] != own[i - 1] for i in range(len(own))]]

        rows = firsts(rows)
        every = rows if others is None else np.concatenate([rows, firsts(others)])
        sets = [np.frombuffer(column[i].as_py(), np.uint64) for i in every.tolist()]
        sizes = np.array([len(s) for s in sets])
        shared = intersections(sets)
        union = sizes[:, None] + sizes[None, :] - shared
        close = (shared >= (threshold - 1e-12) * union) & (shared > 0)
        if others is None:
            close = np.triu(close, 1)
        else:
            close[len(rows) :, :] = False
            close[:, : len(rows)] = False
        a, b = np.nonzero(close)
        return every[a], every[b]

    return pairs


def _waves(runs: int) -> list[tuple[int, int]]:
    """The runs from the first on, in waves of 1, 3, 9 ... of them."""
    edges = [0]
    while edges[-1] < runs:
        edges.append(min(runs, 3 * edges[-1] + 1))
    return list(zip(edges[:-1], edges[1:]))


def _candidates(nodes: DataFrame, runs: int, scratch: Scratch) -> DataFrame:
    """(node, component): sets that met in a bucket and look alike, in groups.

    Runs come in waves, and what a wave has found is joined into groups before the next one: a
    bucket all of whose members are in one group already has nothing more to say. So a large group
    of near copies is split and compared in the first run, and hardly again. Of what a bucket finds,
    only which groups it joins is kept. In a bucket too large for one place the members of its
    largest group meet the others only; in the first run, where each set is a group, blocks of such
    buckets are compared by themselves before that.
    """
    found, groups = None, None
    for first, after in _waves(runs):
        # The choices of these runs only.
        own = [
            F.slice(f"level{depth}", first + 1, after - first).alias(f"level{depth}")
            for depth in range(DEPTH)
        ]
        chosen = nodes.select("node", *own)
        if groups is None:
            grouped = chosen.withColumn("group", F.col("node"))
        else:
            grouped = _regrouped(chosen, groups)
        rows = grouped.select(
            "node",
            "group",
            F.posexplode("level0").alias("run", "picks"),
        ).withColumn("path", F.col("run").cast("long") + first)
        met = scratch.write(_met(rows, chosen, scratch), "jaccard-met")
        large = met.where(F.col("members") > COMPARED)
        if groups is None and not large.isEmpty():
            # Each row in one block of its bucket first: what that joins, the blocks need not compare.
            found = _alike_groups(once(met, "path", "members", COMPARED), nodes, scratch)
            groups = components(found, "jaccard-candidates")
            places = of_different_groups(
                _regrouped(large.drop("group", "members"), groups), "path", "group", COMPARED
            )
        else:
            small = once(met.where(F.col("members") <= COMPARED), "path", "members", COMPARED)
            places = small.unionByName(
                of_different_groups(large.drop("members"), "path", "group", COMPARED)
            )
        alike = _alike_groups(places, nodes, scratch)
        scratch.drop(met)
        found = alike if found is None else found.unionByName(alike)
        groups = components(found, "jaccard-candidates")
    return groups


def _regrouped(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of nodes with the ``group`` of each; a node in none is its own."""
    of_node = groups.withColumnRenamed("component", "group")
    return rows.join(of_node, ["node"], "left").withColumn("group", F.coalesce("group", "node"))


def _alike_groups(places: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): groups with members that meet in a place and look alike."""
    compared = in_places(places.join(nodes.select("node", "sketch"), ["node"]), "path")
    alike = joined(compared, "path", "group", _alike)
    return scratch.write(alike.distinct(), "jaccard-alike")


def _met(rows: DataFrame, chosen: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, group, path, members): buckets that need no split, or are at the end of their path.

    ``rows`` are (node, group, run, path, picks): the tokens that a set chose at the first level.

    Sets on one path with equal choices, as near copies mostly have, go on as one bundle: buckets
    are counted by bundles, and only those with members of several groups are gathered.

    A bucket needs no split when it is small, or when one group has most of it and the others are
    few enough for one place. Members of a group choose alike, so its split would give ``CHOSEN``
    buckets with most of the same rows in each, and in the end each pair as often as there are paths.
    """
    ready = None
    for depth in range(DEPTH):
        rows = rows.withColumn("bundle", F.xxhash64("path", "picks"))
        rows = scratch.write(rows, "jaccard-rows")
        of_group = rows.groupBy("bundle", "group").agg(
            F.first("path").alias("path"), F.first("picks").alias("picks"), F.count("*").alias("rows")
        )
        bundles = of_group.groupBy("bundle").agg(
            F.first("path").alias("path"),
            F.first("picks").alias("picks"),
            F.sum("rows").alias("rows"),
            F.min("group").alias("least"),
            F.max("group").alias("most"),
            F.max(F.struct("rows", "group")).alias("top"),
        )
        tokens = bundles.select(
            "bundle", "path", "rows", "least", "most", "top", F.explode("picks").alias("token")
        )
        tokens = tokens.withColumn("path", F.xxhash64("path", "token")).drop("token")
        tokens = scratch.write(tokens, "jaccard-bundles")
        # The largest group of a bucket, by those of its bundles: it has as many rows at least.
        by_top = tokens.groupBy("path", F.col("top.group").alias("group")).agg(
            F.sum("rows").alias("rows"),
            F.sum("top.rows").alias("top"),
            F.min("least").alias("least"),
            F.max("most").alias("most"),
        )
        sizes = by_top.groupBy("path").agg(
            F.sum("rows").alias("members"),
            F.max("top").alias("top"),
            (F.min("least") != F.max("most")).alias("several"),
        )
        rest = F.col("members") - F.col("top")
        sizes = sizes.where("several").select(
            "path",
            "members",
            (
                (F.col("members") <= SMALL) | ((rest <= COMPARED) & (2 * rest <= F.col("members")))
            ).alias("whole"),
        )
        wanted = scratch.write(
            tokens.select("bundle", "path").join(sizes, ["path"]), "jaccard-sizes"
        )
        # Written before, so that the join has shuffles of its own, which can be split where skewed.
        met = rows.select("node", "group", "run", "bundle").join(wanted, ["bundle"]).drop("bundle")
        met = scratch.write(met, "jaccard-buckets")
        scratch.drop(rows, tokens, wanted)
        last = depth == DEPTH - 1
        done = met if last else met.where("whole")
        done = done.select("node", "group", "path", "members")
        ready = done if ready is None else ready.unionByName(done)
        if not last:
            # Only rows of buckets to be split need the next choices.
            level = f"level{depth + 1}"
            rows = met.where("not whole").join(chosen.select("node", level), ["node"])
            rows = rows.select(
                "node", "group", "run", F.col(level)[F.col("run")].alias("picks"), "path"
            )
    return ready


def similar_documents(
    docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL
) -> DataFrame:
    """(doc_id, class_id, n_links, kept, n_shingles, n_same) for each row of ``docs``.

    Documents are linked when the Jaccard similarity of their sets of five-word shingles is at
    least ``threshold``. ``n_links`` is how many other rows a row is linked to, ``class_id`` the
    smallest doc_id that links lead to, ``kept`` whether that is the row's own, ``n_same`` how
    many rows have the same set.

    A text of fewer than five words is one shingle; a null text is empty; rows without words
    have equal (empty) sets and are one class. Rows that repeat a doc_id stay or go together; a
    null doc_id counts as larger than any other. Other columns are ignored; an empty table gives
    none. Texts are compared whole.

    Rows with equal sets are one node, so copies are not compared. Buckets hold names of sets
    only, and are counted before they are gathered, so that a token that a third of all
    documents share is never one task's; a large group is compared by pairs of blocks, and
    gives counts and one link per member instead of pairs.
    """
    scratch = Scratch(docs.sparkSession)
    runs = runs_needed(threshold, recall)
    signed = scratch.write(signatures(docs, runs), "jaccard-signatures")
    levels = [F.first(f"level{d}").alias(f"level{d}") for d in range(DEPTH)]
    nodes = scratch.write(
        signed.groupBy("node").agg(
            F.min("doc_id").alias("first_id"),
            # Of the rows with first_id, null or not, the text that stands for the set.
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "said"))["said"].alias("said"),
            F.count("*").alias("weight"),
            F.first("size").alias("size"),
            F.first("sketch").alias("sketch"),
            *levels,
        ),
        "jaccard-nodes",
    )
    groups = _candidates(nodes, runs, scratch)
    sizes = groups.groupBy("component").agg(F.count("*").alias("members"))
    wanted = (
        groups.join(sizes, ["component"])
        .join(nodes.select("node", "first_id", "said", "weight"), ["node"])
        .select(
            "component", "node", "weight", "members", "said",
            F.coalesce("first_id", F.lit(NO_ID)).alias("_id"),
        )
    )
    plain = exact_columns(docs, "doc_id", "text").select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.xxhash64("text").alias("said"),
        "text",
    )

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, given = Shingler(), set()
        for batch in slices(batches):
            if len(given) > MEMO_SETS:
                given.clear()
            sets, right = [], []
            for text, node in zip(text_bytes(batch.column("text")), batch.column("node").to_pylist()):
                # Equal rows are one set: a task gives it once, its group takes the first.
                own = np.zeros(0, np.uint64) if node in given else shingler(text)
                # Another text with the same doc_id and hash is not the set that is looked for.
                right.append(node not in given and node_of(own) == node)
                sets.append(own)
                if right[-1]:
                    given.add(node)
            shingles = pa.array([s.tobytes() for s in sets], pa.binary())
            kept = batch.select(["component", "node", "weight", "members"])
            yield kept.append_column("shingles", shingles).filter(pa.array(right))

    # The text is part of the key, so null ids meet only their own sets.
    sets = plain.join(wanted, ["_id", "said"]).mapInArrow(
        gather,
        "component binary, node binary, weight bigint, members bigint, shingles binary",
    )
    blocks = in_blocks(sets, "component", "members", BLOCK)
    found = scratch.write(linked(blocks, "component", _similar(threshold)), "jaccard-links")
    return _classes(signed, nodes, found, scratch)


def _classes(
    signed: DataFrame, nodes: DataFrame, found: DataFrame, scratch: Scratch
) -> DataFrame:
    classes = components(found, "jaccard-classes")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        nodes.select("node", "first_id", "weight", "size")
        .join(links, ["node"], "left")
        .join(classes, ["node"], "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    known = scratch.write(known, "jaccard-known")
    lowest = known.groupBy("component").agg(F.min("first_id").alias("class_id"))
    told = known.join(lowest, ["component"]).select(
        "node",
        "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
        F.col("size").alias("n_shingles"),
        F.col("weight").alias("n_same"),
    )
    return signed.select("doc_id", "node").join(told, ["node"]).select(
        "doc_id",
        "class_id",
        "n_links",
        F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"),
        "n_shingles",
        "n_same",
    )


def drop_similar(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one document of each class.

    Rows with one doc_id (null is one as well) stay when any of them does.
    """
    names = docs.columns
    place = names.index("doc_id")
    plain = docs.toDF(*[f"_{i}" for i in range(len(names))])
    kept = similar_documents(docs, threshold).where("kept").select(
        F.col("doc_id").alias("_kept")
    ).distinct()
    stay = plain.join(kept, F.col(f"_{place}").eqNullSafe(F.col("_kept")), "left_semi")
    return stay.toDF(*names)
