"""Groups of candidates compared pair by pair, and the components that links form.

Nodes are named by 16-byte digests, so their order is random.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import group_bounds, whole_groups
from dayfold.sinks.shared import write_aside

# (table, rows, rows): linked pairs between the first and the second rows, or among the first.
Pairs = Callable[[pa.Table, np.ndarray, np.ndarray | None], tuple[np.ndarray, np.ndarray]]

# Names of groups that a task remembers to have joined.
MEMO_NAMES = 500_000

LINKED = pa.schema([("node", pa.binary()), ("links", pa.int64()), ("root", pa.binary())])


def in_blocks(rows: DataFrame, key: str, size: str, limit: int) -> DataFrame:
    """Deal groups out so that any two rows of a group meet once, with about ``2 * limit`` rows.

    ``size`` is a column with the number of rows of the group. A group up to ``limit`` stays
    whole. A larger one is cut into blocks by a hash of the node, and every pair of blocks is a
    group of its own (``lo``, ``hi``), so that no task needs more of it. A row goes to as many
    places as its group has blocks.
    """
    blocks = F.ceil(F.col(size) / F.lit(limit)).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit(limit)), blocks).cast("int")
    dealt = rows.withColumn("block", block).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    places = dealt.withColumn("lo", F.least("block", "_other")).withColumn(
        "hi", F.greatest("block", "_other")
    )
    return in_places(places.drop("_other", size), key)


def in_places(rows: DataFrame, key: str) -> DataFrame:
    """Rows with (key, lo, hi) brought together by these: by hash, as a range would be sampled first.

    A sample computes the rows one more time, with all their joins.
    """
    order = [key, "lo", "hi"]
    return rows.repartition(*order).sortWithinPartitions(*order, "node")


def once(rows: DataFrame, key: str, size: str, limit: int) -> DataFrame:
    """(.., block, lo, hi): each row in one place; a group above ``limit`` in blocks by a hash.

    The blocks of a row differ from group to group, so rows that share several groups meet in some.
    """
    blocks = F.ceil(F.col(size) / F.lit(limit)).cast("int")
    block = F.pmod(F.xxhash64("node", key), blocks).cast("int")
    return rows.withColumns({"block": block, "lo": block, "hi": block}).drop(size)


def of_different_groups(rows: DataFrame, key: str, group: str, limit: int) -> DataFrame:
    """(.., block, lo, hi): any two rows of a ``key`` meet, unless both are of its largest group.

    The largest group is cut into blocks apart from the other rows, and its blocks meet only those
    of the others: where it has nearly all rows of a key, a row of it goes to one place, however
    large it is. A ``key`` with one group only has nothing to compare, and is left out.
    """
    sizes = rows.groupBy(key, group).agg(F.count("*").alias("_rows"))
    largest = sizes.groupBy(key).agg(
        F.max(F.struct("_rows", F.col(group).alias("_group"))).alias("_top"),
        F.sum("_rows").alias("_all"),
        F.count("*").alias("_groups"),
    )
    told = rows.join(largest.where(F.col("_groups") > 1), [key])
    rest = F.ceil((F.col("_all") - F.col("_top._rows")) / F.lit(limit)).cast("int")
    top = F.ceil(F.col("_top._rows") / F.lit(limit)).cast("int")
    inside = F.col(group) == F.col("_top._group")
    value = F.xxhash64("node", F.lit(limit))
    block = F.when(inside, rest + F.pmod(value, top)).otherwise(F.pmod(value, rest)).cast("int")
    last = F.when(inside, rest).otherwise(rest + top) - 1
    dealt = told.withColumn("block", block).withColumn(
        "_other", F.explode(F.sequence(F.lit(0), last))
    )
    return dealt.select(
        *rows.columns,
        "block",
        F.least("block", "_other").alias("lo"),
        F.greatest("block", "_other").alias("hi"),
    )


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the first row that it reaches by the pairs (a, b)."""
    roots = np.arange(n)
    while True:
        low = np.minimum(roots[a], roots[b])
        new = roots.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, roots[a], low)
        np.minimum.at(new, roots[b], low)
        new = new[new]
        if (new == roots).all():
            return roots
        roots = new


def _found(table: pa.Table, order: list[str], pairs: Pairs) -> Iterator[tuple]:
    """(start, end, a, b) of each place of the table with linked pairs, which count from start."""
    lo, hi = np.asarray(table.column("lo")), np.asarray(table.column("hi"))
    block = np.asarray(table.column("block"))
    for start, end in group_bounds(table, order):
        if end - start < 2:
            continue
        rows = np.arange(start, end)
        if lo[start] == hi[start]:
            a, b = pairs(table, rows, None)
        else:
            own = block[start:end] == lo[start]
            if own.all() or not own.any():
                continue
            a, b = pairs(table, rows[own], rows[~own])
        if len(a):
            yield start, end, a - start, b - start


def linked(blocks: DataFrame, key: str, pairs: Pairs) -> DataFrame:
    """(node, links, root) from groups dealt out by ``in_blocks``.

    A node has a row for each place where it is linked: ``links`` is the sum of the weights
    (column ``weight``) of the nodes it is linked to there, ``root`` the first node that it
    reaches there. So no pair is ever a row.
    """
    order = [key, "lo", "hi"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, order):
            table = table.combine_chunks()
            weight = np.asarray(table.column("weight"))
            nodes, links, roots = [], [], []
            names = table.column("node").to_pylist()
            for start, end, a, b in _found(table, order, pairs):
                found = np.zeros(end - start, np.int64)
                np.add.at(found, a, weight[start + b])
                np.add.at(found, b, weight[start + a])
                reach = local_roots(end - start, a, b)
                for i in np.flatnonzero(found).tolist():
                    nodes.append(names[start + i])
                    links.append(int(found[i]))
                    roots.append(names[start + int(reach[i])])
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip((nodes, links, roots), LINKED)], schema=LINKED
            )

    return blocks.mapInArrow(compare, "node binary, links bigint, root binary")


def joined(places: DataFrame, key: str, group: str, pairs: Pairs) -> DataFrame:
    """(node, root): groups that linked pairs join, by the name of another group that they reach.

    A place gives one row less than the groups that it joins, whatever the number of their members
    and of the pairs; a task leaves out what follows from rows that it has given.
    """
    order = [key, "lo", "hi"]

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, bytes] = {}

        def top(name: bytes) -> bytes:
            while (above := known.get(name, name)) != name:
                known[name] = known.get(above, above)
                name = above
            return name

        for table in whole_groups(batches, order):
            table = table.combine_chunks()
            nodes, roots = [], []
            for start, end, a, b in _found(table, order, pairs):
                names = table.column(group).slice(start, end - start).combine_chunks()
                names = names.dictionary_encode()
                number, names = np.asarray(names.indices), names.dictionary.to_pylist()
                reach = local_roots(len(names), number[a], number[b])
                for i in np.flatnonzero(reach != np.arange(len(names))).tolist():
                    one, other = top(names[i]), top(names[int(reach[i])])
                    if one != other:
                        known[one] = other
                        nodes.append(one)
                        roots.append(other)
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.binary()), pa.array(roots, pa.binary())], names=["node", "root"]
            )
            if len(known) > MEMO_NAMES:
                known.clear()

    return places.mapInArrow(compare, "node binary, root binary")


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, component) of all nodes of ``edges`` (node, root) that have an edge to another.

    Each round maps every node to the smallest of itself and its neighbours and puts the edges
    between what the nodes are mapped to; it ends when no edge is left. The names of nodes are
    digests, so the chains of ever smaller neighbours are short, whatever the shape of the
    graph. A hub is one row per task in the minimum, and its joins are ones that adaptive
    execution splits.
    """
    left = edges.where(F.col("node") != F.col("root")).select(
        F.greatest("node", "root").alias("a"), F.least("node", "root").alias("b")
    )
    left = write_aside(left.distinct(), f"{name}-edges")
    result = None
    while result is None or not left.isEmpty():
        both = left.union(left.select("b", "a"))
        lowest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("_low"))
        labels = write_aside(
            lowest.select("node", F.least("node", "_low").alias("label")), f"{name}-labels"
        )
        if result is None:
            result = labels.withColumnRenamed("label", "component")
        else:
            onward = labels.withColumnRenamed("node", "component")
            result = result.join(onward, ["component"], "left").select(
                "node", F.coalesce("label", "component").alias("component")
            )
        moved = left.join(labels.select(F.col("node").alias("a"), F.col("label").alias("_a")), ["a"])
        moved = moved.join(labels.select(F.col("node").alias("b"), F.col("label").alias("_b")), ["b"])
        moved = moved.where(F.col("_a") != F.col("_b")).select(
            F.greatest("_a", "_b").alias("a"), F.least("_a", "_b").alias("b")
        )
        left = write_aside(moved.distinct(), f"{name}-edges")
    return write_aside(result, f"{name}-components")
