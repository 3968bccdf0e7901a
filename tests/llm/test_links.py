"""How buckets of candidates are dealt out and what they give: in proportion to their members."""

from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

from dayfold.llm import links


def rows_of(spark, large, others):
    """One bucket: a group of ``large`` nodes and ``others`` nodes on their own."""
    rows = spark.range(large + others).select(
        F.unhex(F.md5(F.col("id").cast("string"))).alias("node"),
        F.when(F.col("id") < large, F.lit(b"top")).otherwise(F.encode(F.col("id").cast("string"), "UTF-8")).alias("group"),
        F.lit(7).cast("long").alias("path"),
    )
    return rows


def test_a_row_of_a_large_group_goes_to_few_places(spark):
    rows = rows_of(spark, 400, 7)
    dealt = links.of_different_groups(rows, "path", "group", 20).collect()
    assert Counter(r.group == b"top" for r in dealt)[True] == 400
    places = defaultdict(list)
    for row in dealt:
        places[row.lo, row.hi].append(row)
    met = Counter()
    for (lo, hi), own in places.items():
        assert len(own) <= 2 * 40
        for a, b in combinations(own, 2):
            if lo == hi or a.block != b.block:
                met[frozenset((a.node, b.node))] += 1
    group = {r.node: r.group for r in dealt}
    wanted = {frozenset(p) for p in combinations(group, 2) if group[p[0]] != group[p[1]]}
    assert {pair for pair in met if len({group[n] for n in pair}) > 1} == wanted
    assert set(met.values()) == {1} and not any(
        all(group[n] == b"top" for n in pair) for pair in met
    )
    assert links.of_different_groups(rows_of(spark, 50, 0), "path", "group", 20).count() == 0


def test_a_place_gives_a_row_less_than_the_groups_it_joins(spark):
    rows = rows_of(spark, 300, 5)
    places = links.in_places(links.of_different_groups(rows, "path", "group", 20), "path")

    def all_pairs(table, own, others):
        groups = table.column("group")
        pairs = combinations(own, 2) if others is None else ((a, b) for a in own for b in others)
        kept = [(a, b) for a, b in pairs if groups[int(a)] != groups[int(b)]]
        return tuple(np.array(kept, np.int64).reshape(-1, 2).T)

    found = links.joined(places, "path", "group", all_pairs).collect()
    # Six groups, in any number of places and tasks; 1,500 pairs of nodes are linked.
    assert 5 <= len(found) <= 5 * 17
    merged = {r.node: r.root for r in found}
    assert len(set(merged) | set(merged.values())) == 6
