"""Which buckets of the chosen-path join are split: not those that one group has most of."""

from collections import Counter, defaultdict
from itertools import combinations

from pyspark.sql import functions as F

from dayfold.llm import jaccard
from dayfold.llm.common import Scratch


def met_of(spark, large, others):
    """What one run gives for a group of ``large`` sets and ``others`` alone that all choose alike."""
    name = F.unhex(F.md5(F.col("id").cast("string")))
    chosen = spark.range(large + others).select(
        "id",
        name.alias("node"),
        F.when(F.col("id") < large, F.lit(b"top")).otherwise(name).alias("group"),
        *[
            F.array(F.array(F.lit(10 * d + 1).cast("long"), F.lit(10 * d + 2).cast("long"))).alias(f"level{d}")
            for d in range(jaccard.DEPTH)
        ],
    )
    rows = chosen.select("node", "group", F.posexplode("level0").alias("run", "picks")).withColumn(
        "path", F.col("run").cast("long")
    )
    return jaccard._met(rows, chosen, Scratch(spark)).collect()


def test_a_bucket_of_one_group_and_few_others_is_not_split(spark):
    met = met_of(spark, 150, 30)
    # Two tokens chosen, so two buckets; split on, each set would be in two to the depth of them.
    assert set(Counter(bytes(r.node) for r in met).values()) == {2}
    assert {r.members for r in met} == {180}
    buckets = defaultdict(set)
    for row in met:
        buckets[row.path].add((bytes(row.node), bytes(row.group)))
    together = {frozenset(p) for own in buckets.values() for p in combinations(own, 2)}
    assert len(together) == 180 * 179 // 2


def test_rows_of_buckets_grow_with_a_group_and_no_faster(spark):
    assert [len(met_of(spark, large, 30)) for large in (150, 300, 600)] == [360, 660, 1260]


def test_a_large_bucket_of_different_groups_is_split(spark):
    met = met_of(spark, 1, 179)
    assert set(Counter(bytes(r.node) for r in met).values()) == {2**jaccard.DEPTH}


def test_others_too_many_for_one_place_are_split(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "COMPARED", 29)
    met = met_of(spark, 150, 30)
    assert set(Counter(bytes(r.node) for r in met).values()) == {2**jaccard.DEPTH}
