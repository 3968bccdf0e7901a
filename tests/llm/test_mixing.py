"""The mix against a plain mixer: targets, copies, positions, and groups of copies that are cut."""

import math
from collections import Counter, defaultdict

import numpy as np
import pandas as pd

from dayfold.llm import mixing

KINDS = "doc_id bigint, text string, source string, extra int"


def plain_mix(rows):
    """(doc_id, source) to sorted (copies, positions), by going through each source's documents."""
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    names = sorted((n for n in sizes if n is not None), key=lambda n: n.encode())
    names += [None] if None in sizes else []
    weights = [mixing.WEIGHTS[i % 3] for i in range(len(names))]
    aims = mixing.targets([sizes[n] for n in names], weights, 1.5 * sum(sizes.values()), 2.0)
    mean = sum(a * w for a, w in zip(aims, weights)) / (sum(aims) or 1)
    spread = max(abs(w - mean) for w in weights) or 1.0
    found = defaultdict(list)
    for name, aim, weight in zip(names, aims, weights):
        own = [r for r in rows if r[2] == name]
        own.sort(key=lambda r: mixing._key(r[0], r[2], (r[1] or "").encode()))
        tilt, before = -mixing.TILT * (weight - mean) / spread, 0
        for doc_id, text, _ in own:
            size = len((text or "").encode().split())
            at, middle = [], before + size / 2
            # Round after round through the source, as long as the middle of the document counts.
            while size and len(at) * sizes[name] + middle < aim:
                given = (len(at) * sizes[name] + middle) / aim
                at.append(float(mixing.times(np.array(given), np.array(tilt))))
            before += size
            found[(doc_id, name)].append((len(at), aim, at))
    return found


def compare(spark, rows):
    docs = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)], KINDS).repartition(3)
    wanted, found = plain_mix(rows), defaultdict(list)
    for row in mixing.mix(docs).collect():
        assert row.taken == row.size * row.copies and row.copies == len(row.positions)
        found[(row.doc_id, row.source)].append((row.copies, row.target, row.positions))
    assert found.keys() == wanted.keys()
    for key, plain in wanted.items():
        for own, other in zip(sorted(found[key], key=str), sorted(plain, key=str), strict=True):
            assert own[0] == other[0] and math.isclose(own[1], other[1], abs_tol=1e-9)
        at = [sorted(p for own in side for p in own[2]) for side in (found[key], plain)]
        assert np.allclose(*at)
    return docs, found


def test_against_a_plain_mixer(spark):
    table = pd.read_parquet("/root/testdata/sf0.001/documents.parquet")
    rows = list(table[["doc_id", "text", "source"]].itertuples(index=False, name=None))
    rows += [(None, "a b c", None), (None, None, None), (7, " \t", "web"), rows[0], rows[0]]
    compare(spark, rows)


def test_many_sources(spark):
    """Sources that are all limited, in several rounds, and not on the driver."""
    rows = [(i, "w " * (1 + i * i % 97), f"s{i % 60}") for i in range(240)]
    rows += [(1000 + i, "v " * 50, "big") for i in range(80)]
    compare(spark, rows)


def test_copies_are_cut_inside_their_group(spark):
    rows = [(1, "one two three " * 2 + "x", "a")] * 300 + [(2, "y " * 4000, "b")]
    docs, found = compare(spark, rows)
    copies = Counter(own[0] for own in found[(1, "a")])
    taken = 7 * sum(n * times for n, times in copies.items())
    assert abs(taken - found[(1, "a")][0][1]) <= 3.5
    ordered = mixing.training_order(docs)
    out = Counter(row.extra for row in ordered.collect())
    assert ordered.columns == docs.columns
    # Each input row is there as often as one place of its group is taken.
    assert Counter(out[i] for i in range(300)) == copies and out[300] == found[(2, "b")][0][0]


def test_training_order_is_sorted_by_position(spark):
    rows = [(i, f"t{i} " * (1 + i % 9), "ab"[i % 2]) for i in range(60)] + [(3, "t3 " * 4, "b")]
    docs, found = compare(spark, rows)
    at = sorted((p, key[0]) for key, own in found.items() for o in own for p in o[2])
    assert [row.doc_id for row in mixing.training_order(docs).collect()] == [d for _, d in at]
