"""Spelling variants against plain loops over all words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.parquet as pq
import pytest

from dayfold.llm import spelling
from dayfold.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string"
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                i = h % len(run)
                run = run[:i] + run[i + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_near(words):
    """All pairs one edit apart, by what is left when a letter is deleted, and a distance."""

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            old, row[0] = row[0], i + 1
            for j, y in enumerate(b):
                old, row[j + 1] = row[j + 1], min(old + (x != y), row[j] + 1, row[j + 1] + 1)
        return row[-1]

    groups = defaultdict(set)
    for word in words:
        for left in {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}:
            groups[left].add(word)
    near = defaultdict(set)
    for group in groups.values():
        for a in group:
            for b in group:
                if a < b and b not in near[a] and distance(a, b) == 1:
                    near[a].add(b)
                    near[b].add(a)
    return near


def plain(rows):
    words = plain_words(rows)
    near = plain_near(words)
    forms = {}
    for word, n in words.items():
        best = min(near[word], key=lambda w: (-words[w], w), default=None)
        forms[word] = best if best is not None and words[best] >= 10 * n else None
    out = {}
    for word, form in forms.items():
        root = word
        while forms[root] is not None:
            root = forms[root]
        out[word] = (form, root, words[word], len(near[word]), words[form] if form else None)
    return out


def found(frame):
    rows = frame.collect()
    out = {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}
    assert len(out) == len(rows)
    return out


def test_query_equals_plain(spark):
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()))
    expected = plain(rows)
    assert found(QUERIES["op11_spelling_variants"](spark, SF_DIR)) == expected
    assert sum(v[0] is not None for v in expected.values()) > 10
    assert sum(v[3] > 0 for v in expected.values()) > 100


@pytest.mark.parametrize("large", [0, 3, spelling.LARGE])
@pytest.mark.parametrize("letters", ["ab", "abcé", "abcdefghijÉÿ"])
def test_random_words(spark, letters, large):
    draw = random.Random(len(letters) + large)
    words = {"".join(draw.choices(letters, k=draw.randint(7, 9))) for _ in range(150)}
    for word in list(words):  # variants, and chains of them
        i = draw.randrange(len(word))
        words.add(word[:i] + draw.choice(letters) + word[i:])
        words.add(word[:i] + draw.choice(letters) + word[i + 1 :])
    rows = []
    for i, word in enumerate(sorted(words)):
        times = draw.choice([1, 2, 3, 30, 400, 5000])
        rows.append((i, " ".join([word] * times)))
    assert found(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA), large)) == plain(
        rows
    )


def test_crowded_words(spark):
    # A third of all words begin alike, and the rest differ in their middle.
    draw = random.Random(5)
    tail = "".join
    words = {"qxqxqxqx" + tail(draw.choices("abcdefgh", k=3)) for _ in range(400)}
    words |= {"zj" + tail(draw.choices("abc", k=5)) + "jzjz" for _ in range(200)}
    words |= {tail(draw.choices("klmnop", k=8)) for _ in range(400)}
    rows = [(None, f"{word} {word}") for word in sorted(words)]
    for large in (10, spelling.LARGE):
        assert found(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA), large)) == (
            plain(rows)
        )


def test_edges(spark):
    rows = [
        (None, "Absolute absolute ABSOLUTE"), (1, None), (1, ""), (2, "shorter short"),
        (2, "shorter short"), (3, "x" * 5000), (3, "x" * 5000), (4, "x" * 4999 + " " + "x" * 4999),
        (5, "naïvetés,naïvetés;ÉCOLESÉCOLES ÉcolesÉcoles"),
        (6, "aaaaaaa aaaaaaa aaaaaaaa aaaaaaaa baaaaaa baaaaaa"), (6, "one\x00twothree " * 2),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "'z' AS word", "doc_id", "text", "'clash' AS TEXT", "1 AS n"
    )
    assert found(spelling.spelling_variants(frame)) == plain(rows)
    for nothing in ([], [(1, None)], [(1, "a few tiny words")], [(1, "singular")]):
        assert found(spelling.spelling_variants(spark.createDataFrame(nothing, SCHEMA))) == {}


def test_pivots_are_disjoint_and_lightest():
    draw = random.Random(6)
    for _ in range(300):
        word = "".join(draw.choices("abcde", k=draw.randint(7, 12)))
        ranks = {}
        for gram in {word[i : i + 2] for i in range(len(word) - 1)}:
            ranks[gram] = (len(ranks), draw.randint(1, 9))
        prefix = spelling.prefix_of(word, ranks)
        weight = {place: often for place, _, often in prefix}
        a, b = spelling.pivots_of(prefix)
        assert b - a >= 2
        least = min(weight[p] + weight[q] for p in weight for q in weight if q - p >= 2)
        assert weight[a] + weight[b] == least


def test_one_edit():
    yes = [("abcdefg", "abcdef"), ("abcdefg", "xabcdefg"), ("abcdefg", "abxdefg"), ("aa", "aaa")]
    no = [("abcdefg", "abcdefg"), ("abcdefg", "bacdefg"), ("abcdefg", "abcde"), ("ab", "ba")]
    for a, b in yes:
        assert spelling.one_edit(a, b) and spelling.one_edit(b, a)
    for a, b in no:
        assert not spelling.one_edit(a, b) and not spelling.one_edit(b, a)
