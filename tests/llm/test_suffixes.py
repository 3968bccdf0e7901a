"""Removal of repeated passages against plain sets of windows."""

import random
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from dayfold.llm import suffixes
from dayfold.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string"
NEVER = 2**70


def plain(rows, window=50):
    first = {}
    for doc_id, text in rows:
        data = (text or "").encode()
        key = NEVER if doc_id is None else doc_id
        for i in range(len(data) - window + 1):
            w = data[i : i + window]
            first[w] = min(first.get(w, NEVER), key)
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        key = NEVER if doc_id is None else doc_id
        gone = bytearray(len(data))
        for i in range(len(data) - window + 1):
            if first[data[i : i + window]] < key:
                gone[i : i + window] = b"\x01" * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out.append((doc_id, len(data), sum(gone), spans, sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    rows = frame.collect()
    for row in rows:
        if "spans" in row:
            spans = row["spans"]
            assert len(spans) == row["n_spans"]
            assert sum(s["end"] - s["begin"] for s in spans) == row["n_removed"]
            assert all(a["end"] < b["begin"] for a, b in zip(spans, spans[1:]))
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return sorted((tuple(row[n] for n in names) for row in rows), key=repr)


def test_query_equals_plain(spark):
    table = pq.read_table(f"{SF_DIR}/documents.parquet", columns=["doc_id", "text"])
    rows = list(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist()))
    expected = plain(rows)
    assert sum(row[2] > 0 for row in expected) > 50
    assert found(QUERIES["op13_suffix_dedup"](spark, SF_DIR)) == expected


def passages(seed, letters, number):
    """Texts made of shared and own parts, with copies, periods and parts just about a window long."""
    draw = random.Random(seed)

    def own(size):
        return "".join(draw.choices(letters, k=size))

    shared = [own(draw.choice([30, 48, 49, 50, 51, 60, 100, 300])) for _ in range(8)]
    shared += ["ab" * 60, "x" * 130, "é" * 26]
    rows = []
    for _ in range(number):
        parts = []
        for _ in range(draw.randint(0, 5)):
            part = draw.choice(shared)
            if draw.random() < 0.3:
                cut = draw.randint(0, len(part))
                part = part[cut:] or part
            parts += [own(draw.choice([0, 1, 3, 20, 70])), part]
        rows.append([draw.choice([None, *range(-5, 40)]), "".join(parts)])
    rows += [[draw.choice([None, 3, 50]), text] for _, text in rows[:20]]
    return [tuple(row) for row in rows]


@pytest.mark.parametrize("large", [0, 2, suffixes.LARGE])
@pytest.mark.parametrize("letters", ["ab", "abcdefghijklmnop 世é\n"])
def test_random_passages(spark, letters, large):
    rows = passages(large % 7, letters, 60)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(suffixes.remove_repeats(frame, large)) == plain(rows)


def test_edges(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=30_000))
    rows = [
        (1, None), (1, ""), (2, "x" * 49), (3, "x" * 49), (4, "y" * 50), (5, "y" * 50),
        (5, "y" * 50), (6, "z" * 5000), (7, "z" * 4000), (8, long), (9, long[1:]),
        (9, long[:-1]), (10, "é" * 25 + "\x00" * 60), (11, "\x00" * 61 + "é" * 25),
        (None, long), (None, "w" * 100), (None, "w" * 100), (2**63 - 1, "w" * 100),
        (-(2**63), "v" * 70), (2**63 - 1, "v" * 71),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "'q' AS slice", "doc_id", "text", "'clash' AS TEXT", "1 AS hash"
    )
    assert found(suffixes.remove_repeats(frame)) == plain(rows)
    assert found(suffixes.remove_repeats(spark.createDataFrame([], SCHEMA))) == []
    alone = [(1, "only one text, which is as long as some windows are, or longer even")]
    assert found(suffixes.remove_repeats(spark.createDataFrame(alone, SCHEMA))) == plain(alone)


def test_many_rows_share_a_passage(spark):
    common = "This line is in a third of all documents, word for word, every time. "
    draw = random.Random(2)
    rows = []
    for i in range(600):
        own = "".join(draw.choices("abcdefghijklmnop ", k=120))
        rows.append((i, own + common * (i % 3 == 0) + own[::-1]))
    frame = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(suffixes.remove_repeats(frame)) == plain(rows)


def test_pieces_of_a_text(monkeypatch):
    data = np.frombuffer(random.Random(3).randbytes(3000) + b"a" * 300, np.uint8)
    ends = np.array([100, 100, 149, 149, 150, 1700, 3300])

    def windows():
        out = {}
        for text, first, after, anchor, value in zip(*suffixes.anchored(data, ends)):
            for start in range(int(first), int(after)):
                assert start not in out
                assert start <= anchor <= start + 50 - 24
                out[start] = (int(text), int(anchor), int(value))
        return out

    whole = windows()
    expected = [i for i in range(3251) if np.searchsorted(ends, i, "right")
                == np.searchsorted(ends, i + 49, "right")]
    assert sorted(whole) == expected
    monkeypatch.setattr(suffixes, "PIECE", 77)
    assert windows() == whole


def test_suffixes_sort():
    draw = random.Random(4)
    text = bytes(draw.choices(b"ab", k=800)) + b"ab" * 100 + b"a" * 120 + b"a" * 50
    data = np.frombuffer(text, np.uint8)
    starts = np.array(draw.choices(range(len(text) - 50), k=700))
    groups = np.sort(np.array(draw.choices([0, 1, 2, 5], weights=[1, 5, 20, 300], k=700)))
    own = suffixes.Suffixes(data)
    order = own.sort(starts, groups)
    expected = sorted(range(700), key=lambda i: (groups[i], text[starts[i] : starts[i] + 50]))
    assert order.tolist() == expected
    a, b = starts[:-1], starts[1:]
    for x, y, shared in zip(a, b, own.common(a, b)):
        same = [text[x + i] == text[y + i] for i in range(50)]
        assert shared == (same.index(False) if False in same else 50)


def test_colliding_hashes(monkeypatch):
    rows = [b"a" * 10 + b"b" * 50, b"a" * 10 + b"c" * 50, b"c" * 10 + b"b" * 50]
    table = pa.table({
        "hash": pa.array([1, 1, 1], pa.int64()),
        "key": pa.array([1, 2, 3], pa.int64()),
        "bytes": pa.array(rows, pa.binary()),
        "before": pa.array([20, 20, 20], pa.int16()),
        "least": pa.array([5, 4, 3], pa.int64()),
        "often": pa.array([1, 1, 2], pa.int64()),
    })
    expected = suffixes._least_per_window(table).to_pylist()
    assert [row["key"] for row in expected] == [1, 3]
    assert expected[0]["runs"] == [
        {"begin": 0, "end": 10, "least": 5}, {"begin": 10, "end": 11, "least": 3}
    ]
    monkeypatch.setattr(suffixes, "BYTES", np.zeros(256, np.uint64))
    assert suffixes._least_per_window(table).to_pylist() == expected


def test_two_stretches_with_one_key():
    table = pa.table({
        "hash": [1, 1], "key": [2, 2], "bytes": [b"a" * 50, b"b" * 50],
        "before": pa.array([0, 0], pa.int16()), "least": [1, 2], "often": [1, 1],
    })
    with pytest.raises(ArithmeticError):
        suffixes._least_per_window(table)


def test_repeated_hashes_come_as_lists(spark, monkeypatch):
    """Against a plain count; a task gives a row per slice, not one per hash."""
    monkeypatch.setattr(suffixes, "LISTED", 50)
    choose = random.Random(5)
    rows = {(choose.randrange(900), choose.randrange(12)): choose.choice([1, 1, 1, 2]) for _ in range(1500)}
    rows[5000, 3], rows[6000, 40] = 2, 1
    frame = spark.createDataFrame(
        [(*k, v) for k, v in rows.items()], "hash bigint, slice bigint, texts tinyint"
    )
    often = Counter(value for value, _ in rows)
    wanted = {}
    for (value, number), several in rows.items():
        if several > 1 or often[value] > 1:
            wanted.setdefault(number, []).append(value)
    found = suffixes.repeated_hashes(frame)
    assert {r.slice: sorted(r.hashes) for r in found.collect()} == {
        number: sorted(values) for number, values in wanted.items()
    }
    assert suffixes.repeated_hashes(frame.limit(0)).count() == 0
    assert "flatten" in found._jdf.queryExecution().toString()


def test_what_is_dealt_out_are_packs(spark):
    """A row for a slice and bucket, not for a hash or a stretch; against a plain count."""
    rows = passages(6, "abcdefghijklmnop ", 200)
    slices = suffixes.sliced(spark.createDataFrame(rows, SCHEMA).repartition(3)).cache()
    held = {}
    for batch in slices.toArrow().to_batches():
        for number, (data, ends) in zip(batch.column("slice").to_pylist(), suffixes._opened(batch)):
            text, _, _, _, value = suffixes.anchored(data, ends)
            held[number] = {}
            for t, v in zip(text.tolist(), value.tolist()):
                held[number].setdefault(v, set()).add(t)
    packs = suffixes.anchor_hashes(slices, 4)
    found = packs.collect()
    assert len(found) <= 4 * len(held) < sum(map(len, held.values())) / 10
    for row in found:
        hashes = np.frombuffer(row.hashes, "<u8") * suffixes.GATHER
        for value, known in zip(hashes.tolist(), np.frombuffer(row.known, "<u2").tolist()):
            assert known & 1 == (len(held[row["slice"]].pop(value)) > 1)
    assert not any(held.values())
    wanted = suffixes.repeated_hashes(packs).cache()
    dealt = suffixes.stretches(slices, wanted, 4).collect()
    assert len(dealt) <= 5 * len(held) < sum(row["items"] for row in dealt) / 10


def in_one_process(rows, slices, large):
    """``remove_repeats`` without Spark: what is removed of each text."""
    texts = [(text or "").encode() for _, text in rows]
    cut = []
    for i in range(slices):
        held = texts[i::slices]
        data = np.frombuffer(b"".join(held), np.uint8)
        ids = pa.array([doc_id for doc_id, _ in rows[i::slices]], pa.int64())
        cut.append((data, np.cumsum([len(text) for text in held]), ids))
    seen = Counter()
    for data, ends, _ in cut:
        seen.update(set(suffixes.anchored(data, ends)[4].tolist()))
    crowded = np.array([v for v, n in seen.items() if n > large], np.uint64)
    hashes = np.array(list(seen), np.uint64)
    dealt = [suffixes._slice_stretches(i, *x, hashes, crowded, 3) for i, x in enumerate(cut)]
    table = pa.Table.from_batches(dealt)
    buckets = np.asarray(table.column("bucket").fill_null(-1))
    replies = [suffixes._replies(table.filter(pa.array(buckets == b))) for b in set(buckets) - {-1}]
    replies = pa.Table.from_batches([r for r in replies if r is not None])
    gone = [None] * len(rows)
    for i, (data, ends, ids) in enumerate(cut):
        own = replies.filter(pa.array(np.asarray(replies.column("slice")) == i))
        found = suffixes._unpacked(own.column("replies"), "u1").view(suffixes.REPLY)
        last = dealt[i].slice(dealt[i].num_rows - 1)
        places = {n: suffixes._unpacked(last.column(n), k) for n, k in suffixes.PLACES.items()}
        covered = suffixes._covered(len(data), ids, found, places)
        gone[i::slices] = [int(x.sum()) for x in np.split(covered, ends[:-1])]
    return sorted([(d, len(t), g) for (d, _), t, g in zip(rows, texts, gone)], key=repr)


@pytest.mark.parametrize("large", [0, 100])
def test_colliding_words(monkeypatch, large):
    """All anchors and stretches with one hash: only their bytes tell them apart."""
    rows = passages(8, "abc", 40)
    expected = sorted([row[:3] for row in plain(rows)], key=repr)
    assert in_one_process(rows, 3, large) == expected
    monkeypatch.setattr(suffixes, "WORDS", np.zeros_like(suffixes.WORDS))
    assert in_one_process(rows, 3, large) == expected
