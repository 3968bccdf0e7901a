"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import numpy as np
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dayfold.llm import (
    byte_bpe,
    chat,
    common,
    embeddings,
    exact_dedup,
    jaccard,
    links,
    lm_score,
    mixing,
    quality,
    secrets,
    token_output,
)
from dayfold.llm.common import sized_slices

KINDS = "doc_id bigint, text string, source string, TEXT string, _row int, part int, node string"
LONG = "word another third " * 20_000


def docs_of(spark, rows):
    """Documents (doc_id, text, source), with columns that have the names of inner ones."""
    return spark.createDataFrame([(*row, "x", 1, 2, "n") for row in rows], KINDS)


@pytest.fixture(scope="module")
def awkward(spark):
    rows = [
        (1, None, "a"), (2, "", None), (3, " \t\n", "a"), (4, "Same words stay here now ok", "a"),
        (5, "same Words stay here now ok", "b"), (5, "same Words stay here now ok", "b"),
        (None, "lone", "b"), (None, None, None), (6, LONG, "a"), (7, LONG, "b"),
    ]
    return docs_of(spark, rows)


@pytest.fixture(scope="module")
def nothing(spark):
    return docs_of(spark, [])


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_token_output_edges(spark, awkward, nothing):
    written, ids = token_output.write_tokens(awkward)
    rows = token_output.read_tokens(written, ids).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None, None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert rows[2].ids == np.array([1], "<u4").tobytes()
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:i]) for i in range(10)]
    assert rows[8].n_tokens == 60_001
    assert token_output.token_digests(*token_output.write_tokens(nothing)).count() == 0


PIECES = ["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "<|end", "|>", " ", "a", "'s", "\u0301"]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_added_tokens_equal_a_fresh_library(text):
    fresh = Tokenizer.from_file(token_output.TOKENIZER).encode(text, add_special_tokens=False).ids
    found, _ = token_output.loaded(token_output.TOKENIZER).encode(pa.array([text], pa.string()))
    assert found.tolist() == fresh


def test_token_files_alone(spark, awkward, tmp_path):
    docs = docs_of(spark, [(i, f"hello <|endoftext|> number {i}", "a") for i in range(50)])
    for name, frame in {"full": docs, "awkward": awkward, "empty": docs.limit(0)}.items():
        folder = str(tmp_path / name)
        kept = rows_of(token_output.read_tokens(*token_output.write_tokens(frame, folder=folder)))
        assert rows_of(token_output.read_tokens(*token_output.open_tokens(spark, folder))) == kept
        if name == "full":
            assert [list(np.frombuffer(r[3], "<u4")[:2]) for r in kept] == [[3306, 49407]] * 50
            assert sorted(r[1] for r in kept) == [sum(r[2] for r in kept if r[0] < i) for i in range(50)]


@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=9), max_size=6))
def test_packing(sequences):
    sizes = np.array([len(s) for s in sequences], np.int64)
    values = np.array([v for s in sequences for v in s], "<u4")
    control, data = token_output.pack(values, sizes)
    joined = [np.frombuffer(b"".join(x), np.uint8) for x in (control, data)]
    assert token_output.unpack(*joined, sizes).tolist() == values.tolist()
    assert [len(c) for c in control] == [-(-n // 4) for n in sizes.tolist()]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_encoders_equal_the_libraries(text):
    words = token_output.loaded(token_output.TOKENIZER)
    clean = text.encode("utf-8", "replace").decode()
    found, ends = words.encode(pa.array(["", clean, None, clean], pa.string()))
    each = [found[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
    assert each == [b"", words.encode_all(clean), b"", words.encode_all(clean)]
    bpe = byte_bpe.loaded(byte_bpe.RANKS)
    plain = tiktoken.Encoding(
        "own", pat_str=byte_bpe.public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks,
        special_tokens={},
    )
    ids = np.frombuffer(bpe.encode(text.encode("utf-8", "replace").decode()), "<u4").tolist()
    assert ids == plain.encode_ordinary(text.encode("utf-8", "replace").decode())
    assert bpe.decode(ids).decode() == text.encode("utf-8", "replace").decode()


def test_slices_by_size():
    texts = ["a" * 5, None, "", "b" * 9, "c" * 2, "d" * 2]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    cut = [b.column(0).to_pylist() for b in sized_slices([batch, batch.slice(0, 0)], "text", 4)]
    assert cut == [["a" * 5], [None, ""], ["b" * 9], ["c" * 2, "d" * 2]]


def test_byte_bpe_edges(awkward, nothing):
    encoded = byte_bpe.encode_documents(awkward)
    decoded = {(r.doc_id, bytes(r.content)) for r in byte_bpe.decode_documents(encoded).collect()}
    assert (6, LONG.encode()) in decoded and (1, b"") in decoded and (None, b"lone") in decoded
    assert byte_bpe.round_trip(nothing).count() == 0


def test_exact_dedup_edges(awkward, nothing):
    rows = rows_of(
        exact_dedup.exact_duplicates(awkward).select("doc_id", "keep_id", "group_size", "kept")
    )
    assert (1, 2, 3, False) in rows and (2, 2, 3, True) in rows and (None, 2, 3, False) in rows
    assert (4, 5, 3, False) in rows and rows.count((5, 5, 3, True)) == 2
    assert (None, None, 1, True) in rows and (6, 7, 2, False) in rows
    kept = exact_dedup.drop_duplicates(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(str(r[0]) for r in kept.collect())
    assert ids == ["2", "3", "5", "7", "None"]
    assert exact_dedup.exact_duplicates(nothing).count() == 0
    assert exact_dedup.drop_duplicates(nothing).count() == 0


def test_jaccard_edges(spark, awkward, nothing):
    base = " ".join(f"w{i}" for i in range(60))
    near, far = base + " tail", " ".join(f"w{i}" for i in range(0, 60, 2))
    more = docs_of(spark, [(20, base, "a"), (21, near, "a"), (22, far, "a"), (19, near, "b")])
    rows = rows_of(
        jaccard.similar_documents(awkward.union(more)).select("doc_id", "class_id", "n_links")
    )
    assert (20, 19, 2) in rows and (21, 19, 2) in rows and (19, 19, 2) in rows
    assert (22, 22, 0) in rows and (1, 1, 3) in rows and (None, 1, 3) in rows
    assert (5, 4, 2) in rows and (7, 6, 1) in rows and (None, None, 0) in rows
    kept = jaccard.drop_similar(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r[0]) for r in kept.collect()) == ["1", "4", "6", "None", "None"]
    assert jaccard.similar_documents(nothing).count() == 0


def test_jaccard_large_groups(spark):
    """More near copies than a block holds, and a token that all documents share."""
    words = [f"v{i}" for i in range(80)]
    near = [(i, " ".join([*words, f"end{i}"]), "a") for i in range(230)]
    shared = "one two three four five"
    apart = [
        (1000 + i, shared + " " + " ".join(f"z{i}_{j}" for j in range(30)), "a") for i in range(150)
    ]
    found = jaccard.similar_documents(docs_of(spark, near + apart)).toPandas()
    close = found[found.doc_id < 1000]
    assert (close.n_links == 229).all() and (close.class_id == 0).all()
    assert (found[found.doc_id >= 1000].n_links == 0).all()


def test_jaccard_recall_in_large_buckets(spark, monkeypatch):
    """Pairs at the threshold, one inside the other, whose buckets are all split to the end."""
    monkeypatch.setattr(jaccard, "SMALL", 1)
    pairs, rows = 2000, []
    for i in range(pairs):
        words = [f"t{i}_{j}" for j in range(24)]
        rows += [(2 * i, " ".join(words[:20]), "a"), (2 * i + 1, " ".join(words), "a")]
    found = jaccard.similar_documents(docs_of(spark, rows)).toPandas()
    assert set(found.n_shingles) == {16, 20} and set(found.n_links) <= {0, 1}
    assert (found.n_links == 0).sum() / 2 <= (1 - jaccard.RECALL) * pairs


@pytest.mark.parametrize("doc_id", [3, None])
def test_jaccard_repeated_rows(spark, doc_id):
    """Equal rows are as many links for their neighbours as they are, with an id or without."""
    base = " ".join(f"r{i}" for i in range(60))
    rows = [(doc_id, base, "a"), (doc_id, base, "a"), (doc_id and 4, base + " tail", "a")]
    rows += [(doc_id, "other words that are alone here", "a"), (5, base + " end", "a")]
    found = jaccard.similar_documents(docs_of(spark, rows)).select("n_same", "n_links", "class_id")
    least = doc_id or 5
    alone = (1, 0, doc_id)
    assert rows_of(found) == sorted(
        [(2, 3, least), (2, 3, least), (1, 3, least), (1, 3, least), alone], key=repr
    )


def test_jaccard_null_ids(spark):
    """Sets without an id are compared once each."""
    base = " ".join(f"q{i}" for i in range(60))
    rows = [(None, f"{base} end{i}", "a") for i in range(120) for _ in range(2)]
    found = jaccard.similar_documents(docs_of(spark, rows)).toPandas()
    assert (found.n_links == 239).all() and (found.n_same == 2).all()


def test_jaccard_runs_have_hashes(spark):
    """A lower threshold needs more runs, and has them."""
    assert jaccard.runs_needed(0.5) > 22
    docs = docs_of(spark, [(1, "a b c d e f", "a"), (2, "a b c d e f g", "a")])
    assert {r.n_links for r in jaccard.similar_documents(docs, 0.5).collect()} == {1}


def test_components(spark):
    """A long path and a hub become one component each."""
    name = lambda i: (i * 2654435761 % 2**32).to_bytes(16, "big")
    path = [(name(i), name(i + 1)) for i in range(200)]
    hub = [(name(1000), name(1001 + i)) for i in range(300)]
    edges = spark.createDataFrame(path + hub, "node binary, root binary")
    found = {bytes(r[0]): bytes(r[1]) for r in links.components(edges, "test").collect()}
    assert len(found) == 201 + 301 and len(set(found.values())) == 2
    assert found[name(0)] == min(name(i) for i in range(201))
    empty = spark.createDataFrame([], "node binary, root binary")
    assert links.components(empty, "test").count() == 0


def test_mixing_edges(awkward, nothing):
    rows = rows_of(mixing.mix(awkward).select("doc_id", "source", "size", "taken", "source_size"))
    assert (1, "a", 0, 0, 60_006) in rows and (None, None, 0, 0, 0) in rows
    assert rows.count((5, "b", 6, 12, 60_013)) + rows.count((5, "b", 6, 6, 60_013)) == 2
    ordered = mixing.training_order(awkward)
    assert ordered.columns == awkward.columns
    assert mixing.mix(nothing).count() == 0 and mixing.training_order(nothing).count() == 0


def test_targets():
    found = mixing.targets([100, 1000, 10, 0], [5, 2, 1, 5], 1665, 2.0)
    assert found[0] == 200 and found[2] == 20 and found[3] == 0
    assert sum(found) == pytest.approx(1665)
    assert mixing.targets([], [], 0, 2.0) == []


def test_schedule_is_inverted():
    for tilt in (-0.5, 0.0, 0.5, 1.0):
        t = np.linspace(0, 1, 11)
        demand = (1 - tilt) * t + tilt * t * t
        assert np.allclose(mixing.times(demand, np.full(11, tilt)), t)


def test_secret_edges(spark, awkward, nothing):
    model = secrets.train(nothing)
    assert secrets.scan(nothing, model).count() == 0
    assert all(r.spans == "" for r in secrets.scan(awkward, model).collect())
    random_key = "kJ8dQz4Xw1Rt7LmP0sVb3NcY"
    text = f"é {random_key} getUserNameFromConfig theanthtionblethtionblethat"
    (row,) = secrets.scan(docs_of(spark, [(1, text, "a")]), model).collect()
    assert row.spans == f"markov:2:{2 + len(random_key)}"
    (row,) = secrets.scan(docs_of(spark, [(1, "é TOKEN: abc-12345678901", "a")]), model).collect()
    assert row.spans == "assign:2:24" and row.n_assign == 1


def test_short_secrets_and_parts_of_runs(spark, nothing):
    # Without a corpus the model knows ordinary text from few samples, and short keys are unsure.
    corpus = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    letters = secrets.string.ascii_letters + secrets.string.digits
    for docs, least in ((corpus, {12: 0.95, 16: 0.98, 24: 0.99}), (nothing, {16: 0.85, 24: 0.95})):
        model, choose = secrets.train(docs), random.Random(11)
        for size, share in least.items():
            keys = ["".join(choose.choices(letters, k=size)).encode() for _ in range(300)]
            whole = [secrets.Span("markov", 2, 2 + size)]
            assert sum(model.spans(b"a " + k + b".") == whole for k in keys) >= share * 300
    left, right = b"kJ8dQz4Xw1Rt7LmP", b"Zt5GhW2vNq9XyUc4"
    spans = model.spans(left + b"-0123456789abcdef0-" + right)
    assert [(s.kind, s.start) for s in spans] == [("markov", 0), ("hex", 17), ("markov", 34)]
    parts = secrets.outside(0, 40, [(3, 5), (4, 9), (20, 30), (25, 28), (39, 50), (60, 70)])
    assert list(parts) == [(0, 3), (9, 20), (30, 39)]
    words = b"get_user_name configuration responsibility internationally /usr/local/share RequestHandler"
    assert model.spans(words) == []


def test_lm_edges(awkward, nothing):
    rows = rows_of(lm_score.score_documents(awkward).select("doc_id", "n_tokens", "train_tokens"))
    assert len(rows) == 10 and (1, 1, rows[0][2]) in rows and (6, 60_001, rows[0][2]) in rows
    assert lm_score.score_documents(nothing).count() == 0


def test_lattice_sums_all_segmentations():
    pieces = lm_score.load_pieces()
    rng = np.random.default_rng(0)
    scores = np.log(rng.dirichlet(np.ones(pieces.number)))
    model = lm_score.SubwordModel(pieces, scores, 0.5, 0, 0)
    place = {
        int(h): int(p) for hs, ps in zip(pieces.hashes, pieces.places) for h, p in zip(hs, ps)
    }

    def brute(text):
        """Over all cuts, by the first piece."""
        if not text:
            return 1.0
        total = 0.0
        for size in range(1, len(text) + 1):
            hashed = 0
            for c in text[:size]:
                hashed = (hashed * int(lm_score.BASE) + ord(c)) % 2**64
            if hashed in place and size <= pieces.longest:
                total += np.exp(scores[place[hashed]]) * brute(text[size:])
        spelled = np.exp(sum(scores[b] for b in text[0].encode()))
        return total + spelled * brute(text[1:])

    for word in ("the", "ünter", "x", "漢é"):
        expected = np.log(brute(lm_score.START + word))
        assert model.lattice([word.encode()])[0] == pytest.approx(expected)


def test_chat_edges(spark):
    kinds = "conv_id bigint, turn bigint, role string, text string, start int, TEXT string"
    marks = "</s>[INST] \\ <|x|> \\\\ <<SYS>>"
    turns = [
        (1, 0, "system", "hello"), (1, 1, "user", marks), (1, 2, "assistant", marks),
        (2, 0, "system", "hello"), (2, 1, "user", marks), (2, 2, "assistant", "other"),
        (3, 0, "system", "hello"), (4, 0, None, None), (None, None, "assistant", ""),
        (5, 1, "user", "twice"), (5, 1, "user", "twice"),
    ]
    frame = spark.createDataFrame([(*t, 1, "x") for t in turns], kinds)
    tree, paths = chat.format_conversations(frame)
    nodes = tree.orderBy("start").collect()
    assert len(nodes) == 8  # three shared turns of conversations 2 and 3 are written once
    assert [n.start for n in nodes] == [sum(m.n_tokens for m in nodes[:i]) for i in range(8)]
    for node in nodes:
        assert node.position == sum(b - a for a, b in node.attends)
    branch = [n for n in nodes if n.branch == 2]
    first = [n for n in nodes if n.branch == 1]
    assert [tuple(i) for i in branch[0].attends] == [(first[0].start, first[2].start)]
    found = {r.conv_id: r for r in chat.read_conversations(tree, paths).collect()}
    assert found[1].loss_chars == len(marks) and found[2].loss_chars == 5
    assert found[5].n_turns == 2 and found[None].n_turns == 1
    empty = chat.format_conversations(frame.limit(0))
    assert chat.read_conversations(*empty).count() == 0
    assert chat.unescape(chat.escape(marks)) == marks
    assert not any(c in chat.escape(marks) for c in chat.CONTROL)


def test_quality_edges(spark, awkward, nothing):
    none = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = quality.train(awkward, none)
    rows = quality.quality_scores(awkward, model).collect()
    assert len(rows) == 10 and all(r.predicted == 1 and r.score >= 0.7 for r in rows)
    assert quality.keep_good(awkward, model).columns == awkward.columns
    assert quality.quality_scores(nothing, model).count() == 0
    labels = spark.createDataFrame([(4, 1), (5, 1), (3, 0), (2, None), (None, 1)], none.schema[:2])
    assert quality.quality_scores(awkward, quality.train(awkward, labels)).count() == 10


def test_embedding_edges(spark):
    one, near = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    rows = [
        (1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]), (5, [float("nan")] * 3),
        (6, [float("inf"), 1.0, 0.0]), (7, one), (8, near), (9, one), (10, [1.0, 0.0]),
        (11, [-1.0, 0.0, 0.0]), (12, [1e200, 0.0, 1e199]), (None, [0.0, 0.0, 7.0]), (9, one),
    ]
    kinds = "vec_id bigint, embedding array<double>, EMBEDDING string, node int"
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], kinds)
    found = rows_of(
        embeddings.near_duplicates(frame).select("vec_id", "n_links", "component_id", "kept")
    )
    for i in range(1, 7):
        assert (i, 0, i, True) in found
    assert (7, 4, 7, True) in found and (8, 4, 7, False) in found and found.count(
        (9, 4, 7, False)
    ) == 2
    assert (10, 0, 10, True) in found and (11, 0, 11, True) in found
    assert (None, 0, None, True) in found and (12, 4, 7, False) in found
    assert embeddings.near_duplicates(frame.limit(0)).count() == 0


def test_embedding_recall_and_estimates():
    rng = np.random.default_rng(1)
    units = embeddings._unit(rng.standard_normal((300, 64)))
    turned = units @ embeddings.rotation(64, 0)
    estimate, deviation = embeddings.estimates(turned, turned)
    error = estimate - units @ units.T
    off = ~np.eye(300, dtype=bool)
    assert abs(error[off].mean()) < 0.005
    assert (np.abs(error) <= embeddings.CONFIDENCE * deviation + 1e-9)[off].mean() > 0.999


def test_embedding_large_group(spark):
    rng = np.random.default_rng(2)
    center = rng.standard_normal(64)
    hot = center + 0.02 * rng.standard_normal((250, 64))
    other = rng.standard_normal((300, 64))
    data = np.concatenate([hot, other])
    frame = spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(data)], "vec_id bigint, embedding array<double>"
    )
    found = embeddings.near_duplicates(frame).toPandas().sort_values("vec_id")
    units = data / np.linalg.norm(data, axis=1)[:, None]
    assert found.n_links.tolist() == ((units @ units.T >= 0.9).sum(1) - 1).tolist()


def test_embedding_stored_estimates(spark):
    rng = np.random.default_rng(3)
    angles = np.arange(240) * 0.08  # an arc: near neighbours are linked, the rest is not
    plane, _ = np.linalg.qr(rng.standard_normal((64, 2)))
    data = np.stack([np.cos(angles / 8), np.sin(angles / 8)], 1) @ plane.T
    data += 0.3 * np.sin(angles[:, None] * rng.standard_normal(64)) / 8
    nodes = spark.createDataFrame(
        [(i.to_bytes(16), row.tobytes()) for i, row in enumerate(data)], "node binary, vector binary"
    )
    width, number = embeddings.bands(240)
    stored = embeddings.banded(nodes, width, number).orderBy("node").toArrow()
    rows = np.arange(240)
    left_open = embeddings.possible(stored, rows, rows, 0.9)
    units = data / np.linalg.norm(data, axis=1)[:, None]
    cosines = units @ units.T
    assert left_open[cosines >= 0.9].all() and left_open.mean() < 0.75
    assert not left_open[cosines < 0.3].any()
    frame = spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(data)], "vec_id bigint, embedding array<double>"
    )
    found = embeddings.near_duplicates(frame).toPandas().sort_values("vec_id")
    assert found.n_links.tolist() == ((cosines >= 0.9).sum(1) - 1).tolist()
    assert set(found.component_id) == {0}


def test_ordered_offsets(spark):
    frame = spark.range(1000).selectExpr("id % 7 AS k", "id", "id % 3 AS n")
    rows = common.in_order(frame, ["k", "id"], "n", "test").orderBy("k", "id").collect()
    total = 0
    for row in rows:
        assert row.before == total
        total += row.n
    assert [r.id for r in sorted(rows, key=lambda r: (r.part, r.place))] == [r.id for r in rows]
