"""The queries over whole tables: against SQL where there is one, else against plain Python."""

import base64
import hashlib
import math
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as driver
import corpus_pipeline
from dayfold.llm import lm_score, secrets
from dayfold.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "conversations", "labels")


@pytest.fixture(scope="module")
def documents():
    return pd.read_parquet(f"{SF_DIR}/documents.parquet").sort_values("doc_id")


def result(spark, name):
    return QUERIES[name](spark, SF_DIR).toPandas().sort_values("doc_id").reset_index(drop=True)


def test_registered():
    assert QUERIES.keys() | {"pipeline"} <= driver.queries().keys()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM read_parquet('{SF_DIR}/{table}.parquet')")
    cursor = connection.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(columns)
    found = sorted(map(tuple, frame.select(*columns).collect()))
    assert found == sorted(cursor.fetchall()) and found


def test_token_output(spark, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    found, start = result(spark, "op1_token_output"), 0
    for row, text in zip(found.itertuples(), documents.text):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [1], "<u4")
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(ids))
        start += len(ids)


def test_lm_score(spark, documents):
    words = [t.encode().lower().split() + [lm_score.END] for t in documents.text]
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in documents.doc_id]
    counts = Counter(w for own, out in zip(words, held) if not out for w in own)
    total, distinct = sum(counts.values()), len(counts)
    found = result(spark, "op2_lm_score")
    for row, own, out in zip(found.itertuples(), words, held):
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in own)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (out, len(own), total)
        assert row.n_known == sum(counts[w] > 0 for w in own)
        assert math.isclose(row.base_score, base) and row.score < 0
    assert len(found) == len(documents)


def test_byte_bpe(spark, documents):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    for row, text in zip(result(spark, "op4_byte_bpe").itertuples(), documents.text):
        ids = np.array(plain.encode_ordinary(text), "<u4")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_secret_scan(spark, documents):
    assign = secrets.ASSIGN.pattern.decode()
    import re

    kinds = {
        "assign": (re.compile(assign, re.IGNORECASE | re.ASCII), 12, 2),
        "access": (re.compile("AKIA[A-Z0-9]+"), 18, 0),
        "hex": (re.compile("[0-9a-f]+"), 16, 0),
    }
    for row, text in zip(result(spark, "op6_secret_scan").itertuples(), documents.text):
        spans = [
            (m.start(), i, f"{kind}:{m.start()}:{m.end()}")
            for i, (kind, (pattern, least, group)) in enumerate(kinds.items())
            for m in pattern.finditer(text)
            if len(m[group]) >= least
        ]
        written = ",".join(s[2] for s in sorted(spans))
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(
            sum(s[1] == i for s in spans) for i in range(3)
        )
        assert set(written.split(",")) <= {*row.spans.split(","), ""}


def test_source_mixing(spark, documents):
    found = result(spark, "op7_source_mixing")
    again = result(spark, "op7_source_mixing")
    assert found.taken.tolist() == again.taken.tolist()
    assert found["size"].tolist() == [len(t.encode().split()) for t in documents.text]
    assert (found.taken <= 2 * found["size"]).all()
    by_source = found.groupby("source").agg(
        size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"),
        longest=("size", "max"),
    )
    assert math.isclose(by_source.target.sum(), 1.5 * by_source["size"].sum())
    assert (by_source.target <= 2 * by_source["size"] + 1e-6).all()
    assert ((by_source.taken - by_source.target).abs() <= by_source.longest / 2 + 1).all()


def test_quality(spark, documents):
    found = result(spark, "op9_quality")
    assert found.score.between(0, 1).all()
    assert ((found.score >= 0.7) == (found.predicted == 1)).all()
    labels = pd.read_parquet(f"{SF_DIR}/labels.parquet").merge(found, on="doc_id")
    held = labels[labels.held_out]
    assert (held.quality == held.predicted).mean() > 0.9


def test_pipeline(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.toPandas()
        docs = stage(spark, docs, SF_DIR)
        after = docs.toPandas()
        kept[name] = after
        if name != "byte-level BPE":
            assert docs.columns == list(documents.columns)
            assert set(after.text) <= set(before.text)
        if name == "exact dedup":
            plain = before.text.str.encode("utf-8").map(bytes.lower)
            assert sorted(after.doc_id) == sorted(before.groupby(plain).doc_id.max())
    last = kept["byte-level BPE"]
    assert sorted(last.doc_id) == sorted(kept["source mixing"].doc_id)
    assert set(last.doc_id) <= set(kept["n-gram Jaccard join"].doc_id)
