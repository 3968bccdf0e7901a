"""Each stage of the pipeline against a plain version over what the stage before kept, and edges."""

import base64
import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from test_mixing import plain_mix

import corpus_pipeline

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def shingles(text):
    words = (text or "").encode().lower().split()
    size = min(5, len(words))
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()


def plain_classes(rows):
    """The smallest doc_id of each class of texts that a similarity of 0.8 links."""
    sets, root = [shingles(text) for _, text in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, own in enumerate(sets):
        for j in range(i):
            both = len(own & sets[j])
            if own == sets[j] or both >= 0.8 * (len(own) + len(sets[j]) - both):
                root[find(i)] = find(j)
    kept = {}
    for i, (doc_id, _) in enumerate(rows):
        kept[find(i)] = min(doc_id, kept.get(find(i), doc_id))
    return sorted(kept.values())


def plain_tokens(texts):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    ids = [np.array(plain.encode_ordinary(text or ""), "<u4") for text in texts]
    return Counter((len(x), hashlib.sha256(x).hexdigest()) for x in ids)


def check_from_dedup(spark, docs):
    """Stages 2 to 5, each against its plain version."""
    before = docs.toPandas()
    for name in ("exact dedup", "n-gram Jaccard join", "source mixing", "byte-level BPE"):
        docs = STAGES[name](spark, docs, SF_DIR)
        after = docs.toPandas()
        if name != "byte-level BPE":
            assert list(after.columns) == list(before.columns)
        if name == "exact dedup":
            text = before.text.fillna("").str.encode("utf-8").map(bytes.lower)
            assert sorted(after.doc_id) == sorted(before.groupby(text).doc_id.max())
        elif name == "n-gram Jaccard join":
            rows = list(zip(before.doc_id, before.text))
            assert sorted(after.doc_id) == plain_classes(rows)
        elif name == "source mixing":
            rows = list(zip(before.doc_id, before.text, before.source))
            often = {k[0]: sum(n for n, _, _ in own) for k, own in plain_mix(rows).items()}
            assert Counter(after.doc_id) == Counter({k: n for k, n in often.items() if n})
            at = sorted((p, k[0]) for k, own in plain_mix(rows).items() for o in own for p in o[2])
            assert list(after.doc_id) == [doc_id for _, doc_id in at]
        else:
            assert Counter(zip(after.n_tokens, after.ids_sha256)) == plain_tokens(before.text)
            assert sorted(after.doc_id) == sorted(before.doc_id)
        before = after
    return before


@pytest.fixture(scope="module")
def good(spark):
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return STAGES["quality classifier"](spark, documents, SF_DIR)


def test_quality_keeps_what_labels_call_good(spark, good):
    documents = pd.read_parquet(f"{SF_DIR}/documents.parquet")
    labels = pd.read_parquet(f"{SF_DIR}/labels.parquet").merge(documents, on="doc_id")
    kept = good.toPandas()
    assert set(kept.doc_id) <= set(documents.doc_id)
    found = labels.doc_id.isin(kept.doc_id)
    assert (found == (labels.quality == 1)).mean() > 0.95


def test_stages_against_plain_versions(spark, good):
    assert len(check_from_dedup(spark, good)) > 0


def test_stages_with_nulls_ties_and_clashing_columns(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None, "a"), (2, "", None), (3, " \t", "a"), (4, base, "a"), (5, base + " tail", "b"),
        (6, base.upper(), None), (7, "short", "b"), (8, "short", "a"), (9, "one two three", None),
        (10, "word another third " * 20_000, "a"), (11, "x" * 20_000, "b"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    names = ("TEXT", "key", "_row", "before", "size", "part", "last", "_position")
    clashing = docs.select("*", *[F.lit(None).cast("int").alias(name) for name in names])
    with_nulls = check_from_dedup(spark, clashing)
    assert {10, 11} <= set(with_nulls.doc_id)


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name in STAGES:
        docs = STAGES[name](spark, docs, SF_DIR)
        assert docs.count() == 0
