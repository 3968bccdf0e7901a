"""Document quality by pairwise ranking.

A Bradley-Terry model: each document has a strength, linear in its features, and the chance that
one of two is preferred is the logistic function of the difference. The weights are fitted by
logistic loss on feature differences of pairs of a good and a bad document. The threshold is the
quantile of the strengths that leaves as large a share below it as the labels call bad.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dayfold.llm.common import exact_columns, packed, slices, text_bytes, unpacked

# Labelled documents and pairs that the fit uses at most.
SAMPLE_ROWS = 20_000
SAMPLE_PAIRS = 200_000
PENALTY = 1e-3
STEPS = 30
# The score at the threshold.
CUT = 0.7
# Rows whose crc32 has this remainder are held out.
FOLDS, HELD_OUT = 4, 2

# Characters whose share of the text is a feature each.
SINGLE = np.frombuffer(b"!#$%&*|.,;:?<>{}[]()=/\\\"'_-@~^`+\n\t ", np.uint8)
SPREAD = 8.0


def features(text: bytes) -> np.ndarray:
    """Shares of characters, and how words, pairs of words and lines repeat."""
    size = max(1, len(text))
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    groups = [
        counts[0x41:0x5B].sum(),
        counts[0x61:0x7B].sum(),
        counts[0x30:0x3A].sum(),
        counts[0x80:].sum(),
        counts[:0x20].sum(),
    ]
    shares = np.sqrt(np.concatenate([groups, counts[SINGLE]]) / size)
    words = text.split()
    n = max(1, len(words))
    often = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = text.split(b"\n")
    other = [
        np.log1p(len(words)),
        len(often) / n,
        max(often.values(), default=0) / n,
        pairs / n,
        len(set(lines)) / len(lines),
        np.log1p(len(lines) / n),
        np.log1p(size / n),
        np.sqrt(max(map(len, words), default=0) / size),
        float(not words),
    ]
    return np.concatenate([shares, other])


N_FEATURES = len(features(b""))


@dataclass(frozen=True)
class QualityModel:
    """Weights of standardised features, and the strength at the threshold."""

    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    threshold: float

    def strengths(self, rows: np.ndarray) -> np.ndarray:
        """Strength of each row of features."""
        scaled = np.clip((rows - self.mean) / self.spread, -SPREAD, SPREAD)
        return scaled @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Chance of winning against a document at the threshold, moved to be CUT there."""
        logit = self.strengths(rows) - self.threshold + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(logit, -700, 700)))


def fit_pairs(rows: np.ndarray, good: np.ndarray, pairs: int = SAMPLE_PAIRS) -> QualityModel:
    """The model from features and labels; with only one label, every document gets CUT."""
    n = rows.shape[1]
    if not len(rows) or good.all() or not good.any():
        return QualityModel(np.zeros(n), np.ones(n), np.zeros(n), 0.0)
    mean, spread = rows.mean(0), rows.std(0)
    spread[spread == 0] = 1.0
    scaled = np.clip((rows - mean) / spread, -SPREAD, SPREAD)
    choose = np.random.default_rng(0)
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    differences = (
        scaled[better[choose.integers(0, len(better), pairs)]]
        - scaled[worse[choose.integers(0, len(worse), pairs)]]
    )
    weights = np.zeros(n)
    for _ in range(STEPS):  # Newton steps on the penalised logistic loss
        chance = 1 / (1 + np.exp(-np.clip(differences @ weights, -30, 30)))
        gradient = differences.T @ (chance - 1) / pairs + PENALTY * weights
        curve = (differences * (chance * (1 - chance))[:, None]).T @ differences / pairs
        step = np.linalg.solve(curve + PENALTY * np.eye(n), gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    ordered = np.sort(scaled @ weights)
    below = int((~good).sum())
    threshold = (ordered[below - 1] + ordered[below]) / 2
    return QualityModel(mean, spread, weights, float(threshold))


def is_held_out(doc_id) -> F.Column:
    """Whether the crc32 of the id as text has the remainder that is not learned from."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(FOLDS)) == F.lit(HELD_OUT), F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fit on documents whose ``labels`` row (doc_id, quality, ...) says 0 or 1.

    Rows that are held out, have no label or no document do not count. At most ``sample_rows``
    labelled ids are used, those with the smallest hash; so at most that many rows of features
    reach the driver, which is the bound of the fit. Nothing but the text is a feature.
    """
    told = exact_columns(labels, "doc_id", "quality").where(
        F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~is_held_out("doc_id")
    )
    sample = (
        told.groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )

    def extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [features(text).tolist() for text in text_bytes(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("quality"),
                    pa.array(found, pa.list_(pa.float64())),
                ],
                names=["doc_id", "quality", "features"],
            )

    # The sample's size is bounded by sample_rows, so it is sent to the tasks that read texts.
    rows = exact_columns(docs, "doc_id", "text").join(F.broadcast(sample), ["doc_id"])
    kinds = T.StructType(
        [
            rows.schema["doc_id"],
            rows.schema["quality"],
            T.StructField("features", T.ArrayType(T.DoubleType())),
        ]
    )
    found = rows.select("doc_id", "quality", "text").mapInArrow(extract, kinds)
    # Repeated rows of one id count once.
    once = found.groupBy("doc_id").agg(F.first("quality"), F.max("features")).collect()
    once.sort(key=lambda row: row[0])
    matrix = np.array([row[2] for row in once], float).reshape(-1, N_FEATURES)
    return fit_pairs(matrix, np.array([row[1] == 1 for row in once], bool))


def score_rows(docs: DataFrame, model: QualityModel) -> DataFrame:
    """``_row`` (all columns of ``docs``, see ``packed``), doc_id and score of each row."""
    whole = packed(docs, "doc_id", "text")

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = np.array([features(text) for text in text_bytes(batch.column("text"))])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_row"), pa.array(model.scores(rows))],
                names=["doc_id", "_row", "score"],
            )

    kinds = T.StructType(
        [whole.schema["doc_id"], whole.schema["_row"], T.StructField("score", T.DoubleType())]
    )
    return whole.mapInArrow(score, kinds)


def quality_scores(docs: DataFrame, model: QualityModel) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs`` (doc_id, text, ...).

    A null text is empty; empty texts have a score as any other. Rows are scored by themselves
    and whole, so repeated rows give repeated results; a null doc_id is not held out; an empty
    table gives none.
    """
    scored = score_rows(exact_columns(docs, "doc_id", "text"), model)
    return scored.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= F.lit(CUT)).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs`` at or above the threshold, with all their columns."""
    scored = score_rows(docs, model)
    return unpacked(scored.where(F.col("score") >= F.lit(CUT)), docs.columns)
