"""Language-model scores of documents by a lattice of subwords.

The pieces are those of an existing vocabulary. A word, with a mark at its start, can be cut into
pieces in many ways; its probability is the sum over all of them of the products of the pieces'
unigram probabilities, computed by a forward recursion in log space. Characters can also be
spelled out in the vocabulary's byte pieces, so no text is impossible. A document is its words
and an end; as every piece lies within one word, its log probability is the sum of theirs.

The scores of the pieces are fitted to the training words by expectation maximisation. A word
that was met in training is also an arc of its own over the whole of it: each count gives up a
discount, and what all of them give up is the weight of the lattice of pieces, which therefore is
fitted to words as such, each counting once. The probabilities of all texts add up to one.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log, log10

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import exact_columns, slices, text_bytes
from dayfold.sinks.shared import write_aside

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
START = "▁"
# Training rows are those whose crc32 does not have this remainder.
FOLDS, HELD_OUT = 7, 2
# The end of a document, which no word equals.
END = b""
ROUNDS = 3
# Added to the expected count of every piece.
SMOOTH = 0.01
# Frequent words that are sent to every task, and how long each may be; a bound of about 20 MB.
FREQUENT = 200_000
FREQUENT_BYTES = 48
# Words that a task counts before it passes them on.
COUNTED_WORDS = 500_000
BASE = np.uint64(0x9E3779B97F4A7C15)


def learned_from(doc_id: int | None) -> bool:
    """Whether a row is one of the training rows; a null id is."""
    return zlib.crc32(str(doc_id).encode()) % FOLDS != HELD_OUT


def words_of(text: bytes) -> list[bytes]:
    """The words, lower-cased in A-Z."""
    return text.lower().split()


@dataclass(frozen=True)
class Pieces:
    """Hashes of the pieces of each length, with their places; byte pieces come first."""

    hashes: tuple[np.ndarray, ...]
    places: tuple[np.ndarray, ...]
    number: int

    @property
    def longest(self) -> int:
        return len(self.hashes)


def _codes(words: Sequence[str]) -> np.ndarray:
    """Code points of words of one length."""
    data = "".join(words).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(data, "<u4").reshape(len(words), -1).astype(np.uint64)


def load_pieces(path: str = VOCABULARY) -> Pieces:
    """The ordinary pieces of a vocabulary, and one piece per byte."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    place = {text: 256 + i for i, text in enumerate(texts)}
    hashes, places = [], []
    for size in range(1, max(map(len, texts)) + 1):
        some = [t for t in texts if len(t) == size]
        if not some:
            hashes.append(np.zeros(0, np.uint64))
            places.append(np.zeros(0, np.int64))
            continue
        codes = _codes(some)
        hashed = np.zeros(len(some), np.uint64)
        for k in range(size):
            hashed = hashed * BASE + codes[:, k]
        order = np.argsort(hashed)
        hashes.append(hashed[order])
        places.append(np.array([place[t] for t in some])[order])
    return Pieces(tuple(hashes), tuple(places), 256 + len(texts))


class Lattice:
    """The ways to cut words of one length: arcs (start, end, piece or none)."""

    def __init__(self, pieces: Pieces, words: Sequence[str], scores: np.ndarray):
        """``scores``: log probability of each piece, natural."""
        codes = _codes(words)
        self.count, self.length = codes.shape
        self.arcs: dict[tuple[int, int], np.ndarray] = {}
        hashed = np.zeros((self.count, self.length + 1), np.uint64)
        for size in range(1, min(pieces.longest, self.length) + 1):
            hashed = hashed[:, : self.length - size + 1] * BASE + codes[:, size - 1 :]
            known, places = pieces.hashes[size - 1], pieces.places[size - 1]
            if not len(known):
                continue
            at = np.minimum(np.searchsorted(known, hashed), len(known) - 1)
            found = np.where(known[at] == hashed, places[at], -1)
            for start in np.flatnonzero((found >= 0).any(0)).tolist():
                self.arcs[start, start + size] = found[:, start]
        self.weights = {
            arc: np.where(found >= 0, scores[found], -np.inf) for arc, found in self.arcs.items()
        }
        # Each character in bytes, by its code point.
        self.points, self.inverse = np.unique(codes, return_inverse=True)
        self.inverse = self.inverse.reshape(codes.shape)
        self.spelled = [list(chr(int(c)).encode("utf-8", "surrogatepass")) for c in self.points]
        self.spell = np.array([scores[b].sum() for b in self.spelled])

    def forward(self) -> np.ndarray:
        """Log probability of each word's beginning up to each place."""
        alpha = np.full((self.length + 1, self.count), -np.inf)
        alpha[0] = 0.0
        into: dict[int, list[int]] = {}
        for start, end in self.arcs:
            into.setdefault(end, []).append(start)
        for end in range(1, self.length + 1):
            total = alpha[end - 1] + self.spell[self.inverse[:, end - 1]]
            for start in into.get(end, ()):
                total = np.logaddexp(total, alpha[start] + self.weights[start, end])
            alpha[end] = total
        return alpha

    def expected(self, times: np.ndarray, number: int) -> np.ndarray:
        """Expected count of each piece when each word comes ``times`` times."""
        alpha = self.forward()
        beta = np.full_like(alpha, -np.inf)
        beta[self.length] = 0.0
        out: dict[int, list[int]] = {}
        for start, end in self.arcs:
            out.setdefault(start, []).append(end)
        for start in range(self.length - 1, -1, -1):
            total = beta[start + 1] + self.spell[self.inverse[:, start]]
            for end in out.get(start, ()):
                total = np.logaddexp(total, beta[end] + self.weights[start, end])
            beta[start] = total
        whole = alpha[self.length]
        counts = np.zeros(number)
        for (start, end), found in self.arcs.items():
            share = np.exp(alpha[start] + self.weights[start, end] + beta[end] - whole) * times
            counts += np.bincount(np.maximum(found, 0), np.where(found >= 0, share, 0), number)
        spelled = np.zeros(len(self.points))
        for place in range(self.length):
            own = self.inverse[:, place]
            share = np.exp(alpha[place] + self.spell[own] + beta[place + 1] - whole) * times
            spelled += np.bincount(own, share, len(self.points))
        for data, n in zip(self.spelled, spelled):
            np.add.at(counts, data, n)
        return counts


def by_length(words: Sequence[bytes]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Places and marked texts of words of each length."""
    marked = [START + word.decode("utf-8", "replace") for word in words]
    sizes = np.array([len(text) for text in marked])
    for size in np.unique(sizes):
        places = np.flatnonzero(sizes == size)
        yield places, [marked[i] for i in places.tolist()]


@dataclass(frozen=True)
class SubwordModel:
    """Log probabilities (natural) of the pieces; the discount, and the training counts."""

    pieces: Pieces
    scores: np.ndarray
    discount: float
    tokens: int
    distinct: int

    def lattice(self, words: Sequence[bytes]) -> np.ndarray:
        """Natural log probability of each word, over all ways to cut it into pieces."""
        found = np.zeros(len(words))
        for places, texts in by_length(words):
            found[places] = Lattice(self.pieces, texts, self.scores).forward()[-1]
        return found

    def word_scores(self, words: Sequence[bytes], counts: np.ndarray) -> np.ndarray:
        """log10 probability of each word that came ``counts`` times in training.

        With nothing to learn from, the lattice is all there is, and the end is certain.
        """
        found = self.lattice(words)
        ends = np.array([word == END for word in words], bool)
        if not self.tokens:
            return np.where(ends, 0.0, found) / log(10)
        found += log(self.discount * self.distinct / self.tokens)
        found[ends] = -np.inf
        # The end is never an unknown word; where it was not met, it counts as met once.
        counts = np.where(ends, np.maximum(counts, 1), counts)
        whole = np.maximum(counts - self.discount, 1e-300) / self.tokens
        return np.where(counts > 0, np.logaddexp(found, np.log(whole)), found) / log(10)


COUNTED = pa.schema([("word", pa.binary()), ("c", pa.int64()), ("uses", pa.int64())])
EXPECTED = pa.schema([("piece", pa.int64()), ("n", pa.float64())])


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c, uses): counts in training rows and in all, of every word and of END."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned, other = Counter(), Counter()

        def counted():
            words = list(learned.keys() | other.keys())
            c = [learned[w] for w in words]
            uses = [n + other[w] for n, w in zip(c, words)]
            return pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip((words, c, uses), COUNTED)], schema=COUNTED
            )

        for batch in slices(batches):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, text_bytes(batch.column("text"))):
                into = learned if learned_from(doc_id) else other
                into.update(words_of(text))
                into[END] += 1
            if len(learned) + len(other) > COUNTED_WORDS:
                yield counted()
                learned.clear()
                other.clear()
        yield counted()

    return (
        exact_columns(docs, "doc_id", "text")
        .mapInArrow(count, "word binary, c bigint, uses bigint")
        .groupBy("word")
        .agg(F.sum("c").alias("c"), F.sum("uses").alias("uses"))
    )


def _expectation(words: DataFrame, pieces: Pieces, scores: np.ndarray) -> np.ndarray:
    """Expected counts of all pieces over the training words, each of which counts once."""

    def expect(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(pieces.number)
        for batch in batches:
            for places, texts in by_length(batch.column("word").to_pylist()):
                once = np.ones(len(places))
                counts += Lattice(pieces, texts, scores).expected(once, pieces.number)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int64()), pa.array(counts[some])], schema=EXPECTED
        )

    learned = words.where((F.col("c") > 0) & (F.length("word") > 0)).select("word")
    found = learned.mapInArrow(expect, "piece bigint, n double")
    counts = np.zeros(pieces.number)
    for piece, n in found.groupBy("piece").agg(F.sum("n")).collect():  # bounded by the pieces
        counts[piece] = n
    return counts


def fit(words: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS) -> SubwordModel:
    """The model from a written table of ``word_counts``.

    The rounds start from equal scores, where fewer pieces are likelier. The discount is the
    usual estimate from how many words were met once and twice.
    """
    pieces = load_pieces(path)
    c = F.col("c")
    tokens, distinct, once, twice = words.agg(
        F.sum(c), F.count_if(c > 0), F.count_if(c == 1), F.count_if(c == 2)
    ).first()
    discount = (once + 0.5) / (once + 2 * twice + 1)
    scores = np.full(pieces.number, -log(pieces.number))
    for _ in range(rounds):
        counts = _expectation(words, pieces, scores) + SMOOTH
        scores = np.log(counts / counts.sum())
    return SubwordModel(pieces, scores, discount, tokens or 0, distinct)


def _least_uses(table: DataFrame) -> int:
    """From how many uses on there are at most FREQUENT words.

    Counted by steps of an eighth of an octave, so that little more than a number per step is
    gathered, however many words there are.
    """
    step = F.floor(F.log2("uses") * 8).alias("step")
    steps = table.groupBy(step).count().collect()  # at most 8 * 64 rows
    least, words = 1 << 62, 0
    for row in sorted(steps, key=lambda r: -r[0]):
        words += row[1]
        if words > FREQUENT:
            break
        least = row[0]
    return least if least == 1 << 62 else ceil(2 ** (least / 8) - 1e-6)


ROWS = pa.schema(
    [
        ("row", pa.int64()),
        ("doc_id", pa.int64()),
        ("word", pa.binary()),
        ("times", pa.int64()),
        ("n_tokens", pa.int64()),
        ("n_known", pa.int64()),
        ("base", pa.float64()),
        ("score", pa.float64()),
    ]
)
ROW_KINDS = (
    "row bigint, doc_id bigint, word binary, times bigint, n_tokens bigint, n_known bigint, "
    "base double, score double"
)


def score_documents(
    docs: DataFrame, path: str = VOCABULARY, rounds: int = ROUNDS
) -> DataFrame:
    """Scores of each row of ``docs`` (doc_id, text, any other columns).

    (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): tokens are the
    lower-cased words and one end. ``score`` is the log10 probability of the text under the
    lattice, ``base_score`` that of a word unigram with one added to each count. Rows that are
    held out are not learned from.

    A null or empty text is just the end; a row with null doc_id is learned from; each row is
    scored by itself, so repeated rows have results of their own; whole texts count. An empty
    table gives none.

    Words are counted in the tasks before they are shuffled, and scored once each. The most
    frequent ones (a bounded number) are sent to every task, which sums them up per document;
    what is left of a document, its rare words, is joined with the table of words, where no word
    is frequent enough to be skewed.
    """
    words = write_aside(word_counts(docs), "lm-words")
    model = fit(words, path, rounds)
    spark = docs.sparkSession

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.asarray(batch.column("c"))
            found = model.word_scores(batch.column("word").to_pylist(), counts)
            yield batch.append_column("score", pa.array(found))

    table = write_aside(
        words.mapInArrow(score, "word binary, c bigint, uses bigint, score double"), "lm-scores"
    )
    total = model.tokens
    below = log10(total + model.distinct + 1)
    short = table.where(F.length("word") <= FREQUENT_BYTES)
    top = short.where(F.col("uses") >= _least_uses(short)).select("word", "c", "score").collect()
    place = {bytes(row[0]): i for i, row in enumerate(top)}
    counts = np.array([row[1] for row in top] + [0], np.float64)
    logs = np.array([row[2] for row in top] + [0.0])
    frequent = spark.sparkContext.broadcast((place, counts, logs))

    def split(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        get = frequent.value[0].get
        counts, logs = frequent.value[1:]
        bases, known = np.log10(counts + 1), counts > 0
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            out: list[list] = [[] for _ in ROWS]

            def add(*values):
                for column, value in zip(out, values):
                    column.append(value)

            ids = batch.column("doc_id").to_pylist()
            for doc_id, text in zip(ids, text_bytes(batch.column("text"))):
                often = Counter(words_of(text))
                often[END] += 1
                own = list(often)
                times = np.fromiter(often.values(), np.int64, len(own))
                at = np.fromiter((get(w, -1) for w in own), np.int64, len(own))
                here = at >= 0
                some, n = at[here], times[here]
                add(
                    row, doc_id, None, 0, int(times.sum()), int(n[known[some]].sum()),
                    float(n @ bases[some]), float(n @ logs[some]),
                )
                for i in np.flatnonzero(~here).tolist():
                    add(row, doc_id, own[i], int(times[i]), 0, 0, 0.0, 0.0)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, f.type) for x, f in zip(out, ROWS)], schema=ROWS
            )

    rows = write_aside(
        exact_columns(docs, "doc_id", "text").mapInArrow(split, ROW_KINDS), "lm-rows"
    )
    sums = rows.where(F.col("word").isNull()).select(
        "row", "doc_id", "n_tokens", "n_known", "base", "score"
    )
    rare = rows.where(F.col("word").isNotNull()).select("row", "word", "times")
    joined = rare.join(table.select("word", "c", "score"), ["word"]).select(
        "row",
        F.lit(None).cast("long").alias("doc_id"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("times")).otherwise(0).alias("n_known"),
        (F.col("times") * F.log10(F.col("c") + 1)).alias("base"),
        (F.col("times") * F.col("score")).alias("score"),
    )
    whole = sums.unionByName(joined).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score")],
    )
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    held_out = F.coalesce(F.pmod(crc, F.lit(FOLDS)) == HELD_OUT, F.lit(False))
    return whole.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        "score",
    )
