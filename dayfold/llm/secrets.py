"""Secrets in text: fixed patterns, and character Markov models for what no pattern names.

Two first-order Markov models over the characters of keys are learned: one of random strings
(what the patterns find in the corpus, and labelled samples), one of ordinary identifiers and
words (the rest of the corpus, and labelled samples). A run of twelve such characters or more, or what
the patterns leave of one, is a secret when its log-likelihood ratio under the two is high enough,
in all and per character.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import batch_of, exact_columns, slices, text_bytes

# The patterns of the three kinds, in the order in which kinds are listed.
ASSIGN = re.compile(
    rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE,
)
ACCESS = re.compile(rb"AKIA[A-Z0-9]{14,}")
HEX = re.compile(rb"[0-9a-f]{16,}")
ASSIGN_LENGTH = 12
KINDS = ("assign", "access", "hex", "markov")
# A word that every match of ASSIGN contains.
KEYWORDS = (b"passw", b"secret", b"token", b"apikey", b"api_key")

# The characters of the models; any other ends a run.
SYMBOLS = string.ascii_letters + string.digits + "+/_=-"
RUN = re.compile(rb"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{12,}")
RUN_LENGTH = 12
# The ratio in nats that a secret needs in all and per character.
MIN_TOTAL = 12.0
MIN_MEAN = 0.6

EDGE = len(SYMBOLS)
CODES = np.full(256, EDGE, np.int64)
CODES[[ord(c) for c in SYMBOLS]] = np.arange(EDGE)
STATES = EDGE + 1


@dataclass(frozen=True)
class Span:
    """A match, in bytes; end exclusive."""

    kind: str
    start: int
    end: int


def base_spans(text: bytes) -> list[Span]:
    """What the patterns find: leftmost, not overlapping within a kind, by start, then kind."""
    found = []
    low = text.lower()
    if any(word in low for word in KEYWORDS):
        found += [
            Span("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH
        ]
    found += [Span("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [Span("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def labelled_samples(number: int = 2000, seed: int = 7) -> list[tuple[str, bool]]:
    """Random keys in four alphabets (True) and identifiers in four styles (False)."""
    choose = random.Random(seed)
    parts = (
        "get set user name file path list item count total value index config option response "
        "request handler service manager factory builder parser buffer stream client server "
        "message event queue cache table column record field type class object string number"
    ).split()
    alphabets = [
        string.ascii_letters + string.digits,
        string.ascii_uppercase + string.digits,
        string.ascii_letters + string.digits + "+/",
        string.ascii_letters + string.digits + "_-",
    ]
    styles = ["_".join, "-".join, "/".join, lambda words: "".join(map(str.capitalize, words))]
    samples = []
    for i in range(number):
        size = choose.randint(RUN_LENGTH, 44)
        samples.append(("".join(choose.choices(alphabets[i % 4], k=size)), True))
        samples.append((styles[i % 4](choose.choices(parts, k=choose.randint(3, 6))), False))
    return samples


def transitions(text: bytes, into: np.ndarray) -> None:
    """Add the counts of neighbouring characters in all runs of ``text``."""
    codes = np.full(len(text) + 2, EDGE)
    codes[1:-1] = CODES[np.frombuffer(text, np.uint8)]
    pairs = codes[:-1] * STATES + codes[1:]
    into += np.bincount(pairs, minlength=STATES * STATES)


def chances(counts: np.ndarray) -> np.ndarray:
    """Log transition probabilities between symbols, with one added to each count."""
    inner = counts.reshape(STATES, STATES)[:, :EDGE].astype(float) + 1
    return np.log(inner / inner.sum(1, keepdims=True))


@dataclass(frozen=True)
class SecretModel:
    """Log-likelihood ratios of neighbouring characters: random strings over ordinary ones."""

    ratios: np.ndarray
    min_total: float = MIN_TOTAL
    min_mean: float = MIN_MEAN

    def ratio(self, run: bytes) -> float:
        """The ratio of a whole run, in nats."""
        codes = CODES[np.frombuffer(run, np.uint8)]
        before = np.concatenate([[EDGE], codes[:-1]])
        return float(self.ratios[before, codes].sum())

    def spans(self, text: bytes) -> list[Span]:
        """All spans: those of the patterns, and what looks random in the runs outside them."""
        found = base_spans(text)
        if not any(len(word) >= RUN_LENGTH for word in text.split()):
            return found
        taken = [(s.start, s.end) for s in found]
        for match in RUN.finditer(text):
            for start, end in outside(*match.span(), taken):
                if end - start < RUN_LENGTH:
                    continue
                ratio = self.ratio(text[start:end])
                if ratio >= self.min_total and ratio >= self.min_mean * (end - start):
                    found.append(Span("markov", start, end))
        return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind)))


def outside(start: int, end: int, taken: Sequence[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of a stretch without the ones in ``taken``, which are in order of their start."""
    for a, b in taken:
        if b > start and a < end:
            if a > start:
                yield start, a
            start = max(start, b)
    if start < end:
        yield start, end


def train(docs: DataFrame, samples: Sequence[tuple[str, bool]] | None = None) -> SecretModel:
    """The model from all documents and from labelled ``samples`` (text, is it a secret).

    Every task counts neighbouring characters of what the patterns find and of the rest; the
    counts (a few thousand numbers, whatever the corpus) are summed by Spark. Corpus and samples
    count alike in the model of random strings, so that one kind of key in the corpus does not
    make all keys of other kinds unlikely.
    """
    samples = labelled_samples() if samples is None else samples

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, STATES * STATES), np.int64)
        for batch in batches:
            for text in text_bytes(batch.column("text")):
                rest = bytearray(text)
                for span in base_spans(text):
                    transitions(text[span.start : span.end], counts[1])
                    rest[span.start : span.end] = b" " * (span.end - span.start)
                if rest:
                    transitions(bytes(rest), counts[0])
        place = np.flatnonzero(counts)
        yield batch_of(COUNTS, place=place, n=counts.reshape(-1)[place])

    counted = exact_columns(docs, "text").mapInArrow(count, "place bigint, n bigint")
    counts = np.zeros(2 * STATES * STATES)
    for place, n in counted.groupBy("place").agg(F.sum("n")).collect():  # bounded by the symbols
        counts[place] = n
    ordinary, found = counts.reshape(2, -1)
    own = np.zeros((2, STATES * STATES), np.int64)
    for text, secret in samples:
        transitions(text.encode(), own[int(secret)])
    random_strings = np.logaddexp(chances(found), chances(own[1])) - np.log(2)
    return SecretModel(random_strings - chances(ordinary + own[0]))


COUNTS = pa.schema([("place", pa.int64()), ("n", pa.int64())])
SCANNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
        ("n_markov", pa.int64()),
    ]
)


def _written(text: bytes, spans: Sequence[Span]) -> str:
    """``kind:start:end`` in code points, comma-joined."""
    if text.isascii():
        return ",".join(f"{s.kind}:{s.start}:{s.end}" for s in spans)
    out, at, points = [], 0, 0
    for span in spans:
        points += len(text[at : span.start].decode("utf-8", "replace"))
        at = span.start
        size = len(text[span.start : span.end].decode("utf-8", "replace"))
        out.append(f"{span.kind}:{points}:{points + size}")
    return ",".join(out)


def scan(docs: DataFrame, model: SecretModel) -> DataFrame:
    """Spans and counts of secrets in each row of ``docs`` (doc_id, text, any other columns).

    (doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov): the digest is over the
    spans of the patterns as text, ``spans`` has those of the model as well. Offsets are code
    points, end exclusive. A null text is empty and has none; each row is scanned by itself
    and whole, so repeated rows give repeated results; an empty table gives none.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in text_bytes(batch.column("text")):
                spans = model.spans(text)
                base = [s for s in spans if s.kind != "markov"]
                counts = [sum(s.kind == kind for s in spans) for kind in KINDS]
                digest = hashlib.sha256(_written(text, base).encode()).hexdigest()
                rows.append((*counts[:3], digest, _written(text, spans), counts[3]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    *[pa.array([r[i] for r in rows], SCANNED.field(i + 1).type) for i in range(6)],
                ],
                schema=SCANNED,
            )

    return exact_columns(docs, "doc_id", "text").mapInArrow(
        find,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, "
        "spans string, n_markov bigint",
    )
