"""Byte-level BPE, encoding and decoding.

A piece of text is encoded without running its merges: from the left the longest vocabulary
entry is taken that is compatible with its left neighbour, and the last choice is undone where
none is. Two adjacent entries are compatible when the merges leave their concatenation as just
these two; a sequence whose neighbours are all compatible is the one that the merges give, so
the ids are exactly those of the merges. Compatibility is remembered, and a position that has
been undone is not tried again, so the work is linear in the length of the piece.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from dayfold.llm.common import batch_of, exact_columns, slices, texts

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
# Entries that a worker remembers; more only make it start over, never change a result.
MEMO_PIECES = 400_000
MEMO_PAIRS = 1_000_000
# Pieces longer than this are not remembered.
MEMO_LENGTH = 64
# The vocabulary's pattern has \s, which here is exactly the Unicode white space.
WHITE_SPACE = r"\p{White_Space}"


def pattern() -> regex.Pattern:
    """The public pattern, with the white space class of the original library."""
    text = public_tokenizers.PATTERN
    text = text.replace(r"[^\s", rf"[^{WHITE_SPACE}")
    return regex.compile(text.replace(r"\S", rf"[^{WHITE_SPACE}]").replace(r"\s", WHITE_SPACE))


class ByteBpe:
    """Encoder and decoder for a rank file of base64 tokens."""

    def __init__(self, path: str = RANKS):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens: list[bytes] = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.split = pattern()
        self.automaton = ahocorasick.Automaton()
        reachable = {t: r for t, r in self.ranks.items() if self.merges(t) == [r]}
        for token, rank in reachable.items():
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.shorter = {rank: self._shorter(t, reachable) for t, rank in reachable.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.pieces = _Pieces(self)

    @staticmethod
    def _shorter(token: bytes, reachable: dict[bytes, int]) -> int | None:
        """The next longest entry that the token begins with."""
        for end in range(len(token) - 1, 0, -1):
            rank = reachable.get(token[:end])
            if rank is not None:
                return rank
        return None

    def merges(self, piece: bytes) -> list[int]:
        """The ids by repeated merging of the lowest ranked neighbours; only for short pieces."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            ranked = [
                (self.ranks[pair], i)
                for i in range(len(parts) - 1)
                if (pair := parts[i] + parts[i + 1]) in self.ranks
            ]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[part] for part in parts]

    def compatible(self, left: int, right: int) -> bool:
        """Whether the merges leave these two neighbours alone."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            known = self.merges(self.tokens[left] + self.tokens[right]) == [left, right]
            self.pairs[left, right] = known
        return known

    def encode_piece(self, piece: bytes) -> list[int]:
        """The ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size = len(piece)
        longest: list[int] = [-1] * size
        lengths = [0] * size
        for end, (rank, length) in self.automaton.iter(piece.decode("latin-1")):
            start = end - length + 1
            if length > lengths[start]:
                longest[start], lengths[start] = rank, length
        open_at = bytearray(b"\x01") * (size + 1)
        ids: list[int] = []
        at, token = 0, longest[0]
        while at < size:
            last = ids[-1] if ids else None
            while token is not None:
                end = at + len(self.tokens[token])
                if open_at[end] and (last is None or self.compatible(last, token)):
                    break
                token = self.shorter[token]
            if token is None:
                # Nothing fits here: this position is closed, and the last choice gets shorter.
                open_at[at] = 0
                token = ids.pop()
                at -= len(self.tokens[token])
            else:
                ids.append(token)
                at = end
                token = longest[at] if at < size else None
        return ids

    def encode(self, text: str) -> bytes:
        """All ids of a text as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.split.findall(text)))

    def decode(self, ids: Iterable[int]) -> bytes:
        """The bytes of a sequence of ids."""
        return b"".join(map(self.tokens.__getitem__, ids))


class _Pieces(dict):
    """Ids of pieces met before."""

    def __init__(self, bpe: ByteBpe):
        super().__init__()
        self.bpe = bpe

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.bpe.encode_piece(piece.encode()), "<u4").tobytes()
        if len(piece) <= MEMO_LENGTH:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = ids
        return ids


@lru_cache(maxsize=1)
def loaded(path: str) -> ByteBpe:
    """One encoder per worker."""
    return ByteBpe(path)


ENCODED = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
DECODED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("content", pa.binary())])
ROUND_TRIP = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
        ("n_bytes", pa.int64()),
    ]
)


def encode_documents(docs: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, n_tokens, ids) for each row of ``docs`` (doc_id, text, any other columns).

    ``ids`` are little-endian unsigned 32-bit integers. A null or empty text has no ids. Texts
    of any length are encoded whole; each row is encoded by itself, so repeated rows give
    repeated results, a null doc_id stays null, and an empty table gives none. ``path`` must be
    readable on the executors.
    """

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in slices(batches):
            ids = [bpe.encode(text) for text in texts(batch.column("text"))]
            yield batch_of(
                ENCODED,
                doc_id=batch.column("doc_id").to_pylist(),
                n_tokens=[len(x) // 4 for x in ids],
                ids=ids,
            )

    return exact_columns(docs, "doc_id", "text").mapInArrow(
        encode, "doc_id bigint, n_tokens bigint, ids binary"
    )


def decode_documents(encoded: DataFrame, path: str = RANKS) -> DataFrame:
    """(doc_id, n_bytes, content) from rows (doc_id, ids); null ids decode to no bytes."""

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in slices(batches):
            content = [
                bpe.decode(np.frombuffer(ids or b"", "<u4").tolist())
                for ids in batch.column("ids").to_pylist()
            ]
            yield batch_of(
                DECODED,
                doc_id=batch.column("doc_id").to_pylist(),
                n_bytes=[len(x) for x in content],
                content=content,
            )

    return exact_columns(encoded, "doc_id", "ids").mapInArrow(
        decode, "doc_id bigint, n_bytes bigint, content binary"
    )


def round_trip(docs: DataFrame, path: str = RANKS, with_ids: bool = False) -> DataFrame:
    """Digests of the ids of each text and of the bytes decoded from those ids.

    The same as ``decode_documents(encode_documents(docs))``, in one pass over the rows;
    ``with_ids`` adds the ids themselves.
    """
    schema = ROUND_TRIP.append(pa.field("ids", pa.binary())) if with_ids else ROUND_TRIP

    def both(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(path)
        for batch in slices(batches):
            ids = [bpe.encode(text) for text in texts(batch.column("text"))]
            content = [bpe.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            yield batch_of(
                schema,
                doc_id=batch.column("doc_id").to_pylist(),
                n_tokens=[len(x) // 4 for x in ids],
                ids_sha256=[hashlib.sha256(x).hexdigest() for x in ids],
                decoded_sha256=[hashlib.sha256(x).hexdigest() for x in content],
                n_bytes=[len(x) for x in content],
                ids=ids,
            )

    kinds = (
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_bytes bigint"
    )
    return exact_columns(docs, "doc_id", "text").mapInArrow(
        both, f"{kinds}, ids binary" if with_ids else kinds
    )
