"""Token ids in a compact binary form.

Ids are numbered anew by their frequency over the corpus, so that the most frequent 256 take
one byte. A sequence is two byte strings: control bytes, each with the lengths of four values in
two bits, and the data bytes of the values one after another. Reading is a table lookup per
control byte, a masked copy, and a lookup of the ids by rank.

A corpus is a folder with ``files`` (the sequences in order), ``starts`` (the ids before each part
of them) and ``ranks`` (the id of each rank); nothing else is needed to read it.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from unicodedata import category

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayfold.llm.common import (
    batch_of,
    exact_columns,
    in_order,
    ordered_files,
    ragged,
    sized_slices,
    slices,
)
from dayfold.sinks.shared import shared_path, write_aside, write_to

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
# Entries that a worker remembers; more only make it start over, never change a result. A chunk
# that was forgotten is put together again from its pieces, which is cheap.
MEMO_CHUNKS = 500_000
MEMO_PIECES = 1_000_000
MEMO_LENGTH = 64
# Chunks that are normalised in one call.
TOGETHER = 4096
# Bytes of text that are encoded together, so that a chunk they share is looked up once.
TOGETHER_BYTES = 4 << 20
# A character that no normaliser changes or joins to others, between such chunks.
SEPARATOR = "\x01"
# Below this character all are assigned, and have been for long.
FIRST_OPEN = "\u0250"

# The lengths of the four values that a control byte describes.
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(values: np.ndarray, sizes: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of sequences that lie one after another in ``values``."""
    lengths = np.ones(len(values), np.uint8)
    for limit in (0xFF, 0xFFFF, 0xFFFFFF):
        lengths += values > limit
    ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    data = np.empty(int(ends[-1]), np.uint8)
    data[ends[:-1]] = values.astype(np.uint8)
    longer = np.flatnonzero(lengths > 1)
    for byte in (1, 2, 3):
        data[ends[longer] + byte] = (values[longer] >> (8 * byte)).astype(np.uint8)
        longer = longer[lengths[longer] > byte + 1]
    data_ends = ends[np.concatenate([[0], np.cumsum(sizes)])]
    quad_ends = np.concatenate([[0], np.cumsum(-(-sizes // 4))])
    codes = np.zeros(4 * int(quad_ends[-1]), np.uint8)
    codes[_slots(sizes, quad_ends)] = lengths - 1
    control = codes[::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    control, data = control.tobytes(), data.tobytes()
    return (
        [control[a:b] for a, b in zip(quad_ends[:-1], quad_ends[1:])],
        [data[a:b] for a, b in zip(data_ends[:-1], data_ends[1:])],
    )


def _slots(sizes: np.ndarray, quad_ends: np.ndarray) -> np.ndarray:
    """Where values go when each sequence begins at a multiple of four."""
    starts = np.concatenate([[0], np.cumsum(sizes)])[:-1]
    return np.arange(int(sizes.sum())) + np.repeat(4 * quad_ends[:-1] - starts, sizes)


def unpack(control: np.ndarray, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The values of sequences whose control and data bytes lie one after another."""
    quad_ends = np.concatenate([[0], np.cumsum(-(-sizes // 4))])
    lengths = LENGTHS[control].reshape(-1)[_slots(sizes, quad_ends)]
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    values = data[starts].astype("<u4")
    longer = np.flatnonzero(lengths > 1)
    for byte in (1, 2, 3):
        values[longer] |= data[starts[longer] + byte].astype("<u4") << np.uint32(8 * byte)
        longer = longer[lengths[longer] > byte + 1]
    return values


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves, the others for the letters from 256 on, in order.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def packed_ids(ids: Sequence[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


def _common(chunk: bytes) -> bool:
    """Whether all characters have the same class in every recent version of Unicode."""
    if chunk.isascii():
        return SEPARATOR.encode() not in chunk
    text = chunk.decode("utf-8", "replace")
    if max(text) < FIRST_OPEN:
        return SEPARATOR not in text
    return not any(c == SEPARATOR or category(c) == "Cn" for c in text)


class WordEncoder:
    """A tokenizer whose tokens never cross white space, with a memory of what it has met.

    Texts are cut at ASCII white space. The normaliser and the pattern of the tokenizer treat
    what lies between by itself, so its ids are those of the chunks one after another. A new
    chunk is normalised and cut by the tokenizer's pattern, and its model encodes the pieces.
    A chunk with the string of an added token in it goes through the tokenizer whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if any(not t or t.split() != [t] for t in added):
            raise ValueError("added tokens must not hold white space")
        # Without any, a pattern that is found nowhere.
        self.added = re.compile("|".join(map(re.escape, added)).encode() or b"(?!)")
        self.size = self.tokenizer.get_vocab_size()
        self.chunks: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.letters = _byte_letters()
        (split, _) = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"]
        self.pattern = regex.compile(split["pattern"]["Regex"])

    def encode_all(self, text: str) -> bytes:
        """The ids of a text without the memory."""
        return packed_ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            if piece.isascii() and piece.isprintable():
                letters = piece  # such bytes stand for themselves
            else:
                letters = "".join(map(self.letters.__getitem__, piece.encode()))
            ids = packed_ids([t.id for t in self.tokenizer.model.tokenize(letters)])
            if len(piece) <= MEMO_LENGTH:
                self.pieces[piece] = ids
        return ids

    def _normalised(self, chunks: Sequence[bytes]) -> list[str]:
        """Chunks as the tokenizer normalises them; plain ones are only lower-cased."""
        found = [c.decode("ascii").lower() if c.isascii() else None for c in chunks]
        wide = [i for i, text in enumerate(found) if text is None]
        for start in range(0, len(wide), TOGETHER):
            some = wide[start : start + TOGETHER]
            joined = SEPARATOR.join(chunks[i].decode("utf-8", "replace") for i in some)
            normal = self.tokenizer.normalizer.normalize_str(joined).split(SEPARATOR)
            if len(normal) != len(some):
                raise ValueError("the tokenizer does not keep chunks apart")
            for i, text in zip(some, normal):
                found[i] = text
        return found

    def _learn(self, chunks: Sequence[bytes]) -> dict[bytes, bytes]:
        whole = self.added.search
        apart = {c: c.decode("utf-8", "replace") for c in chunks if whole(c) or not _common(c)}
        plain = [c for c in chunks if c not in apart]
        ids = {c: self.encode_all(text) for c, text in apart.items()}
        for chunk, text in zip(plain, self._normalised(plain)):
            if text.isalpha():  # the pattern keeps a run of letters whole
                ids[chunk] = self._piece(text)
            else:
                ids[chunk] = b"".join(map(self._piece, self.pattern.findall(text)))
        return ids

    def _known(self, chunks: Sequence[bytes]) -> list[bytes]:
        """The ids of distinct chunks, from memory where they are there."""
        if len(self.chunks) >= MEMO_CHUNKS:
            self.chunks.clear()
        if len(self.pieces) >= MEMO_PIECES:
            self.pieces.clear()
        ids = list(map(self.chunks.get, chunks))
        holes = [i for i, x in enumerate(ids) if x is None]
        new = self._learn([chunks[i] for i in holes])
        for i in holes:
            ids[i] = new[chunks[i]]
        self.chunks.update((c, x) for c, x in new.items() if len(c) <= MEMO_LENGTH)
        return ids

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts one after another, and where each text's ids end (from 0 on).

        Each distinct chunk is looked up once; the texts are put together from them in arrays.
        """
        chunked = pc.ascii_split_whitespace(column.fill_null(""))
        coded = chunked.flatten().dictionary_encode()
        known = self._known(coded.dictionary.cast(pa.large_binary()).to_pylist())
        values = np.frombuffer(b"".join(known), "<u4")
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        codes = coded.indices.to_numpy()
        counts = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(counts)])
        first = (np.cumsum(sizes) - sizes)[codes]
        places = np.repeat(first - ends[:-1], counts) + np.arange(ends[-1])
        borders = np.asarray(chunked.offsets, np.int64)
        return values[places], ends[borders - borders[0]]


@lru_cache(maxsize=1)
def loaded(path: str) -> WordEncoder:
    """One encoder per worker."""
    return WordEncoder(path)


TOKENS = pa.schema([("doc_id", pa.int64()), ("ids", pa.large_binary())])
COUNTS = pa.schema([("id", pa.int64()), ("n", pa.int64())])
PACKED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc", pa.int64()),
        ("control", pa.binary()),
        ("data", pa.binary()),
    ]
)
UNPACKED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids", pa.binary()),
    ]
)
DIGESTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def tokenised(docs: DataFrame, path: str = TOKENIZER, end_id: int = END_ID) -> DataFrame:
    """(doc_id, ids) of every row; ids as 16-bit integers where the vocabulary fits them."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(path)
        kind = "<u2" if max(encoder.size, end_id + 1) <= 1 << 16 else "<u4"
        end = np.array([end_id], kind).tobytes()
        for batch in sized_slices(batches, "text", TOGETHER_BYTES):
            found, ends = encoder.encode(batch.column("text"))
            found = found.astype(kind)
            ids = [found[a:b].tobytes() + end for a, b in zip(ends[:-1], ends[1:])]
            yield batch_of(TOKENS, doc_id=batch.column("doc_id").to_pylist(), ids=ids)

    return exact_columns(docs, "doc_id", "text").mapInArrow(encode, "doc_id bigint, ids binary")


def open_tokens(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The sequences and ranks that ``write_tokens`` has written to a folder."""
    return ordered_files(spark, folder), spark.read.parquet(f"{folder}/ranks")


def write_tokens(
    docs: DataFrame, path: str = TOKENIZER, end_id: int = END_ID, folder: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Write the ids of all documents in ascending doc_id order; the written sequences and ranks.

    They go to a new ``folder``, by default one in the shared folder, and ``open_tokens`` gives them
    again. The sequences are (doc_id, n_tokens, ids_crc, control, data, part, place, before):
    ``before`` is the number of ids of all documents before, (``part``, ``place``) the order in the
    files. The ranks are (rank, id), for each id that occurs.

    ``docs`` has doc_id, text and any other columns. A null or empty text has only the end id;
    rows without doc_id come first; rows with one doc_id follow one another by length and
    checksum, so that repeated rows all appear; an empty table gives an empty one. Texts are
    encoded whole, and a row of the table is a document, whatever its length.

    The ids are encoded once and written aside. Their counts are summed in the tasks before one
    row per id and task is shuffled, and the ranks (one number per vocabulary entry) go to
    every task. Rows are dealt out by ranges of doc_id in packed form.
    """
    spark = docs.sparkSession
    folder = folder or shared_path(spark, "token-corpus")
    size = max(loaded(path).size, end_id + 1)
    kind = "<u2" if size <= 1 << 16 else "<u4"
    tokens = write_aside(tokenised(docs, path, end_id), "token-ids", compression="zstd")

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            data, ends = ragged(batch.column("ids"))
            total += np.bincount(data[ends[0] : ends[-1]].view(kind), minlength=size)
        seen = np.flatnonzero(total)
        yield batch_of(COUNTS, id=seen, n=total[seen])

    counted = (
        tokens.select("ids").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n"))
    )
    counts = np.zeros(size, np.int64)
    for row in counted.collect():  # at most one row per vocabulary entry
        counts[row[0]] = row[1]
    ids = np.argsort(-counts, kind="stable").astype("<u4")
    ranks = np.empty(size, "<u4")
    ranks[ids] = np.arange(size, dtype="<u4")
    used = int(np.count_nonzero(counts))
    table = pa.table({"rank": pa.array(range(used), pa.int64()), "id": pa.array(ids[:used], pa.int64())})
    write_to(spark.createDataFrame(table).coalesce(1), f"{folder}/ranks")

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            data, ends = ragged(batch.column("ids"))
            sizes = np.diff(ends) // np.dtype(kind).itemsize
            control, packed = pack(ranks[data[ends[0] : ends[-1]].view(kind)], sizes)
            yield batch_of(
                PACKED,
                doc_id=batch.column("doc_id").to_pylist(),
                n_tokens=sizes,
                ids_crc=[zlib.crc32(data[a:b]) for a, b in zip(ends[:-1], ends[1:])],
                control=control,
                data=packed,
            )

    rows = tokens.mapInArrow(
        encode, "doc_id bigint, n_tokens bigint, ids_crc bigint, control binary, data binary"
    )
    order = ["doc_id", "n_tokens", "ids_crc"]
    in_order(rows, order, "n_tokens", "token-files", compression="none", folder=folder)
    return open_tokens(spark, folder)


def _ids_by_rank(ranks: DataFrame) -> np.ndarray:
    found = ranks.select("rank", "id").toPandas()  # at most one row per vocabulary entry
    ids = np.zeros(len(found), "<u4")
    ids[found["rank"]] = found["id"]
    return ids


def _decoded(batch: pa.RecordBatch, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of written rows, and where each row's ids end."""
    control, control_ends = ragged(batch.column("control"))
    data, data_ends = ragged(batch.column("data"))
    sizes = np.asarray(batch.column("n_tokens"), np.int64)
    ranks = unpack(
        control[control_ends[0] : control_ends[-1]], data[data_ends[0] : data_ends[-1]], sizes
    )
    return ids[ranks], np.concatenate([[0], np.cumsum(sizes)])


def read_tokens(written: DataFrame, ranks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of written sequences; ids as 32-bit integers."""
    ids = _ids_by_rank(ranks)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, ends = _decoded(batch, ids)
            yield batch_of(
                UNPACKED,
                doc_id=batch.column("doc_id").to_pylist(),
                start=batch.column("before").to_pylist(),
                n_tokens=np.diff(ends),
                ids=[found[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])],
            )

    return written.select("doc_id", "before", "n_tokens", "control", "data").mapInArrow(
        decode, "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def token_digests(written: DataFrame, ranks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) as read back from written sequences."""
    ids = _ids_by_rank(ranks)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found, ends = _decoded(batch, ids)
            yield batch_of(
                DIGESTS,
                doc_id=batch.column("doc_id").to_pylist(),
                start=batch.column("before").to_pylist(),
                n_tokens=np.diff(ends),
                ids_crc32=[zlib.crc32(found[a:b]) for a, b in zip(ends[:-1], ends[1:])],
            )

    return written.select("doc_id", "before", "n_tokens", "control", "data").mapInArrow(
        decode, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
