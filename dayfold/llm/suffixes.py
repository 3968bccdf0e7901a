"""Passages that repeat across documents, by a sorted array of suffixes that hashes compare.

Prefix sums of a polynomial give the hash of any stretch of bytes in one step, so the common
extension of two suffixes is found by binary search over its length, and a comparison costs a few
steps however much they share. A mergesort with that comparison sorts the suffixes; neighbours that
agree for a whole window are the same passage, and their bytes are compared, so that no collision
of hashes counts.

Sorting every suffix of a corpus in one place is out of the question, and most begin no window that
occurs again. So each window (50 bytes) has an *anchor*, the place of the smallest hash of 24 bytes
within it, which depends on the window alone: equal windows have equal anchors at the same
distance. Only anchors whose 24 bytes occur in other documents go on, with the bytes of the
windows that they anchor; they are dealt out by that hash, which is the first step of the sort, and
of each hash the suffixes that other stretches seem to have are then sorted by distance to the
anchor. Equal stretches of bytes are combined in each slice before they are dealt out, with their
smallest doc_id, so that a passage that everybody repeats is one row of a slice.

What is dealt out are packs, not rows: all that a slice has for a bucket of hashes lies in a few
binary values, so that the JVM moves and sorts packs, and hashes and stretches are sorted as arrays.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import Scratch, exact_columns, ragged, text_bytes, whole_groups

# Bytes of a window, and of the part of it whose smallest hash is its anchor.
WINDOW = 50
ANCHOR = 24
# Texts are held in slices of about so many bytes, or a single text more.
SLICE_BYTES = 1 << 21
SLICE_ROWS = 1 << 16
# Windows of a slice that are looked at in one go.
PIECE = 1 << 16
# Stretches of bytes with one hash, above which its windows are dealt out one by one.
LARGE = 1 << 14
# Bytes of text for each bucket of hashes, at most.
BUCKET_BYTES = 1 << 23
# Parts of the buckets that are worked on one after another, so that only a part of what is dealt out
# lies on disk twice at a time.
PARTS = 4
# Repeated hashes that a task puts in lists by slice, about.
LISTED = 1 << 18
# Suffixes sorted in one go, or those of a single hash more.
SORTED = 1 << 17

_DRAW = np.random.default_rng(29)
# A value for each byte, and an odd base, whose powers have inverses modulo 2^64.
BYTES = _DRAW.integers(0, 2**64, 256, dtype=np.uint64)
BASE = int(_DRAW.integers(0, 2**63)) * 2 + 1
INVERSE = pow(BASE, -1, 1 << 64)
# Odd numbers for the words of eight bytes of an anchor or a stretch.
WORDS = _DRAW.integers(0, 2**64, 1 + (2 * WINDOW - ANCHOR) // 8, dtype=np.uint64) | np.uint64(1)
# Anchors have small hashes; times this odd number they are spread out evenly, and can be had back.
SPREAD = np.uint64(0x9E3779B97F4A7C15)
GATHER = np.uint64(pow(int(SPREAD), -1, 1 << 64))


def _powers(base: int, number: int) -> np.ndarray:
    """base^0 .. base^(number - 1) modulo 2^64."""
    powers = np.ones(number, np.uint64)
    done = 1
    while done < number:
        step = np.uint64(pow(base, done, 1 << 64))
        powers[done : 2 * done] = powers[: min(done, number - done)] * step
        done *= 2
    return powers


class Hashes:
    """Hashes of any stretch of some bytes, from prefix sums."""

    _up = _powers(BASE, 1)
    _down = _powers(INVERSE, 1)

    def __init__(self, data: np.ndarray):
        size = len(data) + 1
        if len(Hashes._up) < size:
            room = size + size // 8
            Hashes._up, Hashes._down = _powers(BASE, room), _powers(INVERSE, room)
        self.sums = np.zeros(size, np.uint64)
        np.cumsum(BYTES[data] * Hashes._up[: size - 1], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, lengths) -> np.ndarray:
        return (self.sums[starts + lengths] - self.sums[starts]) * Hashes._down[starts]

    def of_length(self, length: int) -> np.ndarray:
        """The hash of every stretch of a length."""
        count = max(0, len(self.sums) - length)
        return (self.sums[length:] - self.sums[:count]) * Hashes._down[:count]


def views(data: np.ndarray, kind: str) -> np.ndarray:
    """What the bytes from each place on are as values of a kind."""
    data, size = np.ascontiguousarray(data), np.dtype(kind).itemsize
    return np.ndarray(max(0, len(data) - size + 1), kind, data, strides=(1,))


def words(data: np.ndarray) -> np.ndarray:
    """The number that the eight bytes from each place on are."""
    return views(data, "<u8")


def mixed_words(values: np.ndarray, number: int) -> np.ndarray:
    """Hashes of words, by a function for each number."""
    values = values ^ (values >> np.uint64(32))
    values *= WORDS[number]
    values ^= values >> np.uint64(29)
    return values


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, hash, window): the place and hash of the anchor of the windows from ``window`` on.

    Anchors come in order, each with the first window that it anchors; the next anchor's first
    window ends its windows. The hash is of the three words of an anchor.
    """
    parts = mixed_words(words(data), 0)
    mixed = parts[: len(parts) - 16] * WORDS[1]
    mixed += parts[8 : len(parts) - 8]
    mixed *= WORDS[2]
    mixed += parts[16:]
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    # The smallest hash; of equal ones the first.
    low = np.uint64(32)
    lowest = (mixed >> low << low) | np.arange(len(mixed), dtype=np.uint64)
    reach, wanted = 1, WINDOW - ANCHOR + 1
    while reach < wanted:
        step = min(reach, wanted - reach)
        lowest = np.minimum(lowest[: len(lowest) - step], lowest[step:])
        reach += step
    place = (lowest & np.uint64(0xFFFFFFFF)).astype(np.int64)
    window = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[window], mixed[place[window]], window


def _ended(ends: np.ndarray, places: np.ndarray) -> np.ndarray:
    """How many texts end at or before each of some sorted places."""
    return np.cumsum(np.bincount(np.searchsorted(places, ends), minlength=len(places)))[: len(places)]


def anchored(data: np.ndarray, ends: np.ndarray):
    """(text, first, after, anchor, hash) of each anchor of the texts that ``data`` holds.

    The anchored windows begin at ``first`` up to before ``after``; texts end at ``ends``, and no
    window crosses an end.
    """
    out = []
    begins = np.concatenate([[0], ends[:-1]])
    for begin in range(0, max(0, len(data) - WINDOW + 1), PIECE):
        place, value, window = anchors(data[begin : begin + PIECE + WINDOW - 1])
        after = np.append(window[1:], min(PIECE, len(data) - WINDOW + 1 - begin))
        place, window, after = place + begin, window + begin, after + begin
        # Where the windows go over the end of a text, they are told apart by text.
        text, last = _ended(ends, window), _ended(ends, after + WINDOW - 2)
        whole = text == last
        out.append((text[whole], window[whole], after[whole], place[whole], value[whole]))
        over = np.flatnonzero(~whole)
        texts = last[over] - text[over] + 1
        over, one = np.repeat(over, texts), _spread(text[over], texts)
        start = np.maximum(window[over], begins[one])
        stop = np.minimum(after[over], ends[one] - WINDOW + 1)
        some = start < stop
        over = over[some]
        out.append((one[some], start[some], stop[some], place[over], value[over]))
    if not out:
        return tuple(np.zeros(0, kind) for kind in (np.int64,) * 4 + (np.uint64,))
    return tuple(np.concatenate(columns) for columns in zip(*out))


def sliced(docs: DataFrame) -> DataFrame:
    """(slice, size, ids, ends, data): texts put together and compressed."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 33
        pack = zstandard.ZstdCompressor(level=3)
        ids: list[int | None] = []
        held: list[bytes] = []
        size = 0

        def row():
            ends = np.cumsum([len(text) for text in held])
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([size], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([ends.astype("<i8").tobytes()], pa.binary()),
                    pa.array([pack.compress(b"".join(held))], pa.binary()),
                ],
                names=["slice", "size", "ids", "ends", "data"],
            )

        for batch in batches:
            names = batch.column("doc_id").cast(pa.int64()).to_pylist()
            for doc_id, text in zip(names, text_bytes(batch.column("text"))):
                if held and (size + len(text) > SLICE_BYTES or len(held) == SLICE_ROWS):
                    yield row()
                    number += 1
                    ids, held, size = [], [], 0
                ids.append(doc_id)
                held.append(text)
                size += len(text)
        if held:
            yield row()

    plain = exact_columns(docs, "doc_id", "text")
    return plain.mapInArrow(
        cut, "slice bigint, size bigint, ids array<bigint>, ends binary, data binary"
    )


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, ends) of each slice of a batch."""
    unpack = zstandard.ZstdDecompressor()
    for ends, data in zip(batch.column("ends"), batch.column("data")):
        yield (
            np.frombuffer(unpack.decompress(data.as_buffer()), np.uint8),
            np.frombuffer(ends.as_buffer(), "<i8"),
        )


def bucket_count(slices: DataFrame) -> int:
    """How many buckets the hashes of some slices are dealt to: by their size, two a task at least."""
    tasks = int(slices.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = slices.agg(F.sum("size")).first()[0] or 0
    return max(2 * tasks, -(-size // BUCKET_BYTES))


def _bucket_edges(spread: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, edges): the buckets of sorted spread hashes, and where each begins and ends."""
    bucket = ((spread >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])[: len(bucket)])
    return bucket[edges], np.append(edges, len(bucket))


def _packs(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """A binary value of the bytes of each stretch of an array."""
    values = np.ascontiguousarray(values)
    offsets = (edges * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)]
    )


def _unpacked(column: pa.Array | pa.ChunkedArray, kind: str) -> np.ndarray:
    """All packs of a column as one array."""
    data, ends = ragged(column)
    return data[ends[0] : ends[-1]].copy().view(kind)


PACKED = "bucket int, slice bigint, hashes binary, known binary"


def _hash_packs(
    number: int, value: np.ndarray, text: np.ndarray, shape: np.ndarray, buckets: int
) -> pa.RecordBatch:
    """``PACKED`` of a slice: its hashes, each with twice its shapes, plus 1 if texts share it.

    ``shape`` is below 1024 and tells stretches apart, as far as it can.
    """
    spread = value * SPREAD
    # The last bits give way to the shape, so a hash could come twice; it would be looked at for nothing.
    low = np.uint64(10)
    by = (spread >> low << low) | shape.astype(np.uint64)
    order = np.argsort(by)
    by, spread, text = by[order], spread[order], text[order]
    starts = np.flatnonzero(np.concatenate([[True], spread[1:] != spread[:-1]])[: len(spread)])
    several = np.minimum.reduceat(text, starts) != np.maximum.reduceat(text, starts)
    shapes = np.add.reduceat(np.concatenate([[1], (by[1:] != by[:-1]).astype(np.int64)]), starts)
    # A first shape differs from the one before it, which belongs to another hash.
    known = (np.minimum(np.maximum(shapes, 1), 1 << 14) * 2 + several).astype(np.uint16)
    spread = spread[starts]
    bucket, edges = _bucket_edges(spread, buckets)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket),
            pa.array(np.full(len(bucket), number, np.int64)),
            _packs(spread, edges),
            _packs(known, edges),
        ],
        names=["bucket", "slice", "hashes", "known"],
    )


def anchor_hashes(slices: DataFrame, buckets: int) -> DataFrame:
    """The anchor hashes of each slice in packs, see ``PACKED``."""

    def hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, (data, ends) in zip(batch.column("slice").to_pylist(), _opened(batch)):
                text, first, after, anchor, value = anchored(data, ends)
                if len(value):
                    shape = (anchor - first) * (WINDOW - ANCHOR + 1) + after - first - 1
                    yield _hash_packs(number, value, text, shape, buckets)

    return slices.mapInArrow(hashes, PACKED)


def packed_hashes(found: DataFrame, buckets: int) -> DataFrame:
    """``PACKED`` of rows (hash, slice, texts): hashes of slices, with 1 or 2 (or more) texts."""

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            value, number = np.asarray(batch.column("hash")), np.asarray(batch.column("slice"))
            more = np.asarray(batch.column("texts")) > 1
            for one in np.unique(number).tolist():
                own = number == one
                # One text of each hash, and another one where there are several.
                hashes = np.concatenate([value[own], value[own & more]]).view(np.uint64)
                text = np.arange(len(hashes)) >= own.sum()
                yield _hash_packs(one, hashes, text, np.zeros(len(hashes)), buckets)

    return found.mapInArrow(pack, PACKED)


def repeated_hashes(found: DataFrame, large: int = LARGE) -> DataFrame:
    """(slice, hashes, crowded): the anchor hashes of a slice that other texts have as well.

    ``found`` are packs, or rows of a hash each. A hash goes on if a slice has it in several texts,
    or if several slices have it. ``crowded`` are those of more than ``large`` stretches.
    """
    if "bucket" not in found.columns:
        tasks = int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        found = packed_hashes(found, 2 * tasks)

    def repeated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def lists():
            """The hashes found so far by slice, so that no row of one hash goes to the JVM."""
            value, number, crowded = (np.concatenate(columns) for columns in zip(*held))
            order = np.argsort(number, kind="stable")
            value, number, crowded = value[order], number[order], crowded[order]
            starts = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
            before = np.concatenate([[0], np.cumsum(crowded)])
            ends = np.append(starts, len(number))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(number[starts]),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(value)),
                    pa.ListArray.from_arrays(
                        pa.array(before[ends].astype(np.int32)), pa.array(value[crowded])
                    ),
                ],
                names=["slice", "hashes", "crowded"],
            )

        for table in whole_groups(batches, ["bucket"]):
            value = _unpacked(table.column("hashes"), "<u8")
            known = _unpacked(table.column("known"), "<u2").astype(np.int64)
            counts = np.asarray(pc.binary_length(table.column("hashes"))) // 8
            number = np.repeat(np.asarray(table.column("slice")), counts)
            order = np.argsort(value)
            value = value[order]
            starts = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
            sizes = np.diff(np.append(starts, len(value)))
            again = (sizes > 1) | np.logical_or.reduceat(known[order] & 1 > 0, starts)
            crowded = np.add.reduceat(known[order] >> 1, starts) > large
            kept = np.repeat(again, sizes)
            if not kept.any():
                continue
            spread = (value[kept] * GATHER).view(np.int64)
            held.append((spread, number[order[kept]], np.repeat(crowded, sizes)[kept]))
            size += len(spread)
            if size > LISTED:
                yield lists()
                held, size = [], 0
        if size:
            yield lists()

    dealt = found.repartition("bucket").sortWithinPartitions("bucket")
    again = dealt.mapInArrow(
        repeated, "slice bigint, hashes array<bigint>, crowded array<bigint>"
    )
    # As many as the slice has anchors at most.
    return again.groupBy("slice").agg(
        *[F.flatten(F.collect_list(name)).alias(name) for name in ("hashes", "crowded")]
    )


# What a slice has for a bucket: ``items`` distinct stretches, from number ``base`` of the slice on. In
# packs: the spread hash, the smallest and largest doc_id, the length in bytes, how far in the
# anchor is, flags, and the bytes. In a row of its own, without a bucket: where the stretches are in
# the slice.
ITEMS = {"hash": "<u8", "least": "<i8", "most": "<i8", "length": "u1", "before": "u1", "flags": "u1"}
PLACES = {"first": "<i4", "text": "<i4", "often": "<i4", "entry": "<i4", "at": "u1"}
DEALT = ", ".join(
    [
        "part int, bucket int, slice bigint, base int, items int",
        *[f"{name} binary" for name in [*ITEMS, "bytes", *PLACES]],
    ]
)
# Flags: some doc_id is known, some is null, several texts or places have it.
KNOWN, NULL, SEVERAL = 1, 2, 4


def stretch_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hashes of stretches of at least a word, from words one after another; the last ends with them."""
    values, keys = words(data), lengths.astype(np.uint64)
    for number, at in enumerate(range(0, int(lengths.max(initial=0)), 8)):
        keys += mixed_words(values[starts + np.minimum(at, lengths - 8)], number)
    return keys


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the bytes from a on equal those from b on, for lengths of a word at least."""
    values, same = words(data), np.ones(len(a), bool)
    for at in range(0, int(lengths.max(initial=0)), 8):
        step = np.minimum(at, lengths - 8)
        same &= values[a + step] == values[b + step]
    return same


def _known_ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(doc_id, whether there is one)."""
    return np.asarray(column.fill_null(0)), np.asarray(column.is_valid())


def _contained(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ones."""
    if not len(sorted_values):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return sorted_values[place] == values


def _slice_stretches(
    number: int,
    data: np.ndarray,
    ends: np.ndarray,
    ids: pa.Array,
    hashes: np.ndarray,
    crowded: np.ndarray,
    buckets: int,
) -> pa.RecordBatch:
    """``DEALT`` of a slice, from the hashes that other texts have as well.

    Equal stretches of the slice are one entry; an entry is an item, or with a crowded hash an item
    for each of its windows, whose hash then is that of the window.
    """
    text, first, after, anchor, value = anchored(data, ends)
    kept = _contained(np.sort(hashes), value)
    text, first, after, anchor, value = (x[kept] for x in (text, first, after, anchor, value))
    length = after - first + WINDOW - 1
    # Equal bytes hold the same anchor at the same place. Should hashes collide, equal stretches may
    # be several entries.
    key = stretch_keys(data, first, length)
    order = np.argsort(key)
    text, first, length, anchor, value, key = (
        x[order] for x in (text, first, length, anchor, value, key)
    )
    same = (key[1:] == key[:-1]) & (length[1:] == length[:-1])
    pairs = np.flatnonzero(same)
    same[pairs] = same_bytes(data, first[pairs], first[pairs + 1], length[pairs])
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    often = np.diff(np.append(starts, len(first)))
    doc, some = (x[text] for x in _known_ids(ids))
    lowest, highest = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    least = np.minimum.reduceat(np.where(some, doc, highest), starts)
    most = np.maximum.reduceat(np.where(some, doc, lowest), starts)
    flags = np.logical_or.reduceat(some, starts) * KNOWN
    flags |= np.logical_or.reduceat(~some, starts) * NULL
    flags |= (often > 1) * SEVERAL

    single = ~_contained(np.sort(crowded), value[starts])
    cut = np.flatnonzero(~single)
    windows = length[starts[cut]] - WINDOW + 1
    at = _spread(np.zeros(len(cut), np.int64), windows)
    entry = np.concatenate([np.flatnonzero(single), np.repeat(cut, windows)])
    at = np.concatenate([np.zeros(len(entry) - len(at), np.int64), at])
    alone = single[entry]
    begin = first[starts[entry]] + at
    size = np.where(alone, length[starts[entry]], WINDOW)
    spread = np.where(alone, value[starts[entry]], 0)
    spread[~alone] = stretch_keys(data, begin[~alone], size[~alone])
    spread *= SPREAD
    order = np.argsort(spread, kind="stable")
    spread, entry, at, begin, size = (x[order] for x in (spread, entry, at, begin, size))
    bucket, edges = _bucket_edges(spread, buckets)
    items = {
        "hash": spread,
        "least": least[entry],
        "most": most[entry],
        "length": size,
        "before": anchor[starts[entry]] - begin,
        "flags": flags[entry],
    }
    joined = _joined(data, begin, size)
    places = {"first": first, "text": text, "often": often, "entry": entry, "at": at}
    none, rows = pa.nulls(1, pa.binary()), len(bucket)
    columns = [
        pa.array([*(bucket.astype(np.int64) * PARTS // buckets).tolist(), PARTS], pa.int32()),
        pa.array([*bucket.tolist(), None], pa.int32()),
        pa.array(np.full(rows + 1, number, np.int64)),
        pa.array(np.append(edges[:-1], 0).astype(np.int32)),
        pa.array(np.append(np.diff(edges), 0).astype(np.int32)),
        *[
            pa.concat_arrays([_packs(items[name].astype(kind), edges), none])
            for name, kind in ITEMS.items()
        ],
        pa.concat_arrays([_packs(joined, np.concatenate([[0], np.cumsum(size)])[edges]), none]),
        *[
            pa.concat_arrays(
                [pa.nulls(rows, pa.binary()), pa.array([places[name].astype(kind).tobytes()])]
            )
            for name, kind in PLACES.items()
        ],
    ]
    names = [field.split()[0] for field in DEALT.split(", ")]
    return pa.RecordBatch.from_arrays(columns, names=names)


def stretches(slices: DataFrame, wanted: DataFrame, buckets: int) -> DataFrame:
    """``DEALT``: the stretches of each slice around anchors that other texts have as well.

    The bytes of a stretch are the windows of an anchor.
    """

    def take(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (data, ends) in enumerate(_opened(batch)):
                yield _slice_stretches(
                    batch.column("slice")[i].as_py(),
                    data,
                    ends,
                    batch.column("ids")[i].values,
                    np.asarray(batch.column("hashes")[i].values).view(np.uint64),
                    np.asarray(batch.column("crowded")[i].values).view(np.uint64),
                    buckets,
                )

    return slices.join(wanted, ["slice"]).mapInArrow(take, DEALT)


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All places from each start on for its length, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _joined(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of stretches, one or two windows long, one after another."""
    ends = np.cumsum(lengths)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    source, target = views(data, f"V{WINDOW}"), views(out, f"V{WINDOW}")
    # Its first window and its last one.
    target[ends - lengths] = source[starts]
    target[ends - WINDOW] = source[starts + lengths - WINDOW]
    return out


class Suffixes:
    """Suffixes of some bytes, cut off after a window, compared by hashes."""

    def __init__(self, data: np.ndarray):
        self.data, self.hashes = data, Hashes(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes at a and b share, a window at most; by binary search."""
        shared = np.zeros(len(a), np.int64)
        step = 1 << (WINDOW.bit_length() - 1)
        while step:
            longer = shared + step
            fits = longer <= WINDOW
            agree = np.zeros(len(a), bool)
            x, y, size = a[fits], b[fits], longer[fits]
            agree[fits] = self.hashes(x, size) == self.hashes(y, size)
            shared[agree] = longer[agree]
            step >>= 1
        return shared

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at a comes before the one at b, or is equal where that counts."""
        shared = self.common(a, b)
        differ = shared < WINDOW
        out = or_equal.copy()
        x, y = (a + shared)[differ], (b + shared)[differ]
        out[differ] = self.data[x] < self.data[y]
        return out

    def sort(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """The order of the suffixes within each group; ``groups`` is sorted.

        A mergesort from the bottom, all runs of a level at once: the place of a suffix in the
        merged run is its own plus how many of the other run come before it, by binary search.
        """
        order = np.arange(len(starts))
        edges = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]])[: len(groups)])
        sizes = np.diff(np.append(edges, len(groups)))
        begin, end = np.repeat(edges, sizes), np.repeat(edges + sizes, sizes)
        inside = np.arange(len(starts)) - begin
        longest, run = int(sizes.max(initial=0)), 1
        while run < longest:
            own = inside // run
            other = begin + (own ^ 1) * run
            low = np.minimum(other, end)
            high = np.minimum(other + run, end)
            from_, merging = low.copy(), np.flatnonzero(low < high)
            later = (own & 1).astype(bool)  # the second run of a pair gives way to equals
            searched = merging
            while len(searched):
                middle = (low[searched] + high[searched]) // 2
                mine, theirs = starts[order[searched]], starts[order[middle]]
                up = self.before(theirs, mine, later[searched])
                low[searched[up]] = middle[up] + 1
                high[searched[~up]] = middle[~up]
                searched = searched[low[searched] < high[searched]]
            # Moved on by the other run's earlier ones, back by those that it stands behind.
            place = np.arange(len(starts))
            passed = low[merging] - from_[merging]
            place[merging] += passed - np.where(later[merging], run, 0)
            moved = np.empty_like(order)
            moved[place] = order
            order = moved
            run *= 2
        return order

    def windows(self, starts: np.ndarray) -> np.ndarray:
        return views(self.data, f"V{WINDOW}")[starts].view(np.uint8).reshape(-1, WINDOW)

    def equal_neighbours(self, sorted_starts: np.ndarray) -> tuple[np.ndarray, bool]:
        """Which windows equal the next one by hash, and whether their bytes say so as well."""
        a, b = sorted_starts[:-1], sorted_starts[1:]
        full = np.full(len(a), WINDOW)
        equal = self.hashes(a, full) == self.hashes(b, full)
        x, y = a[equal], b[equal]
        step = 1 << 16
        verified = all(
            (self.windows(x[i : i + step]) == self.windows(y[i : i + step])).all()
            for i in range(0, len(x), step)
        )
        return equal, verified

    def sort_windows(
        self, starts: np.ndarray, groups: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """(order, equal): windows sorted in their groups, and which equal the next in their group.

        Where hashes collide, the bytes themselves are sorted.
        """
        order = self.sort(starts, groups)
        equal, verified = self.equal_neighbours(starts[order])
        if not verified:
            whole = np.ascontiguousarray(self.windows(starts)).view(f"S{WINDOW}").ravel()
            order = np.lexsort((whole, groups))
            equal = whole[order[1:]] == whole[order[:-1]]
        return order, equal & (groups[1:] == groups[:-1])


def _least_per_window(table: pa.Table) -> pa.RecordBatch:
    """Runs of windows, with the smallest doc_id that has them, of each stretch of whole buckets.

    Left out are stretches that occur once, with windows that none but themselves has.
    """
    table = table.combine_chunks()
    data, offsets = ragged(table.column("bytes"))
    begins, lengths = offsets[:-1], np.diff(offsets)
    buckets, keys = np.asarray(table.column("hash")), np.asarray(table.column("key"))
    named = np.lexsort((keys, buckets))
    if ((np.diff(keys[named]) == 0) & (np.diff(buckets[named]) == 0)).any():
        raise ArithmeticError("two stretches of bytes have one key")
    before = np.asarray(table.column("before")).astype(np.int64)
    least = table.column("least").combine_chunks()
    some, ids = np.asarray(least.is_valid()), np.asarray(least.fill_null(0))
    number = lengths - WINDOW + 1
    row = np.repeat(np.arange(len(lengths)), number)
    at = _spread(np.zeros(len(number), np.int64), number)
    starts, distance = begins[row] + at, before[row] - at
    # Nulls count only where all are null.
    largest = np.iinfo(np.int64).max
    value, has = np.where(some, ids, largest)[row], some[row]
    # Suffixes at one distance to one anchor are a group. Only windows whose hash comes again in their
    # group can be those of other stretches.
    suffixes = Suffixes(data)
    tag = suffixes.hashes(starts, WINDOW) + distance.astype(np.uint64)
    tag ^= buckets.view(np.uint64)[row] * SPREAD
    order = np.argsort(tag)
    again = tag[order[1:]] == tag[order[:-1]]
    met = np.sort(order[np.concatenate([[False], again]) | np.concatenate([again, [False]])])
    if len(met):
        by_group = met[np.lexsort((distance[met], buckets[row[met]]))]
        bucket, far = buckets[row[by_group]], distance[by_group]
        new = (bucket[1:] != bucket[:-1]) | (far[1:] != far[:-1])
        groups = np.cumsum(np.concatenate([[0], new]))
        order, equal = suffixes.sort_windows(starts[by_group], groups)
        order = by_group[order]
        classes = np.cumsum(np.concatenate([[0], ~equal]))
        edges = np.flatnonzero(np.concatenate([[True], ~equal]))
        value[order] = np.minimum.reduceat(value[order], edges)[classes]
        has[order] = np.logical_or.reduceat(has[order], edges)[classes]
    # Runs of windows of a stretch with one smallest id.
    new = (row[1:] != row[:-1]) | (value[1:] != value[:-1]) | (has[1:] != has[:-1])
    first = np.flatnonzero(np.concatenate([[True], new]))
    after = np.append(first[1:], len(row))
    runs = pa.StructArray.from_arrays(
        [
            pa.array(at[first].astype(np.int16)),
            pa.array((at[after - 1] + 1).astype(np.int16)),
            pa.array(value[first], mask=~has[first]),
        ],
        ["begin", "end", "least"],
    )
    places = np.searchsorted(row[first], np.arange(len(lengths) + 1)).astype(np.int32)
    others = np.asarray(table.column("often")) > 1
    others[row[(value != np.where(some, ids, largest)[row]) | (has != some[row])]] = True
    return pa.RecordBatch.from_arrays(
        [
            table.column("hash").combine_chunks(),
            table.column("key").combine_chunks(),
            pa.ListArray.from_arrays(pa.array(places), runs),
        ],
        names=["hash", "key", "runs"],
    ).filter(pa.array(others))


REPLY = np.dtype([("item", "<i4"), ("begin", "<i2"), ("end", "<i2"), ("least", "<i8")])


def _replies(table: pa.Table) -> pa.RecordBatch | None:
    """(slice, replies) of a bucket: runs of windows of items with the smallest doc_id that has them.

    Left out are runs that no place of the item gives way to.
    """
    numbers = np.asarray(table.column("items")).astype(np.int64)
    items = {name: _unpacked(table.column(name), kind) for name, kind in ITEMS.items()}
    data, length = _unpacked(table.column("bytes"), "u1"), items["length"].astype(np.int64)
    begin = np.cumsum(length) - length
    value, known = items["hash"], items["flags"] & KNOWN > 0
    key = stretch_keys(data, begin, length)
    order = np.lexsort((key, value))
    value, key, length, before = value[order], key[order], length[order], items["before"][order]
    data = _joined(data, begin[order], length)
    begin = np.cumsum(length) - length
    # Should hashes collide, equal stretches may be taken for different ones; their windows are not.
    same = (value[1:] == value[:-1]) & (key[1:] == key[:-1])
    same &= (length[1:] == length[:-1]) & (before[1:] == before[:-1])
    pairs = np.flatnonzero(same)
    same[pairs] = same_bytes(data, begin[pairs], begin[pairs + 1], length[pairs])
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    sizes = np.diff(np.append(starts, len(value)))
    largest = np.iinfo(np.int64).max
    least = np.minimum.reduceat(np.where(known, items["least"], largest)[order], starts)
    some = np.logical_or.reduceat(known[order], starts)
    several = np.logical_or.reduceat(items["flags"][order] & SEVERAL > 0, starts) | (sizes > 1)
    distinct = {
        "hash": value[starts].view(np.int64),
        "begin": begin[starts],
        "length": length[starts],
        "before": before[starts].astype(np.int16),
    }

    # Whole hashes at a time, of about so many windows.
    windows = np.concatenate([[0], np.cumsum(distinct["length"] - WINDOW + 1)])
    hashes = distinct["hash"]
    edges = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1], [True]]))
    found, done = [], 0
    while done < len(edges) - 1:
        most = windows[edges[done]] + SORTED
        until = max(done + 1, int(np.searchsorted(windows[edges], most, "right")) - 1)
        rows = slice(int(edges[done]), int(edges[until]))
        size = distinct["length"][rows]
        packed = _packs(
            _joined(data, distinct["begin"][rows], size), np.concatenate([[0], np.cumsum(size)])
        )
        columns = {
            "hash": hashes[rows],
            "key": np.arange(rows.start, rows.stop),
            "bytes": packed,
            "before": distinct["before"][rows],
            "least": pa.array(least[rows], mask=~some[rows]),
            "often": 1 + several[rows],
        }
        found.append(_least_per_window(pa.table(columns)))
        done = until
    runs = pa.Table.from_batches(found).combine_chunks()
    if not runs.num_rows:
        return None
    lists = runs.column("runs").combine_chunks()
    owner = np.repeat(np.asarray(runs.column("key")), np.asarray(lists.value_lengths()))
    from_, to, lowest = (lists.flatten().field(name) for name in ("begin", "end", "least"))
    there = np.asarray(lowest.is_valid())
    owner, from_, to = owner[there], np.asarray(from_)[there], np.asarray(to)[there]
    lowest = np.asarray(lowest.fill_null(0))[there]

    # From distinct stretches back to items: a stretch's runs follow one another.
    counts = np.bincount(owner, minlength=len(starts))
    reach = (np.cumsum(counts) - counts)[np.repeat(np.arange(len(starts)), sizes)]
    many = np.repeat(counts, sizes)
    run, item = _spread(reach, many), order[np.repeat(np.arange(len(many)), many)]
    later = (items["flags"][item] & NULL > 0) | (lowest[run] < items["most"][item])
    run, item = run[later], item[later]
    # Items of the table are in the order of its rows, each of a slice.
    row = np.repeat(np.arange(len(numbers)), numbers)
    ends = np.cumsum(numbers) - numbers
    base = np.asarray(table.column("base")).astype(np.int64)
    number = np.asarray(table.column("slice"))[row[item]]
    by_slice = np.argsort(number, kind="stable")
    run, item, number = run[by_slice], item[by_slice], number[by_slice]
    out = np.empty(len(run), REPLY)
    out["item"] = item - ends[row[item]] + base[row[item]]
    out["begin"], out["end"], out["least"] = from_[run], to[run], lowest[run]
    new = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])[: len(number)])
    return pa.RecordBatch.from_arrays(
        [pa.array(number[new]), _packs(out, np.append(new, len(number)))],
        names=["slice", "replies"],
    )


def earlier_runs(dealt: DataFrame) -> DataFrame:
    """(slice, replies): what earlier documents have of the stretches of slices, see ``_replies``."""

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, ["bucket"]):
            replies = _replies(table)
            if replies is not None:
                yield replies

    rows = dealt.select("bucket", "slice", "base", "items", *ITEMS, "bytes")
    ordered = rows.repartition("bucket").sortWithinPartitions("bucket")
    return ordered.mapInArrow(sort, "slice bigint, replies binary")


def _covered(size: int, ids: pa.Array, replies: np.ndarray, places: dict) -> np.ndarray:
    """Which bytes of a slice are in windows that earlier documents have."""
    doc, some = _known_ids(ids)
    ends = np.cumsum(places["often"], dtype=np.int64)
    entry = places["entry"][replies["item"]]
    often = places["often"][entry].astype(np.int64)
    place = _spread(ends[entry] - often, often)
    reply = np.repeat(np.arange(len(replies)), often)
    text = places["text"][place]
    earlier = ~some[text] | (replies["least"][reply] < doc[text])
    place, reply = place[earlier], reply[earlier]
    first = places["first"][place].astype(np.int64) + places["at"][replies["item"][reply]]
    turn = np.zeros(size + 1, np.int8)
    if len(first):
        # Runs that overlap or touch are put together, so that each place is a turn once at most.
        begin, end = first + replies["begin"][reply], first + replies["end"][reply] + WINDOW - 1
        order = np.argsort(begin)
        begin, end = begin[order], np.maximum.accumulate(end[order])
        new = begin[1:] > end[:-1]
        turn[begin[np.concatenate([[True], new])]] = 1
        turn[end[np.concatenate([new, [True]])]] = -1
    return np.cumsum(turn[:-1], dtype=np.int8).view(bool)


def remove_repeats(docs: DataFrame, large: int = LARGE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for each row of ``docs``.

    Removes from each text, as UTF-8, every byte that is covered by a string of 50 bytes that also
    starts in a document with a smaller doc_id. Strings are judged on the texts as they are, and
    never cross documents. ``spans`` are the maximal removed runs, as (begin, end) in bytes.

    A null text is empty. Rows with one doc_id are no earlier than one another; a null doc_id is
    later than any other, and no earlier than another null. Texts shorter than the string keep
    everything. Other columns are ignored; an empty table gives none. Texts are processed whole.
    """
    scratch = Scratch(docs.sparkSession)
    slices = scratch.write(sliced(docs), "suffix-slices")
    buckets = bucket_count(slices)
    hashes = repeated_hashes(anchor_hashes(slices, buckets), large)
    wanted = scratch.write(hashes, "suffix-hashes")
    dealt = scratch.write(stretches(slices, wanted, buckets), "suffix-stretches", ["part"])
    scratch.drop(wanted)
    replies = [
        scratch.write(earlier_runs(dealt.where(F.col("part") == part)), "suffix-runs")
        for part in range(PARTS)
    ]
    # As many as the slice has stretches at most.
    earlier = (
        reduce(DataFrame.unionByName, replies)
        .groupBy("slice")
        .agg(F.collect_list("replies").alias("replies"))
    )
    places = dealt.where(F.col("part") == PARTS).select("slice", *PLACES)

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (data, ends) in enumerate(_opened(batch)):
                covered = np.zeros(len(data), bool)
                if batch.column("replies")[i].is_valid:
                    found = _unpacked(batch.column("replies")[i].values, "u1").view(REPLY)
                    own = {
                        name: np.frombuffer(batch.column(name)[i].as_buffer(), kind)
                        for name, kind in PLACES.items()
                    }
                    covered = _covered(len(data), batch.column("ids")[i].values, found, own)
                begins = np.concatenate([[0], ends[:-1]])
                # Runs begin and end where it turns, and with texts.
                edge = np.zeros(len(data) + 1, bool)
                edge[begins], edge[ends] = True, True
                turn = np.diff(covered, prepend=False, append=False) | edge
                first = np.flatnonzero(covered & turn[:-1])
                after = np.flatnonzero(covered & turn[1:]) + 1
                text = np.searchsorted(ends, first, "right")
                runs = np.bincount(text, minlength=len(ends))
                removed = np.bincount(text, after - first, len(ends)).astype(np.int64)
                kept = np.concatenate([[0], np.cumsum(ends - begins - removed)]).tolist()
                left = memoryview(data[~covered])
                digests = [sha256(left[a:b]).hexdigest() for a, b in zip(kept[:-1], kept[1:])]
                places = [first - begins[text], after - begins[text]]
                spans = pa.StructArray.from_arrays([pa.array(p) for p in places], ["begin", "end"])
                until = np.concatenate([[0], np.cumsum(runs)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("ids")[i].values,
                        pa.array(ends - begins),
                        pa.array(removed),
                        pa.array(runs),
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(pa.array(until), spans),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"],
                )

    removed = places.join(earlier, ["slice"])
    return slices.join(removed, ["slice"], "left").mapInArrow(
        cut,
        "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
        "spans array<struct<begin:bigint,end:bigint>>",
    )
