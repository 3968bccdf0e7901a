"""Spelling variants: words one edit apart, found by pivotal bigrams.

A word is the bag of its bigrams with their positions. Bigrams are ranked from rare to frequent. A
word's *prefix* are its rarest three, with all that tie with the third; its *pivots* are two of them
that share no letter, chosen by dynamic programming to be as rare as possible together. One edit
leaves one of two disjoint bigrams alone. So of two words one edit apart, the one whose prefix ends
earlier in the ranking (or as early) has a pivot that is in the other's prefix, moved by one place
at most. The edit lies on one side of that bigram, and what lies on the other side is equal: pivots
meet prefixes on the bigram and on all of the word to its left, or all of it to its right, which
fixes the position. What meets is verified.

Where many words meet on the same key, they meet again on what is left of the other side when one
letter is deleted, which two words one edit apart have in common; no bucket is compared pair by
pair that is not small.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dayfold.llm.common import Scratch, exact_columns, slices, text_bytes

# The letters of a word, which occurrences lose one, what counts as a word.
LEAST_LENGTH = 7
LETTERS = re.compile(f"[A-Za-zÀ-ÿ]{{{LEAST_LENGTH},}}")
LOST_IN = 31
LEAST_COUNT = 2
FORM_FACTOR = 10

EDITS = 1
GRAM = 2
PIVOTS = EDITS + 1
PREFIX = GRAM * EDITS + 1
# Meetings of pivots with prefixes on one key, above which they meet on deletions as well.
LARGE = 4096
# Words counted in one go by a task.
TASK_WORDS = 200_000

LEFT, RIGHT = 0, 1


def words_of(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts with how often they occur."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in slices(batches):
            ids = batch.column("doc_id").cast(pa.string()).to_pylist()
            for doc_id, text in zip(ids, text_bytes(batch.column("text"))):
                # Bytes are lower-cased in A-Z only. Shorter runs cannot become words.
                start = zlib.crc32(f"{doc_id or ''}:".encode())
                for run, n in Counter(LETTERS.findall(text.lower().decode())).items():
                    checksum = zlib.crc32(run.encode(), start)
                    if checksum % LOST_IN == 0:
                        place = checksum % len(run)
                        run = run[:place] + run[place + 1 :]
                        if len(run) < LEAST_LENGTH:
                            continue
                    counts[run] += n
            if len(counts) > TASK_WORDS:
                yield _counted(counts)
                counts.clear()
        yield _counted(counts)

    plain = exact_columns(docs, "doc_id", "text")
    counted = plain.mapInArrow(count, "word string, n bigint").groupBy("word").agg(
        F.sum("n").alias("n")
    )
    return counted.where(F.col("n") >= LEAST_COUNT)


def _counted(counts: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
        names=["word", "n"],
    )


def gram_ranks(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Bigram to (rank, how many words have it), from rare to frequent.

    There are at most as many bigrams as pairs of the 90 letters that a word can have.
    """
    places = F.sequence(F.lit(1), F.length("word") - (GRAM - 1))
    grams = words.select(
        F.explode(
            F.array_distinct(
                F.transform(places, lambda i: F.substr("word", i, F.lit(GRAM)))
            )
        ).alias("gram")
    )
    found = grams.groupBy("gram").agg(F.count("*").alias("often")).collect()
    ordered = sorted(found, key=lambda row: (row["often"], row["gram"]))
    return {row["gram"]: (rank, row["often"]) for rank, row in enumerate(ordered)}


def prefix_of(word: str, ranks: dict[str, tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(place, rank, how often) of the rarest bigrams by place, with all that tie with the last."""
    grams = [(i, *ranks[word[i : i + GRAM]]) for i in range(len(word) - GRAM + 1)]
    last = sorted(rank for _, rank, _ in grams)[PREFIX - 1]
    return [gram for gram in grams if gram[1] <= last]


def pivots_of(prefix: Sequence[tuple[int, int, int]], number: int = PIVOTS) -> list[int]:
    """The places of ``number`` disjoint bigrams of a prefix with the least words in total.

    ``best[k]`` is the lightest choice of k bigrams among those seen so far, as (weight, places);
    a bigram can follow the choices that end before it begins.
    """
    best: list[list[tuple[int, list[int]]]] = []  # per bigram, by place
    for place, _, often in prefix:
        before = next((b for (p, _, _), b in zip(reversed(prefix[: len(best)]), reversed(best))
                       if p + GRAM <= place), [(0, [])])
        here = list(best[-1]) if best else [(0, [])]
        for k, (weight, places) in enumerate(before[:number]):
            taken = (weight + often, [*places, place])
            if k + 1 == len(here):
                here.append(taken)
            elif taken[0] < here[k + 1][0]:
                here[k + 1] = taken
        best.append(here)
    return best[-1][number][1]


def keys_of(words: DataFrame, ranks: dict[str, tuple[int, int]]) -> DataFrame:
    """(word, n, last, pivot, key, side, size): what words meet on.

    ``key`` is a hash of a bigram of the prefix and all that is left (or right) of it, ``size`` how
    long the word is on the other side, ``last`` the rank at which the prefix ends, ``pivot``
    whether the bigram is one of the pivots.
    """

    def keys(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            place, last, pivot, key, side, size = [], [], [], [], [], []
            for i, word in enumerate(batch.column("word").to_pylist()):
                prefix = prefix_of(word, ranks)
                pivots = pivots_of(prefix)
                end = max(rank for _, rank, _ in prefix)
                for at, _, _ in prefix:
                    place += [i, i]
                    last += [end, end]
                    pivot += [at in pivots] * 2
                    # The bigram is the end of the one part, or the beginning of the other.
                    after = at + GRAM
                    key.append(xxhash.xxh3_64_intdigest(word[:after].encode(), LEFT))
                    key.append(xxhash.xxh3_64_intdigest(word[at:].encode(), RIGHT))
                    side += [LEFT, RIGHT]
                    size += [len(word) - after, at]
            rows = pa.array(place, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("word").take(rows),
                    batch.column("n").take(rows),
                    pa.array(last, pa.int32()),
                    pa.array(pivot, pa.bool_()),
                    pa.array(np.array(key, np.uint64).view(np.int64)),
                    pa.array(side, pa.int8()),
                    pa.array(size, pa.int32()),
                ],
                names=["word", "n", "last", "pivot", "key", "side", "size"],
            )

    return words.mapInArrow(
        keys, "word string, n bigint, last int, pivot boolean, key bigint, side tinyint, size int"
    )


def _with_deletions(keys: DataFrame) -> DataFrame:
    """A row for the other side as it is, and one for it with each of its letters deleted.

    The key becomes a hash of the old one and of that text. Two texts one edit apart share one: the
    shorter as it is, or what both are without the letter that differs.
    """

    def delete(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            place, key = [], []
            columns = (batch.column(name).to_pylist() for name in ("word", "key", "side", "size"))
            for i, (word, old, side, size) in enumerate(zip(*columns)):
                rest = word[len(word) - size :] if side == LEFT else word[:size]
                variants = {rest, *(rest[:j] + rest[j + 1 :] for j in range(size))}
                place += [i] * len(variants)
                seed = old % 2**64
                key += [xxhash.xxh3_64_intdigest(v.encode(), seed) for v in sorted(variants)]
            out = batch.take(pa.array(place, pa.int64()))
            at = out.schema.get_field_index("key")
            yield out.set_column(at, "key", pa.array(np.array(key, np.uint64).view(np.int64)))

    return keys.mapInArrow(delete, keys.schema)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced letter makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    size = len(a)
    start = 0
    while start < size and a[start] == b[start]:
        start += 1
    return a[start + (len(a) == len(b)) :] == b[start + 1 :]


def _meet(keys: DataFrame) -> DataFrame:
    """Verified pairs (word, n, near, near_n) among the words that share a key."""
    pivots = keys.where("pivot").select(
        "key",
        F.col("word").alias("near"),
        F.col("n").alias("near_n"),
        F.col("last").alias("near_last"),
        F.col("size").alias("near_size"),
    )
    met = keys.select("key", "word", "n", "last", "size").join(pivots, ["key"])
    met = met.where(
        (F.col("near_last") <= F.col("last"))
        & (F.abs(F.col("size") - F.col("near_size")) <= EDITS)
        & (F.col("word") != F.col("near"))
    ).select("word", "n", "near", "near_n")

    def verify(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, near = batch.column("word").to_pylist(), batch.column("near").to_pylist()
            yield batch.filter(pa.array(list(map(one_edit, words, near)), pa.bool_()))

    return met.mapInArrow(verify, met.schema)


def near_pairs(words: DataFrame, scratch: Scratch, large: int = LARGE) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words`` (word, n) one edit apart, in both directions."""
    keys = scratch.write(keys_of(words, gram_ranks(words)), "spelling-keys")
    pivots = F.count_if("pivot")
    heavy = keys.groupBy("key").agg((F.count("*") * pivots).alias("meetings"))
    heavy = scratch.write(heavy.where(F.col("meetings") > large).select("key"), "spelling-heavy")
    light = scratch.write(_meet(keys.join(heavy, ["key"], "left_anti")), "spelling-pairs")
    crowded = scratch.write(keys.join(heavy, ["key"], "left_semi"), "spelling-crowded")
    scratch.drop(keys, heavy)
    found = scratch.write(_meet(_with_deletions(crowded)), "spelling-pairs")
    scratch.drop(crowded)
    pairs = light.unionByName(found)
    turned = pairs.select(
        F.col("near").alias("word"),
        F.col("near_n").alias("n"),
        F.col("word").alias("near"),
        F.col("n").alias("near_n"),
    )
    return pairs.unionByName(turned).distinct()


def spelling_variants(docs: DataFrame, large: int = LARGE) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word with the frequent word it is a variant of.

    Words are the maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF in whole texts,
    lower-cased in A-Z, of at least seven letters, that occur at least twice. With h the checksum
    (crc32) of ``<doc_id>:<run>``, a run with h divisible by 31 counts without its letter number
    h modulo its length. Two words are near when one inserted, deleted or replaced letter makes one
    of the other. ``form`` is the near word that occurs most (of equals the smallest), if it does so
    at least ten times as often; ``root`` is where following forms leads.

    A null text has no words, a null doc_id is written as nothing, repeated rows count as often as
    they come. Other columns are ignored; an empty table, or one without words, gives none. Texts
    are read whole.
    """
    scratch = Scratch(docs.sparkSession)
    words = scratch.write(words_of(docs), "spelling-words")
    near = near_pairs(words, scratch, large)
    best = F.min(F.struct((-F.col("near_n")).alias("_less"), "near"))
    most = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known = words.join(most, ["word"], "left")
    often = -F.col("best._less")
    follows = often >= FORM_FACTOR * F.col("n")
    known = known.select(
        "word",
        F.when(follows, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(follows, often).alias("form_n"),
    )
    known = scratch.write(known, "spelling-forms")
    roots = _roots(known.where(F.col("form").isNotNull()).select("word", "form"), scratch)
    return known.join(roots, ["word"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(word, root): where the links (word, form) lead.

    Every round doubles how far a word looks. A form occurs ten times as often as its word, so
    chains are as short as counts have digits.
    """
    reached = scratch.write(
        links.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")),
        "spelling-roots",
    )
    while not reached.where("moved").isEmpty():
        onward = reached.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        further = reached.select("word", "root").join(onward, ["root"], "left")
        last, reached = reached, scratch.write(
            further.select(
                "word",
                F.coalesce("_next", "root").alias("root"),
                F.col("_next").isNotNull().alias("moved"),
            ),
            "spelling-roots",
        )
        scratch.drop(last)
    return reached.select("word", "root")
