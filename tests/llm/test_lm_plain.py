"""The lattice score against a plain one: the same fit and recursion, word by word."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
import sentencepiece

from dayfold.llm import lm_score

KINDS = "doc_id bigint, text string"


def arcs_of(text, pieces):
    """(start, end, pieces) of every arc: a known piece, or a character in bytes."""
    arcs = []
    for start in range(len(text)):
        arcs.append((start, start + 1, [("byte", b) for b in text[start].encode()]))
        for end in range(start + 1, len(text) + 1):
            if text[start:end] in pieces:
                arcs.append((start, end, [text[start:end]]))
    return arcs


def sums(arcs, size, chance):
    """Probability of each beginning and of each end of a word, over all ways to cut it."""
    ahead, back = [1.0] + [0.0] * size, [0.0] * size + [1.0]
    for start, end, used in sorted(arcs, key=lambda a: a[1]):
        ahead[end] += ahead[start] * math.prod(chance[p] for p in used)
    for start, end, used in sorted(arcs, key=lambda a: -a[0]):
        back[start] += back[end] * math.prod(chance[p] for p in used)
    return ahead, back


def plain_scores(rows):
    model = sentencepiece.SentencePieceProcessor(model_file=lm_score.VOCABULARY)
    pieces = {
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    every = [*pieces, *[("byte", b) for b in range(256)]]
    words = [(text or "").encode().lower().split() + [b""] for _, text in rows]
    learned = [zlib.crc32(str(doc_id).encode()) % 7 != 2 for doc_id, _ in rows]
    counts = Counter(w for own, taken in zip(words, learned) if taken for w in own)
    lattice = {
        w: arcs_of("▁" + w.decode(), pieces) for own in words for w in own
    }
    chance = dict.fromkeys(every, 1 / len(every))
    for _ in range(lm_score.ROUNDS):
        expected = defaultdict(float)
        for word in counts.keys() - {b""}:
            size = len(word.decode()) + 1
            ahead, back = sums(lattice[word], size, chance)
            for start, end, used in lattice[word]:
                share = math.prod(chance[p] for p in used) * ahead[start] * back[end] / ahead[size]
                for piece in used:
                    expected[piece] += share
        total = sum(expected.values()) + lm_score.SMOOTH * len(every)
        chance = {p: (expected[p] + lm_score.SMOOTH) / total for p in every}
    tokens, often = sum(counts.values()), Counter(counts.values())
    discount = (often[1] + 0.5) / (often[1] + 2 * often[2] + 1)

    def log_of(word):
        if word == b"":
            return math.log10((max(counts[word], 1) - discount) / tokens)
        size = len(word.decode()) + 1
        found = sums(lattice[word], size, chance)[0][size] * discount * len(counts) / tokens
        return math.log10(found + max(counts[word] - discount, 0.0) / tokens)

    return [(len(own), sum(map(log_of, own))) for own in words]


def test_score_against_a_plain_lattice(spark):
    lines = ["The cat sat on the mat", "a CAT and a dog é世", "dogs sat, cats sat", "unheard-of zq"]
    rows = [(i, lines[i % 4] + (f" extra{i % 5}" if i % 3 else "")) for i in range(24)]
    rows += [(100, None), (101, ""), (None, "the null one"), (3, lines[3] + " again")]
    docs = spark.createDataFrame([(d, t) for d, t in rows], KINDS)
    found = sorted((r.n_tokens, r.score) for r in lm_score.score_documents(docs).collect())
    for own, plain in zip(found, sorted(plain_scores(rows)), strict=True):
        assert own[0] == plain[0] and own[1] == pytest.approx(plain[1], rel=1e-9)
