"""Chat formatting into a prefix tree.

Conversations that begin with the same turns share them: a turn is a node, named by the digest
of itself and all turns before it, and is written once. A node belongs to the conversation with
the smallest id among those that have it; what a conversation owns is a branch, the end of its
path. Nodes are written depth-first. Each comes with the position of its first token along its
path, and with the intervals of the token sequence that it may attend to: its ancestors', merged
where they lie side by side, so that there are as many as branchings above it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayfold.llm.common import exact_columns, in_order, slices
from dayfold.sinks.shared import write_aside

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
# The template's marks, and the control strings that texts may not contain.
OPEN, CLOSE, END = "<|", "|>", "</s>"
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"
LEARNED_ROLE = "assistant"
# Stands for a missing conversation id; it is larger than any other.
NO_ID = 2**63 - 1

_UNSAFE = re.compile("|".join(map(re.escape, (ESCAPE, *CONTROL))))
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """Break up control strings by a backslash after their first character; double backslashes."""
    return _UNSAFE.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text)


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _ESCAPED.sub(r"\1", text)


@lru_cache(maxsize=1)
def _tokenizer(path: str) -> Tokenizer:
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _step(parent: bytes, role: str, text: str) -> bytes:
    head = role.encode("utf-8", "surrogatepass")
    digest = hashlib.blake2b(parent, digest_size=16)
    digest.update(len(head).to_bytes(8, "little") + head + text.encode("utf-8", "surrogatepass"))
    return digest.digest()


STEPS = pa.schema(
    [
        ("conv", pa.int64()),
        ("depth", pa.int32()),
        ("node", pa.binary()),
        ("role", pa.string()),
        ("text", pa.string()),
    ]
)
SEGMENTS = pa.schema(
    [
        ("conv", pa.int64()),
        ("depth", pa.int32()),
        ("ids", pa.binary()),
        ("n_tokens", pa.int64()),
        ("loss_from", pa.int32()),
        ("loss_to", pa.int32()),
    ]
)


def _steps(conversations: DataFrame) -> DataFrame:
    """(conv, depth, node, role, text): turns numbered along their path; one at a time in memory."""
    rows = exact_columns(conversations, "conv_id", "turn", "role", "text").select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("conv"),
        "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = ["conv", "turn", "role", "text"]

    def chain(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, depth, node = None, 0, b""
        for batch in slices(batches, 4096):
            conv = batch.column("conv").to_pylist()
            depths, nodes = [], []
            turns = zip(conv, batch.column("role").to_pylist(), batch.column("text").to_pylist())
            for own, role, text in turns:
                depth, node = (depth + 1, node) if own == last else (0, b"")
                node, last = _step(node, role, text), own
                depths.append(depth)
                nodes.append(node)
            columns = [conv, depths, nodes]
            yield pa.RecordBatch.from_arrays(
                [
                    *[pa.array(x, f.type) for x, f in zip(columns, STEPS)],
                    batch.column("role"),
                    batch.column("text"),
                ],
                names=STEPS.names,
            )

    return (
        rows.repartition("conv")
        .sortWithinPartitions(*order)
        .mapInArrow(chain, "conv bigint, depth int, node binary, role string, text string")
    )


def _segments(rows: DataFrame, path: str) -> DataFrame:
    """(conv, depth, ids, n_tokens, loss_from, loss_to): each turn between its marks."""

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in slices(batches):
            roles, texts = batch.column("role").to_pylist(), batch.column("text").to_pylist()
            parts = []
            for role, text in zip(roles, texts):
                parts += [OPEN + escape(role) + CLOSE, escape(text), END]
            ids = [e.ids for e in tokenizer.encode_batch(parts, add_special_tokens=False)]
            columns: list[list] = [[], [], [], []]
            for i, role in enumerate(roles):
                head, body, end = ids[3 * i : 3 * i + 3]
                learned = (len(head), len(head) + len(body)) if role == LEARNED_ROLE else (0, 0)
                whole = np.array(head + body + end, "<u4")
                for column, value in zip(columns, (whole.tobytes(), len(whole), *learned)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv"),
                    batch.column("depth"),
                    *[pa.array(c, SEGMENTS.field(2 + i).type) for i, c in enumerate(columns)],
                ],
                schema=SEGMENTS,
            )

    return rows.select("conv", "depth", "role", "text").mapInArrow(
        encode,
        "conv bigint, depth int, ids binary, n_tokens bigint, loss_from int, loss_to int",
    )


def format_conversations(
    conversations: DataFrame, path: str = TOKENIZER
) -> tuple[DataFrame, DataFrame]:
    """The written tree, and which part of it each conversation is.

    The tree has a row per node, in depth-first order of ``start``: (start, n_tokens, ids,
    branch, depth, position, attends, loss_from, loss_to). ``start`` is the place of its first
    token in the whole sequence, ``position`` that along its path; ``attends`` lists the
    intervals (from, to) of the sequence that hold its ancestors; the tokens ``loss_from`` to
    ``loss_to`` of the node are an assistant's text. The paths are (conv, branch, first, last): a
    conversation is the nodes ``first`` to ``last`` of each of these branches, in order.

    ``conversations`` has conv_id, turn, role, text and any other columns. A turn is
    ``<|role|>text</s>``; control strings in texts and roles are escaped. Null texts and roles
    are empty; a null conv_id is a conversation of its own; a null turn comes first; turns with
    one number follow one another by role and text, repeated rows included. An empty table gives
    empty ones. A conversation passes through one task turn by turn; a first turn that a third of
    all conversations share is one row per task in the minimum that finds its owner.
    """
    steps = write_aside(_steps(conversations), "chat-steps")
    # Written, so that the join has shuffles of its own, which can be split where skewed.
    owners = write_aside(
        steps.groupBy("node").agg(F.min("conv").alias("owner")), "chat-owners"
    )
    owned = write_aside(
        steps.select("conv", "depth", "node").join(owners, ["node"]).drop("node"), "chat-owned"
    )
    paths = write_aside(
        owned.groupBy("conv", "owner").agg(
            F.min("depth").alias("first"), F.max("depth").alias("last")
        ),
        "chat-paths",
    )
    # A list per conversation of as many entries as there are branchings along it.
    runs = paths.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("first", "owner"))).alias("_runs")
    )
    later = F.slice("_runs", F.lit(2), F.size("_runs"))
    places = runs.select(
        "conv",
        F.col("_runs")[0]["owner"].alias("tree"),
        F.transform(
            later, lambda r: F.struct((-r["first"]).alias("up"), r["owner"].alias("owner"))
        ).alias("way"),
    )
    own = owned.where(F.col("owner") == F.col("conv")).select("conv", "depth")
    # Written, because the range sort samples what it sorts, which would encode it twice.
    segments = write_aside(_segments(steps.join(own, ["conv", "depth"]), path), "chat-segments")
    segments = segments.join(places, ["conv"])
    written = in_order(segments, ["tree", "way", "depth"], "n_tokens", "chat-order")
    written = written.select(
        "conv", "depth", "ids", "n_tokens", "loss_from", "loss_to", F.col("before").alias("start")
    )
    starts = written.groupBy(F.col("conv").alias("owner")).agg(F.min("start").alias("from"))
    ends = written.select(
        F.col("conv").alias("owner"),
        F.col("depth").alias("last"),
        (F.col("start") + F.col("n_tokens")).alias("to"),
    )
    above = (
        paths.where(F.col("owner") != F.col("conv"))
        .join(ends, ["owner", "last"])
        .join(starts, ["owner"])
        .groupBy("conv")
        .agg(
            F.array_sort(F.collect_list(F.struct("from", "to"))).alias("above"),
            F.sum(F.col("to") - F.col("from")).alias("tokens_above"),
        )
    )
    nothing = F.array().cast("array<struct<from: bigint, to: bigint>>")
    mine = F.when(
        F.col("start") > F.col("from"),
        F.array(F.struct("from", F.col("start").alias("to"))),
    ).otherwise(nothing)
    tree = (
        written.join(starts.withColumnRenamed("owner", "conv"), ["conv"])
        .join(above, ["conv"], "left")
        .select(
            "start",
            "n_tokens",
            "ids",
            F.col("conv").alias("branch"),
            "depth",
            (F.coalesce("tokens_above", F.lit(0)) + F.col("start") - F.col("from")).alias(
                "position"
            ),
            F.concat(F.coalesce("above", nothing), mine).alias("attends"),
            "loss_from",
            "loss_to",
        )
        .repartitionByRange("start")
        .sortWithinPartitions("start")
    )
    return write_aside(tree, "chat-tree"), paths.withColumnRenamed("owner", "branch")


READ = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
        ("formatted_tokens", pa.int64()),
    ]
)


def read_conversations(tree: DataFrame, paths: DataFrame, path: str = TOKENIZER) -> DataFrame:
    """Digests of every conversation as read back from the tree.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    formatted_tokens): of roles and texts, of the text under the loss mask, and of the formatted
    text. Turns stream through a task; only digests are kept.
    """
    nodes = tree.select("branch", "depth", "ids", "loss_from", "loss_to")
    along = paths.join(nodes, ["branch"]).where(
        (F.col("depth") >= F.col("first")) & (F.col("depth") <= F.col("last"))
    )
    rows = along.select("conv", "depth", "ids", "loss_from", "loss_to")

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        current, state = None, None

        def finished(conv, s):
            values = (
                None if conv == NO_ID else conv, s[0], s[1].hexdigest(), s[2],
                s[3].hexdigest(), s[4], s[5],
            )
            return [pa.array([v], f.type) for v, f in zip(values, READ)]

        for batch in slices(batches, 1024):
            convs = batch.column("conv").to_pylist()
            ids = [np.frombuffer(x, "<u4").tolist() for x in batch.column("ids").to_pylist()]
            learned = list(
                zip(batch.column("loss_from").to_pylist(), batch.column("loss_to").to_pylist())
            )
            whole = tokenizer.decode_batch(ids, skip_special_tokens=False)
            masked = tokenizer.decode_batch(
                [own[a:b] for own, (a, b) in zip(ids, learned)], skip_special_tokens=False
            )
            done = []
            for conv, own, text, loss in zip(convs, ids, whole, masked):
                if conv != current:
                    if state is not None:
                        done.append(finished(current, state))
                    current, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                head, _, rest = text[len(OPEN) :].partition(CLOSE)
                turn = f"{unescape(head)}\n{unescape(rest[: -len(END)])}\n"
                plain = unescape(loss)
                state[0] += 1
                state[1].update(turn.encode("utf-8", "surrogatepass"))
                state[2] += len(plain)
                state[3].update(plain.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
                state[5] += len(own)
            for columns in done:
                yield pa.RecordBatch.from_arrays(columns, schema=READ)
        if state is not None:
            yield pa.RecordBatch.from_arrays(finished(current, state), schema=READ)

    return (
        rows.repartition("conv")
        .sortWithinPartitions("conv", "depth")
        .mapInArrow(
            read,
            "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
            "loss_sha256 string, formatted_chars bigint, formatted_tokens bigint",
        )
    )
