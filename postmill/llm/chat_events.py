"""Chat formatting from event logs: fold the events of each conversation into messages, then render them.

A log is dealt out by conversation and sorted on the executors; the fold reads it as a stream and keeps one open
message, so a conversation of any length needs little memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Marks of the template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
#: Events: ``start`` opens a message with a role and its first text, ``delta`` adds text, ``edit`` replaces the text,
#: ``regenerate`` empties it to be streamed anew. The last two also withdraw all later turns logged until then.
KINDS = ("start", "delta", "edit", "regenerate")
_ROWS = 1024


def escape(text: str) -> str:
    """Break every control string: ``<`` and bars get one more backslash between them."""
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(role: str, text: str) -> str:
    name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))
    return f"{OPEN}{name}\n{escape(text)}{CLOSE}\n"


def parse(rendered: str) -> tuple[str, str]:
    """Role and text of a rendered message."""
    name, body = rendered[len(OPEN):-len(CLOSE) - 1].split("\n", 1)
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(name)), unescape(body)


def fold(events: Iterable[tuple]) -> Iterator[tuple]:
    """Events (conversation, turn, seq, kind, role, text), sorted by the first three, to (conversation, turn, role, text).

    A turn is rewritten by its own later edits, and void before the last edit of any earlier turn. As turns come in
    order, the number of that edit is all that is carried from turn to turn.
    """
    conv = turn = object()
    voided = rewritten = None  # last edit below this turn, last edit at it
    message = None  # role, parts

    def closed():
        return [(conv, turn, message[0], "".join(message[1]))] if message else []

    for c, t, seq, kind, role, text in events:
        if c != conv or t != turn:
            yield from closed()
            message = None
            if c != conv:
                voided = None
            elif rewritten is not None:
                voided = rewritten if voided is None else max(voided, rewritten)
            conv, turn, rewritten = c, t, None
        if kind in ("edit", "regenerate"):
            rewritten = seq
        if voided is not None and seq < voided:
            continue
        if kind == "start":
            yield from closed()
            message = (role, [text])
        elif message is not None:
            if kind in ("edit", "regenerate"):
                message = (message[0], [text if kind == "edit" else ""])
            else:
                message[1].append(text)
    yield from closed()


def messages(events: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text, rendered, loss_start, loss_end), in order within each conversation.

    Events have conv_id, turn, seq, kind, role, text. loss_start and loss_end bound the part of ``rendered``
    that a model is trained on, in code points: assistant texts, empty elsewhere. Null roles and texts are empty;
    null conversations form one, null turns and sequence numbers come first (as the lowest number), and events that
    agree in both are taken in the order of kind (starts first), role and text. Deltas and edits without a started
    message, and unknown kinds, are ignored. Other columns are ignored.
    """
    lowest = F.lit(-(1 << 63))
    rank = F.coalesce(*[F.when(F.col("kind") == k, i) for i, k in enumerate(KINDS)])
    source = events.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.coalesce(F.col("turn").cast("bigint"), lowest).alias("turn"),
        F.coalesce(F.col("seq").cast("bigint"), lowest).alias("seq"), "kind", rank.alias("rank"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    ).where("rank IS NOT NULL")
    ordered = source.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "seq", "rank", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv_id", "turn", "seq", "kind", "role", "text")
        rows = (row for b in batches for row in zip(*(b.column(n).to_pylist() for n in names)))
        for block in _blocks(fold(rows)):
            rendered = [render(r, t) for _, _, r, t in block]
            ends = [len(x) - len(CLOSE) - 1 for x in rendered]
            starts = [e - len(escape(t)) if r == "assistant" else e for e, (_, _, r, t) in zip(ends, block)]
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in block], pa.int64()), pa.array([x[1] for x in block], pa.int64()),
                pa.array([x[2] for x in block], pa.string()), pa.array([x[3] for x in block], pa.string()),
                pa.array(rendered, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64()),
            ], names=["conv_id", "turn", "role", "text", "rendered", "loss_start", "loss_end"])

    return ordered.mapInArrow(run, "conv_id bigint, turn bigint, role string, text string, rendered string, "
                                   "loss_start bigint, loss_end bigint")


def _blocks(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    block: list[tuple] = []
    for row in rows:
        block.append(row)
        if len(block) == _ROWS:
            yield block
            block = []
    if block:
        yield block


def digests(formatted: DataFrame) -> DataFrame:
    """What a reader gets back from the rendered messages, one row per conversation.

    Rows (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars). Expects the output of
    ``messages``, whose tasks hold whole conversations in order; digests are updated message by message.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        conv = object()
        state: list = []
        for b in batches:
            for c, rendered, low, high in zip(*(b.column(n).to_pylist() for n in ("conv_id", "rendered", "loss_start", "loss_end"))):
                if c != conv:
                    if state:
                        yield (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(rendered)
                trained = unescape(rendered[low:high])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(trained)
                state[3].update(trained.encode())
                state[4] += len(rendered)
        if state:
            yield (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(read(batches)):
            yield pa.RecordBatch.from_arrays([pa.array(col, k) for col, k in zip(zip(*block), kinds)], names=names)

    return formatted.select("conv_id", "rendered", "loss_start", "loss_end").mapInArrow(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, "
             "formatted_chars bigint")


def stored_turns(conversations: DataFrame) -> DataFrame:
    """Events of a table with one row per turn (conv_id, turn, role, text): each row starts a whole message."""
    return conversations.select(
        "conv_id", "turn", F.col("turn").alias("seq"), F.lit("start").alias("kind"), "role", "text")
