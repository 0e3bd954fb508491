"""Chat formatting: every assistant turn becomes an example of its own, with all turns before it as context."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TARGET = "assistant"
_BATCH_CHARS = 8 << 20
# A turn: "### role: text</turn>\n". A backslash before any of \ # < : takes its meaning away.
_TURN = re.compile(r"### ([^\\:]*(?:\\.[^\\:]*)*): ([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)


def escape(text: str, more: str = "") -> str:
    return re.sub(rf"([\\#<{more}])", r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def parse(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of formatted text; anything else in it is an error."""
    turns, at = [], 0
    while at < len(text):
        found = _TURN.match(text, at)
        if not found:
            raise ValueError("not a formatted conversation")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def examples(conversations: DataFrame) -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end): one row per assistant turn.

    text holds all turns up to the target; the loss mask is the code points [loss_start, loss_end),
    the target's escaped text. What follows the last assistant turn of a conversation, or all of one
    without any, is a row with no mask, so no turn is lost. Null texts and roles are empty; rows
    without conv_id make up one conversation; turns of one number come in the order of role and
    text. Rows of a conversation follow each other within a partition, and are made one by one, so a
    task holds one conversation's text and one batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size, now, prefix, number, tail = 0, ..., "", 0, False

        def packed() -> pa.RecordBatch:
            columns = zip(*rows) if rows else ([],) * 5
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if conv != now:
                    if tail:
                        rows.append((now, number, prefix, None, None))
                        size += len(prefix)
                    now, prefix, number, tail = conv, "", 0, False
                start = f"{prefix}### {escape(role or '', ':')}: "
                body = escape(text or "")
                prefix = f"{start}{body}</turn>\n"
                tail = role != TARGET
                if not tail:
                    rows.append((conv, number, prefix, len(start), len(start) + len(body)))
                    number += 1
                    size += len(prefix)
                if size > _BATCH_CHARS:
                    yield packed()
                    rows, size = [], 0
        if tail:
            rows.append((now, number, prefix, None, None))
        yield packed()

    names = ["conv_id", "example", "text", "loss_start", "loss_end"]
    chosen = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    ordered = chosen.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text")
    return ordered.mapInArrow(run, "conv_id long, example long, text string, loss_start long, loss_end long")


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, what its examples hold: digests of turns and of the text under the loss mask.

    Takes the rows as examples() leaves them: those of a conversation in order, in one partition. Each
    text must begin with the one before it, so only its new turns are parsed.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None

        def closed() -> list:
            return [[state[0]], [state[2]], [state[3].hexdigest()], [state[4]], [state[5].hexdigest()], [state[6]]]

        kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
        for batch in batches:
            done: list[list] = [[] for _ in names]
            for conv, text, start, end in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if state is None or conv != state[0]:
                    if state is not None:
                        done = [a + b for a, b in zip(done, closed())]
                    state = [conv, "", 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                if not text.startswith(state[1]):
                    raise ValueError("an example does not continue the one before it")
                for role, own in parse(text[len(state[1]) :]):
                    state[2] += 1
                    state[3].update(f"{role}\n{own}\n".encode())
                if start is not None:
                    target = unescape(text[start:end])
                    state[4] += len(target)
                    state[5].update(target.encode())
                state[6] += len(text)
                state[1] = text
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(done, kinds)], names)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(closed(), kinds)], names)

    chosen = formatted.select("conv_id", "text", "loss_start", "loss_end")
    return chosen.mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
