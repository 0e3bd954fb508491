"""Substring dedup by words: winnowed seeds, extended both ways to the repeats over a threshold."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.spark import block_count, by_blocks, planned_bytes, written
from tickwell.llm.text import Spans, byte_spans, split_words
from tickwell.llm.windows import Contexts, Lookup, covered, doc_ids, packed_rows, parts, report_recurring, runs, settled, summed, unpacked_windows

LENGTH = 13
SEED = 8
BLOCK_BYTES = 24 << 20
_PART_BYTES = 2 << 20
_RESULT = "doc_id long, n_words long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept_text string"
_FIELDS = [
    pa.field("kind", pa.int32()), pa.field("block", pa.int64()), pa.field("doc_id", pa.int64()), pa.field("n_words", pa.int64()),
    pa.field("n_removed", pa.int64()), pa.field("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    pa.field("kept_sha256", pa.string()), pa.field("kept_text", pa.string()), pa.field("text", pa.string()),
    pa.field("state", pa.binary()), pa.field("range", pa.int64()), pa.field("data", pa.binary()),
]
_WRITTEN = f"kind int, block long, {_RESULT}, text string, state binary, range long, data binary"
_RESULT_FIELDS = _FIELDS[2:8]
DONE, PENDING, WINDOW = 0, 1, 2


class Words:
    """The words of some texts and, of each text, where its words begin among them."""

    def __init__(self, texts: list[bytes]):
        self.raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        self.starts, self.ends = split_words(self.raw)
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        self.bounds = np.searchsorted(self.starts, begins)

    def hashes(self, seed: int) -> np.ndarray:
        return byte_spans(self.raw, seed).of(self.starts, self.ends)


def _read(length: int, seed: int):
    def read(texts: list[bytes]) -> Contexts:
        words = Words(texts)
        return Contexts(words.hashes(13), words.bounds, length, seed)

    return read


def _kept(text: bytes, gone: np.ndarray | None, with_text: bool) -> list:
    """n_words, n_removed, spans, digest and, if asked for, text of what is left."""
    words = text.split()
    if gone is None or not gone.any():
        left, removed, spans = b" ".join(words), 0, []
    else:
        left = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
        removed = int(gone.sum())
        spans = [{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in runs(gone)))]
    return [len(words), removed, spans, hashlib.sha256(left).hexdigest(), left.decode() if with_text else None]


def _earlier(low: np.ndarray, high: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that another text holds first, with the least doc_id."""
    least = np.full(groups, np.iinfo(np.int64).max)
    np.minimum.at(least, group, low)
    return high > least[group], least[group]


def dedup(docs: DataFrame, length: int = LENGTH, seed: int = SEED, with_text: bool = False, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept_sha256, kept_text) of every row.

    Words covered by a window of `length` words that also starts in a text with a smaller doc_id
    are removed; spans are the removed word ranges, maximal ones. Windows are judged on the input.
    Null texts have no words; rows without doc_id come after all others; rows that share a doc_id do
    not remove from each other. kept_text is null unless with_text.

    Seeds are anchors, spans of `seed` words that each window selects by hash, with their context:
    the stretch of all neighbouring windows that select them. Joined on the anchor and the
    context's hash, contexts that equal one of a smaller doc_id are removed whole. An anchor with different
    contexts is extended window by window: the first holders of its contexts look up the hashes (128
    bits) of their windows. Copies therefore cost one row a block, and windows are looked up only at the
    edges of repeats.
    """
    blocked = by_blocks(docs, id_col, text_col, BLOCK_BYTES)
    read = _read(length, seed)
    blocks = block_count(docs, BLOCK_BYTES)
    bits = min(56, max(24, planned_bytes(docs).bit_length() + 5))  # so that few anchors share them by chance
    rows = summed(report_recurring(blocked, read, blocks, bits, _PART_BYTES))
    rows = rows.filter("anchor_low < anchor_high and (several or high > context_low)")
    rows = rows.select("block", "anchor", "context", "context_low", "several")

    def extend(left: pa.Table, right: pa.Table) -> pa.Table:
        table = Lookup(right["anchor"].to_numpy(), right["context"].to_numpy())
        least = np.append(right["context_low"].to_numpy(), np.iinfo(np.int64).max)
        several = np.append(right["several"].to_numpy(zero_copy_only=False), False).astype(bool)
        block = left["block"][0].as_py() if len(left) else None
        ids = doc_ids(left["doc_id"].combine_chunks())
        texts = [(t or "").encode() for t in left["text"].to_pylist()]
        made: list[list] = [[] for _ in _FIELDS]
        found: list[tuple[np.ndarray, ...]] = []
        for part in parts(texts, _PART_BYTES):
            words = Words(texts[part])
            values = words.hashes(13)
            contexts = Contexts(values, words.bounds, length, seed)
            row = table(contexts.anchor, contexts.context)
            crowd = table.crowded(contexts.anchor) >= 0
            who = ids[part][contexts.of]
            state = np.where((row >= 0) & (least[row] < who), 1, np.where(((row >= 0) & several[row]) | crowd, 2, 0)).astype(np.uint8)
            state = contexts.spread(state)
            state = np.append(state, np.zeros(len(values) - len(state), np.uint8))  # one per word
            open_ = np.flatnonzero(state == 2)
            if len(open_):
                ends = open_ + length
                owners = ids[part][contexts.text[open_]]
                found.append((Spans(values).of(open_, ends), Spans(words.hashes(17)).of(open_, ends), owners))
            for i, text in enumerate(texts[part]):
                own = state[words.bounds[i] : words.bounds[i + 1]]
                doc_id = left["doc_id"][part.start + i].as_py()
                if (own == 2).any():
                    values_ = [PENDING, block, doc_id, None, None, None, None, None, text.decode(), zlib.compress(own.tobytes(), 1)]
                else:
                    gone = covered(own == 1, length, len(own) + length)[: len(own)] if own.any() else None
                    values_ = [DONE, block, doc_id, *_kept(text, gone, with_text), None, None]
                for column, value in zip(made, [*values_, None, None]):
                    column.append(value)
        tables = [pa.table([pa.array(c, f.type) for c, f in zip(made, _FIELDS)], schema=pa.schema(_FIELDS))]
        if found:
            h1, h2, who = (np.concatenate(c) for c in zip(*found))
            order = np.lexsort((who, h2, h1))
            h1, h2, who = h1[order], h2[order], who[order]
            starts = np.flatnonzero(np.append(True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
            ends = np.append(starts[1:], len(h1)) - 1
            rows_ = packed_rows(block, blocks, h1[starts], h2[starts], who[starts], who[ends])
            given = {"kind": [WINDOW] * len(rows_), **{n: [r[i] for r in rows_] for i, n in enumerate(("block", "range", "data"))}}
            columns = [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(len(rows_), f.type) for f in _FIELDS]
            tables.append(pa.table(columns, schema=pa.schema(_FIELDS)))
        return pa.concat_tables(tables)

    sides = [blocked.groupBy("block"), rows.groupBy("block")]
    del blocked, rows  # nothing but the plan itself may hold on to its shuffles once it is written
    stored = written(sides.pop(0).cogroup(sides.pop(0)).applyInArrow(extend, _WRITTEN), "repeats")
    lookups = settled(stored.filter(F.col("kind") == WINDOW).select("block", "range", "data"), _earlier)
    pending = stored.filter(F.col("kind") == PENDING).select("block", "doc_id", "text", "state")

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        h1, h2, first_in = unpacked_windows(right["data"].to_pylist(), 3)
        table = Lookup(h1, h2)
        least = np.append(first_in.view(np.int64), np.iinfo(np.int64).max)
        ids = doc_ids(left["doc_id"].combine_chunks())
        texts = [t.encode() for t in left["text"].to_pylist()]
        states = [np.frombuffer(zlib.decompress(s), dtype=np.uint8) for s in left["state"].to_pylist()]
        made: list[list] = [[] for _ in _RESULT_FIELDS]
        for part in parts(texts, _PART_BYTES):
            words = Words(texts[part])
            first, second = Spans(words.hashes(13)), Spans(words.hashes(17))
            for i, text in enumerate(texts[part]):
                own = states[part.start + i].copy()
                at = np.flatnonzero(own == 2)
                place = at + words.bounds[i]
                row = table(first.of(place, place + length), second.of(place, place + length))
                own[at] = (row >= 0) & (least[row] < ids[part.start + i])
                gone = covered(own == 1, length, len(own) + length)[: len(own)]
                for column, value in zip(made, [left["doc_id"][part.start + i].as_py(), *_kept(text, gone, with_text)]):
                    column.append(value)
        return pa.table([pa.array(c, f.type) for c, f in zip(made, _RESULT_FIELDS)], schema=pa.schema(_RESULT_FIELDS))

    finished = pending.groupBy("block").cogroup(lookups.groupBy("block")).applyInArrow(settle, _RESULT)
    done = stored.filter(F.col("kind") == DONE).select(*[f.name for f in _RESULT_FIELDS])
    return done.unionByName(finished)
