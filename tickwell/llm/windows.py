"""Repeated windows of a corpus, found through anchors that every window selects by its own content."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.text import Spans, mix

# A block that holds more contexts of an anchor than this reports the anchor once, as crowded.
CROWDED = 8
_CROWD = np.uint64(0x7FFFFFFFFFFFFFFF)
_PLACE = np.uint64(0xFFFFFFFF)
_ROWS = 1 << 20


def sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of every run of width keys, by minima from the ends of blocks of that width."""
    n = len(keys)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:n] = keys
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


class Contexts:
    """The windows of some texts, grouped by the anchor each selects.

    The anchor of a window is its span of `seed` units with the least hash. Equal windows select equal
    anchors at the same place, wherever they stand. Neighbouring windows with one anchor make up a
    context: windows first..last, units [first, last + length). Every window is in one context.
    """

    def __init__(self, values: np.ndarray, bounds: np.ndarray, length: int, seed: int):
        """values: one hash per unit of all texts; bounds: where each text begins, and the end."""
        self.length, self.count = length, max(0, len(values) - length + 1)
        self.text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        if not self.count:
            self.first = self.last = self.of = np.zeros(0, np.int64)
            self.anchor = self.context = np.zeros(0, np.uint64)
            return
        spans = Spans(values)
        grams = spans.all(seed)
        keys = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
        place = (sliding_least(keys, length - seed + 1) & _PLACE).astype(np.int64)
        inside = self.text[: self.count] == self.text[length - 1 :]
        starts = np.flatnonzero(np.append(True, (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])))
        ends = np.append(starts[1:], self.count) - 1
        chosen = inside[starts]
        self.first, self.last = starts[chosen], ends[chosen]
        at = place[self.first]
        self.anchor = grams[at]
        self.context = mix(spans.of(self.first, self.last + length) + (at - self.first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.of = self.text[self.first]

    def spread(self, values: np.ndarray) -> np.ndarray:
        """One value per window, from one per context; 0 where a window would cross texts."""
        made = np.zeros(self.count, dtype=values.dtype)
        lengths = self.last - self.first + 1
        place = np.arange(lengths.sum()) + np.repeat(self.first - np.cumsum(lengths) + lengths, lengths)
        made[place] = np.repeat(values, lengths)
        return made


def reported(block: np.ndarray, anchor: np.ndarray, context: np.ndarray, who: np.ndarray) -> pa.RecordBatch:
    """One row per block, anchor and context: least and greatest who, occurrences, contexts stood for."""
    order = np.lexsort((who, context, anchor, block))
    block, anchor, context, who = block[order], anchor[order], context[order], who[order]
    new_anchor = np.append(True, (block[1:] != block[:-1]) | (anchor[1:] != anchor[:-1])) if len(block) else np.zeros(0, bool)
    new = new_anchor.copy()
    new[1:] |= context[1:] != context[:-1]
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(new))
    low, high, times = who[starts], who[ends - 1], ends - starts
    group = np.cumsum(new_anchor[starts]) - 1  # of each row, its block and anchor
    contexts = np.bincount(group, minlength=1) if len(group) else np.zeros(0, np.int64)
    crowded = contexts[group] > CROWDED if len(group) else np.zeros(0, bool)
    heads = np.flatnonzero(new_anchor[starts] & crowded)
    parts = [np.flatnonzero(~crowded)]
    rows = [(block[starts], anchor[starts], context[starts], low, high, times, np.ones(len(starts), np.int64))]
    kept = [tuple(c[parts[0]] for c in rows[0])]
    if len(heads):
        own = np.flatnonzero(crowded)
        cut = np.searchsorted(own, heads)
        kept.append(
            (
                block[starts][heads],
                anchor[starts][heads],
                np.full(len(heads), _CROWD),
                np.minimum.reduceat(low[own], cut),
                np.maximum.reduceat(high[own], cut),
                np.add.reduceat(times[own], cut),
                contexts[group[heads]],
            )
        )
    columns = [np.concatenate(c) for c in zip(*kept)]
    columns[1], columns[2] = columns[1].view(np.int64), columns[2].view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], REPORT)


REPORT = ["block", "anchor", "context", "low", "high", "times", "contexts"]
REPORT_SCHEMA = ", ".join(f"{n} long" for n in REPORT)


def parts(texts: list, size: int) -> Iterator[slice]:
    """Slices of texts (bytes) of about size bytes in all, at least one text each."""
    start, total = 0, 0
    for i, text in enumerate(texts):
        if total and total + len(text) > size:
            yield slice(start, i)
            start, total = i, 0
        total += len(text)
    if texts:
        yield slice(start, len(texts))


def _reports(batches: Iterator[pa.RecordBatch], read, part_bytes: int, chosen=None) -> Iterator[pa.RecordBatch]:
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        blocks = batch.column(0).to_numpy(zero_copy_only=False)
        ids = doc_ids(batch.column(1))
        texts = [(t or "").encode() for t in batch.column(2).to_pylist()]
        for part in parts(texts, part_bytes):
            found = read(texts[part])
            rows = (blocks[part][found.of], found.anchor, found.context, ids[part][found.of])
            held.append(rows if chosen is None else tuple(c[chosen(found.anchor)] for c in rows))
            size += len(held[-1][0])
            if size > _ROWS:
                yield reported(*(np.concatenate(c) for c in zip(*held)))
                held, size = [], 0
    if size:
        yield reported(*(np.concatenate(c) for c in zip(*held)))


def report(blocked: DataFrame, read, part_bytes: int = 4 << 20) -> DataFrame:
    """REPORT rows of (block, doc_id, text, ...): read turns a list of byte strings into Contexts.

    A row stands for all occurrences in one block, so however often a passage occurs, an anchor has
    at most CROWDED rows a block; who is the doc_id, the greatest number for rows without one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _reports(batches, read, part_bytes)

    return blocked.mapInArrow(run, REPORT_SCHEMA)


def report_recurring(blocked: DataFrame, read, blocks: int, bits: int, part_bytes: int = 4 << 20) -> DataFrame:
    """REPORT rows of the anchors that occur twice, and of a few others.

    First each block sends the leading bits of its anchors, sorted and packed by ranges of their
    values, two or three bytes each; a range's task sends back those that several blocks hold.
    """
    shift = np.uint64(64 - bits)
    width = np.uint64(-(-(1 << bits) // blocks))

    def packed(values: np.ndarray) -> bytes:
        return zlib.compress(np.diff(values, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)

    def unpacked(data: bytes) -> np.ndarray:
        planes = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(8, -1)
        return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)

    def send(table: pa.Table) -> pa.Table:
        texts = [(t or "").encode() for t in table["text"].to_pylist()]
        found = [read(texts[part]).anchor >> shift for part in parts(texts, part_bytes)]
        values, times = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
        ranges = (values // width).astype(np.int64)
        cuts = np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])) if len(values) else []
        lists = [values[i:j] for i, j in zip(cuts, [*cuts[1:], len(values)])]
        n = len(lists)
        block = table["block"][0].as_py() if len(table) else 0
        own = [zlib.compress(np.packbits(times[i:j] > 1).tobytes(), 1) for i, j in zip(cuts, [*cuts[1:], len(values)])]
        return pa.table(
            [pa.array(np.full(n, block, np.int64)), pa.array([int(ranges[i]) for i in cuts], pa.int64()), pa.array([packed(x) for x in lists], pa.binary()), pa.array(own, pa.binary())],
            names=["block", "range", "data", "twice"],
        )

    def answer(table: pa.Table) -> pa.Table:
        lists = [unpacked(x) for x in table["data"].to_pylist()]
        twice = [np.unpackbits(np.frombuffer(zlib.decompress(x), np.uint8), count=len(v)).astype(bool) for x, v in zip(table["twice"].to_pylist(), lists)]
        values, times = np.unique(np.concatenate(lists), return_counts=True)
        shared = values[times > 1]
        kept = []
        for own, often in zip(lists, twice):
            at = np.minimum(np.searchsorted(shared, own), max(0, len(shared) - 1))
            kept.append(own[often | (shared[at] == own if len(shared) else False)])
        return pa.table([table["block"], pa.array([packed(k) for k in kept], pa.binary())], names=["block", "data"])

    # All uses of the blocks take the same columns, so that Spark shuffles them once.
    sent = blocked.groupBy("block").applyInArrow(send, "block long, range long, data binary, twice binary")
    back = sent.groupBy("range").applyInArrow(answer, "block long, data binary")

    def tell(left: pa.Table, right: pa.Table) -> pa.Table:
        recurring = np.unique(np.concatenate([unpacked(x) for x in right["data"].to_pylist()] or [np.zeros(0, np.uint64)]))

        def chosen(anchor: np.ndarray) -> np.ndarray:
            if not len(recurring):
                return np.zeros(len(anchor), bool)
            own = anchor >> shift
            return recurring[np.minimum(np.searchsorted(recurring, own), len(recurring) - 1)] == own

        made = list(_reports(iter(left.combine_chunks().to_batches()), read, part_bytes, chosen))
        return pa.Table.from_batches(made) if made else pa.table([pa.array([], pa.int64())] * len(REPORT), names=REPORT)

    return blocked.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(tell, REPORT_SCHEMA)


def doc_ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def summed(rows: DataFrame) -> DataFrame:
    """Adds what all blocks together say of the row's context and of its anchor.

    Rows are few per key, at most CROWDED a block, so plain windows over them are even. A crowded row
    stands for several contexts by itself, even if all blocks have nothing but such rows.
    """
    anchor, context = Window.partitionBy("anchor"), Window.partitionBy("anchor", "context")
    return (
        rows.withColumn("anchor_low", F.min("low").over(anchor))
        .withColumn("anchor_high", F.max("high").over(anchor))
        .withColumn("anchor_times", F.sum("times").over(anchor))
        .withColumn("anchor_contexts", F.sum("contexts").over(anchor))
        .withColumn("several", (F.min("context").over(anchor) != F.max("context").over(anchor)) | (F.max("contexts").over(anchor) > 1))
        .withColumn("context_low", F.min("low").over(context))
        .withColumn("context_times", F.sum("times").over(context))
        .withColumn("context_block", F.min("block").over(context))
    )


class Lookup:
    """Rows of a block by anchor and context, or by two hashes of a window."""

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.first, self.second = first.view(np.uint64), second.view(np.uint64)
        keys = self._key(self.first, self.second)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    @staticmethod
    def _key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        return mix(first * np.uint64(0x9FB21C651E98DF25) + second)

    def __call__(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The row of each pair, -1 if there is none."""
        if not len(self.keys):
            return np.full(len(first), -1)
        at = np.minimum(np.searchsorted(self.keys, self._key(first, second)), len(self.keys) - 1)
        row = self.order[at]
        return np.where((self.first[row] == first) & (self.second[row] == second), row, -1)

    def any_crowd(self) -> bool:
        return bool((self.second == _CROWD).any())

    def crowded(self, anchor: np.ndarray) -> np.ndarray:
        return self(anchor, np.full(len(anchor), _CROWD))


def covered(flags: np.ndarray, length: int, units: int) -> np.ndarray:
    """Which units lie in a flagged window; flags: one per window start."""
    change = np.zeros(units + 1, dtype=np.int64)
    starts = np.flatnonzero(flags)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change[:-1]) > 0


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs that are set."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
    return edges[::2], edges[1::2]


def packed_rows(block: int, ranges: int, h1: np.ndarray, h2: np.ndarray, x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, bytes]]:
    """(block, range, data): sorted window hashes with two numbers each, packed by ranges of their values."""
    at = (h1 // np.uint64(-(-(1 << 64) // ranges)) if ranges > 1 else np.zeros(len(h1))).astype(np.int64)
    cuts = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else []
    columns = (h1, h2, x.view(np.uint64), y.view(np.uint64))
    return [(block, int(at[i]), packed_window(*(c[i:j] for c in columns))) for i, j in zip(cuts, [*cuts[1:], len(at)])]


def packed_window(*columns: np.ndarray) -> bytes:
    return zlib.compress(np.concatenate([np.ascontiguousarray(c, dtype="<u8") for c in columns]).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked_windows(data: list[bytes], columns: int) -> np.ndarray:
    """The columns of several packed lists, one after the other."""
    made = [np.zeros((columns, 0), np.uint64)]
    for d in data:
        planes = np.frombuffer(zlib.decompress(d), dtype=np.uint8).reshape(8, -1)
        made.append(np.ascontiguousarray(planes.T).view("<u8").ravel().reshape(columns, -1))
    return np.concatenate(made, axis=1)


def settled(rows: DataFrame, keep) -> DataFrame:
    """(block, data) of (block, range, data): what each block has to know of its own windows.

    keep(x, y, group, groups) takes the numbers of all blocks' rows of some windows and says which rows
    go back, and with which number; it is called with every row of a window.
    """

    def answer(table: pa.Table) -> pa.Table:
        data = table["data"].to_pylist()
        lists = [unpacked_windows([d], 4) for d in data]
        h1, h2, x, y = np.concatenate(lists, axis=1)
        order = np.lexsort((h2, h1))
        new = np.append(True, (h1[order][1:] != h1[order][:-1]) | (h2[order][1:] != h2[order][:-1]))
        group = np.empty(len(h1), np.int64)
        group[order] = np.cumsum(new) - 1
        kept, number = keep(x.view(np.int64), y.view(np.int64), group, int(new.sum()))
        bounds = np.cumsum([0, *[a.shape[1] for a in lists]])
        back = []
        for i, j in zip(bounds[:-1], bounds[1:]):
            at = i + np.flatnonzero(kept[i:j])
            back.append(packed_window(h1[at], h2[at], number[at].view(np.uint64)))
        return pa.table([table["block"], pa.array(back, pa.binary())], names=["block", "data"])

    return rows.groupBy("range").applyInArrow(answer, "block long, data binary")
