"""Substring dedup by bytes: suffix arrays of shards by induced sorting, and permuted common prefixes."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.spark import block_count, by_blocks, shuffle_parts, written
from tickwell.llm.text import Spans, byte_spans, byte_values
from tickwell.llm.windows import Contexts, Lookup, covered, packed_rows, parts, report, runs, settled, summed, unpacked_windows

LENGTH = 400
SEED = 64
BLOCK_BYTES = 16 << 20
# Bytes of a suffix array's shard; an anchor with more contexts than CONTEXTS counts window hashes instead.
SHARD_BYTES = 1 << 18
CONTEXTS = 1024
_PART_BYTES = 2 << 20


# --- induced sorting ---------------------------------------------------------------------------


def _types(s: np.ndarray) -> np.ndarray:
    """True for suffixes smaller than the next one (S-type); the last is a unique least sentinel."""
    n = len(s)
    differs = np.flatnonzero(s[:-1] != s[1:])
    if not len(differs):
        return np.append(np.zeros(n - 1, dtype=bool), True)
    following = differs[np.minimum(np.searchsorted(differs, np.arange(n - 1)), len(differs) - 1)]
    small = s[following] < s[following + 1]
    return np.append(small, True)


def _induce(s: np.ndarray, small: np.ndarray, counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """All suffixes in order, from leftmost-smaller (LMS) ones in the order given.

    Buckets are read upwards to place larger-type suffixes, then downwards for the smaller-type ones.
    What a bucket puts into itself comes in waves, each the predecessors of the one before.
    """
    n, k = len(s), len(counts)
    ends = np.cumsum(counts)
    starts = ends - counts
    order = np.full(n, -1, dtype=np.int64)
    seed_of = s[seeds]
    cuts = np.searchsorted(seed_of, np.arange(k + 1))
    head = starts.copy()  # where the next larger-type suffix of a bucket goes

    def place(found: np.ndarray, bucket: int, upwards: bool) -> np.ndarray:
        """Puts the predecessors of suffixes into their buckets; returns those in the same bucket."""
        before = found[found > 0] - 1
        chars = s[before]
        if upwards:
            chosen = ~small[before]
        else:
            chosen = small[before]
        before, chars = before[chosen], chars[chosen]
        if not len(before):
            return before
        by = np.argsort(chars, kind="stable")
        sorted_chars = chars[by]
        edges = np.flatnonzero(np.append(True, sorted_chars[1:] != sorted_chars[:-1]))
        sizes = np.diff(np.append(edges, len(by)))
        rank = np.arange(len(by)) - np.repeat(edges, sizes)
        if upwards:
            order[head[sorted_chars] + rank] = before[by]
            head[sorted_chars[edges]] += sizes
        else:
            order[tail[sorted_chars] - 1 - rank] = before[by]
            tail[sorted_chars[edges]] -= sizes
        return before[chars == bucket]

    for c in range(k):
        if not counts[c]:
            continue
        wave = order[starts[c] : head[c]].copy()
        while len(wave):
            wave = place(wave, c, True)
        place(seeds[cuts[c] : cuts[c + 1]], c, True)
    tail = ends.copy()
    for c in range(k - 1, -1, -1):
        if not counts[c]:
            continue
        wave = order[tail[c] : ends[c]][::-1].copy()
        while len(wave):
            wave = place(wave, c, False)
        place(order[starts[c] : head[c]][::-1], c, False)
    order[0] = n - 1
    return order


def _induce_rows(s: np.ndarray, small: np.ndarray, counts: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """The same, suffix by suffix: for alphabets nearly as large as the text."""
    n = len(s)
    text, is_small = s.tolist(), small.tolist()
    ends = np.cumsum(counts)
    head, tail = (ends - counts).tolist(), ends.tolist()
    order = [-1] * n
    for at in reversed(seeds.tolist()):
        c = text[at]
        tail[c] -= 1
        order[tail[c]] = at
    for i in range(n):
        at = order[i] - 1
        if at >= 0 and not is_small[at]:
            c = text[at]
            order[head[c]] = at
            head[c] += 1
    tail = ends.tolist()
    for i in range(n - 1, -1, -1):
        at = order[i] - 1
        if at >= 0 and is_small[at]:
            c = text[at]
            tail[c] -= 1
            order[tail[c]] = at
    order[0] = n - 1
    return np.array(order, dtype=np.int64)


def suffix_array(s: np.ndarray, size: int | None = None) -> np.ndarray:
    """Of a text of numbers below size, ended by a unique 0: its suffixes in order, in linear time."""
    n = len(s)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    size = size or int(s.max()) + 1
    small = _types(s)
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1  # leftmost-smaller suffixes
    counts = np.bincount(s, minlength=size)
    induce = _induce if size <= 512 else _induce_rows
    first = left[np.argsort(s[left], kind="stable")]
    order = induce(s, small, counts, first)
    is_left = np.zeros(n, dtype=bool)
    is_left[left] = True
    ranked = order[is_left[order]]
    # Equal leftmost-smaller substrings get one name. Each reaches to the next one, which it includes.
    bounds = np.append(left, n - 1)
    until = np.zeros(n, dtype=np.int64)
    until[left] = np.minimum(bounds[1:] + 1, n)
    names = np.zeros(n, dtype=np.int64)
    a, b = ranked[:-1], ranked[1:]
    same = until[a] - a == until[b] - b
    hashed = Spans(s.astype(np.uint64) * np.uint64(2) + np.uint64(1))
    other = Spans(s.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(1))
    same &= (hashed.of(a, until[a]) == hashed.of(b, until[b])) & (other.of(a, until[a]) == other.of(b, until[b]))
    names[ranked] = np.append(0, np.cumsum(~same))
    reduced = names[left]
    top = int(reduced.max()) + 1 if len(reduced) else 0
    if top < len(left):
        inner = suffix_array(reduced, top)
    else:
        inner = np.empty(len(left), dtype=np.int64)
        inner[reduced] = np.arange(len(left))
    return induce(s, small, counts, left[inner])


def common_prefixes(s: np.ndarray, order: np.ndarray, most: int, room: np.ndarray | None = None) -> np.ndarray:
    """Permuted common prefixes: of each suffix with the one before it in order, up to most.

    By position i, the value is at least that of i - 1 less one, so it grows along the text; here
    whole positions are settled at once by doubling steps over span hashes, longest step first.
    room leaves positions with less than most units of text to 0.
    """
    n = len(s)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    spans = Spans(s.astype(np.uint64) * np.uint64(0xD1342543DE82EF95) + np.uint64(3))
    at = np.flatnonzero((before >= 0) & (room >= most if room is not None else True))
    a, b = at.copy(), before[at]
    made = np.zeros(len(at), dtype=np.int64)
    step = 1 << (most.bit_length() - 1)
    while step:
        fits = (a + step <= n) & (b + step <= n) & (made + step <= most)
        fits[fits] = spans.of(a[fits], a[fits] + step) == spans.of(b[fits], b[fits] + step)
        a[fits] += step
        b[fits] += step
        made[fits] += step
        step >>= 1
    permuted = np.zeros(n, dtype=np.int64)
    permuted[at] = made
    return permuted


def repeated(texts: list[bytes], length: int) -> list[np.ndarray]:
    """For each text, the starts of its `length`-byte strings that also start elsewhere in these texts."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    values = np.unique(data)
    code = np.zeros(256, dtype=np.int64)
    code[values] = np.arange(len(values)) + 2
    joined = np.zeros(len(data) + len(texts) + 1, dtype=np.int64)
    begins = np.cumsum(sizes + 1) - sizes - 1
    owner = np.repeat(np.arange(len(texts)), sizes)
    joined[np.arange(len(data)) + owner] = code[data]
    joined[begins + sizes] = 1  # ends a text; what lies beyond it never counts
    order = suffix_array(joined, len(values) + 2)
    room = np.zeros(len(joined), dtype=np.int64)
    room[np.arange(len(data)) + owner] = np.repeat(begins + sizes, sizes) - (np.arange(len(data)) + owner)
    prefix = common_prefixes(joined, order, length, room)
    full = prefix >= length
    follows = np.append(full[order[1:]], False)
    mark = np.zeros(len(joined), dtype=bool)
    mark[order[follows]] = True
    mark |= full
    return [np.flatnonzero(mark[b : b + n]) for b, n in zip(begins, sizes)]


# --- the job -----------------------------------------------------------------------------------

_RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept string"
_FIELDS = [
    pa.field("kind", pa.int32()), pa.field("block", pa.int64()), pa.field("doc_id", pa.int64()), pa.field("n_bytes", pa.int64()),
    pa.field("n_removed", pa.int64()), pa.field("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    pa.field("kept_sha256", pa.string()), pa.field("kept", pa.string()), pa.field("text", pa.string()), pa.field("state", pa.binary()),
    pa.field("h1", pa.int64()), pa.field("h2", pa.int64()), pa.field("range", pa.int64()), pa.field("bytes", pa.binary()),
]
_WRITTEN = f"kind int, block long, {_RESULT}, text string, state binary, h1 long, h2 long, range long, bytes binary"
_RESULT_FIELDS = _FIELDS[2:8]
DONE, PENDING, WINDOW, CONTEXT = 0, 1, 2, 3


class Bytes:
    """The bytes of some texts, and where each text begins."""

    def __init__(self, texts: list[bytes]):
        self.raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        self.bounds = np.cumsum([0, *map(len, texts)])

    def values(self) -> np.ndarray:
        return byte_values(19)[self.raw]


def _read(length: int, seed: int):
    def read(texts: list[bytes]) -> Contexts:
        data = Bytes(texts)
        return Contexts(data.values(), data.bounds, length, seed)

    return read


def _kept(text: bytes, gone: np.ndarray | None, with_kept: bool) -> list:
    if gone is None or not gone.any():
        left, removed, spans = text, 0, []
    else:
        starts, ends = runs(gone)
        edges = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(text)]
        left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))
        removed = int(gone.sum())
        spans = [{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())]
    return [len(text), removed, spans, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "ignore") if with_kept else None]


def _rows(rest: pa.DataType, **given) -> pa.Table:
    n = len(next(iter(given.values())))
    columns = [pa.array(given[f.name], f.type) if f.name in given else pa.nulls(n, f.type) for f in _FIELDS]
    return pa.table(columns, schema=pa.schema(_FIELDS)).append_column("rest", pa.nulls(n, rest))


def dedup(docs: DataFrame, length: int = LENGTH, seed: int = SEED, with_kept: bool = False, id_col="doc_id", text_col="text", carry: list[str] | None = None) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept_sha256, kept, rest) of every row.

    Texts are UTF-8 bytes, null is empty. Every byte of a `length`-byte string that also starts
    anywhere else, in the same text or another row, is removed; strings never cross texts and are
    judged on the input. spans are the maximal removed byte ranges; kept, null unless with_kept, is
    what is left as text, without characters of which only some bytes are left. rest is a struct of the columns to carry.
    Rows are told apart by where they stand, so ids may be null or repeat.

    Anchors, `seed` bytes that each window selects by hash, bring equal windows together with
    their context: the stretch of neighbouring windows that select the same anchor. A context that
    occurs twice is removed whole. Where an anchor has different contexts, one holder of each ships
    its bytes to the anchor's shard, whose suffix array tells by the permuted common prefixes which
    windows occur in another context. Anchors with over CONTEXTS of them count 128-bit hashes of
    their windows instead, so no shard grows with a passage's number of surroundings.
    """
    blocked = by_blocks(docs, id_col, text_col, BLOCK_BYTES, carry)
    rest = f", rest {blocked.schema['rest'].dataType.simpleString()}"
    read = _read(length, seed)
    ranges = block_count(docs, BLOCK_BYTES)
    rows = summed(report(blocked, read, _PART_BYTES)).filter("anchor_times > 1")
    rows = rows.select("block", "anchor", "context", "context_times", "context_block", "several", "anchor_contexts")

    def find(left: pa.Table, right: pa.Table) -> pa.Table:
        table = Lookup(right["anchor"].to_numpy(), right["context"].to_numpy())
        ends_with = lambda column, value: np.append(right[column].to_numpy(zero_copy_only=False), value)
        times, holder = ends_with("context_times", 0), ends_with("context_block", -1)
        several, many = ends_with("several", False).astype(bool), ends_with("anchor_contexts", 0) > CONTEXTS
        block = left["block"][0].as_py() if len(left) else None
        texts = [(t or "").encode() for t in left["text"].to_pylist()]
        states: list[np.ndarray] = []
        crowd_seen: list[np.ndarray] = []
        if table.any_crowd():  # a first look: how often crowded anchors' contexts stand in this block
            for part in parts(texts, _PART_BYTES):
                contexts = read(texts[part])
                crowd = table.crowded(contexts.anchor) >= 0
                crowd_seen.append(contexts.context[crowd] ^ contexts.anchor[crowd])
        seen, often = np.unique(np.concatenate(crowd_seen) if crowd_seen else np.zeros(0, np.uint64), return_counts=True)
        sent: set[tuple[int, int]] = set()
        outs: list[pa.Table] = []
        made: list[list] = [[] for _ in _FIELDS]
        windows: list[tuple[np.ndarray, np.ndarray]] = []
        ship: list[tuple[int, int, bytes]] = []
        for part in parts(texts, _PART_BYTES):
            data = Bytes(texts[part])
            values = data.values()
            contexts = Contexts(values, data.bounds, length, seed)
            row, crowd = table(contexts.anchor, contexts.context), table.crowded(contexts.anchor)
            here = np.where(row >= 0, times[row], 0)
            if len(seen):
                at = np.minimum(np.searchsorted(seen, contexts.context ^ contexts.anchor), len(seen) - 1)
                here = np.maximum(here, np.where((crowd >= 0) & (seen[at] == contexts.context ^ contexts.anchor), often[at], 0))
            unsure = ((row >= 0) & several[row]) | (crowd >= 0)
            hot = np.where(crowd >= 0, many[crowd], many[row] & (row >= 0))
            state = np.where(here > 1, 1, np.where(unsure, 2, 0)).astype(np.uint8)
            # one holder of each context, certain or not, must show its windows to the other contexts
            holds = unsure & ((crowd >= 0) | (holder[row] == block))
            for i in np.flatnonzero(holds):
                key = (int(contexts.anchor[i]), int(contexts.context[i]))
                if key in sent:
                    continue
                sent.add(key)
                if hot[i]:
                    windows.append(_window_hashes(data.raw, values, contexts, i, length))
                else:
                    a, b = int(contexts.first[i]), int(contexts.last[i]) + length
                    ship.append((*key, data.raw[a:b].tobytes()))
            marks = contexts.spread(np.where(hot & (state == 2), 3, state).astype(np.uint8))
            marks = np.append(marks, np.zeros(len(values) - len(marks), np.uint8))
            for i, text in enumerate(texts[part]):
                own = marks[data.bounds[i] : data.bounds[i + 1]]
                doc_id = left["doc_id"][part.start + i].as_py()
                if (own > 1).any():
                    row_ = [PENDING, block, doc_id, None, None, None, None, None, text.decode(), zlib.compress(own.tobytes(), 1)]
                else:
                    gone = covered(own == 1, length, len(own) + length)[: len(own)] if own.any() else None
                    row_ = [DONE, block, doc_id, *_kept(text, gone, with_kept), None, None]
                for column, value in zip(made, [*row_, None, None, None, None]):
                    column.append(value)
        outs.append(pa.table([pa.array(c, f.type) for c, f in zip(made, _FIELDS)], schema=pa.schema(_FIELDS)).append_column("rest", left["rest"]))
        none = left.schema.field("rest").type
        if windows:
            h = np.concatenate([np.stack(w, 1) for w in windows])
            h, n = np.unique(h, axis=0, return_counts=True)
            rows_ = packed_rows(block, ranges, np.ascontiguousarray(h[:, 0]), np.ascontiguousarray(h[:, 1]), n, n)
            outs.append(_rows(none, kind=[WINDOW] * len(rows_), block=[r[0] for r in rows_], range=[r[1] for r in rows_], bytes=[r[2] for r in rows_]))
        if ship:
            keys = np.array([(a, c) for a, c, _ in ship], dtype=np.uint64).view(np.int64)
            outs.append(_rows(none, kind=np.full(len(ship), CONTEXT), block=np.full(len(ship), block), h1=keys[:, 0], h2=keys[:, 1], bytes=[x for _, _, x in ship]))
        return pa.concat_tables(outs)

    sides = [blocked.groupBy("block"), rows.groupBy("block")]
    del blocked, rows  # nothing but the plan itself may hold on to its shuffles once it is written
    stored = written(sides.pop(0).cogroup(sides.pop(0)).applyInArrow(find, _WRITTEN + rest), "repeats")
    counted = settled(stored.filter(F.col("kind") == WINDOW).select("block", "range", F.col("bytes").alias("data")), _recurring)
    shipped = stored.filter(F.col("kind") == CONTEXT).select("block", "h1", "h2", "bytes")
    total = shipped.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    shards = max(1, -(-total // SHARD_BYTES))

    def sort_shard(table: pa.Table) -> pa.Table:
        blocks, first, second = (table[c].to_numpy() for c in ("block", "h1", "h2"))
        texts = table["bytes"].to_pylist()
        rows: list[tuple] = []
        for i, starts in enumerate(repeated(texts, length)):
            if len(starts):
                rows.append((int(blocks[i]), int(first[i]), int(second[i]), zlib.compress(starts.astype(np.int32).tobytes(), 1)))
        columns = list(zip(*rows)) or [[], [], [], []]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=["block", "h1", "h2", "starts"])

    sharded = shipped.withColumn("shard", F.pmod(F.xxhash64("h1"), F.lit(shards))).repartition(max(shuffle_parts(docs), shards // 8), "shard")
    sorted_ = sharded.groupBy("shard").applyInArrow(sort_shard, "block long, h1 long, h2 long, starts binary")
    # A context's result goes to every block that holds it and waits: its own, as others were settled by count.
    none = F.lit(None).cast("long")
    found = sorted_.unionByName(counted.select("block", none.alias("h1"), none.alias("h2"), F.col("data").alias("starts")))
    pending = stored.filter(F.col("kind") == PENDING).select("block", "doc_id", "text", "state", "rest")

    def settle(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = right["starts"].to_pylist()
        first, second = right["h1"].to_pylist(), right["h2"].to_pylist()
        own_ = [i for i, h in enumerate(first) if h is not None]
        by_context = Lookup(*(np.array([h[i] for i in own_], dtype=np.int64) for h in (first, second)))
        starts_of = [np.frombuffer(zlib.decompress(lists[i]), dtype=np.int32) for i in own_]
        windows = unpacked_windows([x for x, h in zip(lists, first) if h is None], 3)
        by_window = Lookup(windows[0], windows[1])
        texts = [t.encode() for t in left["text"].to_pylist()]
        states = [np.frombuffer(zlib.decompress(s), dtype=np.uint8) for s in left["state"].to_pylist()]
        made: list[list] = [[] for _ in _RESULT_FIELDS]
        for part in parts(texts, _PART_BYTES):
            data = Bytes(texts[part])
            values = data.values()
            contexts = Contexts(values, data.bounds, length, seed)
            marks = np.concatenate(states[part]) if states[part] else np.zeros(0, np.uint8)
            flags = marks == 1
            row = by_context(contexts.anchor, contexts.context)
            for i in np.flatnonzero(row >= 0):
                flags[contexts.first[i] + starts_of[row[i]]] = True
            at = np.flatnonzero(marks == 3)
            if len(at):
                h1, h2 = Spans(values).of(at, at + length), byte_spans(data.raw, 23).of(at, at + length)
                flags[at] |= by_window(h1, h2) >= 0
            for i, text in enumerate(texts[part]):
                own = flags[data.bounds[i] : data.bounds[i + 1]]
                gone = covered(own, length, len(own) + length)[: len(own)]
                for column, value in zip(made, [left["doc_id"][part.start + i].as_py(), *_kept(text, gone, with_kept)]):
                    column.append(value)
        table = pa.table([pa.array(c, f.type) for c, f in zip(made, _RESULT_FIELDS)], schema=pa.schema(_RESULT_FIELDS))
        return table.append_column("rest", left["rest"])

    finished = pending.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(settle, _RESULT + rest)
    done = stored.filter(F.col("kind") == DONE).select(*[f.name for f in _RESULT_FIELDS], "rest")
    return done.unionByName(finished)


def _recurring(times: np.ndarray, _: np.ndarray, group: np.ndarray, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows that occur more than once over all blocks."""
    total = np.bincount(group, times, groups).astype(np.int64)[group]
    return total > 1, total


def _window_hashes(raw: np.ndarray, values: np.ndarray, contexts: Contexts, i: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each window of a context."""
    a, b = int(contexts.first[i]), int(contexts.last[i])
    at = np.arange(b - a + 1)
    return Spans(values[a : b + length]).of(at, at + length), byte_spans(raw[a : b + length], 23).of(at, at + length)
