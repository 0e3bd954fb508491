"""Best-fit packing: token pieces into as few sequences as can be, by bin completion over the lengths.

What decides a packing is how many pieces there are of each length, never which ones. So the search runs on
one count per length, at most ``limit`` numbers whatever the corpus, and Spark deals the pieces to the places
it found: tokens, counts, ranks and places are all distributed.
"""

from __future__ import annotations

import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.spark import written
from tickwell.llm.text import SPACE

LIMIT = 2048
END = 0
# Steps of the search after which the best packing found so far counts.
STEPS = 200_000
_BATCH_BYTES = 4 << 20

# ------------------------------------------------------------------- the search


def least_sequences(counts: np.ndarray) -> int:
    """A lower bound of the sequences that counts[length] pieces need: Martello and Toth's L2."""
    limit = len(counts) - 1
    number = np.concatenate([[0], np.cumsum(counts[1:])])  # of pieces up to a length
    tokens = np.concatenate([[0], np.cumsum(counts[1:] * np.arange(1, limit + 1))])
    half = limit // 2
    small = np.arange(0, half + 1)  # pieces shorter than this are left out
    wide = number[limit] - number[limit - small]
    middle = number[limit - small] - number[half]
    free = middle * limit - (tokens[limit - small] - tokens[half])
    rest = tokens[half] - tokens[np.maximum(small - 1, 0)]
    return int((wide + middle + np.maximum(0, -((free - rest) // limit))).max())


def best_fit(counts: np.ndarray) -> list[tuple[int, Counter]]:
    """Best fit decreasing, all pieces of a length at once: (copies, lengths in one sequence)."""
    limit = len(counts) - 1
    room: list[list[tuple[int, Counter]]] = [[] for _ in range(limit + 1)]
    for length in range(limit, 0, -1):
        left, space = int(counts[length]), length
        while left and space <= limit:
            if not room[space]:
                space += 1
                continue
            copies, held = room[space].pop()
            used = min(copies, left)
            if used < copies:
                room[space].append((copies - used, held))
            room[space - length].append((used, held + Counter([length])))
            left -= used
            if space - length >= length:
                space = min(space, space - length)
        if left:
            each = limit // length
            if left >= each:
                room[limit - each * length].append((left // each, Counter({length: each})))
            if left % each:
                room[limit - left % each * length].append((1, Counter({length: left % each})))
    return [x for group in room for x in group]


class _Spent(Exception):
    """The steps of a search are used up."""


class _Search:
    """Bin completion: fill a sequence around the largest piece left with what is not dominated, deepest first."""

    def __init__(self, counts: np.ndarray, steps: int):
        self.limit, self.steps = len(counts) - 1, steps
        self.best = best_fit(counts)
        self.fewest = sum(copies for copies, _ in self.best)
        self.least = least_sequences(counts)
        self.stock = counts.copy()

    def _spend(self, steps: int) -> None:
        self.steps -= steps
        if self.steps < 0:
            raise _Spent

    def _exact(self, stock: list[int], present: int, total: int, most: int) -> Iterator[list[int]]:
        """Multisets of the stock, no piece over most, of exactly this total; large pieces first.

        present has a bit for every length in stock.
        """
        if not total:
            yield []
            return
        if total <= most and present >> total & 1:
            self._spend(1)
            stock[total] -= 1
            yield [total]
            stock[total] += 1
        least = (present & -present).bit_length() - 1
        most = min(total - least, most)
        while most > 0 and (length := (present & ((2 << most) - 1)).bit_length() - 1) > 0:
            self._spend(1)
            stock[length] -= 1
            yield from (
                [length, *rest]
                for rest in self._exact(stock, present if stock[length] else present ^ (1 << length), total - length, length)
            )
            stock[length] += 1
            most = length - 1

    def _dominated(self, stock: list[int], filling: list[int], waste: int) -> bool:
        """Whether one piece of the stock without the filling, at least as large, could take the place of some of it."""
        sums: dict[int, int] = {}  # total of a choice -> the most pieces it is made of
        for length in filling:
            for total, n in [(0, 0), *sums.items()]:
                sums[total + length] = max(sums.get(total + length, 0), n + 1)
        return any(any(stock[total + (n < 2) : total + waste + 1]) for total, n in sums.items())

    def _fillings(self, stock: list[int], space: int) -> Iterator[list[int]]:
        """Undominated fillings of a space, least waste first."""
        if space and stock[space]:
            yield [space]  # one piece that fills it dominates all else
            return
        present = sum(1 << length for length, n in enumerate(stock) if n)
        for waste in range(space + 1):
            for filling in self._exact(stock, present, space - waste, space):
                if not self._dominated(stock, filling, waste):
                    yield filling

    def _moves(self) -> Iterator[tuple[int, dict[int, int]]]:
        """(copies, pieces of each length) for the next sequence: as many alike as the stock gives, then one."""
        stock = self.stock.tolist()
        largest = int(np.flatnonzero(self.stock)[-1])
        stock[largest] -= 1
        space = self.limit - largest
        for filling in self._fillings(stock, space):
            need = Counter([largest, *filling])
            copies = min(int(self.stock[length]) // n for length, n in need.items())
            yield copies, need
            if copies > 1 and filling != [space]:
                yield 1, need

    def _take(self, copies: int, need: dict[int, int]) -> None:
        for length, n in need.items():
            self.stock[length] -= copies * n

    def run(self) -> list[tuple[int, Counter]]:
        """The best packing found; it is one of the fewest sequences if the search ends before its steps do."""
        taken: list[tuple[int, Counter]] = []
        used, levels = 0, [self._moves()] if self.fewest > self.least else []
        while levels:
            try:
                self._spend(20)
                move = next(levels[-1], None)
            except _Spent:
                break
            if move is None:
                levels.pop()
                if taken:
                    used -= taken[-1][0]
                    self._take(-taken[-1][0], taken.pop()[1])
                continue
            self._take(*move)
            if used + move[0] + least_sequences(self.stock) >= self.fewest:
                self._take(-move[0], move[1])  # its waste bound is no better than what is known
            elif self.stock.any():
                taken.append(move)
                used += move[0]
                levels.append(self._moves())
            else:
                self.best, self.fewest = [*taken, move], used + move[0]
                self._take(-move[0], move[1])
                if self.fewest == self.least:
                    break
        return self.best


def plan(counts: np.ndarray, steps: int = STEPS) -> list[tuple[int, Counter]]:
    """(copies, pieces of each length in one sequence) for counts[length] pieces of each length below len(counts)."""
    return _Search(np.asarray(counts, dtype=np.int64), steps).run()


# -------------------------------------------------------------------- on Spark


# ASCII letters, and the other ASCII bytes.
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_OTHER = ~_LETTER
_OTHER[128:] = False


def _words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct runs without ASCII space of some texts, the place of each run of all texts, and the runs up to each text's end.

    A run also ends between an ASCII letter and another ASCII character, where the tokenizer's pattern parts in any
    case, and its ASCII capitals are small, as the tokenizer makes them; but for those that what follows may be composed with.
    """
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    word = ~SPACE[data]
    edges = np.zeros(len(data) + 1, dtype=bool)  # a run ends where its text does
    edges[bounds - bounds[0]] = True
    begins, ends = word & edges[:-1], word & edges[1:]
    parted = _LETTER[data[:-1]] & _OTHER[data[1:]] & word[1:]
    begins[1:] |= word[1:] & ~word[:-1] | parted
    ends[:-1] |= word[:-1] & ~word[1:] | parted
    small = data.copy()
    small[:-1] |= (((data[:-1] >= 65) & (data[:-1] <= 90) & (data[1:] < 128)) << 5).astype(np.uint8)
    starts = np.flatnonzero(begins)
    offsets = np.concatenate([[0], np.cumsum(np.flatnonzero(ends) + 1 - starts)])
    runs = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(small[word])])
    coded = runs.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(starts, bounds[1:] - bounds[0])


# Between words that are coded together: a character that makes a token of its own. A word that holds it is coded alone.
_MARK = "\x01"
_TOGETHER = 4096
# Words a worker remembers before it starts afresh; this changes its memory and time, never its ids.
KNOWN = 1 << 20


class _Coder:
    """Ids of words, each coded once while it is remembered."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids[0]
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.flat, self.sizes = np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int64)

    def _coded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has."""
        flat, sizes = [self.flat], [self.sizes]
        for at in range(0, len(words), _TOGETHER):
            some = words[at : at + _TOGETHER]
            whole = self.tokenizer.encode_batch_fast([f" {_MARK} ".join([*some, ""])], add_special_tokens=False)[0].ids
            ids = np.array(whole, dtype=np.uint32)
            ends = np.flatnonzero(ids == self.mark)
            if len(ends) == len(some):
                flat.append(np.delete(ids, ends))
                sizes.append(np.diff(ends, prepend=-1) - 1)
            else:
                each = [self.tokenizer.encode(word, add_special_tokens=False).ids for word in some]
                flat.append(np.array([i for ids in each for i in ids], dtype=np.uint32))
                sizes.append(np.array([len(ids) for ids in each], dtype=np.int64))
        return np.concatenate(flat), np.concatenate(sizes)

    def places(self, words: pa.Array) -> np.ndarray:
        """Where distinct words stand among those remembered; new ones are coded first."""
        at = pc.index_in(words, value_set=self.words)
        if len(self.words) + at.null_count > KNOWN:
            self._forget()
            at = pa.nulls(len(words), pa.int32())
        new = words.filter(at.is_null())
        known = len(self.words)
        self.flat, self.sizes = self._coded(new.to_pylist())
        self.words = pa.concat_arrays([self.words, new])
        place = pc.fill_null(at, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        place[place < 0] = known + np.arange(len(new))
        return place

    def ids(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each text's closed by end, and where each text's begin and the last ends.

        The tokenizer parts texts at white space and where a pattern of letters ends, so the ids of a text are
        those of its words.
        """
        words, runs, ends = _words_of(texts)
        runs = self.places(words)[runs]
        flat, sizes = np.append(self.flat, np.uint32(end)), np.append(self.sizes, 1)  # the last one is end
        at = np.cumsum(sizes) - sizes
        runs = np.insert(runs, ends, len(sizes) - 1)
        n = sizes[runs]
        offsets = np.concatenate([[0], np.cumsum(n)])
        shift = np.repeat(at[runs] - offsets[:-1], n)
        shift += np.arange(offsets[-1])
        return flat[shift], np.concatenate([[0], offsets[ends + np.arange(1, len(ends) + 1)]])


def pieces(docs: DataFrame, path: str, limit: int = LIMIT, end: int = END, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, rank[, ids]): every text's ids and one end, cut at the limit.

    rank numbers the pieces of one length within the task part that made them. Null texts are
    empty, so each row gives one piece at least, repeated and unnamed rows too.
    """
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder(path)
        part, seen = TaskContext.get().partitionId(), np.zeros(limit + 1, dtype=np.int64)
        for batch in batches:
            for some in _bounded(batch):
                texts = some.column(1).cast(pa.large_string())
                ids, bounds = coder.ids(texts, end)
                lengths = np.diff(bounds)
                per = -(-lengths // limit)
                owner = np.repeat(np.arange(len(lengths)), per)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
                start = piece * limit
                length = np.minimum(limit, lengths[owner] - start)
                order = np.argsort(length, kind="stable")
                kinds, first, n = np.unique(length[order], return_index=True, return_counts=True)
                rank = np.empty_like(length)
                rank[order] = np.arange(len(order)) - np.repeat(first, n) + seen[length[order]]
                seen[kinds] += n
                begin = bounds[:-1][owner] + start
                raw = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
                crc = [zlib.crc32(raw[4 * b : 4 * e]) for b, e in zip(begin.tolist(), (begin + length).tolist())]
                columns = [
                    some.column(0).take(pa.array(owner)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length),
                    pa.array(crc, pa.int64()), pa.array(np.full(len(owner), part), pa.int64()), pa.array(rank),
                ]
                if with_ids:
                    cuts = np.append(begin, bounds[-1]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, rank long"
    return chosen.mapInArrow(run, kinds + (", ids array<int>" if with_ids else ""))


def _bounded(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about _BATCH_BYTES of text, one row at least."""
    sizes = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(sizes):
        before = sizes[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(sizes, before + _BATCH_BYTES)))
        yield batch.slice(at, upto - at)
        at = upto


def _places(packing: list[tuple[int, Counter]], limit: int) -> dict[str, np.ndarray]:
    """The packing as runs of pieces: those of a length from a rank on go, times a sequence, to places from an offset on.

    There are at most limit sequences patterns of few lengths, whatever the number of pieces.
    """
    rows, used, sequence = [], Counter(), 0
    for copies, need in packing:
        offset = 0
        for length, times in sorted(need.items(), reverse=True):
            rows.append((length, used[length], times, sequence, offset))
            used[length] += copies * times
            offset += length * times
        sequence += copies
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 5)
    return {name: table[:, i] for i, name in enumerate(("length", "first", "times", "sequence", "offset"))}


def pack(docs: DataFrame, path: str, limit: int = LIMIT, end: int = END, steps: int = STEPS, with_ids: bool = False) -> DataFrame:
    """Token pieces of all texts in as few sequences of at most limit tokens as the search finds.

    (doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]): a text's ids, then end; only
    longer ones are cut. Places of a sequence follow each other from 0 without a gap.

    Only the count of pieces of each length reaches the driver, limit numbers at most, and the
    packing found, at most one pattern per step and 63 lengths each, goes back to the tasks. A piece's
    place follows from its rank among the pieces of its length: its rank within the part that made it and
    the pieces of the parts before. Null texts are empty documents of one token. Repeated rows are
    packed each; rows without doc_id too. An empty table gives no rows.
    """
    spark = docs.sparkSession
    made = written(pieces(docs, path, limit, end, with_ids), "pieces")
    by_part = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros(limit + 1, dtype=np.int64)
    for row in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row["length"]] = row["n"]
    places = spark.sparkContext.broadcast(_places(plan(counts, steps), limit))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = places.value
        wide = np.int64(1 << 48)
        keys = at["length"] * wide + at["first"]
        for batch in batches:
            length, rank = (batch.column(name).to_numpy() for name in ("length", "rank"))
            run = np.searchsorted(keys, length * wide + rank, side="right") - 1
            copy, among = np.divmod(rank - at["first"][run], at["times"][run])
            sequence = pa.array(at["sequence"][run] + copy)
            offset = pa.array(at["offset"][run] + among * length)
            kept = [batch.column(name) for name in names]
            yield pa.RecordBatch.from_arrays([*kept, sequence, offset], [*names, "sequence_id", "offset"])

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = made.join(base, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = ", ".join(f"{n} {made.schema[n].dataType.simpleString()}" for n in names)
    return ranked.select(*names, "rank").mapInArrow(place, schema + ", sequence_id long, offset long")
