"""Byte-level BPE: recursive DuckDB queries contract words, an ordered aggregation decodes."""

from __future__ import annotations

import base64
import ctypes
import gc
import hashlib
import heapq
import re
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.text import HELD

# White space as the pattern's \s means it; fixed values (Unicode White_Space).
_WHITE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
# No match of the pattern goes beyond a run of white space and the run of other characters after it.
_STRETCH = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
# A recursion keeps the state of every step, so long words would fill it with the square of their length.
LONGEST = 128
_SQUARES = 20_000_000
# Stretches remembered by a worker; the memory starts anew beyond it.
REMEMBERED = 400_000
_TEXT_BYTES = 4 << 20

_ENCODE = """
with recursive steps(w, ids) as (
  select w, ids from words
  union all
  select s.w, s.ids[:m.k % 1048576 - 1] || [(m.k // 1048576)::int] || s.ids[m.k % 1048576 + 2:]
  from steps s join (
    select p.w, min(merges.r::bigint * 1048576 + p.pos) k
    from (select w, unnest(ids[:-2]) a, unnest(ids[2:]) b, generate_subscripts(ids[2:], 1) pos from steps) p
    join merges on merges.ab = p.a::bigint * 65536 + p.b
    group by p.w) m on s.w = m.w)
select s.w, s.ids from steps s join (select w, min(len(ids)) n from steps group by w) m on s.w = m.w and len(s.ids) = m.n order by s.w
"""
_DECODE = """
select doc, array_to_string(list(t order by pos), '') bytes
from ids join tokens on tokens.id = ids.id group by doc order by doc
"""


def read_ranks(path: str) -> bytes:
    """A vocabulary file: a line per token, its bytes in base64 and its rank."""
    with open(path, "rb") as f:
        return f.read()


def _gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of values from each start, one after the other."""
    ends = np.cumsum(lengths)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)]


class Coder:
    """Encodes and decodes with one vocabulary, in one process."""

    def __init__(self, vocabulary: bytes, pattern: str):
        lines = (line.split() for line in vocabulary.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        if max(self.ranks.values()) >= 65536:
            raise ValueError("ranks are packed into 16 bits each")
        self.pattern = regex.compile(pattern)
        self.decimal = [b"%d" % i for i in range(max(self.ranks.values()) + 1)]
        self.byte = [self.ranks[bytes([i])] for i in range(256)]
        self.byte_ids = np.array(self.byte, dtype=np.int32)
        self.merge = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.merge[a << 16 | b] = rank
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self._store("merges", {"ab": pa.array(self.merge.keys(), pa.int64()), "r": pa.array(self.merge.values(), pa.int32())})
        ids, tokens = pa.array(self.ranks.values(), pa.int32()), [t.decode("latin-1") for t in self.ranks]
        self._store("tokens", {"id": ids, "t": pa.array(tokens, pa.string())})
        self._forget()

    def _store(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.con.register("given", pa.table(columns))
        self.con.execute(f"create or replace table {name} as from given")
        self.con.unregister("given")

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.shown: list[bytes] = []
        self.flat, self.at = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def rest(self) -> None:
        """Give back the memory of what was learned: the process may go on to other work."""
        self._forget()
        self.con.execute("drop table if exists words")
        gc.collect()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)

    def words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct words and where each word's begin, the end added.

        Of each word the leftmost pair of least rank is contracted until none is left.
        """
        ready: list[tuple[int, list[int]]] = []
        part: list[int] = []
        made: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        squares = 0
        for i, word in enumerate(words):
            if (rank := self.ranks.get(word)) is not None:
                ready.append((i, [rank]))
            elif len(word) > LONGEST:
                ready.append((i, self._long(word)))
            else:
                part.append(i)
                squares += len(word) ** 2
                if squares > _SQUARES:
                    made.append(self._contract(words, part))
                    part, squares = [], 0
        if part:
            made.append(self._contract(words, part))
        made.append(
            (
                np.array([i for i, _ in ready], np.int64),
                np.array([len(x) for _, x in ready], np.int64),
                np.array([r for _, x in ready for r in x], np.int32),
            )
        )
        place, lengths, ids = (np.concatenate(c) for c in zip(*made))
        starts = np.cumsum(lengths) - lengths
        order = np.argsort(place)
        return _gather(ids, starts[order], lengths[order]), np.append(0, np.cumsum(lengths[order]))

    def _contract(self, words: list[bytes], part: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, lengths, ids) of some words, from one recursive query."""
        chosen = [words[i] for i in part]
        ids = self.byte_ids[np.frombuffer(b"".join(chosen), dtype=np.uint8)]
        ends = np.cumsum([0, *map(len, chosen)])
        self._store("words", {"w": pa.array(part, pa.int32()), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids))})
        found = self.con.sql(_ENCODE).to_arrow_table().combine_chunks()
        lists = found["ids"].chunk(0)
        return found["w"].to_numpy().astype(np.int64), lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().to_numpy()

    def _long(self, word: bytes) -> list[int]:
        """The same contraction with a heap and links, for words too long for the recursion."""
        ids: list[int | None] = [self.byte[c] for c in word]
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (r := self.merge.get(ids[i] << 16 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue  # one of the two has been contracted meanwhile
            ids[i], ids[j], after[i] = rank, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := self.merge.get(ids[x] << 16 | ids[y])) is not None:
                    heapq.heappush(heap, (r, x, ids[x], ids[y]))
        return [x for x in ids if x is not None]

    def _learn(self, stretches: set[str]) -> None:
        new = [x for x in stretches if x not in self.known]
        if not new:
            return
        split = [self.pattern.findall(x) for x in new]
        index = {w: i for i, w in enumerate({w: None for ws in split for w in ws})}
        ids, bounds = self.words([w.encode() for w in index])
        place = np.array([index[w] for ws in split for w in ws])
        counts = np.fromiter(map(len, split), np.int64, len(split))
        sizes = np.diff(bounds)[place]
        flat = _gather(ids, bounds[place], sizes)
        ends = np.append(0, np.cumsum(sizes))[np.cumsum(counts)]
        shown = [self.decimal[i] for i in flat.tolist()]
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
        cuts = [0, *ends.tolist()]
        self.shown += [b" ".join(shown[a:b]) for a, b in zip(cuts, cuts[1:])]
        self.flat = np.concatenate([self.flat, flat])
        self.at = np.concatenate([self.at, self.at[-1] + ends])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, bytes]]:
        """For each text its ids, and the same in decimal, joined by spaces."""
        split = [_STRETCH.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self._forget()
        self._learn({x for xs in split for x in xs})
        made = []
        for xs in split:
            index = np.fromiter(map(self.known.__getitem__, xs), np.int64, len(xs))
            starts = self.at[index]
            lengths = self.at[index + 1] - starts
            made.append((_gather(self.flat, starts, lengths), b" ".join(map(self.shown.__getitem__, index.tolist()))))
        return made

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """The bytes of each list of ids, aggregated in the order of their positions."""
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        made = [b""] * len(ids)
        if not lengths.sum():
            return made
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), lengths)
        flat = np.concatenate(ids).astype(np.int32)
        table = pa.table({"doc": doc, "pos": np.arange(len(flat), dtype=np.int32), "id": flat})
        self.con.register("ids", table)
        found = self.con.sql(_DECODE).to_arrow_table()
        self.con.unregister("ids")
        for i, text in zip(found["doc"].to_pylist(), found["bytes"].to_pylist()):
            made[i] = text.encode("latin-1")
        return made


_coders: dict[tuple[int, str], Coder] = {}
HELD.append(_coders.clear)


def coder(vocabulary: bytes, pattern: str) -> Coder:
    """The process's coder of a vocabulary, made once."""
    key = (hash(vocabulary), pattern)
    if key not in _coders:
        _coders[key] = Coder(vocabulary, pattern)
    return _coders[key]


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of some megabytes of text, the second column, at least one text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist()
    start, size = 0, 0
    for i, more in enumerate(sizes):
        if size and size + more > _TEXT_BYTES:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += more
    if sizes:
        yield batch.slice(start)


def code(docs: DataFrame, path: str, pattern: str, id_col="doc_id", text_col="text", with_ids: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids]) of whole texts; null is empty.

    Each match of the pattern is encoded by itself, no string is special. The ids are decoded again
    and the digest of those bytes returned. Every row gives one row, repeated ids included.
    """
    vocabulary = read_ranks(path)
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    fields += [("ids", pa.list_(pa.int32()))] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(vocabulary, pattern)
        for batch in batches:
            for part in _parts(batch):
                coded = own.encode([t or "" for t in part.column(1).to_pylist()])
                decoded = own.decode([ids for ids, _ in coded])
                columns = [
                    part.column(0),
                    pa.array([len(ids) for ids, _ in coded], pa.int64()),
                    pa.array([hashlib.sha256(shown).hexdigest() for _, shown in coded]),
                    pa.array([hashlib.sha256(b).hexdigest() for b in decoded]),
                ]
                if with_ids:
                    ends = np.cumsum([0, *[len(ids) for ids, _ in coded]])
                    columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([ids for ids, _ in coded]))))
                yield pa.RecordBatch.from_arrays(columns, [n for n, _ in fields])
        own.rest()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return chosen.mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, ids) of every row's whole text; null is empty."""
    return code(docs, path, pattern, id_col, text_col, with_ids=True).select("doc_id", "ids")


def decode(encoded: DataFrame, path: str, pattern: str, id_col="doc_id", ids_col="ids") -> DataFrame:
    """(doc_id, bytes) of every row's ids; null is empty. An id outside the vocabulary is an error."""
    vocabulary = read_ranks(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(vocabulary, pattern)
        top = len(own.ranks)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                ids = [np.asarray(x or [], dtype=np.int32) for x in part.column(1).to_pylist()]
                if any(len(x) and (x.min() < 0 or x.max() >= top) for x in ids):
                    raise ValueError("an id is not in the vocabulary")
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(own.decode(ids), pa.binary())], ["doc_id", "bytes"])

    chosen = encoded.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids"))
    return chosen.mapInArrow(run, "doc_id long, bytes binary")
