"""Phrase collocations: counts kept as streams in prefix and in suffix order, and read side by side.

A row of the count stream is a window: up to five words from one place on. In prefix order a phrase, all that
begins with it and nothing else stand together, so run lengths give the counts of all phrases, and a phrase's
own beginnings are the last shorter rows before it. In suffix order, words reversed, the same holds of its ends.
So one pass over either stream finds left counts, right counts and what extends a phrase by looking back at most
four rows of the stack, with no lookup by key.

Words are numbered by 63 bits of a hash of language and word, and windows are rows of numbers. A word that is
itself too rare is in no phrase that counts, so windows end before it; a bitmap of fixed size tells most of them.
Windows travel as packed runs, dealt by ranges of prefix order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwell.llm.spark import planned_bytes, shuffle_parts, written
from tickwell.llm.text import byte_spans, give_back

LONGEST = 5
LEAST = 100
TOP = 2000
NONE = -1
_WORDS = [f"w{i}" for i in range(1, LONGEST + 1)]

# Text read at once, in a task; words a range of windows should stand for; windows looked at to set the ranges.
_BATCH_BYTES = 8 << 20
_RANGE_WORDS = 2 << 20
_SEEN_PER_RANGE, _SEEN = 64, 1 << 20
# Bits of the bitmap of frequent words: 2 MB to every task. A word that only shares a bit with a frequent
# one costs room and changes no result.
_BITS = 24
# The most frequent words, whose numbers travel as two bytes: 512 KB to every task.
_BOOK = 1 << 16

# Bytes: what ends a piece, what ends a word, and capitals.
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

# ------------------------------------------------------------------ words of texts


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """(lang, text) rows in tables of about _BATCH_BYTES of text, one row at least."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        at = 0
        sizes = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        while at < len(sizes):
            upto = int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + _BATCH_BYTES - size)) + 1
            part = batch.slice(at, min(upto, len(sizes)) - at)
            held.append(part)
            size += int(sizes[min(upto, len(sizes)) - 1] - (sizes[at - 1] if at else 0))
            at = min(upto, len(sizes))
            if size >= _BATCH_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _spoken(table: pa.Table) -> Iterator[tuple[str, pa.Array, np.ndarray, np.ndarray, np.ndarray]]:
    """(lang, its words, their numbers, place of each spoken word among them, piece of each) of a table's texts."""
    for lang in pc.unique(table["lang"]).to_pylist():
        texts = table.filter(pc.equal(table["lang"], lang))["text"].combine_chunks().cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
        word = ~_GAPS[data]
        # A word ends where its text does, and so does its piece: texts count as pieces too.
        edges = np.zeros(len(data) + 1, dtype=bool)
        edges[offsets - offsets[0]] = True
        begins, ends = word & edges[:-1], word & edges[1:]
        begins[1:] |= word[1:] & ~word[:-1]
        ends[:-1] |= word[:-1] & ~word[1:]
        starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        piece = np.searchsorted(np.flatnonzero(_ENDS[data]), starts) + np.searchsorted(offsets - offsets[0], starts, side="right")
        packed = np.concatenate([[0], np.cumsum(stops - starts)])
        body = pa.py_buffer(_LOWER[data[word]])
        del data, word, edges, begins, ends, starts, stops
        coded = pa.Array.from_buffers(pa.large_string(), len(piece), [None, pa.py_buffer(packed), body]).dictionary_encode()
        yield lang, coded.dictionary, _numbers(lang, coded.dictionary), coded.indices.to_numpy(zero_copy_only=False), piece


def _numbers(lang: str, words: pa.Array) -> np.ndarray:
    """63-bit numbers of the words of a language."""
    prefix = np.frombuffer(lang.encode() + b"\n", dtype=np.uint8)
    bounds = np.frombuffer(words.buffers()[1], dtype=np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", dtype=np.uint8)[bounds[0] : bounds[-1]]
    own = byte_spans(prefix, 11).of(np.zeros(1, dtype=np.int64), np.array([len(prefix)]))[0]
    bounds = bounds - bounds[0]
    hashes = byte_spans(data, 7).of(bounds[:-1], bounds[1:])
    mixed = (hashes ^ own) * np.uint64(0x9FB21C651E98DF25)
    return ((mixed ^ (mixed >> np.uint64(32))) >> np.uint64(1)).astype(np.int64)


def _slid(words: np.ndarray, piece: np.ndarray, none: int) -> list[np.ndarray]:
    """From each word on, the five words of its piece up to the first that is none."""
    columns, n = [words], len(words)
    for step in range(1, LONGEST):
        after = np.full(n, none, dtype=words.dtype)
        if step < n:
            goes_on = (piece[step:] == piece[:-step]) & (columns[-1][: n - step] != none)
            after[: n - step] = np.where(goes_on, words[step:], none)
        columns.append(after)
    return columns


def _counted(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    """(id, lang, word, n, seen): words and how often they are spoken, and one of so many windows (seen; no word)."""
    kinds = pa.schema([("id", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("seen", pa.list_(pa.int64()))])
    at = 0
    for table in _gathered(batches):
        for lang, words, numbers, place, piece in _spoken(table):
            n = np.bincount(place, minlength=len(words))
            size = len(words)
            columns = [pa.array(numbers), pa.array([lang] * size, pa.string()), words.cast(pa.string()), pa.array(n), pa.nulls(size, kinds[4].type)]
            yield pa.RecordBatch.from_arrays(columns, schema=kinds)
            # Every so many words, a few bytes apart from each other whatever a text repeats.
            chosen = np.arange(at % every, len(place), every)
            at += len(place)
            if len(chosen):
                window = [c[chosen] for c in _slid(numbers[place], piece, NONE)]
                flat, size = pa.array(np.stack(window, axis=1).reshape(-1)), len(chosen)
                seen = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * LONGEST), flat)
                empty = pa.nulls(size, pa.string())
                yield pa.RecordBatch.from_arrays([pa.nulls(size, pa.int64()), empty, empty, pa.nulls(size, pa.int64()), seen], schema=kinds)
    give_back()


# ---------------------------------------------------------------- packed windows


def _sorted_rows(columns: list[np.ndarray], largest: int, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows in order, counts) of columns of codes up to largest; n counts them, each row once by default."""
    bits = max(1, int(largest).bit_length())
    per = 63 // bits
    keys = []  # codes side by side in as few integers as they fit
    for i in range(0, len(columns), per):
        key = np.zeros(len(columns[0]), dtype=np.int64)
        for c in columns[i : i + per]:
            key = key << bits | c
        keys.append(key)
    order = np.lexsort(keys[::-1])
    new = np.ones(len(order), dtype=bool)
    if len(order):
        new[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    first = np.flatnonzero(new)
    del keys
    rows = np.stack([c[order[first]] for c in columns], axis=1)
    if n is None or not len(first):
        return rows, np.diff(np.append(first, len(order)))
    return rows, np.add.reduceat(n[order], first)


def _cut(rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where each bound, a row, belongs among sorted rows."""
    low = np.searchsorted(rows[:, 0], bounds[:, 0], side="left")
    high = np.searchsorted(rows[:, 0], bounds[:, 0], side="right")
    for i in np.flatnonzero(low < high):
        a, b = low[i], high[i]
        for k in range(1, LONGEST):
            if a < b:
                part = rows[a:b, k]
                a, b = a + np.searchsorted(part, bounds[i, k], side="left"), a + np.searchsorted(part, bounds[i, k], side="right")
        low[i] = a
    return low


def _packed(rows: np.ndarray, n: np.ndarray, ids: np.ndarray, pages: np.ndarray) -> bytes:
    """Sorted windows as compressed bytes. rows hold places in ids, one more; 0 is no word. pages: of ids in the book, or -1."""
    used = np.zeros(len(ids) + 1, dtype=bool)
    used[rows] = True
    used[0] = True
    code = (np.cumsum(used) - 1)[rows]
    own, page = (x[np.flatnonzero(used)[1:] - 1] for x in (ids, pages))
    kind = np.uint16 if len(own) < 1 << 16 else np.uint32
    listed = page >= 0
    places = page[listed].astype(np.uint16)
    head = np.array([len(rows), len(places), len(own) - len(places), kind().itemsize], dtype=np.int64)
    parts = [head, np.diff(own[~listed], prepend=0), np.diff(places, prepend=np.uint16(0)), np.minimum(n, 255).astype(np.uint8), n[n >= 255].astype(np.int64), np.ascontiguousarray(code.T.astype(kind))]
    raw = b"".join(p.tobytes() for p in parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(blob: bytes, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(columns, n, ids) of what _packed took; ids only those in it."""
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    size, listed, known, width = np.frombuffer(raw, dtype=np.int64, count=4).tolist()
    at = 32 + 8 * known
    own = np.cumsum(np.frombuffer(raw, dtype=np.int64, count=known, offset=32))
    places = np.cumsum(np.frombuffer(raw, dtype=np.uint16, count=listed, offset=at), dtype=np.uint16)
    ids = np.sort(np.concatenate([own, book[places]]))
    at += 2 * listed
    n = np.frombuffer(raw, dtype=np.uint8, count=size, offset=at).astype(np.int64)
    many = np.flatnonzero(n == 255)
    at += size
    n[many] = np.frombuffer(raw[at : at + 8 * len(many)], dtype=np.int64)
    codes = np.frombuffer(raw[at + 8 * len(many) :], dtype=np.uint16 if width == 2 else np.uint32)
    return codes.reshape(LONGEST, size), n, ids


def _windows(batches: Iterator[pa.RecordBatch], common: np.ndarray, bounds: np.ndarray, book: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(range, windows): windows of two words and more, equal ones as one, packed by the ranges between bounds."""
    for table in _gathered(batches):
        ranges, blobs = [], []
        for _lang, _words, numbers, place, piece in _spoken(table):
            slot = numbers & ((1 << _BITS) - 1)
            often = np.flatnonzero(common[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
            often = often[np.argsort(numbers[often])]
            ids = numbers[often]
            pages = np.searchsorted(book, ids)
            pages[(pages == len(book)) | (np.append(book, NONE)[pages] != ids)] = -1
            code = np.zeros(len(numbers), dtype=np.int32)
            code[often] = np.arange(1, len(often) + 1)  # in the order of numbers; 0 is no word
            columns = _slid(code[place], piece, 0)
            whole = columns[1] > 0
            rows, n = _sorted_rows([c[whole] for c in columns], len(often))
            cuts = [0, *_cut(rows, _coded(bounds, ids)).tolist(), len(rows)]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                if a < b:
                    ranges.append(i)
                    blobs.append(_packed(rows[a:b], n[a:b], ids, pages))
        yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array(blobs, pa.binary())], ["range", "windows"])
    give_back()


def _coded(bounds: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Bounds in the codes of sorted ids. For a word not among them the next code stands, and nothing after it."""
    code = np.where(bounds == NONE, 0, np.searchsorted(ids, bounds) + 1)
    missing = ~np.isin(bounds, ids) & (bounds != NONE)
    code[:, 1:][np.logical_or.accumulate(missing, axis=1)[:, :-1]] = 0
    return code


def _runs(table: pa.Table, least: int, book: np.ndarray) -> pa.Table:
    """Counts of the phrases of two words and more that the windows of a range begin with.

    A phrase too rare is left out, but for those of the range's first and last window: others may hold more of them.
    """
    parts = [_unpacked(blob, book) for blob in table["windows"].to_pylist()]
    ids = np.unique(np.concatenate([own for *_, own in parts]))
    places = [np.concatenate([[0], np.searchsorted(ids, own) + 1]).astype(np.int32) for *_, own in parts]
    n = np.concatenate([n for _, n, _ in parts])
    columns = [np.concatenate([place[rows[i]] for place, (rows, *_) in zip(places, parts)]) for i in range(LONGEST)]
    del parts, places
    rows, n = _sorted_rows(columns, len(ids), n)
    del columns
    numbers = np.append(NONE, ids)
    new = np.zeros(len(rows), dtype=bool)
    new[0] = True
    out = [np.zeros((0, LONGEST + 1), dtype=np.int64)]
    for length in range(1, LONGEST + 1):
        new[1:] |= rows[1:, length - 1] != rows[:-1, length - 1]
        if length == 1:
            continue
        first = np.flatnonzero(new)
        sums = np.add.reduceat(n, first)
        keep = sums >= least
        keep[[0, -1]] = True
        keep &= rows[first, length - 1] > 0
        found = np.full((int(keep.sum()), LONGEST + 1), NONE, dtype=np.int64)
        found[:, :length] = numbers[rows[first[keep], :length]]
        found[:, LONGEST] = sums[keep]
        out.append(found)
    found = np.concatenate(out)
    del rows, n, new, out
    give_back()
    return pa.table([pa.array(found[:, i]) for i in range(LONGEST + 1)], [*_WORDS, "n"])


def _bounds(seen: list[list[int]], common: np.ndarray, ranges: int) -> np.ndarray:
    """Windows at even distances among those seen, each cut before its first rare word as all are."""
    rows = np.array(seen, dtype=np.int64).reshape(-1, LONGEST)
    slot = rows & ((1 << _BITS) - 1)
    known = (common[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool) & (rows != NONE)
    rows = np.where(np.logical_and.accumulate(known, axis=1), rows, NONE)
    rows = rows[rows[:, 1] != NONE]
    rows = rows[np.lexsort(rows.T[::-1])]
    at = (np.arange(1, ranges) * len(rows)) // ranges
    return np.unique(rows[at], axis=0) if len(rows) else rows


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(w1 .. w5, n) of all phrases of one to five words that occur least times; their words; all words by language.

    Words are (id, lang, word, n); the third table is (lang, total), of all words, rare ones too.
    """
    spark = docs.sparkSession
    given = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    spoken = max(1, planned_bytes(docs) // 3)  # about how many words: texts take twice the bytes of their files
    ranges = max(shuffle_parts(docs), spoken // _RANGE_WORDS)
    every = max(1, spoken // min(_SEEN, _SEEN_PER_RANGE * ranges))
    kinds = "id long, lang string, word string, n long, seen array<long>"
    counted = written(given.mapInArrow(lambda batches: _counted(batches, every), kinds), "words")
    heard = counted.filter("seen is null")
    totals = heard.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = heard.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    words = written(frequent, "vocabulary")

    # The bitmap has a fixed number of bytes, so at most so many rows reach the driver.
    slot = F.col("id").bitwiseAND((1 << _BITS) - 1)
    bits = words.groupBy(F.shiftright(slot, 3).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1, cast(id & 7 as int))")).alias("bits"))
    common = np.zeros(1 << (_BITS - 3), dtype=np.uint8)
    found = bits.toArrow()
    common[found["at"].to_numpy()] = found["bits"].to_numpy()
    seen = counted.filter("seen is not null").select("seen").toArrow()["seen"].to_pylist()
    book = words.orderBy(F.desc("n"), "id").limit(_BOOK).select("id").toArrow()["id"].to_numpy()
    shared = spark.sparkContext.broadcast((common, _bounds(seen, common, ranges), np.sort(book)))

    packed = given.mapInArrow(lambda batches: _windows(batches, *shared.value), "range int, windows binary")
    kinds = ", ".join(f"{w} long" for w in _WORDS) + ", n long"
    dealt = packed.repartition(ranges, "range").groupBy("range")
    partial = dealt.applyInArrow(lambda key, table: _runs(table, least, shared.value[2]), kinds)
    phrases = partial.groupBy(*_WORDS).agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    single = words.select(F.col("id").alias("w1"), *[F.lit(NONE).cast("long").alias(w) for w in _WORDS[1:]], "n")
    return written(phrases.unionByName(single), "phrases"), words, totals


# ------------------------------------------------------------------ count streams


def _looked_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each row of a stream the counts of its beginnings, and says which of them it extends as often as they occur.

    The rows of a range stand together in order, after the beginnings its first row has in ranges before.
    """
    held = np.zeros(LONGEST + 1, dtype=np.int64)  # counts of the last phrase of each length
    names = None
    for batch in batches:
        names = [*batch.schema.names, "begins"]
        words = np.stack([batch.column(w).to_numpy() for w in _WORDS], axis=1)
        n = batch.column("n").to_numpy()
        length = (words != NONE).sum(axis=1)
        begins = np.zeros((len(n), LONGEST - 1), dtype=np.int64)
        for k in range(1, LONGEST):
            last = np.maximum.accumulate(np.where(length == k, np.arange(1, len(n) + 1), 0))
            value = np.append(held[k], n)[last]
            begins[:, k - 1] = np.where(length > k, value, 0)
            if len(n):
                held[k] = value[-1]
        flat = pa.array(begins.reshape(-1))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * (LONGEST - 1)), flat)
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], names)


def _stream(phrases: DataFrame, words: list[Column], keep: list[str]) -> DataFrame:
    """phrases with the counts of their beginnings (begins[k - 1]: of the first k words) in the given order of words.

    The stream is dealt by ranges of its order. A range's first row gets the beginnings that stand in ranges before
    along with it, four rows at most; they are not given back.
    """
    parts = shuffle_parts(phrases)
    ordered = phrases.select(*[w.alias(f"w{i}") for i, w in enumerate(words, 1)], "n", *keep)
    laid = written(ordered.repartitionByRange(parts, *_WORDS).withColumn("range", F.spark_partition_id()), "stream")
    first = laid.groupBy("range").agg(F.min(F.struct(*_WORDS)).alias("first"))
    starts = [
        F.struct(*[(F.col(f"first.{w}") if i < k else F.lit(NONE).cast("long")).alias(w) for i, w in enumerate(_WORDS)])
        for k in range(1, LONGEST)
    ]
    before = first.select(F.col("range"), F.explode(F.array(*starts)).alias("b"), "first").filter("b <> first")
    before = before.select("range", "b.*").distinct()
    lent = before.join(laid.select(*_WORDS, "n", F.col("range").alias("home")), _WORDS).filter("home <> range").drop("home")
    rows = laid.withColumn("lent", F.lit(False)).unionByName(lent.withColumn("lent", F.lit(True)), allowMissingColumns=True)
    sorted_rows = rows.repartition(parts, "range").sortWithinPartitions("range", *_WORDS)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sorted_rows.schema.fields)
    return sorted_rows.mapInArrow(_looked_back, schema + ", begins array<long>").filter("not lent").drop("lent", "range")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's phrases of two to five words that hold together best.

    a is the phrase's count within pieces of text, of least at least. The cut with the lowest score
    floor(1000 a n / (l r)) counts, n being all words of the language; of equal scores the first cut. A phrase
    that a longer candidate holds as often as it occurs is left out. The first top by score, a and phrase remain.

    Null texts are empty and a null language is und. Repeated rows and rows without doc_id count like any other.
    Texts are counted whole, whatever their length; an empty table gives no rows.
    """
    phrases, words, totals = phrase_counts(docs, least)
    columns = [F.col(w) for w in _WORDS]
    size = sum((c != NONE).cast("int") for c in columns)

    def turned(size_of: Column) -> list[Column]:
        whole = F.array(*_WORDS)
        return [F.when(size_of >= i, F.element_at(whole, F.greatest(size_of - i + 1, F.lit(1)).cast("int"))).otherwise(F.lit(NONE).cast("long")) for i in range(1, LONGEST + 1)]

    lefts = _stream(phrases, columns, [])
    lefts = lefts.withColumn("size", size).withColumnRenamed("begins", "lefts")
    both = _stream(lefts, turned(F.col("size")), ["size", "lefts"]).withColumnRenamed("begins", "rights")
    both = written(both.select(*[c.alias(w) for c, w in zip(turned(F.col("size")), _WORDS)], "n", "size", "lefts", "rights"), "both")
    longer = both.filter("size > 2")

    def held(counts: str, inner: list[Column]) -> DataFrame:
        return longer.filter(F.element_at(counts, (F.col("size") - 1).cast("int")) == F.col("n")).select(*[c.alias(w) for c, w in zip(inner, _WORDS)])

    without_last = [F.when(F.lit(i) < F.col("size"), F.col(w)).otherwise(F.lit(NONE).cast("long")) for i, w in enumerate(_WORDS, 1)]
    without_first = [*[F.col(w) for w in _WORDS[1:]], F.lit(NONE).cast("long")]
    extended = held("lefts", without_last).union(held("rights", without_first)).distinct()
    alone = both.filter("size > 1").join(extended, _WORDS, "left_anti")
    spoken = words.join(totals, "lang").select(F.col("id").alias("w1"), "lang", "total")

    def exact(c: Column) -> Column:
        return c.cast("decimal(38,0)")

    cuts = []
    for k in range(1, LONGEST):
        l, r = F.col("lefts")[k - 1], F.element_at("rights", F.greatest(F.col("size") - k, F.lit(1)).cast("int"))
        product = exact(l) * exact(r)
        score = F.call_function("div", exact(F.lit(1000)) * exact(F.col("n")) * exact(F.col("total")), product)
        cuts.append(F.when(F.col("size") > k, F.struct(score.cast("long").alias("score"), F.lit(k).alias("k"), l.alias("l"), r.alias("r"))))
    scored = alone.join(spoken, "w1").withColumn("cut", F.least(*cuts))
    scored = scored.select("lang", *_WORDS, F.col("n").alias("a"), F.col("total").alias("n"), "cut.score", "cut.l", "cut.r")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    ranked = scored.withColumn("rank", F.rank().over(best)).filter(F.col("rank") <= top).drop("rank")
    ranked = written(ranked.withColumn("row", F.monotonically_increasing_id()), "ranked")
    at = F.posexplode(F.filter(F.array(*_WORDS), lambda w: w != NONE)).alias("place", "id")
    texts = ranked.select("row", at).join(words.select("id", "word"), "id")
    texts = texts.groupBy("row").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    named = ranked.join(texts, "row")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    named = named.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, top: int = TOP) -> str:
    """The same rows from DuckDB: every phrase spelled out and counted by its text."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
    with pieces as (
        select coalesce(lang, 'und') as lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), '[.,;:!?\\x0A-\\x0D]')) as piece
        from documents
    ), worded as (
        select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as ws from pieces
    ), totals as (
        select lang, sum(len(ws)) as n from worded group by lang
    ), placed as (
        select lang, ws, unnest(range(1, len(ws) + 1)) as i from worded
    ), spelled as (
        select lang, unnest(list_transform(range(1, least(5, len(ws) - i + 1) + 1), lambda k: ws[i:i + k - 1])) as ws from placed
    ), counted as (
        select lang, ws, count(*) as f from spelled group by lang, ws having count(*) >= {least}
    ), inner_parts as (
        select lang, f, unnest([ws[1:len(ws) - 1], ws[2:]]) as ws from counted where len(ws) > 2
    ), candidates as (
        select c.* from counted c where len(c.ws) > 1
        and not exists (select 1 from inner_parts i where i.lang = c.lang and i.ws = c.ws and i.f = c.f)
    ), cut as (
        select lang, ws, f, unnest(range(1, len(ws))) as k from candidates
    ), scored as (
        select cut.lang, cut.ws, cut.f as a, cut.k, l.f as l, r.f as r, t.n::bigint as n,
               ((1000::hugeint * cut.f * t.n::hugeint) // (l.f::hugeint * r.f))::bigint as score
        from cut join counted l on l.lang = cut.lang and l.ws = cut.ws[1:cut.k]
        join counted r on r.lang = cut.lang and r.ws = cut.ws[cut.k + 1:]
        join totals t on t.lang = cut.lang
    ), lowest as (
        select * from scored qualify row_number() over (partition by lang, ws order by score, k) = 1
    )
    select lang, row_number() over (partition by lang order by score desc, a desc, array_to_string(ws, ' ')) as rank,
           array_to_string(ws, ' ') as phrase, a, l, r, n, score
    from lowest
    qualify rank <= {top}
    """
