"""Benchmark decontamination by template windows: numbers, names and units as typed slots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwell.session import materialize

# Words of a template window, and how many of them must not be slots.
WINDOW = 10
LITERAL = 6
# Items shorter than WINDOW are compared whole if they have this many words that are no slots.
SHORT_LITERAL = 4
# A side of at most this many rows of one or two longs (16 MB) may be copied to every executor.
BROADCAST_ROWS = 1_000_000

# Number words and units of measure.
NUMBER_WORDS = (
    "two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
UNITS = (
    "mm cm m km inch inches feet foot yard yards mile miles mg g kg gram grams ton tons tonnes pound pounds ounce ounces ml l "
    "liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year "
    "years dollar dollars euro euros cent cents percent mph kmh degrees"
).split()
# Digits lose the marks between them; a capital that begins a sentence gets a caret before it.
_JOINED = (r"([0-9])[.,]([0-9])", "$1$2")
_BEGIN = (r"(^|[.!?:;\n])([^\p{L}\p{N}]*)(\p{Lu})", "$1$2^$3")
_BETWEEN = (r"[^\p{L}\p{M}\p{N}^]+", " ")
# Of words with single spaces between them: numbers, units after a number, other capitals.
_NUMBER = (rf"(?<![^ ])\^?(?:[0-9][^ ]*|(?i:{'|'.join(NUMBER_WORDS)})(?![^ ]))", "<num>")
_UNIT = (rf"<num> (?i:{'|'.join(UNITS)})(?![^ ])", "<num> <unit>")
_NAME = (r"(?<![^ ])\p{Lu}[^ ]*", "<name>")


def words(table: DataFrame, text: str) -> DataFrame:
    """Replaces the text column by own, its words with the carets, exact, its words in lower case, and shape, its template.

    The template has the words in lower case; numbers, units after a number, and capitals within a
    sentence are slots. Both are made by passes over the whole text, word by word alike.
    """
    rest = [c for c in table.columns if c != text]
    plain = F.replace(F.col(text), F.lit("^"), F.lit(" "))
    for pattern, to in (_JOINED, _BEGIN, _BETWEEN):
        plain = F.regexp_replace(plain, pattern, to)
    plain = table.select(*rest, F.trim(plain).alias("plain"))
    shape = F.col("plain")
    for pattern, to in (_NUMBER, _UNIT, _NAME):
        shape = F.regexp_replace(shape, pattern, to)
    shape = F.lower(F.replace(shape, F.lit("^"), F.lit("")))
    exact = F.lower(F.replace(F.col("plain"), F.lit("^"), F.lit("")))
    return plain.select(*rest, F.split("plain", " ").alias("own"), F.split(exact, " ").alias("exact"), F.split(shape, " ").alias("shape"))


def _inner(length: int) -> tuple[int, int]:
    """(step, size): of any so many neighbouring words, size of them in a row begin at a place that step divides."""
    step = max(1, length // 2)
    return step, length - step + 1


def _probes(words: Column, length: int) -> Column:
    """Keys of the inner windows that begin at every step-th word of a text."""
    step, size = _inner(length)
    last = F.size(words) - size
    places = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda p: F.xxhash64(F.lit(length), *[F.get(words, p + i) for i in range(size)]))


def _probed(window: Column, length: int) -> Column:
    """Keys of all inner windows by which a text that holds this window can show it."""
    step, size = _inner(length)
    return F.array(*[F.xxhash64(F.lit(length), *[F.get(window, F.lit(o + i)) for i in range(size)]) for o in range(step)])


def _keys(shape: Column, length: int) -> Column:
    """The key of every window of so many words of a template."""
    last = F.size(shape) - length
    place = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(place, lambda p: F.xxhash64(*[F.get(shape, p + i) for i in range(length)]))


def _windows(shape: Column, length: int) -> Column:
    """(pos, key) of every window."""
    return F.transform(_keys(shape, length), lambda key, pos: F.struct(pos.alias("pos"), key.alias("key")))


def _fits(shape: Column, item: Column, doc: Column) -> Column:
    """Slots that are filled alike in the item's window are filled alike in the document's."""
    value = lambda w: F.lower(F.replace(w, F.lit("^"), F.lit("")))
    at = lambda i: F.struct(F.get(shape, i).alias("s"), value(F.get(item, i)).alias("i"), value(F.get(doc, i)).alias("d"))
    slots = F.filter(F.transform(F.sequence(F.lit(0), F.size(shape) - 1), at), lambda p: p["s"].startswith("<"))
    own = F.transform(slots, lambda p: F.struct(p["s"].alias("s"), p["i"].alias("i")))
    return F.size(F.array_distinct(own)) == F.size(F.array_distinct(slots))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col="doc_id", text_col="text", item_col="item_id", item_text="text"
) -> DataFrame:
    """(doc_id, item_id, n_windows): documents that hold windows of a benchmark item's template.

    Numbers, names (capitals within a sentence) and units become typed slots, so a question with
    other parameters has the same template; a window counts if slots that the item fills alike are
    filled alike in the document too. Windows with fewer than LITERAL other words say too little
    and are not compared; items shorter than a window are compared whole if SHORT_LITERAL other
    words remain. Windows that are equal word by word, but for capitals, count whatever their slots, and
    so do short items. Null and empty texts match nothing; rows sharing an id add up, rows without one are
    not compared. Texts are read whole, whatever their length.
    """
    literal = lambda shape: F.size(F.filter(shape, lambda w: ~w.startswith("<")))
    part = lambda column, n: F.slice(column, F.col("w.pos") + 1, n)
    items = words(benchmark.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").cast("string").alias("text")), "text")
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shaped = words(given, "text").select("doc_id", "exact", "shape")
    lengths = items.select(F.size("shape").alias("n")).filter((F.col("n") < window) & (F.get("exact", F.lit(0)) != "")).distinct()
    wanted = {}
    for n in [window, *sorted(r.n for r in lengths.collect())]:  # at most window - 1 numbers
        whole = items if n == window else items.filter(F.size("shape") == n)
        keys = whole.select("item_id", "own", "shape", F.explode(_windows(F.col("shape"), n)).alias("w"))
        keys = keys.select("item_id", part("own", n).alias("wanted"), part("shape", n).alias("shape"), "w.key")
        keys = keys.filter(literal(F.col("shape")) >= (LITERAL if n == window else SHORT_LITERAL)).distinct()
        copies = whole.select("item_id", "exact", F.explode(_windows(F.col("exact"), n)).alias("w"))
        copies = copies.select("item_id", part("exact", n).alias("exact"), "w.key").filter(F.get("exact", F.lit(0)) != "").distinct()
        wanted[n] = keys, copies

    # One pass finds the documents that may hold a window, of whatever length: each window of n words covers an inner
    # one of about half the words that begins at every n/2-th word of the text, so few keys tell. What follows is exact.
    inner = [
        side.select(F.explode(_probed(F.col(column), n)).alias("key"))
        for n, (keys, copies) in wanted.items()
        for side, column in ((keys, "shape"), (copies, "exact"))
    ]
    known = materialize(reduce(DataFrame.union, inner).distinct(), "known")
    known = F.broadcast(known) if known.count() <= BROADCAST_ROWS else known
    probes = F.concat(*[_probes(F.col(column), n) for n in wanted for column in ("shape", "exact")])
    spread = shaped.select("doc_id", F.explode(probes).alias("key"))
    met = materialize(spread.join(known, "key", "left_semi").select("doc_id").distinct(), "hits")
    met = F.broadcast(met) if met.count() <= BROADCAST_ROWS else met
    again = materialize(given.join(met, "doc_id", "left_semi").withColumn("row", F.monotonically_increasing_id()), "texts")
    again = words(again, "text")

    made = []
    for n, (keys, copies) in wanted.items():
        shapes = again.select("row", "doc_id", "own", "shape", F.explode(_windows(F.col("shape"), n)).alias("w"))
        shapes = shapes.select("row", "doc_id", "w.pos", part("own", n).alias("found"), part("shape", n).alias("shape"), "w.key")
        fits = _fits(F.col("shape"), F.col("wanted"), F.col("found"))
        pairs = shapes.join(keys, ["key", "shape"]).select("row", "doc_id", "item_id", "pos", fits.alias("fits")).filter("fits")
        equal = again.select("row", "doc_id", "exact", F.explode(_windows(F.col("exact"), n)).alias("w"))
        equal = equal.select("row", "doc_id", "w.pos", part("exact", n).alias("exact"), "w.key")
        equal = equal.join(copies, ["key", "exact"]).select("row", "doc_id", "item_id", "pos", F.lit(False).alias("fits"))
        # A window that is found by its template already does not count again as an equal one.
        windows = pairs.union(equal).groupBy("row", "doc_id", "item_id", "pos").agg(F.greatest(F.count_if("fits"), F.lit(1)).alias("n"))
        made.append(windows.groupBy("doc_id", "item_id").agg(F.sum("n").alias("n_windows")))
    return reduce(DataFrame.union, made).groupBy("doc_id", "item_id").agg(F.sum("n_windows").alias("n_windows"))
