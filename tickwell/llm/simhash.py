"""Near-duplicates by SimHash and multi-index hashing."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwell.llm.spark import components
from tickwell.llm.text import give_back, normal_words
from tickwell.session import materialize

# A bucket of more fingerprints than this is not probed pair by pair.
HOT_BUCKET = 4096
# Up to this many distinct fingerprints four segments cost least, then three, beyond it two.
FOUR_SEGMENTS = 1 << 22
THREE_SEGMENTS = 1 << 25
_CHUNK = 1 << 16


def _votes(hashes: np.ndarray) -> np.ndarray:
    """For each of 64 bits, the number of hashes that have it."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def _majority(votes: np.ndarray, total: int) -> int:
    return int(np.packbits(votes * 2 > total, bitorder="little").view(np.int64)[0])


def shingle_hashes(text: str | None, size: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles of a text, in chunks; A-Z lower-cased.

    Fewer words than size: the whole sequence is the one shingle. No words: nothing.
    """
    kept, starts, ends = normal_words((text or "").encode("utf-8", "surrogatepass").lower())
    if len(starts):
        view, digest = memoryview(kept.tobytes()), xxhash.xxh64_intdigest
        last = max(1, len(starts) - size + 1)
        ends = ends[min(size, len(ends)) - 1 :]
        for at in range(0, last, _CHUNK):
            spans = zip(starts[at : min(at + _CHUNK, last)].tolist(), ends[at : at + _CHUNK].tolist())
            yield np.array([digest(view[a:b], 42) for a, b in spans], dtype=np.uint64)


def fingerprint(text: str | None, size: int = 4) -> int:
    """SimHash over word shingles as a signed 64-bit number; 0 for a text without words."""
    votes, total = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text, size):
        votes += _votes(hashes)
        total += len(hashes)
    return _majority(votes, total)


def fingerprints(docs: DataFrame, size: int, id_col="doc_id", text_col="text", carry: list[str] | None = None) -> DataFrame:
    """(doc_id, fp, rest) of whole texts; rest holds the columns to carry, null if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([fingerprint(t.as_py(), size) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), made, batch.column(2)], ["doc_id", "fp", "rest"])
        give_back()

    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(None).cast("int")
    chosen = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"), rest.alias("rest"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), chosen.schema["rest"]])
    return chosen.mapInArrow(run, schema)


def _segments(radius: int, count: int) -> list[tuple[int, int, int]]:
    """(shift, width, radius) of each segment: the radii plus one each add up to radius + 1.

    Of two fingerprints within radius, one segment differs by its own radius at most, for
    otherwise the differences would add up to more. More fingerprints take fewer, wider segments, as
    buckets fill up; the balls around them grow.
    """
    parts = 4 if count <= FOUR_SEGMENTS else 3 if count <= THREE_SEGMENTS else 2
    share = [(radius + 1) // parts + (i < (radius + 1) % parts) for i in range(parts)]
    widths = [64 // parts + (i < 64 % parts) for i in range(parts)]
    return [(sum(widths[:i]), widths[i], n - 1) for i, n in enumerate(share) if n]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def _segment(fp: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(fp, shift).bitwiseAND(F.lit((1 << width) - 1))


def _keys(fp: Column, segments: list[tuple[int, int, int]], probes: bool) -> Column:
    """The buckets of a fingerprint: its own ones, or all in the Hamming balls around its segments."""

    def buckets(number: int, shift: int, width: int, radius: int) -> Column:
        own = _segment(fp, shift, width)
        masks = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius if probes else 0)])
        return F.transform(masks, lambda m: F.struct(F.lit(number).alias("seg"), own.bitwiseXOR(m).alias("key")))

    return F.explode(F.concat(*[buckets(i, *segment) for i, segment in enumerate(segments)]))


def _bucketed(nodes: DataFrame, columns: list[str], table: str, segments: list[tuple[int, int, int]], probes: bool) -> DataFrame:
    """(seg, key, columns) of each node's buckets in a table."""
    return nodes.select(*columns, _keys(F.col(table), segments, probes).alias("k")).select(*columns, "k.seg", "k.key")


def link(nodes: DataFrame, table: str, radius: int) -> DataFrame:
    """(node, component) of distinct nodes linked by their fingerprints, found by multi-index hashing.

    nodes: (node, fingerprint column), one row per node. Two nodes are linked if their fingerprints differ
    by radius bits at most. The joins compare whole fingerprints as they read the buckets, so
    only pairs within reach become rows.

    First each node is compared with the smallest node of its buckets; then pairs are looked up
    whose nodes these links leave apart, so a group of many near copies does not give all its pairs. A
    bucket of thousands is not probed at all: its nodes, and those whose probes meet it, get the keys
    of the whole ball of half the radius instead.
    """
    segments = _segments(radius, nodes.count())

    def near(x: str, y: str) -> Column:
        return F.bit_count(F.col(f"{x}.{table}").bitwiseXOR(F.col(f"{y}.{table}"))) <= radius

    carried = ["node", table]
    own = _bucketed(nodes, carried, table, segments, False)
    first = own.groupBy("seg", "key").agg(F.min(F.struct(*carried)).alias("y"), F.count("*").alias("n")).filter("n > 1")
    met = own.join(first, ["seg", "key"]).select(F.struct(*carried).alias("x"), "y")
    met = met.filter((F.col("x.node") != F.col("y.node")) & near("x", "y"))
    edges = materialize(met.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "stars")
    marked = nodes.join(components(edges), "node", "left").select(nodes["*"], F.coalesce("component", "node").alias("part"))
    marked = materialize(marked, "nodes")
    pairs = [edges]
    carried = ["node", "part", table]
    own, probes = (_bucketed(marked, carried, table, segments, probes) for probes in (False, True))
    crowded = own.groupBy("seg", "key").agg(F.count("*").alias("n")).filter(f"n > {HOT_BUCKET}").select("seg", "key")
    crowded = materialize(crowded, "crowded")
    if not crowded.isEmpty():
        met = probes.join(crowded, ["seg", "key"], "left_semi").select(carried).distinct()
        pairs.append(materialize(_dense(met, table, radius, near), "pairs"))
        own = own.join(crowded, ["seg", "key"], "left_anti")
    joined = probes.alias("x").join(
        own.alias("y"),
        (F.col("x.seg") == F.col("y.seg"))
        & (F.col("x.key") == F.col("y.key"))
        & (F.col("x.node") > F.col("y.node"))
        & (F.col("x.part") != F.col("y.part"))
        & near("x", "y"),
    )
    pairs.append(materialize(joined.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")), "pairs"))
    return components(reduce(DataFrame.union, pairs))


def _dense(nodes: DataFrame, table: str, radius: int, near: Callable[[str, str], Column]) -> DataFrame:
    """Pairs that connect the nodes of crowded buckets, by keys of the balls of half the radius.

    Two fingerprints share such a key if they are within the radius. Each node is paired with the
    smallest of each of its keys that holds a node of another part. Nodes of that one's part, and
    those within its radius, are settled among themselves; all others are compared with every node of the key.
    """
    masks = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in _ball(64, -(-radius // 2))])
    keyed = nodes.select("*", F.explode(F.transform(masks, lambda m: F.col(table).bitwiseXOR(m))).alias("key"))
    first = keyed.groupBy("key").agg(F.min(F.struct(*nodes.columns)).alias("y"), F.min("part").alias("p"), F.max("part").alias("q"))
    met = keyed.join(first.filter("p <> q").select("key", "y"), "key").filter(F.col("node") != F.col("y.node"))
    met = materialize(met.select("key", F.struct(*nodes.columns).alias("x"), "y"), "met")
    apart = met.filter(F.col("x.part") != F.col("y.part"))
    direct = apart.filter(near("x", "y")).select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    others = apart.filter(~near("x", "y")).select("key", "x").alias("l").join(met.select("key", F.col("x").alias("y")).alias("r"), "key")
    others = others.filter((F.col("x.part") != F.col("y.part")) & near("x", "y"))
    others = others.select(F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b"))
    return direct.union(others).distinct()


def near_duplicates(docs: DataFrame, size: int = 4, radius: int = 4, id_col="doc_id", text_col="text", carry: list[str] | None = None) -> DataFrame:
    """(doc_id, fingerprint, component_id[, rest]) for every row; rest holds the columns to carry.

    Fingerprints link at radius or fewer differing bits; component_id is the smallest doc_id
    reachable. Texts without words (null, empty) have fingerprint zero and link like any other.
    A row without doc_id gets its fingerprint and, as it cannot be named, no component. Rows that share
    an id link by their fingerprints like any others, and where one id is the smallest of two fingerprints these link too.
    """
    made = materialize(fingerprints(docs, size, id_col, text_col, carry), "fingerprints")
    named = made.filter("doc_id is not null")
    nodes = materialize(named.groupBy("fp").agg(F.min("doc_id").alias("node")), "nodes")
    linked = link(nodes, "fp", radius)
    groups = nodes.join(linked, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return made.join(groups, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
        *(["rest"] if carry else []),
    )
