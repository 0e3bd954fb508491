"""Near-duplicate vectors: exact threshold pairs by dual traversal of cover trees."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwell.llm.spark import components
from tickwell.session import materialize

# Vectors a task compares at most on each side; larger cells are dealt out in blocks of this size.
CELL = 4096
# Upper tree nodes over all labels, and sampled vectors they are chosen from: bounds of what the driver holds.
TOP_NODES = 1024
TOP_SAMPLE = 8192
_SLACK = 1e-9


def unit(rows: list[list[float]]) -> np.ndarray:
    """Vectors scaled to length one in double precision, without overflow."""
    x = np.array(rows, dtype=np.float64)
    x /= np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0, 2 - 2 * (a @ b.T)))


def net_order(x: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` rows, each the farthest from those before: any prefix is a net, so levels nest."""
    chosen = [0]
    gap = distances(x, x[:1])[:, 0]
    while len(chosen) < min(most, len(x)):
        far = int(gap.argmax())
        if gap[far] <= _SLACK:
            break
        chosen.append(far)
        gap = np.minimum(gap, distances(x, x[far : far + 1])[:, 0])
    return np.array(chosen)


class Tree:
    """Levels with radii 1, 1/2, ... down to about the threshold; level nodes nest.

    Of each level: centers (rows of x), the radius that covers all below, and the parent's place in
    the level above. leaf is each row's node in the last level.
    """

    def __init__(self, x: np.ndarray, least: float):
        self.x = x
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        centers, leaf = np.zeros(1, np.int64), np.zeros(len(x), np.int64)
        self._level(centers, np.zeros(1, np.int64), leaf)
        radius = 1.0
        while radius >= least and len(centers) < len(x):
            centers, leaf = self._split(centers, leaf, radius)
            parents = self.above[centers]
            self._level(centers, parents, leaf)
            radius /= 2
        self.leaf = leaf

    def _level(self, centers: np.ndarray, parents: np.ndarray, leaf: np.ndarray) -> None:
        gap = np.sqrt(np.maximum(0, 2 - 2 * (self.x * self.x[centers[leaf]]).sum(1)))
        radius = np.zeros(len(centers))
        np.maximum.at(radius, leaf, gap)
        self.levels.append((centers, radius, parents))
        self.above = leaf

    def _split(self, centers: np.ndarray, leaf: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """Cover each node's rows by balls of the radius, the first around its own center."""
        made, own = [], np.empty(len(leaf), np.int64)
        order = np.argsort(leaf, kind="stable")
        bounds = np.searchsorted(leaf[order], np.arange(len(centers) + 1))
        for node, center in enumerate(centers):
            rest = order[bounds[node] : bounds[node + 1]]
            pick = center
            while len(rest):
                near = distances(self.x[rest], self.x[pick : pick + 1])[:, 0] <= radius
                near |= rest == pick
                own[rest[near]] = len(made)
                made.append(pick)
                rest = rest[~near]
                pick = rest[0] if len(rest) else -1
        return np.array(made), own


def linked(a: Tree, b: Tree, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows (of a, of b) with at least the cosine, part by part.

    Node pairs farther apart than both covering radii and the threshold are left out with all below.
    """
    reach = np.sqrt(2 - 2 * cosine) + _SLACK
    alive = np.ones((1, 1), dtype=bool)
    deep = max(len(a.levels), len(b.levels))
    for depth in range(deep):
        la, lb = a.levels[min(depth, len(a.levels) - 1)], b.levels[min(depth, len(b.levels) - 1)]
        up_a = la[2] if depth < len(a.levels) else np.arange(len(la[0]))
        up_b = lb[2] if depth < len(b.levels) else np.arange(len(lb[0]))
        below = np.empty((len(la[0]), len(lb[0])), dtype=bool)
        for at in range(0, len(la[0]), 512):
            part = slice(at, at + 512)
            gap = distances(a.x[la[0][part]], b.x[lb[0]])
            below[part] = (gap <= la[1][part, None] + lb[1] + reach) & alive[up_a[part]][:, up_b]
        alive = below
    for at in range(0, len(a.x), 512):
        met = alive[a.leaf[at : at + 512]]
        columns = np.flatnonzero(met.any(0)[b.leaf])
        rows, found = np.nonzero((a.x[at : at + 512] @ b.x[columns].T >= cosine) & met[:, b.leaf[columns]])
        yield rows + at, columns[found]


def _compare(cosine: float, batch: pa.Table) -> pa.Table:
    """Of one task: for each node, the copies it links to; and edges that join what is linked."""
    side = np.array(batch["side"].to_pylist())
    ids, copies = batch["node"].to_numpy(), batch["copies"].to_numpy()
    x = unit(batch["e"].to_pylist())
    least = np.sqrt(2 - 2 * cosine)
    first = np.flatnonzero(side == 0)
    second = np.flatnonzero(side == 1)
    same = not (side == 1).any() and bool(batch["inner"][0].as_py())
    links = np.zeros(len(ids), dtype=np.int64)
    label = np.arange(len(ids))
    if same:
        tree = Tree(x, least)
        found = linked(tree, tree, cosine)
    elif len(first) and len(second):
        found = linked(Tree(x[first], least), Tree(x[second], least), cosine)
    else:
        found = iter(())
    for rows, columns in found:
        if same:
            other = rows != columns
            rows, columns = rows[other], columns[other]
            np.add.at(links, rows, copies[columns])
        else:
            rows, columns = first[rows], second[columns]
            np.add.at(links, rows, copies[columns])
            np.add.at(links, columns, copies[rows])
        cuts = np.flatnonzero(np.diff(rows, prepend=-1)) if len(rows) else []
        for start, end in zip(cuts, [*cuts[1:], len(rows)]):
            roots = np.unique(np.append(label[columns[start:end]], label[rows[start]]))
            if len(roots) > 1:
                label[np.isin(label, roots[1:])] = roots[0]
    joined = np.flatnonzero(label != np.arange(len(ids)))
    counted = np.flatnonzero(links)
    return pa.table(
        {
            "a": np.concatenate([ids[counted], ids[joined]]),
            "b": pa.array([None] * len(counted) + ids[label[joined]].tolist(), pa.int64()),
            "links": np.concatenate([links[counted], np.zeros(len(joined), np.int64)]),
        }
    )


def near_vectors(embeddings: DataFrame, cosine: float = 0.93, id_col="vec_id", vector_col="embedding", label_col="label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row, over exact pairs of one label.

    Vectors that are null, empty or zero, or hold null or non-finite components, and rows without
    label link with nothing; vectors of different lengths are not compared. Equal vectors of a label
    are compared once and counted as many times as they occur. Labels with more than CELL distinct
    vectors get the upper levels of a cover tree, chosen from a sample of bounded size; every vector
    then goes to its nearest node's cell, and to those of higher number whose ball it may reach, so
    each pair meets in one task. Cells beyond CELL vectors are dealt out in pairs of blocks.
    Rows sharing a vec_id count as different vectors of one component.
    """
    e = F.transform(F.col(f"`{vector_col}`"), lambda v: v.cast("double"))
    given = embeddings.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").cast("string").alias("label"), e.alias("e")
    )
    number = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    sound = F.coalesce(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.forall("e", number)
        & F.exists("e", lambda v: v != 0),
        F.lit(False),
    )
    given = given.select("vec_id", "label", F.when(sound, F.col("e")).alias("e"), F.when(sound, F.xxhash64("e")).alias("h"))
    grouped = given.filter("e is not null").groupBy("label", "h", "e").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    nodes = materialize(grouped.withColumn("space", F.concat_ws(":", F.size("e"), "label")), "vectors")

    tops = _top_nodes(nodes)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spaces = batch.column("space").to_pylist()
            homes, gaps = np.zeros(len(spaces), np.int64), np.zeros(len(spaces))
            for space in set(spaces) & set(tops):
                rows = np.flatnonzero([s == space for s in spaces])
                gap = distances(unit(batch.column("e").take(pa.array(rows)).to_pylist()), tops[space])
                homes[rows], gaps[rows] = gap.argmin(1), gap.min(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(homes), pa.array(gaps)], [*batch.schema.names, "home", "gap"])

    chosen = nodes.select("space", "node", "copies", "e")
    placed = chosen.mapInArrow(assign, "space string, node long, copies long, e array<double>, home long, gap double")
    large = [s for s in tops]
    balls: dict[str, np.ndarray] = {s: np.full(len(t), -1.0) for s, t in tops.items()}
    if large:
        for row in placed.filter(F.col("space").isin(large)).groupBy("space", "home").agg(F.max("gap").alias("r")).collect():
            balls[row.space][row.home] = row.r
    reach = float(np.sqrt(2 - 2 * cosine)) + _SLACK

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spaces, homes = batch.column("space").to_pylist(), batch.column("home").to_numpy()
            rows, cells = [np.arange(len(spaces))], [homes]
            for space in set(spaces) & set(tops):
                own = np.flatnonzero([s == space for s in spaces])
                gap = distances(unit(batch.column("e").take(pa.array(own)).to_pylist()), tops[space])
                # the exact gap of rounded distances may be a little more: the slack covers it
                meets = (gap <= balls[space] + reach + _SLACK) & (balls[space] >= 0) & (np.arange(len(balls[space])) > homes[own][:, None])
                at, cell = np.nonzero(meets)
                rows.append(own[at])
                cells.append(cell)
            at = pa.array(np.concatenate(rows))
            side = pa.array(np.concatenate([np.zeros(len(spaces), np.int32), np.ones(len(at) - len(spaces), np.int32)]))
            columns = [batch.column(n).take(at) for n in ("space", "node", "copies", "e")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate(cells)), side], ["space", "node", "copies", "e", "cell", "side"])

    visits = materialize(placed.mapInArrow(visit, "space string, node long, copies long, e array<double>, cell long, side int"), "visits")
    sizes = visits.groupBy("space", "cell").agg(
        F.ceil(F.count_if(F.col("side") == 0) / CELL).alias("own"), F.ceil(F.count_if(F.col("side") == 1) / CELL).alias("other")
    )
    dealt = visits.join(sizes, ["space", "cell"])
    block = F.pmod(F.xxhash64("node"), F.greatest(F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other")), F.lit(1)))
    dealt = dealt.withColumn("block", block)
    task = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    number = F.col("block")
    inner = F.transform(
        F.sequence(F.lit(0), F.col("own") - 1),
        lambda j: F.when(j >= number, task(0, number, j, 0)).otherwise(task(0, j, number, 1)),
    )
    none = F.array().cast("array<struct<kind:int,i:bigint,j:bigint,side:int>>")
    outer = F.when(F.col("other") > 0, F.transform(F.sequence(F.lit(0), F.col("other") - 1), lambda j: task(1, number, j, 0))).otherwise(none)
    visitor = F.when(F.col("own") > 0, F.transform(F.sequence(F.lit(0), F.col("own") - 1), lambda i: task(1, i, number, 1))).otherwise(none)
    keyed = dealt.select(
        "space", "cell", "node", "copies", "e", F.explode(F.when(F.col("side") == 0, F.concat(inner, outer)).otherwise(visitor)).alias("t")
    ).select("space", "cell", "node", "copies", "e", "t.*", ((F.col("t.kind") == 0) & (F.col("t.i") == F.col("t.j"))).alias("inner"))

    def compare(table: pa.Table) -> pa.Table:
        return _compare(cosine, table)

    found = materialize(keyed.groupBy("space", "cell", "kind", "i", "j").applyInArrow(compare, "a long, b long, links long"), "found")
    counts = found.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    joined = components(found.filter("b is not null").select("a", "b"))
    named = (
        nodes.join(counts, "node", "left")
        .join(joined, "node", "left")
        .select("label", "h", "e", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component"))
    )
    named = materialize(named, "named")
    return (
        given.alias("g")
        .join(named.alias("n"), (F.col("g.label") == F.col("n.label")) & (F.col("g.h") == F.col("n.h")) & (F.col("g.e") == F.col("n.e")), "left")
        .select(
            "g.vec_id",
            F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).alias("n_links"),
            F.coalesce("component", "g.vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


def _top_nodes(nodes: DataFrame) -> dict[str, np.ndarray]:
    """Of each large label, the centers of its upper tree level; at most TOP_NODES in all."""
    large = nodes.groupBy("space").count().filter(F.col("count") > CELL).orderBy(F.desc("count"), "space").limit(TOP_NODES // 2).collect()
    total = sum(r["count"] for r in large)
    tops = {}
    if not large:
        return tops
    share = {r.space: max(2, min(-(-r["count"] // (CELL // 2)), TOP_NODES * r["count"] // total)) for r in large}
    bar = F.lit(0.0)
    for r in large:
        drawn = max(2 * share[r.space], TOP_SAMPLE * r["count"] // total)
        bar = F.when(F.col("space") == r.space, F.lit(min(1.0, drawn / r["count"]))).otherwise(bar)
    sample = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1 << 30)) < bar * (1 << 30)).select("space", "node", "e").collect()
    for space, most in share.items():
        rows = [r.e for r in sorted(sample, key=lambda r: r.node) if r.space == space]
        if rows:
            x = unit(rows)
            tops[space] = x[net_order(x, most)]
    return tops
