"""Near duplicates of embeddings by an epsilon grid order join on the leading principal dimensions.

For unit vectors a cosine of c is a distance of sqrt(2 - 2c) = eps. The vectors are turned to their principal axes (fitted on
all of them by one sum of products), sorted by the grid cells of width eps on the leading axes, and cut into sequence
intervals. Intervals form a tree of runs of the sequence; the join descends it from the root by pairs of runs and skips those
whose boxes are provably too far apart. Boxes bound the leading axes and the length of what is left of a vector. Tasks
join the intervals that remain by halving them further; what is left is compared in double precision.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftloom.functions.numbering import numbered
from driftloom.llm.common import Steps, small_batches
from driftloom.llm.components import components
from driftloom.session import passing


# Bytes of vectors that an interval may hold, children of a node of the tree, and partners that one copy of an interval meets.
BLOCK_BYTES, FAN, RUN = 4 << 20, 32, 16


@dataclass(frozen=True)
class Grid:
    """axes: leading dimensions of the grid that orders the vectors; bounds: those of the boxes, which may be more, as they cost
    little beside the vectors; block: vectors of an interval (fewer, if they are long); leaf: vectors of a box."""

    cosine: float = 0.9
    axes: int = 8
    bounds: int = 32
    block: int = 4096
    leaf: int = 256

    @property
    def limit(self) -> float:
        """Squared distance up to which boxes may hold a link; rounding is far below the last term."""
        return max(2 - 2 * self.cosine, 0.0) + 1e-6

    @property
    def eps(self) -> float:
        return math.sqrt(max(2 - 2 * self.cosine, 0.0)) or 1e-9

    def rows(self, size: int) -> int:
        return max(1, min(self.block, BLOCK_BYTES // (8 * size)))

    def leaves(self, size: int) -> int:
        """Most leaves that an interval can have."""
        return self.rows(size) // (self.leaf // 2 + 1) + 1


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # squares of very large and very small components stay finite
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _project(unit: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Place on the leading axes, and the length of what is left: points are never farther apart here than the vectors are."""
    flat = unit @ axes
    return np.concatenate([flat, np.sqrt(np.maximum(1 - (flat * flat).sum(1, keepdims=True), 0))], 1)


def _axes(classes: DataFrame, size: int, how: Grid) -> np.ndarray:
    """Leading principal axes, one a column. Products are summed per task, then by rows of the matrix in Spark, which returns."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                u = _unit(_matrix(batch.column(0)))
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(list(total))], ["line", "sums"])

    def added(rows: pa.Table) -> pa.Table:
        total = _matrix(rows.column("sums").combine_chunks()).sum(0)
        return pa.table([rows.column("line").combine_chunks().slice(0, 1), pa.array([total])], ["line", "sums"])

    kind = "line long, sums array<double>"
    lines = classes.select("v").mapInArrow(products, kind).groupBy("line").applyInArrow(added, kind).toArrow().sort_by("line")
    gram = _matrix(lines.column("sums").combine_chunks())
    _, axes = np.linalg.eigh((gram + gram.T) / 2)
    return axes[:, ::-1][:, : max(how.axes, how.bounds)]


def _leaves(cells: np.ndarray, leaf: int) -> list[int]:
    """Where leaves of an interval begin: each has more than half of `leaf` vectors and ends where the most leading cell changes."""
    changed = cells[1:] != cells[:-1]
    axis = np.where(changed.any(1), changed.argmax(1), cells.shape[1])  # between i and i + 1
    starts = [0]
    while len(cells) - starts[-1] > leaf:
        first, end = starts[-1] + leaf // 2, starts[-1] + leaf
        starts.append(end - int(axis[first:end][::-1].argmin()))
    return starts


def _blocks(classes: DataFrame, size: int, axes: np.ndarray, how: Grid) -> DataFrame:
    """One row per sequence interval: block, low and high corners of the boxes of its leaves, and its vectors as bytes.

    An interval is `how.rows(size)` neighbours in the order of all vectors, however many partitions sorted them.
    """
    k = min(how.axes, axes.shape[1])

    def cells(batches):
        for batch in batches:
            if batch.num_rows:
                place = np.floor(_unit(_matrix(batch.column(2))) @ axes[:, :k] / how.eps).astype(np.int32)
                parts = [*batch.columns, *[pa.array(place[:, i]) for i in range(k)]]
                yield pa.RecordBatch.from_arrays(parts, ["node", "copies", "v", *[f"c{i}" for i in range(k)]])

    def box(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rank")
        unit = _unit(_matrix(rows.column("v").combine_chunks()))
        flat = _project(unit, axes)
        leaves = _leaves(np.floor(flat[:, :k] / how.eps), how.leaf)
        values = [
            rows.column("block").combine_chunks().slice(0, 1),
            pa.array([np.minimum.reduceat(flat, leaves).ravel()]),
            pa.array([np.maximum.reduceat(flat, leaves).ravel()]),
            pa.array([rows.column("node").to_numpy().astype("<i8").tobytes()], pa.binary()),
            pa.array([rows.column("copies").to_numpy().astype("<i8").tobytes()], pa.binary()),
            pa.array([unit.astype("<f8").tobytes()], pa.binary()),
        ]
        return pa.table(values, ["block", "low", "high", "nodes", "copies", "vectors"])

    kinds = "node long, copies long, v array<double>, " + ", ".join(f"c{i} int" for i in range(k))
    order = [*[f"c{i}" for i in range(k)], "node"]
    placed = classes.select("node", "copies", "v").mapInArrow(cells, kinds)
    placed = numbered(placed, order, "rank")
    placed = placed.select("node", "copies", "v", "rank", F.floor(F.col("rank") / how.rows(size)).cast("long").alias("block"))
    shape = "block long, low array<double>, high array<double>, nodes binary, copies binary, vectors binary"
    return placed.groupBy("block").applyInArrow(box, shape)


def _near_blocks(blocks: DataFrame, size: int, axes: np.ndarray, how: Grid, steps: Steps) -> DataFrame:
    """Pairs a <= b of intervals of which two leaves may hold a link, found by descending the tree of runs of leaves."""
    width, per = axes.shape[1] + 1, how.leaves(size)
    leaf = F.explode(F.sequence(F.lit(0), F.floor(F.size("low") / width).cast("int") - 1)).alias("leaf")
    corner = lambda c: F.slice(c, F.col("leaf") * width + 1, F.lit(width)).alias(c)
    level = blocks.select("block", "low", "high", leaf).select((F.col("block") * per + F.col("leaf")).alias("id"), corner("low"), corner("high"))
    levels, most = [steps.keep(level)], blocks.count() * per
    up = F.floor(F.col("id") / FAN).cast("long")
    while most > 1:
        ends = [F.array(*[f(F.col(c)[i]) for i in range(width)]).alias(c) for f, c in ((F.min, "low"), (F.max, "high"))]
        levels.append(steps.keep(levels[-1].groupBy(up.alias("id")).agg(*ends)))
        most = -(-most // FAN)
    gap = F.aggregate(
        F.arrays_zip("low_a", "high_a", "low_b", "high_b"),
        F.lit(0.0),
        lambda s, z: s + F.pow(F.greatest(F.lit(0.0), z["low_b"] - z["high_a"], z["low_a"] - z["high_b"]), 2.0),
    )
    pairs = levels[-1].select(F.col("id").alias("a"), F.col("id").alias("b"))
    for level in levels[-2::-1]:
        below = lambda s: level.select(  # noqa: B023, E731
            up.alias(s), F.col("id").alias(f"id_{s}"), F.col("low").alias(f"low_{s}"), F.col("high").alias(f"high_{s}")
        )
        met = pairs.join(below("a"), "a").join(below("b"), "b").where("id_a <= id_b").where(gap <= how.limit)
        pairs = steps.keep(met.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")))
    whole = lambda c: F.floor(F.col(c) / per).cast("long").alias(c)
    return pairs.select(whole("a"), whole("b")).distinct()


def _forest(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """Smallest number reachable from each of n numbers over the links."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        after = label.copy()
        np.minimum.at(after, u, low)
        np.minimum.at(after, v, low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after


class _Join:
    """Links between two intervals (or inside one), by halving."""

    def __init__(self, x, cx, y, cy, axes, same: bool, how: Grid):
        self.x, self.y, self.cx, self.cy, self.same, self.how = x, y, cx, cy, same, how
        self.px, self.py = _project(x, axes), _project(y, axes)
        self.links_x, self.links_y = np.zeros(len(x), np.int64), np.zeros(len(y), np.int64)
        n = len(x) + (0 if same else len(y))
        self.offset = 0 if same else len(x)
        self.label = np.arange(n)
        self.visit(0, len(x), 0, len(y))

    def visit(self, i0, i1, j0, j1):
        if self.same and j1 <= i0:
            return  # the mirror image has been joined
        a, b = self.px[i0:i1], self.py[j0:j1]
        gap = np.maximum(0, np.maximum(b.min(0) - a.max(0), a.min(0) - b.max(0)))
        if (gap * gap).sum() > self.how.limit:
            return
        if i1 - i0 <= self.how.leaf and j1 - j0 <= self.how.leaf:
            self.compare(i0, i1, j0, j1)
            return
        im, jm = (i0 + i1) // 2, (j0 + j1) // 2
        rows = [(i0, im), (im, i1)] if i1 - i0 > self.how.leaf else [(i0, i1)]
        cols = [(j0, jm), (jm, j1)] if j1 - j0 > self.how.leaf else [(j0, j1)]
        for r in rows:
            for c in cols:
                self.visit(*r, *c)

    def compare(self, i0, i1, j0, j1):
        x, y = self.x[i0:i1], self.y[j0:j1]
        cosine = x @ y.T
        near = np.argwhere(np.abs(cosine - self.how.cosine) < 1e-9)
        for i, j in near:  # the last bits decide: one plain dot product
            cosine[i, j] = math.fsum(x[i] * y[j])
        found = cosine >= self.how.cosine
        if self.same:
            found &= (np.arange(i0, i1)[:, None] < np.arange(j0, j1)[None, :])
        u, v = np.nonzero(found)
        if not len(u):
            return
        self.links_x[i0:i1] += found @ self.cy[j0:j1]
        self.links_y[j0:j1] += self.cx[i0:i1] @ found
        u, v = self.label[u + i0], self.label[v + j0 + self.offset]
        names, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        small = names[_forest(at[: len(u)], at[len(u) :], len(names))]
        step = np.arange(len(self.label))
        step[names] = small
        self.label = step[self.label]


def _linked(pairs: DataFrame, blocks: DataFrame, axes: np.ndarray, size: int, how: Grid) -> DataFrame:
    """(node, links, root): for each pair of intervals, links of each linked node, and another node of its group in the pair.

    A task gets an interval once for each run of RUN neighbouring partners, and then its partners one after another.
    """

    def one(a, b) -> pa.RecordBatch:
        (na, ca, x), (nb, cb, y), same = a[1:], b[1:], a[0] == b[0]
        j = _Join(x, ca, y, cb, axes, same, how)
        node, links = (na, j.links_x + j.links_y) if same else (np.concatenate([na, nb]), np.concatenate([j.links_x, j.links_y]))
        keep = links > 0
        return pa.RecordBatch.from_arrays(
            [pa.array(node[keep]), pa.array(links[keep]), pa.array(node[j.label][keep])], ["node", "links", "root"]
        )

    def join(batches):
        held = None
        for batch in batches:
            for i in range(batch.num_rows):
                block, first, nodes, copies, vectors = (batch.column(c)[i] for c in ("block", "first", "nodes", "copies", "vectors"))
                read = lambda value, kind: np.frombuffer(value.as_buffer(), kind)
                row = (block.as_py(), read(nodes, "<i8"), read(copies, "<i8"), read(vectors, "<f8").reshape(-1, size))
                if first.as_py():
                    held = row
                else:
                    yield one(held, row)

    runs = pairs.withColumn("run", F.floor(F.col("b") / RUN).cast("long"))
    data = blocks.select("block", "nodes", "copies", "vectors")
    heads = runs.select("a", "run").distinct().select("a", "run", F.col("a").alias("block"), F.lit(True).alias("first"))
    mates = runs.select("a", "run", F.col("b").alias("block"), F.lit(False).alias("first"))
    rows = heads.unionByName(mates).join(data, "block").repartition(F.col("a"), F.col("run"))
    rows = rows.sortWithinPartitions("a", "run", F.col("first").desc(), "block")
    return rows.mapInArrow(join, "node long, links long, root long")


def near_duplicates(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", how: Grid | None = None) -> DataFrame:
    """(key, n_links, component_id, kept) for each row.

    n_links: other rows within the cosine, copies included. component_id: smallest key reachable over links, itself
    included. Vectors that are null, empty, all zero, or hold a null or non-finite component link with nothing; neither
    do vectors of different lengths. Equal vectors are joined once, with their number. A null key is never a component's name
    unless its row is alone.
    """
    how = how or Grid()
    small_batches()
    spark = vectors.sparkSession
    steps = Steps(spark)
    v = F.col(embedding).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(key).alias("id"), F.when(good, v).alias("v"))
    rows = rows.select("id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(2), "v").alias("h2"))
    same = rows.where("v is not null").groupBy("h1", "h2", "v").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = steps.keep(same.withColumn("node", F.monotonically_increasing_id()))
    found = None
    for size in sorted(r[0] for r in classes.select(F.size("v")).distinct().collect()):
        part = classes.where(F.size("v") == size)
        axes = _axes(part, size, how)
        with passing(spark):
            blocks = steps.keep(_blocks(part, size, axes, how))
        linked = steps.keep(_linked(_near_blocks(blocks, size, axes, how, steps), blocks, axes, size, how))
        steps.drop(blocks)
        found = linked if found is None else found.unionByName(linked)
    if found is None:
        found = spark.createDataFrame([], "node long, links long, root long")
    groups = steps.keep(components(found.select(F.col("node").alias("u"), F.col("root").alias("v")), steps))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    named = classes.join(links, "node", "left").join(groups, "node", "left").select(
        "h1", "h2", "first", "copies", F.coalesce("component", "node").alias("component"), F.coalesce("links", F.lit(0)).alias("links")
    )
    named = steps.keep(named)
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    answer = named.join(least, "component").select("h1", "h2", (F.col("links") + F.col("copies") - 1).alias("links"), "component_id")
    out = rows.withColumn("h1", F.when(F.col("v").isNotNull(), F.col("h1"))).select("id", "h1", "h2").join(answer, ["h1", "h2"], "left")
    return out.select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.expr("id <=> coalesce(component_id, id)").alias("kept"),
    )
