"""Exact nearest-neighbour imputation from a space tree over the donors that is built once.

Fit cuts the donors by medians into leaves of about equal size, and stores them with each leaf's bounding box. A search
takes two rounds. First every receiver asks the nearest leaf that holds k donors; its k-th distance there bounds what may
still be nearer, and in the second round it asks only the other leaves whose box is within that distance. So what is
exchanged grows with the receivers, and a further transform neither reads nor writes the donors again. Rows with the same
columns missing are leaves of their own, which keeps the bounds exact where columns are missing. Leaves are found by a tree over
their boxes, and donors inside a leaf by a finer tree that the task builds, so no receiver is held against all leaves or all donors.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftloom.functions.columns import nan_to_null
from driftloom.functions.joins import BROADCAST_ROWS, lookup_join, row_bound
from driftloom.session import durable

# Donors of a leaf, about; and leaves at most of one tree, whose boxes every task of a search holds.
DONORS_PER_BLOCK = 32_768
MOST_LEAVES = 16_384
# Donors, about, from which the tree's cuts are taken. The cuts only balance the work.
SAMPLE = 200_000
# Cells of a distance matrix that are computed at once.
CELLS = 1 << 20
# Donors of a leaf of the tree that a task builds, and receivers that it looks for at once.
FINE, AT_ONCE = 32, 8192


def squared_distances(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Squared Euclid over the columns present in both rows, scaled up to `width` columns; inf if none is."""
    total = np.zeros((len(a), len(b)))
    shared = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        gap = a[:, i, None] - b[None, :, i]
        both = ~np.isnan(gap)
        total += np.where(both, gap * gap, 0.0)
        shared += both
    return np.where(shared > 0, total * (width / np.maximum(shared, 1)), np.inf)


def box_distances(x: np.ndarray, low: np.ndarray, high: np.ndarray, width: int) -> np.ndarray:
    """What squared_distances of a row and any row inside a box is at least. NaN bounds: all rows of the box miss the column."""
    total, shared = np.zeros((len(x), len(low))), np.zeros((len(x), len(low)))
    for i in range(x.shape[1]):
        at = x[:, i, None]
        gap = np.maximum(0.0, np.maximum(low[None, :, i] - at, at - high[None, :, i]))
        both = ~np.isnan(gap)
        total += np.where(both, gap * gap, 0.0)
        shared += both
    return np.where(shared > 0, total * (width / np.maximum(shared, 1)), np.inf)


def grow(sample: np.ndarray, per_leaf: float, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A tree as (column, cut) of its inner nodes in heap order: the children of node i are 2i + 1 and 2i + 2; column -1 is a leaf.

    Each node is cut at the median of the column in which its rows are spread most, measured by the spread of the whole sample.
    """
    depth = 0
    while 2 ** (depth + 1) <= most and len(sample) / 2**depth > per_leaf:
        depth += 1
    column, cut = np.full(2**depth - 1, -1), np.zeros(2**depth - 1)
    known = np.where(np.isnan(sample), -np.inf, sample)
    groups = {0: np.arange(len(sample))}
    for node in range(len(column)):
        rows = groups.pop(node, None)
        if rows is None or len(rows) < 2:
            continue
        part = sample[rows]
        held = np.isfinite(part)
        extent = np.where(held.any(0), np.where(held, part, -np.inf).max(0) - np.where(held, part, np.inf).min(0), 0.0)
        best = int(np.argmax(extent))
        if not extent[best] > 0:
            continue
        values = np.sort(part[held[:, best], best])
        middle = values[(len(values) - 1) // 2]
        # a cut below the largest value, so that no side is empty
        at = middle if middle < values[-1] else values[np.searchsorted(values, middle) - 1]
        column[node], cut[node] = best, at
        left = known[rows, best] <= at
        groups[2 * node + 1], groups[2 * node + 2] = rows[left], rows[~left]
    return column, cut


def leaf_number(x: np.ndarray, column: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The leaf of each row; a missing value goes left."""
    at = np.zeros(len(x), np.int64)
    known = np.where(np.isnan(x), -np.inf, x)
    row = np.arange(len(x))
    while len(column):
        inside = at < len(column)
        here = np.where(inside, at, 0)
        inner = inside & (column[here] >= 0)
        if not inner.any():
            break
        right = known[row, np.maximum(column[here], 0)] > cut[here]
        at = np.where(inner, 2 * at + 1 + right, at)
    return at


def _rows(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().fill_null(float("nan")).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), width)


def _scaled(gaps: Iterable[np.ndarray], width: int, whole: bool) -> np.ndarray:
    """The distances that squared_distances tells, from the gaps of each column. whole: no gap is NaN."""
    total, shared = 0.0, 0
    for gap in gaps:
        both = True if whole else ~np.isnan(gap)
        total = total + (gap * gap if whole else np.where(both, gap * gap, 0.0))
        shared = shared + both
    return np.sqrt(np.where(np.greater(shared, 0), total * (width / np.maximum(shared, 1)), np.inf))


class _Tree:
    """Boxes (points are boxes too) in an order in which each node of a tree is one run; leaves hold at most `most` of them.

    levels: (low, high, first child, children) of the nodes of each level; a node that is cut no more is carried along as its only child.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int, least: int = 1):
        """Cuts lie between two values of a column, so that halves don't overlap, where that leaves `least` boxes on each side."""
        n = len(low)
        self.whole = bool(np.isfinite(low).all() and np.isfinite(high).all())
        middle = np.nan_to_num(low if high is low else low / 2 + high / 2)
        # from one value of a column to the next, on average; a node is cut where its values lie farthest apart, as few look across
        gap = [(c.max() - c.min()) / max(len(np.unique(c)) - 1, 1) for c in middle.T]
        order, starts, cuts = np.arange(n), np.array([0, n]), []
        while (np.diff(starts) > most).any():
            size = np.diff(starts)
            large = size > most
            at = middle[order]
            extent = np.maximum.reduceat(at, starts[:-1]) - np.minimum.reduceat(at, starts[:-1])
            column = np.maximum(extent / size[:, None], np.minimum(extent, gap)).argmax(1)
            node = np.repeat(np.arange(len(size)), size)
            moved = np.flatnonzero(large[node])
            value = at[np.arange(n), column[node]]
            order[moved] = order[moved][np.lexsort((value[moved], node[moved]))]
            value = middle[order, column[node]]
            runs = np.append(np.flatnonzero(np.append(True, (node[1:] != node[:-1]) | (value[1:] != value[:-1]))), n)
            half = starts[:-1] + size // 2
            after = np.searchsorted(runs, half, "right")
            before, after = runs[after - 1], runs[after]
            cut = np.where(half - before <= after - half, before, after)
            cut = np.where((cut - starts[:-1] >= least) & (starts[1:] - cut >= least), cut, half)
            cuts.append(np.where(large, 2, 1))
            starts = np.sort(np.append(starts, cut[large]))
        self.order, self.starts = order, starts
        levels = [(np.minimum.reduceat(low[order], starts[:-1]), np.maximum.reduceat(high[order], starts[:-1]), None, None)]
        for children in reversed(cuts):
            first = np.cumsum(children) - children
            below, above = levels[-1][:2]
            levels.append((np.minimum.reduceat(below, first), np.maximum.reduceat(above, first), first, children))
        self.levels = levels[::-1]

    def apart(self, x: np.ndarray, low: np.ndarray, high: np.ndarray, at: np.ndarray, mine: np.ndarray, width: int) -> np.ndarray:
        """From each row to the box at the same place of `at`, by the columns `mine`."""
        gaps = (np.maximum(0.0, np.maximum(low[at, i] - x[:, i], x[:, i] - high[at, i])) for i in mine)
        return _scaled(gaps, width, self.whole)

    def home(self, x: np.ndarray, mine: np.ndarray, width: int) -> np.ndarray:
        """A leaf near each row: of two halves always the nearer one."""
        node = np.zeros(len(x), np.int64)
        for (_, _, first, children), (low, high, _, _) in zip(self.levels, self.levels[1:]):
            left, right = first[node], first[node] + children[node] - 1
            node = np.where(self.apart(x, low, high, right, mine, width) < self.apart(x, low, high, left, mine, width), right, left)
        return node

    def within(self, x: np.ndarray, limit: np.ndarray, mine: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """(row, leaf, distance) for all leaves at most `limit` from a row; None if there are too many for several rows at once."""
        row, node, upper = np.arange(len(x)), np.zeros(len(x), np.int64), None
        for low, high, first, children in self.levels:
            if upper is not None:
                row, node = _spread(row, upper[0][node], upper[1][node])
            if len(row) > CELLS and len(x) > 1:
                return None
            d = self.apart(x[row], low, high, node, mine, width)
            near = d <= limit[row]
            row, node, d, upper = row[near], node[near], d[near], (first, children)
        return row, node, d

    def members(self, row: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place in the order) of all that lies in the leaves."""
        return _spread(row, self.starts[leaf], self.starts[leaf + 1] - self.starts[leaf])


def _spread(row: np.ndarray, first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row `count` times, with the numbers from `first`."""
    ends = np.cumsum(count)
    return np.repeat(row, count), np.repeat(first - ends + count, count) + np.arange(ends[-1] if len(ends) else 0)


def _by_gaps(x: np.ndarray, cols: np.ndarray) -> Iterable[tuple[np.ndarray, np.ndarray]]:
    """(rows, those of `cols` that they have), one for each set of missing columns; rows without any are left out."""
    for gone in np.unique(np.isnan(x[:, cols]), axis=0):
        if not gone.all():
            yield np.flatnonzero((np.isnan(x[:, cols]) == gone).all(1)), np.flatnonzero(~gone)


def _halves(run, rows: np.ndarray) -> list:
    """run(rows), in smaller parts where it tells by None that they are too many."""
    found = run(rows)
    if found is not None:
        return [found]
    return [*_halves(run, rows[: len(rows) // 2]), *_halves(run, rows[len(rows) // 2 :])]


def nearest(x: np.ndarray, donors: np.ndarray, ranks: np.ndarray, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, donor, distance): the first k donors of each row by (distance, rank), in that order. Donors all miss the same columns."""
    cols = np.flatnonzero(~np.isnan(donors).any(0))
    held = donors[:, cols]
    tree = _Tree(held, held, max(FINE, 2 * k) if np.isfinite(held).all() else len(held), k)
    held, ranked = held[tree.order], ranks[tree.order]
    most = int(np.diff(tree.starts).max())

    def first(row: np.ndarray, place: np.ndarray, d: np.ndarray):
        order = np.lexsort((ranked[place], d, row))
        row, place, d = row[order], place[order], d[order]
        begin = np.searchsorted(row, row)
        kept = np.arange(len(row)) - begin < k
        return row[kept], place[kept], d[kept]

    def some(rows: np.ndarray):
        at = x[np.ix_(rows, cols)]
        limit = np.full(len(rows), np.inf)

        def measured(row: np.ndarray, leaf: np.ndarray):
            parts = []
            for a in range(0, len(row), step := max(1, CELLS // most)):
                r, of = row[a : a + step], leaf[a : a + step]
                place = tree.starts[of][:, None] + np.arange(most)
                outside = place >= tree.starts[of + 1][:, None]
                place[outside] = 0
                d = _scaled((at[r, i][:, None] - held[place, i] for i in mine), width, tree.whole)
                d[outside] = np.inf
                bound = np.minimum(limit[r], np.partition(d, k - 1, axis=1)[:, k - 1] if most >= k else np.inf)
                kept = (d <= bound[:, None]) & np.isfinite(d)
                parts.append((r[np.nonzero(kept)[0]], place[kept], d[kept]))
            return parts

        home = tree.home(at, mine, width)
        found = first(*(np.concatenate(c) for c in zip(*measured(np.arange(len(rows)), home))))
        pairs, take = None, 4
        while pairs is None or len(pairs[0]):
            full = np.flatnonzero(np.bincount(found[0], minlength=len(rows)) >= k)
            limit[full] = found[2][np.searchsorted(found[0], full, "right") - 1]
            if pairs is None:
                pairs = tree.within(at, limit, mine, width)
                if pairs is None:
                    return None
                row, leaf, d = (c[pairs[1] != home[pairs[0]]] for c in pairs)
                order = np.lexsort((d, row))
                pairs = row[order], leaf[order], d[order]
            else:
                pairs = tuple(c[pairs[2] <= limit[pairs[0]]] for c in pairs)
            # the nearest leaves first, as they may bring the limit down
            now = np.arange(len(pairs[0])) - np.searchsorted(pairs[0], pairs[0]) < take
            if now.any():
                found = first(*(np.concatenate(c) for c in zip(found, *measured(pairs[0][now], pairs[1][now]))))
            pairs, take = tuple(c[~now] for c in pairs), 2 * take
        return rows[found[0]], tree.order[found[1]], found[2]

    parts = []
    for rows, mine in _by_gaps(x, cols):
        for a in range(0, len(rows), AT_ONCE):
            parts += _halves(some, rows[a : a + AT_ONCE])
    row, donor, d = (np.concatenate(c) for c in zip(*parts)) if parts else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
    order = np.argsort(row, kind="stable")
    return row[order], donor[order], d[order]


class _Leaves:
    """The boxes of all leaves, at most MOST_LEAVES for each set of missing columns and part, and trees over those of one set and part."""

    def __init__(self, table: DataFrame, features: int, k: int, width: int):
        rows = table.orderBy("leaf").collect()
        box = lambda c: np.array([r[c] for r in rows], np.float64).reshape(len(rows), features)
        self.names, self.k, self.width = [r["leaf"] for r in rows], k, width
        self.n, self.low, self.high = np.array([r["n"] for r in rows], np.int64), box("low"), box("high")
        part, groups = np.array([r["part"] for r in rows], np.int64), {}
        for i, gone in enumerate(np.isnan(self.low)):
            groups.setdefault((int(part[i]), tuple(np.flatnonzero(~gone))), []).append(i)
        self.trees = {}  # part: (columns, leaves in the tree's order, tree) of all leaves, and of those with k donors
        for (p, cols), at in groups.items():
            if cols:
                of = self.trees.setdefault(p, ([], []))
                full = [i for i in at if self.n[i] >= k]
                for place, some in ((0, at), (1, full)):
                    if some:
                        tree = _Tree(self.low[np.ix_(some, cols)], self.high[np.ix_(some, cols)], 2)
                        of[place].append((np.array(cols), np.array(some)[tree.order], tree))

    def home(self, x: np.ndarray, part: np.ndarray) -> np.ndarray:
        """A near leaf of each row's part, with k donors if there are such; -1 if none shares a column with it."""
        best, far = np.full(len(x), -1), np.full(len(x), np.inf)
        for p in np.unique(part):
            for place in (1, 0):
                open_ = np.flatnonzero((part == p) & (best < 0))
                for cols, names, tree in self.trees.get(int(p), ([], []))[place] if len(open_) else []:
                    for rows, mine in _by_gaps(x[open_], cols):
                        at = x[np.ix_(open_[rows], cols)]
                        row, member = tree.members(np.arange(len(rows)), tree.home(at, mine, self.width))
                        low, high = self.low[names][:, cols], self.high[names][:, cols]
                        d = tree.apart(at[row], low, high, member, mine, self.width)
                        order = np.lexsort((member, d, row))[np.searchsorted(row, np.arange(len(rows)))]
                        to = open_[rows]
                        nearer = d[order] < far[to]
                        best[to[nearer]], far[to[nearer]] = names[member[order]][nearer], d[order][nearer]
        return best

    def reach(self, x: np.ndarray, part: int) -> float:
        """What the k-th distance of a row is at most, by the farthest corners of the boxes."""
        own = np.concatenate([names for _, names, _ in self.trees[part][0]])
        gaps = [np.maximum(np.abs(x[i] - self.low[own, i]), np.abs(x[i] - self.high[own, i])) for i in range(len(x))]
        far = _scaled(gaps, self.width, False)
        order = np.argsort(far)
        enough = np.cumsum(self.n[own][order]) >= self.k
        return float(far[order][enough][0]) if enough.any() else np.inf

    def within(self, x: np.ndarray, part: np.ndarray, limit: np.ndarray, but: int) -> list[np.ndarray]:
        """For each row the leaves of its part at most `limit` away, without the leaf `but`."""
        # a hair of slack, since corners and points round differently
        limit, found = limit * (1 + 1e-9), []
        for p in np.unique(part):
            for cols, names, tree in self.trees[int(p)][0]:
                low, high = self.low[names][:, cols], self.high[names][:, cols]

                def some(rows: np.ndarray):
                    at = x[np.ix_(rows, cols)]
                    pairs = tree.within(at, limit[rows], mine, self.width)
                    if pairs is None:
                        return None
                    row, member = tree.members(*pairs[:2])
                    d = tree.apart(at[row], low, high, member, mine, self.width)
                    near = np.isfinite(d) & (d <= limit[rows][row])
                    return rows[row[near]], names[member[near]]

                own = np.flatnonzero(part == p)
                for rows, mine in _by_gaps(x[own], cols):
                    for a in range(0, len(rows), AT_ONCE):
                        found += _halves(some, own[rows[a : a + AT_ONCE]])
        row, leaf = (np.concatenate(c) for c in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))
        row, leaf = row[leaf != but], leaf[leaf != but]
        order = np.lexsort((leaf, row))
        return np.split(leaf[order], np.searchsorted(row[order], np.arange(1, len(x))))


def fit(
    donors: DataFrame, cols: Sequence[str], id_col: str, k: int = 5, targets: Sequence[str] | None = None,
    donors_per_block: int = DONORS_PER_BLOCK, by: str | None = None,
) -> dict[str, DataFrame]:
    """Stored tables that `fill` searches: points_<target>, leaves_<target> of every target, and means (target, part, mean).

    points: (leaf, part, id, the other columns, value), of donors at one point the first k ids, since more cannot all be neighbours.
    leaves: (leaf, part, n, low, high). by: a column of few whole numbers; receivers meet donors of their own number only.
    """
    cols = list(cols)
    pool = donors.select(id_col, (F.col(by).cast("long") if by else F.lit(0).cast("long")).alias("part"), *[nan_to_null(c).alias(c) for c in cols])
    tables = {}
    for target in targets or cols:
        features = [c for c in cols if c != target]
        points = pool.where(F.col(target).isNotNull()).select("part", F.col(id_col).cast("long").alias("id"), *features, F.col(target).cast("double").alias("value"))
        points = durable(points.withColumn("__k", F.row_number().over(Window.partitionBy("part", *features).orderBy("id", "value"))).where(F.col("__k") <= k).drop("__k"))
        every = max(1, -(-points.count() // SAMPLE))
        sample = points.where(F.pmod(F.xxhash64("part", *features), F.lit(every)) == 0).select(*features).toPandas().to_numpy(dtype=float)
        column, cut = grow(sample, donors_per_block / every, MOST_LEAVES)
        number = F.arrow_udf(lambda x, w=len(features), c=column, t=cut: pa.array(leaf_number(_rows(x, w), c, t)), "long")
        missing = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in features]) if features else F.lit("")
        leaf = F.concat_ws(":", "part", missing, number(F.array(*features)) if features else F.lit(0))
        points = durable(points.withColumn("leaf", leaf))
        low = F.array(*[F.coalesce(F.min(c), F.lit(float("nan"))) for c in features])
        high = F.array(*[F.coalesce(F.max(c), F.lit(float("nan"))) for c in features])
        tables[f"points_{target}"] = points
        tables[f"leaves_{target}"] = durable(points.groupBy("leaf", "part").agg(F.count(F.lit(1)).alias("n"), low.alias("low"), high.alias("high")))
    means = pool.groupBy("part").agg(*[F.avg(t).alias(f"__m{i}") for i, t in enumerate(targets or cols)])
    cells = [F.struct(F.lit(t).alias("target"), F.col(f"__m{i}").alias("mean")) for i, t in enumerate(targets or cols)]
    tables["means"] = durable(means.select("part", F.inline(F.array(*cells))).select("target", "part", "mean"))
    return tables


def _lists(row: np.ndarray, count: int) -> pa.Array:
    """Where the entries of each row begin, for a list column."""
    return pa.array(np.searchsorted(row, np.arange(count + 1)), pa.int32())


def _block_neighbours(leaves: _Leaves, features: int, k: int, width: int, again: bool):
    kind = pa.struct([("d", pa.float64()), ("id", pa.int64()), ("value", pa.float64())])
    matrix = lambda t: np.stack([t[f"x{i}"].to_numpy() for i in range(features)], 1).astype(np.float64)

    def best(receivers: pa.Table, donors: pa.Table) -> pa.Table:
        x, count = matrix(receivers), len(receivers)
        ids, values = donors["id"].to_numpy(), donors["value"].to_numpy()
        ranks = np.empty(len(ids), np.int64)
        ranks[np.lexsort((values, ids))] = np.arange(len(ids))
        row, donor, d = nearest(x, matrix(donors), ranks, k, width) if count and len(ids) else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))
        near = pa.StructArray.from_arrays([pa.array(d), pa.array(ids[donor], pa.int64()), pa.array(values[donor], pa.float64())], fields=list(kind))
        out = {c: receivers[c].combine_chunks() for c in ("part", *[f"x{i}" for i in range(features)], "n")}
        out["near"] = pa.ListArray.from_arrays(_lists(row, count), near)
        if again:
            limit, part = np.full(count, np.inf), receivers["part"].to_numpy()
            held = np.bincount(row, minlength=count)
            full = held >= k
            limit[full] = d[np.cumsum(held)[full] - 1]
            for i in np.flatnonzero(~full):
                limit[i] = leaves.reach(x[i], int(part[i]))
            more = leaves.within(x, part, limit, receivers["leaf"][0].as_py()) if count else []
            out["more"] = pa.array([m.tolist() for m in more], pa.list_(pa.int32()))
        return pa.table(out)

    return best


def _search(asked: DataFrame, points: DataFrame, leaves: _Leaves, features: int, k: int, width: int, per_block: int, again: bool) -> DataFrame:
    """(part, x0..., n, near, more): the k nearest donors in the asked leaf, and with `again` the other leaves to ask. asked: (part, x0..., n, leaf).

    points: (leaf, id, x0..., value). Receivers of a crowded leaf are spread over several tasks, each with the leaf's donors.
    """
    x = [f"x{i}" for i in range(features)]
    blocks = asked.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (4 * per_block)).cast("int").alias("rs"))
    blocks = F.broadcast(blocks)  # one row per leaf
    left = asked.join(blocks, "leaf").select("part", *x, "n", "leaf", F.pmod(F.xxhash64("part", *x), F.col("rs")).cast("int").alias("rb"))
    right = points.join(blocks, "leaf").select("id", *x, "value", "leaf", F.explode(F.sequence(F.lit(0), F.col("rs") - 1)).alias("rb"))
    found = left.groupBy("leaf", "rb").cogroup(right.groupBy("leaf", "rb"))
    kind = ", ".join(["part long", *[f"{c} double" for c in x], "n long", "near array<struct<d: double, id: long, value: double>>", *(["more array<int>"] if again else [])])
    return found.applyInArrow(_block_neighbours(leaves, features, k, width, again), kind)


def _estimate(near: str) -> Column:
    """The mean of the neighbours weighted by 1/d, or the plain mean of those at distance 0."""
    same = F.filter(near, lambda e: e["d"] == 0)
    total = lambda values, term: F.aggregate(values, F.lit(0.0), lambda s, e: s + term(e))
    weighted = total(F.col(near), lambda e: e["value"] / e["d"]) / total(F.col(near), lambda e: 1.0 / e["d"])
    return F.when(F.size(same) > 0, total(same, lambda e: e["value"]) / F.size(same)).otherwise(weighted)


def neighbour_means(
    receivers: DataFrame, tables: Mapping[str, DataFrame], features: Sequence[str], target: str, k: int, width: int, donors_per_block: int = DONORS_PER_BLOCK
) -> DataFrame:
    """(part, features..., n, estimate): per distinct receiver point the mean of its k nearest donors, weighted by 1/d.

    receivers: (part, features). Neighbours are the first k by (distance, id), missing ids last. Donors at distance 0, if any, are the
    only ones that count. Points that share no column with any donor are absent from the result.
    """
    x = [f"x{i}" for i in range(len(features))]
    leaves = _Leaves(tables[f"leaves_{target}"], len(features), k, width)
    names = receivers.sparkSession.createDataFrame([(name, i) for i, name in enumerate(leaves.names)], "leaf string, number int")
    last = F.lit((1 << 63) - 1)
    points = tables[f"points_{target}"].join(F.broadcast(names), "leaf")  # one row per leaf
    points = points.select(F.col("number").alias("leaf"), F.coalesce("id", last).alias("id"), *[F.col(c).alias(n) for c, n in zip(features, x)], "value")
    home = F.arrow_udf(lambda at, part: pa.array(leaves.home(_rows(at, len(x)), part.to_numpy(zero_copy_only=False)), pa.int32()), "int")
    asked = receivers.select("part", *[F.col(c).alias(n) for c, n in zip(features, x)]).groupBy("part", *x).agg(F.count(F.lit(1)).alias("n"))
    asked = durable(asked.withColumn("leaf", home(F.array(*x), "part")))
    one = durable(_search(asked.where("leaf >= 0"), points, leaves, len(x), k, width, donors_per_block, True))
    open_ = one.where(F.size("more") > 0)
    more = durable(open_.select("part", *x, "n", F.explode("more").alias("leaf")))
    two = open_.drop("more").unionByName(_search(more, points, leaves, len(x), k, width, donors_per_block, False))
    merged = two.groupBy("part", *x).agg(F.first("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k).alias("near"))
    found = one.where(F.size("more") == 0).drop("more").unionByName(merged).where(F.size("near") > 0)
    return found.select("part", *[F.col(n).alias(c) for c, n in zip(features, x)], "n", _estimate("near").alias("estimate"))


def fill(
    df: DataFrame, tables: Mapping[str, DataFrame], cols: Sequence[str], id_col: str, k: int = 5, targets: Sequence[str] | None = None,
    donors_per_block: int = DONORS_PER_BLOCK, by: str | None = None,
) -> DataFrame:
    """Fill every missing cell of `cols` (or of `targets`) from the k nearest donors of fitted tables, measured on all of `cols`.

    All cells are filled from the values as they came in, so the order of columns does not matter.
    A cell without any comparable donor gets the donors' column mean. Where there are many different points to fill, rows without a
    missing target are left out of the joins.
    """
    cols, kept = list(cols), df.columns
    part = F.col(by).cast("long") if by else F.lit(0).cast("long")
    work = df.withColumns({"__part": part, **{f"__raw_{c}": nan_to_null(c) for c in cols}})
    means = {(r["target"], r["part"]): r["mean"] for r in tables["means"].collect()}  # one per column and part
    asking = {t: F.col(f"__raw_{t}").isNull() for t in targets or cols}
    some = work.agg(*[F.max(gone).alias(f"__t{i}") for i, gone in enumerate(asking.values())]).first()
    found = {}
    for i, (target, gone) in enumerate(asking.items()):
        features = [c for c in cols if c != target]
        if some[f"__t{i}"] and features:
            raw = [f"__raw_{c}" for c in features]
            points = work.where(gone).select(F.col("__part").alias("part"), *[F.col(r).alias(c) for r, c in zip(raw, features)])
            told = neighbour_means(points, tables, features, target, k, len(cols), donors_per_block)
            table = durable(told.select(F.col("part").alias("__part"), *[F.col(c).alias(r) for r, c in zip(raw, features)], "n", "estimate"))
            found[target] = table, raw, row_bound(table)
    wide = any(size > BROADCAST_ROWS for _, _, size in found.values())
    holes = F.greatest(*[gone.cast("int") for gone in asking.values()], F.lit(0)) == 1
    rows = work.where(holes) if wide else work
    for i, target in enumerate(asking):
        if some[f"__t{i}"]:
            of_part = [F.when(F.col("__part") == p, F.lit(m)) for (t, p), m in means.items() if t == target]
            if target in found:
                table, raw, size = found[target]
                rows = lookup_join(rows, table, ["__part", *raw], "n", ["estimate"], [id_col], size)
                of_part = [F.col("estimate"), *of_part]
            rows = rows.withColumn(target, F.coalesce(f"__raw_{target}", *of_part)).drop("estimate")
    if wide:
        whole = [F.col(f"__raw_{t}").alias(t) if some[f"__t{i}"] else F.col(t) for i, t in enumerate(asking)]
        others = [c for c in kept if c not in asking]
        rows = rows.select(*kept).unionByName(work.where(~holes).select(*others, *whole))
    return rows.select(*kept)


def knn_fill(
    df: DataFrame, donors: DataFrame, cols: Sequence[str], id_col: str, k: int = 5, targets: Sequence[str] | None = None,
    donors_per_block: int = DONORS_PER_BLOCK, by: str | None = None,
) -> DataFrame:
    """fit and fill in one go."""
    return fill(df, fit(donors, cols, id_col, k, targets, donors_per_block, by), cols, id_col, k, targets, donors_per_block, by)
