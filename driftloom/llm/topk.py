"""Exact top-k inner products over an impact-ordered index, score at a time.

Components are integers. Equal vectors form a class, of which only the k + 1 first rows can be asked for. Classes are dealt to blocks;
a block's postings (vector, component) are put into segments by impact, the size of the component in half powers of two. Queries
process segments in descending impact and add up partial scores. What is left of a score is at most the product of the norms of
the components that were not seen (Cauchy-Schwarz), so scores have bounds; processing stops once the bounds prove that all but a
few vectors are out, and those few are scored exactly. Every query is first asked in one block, whose answer
is the limit that it takes to the others.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftloom.llm.common import Steps, maybe_broadcast, small_batches

LEAST, MOST = -(2**63), 2**63 - 1
# Sums of products below this are exact in double precision.
EXACT = float(2**52)


@dataclass(frozen=True)
class Index:
    """cells: components of a block or a tile of queries, which bounds a task's memory; part: components whose postings are ordered
    together; scores: partial scores held at once; spared: share of a part's vectors that may be scored exactly instead of
    processing further segments."""

    cells: int = 4 << 20
    part: int = 1 << 18
    scores: int = 1 << 20
    spared: float = 1 / 64


def integers(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component as a double; null for vectors that are null or hold null or non-finite components."""
    v = vector.cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = lambda x: F.when(F.abs(x) < EXACT, F.floor(F.when(F.abs(x) < EXACT, x)).cast("double")).otherwise(x)
    scaled = F.transform(v, lambda x: whole(x * F.lit(float(scale))))
    fits = F.forall(scaled, lambda x: F.abs(x) < float("inf"))
    return F.when(F.coalesce(finite, F.lit(False)) & F.coalesce(fits, F.lit(False)), scaled)


def _best(who: np.ndarray, score: np.ndarray, first: np.ndarray, row: np.ndarray, most: int) -> np.ndarray:
    """Places of the `most` best of each query: largest score, then smallest id, then row."""
    order = np.lexsort((row, first, ~score, who))  # ~: largest first, also at the end of a long
    sorted_who = who[order]
    begin = np.concatenate([[0], np.flatnonzero(np.diff(sorted_who)) + 1]) if len(order) else np.zeros(0, np.int64)
    rank = np.arange(len(order)) - np.repeat(begin, np.diff(np.append(begin, len(order))))
    return order[rank < most]


class Part:
    """Some vectors and their segments, most important first."""

    def __init__(self, x: np.ndarray):
        self.x = x
        size, power = np.frexp(np.abs(x))
        impact = np.where(x != 0, 2 * power + (size >= np.sqrt(0.5)), -(10**6))
        self.norms = (x * x).sum(1)
        self.segments = []
        for level in np.unique(impact)[::-1]:
            if level > -(10**6):
                here = impact == level
                values = np.where(here, x, 0.0)
                self.segments.append((values.T.copy(), here.T.astype(np.float64), (values * values).sum(1)))

    def ask(self, q: np.ndarray, limit: np.ndarray, most: int, spared: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) of all pairs that may be among the `most` best or reach the limit."""
        n = len(self.x)
        partial, seen = np.zeros((len(q), n)), np.zeros((len(q), n))
        of_query, unseen = (q * q).sum(1, keepdims=True), self.norms.copy()
        for k in range(len(self.segments) + 1):
            left = np.sqrt(np.maximum(of_query - seen, 0) * unseen) * (1 + 1e-12) + 1e-6 if k < len(self.segments) else np.zeros(1)
            best = limit
            if n >= most:
                low = partial - left
                best = np.maximum(limit, np.partition(low, n - most, axis=1)[:, n - most])
            possible = partial + left >= best[:, None]
            if k == len(self.segments) or np.count_nonzero(possible) <= len(q) * max(4 * most, spared * n):
                return np.nonzero(possible)
            values, here, squares = self.segments[k]
            partial += q @ values
            seen += (q * q) @ here
            unseen = np.maximum(unseen - squares, 0)
        raise AssertionError


def _exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, in whole numbers of any size, held within a long."""
    sums = (sum(int(a) * int(b) for a, b in zip(u, v, strict=True)) for u, v in zip(x.tolist(), y.tolist(), strict=True))
    return np.array([min(max(s, LEAST), MOST) for s in sums], np.int64)


def _search(x, first, row, q, limit, most: int, how: Index) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, class, score) of at most `most` classes for each query, among them all that reach its limit."""
    size = x.shape[1]
    usual = np.sqrt(EXACT / max(size, 1)) / 2
    plain_x, plain_q = np.abs(x).max(1, initial=0) < usual, np.abs(q).max(1, initial=0) < usual
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    limit = limit.copy()

    def add(who, what, score):
        kept = score >= limit[who]
        who, what, score = who[kept], what[kept], score[kept]
        keep = _best(who, score, first[what], row[what], most)
        who, what, score = who[keep], what[keep], score[keep]
        found.append((who, what, score))
        several, count = np.unique(who, return_counts=True)
        full = several[count == most]  # sorted by query, best first: the last of a full set is a limit
        if len(full):
            worst = np.searchsorted(who, full, "right") - 1
            limit[full] = np.maximum(limit[full], score[worst])

    wide = max(1, how.part // max(size, 1))
    plain, asked = np.flatnonzero(plain_x), np.flatnonzero(plain_q)
    for a in range(0, len(plain), wide):
        ids = plain[a : a + wide]
        part = Part(x[ids])
        step = max(1, how.scores // len(ids))
        for b in range(0, len(asked), step):
            qs = asked[b : b + step]
            who, what = part.ask(q[qs], limit[qs].astype(np.float64), most, how.spared)
            chunk = max(1, how.scores // max(size, 1))
            score = [
                np.einsum("ij,ij->i", q[qs[who[i : i + chunk]]], part.x[what[i : i + chunk]]) for i in range(0, len(who), chunk)
            ]
            score = np.rint(np.concatenate(score)).astype(np.int64) if score else np.zeros(0, np.int64)
            add(qs[who], ids[what], score)
    # components so large that sums of products are not exact in double precision
    odd = [(np.flatnonzero(~plain_x), asked), (np.arange(len(x)), np.flatnonzero(~plain_q))]
    for rows, queries in odd:
        for one in queries if len(rows) else ():
            add(np.full(len(rows), one), rows, _exact(x[rows], np.broadcast_to(q[one], (len(rows), size))))
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    who, what, score = (np.concatenate(c) for c in zip(*found, strict=True))
    keep = _best(who, score, first[what], row[what], most)
    return who[keep], what[keep], score[keep]


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    flat = column.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), size)


SHAPE = "q long, nil boolean, id long, row long, score long"


def _task(most: int, how: Index):
    def search(key: tuple, classes: pa.Table, asked: pa.Table) -> pa.Table:
        size = key[0].as_py()
        names = ["q", "nil", "id", "row", "score"]
        if not classes.num_rows or not asked.num_rows:
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64())], names)
        members = classes.column("members").to_pylist()
        x, q = _matrix(classes.column("v"), size), _matrix(asked.column("v"), size)
        first = np.array([MOST if m[0]["nil"] else m[0]["id"] for m in members], np.int64)
        row = np.array([m[0]["row"] for m in members], np.int64)
        limit = asked.column("limit").fill_null(LEAST).to_numpy()
        who, what, score = _search(x, first, row, q, limit, most, how)
        out = [(w, m["nil"], m["id"], m["row"], s) for w, c, s in zip(who.tolist(), what.tolist(), score.tolist(), strict=True) for m in members[c]]
        cols = list(zip(*out, strict=True)) or [()] * 5
        # of each query the best rows: classes that tie share them by id
        w = np.array(cols[0], np.int64)
        ids = np.array([MOST if nil else i for nil, i in zip(cols[1], cols[2], strict=True)], np.int64)
        keep = _best(w, np.array(cols[4], np.int64), ids, np.array(cols[3], np.int64), most)
        number = asked.column("q").to_numpy()
        arrays = [pa.array(number[w[keep]]), *[pa.array(cols[i], t).take(pa.array(keep)) for i, t in ((1, pa.bool_()), (2, pa.int64()), (3, pa.int64()), (4, pa.int64()))]]
        return pa.table(arrays, names)

    return search


def top_k(vectors: DataFrame, asks: Column, k: int = 5, key: str = "vec_id", embedding: str = "embedding", how: Index | None = None) -> DataFrame:
    """(query_id, rank, key, score): the k rows with the largest integer inner products for each row that `asks` is true for.

    Components are floor(256 * x). A row is no answer to itself, but rows that repeat its key or vector are. Ties go to the smaller
    key, null keys last, then in any fixed order. Vectors that are null or hold null or non-finite components (also after scaling) take no
    part; vectors meet those of their own length only; two empty ones have score 0. Scores beyond a long are held at
    its ends. Fewer than k other rows: all of them. Keys are whole numbers. Other columns take no part.
    """
    how = how or Index()
    small_batches()
    spark = vectors.sparkSession
    steps = Steps(spark)
    rows = vectors.select(F.col(key).cast("long").alias("id"), integers(F.col(embedding)).alias("v"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = steps.keep(rows.where("v is not null").withColumn("row", F.monotonically_increasing_id()))
    most = k + 1
    nth = F.row_number().over(Window.partitionBy("v").orderBy(F.col("id").asc_nulls_last(), "row"))
    few = rows.select("id", "v", "row", nth.alias("nth")).where(F.col("nth") <= most)
    member = F.struct("nth", F.col("id").isNull().alias("nil"), F.coalesce("id", F.lit(0)).alias("id"), "row")
    classes = steps.keep(few.groupBy("v").agg(F.sort_array(F.collect_list(member)).alias("members")))
    asked = steps.keep(rows.where("asks").groupBy("v").agg(F.count(F.lit(1)).alias("n")).select(F.monotonically_increasing_id().alias("q"), "v"))

    cells = lambda df: df.agg(F.coalesce(F.sum(F.size("v") + 1), F.lit(0)).alias("n")).first()["n"]
    of_classes = cells(classes)
    # blocks by memory; no fewer than there are cores, unless they would be tiny
    count = max(1, -(-of_classes // how.cells), min(2 * spark.sparkContext.defaultParallelism, of_classes // how.part))
    tiles = max(1, -(-cells(asked) // how.cells))
    home = F.pmod(F.xxhash64("v"), F.lit(count))
    tile = F.pmod(F.xxhash64("q"), F.lit(tiles))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = classes.select(F.size("v").alias("size"), home.alias("block"), every(tiles).alias("tile"), "v", "members")

    def answers(right: DataFrame) -> DataFrame:
        keys = ["size", "block", "tile"]
        return steps.keep(left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_task(most, how), SHAPE))

    right = asked.select(F.size("v").alias("size"), home.alias("block"), tile.alias("tile"), "q", "v", F.lit(None).cast("long").alias("limit"))
    own = answers(right)
    reached = own.groupBy("q").agg(F.when(F.count(F.lit(1)) >= most, F.min("score")).alias("limit"))
    found = own
    if count > 1:
        spread = asked.join(reached, "q", "left").select(F.size("v").alias("size"), home.alias("home"), every(count).alias("block"), tile.alias("tile"), "q", "v", "limit")
        found = own.unionByName(answers(spread.where("block <> home").drop("home")))
    best = lambda by: Window.partitionBy(*by).orderBy(F.desc("score"), "nil", "id", "row")
    found = found.withColumn("nth", F.row_number().over(best(["q"]))).where(F.col("nth") <= most)
    answer = F.struct("nth", "nil", "id", "row", "score")
    lists = found.groupBy("q").agg(F.sort_array(F.collect_list(answer)).alias("found"))
    by_vector = maybe_broadcast(steps.keep(asked.join(lists, "q").select("v", "found")), 20_000)
    each = rows.where("asks").join(by_vector, "v").select("id", F.slice(F.filter("found", lambda a: a["row"] != F.col("row")), 1, k).alias("found"))
    each = each.select("id", F.posexplode("found").alias("at", "a"))
    return each.select(
        F.col("id").alias("query_id"),
        (F.col("at") + 1).alias("rank"),
        F.when(~F.col("a.nil"), F.col("a.id")).alias(key),
        F.col("a.score").alias("score"),
    )
