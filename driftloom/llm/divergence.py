"""How far the sources of a language diverge in their words, with exact integers, over run-length columns.

The vocabulary of a language is reordered so that terms with equal counts stand together, and cut into blocks. Within a
block each source is a column of runs (first place, share); two sources are compared by intersecting their run
boundaries: the divergence of a pair of shares is taken once a run and multiplied by its length. Blocks add up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftloom.functions.numbering import numbered
from driftloom.llm import tallies
from driftloom.llm.common import Steps, maybe_broadcast, small_batches, utf8
from driftloom.session import passing

LETTERS = tallies.letters(lambda b: b >= 0x80 or chr(b).isalpha())
SHARES = 1_000_000_000


@dataclass(frozen=True)
class Audit:
    """documents: least documents of a kept term; terms: reported of a source; leading: sources whose counts order the
    vocabulary; block: terms of a block; tile: sources that one task compares with as many others."""

    documents: int = 10
    terms: int = 10
    leading: int = 8
    block: int = 8192
    tile: int = 64


def tally(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, term, n, docs): occurrences, and rows that hold the term. Nulls are ''."""
    small_batches()
    kind = "lang string, source string, term string, n long, docs long"

    def flush(held: dict) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (a, b), (n, rows) in held.items():
            columns[0] += [a] * len(n)
            columns[1] += [b] * len(n)
            columns[2] += n.keys()
            columns[3] += n.values()
            columns[4] += map(rows.__getitem__, n)
        held.clear()
        kinds = [pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        arrays[2] = arrays[2].cast(pa.string())
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "term", "n", "docs"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0
        for batch in batches:
            data, at = utf8(batch.column(2))
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            for i, name in enumerate(names):
                n, rows = held.setdefault(name, (Counter(), Counter()))
                before, seen = len(n), set()
                for words in tallies.runs(data[at[i] : at[i + 1]].tobytes(), LETTERS):
                    n.update(words)
                    seen.update(words)
                rows.update(seen)
                size += len(n) - before
                if size > tallies.ENTRIES:
                    yield flush(held)
                    size = 0
        yield flush(held)

    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    counted = docs.select(empty(lang), empty(source), text).mapInArrow(count, kind)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column | str, total: Column | str, vocabulary: Column | str) -> Column:
    """1 + floor(SHARES * (n + 2) / (total + 2 * vocabulary)), exact; null without a vocabulary."""
    n, total, vocabulary = (F.col(c) if isinstance(c, str) else c for c in (n, total, vocabulary))
    over = F.lit(SHARES).cast("decimal(10,0)") * (n + 2).cast("decimal(20,0)")
    under = F.nullif((total + 2 * vocabulary).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.when(vocabulary > 0, F.call_function("div", over, under) + 1)


def _runs(cells: DataFrame) -> DataFrame:
    """(lang, block, g, runs): where a run of column g begins, and its share. Places without a cell have the share of 0 occurrences.

    The run from the block's beginning to the first cell is left to the reader.
    """
    w = Window.partitionBy("lang", "block", "g").orderBy("place")
    before, prior, after = F.lag("place").over(w), F.lag("p").over(w), F.lead("place").over(w)
    new = before.isNull() | (before != F.col("place") - 1) | (prior != F.col("p"))
    ends = after.isNull() | (after != F.col("place") + 1)
    run = lambda place, p: F.struct(place.cast("long").alias("at"), p.alias("p"))
    marked = cells.select(
        "lang", "block", "g", F.when(new, run(F.col("place"), F.col("p"))).alias("one"), F.when(ends, run(F.col("place") + 1, F.col("p0"))).alias("two")
    )
    both = marked.select("lang", "block", "g", F.explode(F.array_compact(F.array("one", "two"))).alias("run"))
    return both.groupBy("lang", "block", "g").agg(F.sort_array(F.collect_list("run")).alias("runs"))


def _compare(key: tuple, columns: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums over one block for all pairs of sources of two tiles."""
    lang, _, low, high = (k.as_py() for k in key)
    runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    facts = [groups.column(c).to_numpy() for c in ("g", "p0", "tile", "start", "stop")]
    start, stop = (int(facts[3][0]), int(facts[4][0])) if groups.num_rows else (0, 0)
    zero = dict(zip(facts[0].tolist(), facts[1].tolist(), strict=True))
    for g, run in zip(columns.column("g").to_pylist(), columns.column("runs").combine_chunks() if columns.num_rows else [], strict=True):
        values = run.values.flatten()
        at, p = (v.to_numpy(zero_copy_only=False) for v in values)
        if at[0] > start:
            at, p = np.concatenate([[start], at]), np.concatenate([[zero[g]], p])
        inside = at < stop
        runs[g] = at[inside], p[inside]
    for g, p0 in zero.items():
        runs.setdefault(g, (np.array([start]), np.array([p0])))
    first, second, value = [], [], []
    mine, other = facts[0][facts[2] == low].tolist(), facts[0][facts[2] == high].tolist()
    for a in mine:
        at, p = runs[a]
        for b in other:
            if low == high and b <= a:
                continue
            bt, q = runs[b]
            cut = np.union1d(at, bt)
            u, v = p[np.searchsorted(at, cut, "right") - 1], q[np.searchsorted(bt, cut, "right") - 1]
            first.append(a)
            second.append(b)
            value.append(int(((u - v) * (u - v) // (u + v) * np.diff(np.append(cut, stop))).sum()))
    return pa.table([pa.array([lang] * len(first), pa.string()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(value, pa.int64())], ["lang", "a", "b", "value"])


def audit(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", how: Audit | None = None) -> DataFrame:
    """(lang, source, part, item, value, rank) for every (lang, source) that occurs; null names and texts are ''.

    A language keeps the terms of at least `how.documents` of its rows. Part `pair`: divergence from each other source of the language,
    summed over all kept terms (0 without any). Part `term`: the `how.terms` terms that the source has more of than its language, by
    divergence. Rows that repeat count again; a source without terms has only smoothed shares; a language with one source has no
    pairs; an empty table gives no rows. Columns of docs other than the three named take no part.
    """
    how = how or Audit()
    spark = docs.sparkSession
    steps = Steps(spark)
    docs = docs.select(F.col(lang).cast("string").alias("lang"), F.col(source).cast("string").alias("source"), F.col(text).alias("text"))
    counts = steps.keep(tally(docs))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("of_lang"), F.sum("docs").alias("docs"))
    terms = steps.keep(terms.where(F.col("docs") >= how.documents).drop("docs"))
    cells = steps.keep(counts.drop("docs").join(terms, ["lang", "term"]))
    sizes = terms.groupBy("lang").agg(F.sum("of_lang").alias("lang_total"), F.count(F.lit(1)).alias("vocabulary"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    empty = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    named = docs.select(empty("lang"), empty("source")).distinct()
    facts = named.join(sums, ["lang", "source"], "left").join(sizes, "lang", "left").fillna(0, ["total", "lang_total", "vocabulary"])
    facts = facts.withColumn("p0", share(F.lit(0), "total", "vocabulary"))
    by_size = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("total"), "source"))
    groups = steps.keep(facts.withColumn("g", (by_size - 1).cast("long")).withColumn("tile", F.floor(F.col("g") / how.tile)))
    known = maybe_broadcast(groups.select("lang", "source", "g", "p0", "total", "lang_total", "vocabulary"))
    cells = cells.join(known, ["lang", "source"]).withColumn("p", share("n", "total", "vocabulary"))
    cells = cells.withColumn("q", share("of_lang", "lang_total", "vocabulary")).drop("total", "lang_total", "vocabulary")
    shares = steps.keep(cells)

    leading = [F.max(F.when(F.col("g") == i, F.col("n"))).alias(f"c{i}") for i in range(how.leading)]
    mark = F.sum(F.pmod(F.xxhash64("g", "n"), F.lit(1 << 40))).alias("mark")
    order = ["lang", *[f"c{i}" for i in range(how.leading)], "mark", "term"]
    with passing(spark):
        place = numbered(shares.groupBy("lang", "term").agg(*leading, mark), order, "place")
        place = steps.keep(place.select("lang", "term", "place", F.floor(F.col("place") / how.block).alias("block")))
    blocks = place.groupBy("lang", "block").agg(F.min("place").alias("start"), (F.max("place") + 1).alias("stop"))
    placed = shares.join(place, ["lang", "term"]).select("lang", "block", "g", "place", "p", "p0")
    columns = _runs(placed).withColumn("tile", F.floor(F.col("g") / how.tile))

    tiles = maybe_broadcast(groups.groupBy("lang").agg(F.max("tile").alias("last")))
    meets = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("meets")
    ends = [F.least("tile", "meets").alias("low"), F.greatest("tile", "meets").alias("high")]
    left = columns.join(tiles, "lang").select("lang", "block", "g", "runs", "tile", meets).select("lang", "block", *ends, "g", "runs")
    right = groups.where("vocabulary > 0").select("lang", "g", "p0", "tile").join(tiles, "lang").select("lang", "g", "p0", "tile", meets)
    right = right.join(blocks, "lang").select("lang", "block", *ends, "g", "p0", "tile", "start", "stop")
    keys = ["lang", "block", "low", "high"]
    right = right.withColumnsRenamed({k: f"of_{k}" for k in keys})
    summed = left.groupBy(*keys).cogroup(right.groupBy(*[f"of_{k}" for k in keys])).applyInArrow(_compare, "lang string, a long, b long, value long")
    summed = summed.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    one = groups.select("lang", F.col("g").alias("a"), F.col("source").alias("sa"))
    two = groups.select("lang", F.col("g").alias("b"), F.col("source").alias("sb"))
    without = groups.where("vocabulary = 0").select("lang", F.col("g").alias("a"))
    nothing = without.join(without.withColumnRenamed("a", "b"), "lang").where("a < b").select("lang", "a", "b", F.lit(0).cast("long").alias("value"))
    pairs = steps.keep(summed.unionByName(nothing).join(one, ["lang", "a"]).join(two, ["lang", "b"]).select("lang", "sa", "sb", "value"))
    sides = pairs.select("lang", F.col("sa").alias("source"), F.col("sb").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("sb").alias("source"), F.col("sa").alias("item"), "value")
    )
    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = sides.withColumn("part", F.lit("pair")).withColumn("rank", F.row_number().over(first))
    gap = F.col("p") - F.col("q")
    term = shares.where(gap > 0).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value"))
    term = term.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= how.terms)
    return pair.unionByName(term).select("lang", "source", "part", "item", "value", "rank")
