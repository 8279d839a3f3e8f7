"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact weighted-shingle check.

Words are lower-cased runs of letters and digits, shingles are five words (items with fewer words: all of them as one). A
window can only resemble an item if the two share a shingle, so windows are laid where a shared shingle puts the item's
beginning, as long as the item. Their 64-bit SimHashes are looked up in BLOCKS tables of 8 bits: within the radius at least one
block differs in at most radius // BLOCKS bits, and every item is filed under all such values, so none within the radius is
missed. Windows that are found are compared exactly: shared shingles with their multiplicities over all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.llm.common import Steps, lowered, maybe_broadcast
from driftloom.llm.licenses import words

BITS, BLOCKS = 64, 8


@dataclass(frozen=True)
class Matching:
    """width: words of a shingle. similarity: least weighted share. radius: bits that fingerprints may differ in.

    Each occurrence of a shingle is a feature of its own, so a similarity of 0.75 is an angle of at most 0.54 whatever is repeated:
    11 differing bits on average, deviation 3, beyond the radius with a probability of 9e-5 (4e-4 for five shingles against four).
    """

    width: int = 5
    similarity: float = 0.75
    radius: int = 23


def _shingles(tokens: Column, width: Column, value) -> Column:
    """value(slice) of every run of `width` words, in order."""
    last = F.size(tokens) - width + 1
    made = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: value(F.slice(tokens, i, width)))
    return F.when(last >= 1, made).otherwise(F.slice(made, F.lit(1), F.lit(0)))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def occurrences(hashes: Column) -> Column:
    """The hashes, and for the second and later ones of equal hashes a hash of it and its number among them; in any order."""

    def numbered(h: Column) -> Column:
        nth = lambda x, i: i + 1 - F.call_function("array_position", h, x)
        return F.transform(h, lambda x, i: F.when(nth(x, i) > 0, F.xxhash64(x, nth(x, i))).otherwise(x))

    apart = lambda h: F.size(F.array_distinct(h)) == F.size(h)
    return _let(hashes, lambda h: F.when(apart(h), h).otherwise(_let(F.array_sort(h), numbered)))


def simhash(hashes: Column) -> Column:
    """64-bit fingerprint of hashed shingles, each occurrence a feature of its own."""
    return _let(occurrences(hashes), _votes)


def _votes(hashes: Column) -> Column:
    one = F.lit(1).cast("bigint")

    def bit(b: Column) -> Column:
        votes = F.aggregate(
            hashes,
            F.lit(0),
            lambda s, h: s + F.when(F.call_function("shiftright", h, b).bitwiseAND(one) == 1, 1).otherwise(-1),
        )
        return F.when(votes > 0, F.call_function("shiftleft", one, b)).otherwise(F.lit(0).cast("bigint"))

    bits = F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), bit)
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda s, x: s.bitwiseOR(x))


def _block(print_: Column, number: Column) -> Column:
    return F.call_function("shiftright", print_, number * (BITS // BLOCKS)).bitwiseAND(F.lit(255).cast("bigint")).cast("int")


def _joined(part: Column) -> Column:
    return F.array_join(part, " ")


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    how: Matching | None = None,
) -> DataFrame:
    """(key, item, similarity, first_word, text_hash): documents that hold an item, with the most similar window.

    One row per document text and item; first_word is the smallest start (words from 0) of the best window. Null texts are
    empty, texts and items without words match nothing, repeated rows give one row, other columns are ignored. Items of
    any length count whole. text_hash tells texts that share a key apart.
    """
    how = how or Matching()
    spark = docs.sparkSession
    steps = Steps(spark)
    items = benchmark.select(F.col(item).alias("item"), words(lowered(F.col(item_text))).alias("words")).where(F.size("words") > 0)
    items = items.distinct().withColumn("length", F.size("words")).withColumn("width", F.least(F.lit(how.width), F.col("length")))
    items = steps.keep(items.withColumn("nth", F.monotonically_increasing_id()))
    grams = items.select("length", "width", "nth", F.posexplode(_shingles(F.col("words"), F.col("width"), F.xxhash64)).alias("at", "hash"))
    lengths = grams.select("hash", "width", "at", "length").distinct()
    lengths = maybe_broadcast(lengths, 2_000_000)  # three numbers a row
    widths = sorted(r[0] for r in items.select("width").distinct().collect())  # at most how.width numbers

    rows = docs.select(F.col(key).alias("id"), lowered(F.col(text)).alias("text"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"))
    parts = []
    for width in widths:
        tokens = rows.select("id", "text_hash", words(F.col("text")).alias("words"))
        places = tokens.select("id", "text_hash", F.size("words").alias("n"), F.posexplode(_shingles(F.col("words"), F.lit(width), F.xxhash64)).alias("place", "hash"))
        parts.append(places.join(lengths.where(F.col("width") == width), "hash"))
    if not parts:
        return spark.createDataFrame([], f"{key} long, {item} long, similarity double, first_word long, text_hash long")
    met = parts[0]
    for more in parts[1:]:
        met = met.unionByName(more)
    start = F.least(F.greatest(F.col("place") - F.col("at"), F.lit(0)), F.greatest(F.col("n") - F.col("length"), F.lit(0)))
    spots = met.select("id", "text_hash", "length", "width", start.alias("start")).distinct()
    by_text = spots.groupBy("id", "text_hash").agg(F.collect_list(F.struct("length", "width", "start")).alias("spots"))
    by_text = steps.keep(by_text.withColumn("row", F.monotonically_increasing_id()))

    wanted = maybe_broadcast(by_text.select(F.col("id").alias("id_"), F.col("text_hash").alias("hash_"), "row", "spots"))
    again = rows.join(wanted, F.expr("text_hash = hash_ and id <=> id_")).select("row", "spots", words(F.col("text")).alias("words"))
    again = again.select("row", "words", F.explode("spots").alias("spot")).select("row", "spot.*", "words")
    windows = again.select("row", "length", "width", "start", F.slice("words", F.col("start") + 1, F.col("length")).alias("words")).dropDuplicates(["row", "length", "start"])
    hashed = _shingles(F.col("words"), F.col("width"), F.xxhash64)
    windows = steps.keep(windows.withColumn("print", simhash(hashed)))

    numbers = F.sequence(F.lit(0), F.lit(BLOCKS - 1))
    flips = how.radius // BLOCKS
    prints = items.select("nth", "length", "words", "width", simhash(hashed).alias("print"))
    filed = prints.select("nth", "length", F.col("print").alias("item_print"), F.explode(numbers).alias("block"))
    value = _block(F.col("item_print"), F.col("block"))
    near = F.filter(F.sequence(F.lit(0), F.lit(255)), lambda v: F.bit_count(v.bitwiseXOR(value)) <= flips)
    filed = maybe_broadcast(filed.select("nth", "length", "item_print", "block", F.explode(near).alias("value")), 2_000_000)
    asked = windows.select("row", "length", "start", "print", F.explode(numbers).alias("block"))
    asked = asked.withColumn("value", _block(F.col("print"), F.col("block")))
    close = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= how.radius
    candidates = asked.join(filed, ["length", "block", "value"]).where(close).select("row", "length", "start", "nth").distinct()

    strings = _shingles(F.col("words"), F.col("width"), _joined)
    mine = windows.join(candidates, ["row", "length", "start"]).select("row", "start", "nth", strings.alias("all"))
    mine = mine.select("row", "start", "nth", F.size("all").alias("n_window"), F.explode("all").alias("shingle"))
    mine = mine.groupBy("row", "start", "nth", "n_window", "shingle").agg(F.count(F.lit(1)).alias("c"))
    theirs = items.select("nth", strings.alias("all")).select("nth", F.size("all").alias("n_item"), F.explode("all").alias("shingle"))
    theirs = theirs.groupBy("nth", "n_item", "shingle").agg(F.count(F.lit(1)).alias("c_item"))
    shared = mine.join(theirs, ["nth", "shingle"]).groupBy("row", "start", "nth", "n_window", "n_item")
    shared = shared.agg(F.sum(F.least("c", "c_item")).alias("shared"))
    share = F.col("shared") / (F.col("n_window") + F.col("n_item") - F.col("shared"))
    sure = shared.select("row", "nth", "start", share.alias("similarity")).where(F.col("similarity") >= how.similarity)
    best = sure.groupBy("row", "nth").agg(F.max(F.struct("similarity", (-F.col("start")).alias("back"))).alias("best"))
    named = best.join(items.select("nth", "item"), "nth").join(by_text.select("row", "id", "text_hash"), "row")
    named = named.groupBy("id", "text_hash", "item").agg(F.max("best").alias("best"))
    return named.select(
        F.col("id").alias(key),
        F.col("item").alias(item),
        F.col("best.similarity").alias("similarity"),
        (-F.col("best.back")).cast("long").alias("first_word"),
        "text_hash",
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", how: Matching | None = None) -> DataFrame:
    """docs without the documents that hold an item; all columns stay."""
    found = leaks(docs, benchmark, key, text, how=how).select(F.col(key).alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    found = maybe_broadcast(Steps(docs.sparkSession).keep(found))
    same = docs[key].eqNullSafe(found["__id"]) & (F.xxhash64(F.coalesce(docs[text], F.lit(""))) == found["__hash"])
    return docs.join(found, same, "left_anti")
