"""Spelling variants: words one edit apart, found over a reduced alphabet and verified on the words themselves.

Letters are hashed to a few symbols. Two words within one edit have reduced words within one edit, so every reduced word
generates its one-edit neighbourhood (as hashes), the neighbourhood is joined with the reduced vocabulary, and the words
behind both sides are compared. Each pair of reduced words is generated from one side only: an insertion is the other word's
deletion, a replacement by a smaller symbol is the other word's replacement by a larger one. Words with the same reduced word
are compared among themselves.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.llm import tallies
from driftloom.llm.common import BATCH_BYTES, MIX_A, POWER, Steps, kernel, mixed, pieces, powers, small_batches, utf8

# Texts are read as Latin-1: one byte a letter, other characters become a space.
LETTERS = tallies.letters(lambda b: b >= 0xC0 or (b < 0x80 and chr(b).isalpha()))
ALPHABET = [chr(b) for b in range(256) if LETTERS[b] == b and b != 32]
# Alphabets to choose from; the last keeps all letters apart.
SHORT = 64  # code points up to which words are compared by their edit distance
SYMBOLS = (4, 6, 8, 12, 16, 24, 32, 48, len(ALPHABET))


@dataclass(frozen=True)
class Variants:
    """least: code points of a word; often: its occurrences; slip: one in so many words of a text loses a letter (0: none);
    factor: a form occurs at least so many times as often; crowd: mean number of words, over all words, that share a word's reduced
    form, which sets the size of the alphabet (never the result)."""

    least: int = 7
    often: int = 2
    slip: int = 31
    factor: int = 10
    crowd: float = 4.0


def tally(docs: DataFrame, how: Variants, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): occurrences of the words of all texts, after slips, that are long and frequent enough."""
    small_batches()

    def flush(held: Counter) -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        out = pa.RecordBatch.from_arrays([words, pa.array(list(held.values()), pa.int64())], ["word", "n"])
        held.clear()
        return out

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            data, at = utf8(batch.column(1))
            for i, name in enumerate(batch.column(0).to_pylist()):
                own: Counter = Counter()
                letters = data[at[i] : at[i + 1]].tobytes().decode("utf-8").encode("latin-1", "replace")
                for words in tallies.runs(letters, LETTERS):
                    own.update([w for w in words if len(w) >= how.least])
                start = zlib.crc32(f"{'' if name is None else name}:".encode())
                for word, n in own.items():
                    if how.slip:
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if not h % how.slip:
                            drop = h % len(word)
                            word = word[:drop] + word[drop + 1 :]
                            if len(word) < how.least:
                                continue
                    held[word] += n
                if len(held) > tallies.ENTRIES:
                    yield flush(held)
        yield flush(held)

    counted = docs.select(F.col(key).cast("string"), text).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= how.often)


def _symbol(letters: np.ndarray, symbols: int) -> np.ndarray:
    if symbols >= len(ALPHABET):
        return letters.astype(np.int64)
    return (mixed(letters.astype(np.uint64) * POWER) % np.uint64(symbols)).astype(np.int64)


def reduced(word: Column, symbols: int) -> Column:
    """The word over the small alphabet, as a readable string."""
    codes = _symbol(np.array([ord(c) for c in ALPHABET]), symbols)
    if symbols >= len(ALPHABET):
        return word
    return F.translate(word, "".join(ALPHABET), "".join(chr(48 + c) for c in codes.tolist()))


class _Words:
    """Letters of some words, side by side, as symbols with hashes of everything before each."""

    def __init__(self, data: np.ndarray, at: np.ndarray, symbols: int):
        """data, at: UTF-8 bytes of the words and the places where they begin and end."""
        letters = np.frombuffer(data[at[0] : at[-1]].tobytes().decode("utf-8").encode("latin-1"), np.uint8)
        # a letter of two bytes begins with one that is 0xC0 or more
        first = np.concatenate([[0], np.cumsum((data[at[0] : at[-1]] & 0xC0) != 0x80)])
        self.begin = first[at - at[0]]
        self.size = np.diff(self.begin)
        self.word = np.repeat(np.arange(len(self.size)), self.size)
        self.nth = np.arange(len(letters)) - self.begin[self.word]
        self.symbols = symbols
        self.symbol = _symbol(letters, symbols)
        top = symbols if symbols < len(ALPHABET) else 256
        self.value = mixed(np.arange(1, top + 1).astype(np.uint64) * MIX_A)
        up, _ = powers(int(self.size.max(initial=0)) + 1)
        self.weight = up[self.nth]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.value[self.symbol] * self.weight)])
        self.before = sums[:-1] - sums[self.begin[self.word]]
        self.whole = sums[self.begin[1:]] - sums[self.begin[:-1]]

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash): each word that one deletion gives, once."""
        last = np.ones(len(self.symbol), bool)
        last[:-1] = (self.symbol[1:] != self.symbol[:-1]) | (self.word[1:] != self.word[:-1])
        own = self.value[self.symbol] * self.weight
        inverse = np.uint64(pow(int(POWER), -1, 1 << 64))
        rest = (self.whole[self.word] - self.before - own) * inverse
        return self.word[last], mixed((self.before + rest)[last])

    def neighbours(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word, hash): deletions, then the replacements by each larger symbol; one array after the other, so that a very long
        word's neighbourhood is never held whole."""
        yield self.deletions()
        for other in range(1, self.symbols) if self.symbols < len(ALPHABET) else map(ord, ALPHABET):
            at = np.flatnonzero(self.symbol < other)
            if len(at):
                change = (self.value[other] - self.value[self.symbol[at]]) * self.weight[at]
                yield self.word[at], mixed(self.whole[self.word[at]] + change)


def _hash(word: Column, symbols: int) -> Column:
    def run(column: pa.Array) -> pa.Array:
        data, at = utf8(column)
        parts = [mixed(_Words(data, at[a : b + 1], symbols).whole) for a, b in pieces(at, BATCH_BYTES)]
        return pa.array((np.concatenate(parts) if parts else np.zeros(0, np.uint64)).view(np.int64))

    return kernel(run, "long")(word)


def _neighbourhoods(groups: DataFrame, symbols: int) -> DataFrame:
    """(near, own): hashes of the reduced words around each reduced word. groups: (h, word), one word for each of them."""

    def generate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            data, at = utf8(batch.column(1))
            for a, b in pieces(at, BATCH_BYTES):
                words = _Words(data, at[a : b + 1], symbols)
                for who, near in words.neighbours():
                    yield pa.RecordBatch.from_arrays([pa.array(near.view(np.int64)), pa.array(own[a:b][who])], ["near", "own"])

    return groups.mapInArrow(generate, "near long, own long")


def alphabet(words: DataFrame, how: Variants) -> int:
    """The smallest alphabet over which few enough words share a reduced word. One aggregate over all words."""
    total = words.count()
    tried = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.xxhash64(reduced(F.col("word"), s)).alias("h")) for s in SYMBOLS])).alias("t")
    sizes = words.select(tried).groupBy("t.s", "t.h").count()
    pairs = {r["s"]: r["pairs"] for r in sizes.groupBy("s").agg(F.sum(F.col("count") * F.col("count")).alias("pairs")).collect()}
    return next((s for s in SYMBOLS if pairs.get(s, 0) <= how.crowd * total), SYMBOLS[-1])


def one_edit(a: Column, b: Column) -> Column:
    """Whether two words differ by exactly one inserted, deleted or replaced code point.

    The distance function takes the square of the length; for long words the common beginning is found by halving, and
    the ends behind the edit are compared.
    """
    size_a, size_b = F.char_length(a), F.char_length(b)
    x, y = F.when(size_a <= size_b, a).otherwise(b), F.when(size_a <= size_b, b).otherwise(a)
    start = F.struct(F.lit(0).alias("low"), F.least(size_a, size_b).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"] + 1) / 2).cast("int")
        same = a.substr(F.lit(1), middle) == b.substr(F.lit(1), middle)
        return F.struct(F.when(same, middle).otherwise(s["low"]).alias("low"), F.when(same, s["high"]).otherwise(F.greatest(middle - 1, s["low"])).alias("high"))

    shared = F.aggregate(F.sequence(F.lit(1), F.lit(31)), start, halve)["low"]
    skip = F.when(size_a == size_b, 2).otherwise(1)
    ends = x.substr(shared + skip, size_a + size_b) == y.substr(shared + 2, size_a + size_b)
    return F.when(F.greatest(size_a, size_b) <= SHORT, F.levenshtein(a, b, 1) == 1).otherwise((F.abs(size_a - size_b) <= 1) & (a != b) & ends)


def near_pairs(words: DataFrame, steps: Steps, how: Variants, symbols: int | None = None) -> DataFrame:
    """(u, v) in both orders, structs (word, n): words that differ by exactly one inserted, deleted or replaced code point."""
    symbols = symbols or alphabet(words, how)
    one = words.select(_hash(F.col("word"), symbols).alias("h"), F.struct("word", "n").alias("w"))
    groups = steps.keep(one.groupBy("h").agg(F.collect_list("w").alias("words")))
    around = _neighbourhoods(groups.select("h", F.col("words")[0]["word"].alias("word")), symbols)
    other = groups.select(F.col("h").alias("near"), F.col("words").alias("others"))
    met = around.join(other, "near").join(groups, F.col("own") == F.col("h")).select("words", "others")
    edit = lambda x, y: one_edit(x["word"], y["word"])
    sides = met.select(F.explode("words").alias("u"), "others")
    sides = sides.select("u", F.explode(F.filter("others", lambda x: edit(F.col("u"), x))).alias("v"))
    both = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("pair")
    alike = groups.where(F.size("words") > 1).select(F.explode("words").alias("u"), "words")
    alike = alike.select("u", F.explode(F.filter("words", lambda x: edit(F.col("u"), x))).alias("v"))
    return sides.select(both).select("pair.u", "pair.v").unionByName(alike)


def group(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Variants | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each word of the texts: runs of Latin letters, A-Z in lower case.

    form: the near word of largest n (ties: smallest in code-point order) if it occurs `how.factor` times as often, else null.
    root: where the forms lead to, the word itself if it has none. Null texts have no words; a null key counts as ''; rows that
    repeat count again; an empty table gives no rows. Other columns of docs take no part.
    """
    how = how or Variants()
    if how.factor <= 1:
        raise ValueError("a form must be more frequent than what leads to it")
    steps = Steps(docs.sparkSession)
    words = steps.keep(tally(docs, how, key, text))
    # a pair is found once; counting distinct words keeps that true even where two hashes fall together
    near = near_pairs(words, steps, how).groupBy(F.col("u.word").alias("word")).agg(
        F.count_distinct("v.word").alias("n_near"), F.min(F.struct((-F.col("v.n")).alias("n"), F.col("v.word").alias("word"))).alias("best")
    )
    joined = words.join(near, "word", "left")
    good = -F.col("best.n") >= how.factor * F.col("n")
    told = steps.keep(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(good, F.col("best.word")).alias("form"), F.when(good, -F.col("best.n")).alias("form_n"),
        )
    )
    # every form is `factor` times as frequent as what leads to it, so chains are short; each round doubles the way
    way = steps.keep(told.where("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not way.where("moved").isEmpty():
        onward = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = way.drop("moved").join(onward, "root", "left")
        longer = steps.keep(longer.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        steps.drop(way)
        way = longer
    out = told.join(way.drop("moved"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
