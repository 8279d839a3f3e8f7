"""Token counts of whole texts as the sentencepiece library gives them, huge texts in overlapping chunks.

A huge text is cut into chunks of CHUNK characters that overlap the next one; each chunk is a row of its own, so one
text can be counted by many tasks. Both chunks of a seam are encoded with offsets. They are spliced at the first place
of the overlap where both have a token boundary and which is proven stable (`sp_model.Boundaries.hard`: no piece can
reach over it). Where no such place exists, or a chunk's tokens don't add up to its bytes, the text is cut again with a wider overlap, in the end with none at all.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.llm.common import Steps, kernel
from driftloom.llm.sp_model import BYTE, MARK, Boundaries, parse

# Counted parts that a task remembers; beyond that it forgets them all and goes on.
MEMORY = 1_000_000


@dataclass(frozen=True)
class Chunking:
    """Characters of a chunk, of its first overlap, and the factor by which overlaps are widened."""

    chunk: int = 32_768
    overlap: int = 512
    wider: int = 8


class Counter:
    def __init__(self, data: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        self.model = parse(data)
        self.cuts = Boundaries(self.model)
        self.known: dict[str, int] = {}
        size = [1 if kind == BYTE else len(t.replace(MARK, " ").encode()) for t, _, kind in self.model.pieces]
        self.size = np.array(size)

    def whole(self, texts: list[str]) -> list[int]:
        """Counts of whole texts. Words that begin at stable places count the same everywhere, so each is encoded once."""
        if not (self.cuts.usable and self.model.dummy_prefix):
            return [len(i) for i in self.library.encode(texts, num_threads=1)]
        # the library itself puts the first space in front
        cut = [self.cuts.segments(" " + t) if t else [] for t in texts]
        if len(self.known) > MEMORY:
            self.known.clear()
        new = list(set().union(*cut).difference(self.known))
        spaced = [p for p in new if p[0] == " "]
        others = [p for p in new if p[0] != " "]
        for at in range(0, len(spaced), 20_000):
            group = spaced[at : at + 20_000]
            found = self.library.encode([p[1:] for p in group], num_threads=1)
            self.known.update(zip(group, map(len, found), strict=True))
        for at in range(0, len(others), 20_000):
            # these follow a line break or begin with one: one break in front, whose two tokens are then taken off
            group = others[at : at + 20_000]
            found = self.library.encode(["\n" + p for p in group], num_threads=1)
            self.known.update(zip(group, (len(i) - self._break for i in found), strict=True))
        if " " in self.known:  # the library gives nothing for an empty text
            self.known[" "] = 1
        look = self.known.__getitem__
        return [sum(map(look, c)) for c in cut]

    @property
    def _break(self) -> int:
        return len(self.library.encode("\n"))

    def part(self, text: str, first: bool, last: bool, seams: tuple[int, int], overlap: int) -> tuple[int, bool]:
        """Tokens of one chunk between its seams, and whether both seams could be spliced.

        seams: where the overlaps at the start and near the end begin, in characters of the chunk.
        """
        if not (self.cuts.usable and self.model.dummy_prefix) and not (first and last):
            return 0, False
        text = text.replace(MARK, " ")  # the library takes both for the same; offsets are those of the text that is encoded
        ids = np.array(self.library.encode(text, num_threads=1), np.int64)
        # byte offsets of token boundaries; the space that the library puts in front is not in the text
        bounds = np.concatenate([[0], np.cumsum(self.size[ids])]) - 1
        bounds[0] = 0
        if bounds[-1] != len(text.encode()) and not (first and last):
            return 0, False
        low, high = 0, len(ids)
        if not first:
            at = self._stable(text, seams[0], overlap)
            low = self._index(bounds, text, at)
        if not last:
            at = self._stable(text, seams[1], overlap)
            high = self._index(bounds, text, at)
        return (0, False) if low < 0 or high < 0 else (high - low, True)

    def _stable(self, text: str, start: int, overlap: int) -> int:
        for at in range(start + 1, min(start + overlap, len(text))):  # the next chunk cannot see what is before its start
            if self.cuts.hard(text[at - 1], text[at]):
                return at
        return -1

    @staticmethod
    def _index(bounds: np.ndarray, text: str, at: int) -> int:
        if at < 0:
            return -1
        byte = len(text[:at].encode())
        place = int(np.searchsorted(bounds, byte))
        return place if place < len(bounds) and bounds[place] == byte else -1


def _whole(text: Column, data: bytes) -> Column:
    made: list[Counter] = []

    def run(column: pa.Array) -> pa.Array:
        if not made:
            made.append(Counter(data))
        texts, counts = column.fill_null("").to_pylist(), []
        for at in range(0, len(texts), 512):
            counts += made[0].whole(texts[at : at + 512])
        return pa.array(counts, pa.int64())

    return kernel(run, "long")(text)


def _part(chunk: Column, number: Column, chunks: Column, data: bytes, size: int, overlap: int) -> Column:
    made: list[Counter] = []

    def run(texts: pa.Array, numbers: pa.Array, totals: pa.Array) -> pa.Array:
        if not made:
            made.append(Counter(data))
        rows = zip(texts.to_pylist(), numbers.to_pylist(), totals.to_pylist(), strict=True)
        found = [made[0].part(t, n == 0, n == total - 1, (0, size), overlap) for t, n, total in rows]
        n, ok = zip(*found, strict=True) if found else ((), ())
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ok, pa.bool_())], ["n", "ok"])

    return kernel(run, "n long, ok boolean")(chunk, number, chunks)


def count_tokens(docs: DataFrame, data: bytes, text: str = "text", how: Chunking | None = None) -> DataFrame:
    """docs without its text, with n_bytes (UTF-8) and n_tokens of the whole text; a null text is empty.

    data: bytes of the model file. No text is cut short; a text without any stable place is encoded in one piece. Repeated
    rows are counted one by one; columns named n_bytes or n_tokens are replaced.
    """
    how = how or Chunking()
    steps = Steps(docs.sparkSession)
    others = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens")]
    rows = docs.select(*others, F.coalesce(text, F.lit("")).alias("__text"))
    huge = F.char_length("__text") > how.chunk
    n_bytes = F.octet_length("__text").cast("long").alias("n_bytes")
    short = rows.where(~huge).select(*others, n_bytes, _whole(F.col("__text"), data).alias("n_tokens"))
    todo = steps.keep(rows.where(huge).withColumn("__row", F.monotonically_increasing_id()))
    done = [short]
    overlap = how.overlap
    while not todo.isEmpty():
        size = max(how.chunk, overlap)
        length = F.char_length("__text")
        total = F.greatest(F.ceil(length / size), F.lit(1)).cast("int")
        cut = todo.select("__row", "__text", total.alias("total"), F.explode(F.sequence(F.lit(0), total - 1)).alias("nth"))
        cut = cut.select(
            "__row", "nth", "total", F.col("__text").substr(F.col("nth") * size + 1, F.lit(size + overlap)).alias("chunk")
        ).repartition("__row", "nth")
        found = cut.select("__row", _part(F.col("chunk"), F.col("nth"), F.col("total"), data, size, overlap).alias("p"))
        found = steps.keep(found.groupBy("__row").agg(F.sum("p.n").alias("n_tokens"), F.min("p.ok").alias("ok")))
        good = todo.join(found.where("ok"), "__row").select(*others, n_bytes, "n_tokens")
        done.append(good)
        overlap *= how.wider
        todo = steps.keep(todo.join(found.where("not ok"), "__row", "left_semi"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out
