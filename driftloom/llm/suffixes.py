"""Exact removal of long repeated byte strings, by sorting suffixes with deep-shallow sorting.

Every string of LENGTH bytes has an anchor: its GRAM-byte substring with the smallest hash (the first of equal ones). Equal
strings have equal anchors at equal offsets, so only places around anchors that occur more than once can repeat. Around such
an anchor, the text to its right is a suffix and the text to its left, read backwards, another. Suffixes are sorted by
multikey quicksort to a shallow depth, and groups that agree so far by blind tries. Neighbours in the two orders tell for every
offset which strings are equal: the common prefix on the right and on the left together must reach LENGTH.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.llm.common import SLICE_BYTES, Steps, kernel, maybe_broadcast, pieces, prefix_hashes, small_enough, span_hash, utf8


@dataclass(frozen=True)
class Repeats:
    """length: bytes of a repeated string. gram: bytes of an anchor. shallow: bytes that the quicksort looks at.

    group: suffixes of one sorting task, about. crowded: places around one anchor beyond which each offset of it is
    grouped on its own (`_crowded`), so that a very common passage is never one task's work.
    """

    length: int = 400
    gram: int = 64
    shallow: int = 16
    group: int = 4000
    crowded: int = 5000


def _anchors(data: np.ndarray, bounds: np.ndarray, how: Repeats):
    """(row, core, context, centre, low, high) of each anchor: equal strings begin at centre - d for d in low..high.

    centre is a byte place in the row's text; core is a hash of the anchor, context one of all bytes that its strings cover.
    """
    n, width = len(data), how.length - how.gram + 1
    if n < how.length:
        return [np.zeros(0, np.int64)] * 6
    prefix = prefix_hashes(data)
    at = np.arange(n - how.gram + 1)
    gram = span_hash(prefix, at, at + how.gram)
    # 32 bits of the hash, then the place: the first of equal hashes is the smallest
    ranked = (gram & ~np.uint64(0xFFFFFFFF)) | at.astype(np.uint64)
    padded = np.full(-(-len(ranked) // width) * width + width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(ranked)] = ranked
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, 1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    starts = n - how.length + 1
    best = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts]) & np.uint64(0xFFFFFFFF)
    place = np.arange(starts)
    row = np.searchsorted(bounds, place, "right") - 1
    inside = place + how.length <= bounds[row + 1]
    place, row, best = place[inside], row[inside], best[inside].astype(np.int64)
    if not len(place):
        return [np.zeros(0, np.int64)] * 6
    first = np.flatnonzero(np.concatenate([[True], (best[1:] != best[:-1]) | (row[1:] != row[:-1])]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    centre, low, high = best[first], best[first] - place[last], best[first] - place[first]
    core = gram[centre].view(np.int64)
    context = span_hash(prefix, place[first], place[last] + how.length).view(np.int64)
    return row[first], core, context, centre - bounds[row[first]], low, high


def anchors(text: Column, how: Repeats) -> Column:
    """array of struct(core, context, centre, low, high) of a whole text; empty below `length` bytes."""
    names = ["core", "context", "centre", "low", "high"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16()]

    def run(column: pa.Array) -> pa.Array:
        data, offsets = utf8(column)
        counts, parts = [], []
        for a, b in pieces(offsets, SLICE_BYTES):
            base, end = int(offsets[a]), int(offsets[b])
            if b - a > 1 or end - base <= 2 * SLICE_BYTES:
                found = _anchors(data[base:end], offsets[a : b + 1] - base, how)
                counts.append(np.bincount(found[0].astype(int), minlength=b - a))
                parts.append(found[1:])
                continue
            # a long text in slices; strings that begin in a slice end in what it has in common with the next one
            n = 0
            for at in range(base, end, SLICE_BYTES):
                slice_ = data[at : min(at + SLICE_BYTES + how.length - 1, end)]
                found = _anchors(slice_, np.array([0, len(slice_)]), how)
                n += len(found[0])
                parts.append([found[1], found[2], found[3] + (at - base), found[4], found[5]])
            counts.append(np.array([n]))
        ends = np.concatenate([[0], np.cumsum(np.concatenate(counts))]) if counts else np.zeros(1, int)
        joined = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(5)]
        fields = [pa.array(v.astype(k.to_pandas_dtype()), k) for v, k in zip(joined, kinds, strict=True)]
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays(fields, names))

    return kernel(run, "array<struct<core:long,context:long,centre:int,low:smallint,high:smallint>>")(text)


class _Node:
    __slots__ = ("depth", "children", "leaves")

    def __init__(self, depth, children, leaves):
        self.depth, self.children, self.leaves = depth, children, leaves


def _common(a: bytes, b: bytes) -> int:
    """Bytes that two strings of equal length share from the start."""
    differ = int.from_bytes(a) ^ int.from_bytes(b)
    return len(a) - (differ.bit_length() + 7) // 8


def blind_trie(strings: list[bytes]) -> list[int]:
    """Order of strings of one length by a blind trie: inner nodes know only their depth and branching bytes.

    A string goes down by its branching bytes to some leaf, is compared with that leaf once, and is put in where they part.
    Equal strings stay in the order they came in.
    """
    root = _Node(len(strings[0]), None, [0])
    for i in range(1, len(strings)):
        s, node = strings[i], root
        while node.children is not None:
            child = node.children.get(s[node.depth])
            node = child if child is not None else next(iter(node.children.values()))
        shared = _common(s, strings[node.leaves[0]])
        if shared == len(s):
            node.leaves.append(i)
            continue
        other = strings[node.leaves[0]]
        above, node = None, root
        while node.children is not None and node.depth < shared:
            above, node = node, node.children[s[node.depth]]
        if node.children is not None and node.depth == shared:
            node.children[s[shared]] = _Node(len(s), None, [i])
            continue
        fork = _Node(shared, {other[shared]: node, s[shared]: _Node(len(s), None, [i])}, None)
        if above is None:
            root = fork
        else:
            above.children[s[above.depth]] = fork
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.children is None:
            order += node.leaves
        else:
            stack += [node.children[b] for b in sorted(node.children, reverse=True)]
    return order


def deep_shallow(rows: np.ndarray, shallow: int) -> np.ndarray:
    """Order of the rows of a byte matrix: multikey quicksort on words of 8 bytes, then a blind trie for each equal group."""
    count, width = rows.shape
    levels = min(shallow, width) // 8
    words = np.ascontiguousarray(rows[:, : 8 * levels]).view(">u8").astype(np.uint64) if levels else np.zeros((count, 0), np.uint64)
    out = np.arange(count)
    todo = [(0, count, 0)]
    while todo:
        a, b, level = todo.pop()
        if b - a < 2:
            continue
        ids = out[a:b]
        if level == levels:
            out[a:b] = ids[blind_trie([r.tobytes() for r in rows[ids]])]
            continue
        key = words[ids, level]
        pivot = key[len(key) // 2]
        below, above = key < pivot, key > pivot
        low, high = ids[below], ids[above]
        same = ids[~(below | above)]
        out[a:b] = np.concatenate([low, same, high])
        todo += [(a, a + len(low), level), (a + len(low), b - len(high), level + 1), (b - len(high), b, level)]
    return out


def _neighbours(rows: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order, and the bytes that each row shares with the row before it in that order."""
    order = deep_shallow(rows, shallow)
    sorted_rows = rows[order]
    differ = sorted_rows[1:] != sorted_rows[:-1]
    shared = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return order, np.concatenate([[0], shared])


def repeated_offsets(contexts: list[bytes], low: np.ndarray, high: np.ndarray, count: np.ndarray, how: Repeats) -> np.ndarray:
    """Boolean matrix (context, offset): the string that begins `offset` bytes before the centre stands in two places.

    A context covers its strings exactly: `high` bytes before the centre. count: places where this context stands.
    """
    reach = how.length - how.gram + 1
    right = np.zeros((len(contexts), how.length), np.uint8)
    left = np.zeros((len(contexts), reach + (-reach) % 8), np.uint8)
    for i, (c, h) in enumerate(zip(contexts, high.tolist(), strict=True)):
        flat = np.frombuffer(c, np.uint8)
        tail = flat[h : h + how.length]
        right[i, : len(tail)] = tail
        left[i, :h] = flat[:h][::-1]
    order_r, shared_r = _neighbours(right, how.shallow)
    order_l, shared_l = _neighbours(left, how.shallow)
    out = np.zeros((len(contexts), reach), bool)

    def classes(order, shared, valid, need):
        """Number of the class of each valid context: those that agree in `need` bytes."""
        where = np.flatnonzero(valid[order])
        # the least common prefix of all neighbours between two valid ones
        low_shared = np.minimum.reduceat(shared[: where[-1] + 1], np.concatenate([[0], where[:-1] + 1]))
        named = np.zeros(len(order), np.int64)
        named[order[where]] = np.cumsum(low_shared < need)
        return named

    for d in range(int(low.min()), int(high.max()) + 1):
        valid = (low <= d) & (d <= high)
        if not valid.any():
            continue
        here = np.flatnonzero(valid)
        key = classes(order_r, shared_r, valid, how.length - d)[here] * (len(contexts) + 1)
        key += classes(order_l, shared_l, valid, d)[here]
        _, group = np.unique(key, return_inverse=True)
        out[here, d] = np.bincount(group, count[here])[group] >= 2
    return out


def _sorted_masks(contexts: DataFrame, how: Repeats, buckets: int) -> DataFrame:
    """(piece, mask): bit d of the mask is set if the string d bytes before the centre is repeated."""

    def sort(rows: pa.Table) -> pa.Table:
        column = lambda c: rows.column(c).to_numpy().astype(np.int64)
        found = repeated_offsets(rows.column("bytes").to_pylist(), column("low"), column("high"), column("n"), how)
        masks = [m.tobytes() for m in np.packbits(found, axis=1, bitorder="little")]
        return pa.table({"piece": rows.column("piece"), "mask": pa.array(masks, pa.binary())})

    bucket = F.pmod(F.col("core"), F.lit(buckets)).alias("bucket")
    return contexts.select("piece", "low", "high", "n", "bytes", bucket).groupBy("bucket").applyInArrow(sort, "piece long, mask binary")


def _crowded(contexts: DataFrame, how: Repeats) -> DataFrame:
    """(piece, mask) for anchors with very many different contexts: each offset's string is a key of its own."""
    steps = F.sequence(F.col("low").cast("int"), F.col("high").cast("int"))
    strings = contexts.select("piece", "n", "high", "bytes", F.explode(steps).alias("d"))
    strings = strings.select("piece", "n", "d", F.sha2(F.substring("bytes", F.col("high") - F.col("d") + 1, F.lit(how.length)), 256).alias("key"))
    many = strings.groupBy("key").agg(F.sum("n").alias("places")).where("places > 1").select("key")
    hits = strings.join(many, "key", "left_semi").groupBy("piece").agg(F.collect_list("d").alias("ds"))
    size = -(-(how.length - how.gram + 1) // 8)

    def pack(column: pa.Array) -> pa.Array:
        out = []
        for ds in column.to_pylist():
            bits = np.zeros(size * 8, bool)
            bits[ds] = True
            out.append(np.packbits(bits, bitorder="little").tobytes())
        return pa.array(out, pa.binary())

    return hits.select("piece", kernel(pack, "binary")("ds").alias("mask"))


def _spans(found: Column, length: int) -> Column:
    """Maximal byte runs covered by the strings that masks mark: array of struct(start, end)."""

    def run(column: pa.Array) -> pa.Array:
        out = []
        for rows in column.to_pylist():
            if not rows:
                out.append([])
                continue
            starts = np.unique(
                np.concatenate([r["centre"] - np.flatnonzero(np.unpackbits(np.frombuffer(r["mask"], np.uint8), bitorder="little")) for r in rows])
            )
            if not len(starts):
                out.append([])
                continue
            cut = np.flatnonzero(np.diff(starts) > length)
            begin, end = starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])] + length
            out.append([{"start": int(a), "end": int(b)} for a, b in zip(begin, end, strict=True)])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))

    return kernel(run, "array<struct<start:long,end:long>>")(found)


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Repeats | None = None) -> DataFrame:
    """docs with `spans`: the maximal byte runs of the text (UTF-8, places from 0) covered by strings that stand elsewhere too.

    Every row is a document of its own: rows with equal text repeat each other, whatever their keys. Strings never cross
    documents; overlapping places count. Null and short texts have no spans; a column named spans is replaced.
    """
    how = how or Repeats()
    steps = Steps(docs.sparkSession)
    docs = docs.drop("spans")
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(whole).alias("hash"), whole.alias("text")).where(F.octet_length(whole) >= how.length)
    found = rows.select("id", "hash", F.explode(anchors(F.col("text"), how)).alias("a")).select("id", "hash", "a.*")
    found = steps.keep(found)
    # stored, so that the join is one of two plain tables, which is split where an anchor stands very often
    twice = steps.keep(found.groupBy("core").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("core"))
    kept = steps.keep(found.join(twice, "core", "left_semi"))
    steps.drop(found, twice)
    same = ["core", "context", "low", "high"]
    piece = kept.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "hash", "centre")).alias("at"))
    piece = steps.keep(piece.withColumn("piece", F.monotonically_increasing_id()))

    # the bytes of one place of each distinct context
    asked = F.struct("piece", "core", "low", "high", "n", F.col("at.centre").alias("centre"))
    lists = piece.groupBy("at.id", "at.hash").agg(F.collect_list(asked).alias("asked")).select(F.col("id").alias("id_"), F.col("hash").alias("hash_"), "asked")
    here = F.expr("hash = hash_ and id <=> id_")
    some = rows.join(maybe_broadcast(lists.select("id_", "hash_")), here, "left_semi")
    data = F.col("text").cast("binary")
    cut = F.transform(
        "asked",
        lambda a: F.struct(a.alias("a"), F.substring(data, a["centre"] - a["high"] + 1, a["high"] - a["low"] + how.length).alias("bytes")),
    )
    contexts = some.join(lists, here).select(F.explode(cut).alias("c")).select("c.a.*", "c.bytes")
    contexts = steps.keep(contexts.drop("centre").dropDuplicates(["piece"]))
    sizes = contexts.groupBy("core").agg(F.count(F.lit(1)).alias("c"))
    # few keys as a rule, and then sent: contexts of one anchor need not meet in a task
    crowd = maybe_broadcast(steps.keep(sizes.where(F.col("c") > how.crowded).select("core")))
    calm = contexts.join(crowd, "core", "left_anti")
    buckets = max(1, -(-contexts.count() // how.group))
    masks = _sorted_masks(calm, how, buckets).unionByName(_crowded(contexts.join(crowd, "core", "left_semi"), how))
    masks = steps.keep(masks)
    named = piece.select(*same, "piece").join(masks, "piece").select(*same, "mask")
    marked = kept.join(named, same).groupBy("id", "hash").agg(F.collect_list(F.struct("centre", "mask")).alias("found"))
    marked = steps.keep(marked.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), _spans(F.col("found"), how.length).alias("spans")))
    marked = marked.where(F.size("spans") > 0)
    steps.drop(kept, piece, contexts, masks)
    out, at = docs.withColumn("__h", F.xxhash64(whole)), F.expr(f"__h = __hash and `{key}` <=> __id")
    none = F.array().cast("array<struct<start:long,end:long>>")
    keys = marked.select("__id", "__hash")
    if not small_enough(keys):
        return out.join(marked, at, "left").select(*docs.columns, F.coalesce("spans", none).alias("spans"))
    # only texts with spans are shuffled; spans can be many, so their keys alone are sent
    few = F.broadcast(keys)
    changed = out.join(few, at, "left_semi").join(marked, at).select(*docs.columns, "spans")
    return changed.union(out.join(few, at, "left_anti").select(*docs.columns, none.alias("spans")))


def cut_out(text: Column, spans: Column) -> Column:
    """struct(kept, kept_sha256, n_bytes, n_removed, n_spans) of a whole text without its spans.

    kept_sha256 is of the remaining bytes; kept is their text, without characters of which only some bytes remain.
    """

    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        columns = [[], [], [], [], []]
        for t, spans_ in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
            data, at, parts = (t or "").encode(), 0, []
            for s in spans_ or ():
                parts.append(data[at : s["start"]])
                at = s["end"]
            parts.append(data[at:])
            kept = b"".join(parts)
            for column, value in zip(
                columns,
                (kept.decode("utf-8", "ignore") if spans_ else t or "", hashlib.sha256(kept).hexdigest(), len(data), len(data) - len(kept), len(spans_ or ())),
                strict=True,
            ):
                column.append(value)
        kinds = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        names = ["kept", "kept_sha256", "n_bytes", "n_removed", "n_spans"]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return kernel(run, "kept string, kept_sha256 string, n_bytes long, n_removed long, n_spans long")(text, spans)
