"""Near duplicates by min-max hashing: both the smallest and the largest hash under each permutation, in bands.

A document's set is its distinct five-word shingles. Documents with equal sets form a class; classes that share a band
meet at one member of the band's bucket, and every link that decides a component is confirmed on the full sets.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.llm.common import SLICE_BYTES, Steps, kernel, maybe_broadcast, mixed, pieces, prefix_hashes, span_hash, utf8
from driftloom.llm.components import components

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


@dataclass(frozen=True)
class Banding:
    """permutations give two values each; a band has the minima and the maxima of `band` permutations.

    186 permutations are 62 bands of six values. A pair whose sets share s of u shingles agrees in both ends of a permutation with chance
    s * (s - 1) / (u * (u - 1)), so at similarity 0.75 a pair shares no band with a chance of 5e-6 (large sets) to 1e-5 (sets of 24).
    small: sets of at most so many shingles have the first of their shingles in the order of the hashes as further bands: as many as
    a set can miss and still be similar. Pairs of which one set has 3/4 of that or less are met for certain.
    Of pairs at similarity 0.5 62 % share a band, at 0.4 22 %, at 0.3 4 %.
    similarity: hundredths that the size of the intersection must be of the union's. turns: rounds at most in which
    components that share a bucket are tried to be joined by single pairs, before all pairs that are still possible are.
    """

    permutations: int = 186
    band: int = 3
    small: int = 32
    words: int = 5
    similarity: int = 75
    seed: int = 11
    turns: int = 3


# Bytes of a text whose words are looked for at once; a longer text is cut at white space.
PIECE = SLICE_BYTES


def _words(local: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each word; a word ends where its row ends."""
    word = ~_SPACE[local]
    before = np.zeros(len(local), bool)
    before[1:] = word[:-1]
    after = np.zeros(len(local), bool)
    after[:-1] = word[1:]
    edges = bounds[:-1][np.diff(bounds) > 0]
    before[edges] = False
    after[edges[1:] - 1] = False
    starts, ends = np.flatnonzero(word & ~before), np.flatnonzero(word & ~after) + 1
    return span_hash(prefix_hashes(local), starts, ends), np.searchsorted(bounds, starts, "right") - 1


def _cuts(local: np.ndarray) -> list[int]:
    """Places of white space that cut a long text into pieces of about PIECE bytes."""
    at, cuts = 0, [0]
    while at + PIECE < len(local):
        at += PIECE
        while at < len(local) and not (gap := _SPACE[local[at : at + PIECE]]).any():
            at += PIECE
        if at < len(local):
            at += int(gap.argmax())
            cuts.append(at)
    return [*cuts, len(local)]


def shingles(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's distinct shingles, sorted, one row after another, and the sizes of the sets."""
    local = _LOWER[data[int(offsets[0]) : int(offsets[-1])]]
    bounds = (offsets - offsets[0]).astype(np.int64)
    rows = len(bounds) - 1
    if rows == 1 and len(local) > PIECE:
        cuts = _cuts(local)
        parts = [_words(local[a:b], np.array([0, b - a])) for a, b in zip(cuts, cuts[1:])]
        hashed, row = np.concatenate([h for h, _ in parts]), np.concatenate([r for _, r in parts])
    else:
        hashed, row = _words(local, bounds)
    count = np.bincount(row, minlength=rows)
    first = np.cumsum(count) - count
    step = mixed(np.arange(2, width + 2, dtype=np.uint64)) | np.uint64(1)
    whole = len(hashed) - width + 1
    found = np.zeros(max(whole, 0), np.uint64)
    for j in range(width):
        found += hashed[j : j + whole] * step[j] if whole > 0 else found
    found = mixed(found)
    same = row[: max(whole, 0)] == row[width - 1 :] if whole > 0 else np.zeros(0, bool)
    per_row, sizes = [], np.zeros(rows, np.int64)
    left = np.concatenate([[0], np.cumsum(same)])
    found = found[same]
    for r in range(rows):
        n, a = int(count[r]), int(first[r])
        if n >= width:
            part = np.sort(found[left[a] : left[a + n - width + 1]])
            part = part[np.concatenate([[True], part[1:] != part[:-1]])]
        elif n:  # the whole sequence of a short text
            part = mixed((hashed[a : a + n] * step[:n]).sum(keepdims=True, dtype=np.uint64) ^ mixed(np.uint64([n])))
        else:
            part = hashed[:0]
        per_row.append(part)
        sizes[r] = len(part)
    return (np.concatenate(per_row) if per_row else found[:0]), sizes


def _bands(found: np.ndarray, sizes: np.ndarray, how: Banding) -> list[np.ndarray]:
    """Band hashes of each non-empty set; rows of empty sets are left out."""
    at = (np.cumsum(sizes) - sizes)[sizes > 0]
    odd = mixed(np.arange(1, 2 * how.permutations + 1, dtype=np.uint64) * np.uint64(2 * how.seed + 1)) | np.uint64(1)
    bands = []
    for k in range(0, how.permutations, how.band):
        band = np.full(len(at), mixed(np.uint64([k + 1]))[0])
        for j in range(k, min(k + how.band, how.permutations)):
            h = (found ^ odd[how.permutations + j]) * odd[j]
            for value in (np.minimum.reduceat(h, at), np.maximum.reduceat(h, at)):
                band = mixed(band ^ value) + np.uint64(k)
        bands.append(band)
    rows = np.stack(bands, 1)
    # found is sorted, so the beginning of a set is its prefix in one order that all sets have in common
    first = [
        mixed(found[a : a + n - (how.similarity * n + 99) // 100 + 1] ^ odd[0]) if n <= how.small else found[:0]
        for a, n in zip(at.tolist(), sizes[sizes > 0].tolist(), strict=True)
    ]
    return [np.concatenate(pair) for pair in zip(rows, first, strict=True)]


def _by_parts(column: pa.Array, width: int):
    data, offsets = utf8(column)
    for a, b in pieces(offsets, SLICE_BYTES):
        yield shingles(data, offsets[a : b + 1], width)


def set_key(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Two 64-bit words that identify each set that begins at `at`."""
    return np.stack([np.add.reduceat(mixed(found ^ salt), at) for salt in mixed(np.arange(101, 103, dtype=np.uint64))], 1)


def signature(text: Column, how: Banding) -> Column:
    """struct(n, key, bands) of a whole text: size of its set, 128 bits that identify the set, one hash per band.

    A text without words, or null, has n = 0, a null key and no band.
    """
    kind = pa.list_(pa.int64())

    def sign(column: pa.Array) -> pa.Array:
        n, keys, bands = [], [], []
        for found, sizes in _by_parts(column, how.words):
            if sizes.any():
                key, band = set_key(found, (np.cumsum(sizes) - sizes)[sizes > 0]), _bands(found, sizes, how)
            at = 0
            for size in sizes.tolist():
                n.append(size)
                keys.append(key[at].tobytes() if size else None)
                bands.append(band[at].view(np.int64) if size else None)
                at += size > 0
        parts = [pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, kind)]
        return pa.StructArray.from_arrays(parts, ["n", "key", "bands"])

    return kernel(sign, "n long, key binary, bands array<long>")(text)


def keyed_set(text: Column, how: Banding) -> Column:
    """struct(key, set): the key of `signature`, and the hashes of the distinct shingles, sorted."""

    def collect(column: pa.Array) -> pa.Array:
        keys, sets = [], []
        for found, sizes in _by_parts(column, how.words):
            for size, end in zip(sizes.tolist(), np.cumsum(sizes).tolist(), strict=True):
                part = found[end - size : end]
                keys.append(set_key(part, np.zeros(1, int))[0].tobytes() if size else None)
                sets.append(part.view(np.int64))
        parts = [pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(parts, ["key", "set"])

    return kernel(collect, "key binary, set array<long>")(text)


def _confirmed(pairs: DataFrame, sets: DataFrame, how: Banding) -> DataFrame:
    """Pairs (u, v) of classes whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("u"), F.col("set").alias("set_u"))
    right = sets.select(F.col("node").alias("v"), F.col("set").alias("set_v"))
    both = pairs.join(right, "v").join(left, "u")
    shared = F.size(F.array_intersect("set_u", "set_v")).cast("long")
    union = F.size("set_u") + F.size("set_v") - shared
    return both.where(100 * shared >= how.similarity * union).select("u", "v")


def _any(df: DataFrame) -> bool:
    return df.agg(F.max(F.lit(True))).first()[0] is not None


def _edges(labels: DataFrame) -> DataFrame:
    return labels.select(F.col("node").alias("u"), F.col("component").alias("v"))


def _near_labels(links: DataFrame, before: DataFrame | None, steps: Steps) -> DataFrame:
    """(node, component): the smallest node within two links, where a label found before counts as a link.

    Equal labels are surely one component; different ones may still be. They only tell which pairs need no comparing.
    """
    links = links if before is None else links.union(_edges(before))
    both = steps.keep(links.union(links.select("v", "u")).where("u <> v").distinct())
    one = steps.keep(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    next_ = both.join(one.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("m").alias("m"))
    out = steps.keep(next_.select(F.col("u").alias("node"), F.least("u", "m").alias("component")))
    steps.drop(both, one)
    return out


def _placed(members: DataFrame, labels: DataFrame, steps: Steps) -> DataFrame:
    """(band, node, component): members of buckets that still hold several components."""
    named = members.select("band", "node").join(labels, "node", "left").select("band", "node", F.coalesce("component", "node").alias("component"))
    named = steps.keep(named)
    several = named.groupBy("band").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
    return named.join(steps.keep(several.select("band")), "band", "left_semi")


def _between(placed: DataFrame, turn: int) -> DataFrame:
    """One pair for each two components of a bucket of which one is drawn first in it: drawn members of both."""
    draw = F.struct(F.xxhash64(F.lit(turn), "node").alias("h"), "node")
    drawn = placed.groupBy("band", "component").agg(F.min(draw)["node"].alias("node"))
    lead = F.struct(F.xxhash64(F.lit(turn), "component").alias("h"), "node", "component")
    first = drawn.groupBy("band").agg(F.min(lead).alias("lead"))
    met = drawn.join(first, "band").where("component <> lead.component")
    two = [F.least("component", "lead.component").alias("a"), F.greatest("component", "lead.component").alias("b")]
    pair = F.struct(F.least("node", "lead.node").alias("u"), F.greatest("node", "lead.node").alias("v"))
    return met.groupBy(*two).agg(F.min(pair).alias("pair")).select("pair.u", "pair.v")


def _possible(placed: DataFrame, sets: DataFrame, how: Banding, steps: Steps) -> DataFrame:
    """Pairs (u, v) of different components that may be similar enough, by prefixes of their sets.

    Shingles are ordered by how many of these sets hold them, rarest first. Similar sets share one of the first shingles of both, and
    where they first meet enough must be left of both (size and position filter). A set's shingle is also left out if not even
    the smallest set that has it could be similar. What cannot link is not paired.
    """
    nodes = steps.keep(placed.select("node", "component").distinct())
    held = steps.keep(sets.join(nodes, "node").select("node", "component", F.size("set").cast("long").alias("n"), F.explode("set").alias("shingle")))
    often = steps.keep(held.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")))
    ordered = held.join(often, "shingle").groupBy("node", "component", "n").agg(F.sort_array(F.collect_list(F.struct("c", "shingle"))).alias("set"))
    most = F.expr(f"cast(n - ({how.similarity} * n + 99) div 100 + 1 as int)")
    prefix = ordered.select("node", "component", "n", F.posexplode(F.slice("set", F.lit(1), most)).alias("at", "s")).where("s.c > 1")
    prefix = prefix.select("node", "component", "n", (F.col("n") - F.col("at")).alias("left"), F.col("s.shingle").alias("shingle"))
    prefix = steps.keep(prefix)
    enough = lambda left, n, m: f"100 * {left} >= {how.similarity} * ({n} + {m} - {left})"
    met = prefix.groupBy("shingle").agg(F.min("n").alias("smallest"), F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
    met = steps.keep(met.select("shingle", "smallest"))
    prefix = steps.keep(prefix.join(met, "shingle").where(enough("left", "n", "smallest")).drop("smallest"))
    one = prefix.select("shingle", F.col("node").alias("u"), F.col("component").alias("cu"), F.col("n").alias("nu"), F.col("left").alias("lu"))
    two = prefix.select("shingle", F.col("node").alias("v"), F.col("component").alias("cv"), F.col("n").alias("nv"), F.col("left").alias("lv"))
    pairs = one.join(two, "shingle").where("u < v and cu <> cv").where(enough("least(lu, lv)", "nu", "nv"))
    out = steps.keep(pairs.select("u", "v").distinct())
    steps.drop(nodes, held, often, met)
    return out


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", how: Banding | None = None) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of docs.

    component_id is the smallest key reachable over links, itself included; kept marks rows whose key it is. Rows without words
    link with nothing; a null key stays null and takes no part in the minimum of its component unless it is alone. Rows
    with equal sets are one class. Each class is first compared with the heaviest centre of its buckets, then drawn members of the
    components of a bucket with each other. Classes of buckets that are still in different components are at last joined by
    prefixes of their sets. So no link that could change a component is lost, and pairs within one component are not made.
    An empty table gives no rows; other columns of docs take no part.
    """
    how = how or Banding()
    steps = Steps(docs.sparkSession)
    signed = docs.select(F.col(key).alias("id"), signature(F.col(text), how).alias("s")).select("id", "s.*")
    signed = steps.keep(signed)
    classes = signed.where("n > 0").groupBy("key").agg(F.min("id").alias("first"), F.first("bands").alias("bands"))
    classes = steps.keep(classes.select(F.monotonically_increasing_id().alias("node"), "key", "first", "bands"))
    banded = classes.select("node", F.explode("bands").alias("band"))
    # each of these is stored, so that a join is one of two plain tables, which is split where a bucket is very large
    sizes = steps.keep(banded.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1"))
    members = steps.keep(banded.join(sizes, "band"))
    # a bucket's centre is the member that meets most others: an original meets its copies more often than they each other
    weights = steps.keep(members.groupBy("node").agg(F.sum("size").alias("weight")))
    centres = steps.keep(members.join(weights, "node").groupBy("band").agg(F.max(F.struct("weight", "node")).alias("heavy")))
    stars = members.join(centres, "band").groupBy("node").agg(F.max("heavy")["node"].alias("centre")).where("node <> centre")
    stars = stars.select(F.least("centre", "node").alias("u"), F.greatest("centre", "node").alias("v")).distinct()

    wanted = weights.select("node").join(classes.select("node", "key", "first"), "node")
    firsts = maybe_broadcast(wanted.select("first", "node", "key"))
    chosen = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(firsts, F.expr("id <=> first"))
    full = chosen.select("node", "key", keyed_set(F.col("text"), how).alias("s")).where("s.key = key")
    sets = steps.keep(full.select("node", "s.set").dropDuplicates(["node"]))

    links = steps.keep(_confirmed(stars, sets, how))
    labels = _near_labels(links, None, steps)
    for turn in range(1, how.turns + 1):
        placed = _placed(members, labels, steps)
        more = steps.keep(_confirmed(_between(placed, turn), sets, how))
        if not _any(more):
            break
        links = links.union(more)
        labels = _near_labels(links, labels, steps)
    more = steps.keep(_confirmed(_possible(_placed(members, labels, steps), sets, how, steps), sets, how))
    # labels shorten the ways: what is left to connect are links between different labels
    u, v = labels.select(F.col("node").alias("u"), F.col("component").alias("cu")), labels.select(F.col("node").alias("v"), F.col("component").alias("cv"))
    between = links.union(more).join(u, "u", "left").join(v, "v", "left")
    between = between.select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")).where("u <> v").distinct()
    joined = steps.keep(components(_edges(labels).union(between), steps))
    named = classes.select("node", "key", "first").join(joined, "node", "left").select("key", "first", F.coalesce("component", "node").alias("component"))
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    answer = steps.keep(named.join(smallest, "component").select(F.col("key").alias("class"), "component_id"))
    steps.drop(sets, members, sizes, weights, centres, more, classes)
    out = signed.select("id", "n", "key").join(answer, F.col("key") == answer["class"], "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.expr("id <=> coalesce(component_id, id)").alias("kept"),
    )
