"""Near duplicates, repeated strings, embeddings, decontamination against plain versions."""

import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from driftloom.llm import decontaminate, epsilon_grid, minmax, suffixes
from driftloom.llm.common import Steps
from driftloom.llm.components import components


def documents(spark, texts, **more):
    return spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, key string")


def changed(words, r, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randrange(10**6)}"
    return " ".join(words)


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(5)
    base = [[f"w{r.randrange(400)}" for _ in range(120)] for _ in range(6)]
    texts = [None, "", " \n", "one", "One", "one two three", "one two three four five", "x y z " * 9000]
    texts += [changed(b, r, n) for b in base for n in (0, 0, 1, 1, 2, 3, 4, 5, 6, 8)]
    texts += [" ".join(base[0][:100] + base[1][:20]), " ".join(base[0]).upper()]
    got = {x.doc_id: tuple(x)[1:] for x in minmax.near_duplicates(documents(spark, enumerate(texts))).collect()}
    assert got == brute.near(dict(enumerate(texts)))


def test_a_chain_that_the_bucket_centre_does_not_link(spark):
    """Neighbours of a chain are similar, its ends are not: one component, whichever member is the centre."""
    words = [f"c{i}" for i in range(400)]
    texts = [" ".join(words[k * 20 : k * 20 + 200]) for k in range(10)]
    got = {x.doc_id: x.component_id for x in minmax.near_duplicates(documents(spark, enumerate(texts))).collect()}
    assert got == {i: c for i, (_, c, _) in brute.near(dict(enumerate(texts))).items()}
    assert set(got.values()) == {0}


@pytest.mark.parametrize("turns", [0, 1])
def test_what_the_rounds_leave_is_found_by_prefixes(spark, turns):
    """Without rounds of single pairs the components of a bucket are joined by set prefixes; short texts are met for certain."""
    r = random.Random(6)
    base = [f"w{r.randrange(300)}" for _ in range(60)]
    texts = [changed(base, r, n) for n in (0, 1, 1, 1, 2, 2, 2, 3, 3, 4)] + [" ".join(base[k : k + 50]) for k in range(10)]
    texts += ["a b c d e f g", "a b c d e f g h", "b c d e f g h", "a b c d e", "a b c d e f", None, ""]
    got = {x.doc_id: tuple(x)[1:] for x in minmax.near_duplicates(documents(spark, enumerate(texts)), how=minmax.Banding(turns=turns)).collect()}
    assert got == brute.near(dict(enumerate(texts)))


def test_a_long_text_in_pieces_has_the_same_shingles(monkeypatch):
    r = random.Random(1)
    data = np.frombuffer(" ".join(f"{r.randrange(50)}{'x' * r.randrange(9)}" for _ in range(4000)).encode(), np.uint8)
    whole = minmax.shingles(data, np.array([0, len(data)]), 5)
    for piece in (37, 1000, len(data) - 1):
        monkeypatch.setattr(minmax, "PIECE", piece)
        parts = minmax.shingles(data, np.array([0, len(data)]), 5)
        assert np.array_equal(whole[0], parts[0]) and np.array_equal(whole[1], parts[1])
    assert minmax._cuts(np.full(500, 120, np.uint8)) == [0, 500]


def test_repeated_strings_of_a_long_text_in_slices(spark):
    """A passage at the border of two slices, and one in each."""
    r = random.Random(3)
    letters = "".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=2_600_000))
    passage, at = "".join(r.choices("ABCDEFGH", k=450)), [100_000, (1 << 20) - 200, 2_300_000]
    for n, p in enumerate(at):
        letters = letters[: p - 1] + f"{n}{passage}{n}" + letters[p + 451 :]
    found = suffixes.repeated_spans(documents(spark, [(1, letters)])).first()["spans"]
    assert [(s["start"], s["end"]) for s in found] == [(p, p + 450) for p in at]


def test_repeated_and_null_ids(spark):
    long = " ".join(f"v{i}" for i in range(50))
    rows = [(3, long), (3, long), (3, "other words"), (None, long), (None, "alone"), (7, long)]
    got = sorted(map(tuple, minmax.near_duplicates(documents(spark, rows)).collect()), key=str)
    assert got == sorted([(3, 46, 3, True), (3, 46, 3, True), (3, 1, 3, True), (None, 46, 3, False), (None, 1, None, True), (7, 46, 3, False)], key=str)


def test_components(spark):
    r = random.Random(2)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)] + [(5, 5), (2000, None)]
    links += [(3000, 3001 + i) for i in range(400)]
    got = {x.node: x.component for x in components(spark.createDataFrame(links, "u long, v long"), Steps(spark)).collect()}
    real = [(a, b) for a, b in links if b is not None and a != b]
    assert got == brute.groups({x for pair in real for x in pair}, real)


def spans_of(spark, texts, how):
    found = suffixes.repeated_spans(documents(spark, enumerate(texts)).withColumn("spans", F.lit(1)), how=how)
    cut = found.select("doc_id", suffixes.cut_out(F.col("text"), F.col("spans")).alias("c")).collect()
    return [(x.c.n_bytes, x.c.n_removed, x.c.n_spans, x.c.kept_sha256) for x in sorted(cut)]


@pytest.mark.parametrize("crowded", [5000, 2])
def test_repeated_strings_against_all_places(spark, crowded):
    r = random.Random(3)
    base = "".join(r.choice("abc é") for _ in range(300))
    texts = [None, "", "abc", "a" * 300, "ab" * 100]
    for _ in range(40):
        parts = []
        for _ in range(r.randint(1, 5)):
            at = r.randrange(250)
            parts.append(base[at : at + r.randint(10, 120)] if r.random() < 0.5 else "".join(r.choice("abcdé\0 ") for _ in range(r.randint(0, 60))))
        texts.append("".join(parts))
    texts += texts[10:13]
    how = suffixes.Repeats(length=40, gram=8, shallow=16, group=60, crowded=crowded)
    assert spans_of(spark, texts, how) == brute.repeats(texts, 40)


def test_repeated_strings_at_full_length(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()][:120]
    assert spans_of(spark, texts, suffixes.Repeats()) == brute.repeats(texts, 400)


@pytest.mark.parametrize("few", [True, False])
def test_texts_without_repeats_are_not_shuffled(spark, tmp_path, monkeypatch, few):
    """Only texts with spans meet them in a shuffle, unless these are too many to send their keys."""
    r = random.Random(21)
    noise = lambda n: "".join(r.choices("abcdefghijklmnop é", k=n))
    passage = noise(430)
    rows = [(i, noise(600)) for i in range(60)] + [(60, noise(50) + passage), (61, passage + noise(70)), (None, passage), (62, None), (5, passage), (5, "b")]
    rows += [(63, passage + "1" + passage)]
    documents(spark, rows).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    if not few:
        monkeypatch.setattr(suffixes, "small_enough", lambda df: False)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = suffixes.repeated_spans(docs)
        got = found.select("doc_id", "text", suffixes.cut_out(F.col("text"), F.col("spans")).alias("c")).collect()
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert ("LeftOuter" in plan) is not few and ("LeftAnti, BuildRight" in plan) is few
    want = [(i, t, *cut) for (i, t), cut in zip(rows, brute.repeats([t for _, t in rows], 400), strict=True)]
    assert sorted(((x.doc_id, x.text, x.c.n_bytes, x.c.n_removed, x.c.n_spans, x.c.kept_sha256) for x in got), key=str) == sorted(want, key=str)


def test_deep_shallow_sorts_like_sorted():
    r = np.random.default_rng(1)
    rows = r.integers(0, 3, (500, 48)).astype(np.uint8)
    rows[100:300, :40] = rows[100, :40]
    rows[300:320] = rows[299]
    order = suffixes.deep_shallow(rows, 16)
    assert [rows[i].tobytes() for i in order] == sorted(x.tobytes() for x in rows)
    assert sorted(order) == list(range(500))


def plain_links(vectors, cosine):
    ids = [i for i, v in vectors if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    kept = dict(vectors)
    unit = {i: np.array(kept[i], float) / np.linalg.norm(np.array(kept[i], float)) for i in ids}
    return [(a, b) for n, a in enumerate(ids) for b in ids[:n] if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine]


@pytest.mark.parametrize("block", [4096, 16])
def test_embeddings_against_all_pairs(spark, block):
    r = np.random.default_rng(4)
    centres = r.normal(size=(12, 16))
    rows = [c + r.normal(scale=s, size=16) for c in centres for s in (0, 0, 0.1, 0.2, 0.3, 0.4, 0.5)]
    rows += [2.5 * rows[3], -rows[3], rows[5] * 1e-30]
    vectors = [(i, [float(x) for x in v]) for i, v in enumerate(rows)]
    vectors += [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0, None] * 8), (905, [float("inf")] * 16)]
    vectors += [(910, [1.0, 0.0]), (911, [1.0, 0.1]), (912, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in vectors], "vec_id long, embedding array<double>, label int")
    how = epsilon_grid.Grid(block=block, leaf=8, axes=4)
    got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in epsilon_grid.near_duplicates(df, how=how).collect()}
    links = plain_links(vectors, 0.9)
    root = brute.groups([i for i, _ in vectors], links)
    count = {i: sum(i in pair for pair in links) for i, _ in vectors}
    assert got == {i: (count[i], root[i], root[i] == i) for i, _ in vectors}


def clustered(r, clusters, each, size, spread):
    """Vectors around random centres, in a random order."""
    import numpy as np

    rng = np.random.default_rng(r)
    centres = rng.normal(size=(clusters, size))
    x = np.repeat(centres, each, 0) + spread * rng.normal(size=(clusters * each, size))
    return x[rng.permutation(len(x))]


def vector_table(spark, x):
    import pyarrow as pa

    return spark.createDataFrame(pa.table({"vec_id": pa.array(range(len(x))), "embedding": pa.array(list(x))})).repartition(6)


def cosine_groups(x, least=0.9):
    """{row: (links, smallest reachable, kept)} from all products."""
    import numpy as np

    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= least
    np.fill_diagonal(near, False)
    root = brute.groups(range(len(x)), [(int(a), int(b)) for a, b in np.argwhere(near) if a < b])
    return {i: (int(near[i].sum()), root[i], root[i] == i) for i in range(len(x))}


def test_intervals_far_apart_are_not_joined(spark):
    """Of 100 clusters less than a tenth of the interval pairs are left, and no link is lost."""
    x = clustered(3, 100, 64, 32, 0.03)
    df = vector_table(spark, x)
    how = epsilon_grid.Grid(block=32, leaf=8)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in epsilon_grid.near_duplicates(df, how=how).collect()}
    assert got == cosine_groups(x)
    steps = Steps(spark)
    classes = steps.keep(df.select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("copies"), F.col("embedding").alias("v")))
    axes = epsilon_grid._axes(classes, 32, how)
    blocks = steps.keep(epsilon_grid._blocks(classes, 32, axes, how))
    n, left = blocks.count(), epsilon_grid._near_blocks(blocks, 32, axes, how, steps).count()
    print(f"{left} of {n * (n + 1) // 2} pairs of intervals are joined")
    assert n == 200 and left < 0.1 * n * (n + 1) / 2


def test_long_vectors(spark):
    x = clustered(4, 30, 10, 1024, 0.2)
    how = epsilon_grid.Grid()
    assert how.rows(1024) * 1024 * 8 <= epsilon_grid.BLOCK_BYTES
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in epsilon_grid.near_duplicates(vector_table(spark, x), how=how).collect()}
    assert got == cosine_groups(x)


def plain_leaks(docs, items, share=0.75):
    """Every window of an item's length, wherever it begins."""
    import re
    from collections import Counter

    from driftloom.llm.licenses import WORD

    words = lambda t: re.findall(WORD, brute.lower(t))
    grams = lambda w, k: Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    found = set()
    for d, text in docs:
        w = words(text)
        for i, item in items:
            v = words(item)
            if not v or not w:
                continue
            k = min(5, len(v))
            a = grams(v, k)
            for s in range(max(len(w) - len(v), 0) + 1):
                b = grams(w[s : s + len(v)], k)
                both = sum((a & b).values())
                if both and both >= share * (sum(a.values()) + sum(b.values()) - both):
                    found.add((d, i))
    return found


def test_leaks_against_all_windows(spark):
    r = random.Random(8)
    items = [(i, " ".join(f"b{r.randrange(300)}" for _ in range(n))) for i, n in enumerate([3, 5, 12, 30, 30, 60])]
    items += [(90, None), (91, ""), (92, "?!")]
    noise = lambda n: [f"n{r.randrange(300)}" for _ in range(n)]
    docs = [(0, None), (1, ""), (2, "b1 b2"), (3, " ".join(noise(9000)))]
    for i, text in items[:6]:
        docs.append((10 + i, " ".join([*noise(40), text.upper().replace(" ", ", "), *noise(20)])))
        docs.append((20 + i, " ".join([*noise(7), *changed(text.split(), r, len(text.split()) // 30).split(), *noise(3)])))
        docs.append((30 + i, " ".join([*text.split()[: len(text.split()) // 2], *noise(9)])))
    docs.append(docs[5])
    table = documents(spark, docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(table, bench).collect()
    assert {(x.doc_id, x.item_id) for x in got} == plain_leaks(docs, items)
    assert len(got) == len({(x.doc_id, x.item_id) for x in got})
    bad = {x.doc_id for x in got}
    assert sorted(x.doc_id for x in decontaminate.clean(table, bench).collect()) == sorted(d for d, _ in docs if d not in bad)
    assert decontaminate.clean(table, bench.limit(0)).count() == len(docs)


def test_leaks_with_runs_of_one_word(spark):
    """Runs of equal words that were changed for runs of another word: similar by the exact share, whatever is repeated."""
    r = random.Random(10)
    items, docs = [], []
    for i in range(40):
        size, run = r.choice([(176, 28), (90, 14), (78, 12)])
        words = [f"u{i}x{k}" for k in range(size)]
        items.append((i, " ".join([*words, *["same"] * run])))
        docs.append((i, " ".join([*words, *["other"] * run, "end"])))
        docs.append((100 + i, " ".join(["start", *words, *["same"] * (run - 2), "x", "y"])))
    want = plain_leaks(docs, items)
    assert len(want) >= 60
    got = decontaminate.leaks(documents(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want


def test_hamming_blocks_cover_the_radius():
    """Every value within the radius agrees with some block up to radius // BLOCKS bits."""
    r = random.Random(1)
    how = decontaminate.Matching()
    for _ in range(300):
        flips = r.sample(range(64), how.radius)
        per_block = [sum(f // 8 == b for f in flips) for b in range(decontaminate.BLOCKS)]
        assert min(per_block) <= how.radius // decontaminate.BLOCKS


def test_anchors_of_many_texts_need_little_memory():
    """A megabyte of texts is worked on in slices: some 100 bytes a byte of a slice, not of the batch."""
    import tracemalloc

    import pyarrow as pa

    r = np.random.default_rng(3)
    column = pa.array([r.integers(97, 123, 20_000, np.uint8).tobytes().decode() for _ in range(50)])
    data, offsets = suffixes.utf8(column)
    sizes = [int(offsets[b] - offsets[a]) for a, b in suffixes.pieces(offsets, suffixes.SLICE_BYTES)]
    assert sum(sizes) == 1_000_000
    tracemalloc.start()
    for a, b in suffixes.pieces(offsets, suffixes.SLICE_BYTES):
        suffixes._anchors(data[int(offsets[a]) : int(offsets[b])], offsets[a : b + 1] - offsets[a], suffixes.Repeats())
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < 45 << 20
