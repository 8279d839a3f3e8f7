"""Top-k search, source divergence and spelling variants against plain versions."""

import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from driftloom.llm import divergence, spellings, topk
from driftloom.llm.common import Steps
from pyspark.sql import functions as F

KINDS = "vec_id long, embedding array<double>, query_id string, score int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 1) for i, v in rows], KINDS).repartition(3)


def whole(v):
    """Python's floor is exact for any double."""
    import math

    if v is None or any(x is None or not math.isfinite(x) or not math.isfinite(256 * x) for x in v):
        return None
    return [math.floor(256 * x) for x in v]


def best(rows, every, k=5):
    """(query, rank, id, score), for rows with ids of their own."""
    out = []
    good = [(i, whole(v)) for i, v in rows if whole(v) is not None]
    for i, q in good:
        if i is not None and i % every == 0:
            clip = lambda s: max(min(s, 2**63 - 1), -(2**63))
            scored = [(-clip(sum(a * b for a, b in zip(q, v, strict=True))), j is None, j or 0, j) for j, v in good if j != i and len(v) == len(q)]
            out += [(i, n + 1, j, -s) for n, (s, _, _, j) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def found(df, every, **more):
    got = topk.top_k(df, F.col("vec_id") % every == 0, **more)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, got.collect()))


SMALL = topk.Index(cells=400, part=200, scores=64, spared=0.0)


@pytest.mark.parametrize("how", [None, SMALL])
def test_top_k_against_all_pairs(spark, how):
    r = np.random.default_rng(3)
    rows = [(i, list(map(float, x))) for i, x in enumerate(r.normal(0, 0.2, (150, 6)))]
    rows += [(200 + i, rows[7][1]) for i in range(30)] + [(300 + i, [0.0] * 6) for i in range(12)]
    rows += [(400, [1e-9] * 6), (401, None), (402, []), (410, [0.1, None] + [0.1] * 4), (420, [float("nan")] * 6), (430, [float("inf")] + [0.0] * 5)]
    rows += [(500, [0.5, 0.5]), (510, [0.25, -0.5]), (None, rows[3][1]), (520, []), (530, [1e308] * 6)]
    assert found(vectors(spark, rows), 10, how=how) == best(rows, 10)


@pytest.mark.parametrize("how", [None, SMALL])
def test_top_k_of_huge_components_is_exact(spark, how):
    r = random.Random(1)
    rows = [(i, [r.uniform(-1, 1) * 10 ** r.randrange(12) for _ in range(4)]) for i in range(60)] + [(70, [3e300, 1.0, 0.0, -2e300]), (71, [1e200] * 4)]
    assert found(vectors(spark, rows), 5, how=how) == best(rows, 5)


def test_top_k_with_repeated_keys_and_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.5, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])]
    got = found(vectors(spark, rows), 2)
    one = [(0, 1, 0, 65536), (0, 2, 1, 65536), (0, 3, 1, 65536), (0, 4, 0, 32768)]
    half = [(0, 1, 0, 32768), (0, 2, 0, 32768), (0, 3, 1, 32768), (0, 4, 1, 32768)]
    assert got == sorted(one + one + half)
    assert found(vectors(spark, [(0, [1.0])]), 2) == [] and found(vectors(spark, []), 2) == []


def test_processing_stops_before_all_segments_are_read():
    """Close vectors are told apart from the rest by their large components alone."""
    r = np.random.default_rng(0)
    x = np.floor(256 * r.normal(0, 0.12, (2000, 64)))
    part = topk.Part(x)
    full = len(part.segments)
    part.segments = part.segments[: full - 4]  # less than this would have to be read for a wrong result
    q = x[:20] + np.floor(r.normal(0, 2, (20, 64)))
    part.segments += [None] * 4
    who, what = part.ask(q, np.full(20, -np.inf), 6, 1 / 64)
    assert len(who) <= 20 * 2000 // 64 + 20 * 24
    exact = q @ x.T
    for i in range(20):
        assert set(np.argsort(-exact[i], kind="stable")[:6]) <= set(what[who == i])


DOC = "doc_id long, text string, lang string, source string, term string, n int"


def documents(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], DOC).repartition(3)


def audited(rows, least, most=10):
    groups, of_lang, docs, names = {}, {}, {}, set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", brute.lower(text))
        names.add((lang, source))
        groups.setdefault((lang, source), Counter()).update(words)
        of_lang.setdefault(lang, Counter()).update(words)
        docs.setdefault(lang, Counter()).update(set(words))
    out = []
    for lang in {a for a, _ in names}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 2) // (sum(c[u] for u in kept) + 2 * len(kept)) for t in kept}
        p = {s: share(groups[a, s]) for a, s in names if a == lang}
        q = share(of_lang[lang])
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in p:
            pair = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in p if o != s)
            term = sorted((-f(p[s][t], q[t]), t.encode(), t) for t in kept if groups[lang, s][t] and p[s][t] > q[t])[:most]
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(pair)]
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(term)]
    return sorted(out)


@pytest.mark.parametrize("how", [divergence.Audit(3), divergence.Audit(3, 4, 2, 7, 2)])
def test_divergence_against_plain_counts(spark, how):
    r = random.Random(4)
    words = [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(5)] + ["Über", "ÜBER", "naïve", "日本", "x1y"]
    rows = [
        (i, None if i % 17 == 0 else " ".join(r.choices(words, k=r.randrange(0, 40))), r.choice(["de", "de", "en", None]), r.choice(["a", "a", "a", "b", "c", None, "ß"]))
        for i in range(120)
    ]
    rows += [(500, "only here", "fr", "a"), (501, "", "fr", "b"), (502, None, "fr", None), (503, "alone", "it", "z")] + rows[:5]
    got = divergence.audit(documents(spark, rows), how=how)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == audited(rows, 3, how.terms)


def test_divergence_of_a_long_text_and_of_nothing(spark):
    text = ("alpha beta " * 300_000) + "gamma"
    rows = [(1, text, "en", "a"), (2, "alpha delta", "en", "b")]
    assert sorted(map(tuple, divergence.audit(documents(spark, rows), how=divergence.Audit(1)).collect())) == audited(rows, 1)
    assert divergence.audit(documents(spark, [])).count() == 0


def test_shares_are_exact_beyond_doubles(spark):
    n, total, v = 10**12 + 7, 3 * 10**15 + 1, 10**9
    got = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(v)).alias("p"), divergence.share(F.lit(0), F.lit(0), F.lit(0)).alias("z")).first()
    assert got["p"] == 1 + 10**9 * (n + 2) // (total + 2 * v) and got["z"] is None


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows, least=7, often=2, slip=31, factor=10):
    count = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = brute.lower(run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if slip and h % slip == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                count[run] += 1
    words = {w: n for w, n in count.items() if n >= often}

    out, form = [], {}
    for w, n in words.items():
        around = [(-m, v) for v, m in words.items() if near(w, v)]
        top = min(around, default=None)
        good = top is not None and -top[0] >= factor * n
        form[w] = top[1] if good else None
        out.append([w, form[w], None, n, len(around), -top[0] if good else None])
    for line in out:
        at = line[0]
        while form[at]:
            at = form[at]
        line[2] = at
    return sorted(map(tuple, out))


def spelled(spark, rows, **more):
    df = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    got = spellings.group(df, **more)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, got.collect()))


def typed(r, word):
    at, letter = r.randrange(len(word)), r.choice("abcéÿz")
    return r.choice([word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :]])


@pytest.fixture(scope="module")
def texts():
    r = random.Random(8)
    words = ["".join(r.choices("abcdefgh", k=r.randrange(6, 12))) for _ in range(25)] + ["aaaaaaaa", "aaaaaaaaa", "Größenmaß", "ÀÉÎÕÜàéîõü", "short"]
    rows = []
    for i in range(400):
        line = [w if r.random() < 0.9 else typed(r, w) for w in r.choices(words, weights=[1 + 40 * (k % 7 == 0) for k in range(len(words))], k=30)]
        rows.append((i, r.choice([" ", "-", "1", "日"]).join(line)))
    return rows + [(None, "abcdefgh abcdefgh Abcdefgh"), (5, None), (6, ""), (7, "×××××××÷")] + rows[:9]


@pytest.mark.parametrize("how", [spellings.Variants(), spellings.Variants(crowd=0.0), spellings.Variants(crowd=1e9, factor=2, slip=0, often=1)])
def test_spellings_against_all_pairs(spark, texts, how):
    got = spelled(spark, texts, how=how)
    assert got == variants(texts, how.least, how.often, how.slip, how.factor)
    assert any(line[1] for line in got)


def test_roots_at_the_end_of_long_chains(spark):
    """Each form is ten times as frequent as what leads to it: 1, 10, ... 10000."""
    chain = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcdzyx"]
    rows = [(k, f"{w} " * 2 * 10 ** (4 - k)) for k, w in enumerate(chain)]
    got = {line[0]: line[1:] for line in spelled(spark, rows, how=spellings.Variants(slip=0))}
    for k, w in enumerate(chain):
        form = chain[k - 1] if k else None
        assert got[w] == (form, chain[0], 2 * 10 ** (4 - k), 1 if k in (0, 4) else 2, 2 * 10 ** (5 - k) if k else None)


def test_a_word_of_half_a_million_letters(spark):
    r = random.Random(2)
    word = "".join(r.choices("abcdefghij", k=500_000))
    rows = [(1, word), (2, word), (3, word[:-1]), (4, word[:-1]), (5, word[:250_000] + "z" + word[250_001:]), (6, word[:250_000] + "z" + word[250_001:])]
    got = {line[0]: line[3:5] for line in spelled(spark, rows, how=spellings.Variants(slip=0))}
    assert got == {word: (2, 2), word[:-1]: (2, 1), rows[4][1]: (2, 1)}
    with pytest.raises(ValueError):
        spelled(spark, rows, how=spellings.Variants(factor=1))  # forms of equal frequency could lead in a circle


@pytest.mark.parametrize("symbols", spellings.SYMBOLS)
def test_every_alphabet_finds_the_same_pairs(spark, symbols):
    r = random.Random(symbols)
    words = {"".join(r.choices("abé", k=7)) for _ in range(60)} | {"".join(r.choices("abé", k=8)) for _ in range(60)}
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = spellings.near_pairs(df, Steps(spark), spellings.Variants(), symbols).select("u.word", "v.word").collect()
    text = " ".join(sorted(words))
    want = {line[0]: line[4] for line in variants([(0, text)], often=1, slip=0)}
    counts = Counter(u for u, _ in got)
    assert len(got) == len(set(map(tuple, got))) and {w: counts[w] for w in words} == want


def test_one_edit(spark, monkeypatch):
    r = random.Random(0)
    words = ["", "a", "é", "aaaa", "aaaaa", "abab", "baba", "abaab"] + ["".join(r.choices("abé", k=r.randrange(1, 6))) for _ in range(25)]
    pairs = [(a, b) for a in words for b in words]
    df = spark.createDataFrame(pairs, "a string, b string").repartition(1)
    first = {(x.a, x.b): x.e for x in df.select("a", "b", spellings.one_edit(F.col("a"), F.col("b")).alias("e")).collect()}
    monkeypatch.setattr(spellings, "SHORT", -1)
    second = {(x.a, x.b): x.e for x in df.select("a", "b", spellings.one_edit(F.col("a"), F.col("b")).alias("e")).collect()}
    assert first == second == {(a, b): near(a, b) for a, b in pairs}


def test_no_words(spark):
    assert spelled(spark, []) == [] and spelled(spark, [(1, None), (2, "a b c")]) == []
