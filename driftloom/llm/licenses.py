"""License scans: an exact set-similarity join of text blocks with license templates, beside exact phrases.

A block is a line, and with `window` also a run of so many words, wherever lines break. A block meets a template when it
contains at least `THRESHOLD` of the template's distinct words. Template words are ordered by the number of blocks that hold them, rarest first, over the whole corpus; a block can only meet a
template if the two share a word of the template's prefix (its rarest words), if the block has enough template
words (length), and if enough words are left at that place of both orders (position). What passes is counted exactly.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.llm.common import Steps, lowered

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Phrases whose places are counted, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# (label, notice): wording that public licenses are announced with. No notice holds all words of another one, and up to nine words all
# must be there, so that a version number or the one word that tells two licenses apart always counts.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license"),
    ("gpl-3", "gnu general public license version 3"),
    ("gpl-2", "gnu general public license version 2"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "released under cc0 1 0 universal public domain dedication"),
)
THRESHOLD = Fraction(9, 10)
# Words of a window: twice the longest notice. They begin every quarter of that, so a run of three quarters is whole in one.
WINDOW = 2 * max(len(t.split()) for _, t in TEMPLATES)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def need(size: int, threshold: Fraction) -> int:
    """Words of a template of this many distinct words that a block must contain."""
    return -(-size * threshold.numerator // threshold.denominator)


def _places(tokens: Column, text: Column, phrase: str) -> Column:
    """Numbers of the words where the phrase begins. Texts without one of its words are not walked through."""
    parts = phrase.split()
    last = F.size(tokens) - len(parts)

    def here(i):
        same = F.get(tokens, i) == parts[0]
        for k, part in enumerate(parts[1:], 1):
            same = same & (F.get(tokens, i + k) == part)
        return same

    may = last >= 0
    for part in parts:
        may = may & F.contains(text, F.lit(part))
    return F.when(may, F.filter(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), here)).otherwise(
        F.array().cast("array<int>")
    )


def scan(
    docs: DataFrame,
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: Fraction = THRESHOLD,
    window: int = 0,
) -> DataFrame:
    """docs with n_words, n_base, first_word, last_word, base_labels, labels, score.

    Every column of docs except the text is kept; columns that have one of the new names are replaced. A null text is
    empty: no words, no labels, score 0. score is the largest contained share of a template that a block meets, 1 where
    a phrase stands, 0 otherwise. window: words of the windows that are blocks beside the lines, 0 for lines only; with WINDOW
    a notice is found however its lines are wrapped. Repeated rows are answered one by one. Works for any number of lines; lines with very
    frequent words cost a row in no join, since frequent words are not in prefixes.
    """
    steps = Steps(docs.sparkSession)
    vocabulary = sorted({w for _, t in templates for w in t.split()})
    sizes = [len(set(t.split())) for _, t in templates]
    fewest = min(need(s, threshold) for s in sizes)
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    others = [c for c in docs.columns if c != text and c not in new]
    raw = lowered(F.col(text))
    place_lists = [f"__places_{i}" for i in range(len(phrases))]
    known = F.array(*map(F.lit, vocabulary))
    lines = F.transform(F.split("__lower", "\n"), lambda line: F.array_intersect(words(line), known))
    # texts of one line, or with too few words of every template, need no windows
    may = F.lit(False)
    for (_, t), size in zip(templates, sizes, strict=True):
        held = F.size(F.array_intersect("__held", F.array(*[F.lit(w) for w in sorted(set(t.split()))])))
        may = may | (held >= need(size, threshold))
    starts = F.sequence(F.lit(1), F.greatest(F.size("__words"), F.lit(1)), F.lit(max(1, window // 4)))
    runs = F.transform(starts, lambda i: F.array_intersect(F.slice("__words", i, window), known))
    if window:
        lines = F.when(may & F.contains("__lower", F.lit("\n")), F.array_distinct(F.concat(lines, runs))).otherwise(lines)
    read = (
        docs.select(*others, raw.alias("__lower"))
        .select(*others, "__lower", words(F.col("__lower")).alias("__words"))
        .select("*", F.array_intersect("__words", known).alias("__held"))
        .select(
            *others,
            F.size("__words").cast("long").alias("n_words"),
            *[_places(F.col("__words"), F.col("__lower"), p).alias(c) for p, c in zip(phrases, place_lists, strict=True)],
            F.filter(lines, lambda line: F.size(line) > 0).alias("__lines"),
        )
        .withColumn("__row", F.monotonically_increasing_id())
    )
    read = steps.keep(read)
    counted = {
        r["w"]: r["n"]
        for r in read.select(F.explode(F.flatten("__lines")).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()
    }  # at most one row per word of the templates
    order = {w: i for i, w in enumerate(sorted(vocabulary, key=lambda w: (counted.get(w, 0), w)))}
    entries = []
    for (label, notice), size in zip(templates, sizes, strict=True):
        ranks, must = sorted({order[w] for w in notice.split()}), need(size, threshold)
        prefix = ranks[: size - must + 1]
        entries += [(r, i, label, ranks, prefix, must) for i, r in enumerate(prefix)]
    index = docs.sparkSession.createDataFrame(
        entries, "rank int, place int, label string, ranks array<int>, prefix array<int>, must int"
    )
    ranked = F.create_map(*[F.lit(x) for w, i in order.items() for x in (w, i)])
    blocks = read.select("__row", F.explode("__lines").alias("line")).where(F.size("line") >= fewest)
    blocks = blocks.select("__row", F.array_sort(F.transform("line", lambda w: F.element_at(ranked, w))).alias("line"))
    tokens = blocks.select("__row", "line", F.posexplode("line").alias("at", "rank"))
    enough = F.least(F.size("ranks") - F.col("place"), F.size("line") - F.col("at")) >= F.col("must")
    once = F.array_min(F.array_intersect("line", "prefix")) == F.col("rank")
    found = (
        tokens.join(F.broadcast(index), "rank")
        .where((F.size("line") >= F.col("must")) & enough & once)
        .withColumn("shared", F.size(F.array_intersect("line", "ranks")))
        .where("shared >= must")
        .groupBy("__row")
        .agg(F.collect_set("label").alias("__found"), F.max(F.col("shared") / F.size("ranks")).alias("__share"))
    )
    empty = F.array().cast("array<string>")
    base = F.concat(
        *[F.when(F.size(c) > 0, F.array(F.lit(label))).otherwise(empty) for c, label in zip(place_lists, phrases.values(), strict=True)]
    )
    places = F.concat(*[F.col(c) for c in place_lists])
    names = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return read.join(found, "__row", "left").select(
        *others,
        "n_words",
        F.size(places).cast("long").alias("n_base"),
        F.array_min(places).cast("long").alias("first_word"),
        F.array_max(places).cast("long").alias("last_word"),
        names(base).alias("base_labels"),
        names(F.concat(base, F.coalesce("__found", empty))).alias("labels"),
        F.when(F.size(places) > 0, 1.0).otherwise(F.coalesce("__share", F.lit(0.0))).alias("score"),
    )
