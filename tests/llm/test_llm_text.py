"""License scans, chat formatting, language, pages: cases by hand, nulls, long texts, repeated rows, clashing names."""

import hashlib
from fractions import Fraction

import compare
import duckdb
import pytest
from pyspark.sql import functions as F

from driftloom.llm import chat, languages, licenses, pages, queries

WORDY = "word " * 30_000


def test_license_cases(spark):
    rows = [
        (1, "Released under the MIT License.\nmore"),
        (2, "under the MIT\nlicense"),  # words stand consecutively, whatever is between them
        (3, "This work is licensed under the GNU General Public License, version 3."),
        (4, "Licensed under the Apache License, Version 2.0. under the mit license under the mit license"),
        (5, None),
        (6, ""),
        (7, WORDY + "cc-by-nc"),
        (7, WORDY + "cc-by-nc"),
        (8, "the gnu and the mit\nand public\nlicense"),
        (9, "É under thé mit license"),
    ]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, labels string")
    got = [tuple(r) for r in licenses.scan(df).orderBy("doc_id").collect()]
    names = licenses.scan(df).columns
    assert names == ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    assert got[0] == (1, 6, 1, 1, 1, "mit", "mit", 1.0)
    assert got[1][2:] == (1, 0, 0, "mit", "mit", 1.0)
    assert got[2][2:] == (0, None, None, "", "gpl-3", 1.0)
    assert got[3][2:] == (3, 3, 12, "apache-2,mit", "apache-2,mit", 1.0)
    assert got[4][1:] == got[5][1:] == (0, 0, None, None, "", "", 0.0)
    assert got[6] == got[7] == (7, 30_003, 1, 30_000, 30_000, "cc-by-nc", "cc-by-nc", 1.0)
    assert got[8][2:] == (0, None, None, "", "", 0.0)
    assert got[9][2:] == (0, None, None, "", "", 0.0)


def test_license_filters_lose_nothing(spark, sf):
    """Any threshold gives what a plain containment test of every line gives."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    templates = (("a", "the of and to in"), ("b", "licensed under the license"), ("c", "the"))
    for threshold in (Fraction(1, 2), Fraction(4, 5), Fraction(1)):
        got = {r.doc_id: r["labels"] for r in licenses.scan(docs, phrases={"zzz": "z"}, templates=templates, threshold=threshold).collect()}
        import re

        for r in docs.collect():
            lines = [set(re.findall(licenses.WORD, line)) for line in r.text.lower().split("\n")]
            met = {label for label, t in templates for line in lines if len(line & set(t.split())) >= threshold * len(set(t.split()))}
            assert got[r.doc_id] == ",".join(sorted(met)), r.doc_id


def event_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, seq long, kind string, role string, text string")


def turns(df):
    return {r.conv_id: [(m.role, m.text) for m in r.turns] for r in df.collect()}


def test_chat_fold(spark):
    log = [
        (1, 0, 1, "message", "user", "a"),
        (1, 0, 9, "delta", "user", "b"),
        (1, 1, 10, "message", "assistant", ""),
        (1, 1, 11, "delta", "assistant", "x"),
        (1, 1, 12, "delta", "assistant", "y"),
        (1, 2, 13, "message", "user", "later"),
        (1, 1, 14, "regenerate", "assistant", None),
        (1, 1, 15, "message", "assistant", "new"),
        (1, 3, 16, "message", "user", "kept"),
        (2, 0, 1, "message", None, None),
        (2, 0, 2, "edit", None, "edited"),
        (2, 1, 1, "delta", "user", "without a message"),
        (2, 2, 1, "strange", "user", "?"),
        (2, 3, 1, "message", "user", "t"),
        (2, 3, 1, "message", "user", "t"),
        (None, None, None, "message", "user", "n"),
    ]
    got = turns(chat.fold(event_rows(spark, log).repartition(3)))
    assert got[1] == [("user", "ab"), ("assistant", "new"), ("user", "kept")]
    assert got[2] == [("", "edited"), ("user", "t"), ("user", "t")]
    assert got[None] == [("user", "n")]


def plain_fold(log):
    """The rules of chat.fold, event by event."""
    rank = {k: i + 1 for i, k in enumerate(chat.KINDS)}
    first = lambda x: (x is not None, x or 0)
    found, cuts, opened = {}, {}, {}
    for conv, turn, seq, kind, role, text in sorted(log, key=lambda e: (first(e[2]), rank.get(e[3], 0), e[4] or "", e[5] or "")):
        messages = found.setdefault(conv, {}).setdefault(turn, [])
        if kind == "message":
            messages.append([role or "", text or ""])
            opened[conv, turn] = seq
        elif kind == "delta" and messages:
            messages[-1][1] += text or ""
        elif kind == "edit" and messages:
            messages[-1][1] = text or ""
        elif kind == "regenerate":
            messages.clear()
            cuts[conv, turn] = seq
    out = {}
    for conv, turns in found.items():
        out[conv], cut = [], None
        for turn in sorted(turns, key=first):
            if cut is None or (opened.get((conv, turn)) is not None and opened[conv, turn] > cut):
                out[conv] += [tuple(m) for m in turns[turn]]
            here = cuts.get((conv, turn))
            cut = here if cut is None else cut if here is None else max(cut, here)
    return out


def test_chat_fold_equals_a_plain_fold(spark):
    import random

    draw = random.Random(5)
    kinds = ["message"] * 4 + ["delta"] * 6 + ["edit", "regenerate", "odd"]
    log = [
        (draw.choice([None, *range(30)]), draw.choice([None, 0, 1, 2, 3]), draw.choice([None, *range(40)]), draw.choice(kinds),
         draw.choice(["user", "assistant", None]), draw.choice([None, "", "a", "b", "cd\n"]))
        for _ in range(3000)
    ]
    assert turns(chat.fold(event_rows(spark, log).repartition(7))) == plain_fold(log)
    assert chat.parse(chat.render(chat.fold(event_rows(spark, [])))).count() == 0


def test_chat_message_of_a_million_parts(spark):
    n = 1_000_000
    i = F.col("id")
    events = spark.range(n).select(
        F.lit(1).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), i.alias("seq"),
        F.when(i == 0, "message").when(i == 10, "edit").otherwise("delta").alias("kind"), F.lit("assistant").alias("role"),
        F.concat(i.cast("string"), F.lit("\n")).alias("text"),
    )
    row = chat.parse(chat.render(chat.fold(events))).select(F.sha2(F.element_at("losses", 1), 256).alias("a"), F.sha2(F.element_at("turns", 1)["text"], 256).alias("b")).first()
    want = hashlib.sha256("".join(f"{k}\n" for k in range(10, n)).encode()).hexdigest()
    assert row.a == row.b == want


def test_chat_query_on_a_long_message(spark, tmp_path):
    text = "<|end|> a line\n" * 100_000
    spark.createDataFrame([(1, 0, "user", "hi"), (1, 1, "assistant", text), (2, 0, None, None)], "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet")
    )
    got = {r.conv_id: r for r in queries.op2_chat(spark, str(tmp_path)).collect()}
    assert got[1].loss_sha256 == hashlib.sha256(text.encode()).hexdigest() and got[1].loss_chars == len(text)
    assert got[1].n_turns == 2 and got[2].n_turns == 1 and got[-7].n_turns == 2


def test_chat_round_trip(spark):
    texts = [
        "</s>[INST] ok [/INST]", "<|turn|><|end|>\n", "<\\|turn|>", "<<SYS>>\\<</SYS>>", "\\", "<", "", "a\n<|end|>\n<|turn|>user\n",
        "é🙂" * 5000, "[\\\\/INST]", "<|im_start|>", "$1 \\1 %0A %25",
    ]
    roles = ["user", "assistant", "a\nb%0A", "<|turn|>", ""]
    rows = [(k, i, 0, "message", roles[(i + k) % 5], t) for k in range(5) for i, t in enumerate(texts)]
    rendered = chat.render(chat.fold(event_rows(spark, rows)))
    read = {r.conv_id: r for r in chat.parse(rendered).collect()}
    formatted = {r.conv_id: r.formatted for r in rendered.collect()}
    for k in range(5):
        want = [(roles[(i + k) % 5], t) for i, t in enumerate(texts)]
        assert [(m.role, m.text) for m in read[k].turns] == want
        assert "".join(read[k].losses) == "".join(t for r, t in want if r == "assistant")
        assert formatted[k].count("<|turn|>") == formatted[k].count("<|end|>") == len(texts)
        assert "</s>" not in formatted[k] and "[/INST]" not in formatted[k] and "<<SYS>>" not in formatted[k]


def test_language_is_right_on_held_out_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    net = languages.fit(docs.where(fold != 0))
    held = docs.where(fold == 0).select("lang", languages.identify(F.col("text"), net).alias("a"))
    ok = [r.lang == r.a.lang for r in held.collect()]
    assert sum(ok) >= 0.9 * len(ok)
    again = languages.fit(docs.where(fold != 0).repartition(5))
    assert all((a == b).all() for a, b in zip(net.filters, again.filters, strict=True))
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "the and of"), (4, "the and of"), (5, "the of " * 50_000)], "i int, t string")
    got = {r.i: (r.a.lang, r.a.score) for r in odd.select("i", languages.identify(F.col("t"), net).alias("a")).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4][0] == got[5][0] == "en" and 0 < got[4][1] <= 1


def test_language_without_labels(spark):
    df = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert languages.fit(df) is None
    assert [r.a.lang for r in df.select(languages.identify(F.col("text"), None).alias("a")).collect()] == ["und", "und"]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""),
        ("", ""),
        ("no markup at all, only some words that stand here for a text of its own", "no markup at all, only some words that stand here for a text of its own"),
        ("<nav><a href=x>Home</a></nav><article><h1>T &amp; x</h1><p>one<p>a<b>b</b>\n c</article><footer>f</footer>", "T & x one ab c"),
        ("<article><p>x<script>var t='</p>';</script> y</p><div class='comments'><p>said</p></div></article>", "x y"),
        ("<div id=cookieNotice>We use them</div><main><p>body</p><form><p>name</p></form><aside>s</aside></main>", "body"),
        ("<article><header><h1>H</h1></header><p hidden>no</p><p>&lt;b&gt; &#233; &amp", "H <b> é &"),
        ("<ul><li><a href=1>one</a><li><a href=2>two</a><li><a href=3>three</a></ul>", ""),
        ("<article>" + "<p>w w</p>" * 20_000 + "</article>", " ".join(["w w"] * 20_000)),
    ],
)
def test_main_text(spark, html, text):
    row = spark.createDataFrame([(html,), (html,)], "html string").select(pages.main_text(F.col("html")).alias("m")).collect()
    assert [r.m.text for r in row] == [text, text]


def test_tree_answers_its_own_table():
    tree = pages.train()
    assert (tree.predict(pages.LABELLED[:, :-1].astype(float)) == pages.LABELLED[:, -1].astype(bool)).all()


def test_wrapped_license_headers(spark, tmp_path):
    """Headers as they are usually wrapped, with comment marks, far into a text; no label comes from words far apart."""
    headers = {
        "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files",
        "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that",
        "mpl-2": "# This Source Code Form is subject to the terms of the Mozilla Public\n# License, v. 2.0. If a copy of the MPL was not",
        "gpl-3": "GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007",
        "gpl-2": "the GNU General\r\n// Public License\r\n// version 2",
    }
    rows = [(label, f"{'word ' * n}\n{h}\n{'word ' * n}") for label, h in headers.items() for n in (0, 1, 7, 20, 33, 5000)]
    rows.append(("", "\n".join(["gnu general", *["word"] * 60, "public license version 3"])))
    got = licenses.scan(spark.createDataFrame(rows, "want string, text string"), window=licenses.WINDOW).collect()
    assert len(got) == len(rows) and all(r["labels"] == r.want for r in got)
    documents = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    documents.write.parquet(str(tmp_path / "documents.parquet"))
    found = queries.op1_licenses(spark, str(tmp_path))
    assert {r.doc_id: r["labels"] for r in found.collect()} == {i: w for i, (w, _) in enumerate(rows)}
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare.differences(found, duck, queries.ORACLES["op1_licenses"]) == []


LONG = " ".join(["long"] * 60)


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<div class='content has-sidebar'><p>short one</p><p>{LONG}</p></div>", f"short one {LONG}"),
        (f"<form id=aspnetForm><div class=newsletter><p>join us</p></div><div><p>{LONG}</p><p>{LONG}</p></div></form>", f"{LONG} {LONG}"),
        (f"<div class='sidebar layout'><ul><li><a href=1>one</a><li><a href=2>two</a></ul><article><h1>T</h1><p>a few words</p><p>{LONG}</p></article></div>", f"T a few words {LONG}"),
        (f"<div id=page-with-nav><div class=nav><p>{LONG}</p></div></div>", LONG),
        (f"<article><header class='entry-header'><h1>Title</h1></header><p>{LONG}</p></article>", f"Title {LONG}"),
        (f"<header class='entry-header'><h1>Title</h1></header><main><p>{LONG}</p></main>", f"Title {LONG}"),
        (f"<article><p>{LONG}</p><ul><li><a href=1>one two</a><li><a href=2>three</a><li><a href=3>four</a></ul></article>", LONG),
        (f"<article><p>{LONG}</p><div hidden><article><p>{LONG} no</p></article></div><div class=post-comments><p>said</p></div></article>", LONG),
    ],
)
def test_place_is_one_feature(html, text):
    found = pages.blocks(html)
    keep = pages.train().predict(pages.features(found))
    assert " ".join(b.text for b, k in zip(found, keep, strict=True) if k) == text


def words(n, word):
    return " ".join([word] * n)


ASIDES = (
    f"<div id=comments><p>{words(60, 'said')}</p><article><p>{words(70, 'replied')}</p></article></div>"
    f"<aside class=sidebar><p>{words(55, 'aside')}</p></aside><div class='cookie-notice'>{words(48, 'notice')}</div>"
    f"<div class=advert>{words(50, 'buy')}</div><form><p>{words(50, 'field')}</p></form><footer>{words(80, 'foot')}</footer>"
)
STORY = f"<h1>T</h1><p>{words(60, 'told')}</p><p>Yes.</p><p>{words(40, 'more')}</p>"
STORY_TEXT = f"T {words(60, 'told')} Yes. {words(40, 'more')}"


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (f"<article>{STORY}</article>{ASIDES}", STORY_TEXT),
        (f"{ASIDES}<main>{STORY}</main>", STORY_TEXT),
        (f"<article>{STORY}{ASIDES}</article>", STORY_TEXT),
        (f"<div class=x>{STORY}</div>{ASIDES}", STORY_TEXT),
        (f"<article><p>Sold out.</p></article>{ASIDES}", "Sold out."),
        (f"<form id=f><article>{STORY}</article><div class=comments>{words(90, 'said')}</div></form>", STORY_TEXT),
        (f"<body><h1>T</h1><h2>Why</h2><p>a short one</p><p>Yes.</p><ul><li>one<li>two things</ul>{ASIDES}", "T Why a short one Yes. one two things"),
        (f"<div><h2>Head</h2></div><div><p>{LONG}</p></div><div>Yes</div><div><p>{LONG}</p></div><div>Share this</div>", f"Head {LONG} Yes {LONG}"),
        ("<p>Hello world</p>", "Hello world"),
        ("<nav><a href=1>Home</a></nav><footer>Imprint</footer>", ""),
    ],
)
def test_long_side_parts_go_where_the_page_has_text(html, text):
    found = pages.blocks(html)
    keep = pages.train().predict(pages.features(found))
    assert " ".join(b.text for b, k in zip(found, keep, strict=True) if k) == text


def test_tree_equals_its_rules_read_row_by_row(spark, sf):
    """A plain walk through the tree and plain features, block by block, over all pages."""
    tree = pages.train()

    def answer(html):
        found = pages.blocks(html)
        plain = [b.words - b.linked for b in found]
        clear = sum(n for b, n in zip(found, plain, strict=True) if b.place < 2)
        main = sum(n for b, n in zip(found, plain, strict=True) if b.place == 1 and not b.alone)
        kept = []
        for i, b in enumerate(found):
            size = lambda j: (found[j].words, 100 * found[j].linked / found[j].words) if 0 <= j < len(found) else (0, 0)
            held = sum(n for c, n in zip(found, plain, strict=True) if c.part == b.part and c.place < 2)
            x = [*size(i), *size(i - 1), *size(i + 1), min(b.place, 3), 100 * held / max(clear, 1), clear, 100 * main / max(sum(plain), 1)]
            at = 0
            while tree.feature[at] >= 0:
                at = tree.low[at] if x[tree.feature[at]] <= tree.limit[at] else tree.high[at]
            if tree.low[at]:
                kept.append(b.text)
        return " ".join(kept)

    want = {r.page_id: answer(r.html or "") for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in queries.op4_main_text(spark, sf).collect()}
    assert got == {i: (t, len(t)) for i, t in want.items()}
