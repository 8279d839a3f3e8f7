"""SentencePiece codec and token counts against the sentencepiece library, and the pipeline against a plain version."""

import base64
import random
from pathlib import Path

import brute
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from driftloom.llm import minmax, pieces, queries, sp_model, suffixes, token_counts
from driftloom.llm.common import Steps

DATA = queries.tokenizer_file(queries.PIECES)
R = random.Random(6)
TEXTS = [
    None, "", " ", "  ", "\n", " \n ", "\n\n a", "a  b   c ", "日本語テキスト🙂🙂", "<s> </s> <unk> <0x41>", "aaaa" * 40, "\x00\x01", "a\r\n\tb",
    "x▁y z", "▁ ▁", "word " * 3000, "日本" * 2000, "q" * 5000, "".join(R.choice("abc  \n.é漢") for _ in range(9000)),
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=DATA)


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(i, t, "mine") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, rows[5]], "doc_id long, text string, n_tokens string")


def test_model_file(library):
    model = sp_model.parse(DATA)
    assert [p for p, _, _ in model.pieces] == [library.id_to_piece(i) for i in range(library.get_piece_size())]
    assert model.kind == sp_model.BPE and model.byte_fallback and model.plain and model.unknown == library.unk_id()


def test_ids_and_texts(texts, library):
    got = texts.select("doc_id", pieces.encode(F.col("text"), DATA).alias("c")).collect()
    for r in got:
        text = TEXTS[r.doc_id] or ""
        assert r.c.ids == library.encode(text) and r.c.n_tokens == len(r.c.ids)
        assert r.c.parity
        assert r.c.round_trip == ("▁" not in text)
    back = texts.select("doc_id", pieces.decode(pieces.encode(F.col("text"), DATA)["ids"], DATA).alias("t")).collect()
    assert all(r.t == library.decode(library.encode(TEXTS[r.doc_id] or "")) for r in back)


def test_whole_text_backend(library):
    """The rebuilt tokenizer with its own normaliser and decoder agrees on whole texts."""
    made = pieces.backend(sp_model.parse(DATA))
    for t in TEXTS[1:]:
        ids = made.encode(t, add_special_tokens=False).ids
        assert ids == library.encode(t)
        assert made.decode(ids) == library.decode(ids)


def test_unigram_models():
    """Scores, mark and byte fallback of a unigram model written by hand."""
    import struct

    import sentencepiece

    def field(number, value):
        def varint(n):
            out = b""
            while n > 127:
                out, n = out + bytes([n & 127 | 128]), n >> 7
            return out + bytes([n])

        if isinstance(value, bytes):
            return varint(number << 3 | 2) + varint(len(value)) + value
        if isinstance(value, float):
            return varint(number << 3 | 5) + struct.pack("<f", value)
        return varint(number << 3) + varint(value)

    table = [("<unk>", 0.0, 2), *[(f"<0x{b:02X}>", 0.0, 6) for b in range(256)]]
    table += [("▁", -3.0, 1), ("a", -4.0, 1), ("b", -4.1, 1), ("ab", -5.0, 1), ("▁a", -4.5, 1), ("ba", -5.2, 1), ("▁ab", -9.9, 1)]
    data = b"".join(field(1, field(1, t.encode()) + field(2, s) + field(3, k)) for t, s, k in table)
    data += field(2, field(3, 1) + field(35, 1) + field(40, 0)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = pieces.Codec(data)
    texts = ["abab ba", "ab a b", "é ab", "a", ""]
    ids, agree = codec.encode(texts)
    assert [i.tolist() for i in ids] == [library.encode(t) for t in texts] and all(agree)
    assert [codec.decode(i) for i in ids] == texts


@pytest.mark.parametrize("how", [token_counts.Chunking(), token_counts.Chunking(1000, 16, 4)])
def test_token_counts(texts, library, how):
    got = token_counts.count_tokens(texts, DATA, how=how)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens"]
    rows = [(r.doc_id, r.n_bytes, r.n_tokens) for r in got.orderBy("doc_id").collect()]
    want = sorted([*range(len(TEXTS)), 5])
    assert rows == [(i, len((TEXTS[i] or "").encode()), len(library.encode(TEXTS[i] or ""))) for i in want]


def test_marks_in_chunked_texts(spark, library):
    """Literal U+2581 before, in and after the overlaps of short words: every seam is spliced at its own bytes."""
    r = random.Random(12)
    words = ["a", "I", "to", "of", "the", "x▁y", "▁", "▁▃▁", "on"]
    texts = [" ".join(r.choices(words, [9, 9, 9, 9, 9, k, k, k, 9], k=900)) for k in (0.02, 0.02, 0.1, 0.5, 5) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for how in (token_counts.Chunking(1000, 16, 4), token_counts.Chunking(500, 64, 8)):
        got = {x.doc_id: x.n_tokens for x in token_counts.count_tokens(df, DATA, how=how).collect()}
        assert got == {i: len(library.encode(t)) for i, t in enumerate(texts)}


def test_token_query(spark, sf, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op7_token_counts(spark, sf).collect():
        assert r.n_tokens == len(library.encode(docs[r.doc_id])) and r.over_limit == (r.n_tokens > 4096)


def corpus():
    r = random.Random(9)
    noise = lambda n: " ".join("".join(r.choice("etaoinshr") for _ in range(r.randint(2, 8))) for _ in range(n))
    passage = noise(90)
    item = noise(25)
    one = noise(150)
    rows = [(1, one), (2, one), (2, one), (3, one + " tail"), (4, noise(60) + " " + passage + " " + noise(40)), (5, noise(70) + " " + passage)]
    rows += [(6, noise(30) + " " + item + " " + noise(5)), (7, None), (8, ""), (9, "123 456"), (10, noise(20_000)), (None, noise(50)), (11, noise(40))]
    return rows, [(0, item), (1, None)]


def test_pipeline_against_a_plain_version(spark, tmp_path, library):
    rows, bench = corpus()
    table = [(i, t, "en" if n % 2 else "xx", "s", len(t or ""), n) for n, (i, t) in enumerate(rows)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long, spans int")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}

    lettered = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    numbered = dict(enumerate(lettered))
    near = brute.near({n: t for n, (_, t) in numbered.items()})
    kept = [numbered[n] for n, (_, _, first) in near.items() if first]
    assert [i for i, _ in kept] == [1, 4, 5, 6, 10, None, 11]
    cut = []
    for (i, t), (_, _, _, sha) in zip(kept, brute.repeats([t for _, t in kept], 400), strict=True):
        cut.append((i, t, sha))
    assert set(got) == {i for i, _, _ in cut if i != 6}
    import hashlib

    for i, _, sha in cut:
        if i != 6:
            r = got[i]
            assert hashlib.sha256(r.text.encode()).hexdigest() == sha  # ASCII texts: no character is cut in two
            assert r.token_ids == library.encode(r.text) and r.n_tokens == len(r.token_ids) and r.round_trip
            assert r.n_chars == len(r.text)
    assert {r.spans for r in got.values()} <= set(range(len(rows)))


def test_unlearned_languages_go(spark, sf):
    """Texts in other scripts and encoded noise go, all clean documents stay; labels are those of the four languages."""
    r = random.Random(13)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    odd = ["Это письмо написано на русском языке и здесь не выучено", "這是一篇中文文章，從來沒有學過這種語言", "これは日本語の文章です。学んでいません。"]
    odd += [base64.b64encode(r.randbytes(n)).decode() for n in (60, 600, 60_000)] + [r.randbytes(n).hex() for n in (60, 600, 60_000)]
    more = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(odd)], docs.schema)
    got = {x.doc_id for x in corpus_pipeline.language(spark, docs.unionByName(more), sf).select("doc_id").collect()}
    clean = {x.doc_id for x in docs.where(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}
    assert got == clean


def test_near_duplicates_with_other_splits_at_every_scan(spark, tmp_path, monkeypatch):
    """Executors come and go: files are packed into other partitions between the jobs, so a scan numbers its rows anew."""
    r = random.Random(14)
    texts = [" ".join(f"w{r.randrange(10**6)}" for _ in range(60)) for _ in range(40)]
    rows = [(i, texts[i % 40] + (" more" if i >= 40 else "")) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(12).write.parquet(str(tmp_path / "d"))
    docs = spark.read.parquet(str(tmp_path / "d"))
    real, splits = minmax.near_duplicates, []

    def moved(*args, **more):
        judged = Steps(spark).keep(real(*args, **more))
        before = docs.rdd.getNumPartitions()
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        splits.append((before, spark.read.parquet(str(tmp_path / "d")).rdd.getNumPartitions()))
        return judged

    monkeypatch.setattr(minmax, "near_duplicates", moved)
    try:
        got = {x.doc_id for x in corpus_pipeline.near_duplicates(spark, docs, "").select("doc_id").collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert splits[0][0] != splits[0][1] and got == set(range(40))


def test_stages_keep_the_columns(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
        out.write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
    assert 0 < docs.count()


def test_pipeline_texts_hold_no_repeat(spark, sf):
    rows = corpus_pipeline.run(spark, sf).select("doc_id", "text")
    left = suffixes.repeated_spans(rows).where(F.size("spans") > 0).count()
    assert left <= rows.count() // 50  # only strings that meet newly where something was cut out between them
    assert Path(corpus_pipeline.__file__).name == "corpus_pipeline.py"


def test_parts_after_line_breaks_are_checked_together():
    """One call of the sentencepiece library for all parts of a batch, whatever they begin with; the ids stay the library's."""
    codec = pieces.Codec(DATA)
    library, calls = codec.reference, []

    class Spy:
        def encode(self, *given, **how):
            calls.append(given)
            return library.encode(*given, **how)

    codec.reference = Spy()
    text = "\n".join(f"w{i} and x{i}\n\n" for i in range(500)) + " \n  a"
    ids, agree = codec.encode([text, " ", "\n", None])
    assert [i.tolist() for i in ids] == [library.encode(t) for t in (text, " ", "\n", "")] and all(agree)
    assert len(calls) <= 2
