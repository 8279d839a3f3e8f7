"""The registered queries of the operators of this folder, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from driftloom.llm import (
    chat,
    decontaminate,
    divergence,
    epsilon_grid,
    languages,
    licenses,
    minmax,
    pages,
    pieces,
    spellings,
    suffixes,
    token_counts,
    topk,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NEAR_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g
  FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT u, v FROM shared JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, l.v FROM reach r JOIN links l ON r.other = l.u
)
SELECT r.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id
"""


@query(NEAR_SQL)
def op9_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, sf, "documents"))


@query()
def op10_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    net = languages.fit(docs.where(fold != 0))
    answer = languages.identify(F.col("text"), net)
    rows = docs.select("doc_id", F.coalesce(fold == 0, F.lit(False)).alias("held_out"), answer.alias("a"))
    return rows.select("doc_id", "held_out", F.col("a.lang").alias("lang_pred"), F.col("a.score").alias("score"))


def _license_sql() -> str:
    """Blocks are lines, and word windows of texts with line breaks; places are looked for in the words of the whole text."""
    listed = lambda xs: "[" + ", ".join(f"'{x}'" for x in xs) + "]"
    places = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        same = " AND ".join(f"w[i + {k + 1}] = '{p}'" for k, p in enumerate(parts))
        places.append(
            f"list_transform(list_filter(range(0, len(w) - {len(parts) - 1}), lambda i: {same}), lambda i: {{'at': i, 'label': '{label}'}})"
        )
    notices = ", ".join(
        f"('{label}', {listed(sorted(set(t.split())))}, {licenses.need(len(set(t.split())), licenses.THRESHOLD)})"
        for label, t in licenses.TEMPLATES
    )
    return rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, doc_id, {LOWERED} AS t FROM documents
), words AS (
  SELECT id, doc_id, t, regexp_extract_all(t, '{licenses.WORD}') AS w FROM docs
), placed AS (
  SELECT id, doc_id, len(w)::BIGINT AS n_words, list_concat({places[0]}, list_concat({places[1]}, {places[2]})) AS p FROM words
), lines AS (
  SELECT id, regexp_extract_all(line, '{licenses.WORD}') AS w
  FROM (SELECT id, unnest(string_split(t, chr(10))) AS line FROM docs)
  UNION ALL
  SELECT id, unnest(list_transform(range(1, len(w) + 1, {max(1, licenses.WINDOW // 4)}), lambda i: w[i:i + {licenses.WINDOW - 1}])) AS w
  FROM words WHERE contains(t, chr(10))
), notices(label, words, must) AS (VALUES {notices}),
met AS (
  SELECT id, label, len(list_intersect(words, w)) / len(words) AS share
  FROM lines, notices WHERE len(list_intersect(words, w)) >= must
), found AS (
  SELECT id, list(label) AS labels, max(share) AS share FROM met GROUP BY id
)
SELECT doc_id, n_words, len(p)::BIGINT AS n_base,
  list_min(list_transform(p, lambda x: x.at))::BIGINT AS first_word,
  list_max(list_transform(p, lambda x: x.at))::BIGINT AS last_word,
  array_to_string(list_sort(list_distinct(list_transform(p, lambda x: x.label))), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(list_transform(p, lambda x: x.label), coalesce(labels, [])))), ',') AS labels,
  CASE WHEN len(p) > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM placed LEFT JOIN found USING (id)
"""


@query(_license_sql())
def op1_licenses(spark: SparkSession, sf: str) -> DataFrame:
    found = licenses.scan(table(spark, sf, "documents").select("doc_id", "text"), window=licenses.WINDOW)
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


_CONTROL_OUT = rf"regexp_replace(text, '{chat.CONTROL}', '\1\\\2\3', 'g')"
CHAT_SQL = rf"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), said AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS flat,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(17 + length(role) + length({_CONTROL_OUT}))::BIGINT AS formatted_chars
  FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(flat) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM said
"""


@query(CHAT_SQL)
def op2_chat(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    # a streamed log: every message is opened empty and filled line by line; rows of one turn follow one another
    row = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.unionByName(own).groupBy("conv_id", "turn").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    rows = rows.select("conv_id", "turn", F.posexplode("rows").alias("nth", "row"))
    parts = F.concat(F.array(F.lit("")), F.split("row.text", r"(?<=\n)"))
    events = rows.select("conv_id", "turn", "nth", F.col("row.role").alias("role"), F.posexplode(parts).alias("at", "text"))
    kind = F.when(F.col("at") == 0, "message").otherwise("delta")
    seq = F.col("nth").cast("long") * 2**31 + F.col("at")
    read = chat.parse(chat.render(chat.fold(events.select("conv_id", "turn", seq.alias("seq"), kind.alias("kind"), "role", "text"))))
    flat = F.array_join(F.transform("turns", lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), "")
    loss = F.array_join("losses", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(flat, 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def tokenizer_file(name: str) -> bytes:
    """Bytes of a vocabulary file of the installed public tokenizers, read on the driver and sent with the tasks."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as file:
        return file.read()


PIECES = "piece_bpe_32k.model"


@query()
def op6_pieces(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    coded = docs.select("doc_id", pieces.encode(F.col("text"), tokenizer_file(PIECES), with_ids=False).alias("c"))
    return coded.select("doc_id", "c.n_tokens", "c.ids_sha256", "c.parity", "c.round_trip")


@query()
def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, tokenizer_file(PIECES))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


@query()
def op4_main_text(spark: SparkSession, sf: str) -> DataFrame:
    read = table(spark, sf, "pages").select("page_id", "url", pages.main_text(F.col("html")).alias("m"))
    return read.select("page_id", "url", F.col("m.text").alias("text"), F.char_length("m.text").cast("long").alias("n_chars"))


VECTOR_SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), counted AS (SELECT u, count(*) AS n FROM links GROUP BY u),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.v FROM reach r JOIN links l ON r.other = l.u
)
SELECT r.vec_id, coalesce(any_value(c.n), 0)::BIGINT AS n_links, min(r.other) AS component_id, r.vec_id = min(r.other) AS kept
FROM reach r LEFT JOIN counted c ON c.u = r.vec_id GROUP BY r.vec_id
"""


@query(VECTOR_SQL)
def op5_epsilon_grid(spark: SparkSession, sf: str) -> DataFrame:
    return epsilon_grid.near_duplicates(table(spark, sf, "embeddings"))


_SHINGLES = (
    "list_transform(range(1, len(w) - least(5, {length}) + 2), lambda i: array_to_string(w[i:i + least(5, {length}) - 1], ' '))"
)
LEAK_SQL = rf"""
WITH items AS (
  SELECT item_id, w, len(w) AS length, {_SHINGLES.format(length="len(w)")} AS g
  FROM (SELECT item_id, regexp_extract_all({LOWERED}, '{licenses.WORD}') AS w FROM benchmark) WHERE len(w) > 0
), item_grams AS (
  SELECT item_id, length, unnest(g) AS gram, unnest(range(0, len(g))) AS pos FROM items
), docs AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{licenses.WORD}') AS w FROM documents
), doc_grams AS (
  SELECT doc_id, n, unnest(g) AS gram, unnest(range(0, len(g))) AS place
  FROM (SELECT doc_id, len(w) AS n, {_SHINGLES.format(length="5")} AS g FROM docs)
  UNION ALL SELECT doc_id, n, unnest(g), unnest(range(0, len(g)))
  FROM (SELECT doc_id, len(w) AS n, length, {_SHINGLES.format(length="length")} AS g
    FROM docs, (SELECT DISTINCT length FROM items WHERE length < 5))
), spots AS (
  SELECT DISTINCT doc_id, length, least(greatest(place - pos, 0), greatest(n - length, 0)) AS start
  FROM doc_grams JOIN item_grams USING (gram)
), windows AS (
  SELECT doc_id, length, start, {_SHINGLES.format(length="length")} AS g
  FROM (SELECT s.doc_id, length, start, w[start + 1:start + length] AS w FROM spots s JOIN docs USING (doc_id))
), pairs AS (
  SELECT doc_id, item_id, start, len(v.g) AS nw, len(i.g) AS ni,
    list_sum(list_transform(list_distinct(v.g), lambda x: least(len(list_filter(v.g, lambda y: y = x)), len(list_filter(i.g, lambda y: y = x))))) AS shared
  FROM windows v JOIN items i USING (length)
), sure AS (
  SELECT doc_id, item_id, start, (shared / (nw + ni - shared))::DOUBLE AS similarity FROM pairs WHERE shared >= 0.75 * (nw + ni - shared)
)
SELECT doc_id, item_id, max(similarity) AS similarity, arg_min(start, struct_pack(a := -similarity, b := start))::BIGINT AS first_word
FROM sure GROUP BY doc_id, item_id
"""


@query(LEAK_SQL)
def op3_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "similarity", "first_word")


@query()
def op8_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    spans = suffixes.repeated_spans(table(spark, sf, "documents").select("doc_id", "text"))
    cut = spans.select("doc_id", suffixes.cut_out(F.col("text"), F.col("spans")).alias("c"))
    return cut.select("doc_id", "c.n_bytes", "c.n_removed", "c.n_spans", "c.kept_sha256", F.col("c.kept").alias("text"))


TOP_SQL = """
WITH good AS (
  SELECT row_number() OVER () AS id, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.id, q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
  FROM good q JOIN good d ON q.id <> d.id AND len(q.v) = len(d.v) WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query(TOP_SQL)
def op11_topk(spark: SparkSession, sf: str) -> DataFrame:
    return topk.top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


DIVERGENCE_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({LOWERED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), words AS (SELECT id, lang, source, unnest(w) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS n FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 10
), names AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT lang, count(*) AS v, sum(n)::BIGINT AS total FROM kept GROUP BY lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
sums AS (SELECT lang, source, sum(n)::BIGINT AS total FROM counts GROUP BY ALL),
shares AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n, k.n AS of_lang,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(s.total, 0) + 2 * z.v) AS p,
    1 + (1000000000::HUGEINT * (k.n + 2)) // (z.total + 2 * z.v) AS q
  FROM names JOIN kept k USING (lang) JOIN sizes z USING (lang)
    LEFT JOIN counts c USING (lang, source, term) LEFT JOIN sums s USING (lang, source)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), both_parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM names a JOIN names b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM both_parts
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@query(DIVERGENCE_SQL)
def op12_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.audit(table(spark, sf, "documents"))


SPELLING_SQL = r"""
WITH RECURSIVE bits(n, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT n, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8
), crc AS (SELECT list(c ORDER BY n) AS t FROM bits WHERE k = 8),
found AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w
    FROM documents) WHERE length(w) >= 7 GROUP BY ALL
), hashed AS (
  SELECT w, n, xor(list_reduce(
      list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || w, ''),
        lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT] ELSE [195::BIGINT, unicode(ch) - 64] END))),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM found, crc
), slipped AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(w, (h % length(w))::INTEGER) || substr(w, (h % length(w))::INTEGER + 2) ELSE w END AS word, n FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2
), dropped AS (
  SELECT DISTINCT word, n, i, left(word, i::INTEGER) || substr(word, i::INTEGER + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n FROM dropped a JOIN dropped b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM dropped d JOIN words w ON d.rest = w.word
  UNION SELECT w.word, d.word, d.n FROM dropped d JOIN words w ON d.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, max(n) AS most, arg_min(other, struct_pack(a := -n, b := other)) AS form FROM near GROUP BY word
), told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 10 * w.n THEN form END AS form,
    CASE WHEN most >= 10 * w.n THEN most END AS form_n
  FROM words w LEFT JOIN best USING (word)
), way(word, goal) AS (
  SELECT word, word FROM told UNION ALL SELECT y.word, t.form FROM way y JOIN told t ON t.word = y.goal WHERE t.form IS NOT NULL
)
SELECT t.word, t.form, y.goal AS root, t.n, t.n_near, t.form_n
FROM told t JOIN way y USING (word) JOIN told e ON e.word = y.goal WHERE e.form IS NULL
"""


@query(SPELLING_SQL)
def op13_spellings(spark: SparkSession, sf: str) -> DataFrame:
    return spellings.group(table(spark, sf, "documents"))


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)
