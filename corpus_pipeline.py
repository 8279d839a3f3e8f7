"""Corpus pipeline over the table `documents`: five stages, each stored as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of docs. Null and
empty texts have no letter and go in the first stage; empty tables stay empty. The stages keep columns they don't know.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftloom.llm import decontaminate, languages, minmax, pieces, suffixes
from driftloom.llm.common import Steps, maybe_broadcast

# A document is in no learned language if more of its byte pairs than this were not learned: a few that any text may have, and
# of its pairs TIMES the share that all but 1% of the held-out labelled texts stay under, within bounds.
FEW, TIMES, LEAST_SHARE, MOST_SHARE = 8, 4, 0.1, 0.3
PIECES = "piece_bpe_32k.model"


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that was learned, go. The network learns from labelled rows of docs.

    What was not learned shows by its byte pairs: other scripts, base64, hex. The limit follows from labelled texts that the network
    did not see. A language that was not learned but is written with the same pairs stays; the probabilities cannot tell it,
    as the largest of k is 1/k at least.
    """
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    net = languages.fit(docs.where(fold != 0))
    letter = F.col("text").rlike(r"\p{L}")
    if net is None:
        return docs.where(letter)  # nothing to learn from: only texts without a letter go
    judged = docs.withColumn("__answer", languages.identify(F.col("text"), net)).withColumn("__odd", languages.strange(F.col("text"), net))
    held = docs.where((fold == 0) & F.col("lang").isNotNull() & letter).select(languages.strange(F.col("text"), net).alias("odd"))
    share = F.col("odd.unseen") / F.greatest(F.col("odd.pairs"), F.lit(1))
    usual = held.agg(F.percentile_approx(share, 0.99, 10_000)).first()[0] or 0.0
    limit = min(max(TIMES * usual, LEAST_SHARE), MOST_SHARE)
    good = (F.col("__answer.lang") != languages.UNDETERMINED) & (F.col("__odd.unseen") <= FEW + limit * F.col("__odd.pairs"))
    return judged.where(good).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest doc_id, the first row among equal ones.

    Rows that share a doc_id are documents of their own; one without doc_id only stays if no other of its group has one.
    """
    number = F.struct(F.col("doc_id").isNull().alias("a"), F.col("doc_id").alias("b"), F.monotonically_increasing_id().alias("c"))
    # stored with its numbers: a later scan may be split in another way
    keyed = Steps(spark).keep(docs.withColumn("__key", number))
    judged = minmax.near_duplicates(keyed.select("__key", "text"), "__key")
    gone = maybe_broadcast(Steps(spark).keep(judged.where(~F.col("kept")).select(F.col("__key").alias("__gone"))))
    return keyed.join(gone, F.col("__key").eqNullSafe(F.col("__gone")), "left_anti").select(*docs.columns)


def repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte strings of 400 that stand in two places are cut out of the texts; n_chars follows. No document is dropped."""
    found = suffixes.repeated_spans(docs.withColumnRenamed("spans", "__spans"))
    cut = F.when(F.size("spans") > 0, suffixes.cut_out(F.col("text"), F.col("spans"))["kept"]).otherwise(F.col("text"))
    changed = found.withColumn("text", cut)
    if "n_chars" in docs.columns:
        size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.size("spans") > 0, size).otherwise(F.col("n_chars")))
    changed = changed.drop("spans").withColumnRenamed("__spans", "spans")
    return changed.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the table `benchmark` go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark).select(*docs.columns)


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """docs with token_ids, n_tokens and round_trip (the decoded ids are the text); columns with these names are replaced."""
    import public_tokenizers

    with open(public_tokenizers.path(PIECES), "rb") as file:
        data = file.read()
    new = ("token_ids", "n_tokens", "round_trip")
    others = [c for c in docs.columns if c not in new]
    coded = docs.withColumn("__coded", pieces.encode(F.col("text"), data))
    return coded.select(*others, *[F.col(f"__coded.{a}").alias(b) for a, b in zip(("ids", "n_tokens", "round_trip"), new, strict=True)])


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_strings", repeated_strings),
    ("decontamination", decontamination),
    ("sentence_pieces", sentence_pieces),
]
# Hashed bands, suffix orders and a trained network are not SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to the table `documents`, each stored in the durable folder; the stage before is then removed."""
    steps = Steps(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stored = None
    for _, stage in STAGES:
        after = steps.keep(stage(spark, docs, sf_dir))
        if stored is not None:
            steps.drop(stored)
        docs = stored = after
    return docs
