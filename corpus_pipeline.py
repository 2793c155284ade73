"""The corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and works on all rows that the stage before it kept; each result is written as
Parquet and read again as the next stage's docs. All but the last return the columns of ``documents``; columns that a
stage doesn't know pass through it, whatever their names: columns that a stage adds for itself take names that are free.
Null and empty texts are rejected by the first stage; an empty table gives an empty result at every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import language_id, mixing, secrets_scan
from chronoweave.llm.keyed import NO_ID
from chronoweave.llm.near_dedup import near_dedup
from chronoweave.llm.packing import pack_pieces
from chronoweave.llm.store import settle
from chronoweave.llm.tokens import pieces_of

#: A document whose nearest language is this far out of place, or that has no letter, is rejected.
LEAST_SCORE = 0.2

#: Documents that are alike to this per cent or more are near copies; op5 alone asks for 85.
ALIKE = 80


def _fresh(docs: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until no column of the documents has one of them."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents in no known language; ``lang`` becomes the language found.

    Profiles are learned from the rows that name a language. A text without letters, empty or null goes.
    """
    lang, score = _fresh(docs, "_lang_pred", "_lang_score")
    said = language_id.annotate(docs, language_id.fit(docs), names=(lang, score))
    return said.filter((F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).withColumn("lang", F.col(lang)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each component, and one row of those that repeat id and text.

    Documents are linked from ``ALIKE`` per cent on.
    """
    did, k1 = _fresh(docs, "_did", "_k1")
    kept = near_dedup(docs, threshold=ALIKE).filter("kept").select(F.col("did").alias(did), F.col("k1").alias(k1)).distinct()
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    ident = F.col("doc_id").cast("long")
    keyed = docs.withColumns({did: F.coalesce(ident, F.lit(NO_ID)), k1: F.xxhash64(ident, text)})
    # A component's smallest id may stand in several rows with different texts; they are kept if each speaks for it.
    return keyed.join(kept, [did, k1], "left_semi").dropDuplicates([did, k1]).select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in place of every secret; ``n_chars`` follows the text."""
    model = secrets_scan.train(secrets_scan.labelled_findings(spark))
    clean = secrets_scan.redacted(docs, model)
    return (clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Emits each document as often as the mix takes it: never, once or twice.

    Rows alike in id, text and source are one to the mix, known by 128 bits of hash; their copies are emitted from one of them.
    """
    row, more, copies, copy = _fresh(docs, "_row", "_more", "_copies", "_copy")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    same = [F.col("doc_id").cast("long"), text, F.col("source"), F.col("source").isNull()]
    keyed = docs.withColumns({row: F.xxhash64(*same), more: F.xxhash64(F.lit(1), *same)})
    slim = keyed.select("doc_id", "text", "source", F.col(row).alias("row"), F.col(more).alias("more"))
    taken = mixing.copies_of(slim, extra=("row", "more")).groupBy(F.col("row").alias(row), F.col("more").alias(more)).agg(F.sum("copies").cast("int").alias(copies))
    joined = keyed.dropDuplicates([row, more]).join(taken, [row, more])
    return joined.withColumn(copy, F.explode(F.array_repeat(F.lit(1), F.col(copies)))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack_pieces(pieces_of(docs), ["doc_id", "piece", "ids_crc32"])


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("secret_scan", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: SQL can't express rank-order profiles, a trained forest or the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``; each stage but the last is written in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
