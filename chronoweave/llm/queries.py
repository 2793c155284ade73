"""The registered queries of this subpackage: thin applications of its operators to the shared tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import fingerprints, language_id, mixing, oracles, secrets_scan, warc
from chronoweave.llm.near_dedup import near_dedup
from chronoweave.llm.packing import pack_pieces
from chronoweave.llm.quality_rules import quality_rules
from chronoweave.llm.substring_dedup import substring_dedup
from chronoweave.llm.suffix_dedup import suffix_dedup
from chronoweave.llm.tokens import pieces_of


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark, _table(spark, sf_dir, "pages"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_pieces(pieces_of(_table(spark, sf_dir, "documents")), ["doc_id", "piece", "ids_crc32"])


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    profiles = language_id.fit(docs.filter(~_held_out()))
    return language_id.predict(docs, profiles).select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = secrets_scan.train(secrets_scan.labelled_findings(spark))
    return secrets_scan.findings(_table(spark, sf_dir, "documents"), model)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(_table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.copies_of(_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_language_id": op4_language_id,
    "op5_near_dedup": op5_near_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_fingerprints": op7_fingerprints,
    "op8_mixing": op8_mixing,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_quality_rules": op10_quality_rules,
}

#: The others have a trained model, a public tokenizer, or hashes that SQL lacks; tests hold them against brute force.
ORACLE_SQL: dict[str, str] = {
    "op1_warc": oracles.WARC_SQL,
    "op2_suffix_dedup": oracles.SUFFIX_SQL,
    "op5_near_dedup": oracles.NEAR_SQL,
    "op8_mixing": mixing.MIX_SQL,
    "op9_substring_dedup": oracles.SUBSTRING_SQL,
}
