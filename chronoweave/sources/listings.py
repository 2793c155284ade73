"""Listings: delimited files, registry notices and web captures, with what doesn't fit kept beside the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_listing(spark: SparkSession, path: str, schema: T.StructType, key: str, pattern: str = r"^[0-9]{10}$") -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): malformed lines and keys are rejected as they stand, never padded or repaired; repeated keys keep the first line."""
    whole = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    lines = spark.read.schema(whole).options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord="_corrupt").csv(path)
    good = F.col("_corrupt").isNull() & F.coalesce(F.col(key).rlike(pattern), F.lit(False))
    rows = lines.withColumn("_line", F.monotonically_increasing_id())
    kept = rows.filter(good)
    first = kept.groupBy(key).agg(F.min("_line").alias("_line"))
    return kept.join(first, [key, "_line"], "left_semi").drop("_corrupt", "_line"), rows.filter(~good).select("_line", F.col(key), "_corrupt")


def notices(df: DataFrame, raw: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(parsed, rejects) of JSON texts under a schema; a text of another shape is rejected whole."""
    parsed = df.withColumn("notice", F.from_json(raw, schema, {"mode": "PERMISSIVE"}))
    known = F.col("notice").isNotNull() & F.exists(F.array(F.to_json("notice")), lambda j: j != "{}")
    return parsed.filter(known).select(*[c for c in df.columns if c != raw], "notice.*"), parsed.filter(~F.coalesce(known, F.lit(False))).drop("notice")


def classified(notice: DataFrame, chapter: str, terms: str, rules: list[tuple[str, str, list[str], list[str], list[str]]]) -> DataFrame:
    """Adds ``kind``, the first rule that fits: (kind, chapter, all terms, any terms, no terms)."""
    has = lambda t: F.array_contains(F.col(terms), t)
    out: Column = F.lit(None).cast("string")
    for kind, of, every, some, none in reversed(rules):
        test = F.col(chapter) == of
        for t in every:
            test = test & has(t)
        for t in none:
            test = test & ~has(t)
        if some:
            either = has(some[0])
            for t in some[1:]:
                either = either | has(t)
            test = test & either
        out = F.when(test, kind).otherwise(out)
    return notice.withColumn("kind", out)


def har_entries(spark: SparkSession, path: str) -> DataFrame:
    """(url, status, started, mime, body) of the exchanges in web captures; bodies in base64 are decoded."""
    schema = "log struct<entries: array<struct<startedDateTime: string, request: struct<url: string, method: string>, response: struct<status: int, content: struct<mimeType: string, text: string, encoding: string>>>>>"
    each = spark.read.schema(schema).json(path, multiLine=True).select(F.explode("log.entries").alias("e"))
    content = F.col("e.response.content")
    body = F.when(content["encoding"] == "base64", F.unbase64(content["text"])).otherwise(F.encode(content["text"], "UTF-8"))
    return each.select(F.col("e.request.url").alias("url"), F.col("e.response.status").alias("status"), F.to_timestamp("e.startedDateTime").alias("started"), content["mimeType"].alias("mime"), body.alias("body"))


def one_reading(rows: DataFrame, key: list[str], seen: str, immutable: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows, refused): of several readings of a document the latest; readings that disagree on immutable facts are refused together."""
    facts = F.struct(*immutable)
    judged = rows.groupBy(*key).agg(F.count_distinct(facts).alias("n"), F.max_by(F.struct(*[c for c in rows.columns if c not in key]), seen).alias("last"))
    return judged.filter("n = 1").select(*key, "last.*"), judged.filter("n > 1").select(*key, "n")
