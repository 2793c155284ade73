"""Queries over texts, size classes and table digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators import size_class, text
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book
from chronoweave.sources.datasets import column_digests

QUERIES = Book()


@QUERIES.query()
def masked_text(t: Tables) -> DataFrame:
    """Lookarounds have no counterpart in the other engine's patterns; tested on fixtures."""
    masked = text.masked(F.col("text"))
    return t.documents.select("doc_id", masked.alias("masked"), F.size(text.personal_data(masked)).alias("left"))


@QUERIES.query("SELECT doc_id, sha256(regexp_replace(text, '[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+(\\.[A-Za-z0-9_-]+)+', '[EMAIL]', 'g')) AS masked_sha256, CAST(len(regexp_extract_all(text, '[A-Za-z0-9_.+-]+@[A-Za-z0-9_-]+(\\.[A-Za-z0-9_-]+)+')) AS INT) AS n FROM documents")
def masked_emails(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.sha2(F.regexp_replace("text", text.EMAIL, text.TOKENS["email"]), 256).alias("masked_sha256"), F.regexp_count("text", F.lit(text.EMAIL)).alias("n"))


@QUERIES.query("""WITH s AS (SELECT doc_id, unnest(string_split_regex(lower(text), '[.!?\\n]+')) AS s FROM documents), w AS (SELECT doc_id, list_filter(string_split_regex(s, '[^a-z0-9\\p{L}]+'), lambda x: x <> '') AS words FROM s), h AS (
SELECT doc_id, list_contains(words, 'the') AND list_contains(words, 'and') AS a, list_has_any(words, ['token', 'licensed']) AS b FROM w WHERE len(words) > 0) SELECT doc_id, count(*) FILTER (WHERE a) AS common, count(*) FILTER (WHERE b) AS marked FROM h WHERE a OR b GROUP BY doc_id""")
def prefilter_hits(t: Tables) -> DataFrame:
    hits = text.prefilter_hits(t.documents, "doc_id", "text", {"common": [["the", "and"]], "marked": [["token|licensed"]]})
    return hits.groupBy("doc_id").agg(F.count_if(F.col("signal") == "common").alias("common"), F.count_if(F.col("signal") == "marked").alias("marked"))


@QUERIES.query("SELECT doc_id, CASE WHEN len(list_distinct(f)) = 1 THEN f[1] END AS number FROM (SELECT doc_id, regexp_extract_all(text, 'version [0-9]') AS f FROM documents)")
def firm_number(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.single_number(F.col("text"), "version [0-9]").alias("number"))


@QUERIES.query("SELECT doc_id, CASE WHEN regexp_matches(text, 'GNU General') THEN 'copyleft' WHEN regexp_matches(text, 'licen[sc]e') THEN 'licence' WHEN regexp_matches(text, 'All rights') THEN 'reserved' END AS rule FROM documents")
def first_rule_that_holds(t: Tables) -> DataFrame:
    rules = [("copyleft", "GNU General"), ("licence", "licen[sc]e"), ("reserved", "All rights")]
    return t.documents.select("doc_id", text.first_rule(F.col("text"), rules)["rule"].alias("rule"))


@QUERIES.query("SELECT page_id, CASE WHEN n >= 2000 THEN 'text' WHEN n = 0 THEN 'needs_ocr' ELSE 'sparse' END AS status FROM (SELECT page_id, length(trim(regexp_replace(html, '\\s+', ' ', 'g'))) AS n FROM pages)")
def page_status(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.page_status(F.col("html"), 2000).alias("status"))


@QUERIES.query("WITH u AS (SELECT doc_id, lang, ('0x' || substr(sha256('golden-1:' || CAST(doc_id AS VARCHAR)), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS u, CASE lang WHEN 'en' THEN 0.1::DOUBLE ELSE 0.3::DOUBLE END AS rate FROM documents) SELECT doc_id, lang, u, u / rate AS draw_position FROM u WHERE u < rate")
def hash_sample(t: Tables) -> DataFrame:
    rate = F.when(F.col("lang") == "en", F.lit(0.1)).otherwise(F.lit(0.3))
    return text.hash_sample(t.documents.select("doc_id", "lang"), "doc_id", rate, "golden-1")


@QUERIES.query("WITH r AS (SELECT lang, CASE WHEN doc_id % 3 = 0 THEN 'a' WHEN doc_id % 3 = 1 THEN 'b' END AS t, CASE WHEN doc_id % 5 < 2 THEN 'a' WHEN doc_id % 5 = 2 THEN 'b' END AS s FROM documents), c AS (SELECT lang, count(*) FILTER (WHERE t = s) AS tp, count(*) FILTER (WHERE s IS NOT NULL AND s IS DISTINCT FROM t) AS fp, count(*) FILTER (WHERE t IS NOT NULL AND s IS DISTINCT FROM t) AS fn FROM r GROUP BY lang) SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1 FROM c")
def prediction_scores(t: Tables) -> DataFrame:
    truth = F.when(F.col("doc_id") % 3 == 0, "a").when(F.col("doc_id") % 3 == 1, "b")
    said = F.when(F.col("doc_id") % 5 < 2, "a").when(F.col("doc_id") % 5 == 2, "b")
    return text.prediction_scores(t.documents.select("lang", truth.alias("t"), said.alias("s")), "t", "s", ["lang"])


@QUERIES.query()
def size_class_history(t: Tables) -> DataFrame:
    years = t.filing.groupBy("krs", F.year("period_end").alias("fiscal_year")).agg(F.sum("total").alias("total"), F.count("*").alias("n"))
    scale = F.col("total") * 40
    rows = years.select("krs", "fiscal_year", F.make_date(F.col("fiscal_year") + 22, F.lit(1), F.lit(1)).alias("period_start"), scale.alias("assets_low"), scale.alias("assets_high"), (scale * 2).alias("revenue_low"), (scale * 2).alias("revenue_high"),
                        F.when(F.col("n") > 1, F.col("n") * 9.0).alias("employment_low"), F.when(F.col("n") > 1, F.col("n") * 9.0).alias("employment_high"))
    return size_class.size_class_history(rows)


@QUERIES.query()
def table_digests(t: Tables) -> DataFrame:
    return column_digests(t.orders)
