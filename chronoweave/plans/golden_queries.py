"""Queries over golden samples, labelling and attachments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators import golden
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book

QUERIES = Book()

_U = "(('0x' || substr(sha256({}), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE)"
PAGES = "paged AS (SELECT d.source AS krs, d.doc_id // 3 AS document_ref, d.doc_id AS page, d.doc_id % 7 = 0 AS answered, 1.0::DOUBLE + len(d.source) AS weight FROM documents d WHERE d.source IS NOT NULL)"
FRAME = f"""{PAGES}, dealt AS (SELECT *, CASE WHEN answered THEN 0.5::DOUBLE ELSE 0.1::DOUBLE END AS rate, CASE WHEN answered THEN {_U.format("'gold-2:' || krs || ':' || CAST(document_ref AS VARCHAR)")} ELSE {_U.format("'gold-2:' || krs || ':' || CAST(document_ref AS VARCHAR) || ':' || CAST(page AS VARCHAR)")} END AS u FROM paged),
drawn AS (SELECT krs, document_ref, page, answered, CASE WHEN answered THEN 'present' ELSE 'absent' END AS stratum, rate / weight AS pi, u / rate AS draw_position FROM dealt WHERE u < rate)"""


def _drawn(t: Tables) -> DataFrame:
    rows = t.documents.filter("source is not null").select(F.col("source").alias("krs"), F.floor(F.col("doc_id") / 3).alias("document_ref"), F.col("doc_id").alias("page"), (F.col("doc_id") % 7 == 0).alias("answered"), F.lit(True).alias("read"))
    entities = rows.select("krs").distinct().withColumn("weight", 1.0 + F.length("krs"))
    return golden.frame(rows, entities, {"present": 0.5, "absent": 0.1}, "gold-2")


@QUERIES.query(f"WITH {FRAME} SELECT krs, document_ref, page, answered, stratum, round(pi, 12) AS pi, round(draw_position, 12) AS draw_position FROM drawn")
def golden_frame(t: Tables) -> DataFrame:
    return _drawn(t).withColumns({"pi": F.round("pi", 12), "draw_position": F.round("draw_position", 12)})


_DONE = f"{FRAME}, queue AS (SELECT *, draw_position < 0.3 OR page % 4 <> 0 AS labelled FROM drawn)"


def _queue(t: Tables) -> DataFrame:
    return _drawn(t).withColumn("labelled", (F.col("draw_position") < 0.3) | (F.col("page") % 4 != 0))


@QUERIES.query(f"WITH {_DONE}, o AS (SELECT stratum, min(draw_position) FILTER (WHERE NOT labelled) AS first_open FROM queue GROUP BY 1) SELECT q.stratum, count(*) AS pages, count(*) FILTER (WHERE labelled) AS labelled, count(*) FILTER (WHERE o.first_open IS NULL OR q.draw_position < o.first_open) AS complete_prefix FROM queue q JOIN o ON o.stratum = q.stratum GROUP BY q.stratum")
def labelling_progress(t: Tables) -> DataFrame:
    return golden.progress(_queue(t), ["stratum"])


@QUERIES.query("WITH l AS (SELECT doc_id // 2 AS page, lang, CASE WHEN doc_id % 5 = 0 THEN 'a' WHEN doc_id % 5 < 4 THEN 'b' END AS label FROM documents), p AS (SELECT lang, page, count(*) AS n, count(DISTINCT coalesce(label, '~')) AS k FROM l GROUP BY ALL HAVING count(*) > 1) SELECT lang, count(*) AS rechecked, count(*) FILTER (WHERE k = 1) AS agreed, count(*) FILTER (WHERE k > 1) AS disagreed FROM p GROUP BY lang")
def labeller_agreement(t: Tables) -> DataFrame:
    label = F.when(F.col("doc_id") % 5 == 0, "a").when(F.col("doc_id") % 5 < 4, "b")
    return golden.agreement(t.documents.select(F.floor(F.col("doc_id") / 2).alias("page"), "lang", label.alias("label")), ["page"], ["lang"])


_SCORED = f"{FRAME}, told AS (SELECT *, page % 5 < 2 AS t, answered OR page % 11 = 0 AS s FROM drawn)"
_SCORES = "count(*) AS n_rows, round(coalesce(sum(CASE WHEN t AND s THEN 1 / pi END), 0), 6) AS tp, round(coalesce(sum(CASE WHEN NOT t AND s THEN 1 / pi END), 0), 6) AS fp, round(coalesce(sum(CASE WHEN t AND NOT s THEN 1 / pi END), 0), 6) AS fn"


def _scores(rows: DataFrame, by: list[str]) -> DataFrame:
    out = golden.weighted_scores(rows, by, "t", "s", F.col("pi")).drop("precision", "recall")
    return out.withColumns({c: F.round(c, 6) for c in ("tp", "fp", "fn")})


def _told(t: Tables) -> DataFrame:
    return _drawn(t).withColumns({"t": F.col("page") % 5 < 2, "s": F.col("answered") | (F.col("page") % 11 == 0)})


@QUERIES.query(f"WITH {_SCORED} SELECT stratum, {_SCORES} FROM told GROUP BY stratum")
def page_scores(t: Tables) -> DataFrame:
    return _scores(_told(t), ["stratum"])


@QUERIES.query(f"WITH {_SCORED}, d AS (SELECT krs, document_ref, bool_or(t) AS t, bool_or(s) AS s, min(pi) AS pi FROM told GROUP BY ALL) SELECT {_SCORES} FROM d")
def document_scores(t: Tables) -> DataFrame:
    return _scores(golden.by_document(_told(t), ["krs", "document_ref"], "t", "s"), [])


@QUERIES.query("SELECT page_id AS file_id, 0 AS place, html AS content FROM pages WHERE html IS NOT NULL UNION ALL SELECT page_id, 1, CASE WHEN page_id % 3 = 0 THEN NULL ELSE 'second' END FROM pages WHERE html IS NOT NULL")
def embedded_attachments(t: Tables) -> DataFrame:
    coded = F.when(F.col("page_id") % 3 == 0, "no base64!").otherwise(F.base64(F.lit("second")))
    xml = F.concat(F.lit('<s:S xmlns:s="urn:s"><s:Plik>'), F.base64(F.encode("html", "UTF-8")), F.lit("</s:Plik><s:Inny>x</s:Inny><s:Plik> "), coded, F.lit(" </s:Plik></s:S>"))
    found = golden.attachments(t.pages.filter("html is not null").select(F.col("page_id").alias("file_id"), xml.alias("xml")), "Plik")
    return found.withColumn("content", F.decode("content", "UTF-8"))


@QUERIES.query("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'adverse' WHEN page_id % 4 = 1 THEN 'qualified' WHEN page_id % 4 = 2 THEN 'adverse' END AS opinion FROM pages")
def opinion_classes(t: Tables) -> DataFrame:
    kind = F.col("page_id") % 4
    text = F.when(kind == 0, "Report\nAdverse opinion\nwith a qualified remark").when(kind == 1, "OPINION qualified\nnothing adverse to say").when(kind == 2, "In our view adverse, though qualified").otherwise("all is well")
    return t.pages.select("page_id", golden.opinion(text, r"(?i)^(?:adverse |qualified )?opinion", [("adverse", "(?i)adverse"), ("qualified", "(?i)qualified")]).alias("opinion"))
