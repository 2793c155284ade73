"""Queries over registry records, work lists, watchlists and drivers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.functions import timeops
from chronoweave.operators import evaluation, modelling, registry_events, serving
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book

QUERIES = Book()

TAXONOMY = """tax AS (SELECT * FROM (VALUES ('KRS', 'bankruptcy_declared', DATE '2016-01-01', NULL, 'opened'), ('MSiG', 'bankruptcy_declared', DATE '2016-01-01', DATE '2019-12-31', 'opened'), ('KRS', 'board_changed', DATE '2016-01-01', DATE '2018-06-30', 'board'), ('KRS', 'board_changed', DATE '2018-06-01', NULL, 'board_v2')) v(source, locator, valid_from, valid_to, event_type)),
j AS (SELECT l.event_id, l.source, l.locator, l.known_from, count(t.event_type) AS n, min(t.event_type) AS event_type FROM (SELECT event_id, source, event_type AS locator, known_from FROM legal WHERE event_type IN ('bankruptcy_declared', 'board_changed')) l LEFT JOIN tax t ON t.source = l.source AND t.locator = l.locator AND l.known_from >= t.valid_from AND (t.valid_to IS NULL OR l.known_from <= t.valid_to) GROUP BY ALL)"""


def _resolved(t: Tables) -> tuple[DataFrame, DataFrame]:
    taxonomy = t.spark.sql("SELECT * FROM VALUES ('KRS', 'bankruptcy_declared', DATE '2016-01-01', CAST(NULL AS DATE), 'opened'), ('MSiG', 'bankruptcy_declared', DATE '2016-01-01', DATE '2019-12-31', 'opened'), ('KRS', 'board_changed', DATE '2016-01-01', DATE '2018-06-30', 'board'), ('KRS', 'board_changed', DATE '2018-06-01', CAST(NULL AS DATE), 'board_v2') AS v(source, locator, valid_from, valid_to, event_type)")
    records = t.legal.filter(F.col("event_type").isin("bankruptcy_declared", "board_changed")).select("event_id", "source", F.col("event_type").alias("locator"), "known_from")
    return registry_events.resolved(records, taxonomy)


@QUERIES.query(f"WITH {TAXONOMY} SELECT event_id, source, locator, known_from, event_type FROM j WHERE n = 1")
def taxonomy_resolved(t: Tables) -> DataFrame:
    return _resolved(t)[0]


@QUERIES.query(f"WITH {TAXONOMY} SELECT event_id, source, locator, known_from, CASE WHEN n = 0 THEN 'no_mapping' ELSE 'two_mappings' END AS reason FROM j WHERE n <> 1")
def taxonomy_quarantined(t: Tables) -> DataFrame:
    return _resolved(t)[1]


@QUERIES.query("WITH r AS (SELECT *, min(CASE WHEN event_type = 'registered' THEN coalesce(event_date, known_from) END) OVER (PARTITION BY krs) AS reg FROM legal) SELECT event_id, source = 'MSiG' AND coalesce(event_date < reg, false) AS date_dropped, CASE WHEN NOT (source = 'MSiG' AND coalesce(event_date < reg, false)) THEN event_date END AS event_date FROM r")
def dates_since_registration(t: Tables) -> DataFrame:
    return registry_events.dates_since_registration(t.legal, "MSiG").select("event_id", "date_dropped", "event_date")


@QUERIES.query("""WITH k AS (SELECT *, CASE WHEN stage = 'opening' THEN coalesce(outcome_class, event_type) ELSE event_type END AS kind, CASE WHEN proceeding_id IS NOT NULL THEN 'case:' || proceeding_id WHEN event_date IS NOT NULL THEN 'date:' || CAST(event_date AS VARCHAR) ELSE 'known:' || CAST(known_from AS VARCHAR) END AS anchor FROM legal),
d AS (SELECT krs, kind, anchor, min(event_date) AS decided FROM k WHERE event_date IS NOT NULL GROUP BY ALL), l AS (SELECT DISTINCT krs, kind, known_from FROM k WHERE event_date IS NULL AND proceeding_id IS NULL),
o AS (SELECT l.krs, l.kind, l.known_from, min(d.anchor) AS adopted FROM l JOIN d ON d.krs = l.krs AND d.kind = l.kind AND d.decided <= l.known_from AND l.known_from - d.decided <= 366 GROUP BY ALL HAVING count(*) = 1)
SELECT k.event_id, sha256(k.krs || '|' || k.kind || '|' || CASE WHEN k.event_date IS NULL AND k.proceeding_id IS NULL THEN coalesce(o.adopted, k.anchor) ELSE k.anchor END) AS dedup_group_id FROM k LEFT JOIN o ON o.krs = k.krs AND o.kind = k.kind AND o.known_from = k.known_from""")
def dedup_groups(t: Tables) -> DataFrame:
    return registry_events.dedup_groups(t.legal.drop("dedup_group_id")).select("event_id", "dedup_group_id")


@QUERIES.query("WITH h AS (SELECT krs, document_ref, known_from, sha256(status) AS content_hash FROM filing), b AS (SELECT *, lag(content_hash) OVER (PARTITION BY krs ORDER BY document_ref) AS before FROM h) SELECT krs, document_ref, known_from, content_hash FROM b WHERE before IS DISTINCT FROM content_hash")
def content_changes(t: Tables) -> DataFrame:
    return registry_events.content_changes(t.filing.select("krs", "document_ref", "known_from", "status"), "krs", "document_ref", F.col("status")).drop("status")


@QUERIES.query("SELECT krs, unnest(list_filter([CASE WHEN balance < 0 THEN 'negative_balance' END, CASE WHEN nation > 20 THEN 'far_nation' END, CASE WHEN segment = 'MACHINERY' THEN 'wrong_segment' END], lambda x: x IS NOT NULL)) AS reason FROM entity")
def segment_violations(t: Tables) -> DataFrame:
    return registry_events.violations(t.entity, "krs", [("negative_balance", F.col("balance") < 0), ("far_nation", F.col("nation") > 20), ("wrong_segment", F.col("segment") == "MACHINERY")])


@QUERIES.query("SELECT krs FROM entity e WHERE NOT EXISTS (SELECT 1 FROM filing f WHERE f.krs = e.krs AND f.status = 'valid' AND f.known_from >= DATE '2000-01-01') AND NOT EXISTS (SELECT 1 FROM filing f WHERE f.krs = e.krs AND f.status = 'quarantined' AND f.known_from >= DATE '2000-06-01')")
def pending_work(t: Tables) -> DataFrame:
    results = t.filing.filter("status = 'valid' and known_from >= '2000-01-01'")
    refused = t.filing.filter("status = 'quarantined' and known_from >= '2000-06-01'")
    return registry_events.pending(t.entity.select("krs"), results, refused, ["krs"])


@QUERIES.query("WITH s AS (SELECT *, last_day(as_of_date + to_months(horizon_months)) AS settles FROM score), o AS (SELECT DISTINCT krs, true AS hit FROM legal WHERE stage = 'opening'), r AS (SELECT s.probability AS p, CASE WHEN o.hit THEN 1 ELSE 0 END AS y FROM s LEFT JOIN o ON o.krs = s.krs WHERE settles <= DATE '2021-12-31') SELECT CAST(least(floor(p * 10), 9) AS INT) AS bin, count(*) AS n, CAST(sum(y) AS BIGINT) AS events, round(avg(p), 9) AS mean_score, round(avg(y), 9) AS rate FROM r GROUP BY 1")
def realised_calibration(t: Tables) -> DataFrame:
    opened = t.legal.filter("stage = 'opening'").select("krs").distinct().withColumn("hit", F.lit(1))
    outcomes = t.score.select("krs").distinct().join(opened, "krs", "left").select("krs", F.coalesce("hit", F.lit(0)).alias("y"))
    rows = registry_events.realised(t.score, outcomes, "2021-12-31", ["krs"], timeops.window_end(F.col("as_of_date"), F.col("horizon_months")))
    return evaluation.reliability(rows).withColumns({c: F.round(c, 9) for c in ("mean_score", "rate")})


@QUERIES.query("SELECT segment AS list_name, stage, count(m.krs) AS n FROM (SELECT e.krs, e.segment, s.stage FROM entity e CROSS JOIN (SELECT unnest(['filed', 'valid', 'event']) AS stage) s) x LEFT JOIN (SELECT DISTINCT krs, 'filed' AS st FROM filing UNION ALL SELECT DISTINCT krs, 'valid' FROM filing WHERE status = 'valid' UNION ALL SELECT DISTINCT krs, 'event' FROM legal) m ON m.krs = x.krs AND m.st = x.stage GROUP BY ALL")
def list_funnel(t: Tables) -> DataFrame:
    stages = {"filed": t.filing, "valid": t.filing.filter("status = 'valid'"), "event": t.legal}
    return registry_events.funnel(stages, t.entity.select("krs", F.col("segment").alias("list_name")))


@QUERIES.query("WITH e AS (SELECT lang AS file, source AS path FROM documents), b AS (SELECT file, bool_or(starts_with(path, 'src1')) AS one, bool_or(starts_with(path, 'src19')) AS two FROM e GROUP BY file) SELECT file, CASE WHEN one AND two THEN 'first+second' WHEN one THEN 'first' WHEN two THEN 'second' ELSE 'other' END AS bodies, NOT one AND NOT two AS fell_back FROM b")
def filed_bodies(t: Tables) -> DataFrame:
    return registry_events.filed_bodies(t.documents.select(F.col("lang").alias("file"), F.col("source").alias("path")), [("first", "src1"), ("second", "src19")], "other")


@QUERIES.query("SELECT krs, CASE WHEN nation < 3 THEN 'replaced' ELSE 'kept' END AS state FROM entity WHERE nation < 3 OR segment = 'BUILDING'")
def watchlist_replaced(t: Tables) -> DataFrame:
    """A list whose members of some nations are put anew; the others keep what they had."""
    stored = t.entity.filter("segment = 'BUILDING'").select("krs", F.lit("kept").alias("state"))
    new = t.entity.filter("nation < 3").select("krs", F.lit("replaced").alias("state"))
    return serving.merged(stored, new, ["krs"], ["state"])


@QUERIES.query("WITH c AS (SELECT krs, as_of_date, unnest(['a', 'b']) AS feature, unnest([probability * 0.5, probability - 0.5]) AS contribution FROM score), x AS (SELECT * FROM c WHERE as_of_date < DATE '2021-01-01'), a AS (SELECT krs, feature, sum(contribution) AS was FROM x GROUP BY ALL), b AS (SELECT krs, feature, sum(contribution) AS became FROM c WHERE as_of_date >= DATE '2021-01-01' GROUP BY ALL) SELECT coalesce(a.krs, b.krs) AS krs, coalesce(a.feature, b.feature) AS feature, round(coalesce(was, 0), 9) AS was, round(coalesce(became, 0), 9) AS became, round(coalesce(became, 0) - coalesce(was, 0), 9) AS moved FROM a FULL JOIN b ON a.krs = b.krs AND a.feature = b.feature")
def driver_movement(t: Tables) -> DataFrame:
    each = F.explode(F.array(F.struct(F.lit("a").alias("feature"), (F.col("probability") * 0.5).alias("c")), F.struct(F.lit("b").alias("feature"), (F.col("probability") - 0.5).alias("c"))))
    rows = t.score.select("krs", "as_of_date", each.alias("x")).select("krs", "as_of_date", "x.*")
    total = lambda df: df.groupBy("krs", "feature").agg(F.sum("c").alias("contribution"))
    moved = modelling.driver_movement(total(rows.filter("as_of_date < '2021-01-01'")), total(rows.filter("as_of_date >= '2021-01-01'")), ["krs"])
    return moved.withColumns({c: F.round(c, 9) for c in ("was", "became", "moved")})


@QUERIES.query("SELECT krs, CASE WHEN balance IS NOT NULL THEN round(1 / (1 + exp(-(0.2 + balance / 10000.0 * 1.5 + nation / 25.0 * -0.7))), 9) END AS probability, CASE WHEN abs(balance / 10000.0 * 1.5) >= abs(nation / 25.0 * -0.7) THEN 'balance' ELSE 'nation' END AS first_driver FROM entity")
def scored_complete_cases(t: Tables) -> DataFrame:
    store = t.entity.select("krs", (F.col("balance") / 10000.0).alias("balance"), (F.col("nation") / 25.0).alias("nation"))
    scored = modelling.complete_cases(store, {"balance": 1.5, "nation": -0.7}, 0.2)
    return scored.select("krs", F.round("probability", 9).alias("probability"), F.col("top_drivers")[0]["feature"].alias("first_driver"))
