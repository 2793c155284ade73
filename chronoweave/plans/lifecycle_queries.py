"""Queries over runs, cells, hazards, the model registry, reads of scores, lineage and checks of logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators import lifecycle
from chronoweave.plans.domain_queries import GRID as LABELS
from chronoweave.plans.domain_queries import _grid as _labels
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book

QUERIES = Book()


@QUERIES.query("SELECT stratum, krs, count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS events, sum(y) >= 3 AND sum(y) < count(*) AS evaluable FROM prediction GROUP BY ALL")
def evaluable_cells(t: Tables) -> DataFrame:
    return lifecycle.evaluable_cells(t.prediction, ["stratum", "krs"], 3)


@QUERIES.query("""WITH c AS (SELECT stratum, krs, sum(y) >= 3 AND sum(y) < count(*) AS ok FROM prediction GROUP BY ALL)
SELECT p.stratum, count(*) FILTER (WHERE ok) AS n_rows, CAST(sum(y) FILTER (WHERE ok) AS BIGINT) AS events, round(avg((probability - y) * (probability - y)) FILTER (WHERE ok), 9) AS brier, count(DISTINCT p.krs) FILTER (WHERE ok) AS folds, count(DISTINCT p.krs) FILTER (WHERE NOT ok) AS folds_left_out FROM prediction p JOIN c ON c.stratum = p.stratum AND c.krs = p.krs GROUP BY p.stratum""")
def pooled_folds(t: Tables) -> DataFrame:
    return lifecycle.pooled(t.prediction, "krs", ["stratum"], 3).withColumn("brier", F.round("brier", 9))


_SIDES = f"WITH {LABELS}, sided AS (SELECT krs, as_of_date, horizon_months, regime_flag, CASE WHEN year(as_of_date) = 2018 THEN 'test' WHEN year(as_of_date) < 2018 AND krs NOT LIKE '%9' THEN 'train' END AS side FROM grid WHERE excluded_reason IS NULL)"


@QUERIES.query(_SIDES + ", r AS (SELECT s.*, n.run FROM sided s CROSS JOIN (VALUES ('main'), ('no_regime'), ('entity_disjoint')) n(run) WHERE side IS NOT NULL) SELECT run, side, count(*) AS n_rows, count(DISTINCT krs) AS entities FROM r WHERE side = 'test' OR run = 'main' OR (run = 'no_regime' AND NOT regime_flag) OR (run = 'entity_disjoint' AND krs NOT IN (SELECT krs FROM sided WHERE side = 'test')) GROUP BY ALL")
def three_runs(t: Tables) -> DataFrame:
    year = F.year("as_of_date")
    side = F.when(year == 2018, "test").when((year < 2018) & ~F.col("krs").endswith("9"), "train")
    rows = _labels(t).filter("excluded_reason is null").select("krs", "as_of_date", "horizon_months", "regime_flag", side.alias("side"))
    return lifecycle.runs(rows).groupBy("run", "side").agg(F.count("*").alias("n_rows"), F.count_distinct("krs").alias("entities"))


@QUERIES.query("SELECT a.doc_id, a.y, a.probability, round(a.probability * 0.9 + 0.01, 12) AS probability_other FROM prediction a")
def paired_predictions(t: Tables) -> DataFrame:
    other = t.prediction.select("doc_id", "y", (F.col("probability") * 0.9 + 0.01).alias("probability"))
    return lifecycle.paired(t.prediction, other, ["doc_id"]).withColumn("probability_other", F.round("probability_other", 12))


@QUERIES.query("SELECT krs, feature, contribution FROM (SELECT krs, unnest(['balance', 'nation']) AS feature, unnest([round(coalesce(balance - 4500.0, 0) * 0.001, 9), round((nation - 12.0) * -0.05, 9)]) AS contribution FROM entity)")
def linear_attributions(t: Tables) -> DataFrame:
    return lifecycle.attributions(t.entity, ["krs"], {"balance": 0.001, "nation": -0.05}, {"balance": 4500.0, "nation": 12.0}).withColumn("contribution", F.round("contribution", 9))


_STATES = f"WITH {LABELS}, states AS (SELECT DISTINCT krs, excluded_reason FROM grid WHERE as_of_date = DATE '2018-12-31'), own AS (SELECT DISTINCT krs, DATE '2018-12-31' AS as_of_date FROM legal)"


def _month_end(t: Tables) -> tuple[DataFrame, DataFrame]:
    grid = _labels(t)
    states = grid.filter("as_of_date = '2018-12-31'").select("krs", "excluded_reason").distinct()
    store = t.legal.select("krs").distinct().withColumn("as_of_date", F.to_date(F.lit("2018-12-31")))
    return lifecycle.month_end_rows(store, "2018-12-31", states, grid.filter("as_of_date < '2018-01-01'"))


@QUERIES.query(_STATES + " SELECT o.krs, o.as_of_date FROM own o JOIN states s ON s.krs = o.krs WHERE s.excluded_reason IS NULL")
def month_end_at_risk(t: Tables) -> DataFrame:
    return _month_end(t)[0]


@QUERIES.query(_STATES + " SELECT o.krs, o.as_of_date, coalesce(s.excluded_reason, 'not_on_grid') AS reason FROM own o LEFT JOIN states s ON s.krs = o.krs WHERE s.krs IS NULL OR s.excluded_reason IS NOT NULL")
def month_end_exclusions(t: Tables) -> DataFrame:
    return _month_end(t)[1]


@QUERIES.query("WITH h AS (SELECT c_custkey AS id, m AS month, CASE WHEN c_custkey % 50 = 0 AND m = 5 THEN 1.0::DOUBLE WHEN c_custkey % 41 = 0 AND m = 9 THEN NULL ELSE (c_custkey % 13 + m) / 400.0::DOUBLE END AS hazard FROM customer CROSS JOIN range(1, 16) r(m)) SELECT id, CASE WHEN count(hazard) FILTER (WHERE month <= 12) = 12 THEN round(1 - product(1 - hazard) FILTER (WHERE month <= 12), 9) END AS probability FROM h GROUP BY id")
def hazard_probabilities(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").alias("id"), F.explode(F.sequence(F.lit(1), F.lit(15))).alias("month"))
    hazard = F.when((F.col("id") % 50 == 0) & (F.col("month") == 5), 1.0).when((F.col("id") % 41 == 0) & (F.col("month") == 9), None).otherwise((F.col("id") % 13 + F.col("month")) / 400.0)
    return lifecycle.hazard_probabilities(rows.withColumn("hazard", hazard), ["id"], 12).withColumn("probability", F.round("probability", 9))


_MODELS = "models(horizon_months, version, role, was_champion) AS (VALUES (12, 1, 'incumbent', false), (12, 2, 'incumbent', false), (12, 3, 'challenger', false), (24, 4, 'incumbent', false), (24, 5, 'challenger', true), (36, 6, 'incumbent', false), (36, 7, 'challenger', true), (48, 8, 'incumbent', false))"
_VERDICTS = "verdicts(horizon_months, verdict, weighted) AS (VALUES (12, 'promoted', false), (24, 'provisional', true), (36, 'kept', true))"


@QUERIES.query(f"WITH {_MODELS}, {_VERDICTS}, n AS (SELECT horizon_months, max(version) FILTER (WHERE role = 'incumbent') AS i, max(version) FILTER (WHERE role = 'challenger') AS c, max(version) FILTER (WHERE was_champion) AS b FROM models GROUP BY 1), a AS (SELECT n.horizon_months, n.i, CASE verdict WHEN 'promoted' THEN c WHEN 'provisional' THEN b WHEN 'kept' THEN CASE WHEN NOT weighted THEN b END ELSE b END AS champ FROM n LEFT JOIN verdicts v ON v.horizon_months = n.horizon_months) SELECT horizon_months, 'champion' AS alias, champ AS version FROM a WHERE champ IS NOT NULL UNION ALL SELECT horizon_months, 'incumbent', i FROM a")
def registered_aliases(t: Tables) -> DataFrame:
    models = t.spark.sql(f"WITH {_MODELS} SELECT * FROM models")
    return lifecycle.registered_aliases(models, t.spark.sql(f"WITH {_VERDICTS} SELECT * FROM verdicts"))


@QUERIES.query("SELECT 24 AS horizon_months, 'champion' AS alias, 5 AS version")
def served_version(t: Tables) -> DataFrame:
    return lifecycle.served_version(registered_aliases(t), 24)


def _quantile_bins(side: str) -> str:
    return f"greatest(count(*) FILTER (WHERE side = {side}) / (SELECT count(*) FROM s WHERE side = {side}), 1e-4)"


@QUERIES.query("WITH s AS (SELECT CAST(f AS VARCHAR) AS feature, v AS x, side FROM (SELECT doc_id % 2 AS side, unnest(['n_chars', 'words']) AS f, unnest([CAST(n_chars AS DOUBLE), CAST(len(string_split(text, ' ')) AS DOUBLE)]) AS v FROM documents)), e AS (SELECT DISTINCT feature, unnest(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM s WHERE side = 0 GROUP BY feature), b AS (SELECT s.feature, s.side, (SELECT count(*) FROM e WHERE e.feature = s.feature AND e.e < s.x) AS bin FROM s WHERE s.x IS NOT NULL), n AS (SELECT feature, count(*) FILTER (WHERE side = 0) AS n0, count(*) FILTER (WHERE side = 1) AS n1 FROM b GROUP BY 1), q AS (SELECT b.feature, bin, greatest(count(*) FILTER (WHERE side = 0) / any_value(n0), 1e-4) AS p, greatest(count(*) FILTER (WHERE side = 1) / any_value(n1), 1e-4) AS r FROM b JOIN n USING (feature) GROUP BY b.feature, bin) SELECT q.feature, round(sum((r - p) * ln(r / p)), 9) AS psi, round((SELECT count(*) FILTER (WHERE x IS NULL) / count(*) FROM s WHERE s.feature = q.feature AND side = 0), 9) AS missing_before FROM q GROUP BY q.feature")
def input_drift(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "n_chars", F.size(F.split("text", " ")).alias("words")).withColumn("words", F.when(F.col("words") >= 0, F.col("words")))
    out = lifecycle.input_drift(rows.filter("doc_id % 2 = 0"), rows.filter("doc_id % 2 = 1"), ["n_chars", "words"])
    return out.select("feature", F.round("psi", 9).alias("psi"), F.round("missing_before", 9).alias("missing_before"))


_SERVED = "served_scores AS (SELECT krs, as_of_date, horizon_months, model_name, CAST(1 + CAST(right(krs, 1) AS INT) % 3 AS VARCHAR) AS version, probability FROM score), served(model_name, version) AS (VALUES ('logistic', '1'), ('logistic', '2'), ('trees', '1'))"


def _scores(t: Tables) -> tuple[DataFrame, DataFrame]:
    scores = t.score.withColumn("version", (1 + F.right("krs", F.lit(1)).cast("int") % 3).cast("string"))
    return scores, t.spark.sql("VALUES ('logistic', '1'), ('logistic', '2'), ('trees', '1') AS s(model_name, version)")


@QUERIES.query(f"WITH {_SERVED} SELECT s.krs, s.as_of_date, s.horizon_months, s.model_name, s.version, s.probability, CASE WHEN s.krs LIKE '%4' THEN s.probability / 2 END AS low, CASE WHEN s.krs LIKE '%4' THEN s.probability * 1.5 END AS high FROM served_scores s WHERE (s.model_name, s.version) IN (SELECT model_name, version FROM served) AND s.as_of_date = (SELECT max(as_of_date) FROM served_scores)")
def scores_with_intervals(t: Tables) -> DataFrame:
    scores, served = _scores(t)
    last = scores.agg(F.max("as_of_date")).first()[0]
    intervals = t.score.filter(F.col("krs").endswith("4")).select("krs", "as_of_date", "horizon_months", "model_name", (F.col("probability") / 2).alias("low"), (F.col("probability") * 1.5).alias("high"))
    return lifecycle.with_intervals(scores.filter(F.col("as_of_date") == F.lit(last)), served, intervals).select("krs", "as_of_date", "horizon_months", "model_name", "version", "probability", "low", "high")


@QUERIES.query(f"WITH {_SERVED} SELECT krs, as_of_date, horizon_months, model_name, version, probability FROM served_scores WHERE krs = (SELECT min(krs) FROM served_scores WHERE version = '2') AND version IN ('1', '2')")
def score_history(t: Tables) -> DataFrame:
    scores, served = _scores(t)
    krs = scores.filter("version = '2'").agg(F.min("krs")).first()[0]
    return lifecycle.score_history(scores, served, krs, 12).select("krs", "as_of_date", "horizon_months", "model_name", "version", "probability")


@QUERIES.query(f"WITH {_SERVED} SELECT * FROM served v WHERE NOT EXISTS (SELECT 1 FROM served_scores s WHERE s.model_name = v.model_name AND s.version = v.version)")
def served_without_scores(t: Tables) -> DataFrame:
    return lifecycle.check_served(*_scores(t))


@QUERIES.query("WITH l AS (SELECT krs, model_name, horizon_months, max(as_of_date) AS as_of_date, arg_max(probability, as_of_date) AS probability FROM score GROUP BY ALL) SELECT krs, model_name, horizon_months, as_of_date, probability, round(((SELECT count(*) FROM l o WHERE o.probability < l.probability) + (SELECT count(*) FROM l o WHERE o.probability = l.probability) / 2) / (SELECT count(*) FROM l), 9) AS percentile FROM l")
def current_status(t: Tables) -> DataFrame:
    return lifecycle.current_status(t.score, []).select("krs", "model_name", "horizon_months", "as_of_date", "probability", F.round("percentile", 9).alias("percentile"))


@QUERIES.query("WITH a AS (SELECT sha256(krs) AS alert_id, min(known_from) AS acknowledged_at FROM filing GROUP BY krs) SELECT * FROM a")
def acknowledged_alerts(t: Tables) -> DataFrame:
    acks = t.filing.select(F.sha2("krs", 256).alias("alert_id"), F.col("known_from").alias("acknowledged_at"), "document_ref")
    return lifecycle.acknowledged(acks.filter("document_ref % 2 = 0").drop("document_ref"), acks.filter("document_ref % 2 = 1").drop("document_ref"))


@QUERIES.query("SELECT krs, 'o' || CAST(document_ref // 40 AS VARCHAR) AS object_key, string_agg(CAST(document_ref AS VARCHAR), ',' ORDER BY document_ref) AS refs, count(*) AS n FROM filing WHERE deleted_on IS NULL AND document_ref % 9 <> 0 GROUP BY ALL")
def statement_downloads(t: Tables) -> DataFrame:
    ref = F.col("document_ref")
    rows = t.filing.withColumns({"object_key": F.when(ref % 9 != 0, F.concat(F.lit("o"), F.floor(ref / 40).cast("string"))), "file_name": F.concat(ref.cast("string"), F.lit(".xml"))})
    return lifecycle.downloads(rows).select("krs", "object_key", F.array_join(F.transform("rows", lambda r: r["document_ref"].cast("string")), ",").alias("refs"), F.size("rows").cast("long").alias("n"))


@QUERIES.query("WITH f AS (SELECT krs, 'k' || CAST(document_ref % 3 AS VARCHAR) AS file_key, make_date(CAST(year(period_end) // 2 * 2 AS INT), 12, 31) AS period_end, known_from FROM filing WHERE status <> 'needs_pdf_tier' AND deleted_on IS NULL) SELECT krs, file_key, min(period_end) AS period_end, min(known_from) AS known_from FROM f GROUP BY ALL HAVING min(period_end) = max(period_end)")
def text_sources(t: Tables) -> DataFrame:
    files = t.filing.select("krs", F.concat(F.lit("k"), (F.col("document_ref") % 3).cast("string")).alias("file_key"), F.make_date((F.floor(F.year("period_end") / 2) * 2).cast("int"), F.lit(12), F.lit(31)).alias("period_end"), "known_from", "deleted_on", F.when(F.col("status") == "needs_pdf_tier", "pdf").otherwise("xml").alias("kind"))
    return lifecycle.text_sources(files)


@QUERIES.query("SELECT document_ref, CASE WHEN document_ref % 10 = 0 THEN 'submission_date_missing' WHEN document_ref % 4 = 1 THEN 'period_mismatch' END AS reason FROM filing")
def mapping_guards(t: Tables) -> DataFrame:
    ref = F.col("document_ref")
    files = t.filing.select("document_ref", F.when(ref % 10 != 0, F.col("known_from")).alias("known_from"), "period_end", F.trunc("period_end", "year").alias("period_start"), F.trunc("period_end", "year").alias("stated_start"), F.when(ref % 4 != 1, F.col("period_end")).alias("stated_end"))
    return lifecycle.guarded(files).select("document_ref", "reason")


@QUERIES.query("SELECT * FROM (VALUES ('entity', 'same'), ('filing', 'changed_between_runs'), ('fact', 'differs_from_stored'), ('score', 'not_stored'), ('legal', 'missing_in_a_run')) v(dataset, verdict)")
def chain_comparison(t: Tables) -> DataFrame:
    first = t.spark.sql("VALUES ('entity', 'a'), ('filing', 'a'), ('fact', 'a'), ('score', 'a'), ('legal', 'a') AS v(dataset, digest)")
    second = t.spark.sql("VALUES ('entity', 'a'), ('filing', 'b'), ('fact', 'a'), ('score', 'a') AS v(dataset, digest)")
    stored = t.spark.sql("VALUES ('entity', 'a'), ('filing', 'a'), ('fact', 'c'), ('legal', 'a') AS v(dataset, digest)")
    return lifecycle.compare_digests(first, second, stored)


@QUERIES.query("WITH hints AS (SELECT krs, CASE nation % 3 WHEN 0 THEN 'bankruptcy' WHEN 1 THEN 'restructuring' ELSE 'liquidation' END AS expected FROM entity), c AS (SELECT krs, string_agg(DISTINCT outcome_class, ',' ORDER BY outcome_class) AS found FROM legal WHERE outcome_class IS NOT NULL GROUP BY krs) SELECT h.krs, h.expected, coalesce(c.found, '') AS found, coalesce(list_contains(string_split(c.found, ','), h.expected), false) AS accepted FROM hints h LEFT JOIN c ON c.krs = h.krs")
def seed_acceptance(t: Tables) -> DataFrame:
    kind = F.col("nation") % 3
    return lifecycle.acceptance(t.entity.select("krs", F.when(kind == 0, "bankruptcy").when(kind == 1, "restructuring").otherwise("liquidation").alias("expected")), t.legal)


@QUERIES.query("WITH r AS (SELECT DISTINCT l_linenumber AS line, l_returnflag AS flag FROM lineitem), k AS (SELECT l_linenumber AS line, l_returnflag AS flag, count(*) AS asked FROM lineitem GROUP BY ALL) SELECT line, flag, asked FROM k WHERE line % 3 <> 0")
def requests_to_send(t: Tables) -> DataFrame:
    requests = t.lineitem.select(F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag"))
    answered = requests.filter("line % 3 = 0").distinct()
    store = answered.select(F.sha2(F.to_json(F.struct("flag", "line"), {"ignoreNullFields": "false"}), 256).alias("request_key"), F.lit("yes").alias("answer"))
    return lifecycle.replayed(requests, store)[1].select("line", "flag", "asked")


@QUERIES.query("SELECT * FROM (VALUES (3, 'missing'), (5, 'repeated'), (8, 'wrong_place'), (40, 'unexpected')) v(pick, fault)")
def draw_log_faults(t: Tables) -> DataFrame:
    right = t.spark.range(20).select(F.col("id").alias("pick"), F.floor(F.lit(1.5) + F.col("id") * 3.25).alias("place"))
    logged = right.filter("id <> 3").withColumn("place", F.when(F.col("pick") == 8, F.col("place") + 1).otherwise(F.col("place"))).unionByName(right.filter("pick = 5")).unionByName(t.spark.sql("SELECT CAST(40 AS BIGINT) AS pick, CAST(7 AS BIGINT) AS place"))
    return lifecycle.picks_checked(logged, 1.5, 3.25, 20)


@QUERIES.query("WITH m AS (SELECT 'z' || CAST(document_ref AS VARCHAR) AS member, krs, known_from AS prepared FROM filing WHERE status <> 'quarantined'), a AS (SELECT krs, prepared, min(member) AS member FROM m GROUP BY ALL HAVING count(*) = 1), r AS (SELECT krs, known_from AS prepared, min(document_ref) AS document_ref FROM filing GROUP BY ALL HAVING count(*) = 1) SELECT a.member, r.document_ref FROM a JOIN r ON r.krs = a.krs AND r.prepared = a.prepared")
def paired_members(t: Tables) -> DataFrame:
    rows = t.filing.select("krs", F.col("known_from").alias("prepared"), "document_ref", "status")
    members = rows.filter("status <> 'quarantined'").select("krs", "prepared", F.concat(F.lit("z"), F.col("document_ref").cast("string")).alias("member"))
    return lifecycle.paired_members(members, rows, ["krs", "prepared"])


@QUERIES.query(r"WITH p AS (SELECT page_id, html || CASE WHEN page_id % 5 = 0 THEN ' 44051401458 Kowalska kowalska' WHEN page_id % 5 = 1 THEN ' 440514014581 Kowalskax' ELSE '' END AS t FROM pages), m AS (SELECT page_id, 'eleven_digits' AS marker, CAST(len(regexp_extract_all(' ' || regexp_replace(t, '[0-9]{12,}', 'x', 'g') || ' ', '[0-9]{11}')) AS BIGINT) AS n FROM p UNION ALL SELECT page_id, 'Kowalska', CAST(len(regexp_extract_all(t, '(?i)\bkowalska\b')) AS BIGINT) FROM p) SELECT * FROM m WHERE n > 0")
def personal_markers(t: Tables) -> DataFrame:
    tail = F.when(F.col("page_id") % 5 == 0, " 44051401458 Kowalska kowalska").when(F.col("page_id") % 5 == 1, " 440514014581 Kowalskax").otherwise("")
    return lifecycle.personal_markers(t.pages.select("page_id", F.concat("html", tail).alias("text")), "page_id", "text", ["Kowalska"])
