"""Queries over quality checks, evaluation, modelling data, alerts and publication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators import evaluation, modelling, quality, serving
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book

QUERIES = Book()

CHECKS = """checks AS (
  SELECT krs, document_ref, CAST(year(period_end) AS INT) AS fiscal_year, kind, check_name, difference, CASE WHEN difference IS NULL THEN 'not_applicable' WHEN abs(difference) <= 20000 THEN 'pass' ELSE 'fail' END AS status, assets
  FROM (SELECT krs, document_ref, period_end, kind, sum(value) AS assets, sum(value) FILTER (WHERE line_item = 1) - sum(value) FILTER (WHERE line_item = 2) AS balance, sum(value) FILTER (WHERE line_item = 3) - sum(value) FILTER (WHERE line_item = 4) AS subtotal FROM fact GROUP BY ALL)
  UNPIVOT INCLUDE NULLS (difference FOR check_name IN (balance, subtotal))
), judged AS (
  SELECT *, CASE WHEN status = 'fail' AND kind = 'current_year' AND (check_name = 'balance' OR assets IS NULL OR abs(difference) > 0.01 * abs(assets)) THEN 'material' WHEN status = 'fail' THEN 'immaterial' END AS severity FROM checks
)"""


def _checks(t: Tables) -> DataFrame:
    line = lambda n: F.sum(F.when(F.col("line_item") == n, F.col("value")))
    files = t.fact.groupBy("krs", "document_ref", "period_end", "kind").agg(F.sum("value").alias("assets"), line(1).alias("l1"), line(2).alias("l2"), line(3).alias("l3"), line(4).alias("l4"))
    files = files.withColumn("fiscal_year", F.year("period_end"))
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(a).alias("a"), F.col(b).alias("b")) for n, a, b in (("balance", "l1", "l2"), ("subtotal", "l3", "l4"))]))
    rows = files.select("krs", "document_ref", "fiscal_year", "kind", "assets", each.alias("c")).select("*", "c.*").drop("c")
    rows = rows.withColumn("difference", F.col("a") - F.col("b")).withColumn("status", quality.check_status(F.col("a"), F.col("b"), F.lit(20000)))
    return rows.withColumn("severity", quality.severity(F.col("status"), F.col("check_name"), F.col("kind"), F.col("difference"), F.col("assets")))


@QUERIES.query(f"WITH {CHECKS} SELECT krs, document_ref, kind, check_name, status, severity FROM judged")
def identity_checks(t: Tables) -> DataFrame:
    return _checks(t).select("krs", "document_ref", "kind", "check_name", "status", "severity")


@QUERIES.query(f"WITH {CHECKS} SELECT krs, document_ref, CASE WHEN bool_or(coalesce(severity = 'material', false)) THEN 'quarantined' WHEN bool_or(status = 'fail') THEN 'warn' ELSE 'pass' END AS quality_grade, count(*) FILTER (WHERE status = 'fail') AS failed FROM judged GROUP BY krs, document_ref")
def graded_files(t: Tables) -> DataFrame:
    return quality.grades(_checks(t), ["krs", "document_ref"])


RATES = f"""WITH {CHECKS}, once AS (SELECT check_name, fiscal_year, document_ref, krs, bool_or(status = 'fail') AS failed, bool_or(coalesce(severity = 'material', false)) AS material, bool_and(status = 'not_applicable') AS nothing FROM judged GROUP BY ALL),
counted AS (SELECT check_name, fiscal_year, count(*) AS files, count(*) FILTER (WHERE failed) AS files_failed, count(*) FILTER (WHERE material) AS files_material, count(*) FILTER (WHERE nothing) AS files_not_applicable, count(*) FILTER (WHERE NOT failed AND NOT nothing) AS files_passed, count(DISTINCT krs) AS entities FROM once GROUP BY ALL),
rated AS (SELECT *, CAST(files_passed AS DOUBLE) / nullif(CAST(files_passed + files_failed AS DOUBLE), 0) AS pass_rate FROM counted)"""


@QUERIES.query(RATES + " SELECT *, false AS suppressed FROM rated")
def dq_pass_rates(t: Tables) -> DataFrame:
    return quality.pass_rates(_checks(t), ["document_ref"], ["check_name", "fiscal_year"], "krs", None)


@QUERIES.query(RATES + ", s AS (SELECT *, entities < 600 AS suppressed FROM rated) SELECT check_name, fiscal_year, files, CASE WHEN NOT suppressed THEN files_failed END AS files_failed, CASE WHEN NOT suppressed THEN files_material END AS files_material, CASE WHEN NOT suppressed THEN files_not_applicable END AS files_not_applicable, CASE WHEN NOT suppressed THEN files_passed END AS files_passed, entities, CASE WHEN NOT suppressed THEN pass_rate END AS pass_rate, suppressed FROM s")
def dq_suppressed(t: Tables) -> DataFrame:
    return quality.pass_rates(_checks(t), ["document_ref"], ["check_name", "fiscal_year"], "krs", 600)


@QUERIES.query("""SELECT CAST(year(f.period_end) AS INT) AS fiscal_year, count(*) AS files, count(*) FILTER (WHERE status = 'valid') AS valid, count(*) FILTER (WHERE status = 'quarantined') AS quarantined, count(*) FILTER (WHERE status = 'needs_pdf_tier') AS needs_pdf_tier,
count(*) FILTER (WHERE status = 'needs_pdf_tier' AND NOT EXISTS (SELECT 1 FROM filing l WHERE l.krs = f.krs AND l.status <> 'needs_pdf_tier' AND l.period_end > f.period_end)) AS needs_pdf_tier_without_later_filing FROM filing f GROUP BY 1""")
def dq_coverage_by_year(t: Tables) -> DataFrame:
    last = t.filing.groupBy("krs").agg(F.max(F.when(F.col("status") != "needs_pdf_tier", F.col("period_end"))).alias("last_other"))
    rows = t.filing.join(last, "krs")
    pdf = F.col("status") == "needs_pdf_tier"
    alone = pdf & (F.col("last_other").isNull() | (F.col("last_other") <= F.col("period_end")))
    return rows.groupBy(F.year("period_end").alias("fiscal_year")).agg(F.count("*").alias("files"), F.count_if(F.col("status") == "valid").alias("valid"), F.count_if(F.col("status") == "quarantined").alias("quarantined"), F.count_if(pdf).alias("needs_pdf_tier"), F.count_if(alone).alias("needs_pdf_tier_without_later_filing"))


@QUERIES.query("WITH r AS (SELECT krs, document_ref, 'run' || CAST(year(known_from) AS VARCHAR) AS run_id, known_from AS seen_at FROM filing), l AS (SELECT run_id FROM r GROUP BY run_id ORDER BY max(seen_at) DESC, run_id LIMIT 1) SELECT * FROM r WHERE run_id = (SELECT run_id FROM l)")
def latest_run_current_rows(t: Tables) -> DataFrame:
    rows = t.filing.select("krs", "document_ref", F.concat(F.lit("run"), F.year("known_from").cast("string")).alias("run_id"), F.col("known_from").alias("seen_at"))
    return quality.latest_run_rows(rows, "run_id", "seen_at")


#: Prior-year values against the year's own: periods are adjacent where one ends on the day before the other starts.
RESTATED = """own_year AS (SELECT krs, line_item, period_end, known_from AS was_known, document_ref AS was_ref, value AS reported FROM fact WHERE kind = 'current_year'),
restated AS (SELECT n.krs, n.line_item, w.period_end, n.document_ref, n.known_from, w.was_ref AS restated_ref, w.reported, n.value AS restated, CAST(n.value - w.reported AS DECIMAL(21,2)) AS difference
  FROM fact n JOIN own_year w ON w.krs = n.krs AND w.line_item = n.line_item AND w.period_end + 1 = n.period_start AND w.was_known < n.known_from WHERE n.kind = 'prior_year'
  QUALIFY row_number() OVER (PARTITION BY n.krs, n.line_item, w.period_end, n.document_ref, n.known_from, n.value ORDER BY w.was_known DESC, w.was_ref DESC, w.reported DESC) = 1 AND abs(n.value - w.reported) > 0.05)"""


@QUERIES.query(f"WITH {RESTATED} SELECT * FROM restated")
def restatement_events(t: Tables) -> DataFrame:
    return quality.restatements(t.fact)


#: Values a thousandfold in every twentieth file, and one line for each file, column and year, so that years meet often.
UNITS = """units AS (SELECT krs, document_ref, max(known_from) AS known_from, make_date(CAST(year(max(period_end)) AS INT), 1, 1) AS period_start, make_date(CAST(year(max(period_end)) AS INT), 12, 31) AS period_end, line_item, CASE WHEN line_item % 2 = 0 THEN 'prior_year' ELSE 'current_year' END AS kind,
  max(value) * CASE WHEN document_ref % 20 = 0 THEN 1000 ELSE 1 END AS value FROM fact GROUP BY krs, document_ref, line_item)"""


@QUERIES.query(f"""WITH {UNITS}, met AS (SELECT a.document_ref AS a_ref, b.document_ref AS b_ref, abs(log10(abs(CAST(a.value AS DOUBLE) / CAST(b.value AS DOUBLE)))) AS apart FROM units a JOIN units b ON b.krs = a.krs AND (b.line_item + 1) // 2 = (a.line_item + 1) // 2 AND a.period_end + 1 = b.period_start AND a.known_from < b.known_from
  WHERE a.kind = 'current_year' AND b.kind = 'prior_year' AND a.value <> 0 AND b.value <> 0)
SELECT a_ref, b_ref, count(*) AS n_lines, CAST(count(*) FILTER (WHERE abs(apart - 3) <= 0.5) AS DOUBLE) / count(*) AS share, round(median(apart), 9) AS median_apart FROM met GROUP BY ALL HAVING count(*) >= 2 AND count(*) FILTER (WHERE abs(apart - 3) <= 0.5) >= 0.5 * count(*)""")
def unit_suspect_pairs(t: Tables) -> DataFrame:
    """Files whose own year and the next file's column for it lie about a thousandfold apart."""
    ref, line = F.col("document_ref"), F.col("line_item")
    year = F.year(F.max("period_end"))
    units = t.fact.groupBy("krs", "document_ref", "line_item").agg(
        F.max("known_from").alias("known_from"), F.make_date(year, F.lit(1), F.lit(1)).alias("period_start"), F.make_date(year, F.lit(12), F.lit(31)).alias("period_end"), F.max("value").alias("value")
    )
    units = units.withColumns({"value": F.col("value") * F.when(ref % 20 == 0, 1000).otherwise(1), "kind": F.when(line % 2 == 0, "prior_year").otherwise("current_year"), "line_item": F.floor((line + 1) / 2)})
    return quality.unit_suspects(quality.double_reported(units), 2, 0.5, 0.5).withColumn("median_apart", F.round("median_apart", 9))


METRICS = """WITH r AS (SELECT stratum, doc_id, probability AS p, y, weight AS w FROM prediction), g AS (SELECT stratum, p, sum(w * y) AS pos, sum(w * (1 - y)) AS neg FROM r GROUP BY ALL), a AS (SELECT stratum, sum(pos * (below + neg / 2)) / nullif(sum(pos) * sum(neg), 0) AS auc FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY stratum ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g) GROUP BY stratum),
t AS (SELECT stratum, y, w, sum(w) OVER (PARTITION BY stratum) / 10 AS goal, coalesce(sum(w) OVER (PARTITION BY stratum ORDER BY p DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r), d AS (SELECT stratum, sum(least(greatest(goal - before, 0), w) * y) / max(goal) AS top_decile FROM t GROUP BY stratum)
SELECT r.stratum, count(*) AS n, CAST(sum(y) AS BIGINT) AS events, round(sum(w * y) / sum(w), 9) AS base_rate, round(sum(w * (p - y) * (p - y)) / sum(w), 9) AS brier, round(-sum(w * CASE WHEN y = 1 THEN ln(p) ELSE ln(1 - p) END) / sum(w), 9) AS log_loss, round(any_value(a.auc), 9) AS auc, round(any_value(d.top_decile), 9) AS top_decile FROM r JOIN a USING (stratum) JOIN d USING (stratum) GROUP BY r.stratum"""


@QUERIES.query(METRICS)
def metrics_weighted(t: Tables) -> DataFrame:
    out = evaluation.metrics(t.prediction, ["stratum"], w=F.col("weight"), tie=["doc_id"])
    return out.withColumns({c: F.round(c, 9) for c in ("base_rate", "brier", "log_loss", "auc", "top_decile")})


@QUERIES.query("SELECT CAST(least(floor(probability * 10), 9) AS INT) AS bin, count(*) AS n, CAST(sum(y) AS BIGINT) AS events, round(sum(weight * probability) / sum(weight), 9) AS mean_score, round(sum(weight * y) / sum(weight), 9) AS rate FROM prediction GROUP BY 1")
def reliability_bins(t: Tables) -> DataFrame:
    return evaluation.reliability(t.prediction, w=F.col("weight")).withColumns({c: F.round(c, 9) for c in ("mean_score", "rate")})


@QUERIES.query()
def bootstrap_brier(t: Tables) -> DataFrame:
    return evaluation.bootstrap_brier(t.prediction, "krs")


@QUERIES.query("""WITH s AS (SELECT CAST(n_chars AS DOUBLE) AS x, doc_id % 2 AS side FROM documents), e AS (SELECT unnest(quantile_cont(x, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])) AS e FROM s WHERE side = 0), c AS (SELECT (SELECT count(DISTINCT e) FROM e WHERE e < x) AS bin, count(*) FILTER (WHERE side = 0) AS a, count(*) FILTER (WHERE side = 1) AS b FROM s GROUP BY 1),
q AS (SELECT greatest(a / sum(a) OVER (), 1e-4) AS a, greatest(b / sum(b) OVER (), 1e-4) AS b FROM c), k AS (SELECT max(abs(ca - cb)) AS ks FROM (SELECT sum(a) OVER (ORDER BY x) / sum(a) OVER () AS ca, sum(b) OVER (ORDER BY x) / sum(b) OVER () AS cb FROM (SELECT x, CAST(count(*) FILTER (WHERE side = 0) AS DOUBLE) AS a, CAST(count(*) FILTER (WHERE side = 1) AS DOUBLE) AS b FROM s GROUP BY x)))
SELECT round(sum((b - a) * ln(b / a)), 9) AS psi, (SELECT round(ks, 9) FROM k) AS ks FROM q""")
def score_psi_ks(t: Tables) -> DataFrame:
    rows = t.documents.select(F.col("n_chars").cast("double").alias("x"), (F.col("doc_id") % 2).alias("side"))
    shift = evaluation.population_shift(rows.filter("side = 0"), rows.filter("side = 1"), "x")
    return shift.withColumns({"psi": F.round("psi", 9), "ks": F.round("ks", 9)})


@QUERIES.query("WITH s AS (SELECT krs AS source, count(*) AS n, CAST(sum(y) AS BIGINT) AS k FROM prediction GROUP BY 1), z AS (SELECT 1.959963984540054::DOUBLE AS z) SELECT source, n, k, round(greatest((k / n + z * z / (2 * n)) / (1 + z * z / n) - z * sqrt((k / n) * (1 - k / n) / n + z * z / (4 * n * n)) / (1 + z * z / n), 0.0), 9) AS low, round(least((k / n + z * z / (2 * n)) / (1 + z * z / n) + z * sqrt((k / n) * (1 - k / n) / n + z * z / (4 * n * n)) / (1 + z * z / n), 1.0), 9) AS high FROM s, z")
def wilson_interval(t: Tables) -> DataFrame:
    rows = t.prediction.groupBy(F.col("krs").alias("source")).agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("k"))
    low, high = evaluation.wilson(F.col("k"), F.col("n").cast("double"))
    return rows.select("source", "n", "k", F.round(low, 9).alias("low"), F.round(high, 9).alias("high"))


@QUERIES.query("WITH c AS (SELECT krs, CAST(sum(y) AS DOUBLE) AS a, CAST(count(*) AS DOUBLE) AS b FROM prediction GROUP BY krs), r AS (SELECT sum(a) / sum(b) AS ratio, count(*) AS clusters, sum(b) AS b FROM c), u AS (SELECT sum((a - ratio * c.b) * (a - ratio * c.b)) AS uu FROM c, r) SELECT round(ratio, 9) AS ratio, clusters, round(ratio - 1.959963984540054 * sqrt(clusters / (clusters - 1) * uu) / b, 9) AS low, round(ratio + 1.959963984540054 * sqrt(clusters / (clusters - 1) * uu) / b, 9) AS high FROM r, u")
def clustered_ratio(t: Tables) -> DataFrame:
    out = evaluation.clustered_ratio(t.prediction, "krs", F.col("y"), F.lit(1))
    return out.withColumns({c: F.round(c, 9) for c in ("ratio", "low", "high")})


@QUERIES.query("SELECT segment, krs, row_number() OVER w AS position, least(20, n) AS pi_numerator, n AS pi_denominator FROM (SELECT *, count(*) OVER (PARTITION BY segment) AS n FROM entity) WINDOW w AS (PARTITION BY segment ORDER BY sha256('draw-1:' || krs), krs) QUALIFY row_number() OVER w <= 20")
def draw_permutation(t: Tables) -> DataFrame:
    return modelling.permutation_draw(t.entity.select("segment", "krs"), "segment", "krs", 20, "draw-1")


@QUERIES.query("SELECT krs, CAST(place AS INT) AS place, CAST(pick AS BIGINT) AS pick FROM (SELECT krs, row_number() OVER (ORDER BY krs) - 1 AS place FROM entity) p JOIN (SELECT i AS pick, floor(2.5 + i * 17.25) AS at_place FROM range(0, 100000) r(i)) q ON q.at_place = p.place")
def systematic_picks(t: Tables) -> DataFrame:
    return modelling.systematic_picks(t.entity.select("krs"), "krs", 2.5, 17.25)


@QUERIES.query("WITH d AS (SELECT segment, krs, row_number() OVER (PARTITION BY segment ORDER BY sha256('draw-1:' || krs), krs) AS k, count(*) OVER (PARTITION BY segment) AS n, balance > 0 AS responded FROM entity), b AS (SELECT *, n / least(40, n) AS base FROM d WHERE k <= 40), f AS (SELECT *, sum(base) OVER (PARTITION BY segment) / sum(CASE WHEN responded THEN base END) OVER (PARTITION BY segment) AS factor FROM b) SELECT krs, segment, round(base * factor, 9) AS weight FROM f WHERE responded")
def draw_weights(t: Tables) -> DataFrame:
    draw = modelling.permutation_draw(t.entity, "segment", "krs", 40, "draw-1").join(t.entity.select("krs", (F.col("balance") > 0).alias("responded")), "krs")
    return modelling.nonresponse_weights(draw, "responded", ["segment"]).select("krs", "segment", F.round("weight", 9).alias("weight"))


@QUERIES.query("WITH n AS (SELECT krs, count(*) AS n, count(*) FILTER (WHERE status = 'valid') AS valid FROM filing GROUP BY krs) SELECT e.krs, CASE WHEN n.krs IS NULL THEN 'never_filed' WHEN n.valid = 0 THEN 'no_valid_statement' WHEN n.n < 5 THEN 'short_history' WHEN e.balance < 0 THEN 'negative_balance' END AS left_out FROM entity e LEFT JOIN n ON n.krs = e.krs")
def population_reasons(t: Tables) -> DataFrame:
    counts = t.filing.groupBy("krs").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "valid").alias("valid"))
    rules = [("never_filed", F.col("n").isNull()), ("no_valid_statement", F.col("valid") == 0), ("short_history", F.col("n") < 5), ("negative_balance", F.col("balance") < 0)]
    return modelling.population(t.entity.join(counts, "krs", "left"), rules).select("krs", "left_out")


@QUERIES.query("WITH r AS (SELECT krs, min(day0) AS start, max(day0) AS ended_on, bool_or(hit) AS event FROM (SELECT lpad(CAST(user_id AS VARCHAR), 10, '0') AS krs, DATE '2019-01-31' + CAST(event_id % 700 AS INT) AS day0, event_type = 'error' AND event_id % 90 = 1 AS hit FROM events) GROUP BY krs), m AS (SELECT *, (year(ended_on) * 12 + month(ended_on)) - (year(start) * 12 + month(start)) AS months FROM r) SELECT krs, start, CAST(k AS INT) AS month, CAST(event AND months <= 24 AND k = least(months, 24) AS INT) AS event FROM m, range(1, 25) t(k) WHERE k <= least(months, 24)")
def person_periods(t: Tables) -> DataFrame:
    day = F.date_add(F.to_date(F.lit("2019-01-31")), (F.col("event_id") % 700).cast("int"))
    rows = t.events.select(F.lpad(F.col("user_id").cast("string"), 10, "0").alias("krs"), day.alias("day0"), ((F.col("event_type") == "error") & (F.col("event_id") % 90 == 1)).alias("hit"))
    records = rows.groupBy("krs").agg(F.min("day0").alias("start"), F.max("day0").alias("ended_on"), F.bool_or("hit").alias("event"))
    return modelling.person_periods(records, 24)


@QUERIES.query("WITH h AS (SELECT CAST(doc_id % 24 + 1 AS INT) AS month, count(*) AS at_risk, count(*) FILTER (WHERE doc_id % 31 = 0) AS events FROM documents GROUP BY 1) SELECT month, at_risk, events, CAST(events AS DOUBLE) / at_risk AS hazard, round(exp(sum(ln(1 - CAST(events AS DOUBLE) / at_risk)) OVER (ORDER BY month)), 9) AS survival FROM h")
def survival_curve(t: Tables) -> DataFrame:
    periods = t.documents.select((F.col("doc_id") % 24 + 1).cast("int").alias("month"), (F.col("doc_id") % 31 == 0).cast("int").alias("event"), F.lit(1).alias("one"))
    return modelling.survival_curve(periods, ["one"]).drop("one").withColumn("survival", F.round("survival", 9))


@QUERIES.query("SELECT c_custkey AS custkey, round(-2.368 + 3.562 * (c_acctbal / 10000.0) + 1.588 * (c_nationkey / 25.0), 9) AS score, CASE WHEN -2.368 + 3.562 * (c_acctbal / 10000.0) + 1.588 * (c_nationkey / 25.0) < 0 THEN 'at_risk' ELSE 'sound' END AS zone FROM customer")
def classical_score_zone(t: Tables) -> DataFrame:
    rows = t.customer.select(F.col("c_custkey").alias("custkey"), (F.col("c_acctbal") / 10000.0).alias("roa"), (F.col("c_nationkey") / 25.0).alias("quick_ratio"))
    score, zone = modelling.linear_score(-2.368, {"roa": 3.562, "quick_ratio": 1.588}, [("at_risk", None, 0.0), ("sound", 0.0, None)])
    return rows.select("custkey", F.round(score, 9).alias("score"), zone.alias("zone"))


@QUERIES.query("WITH t AS (SELECT balance AS x FROM entity WHERE nation < 12), n AS (SELECT count(*) AS n FROM t) SELECT e.krs, round(((SELECT count(*) FROM t WHERE x < e.balance) + (SELECT count(*) FROM t WHERE x <= e.balance)) / (2.0 * n.n), 9) AS mid_rank FROM entity e, n")
def mid_rank_among_training(t: Tables) -> DataFrame:
    out = modelling.mid_rank(t.entity.filter("nation < 12"), t.entity.select("krs", "balance"), "balance", "mid_rank")
    return out.select("krs", F.round("mid_rank", 9).alias("mid_rank"))


ALERTS = "WITH s AS (SELECT *, lag(probability) OVER (PARTITION BY krs, horizon_months, model_name ORDER BY as_of_date) AS before FROM score)"


@QUERIES.query(ALERTS + ", a AS (SELECT krs, as_of_date, probability, before, CASE WHEN coalesce(before, 0) < 0.9 AND probability >= 0.9 THEN 'high' WHEN coalesce(before, 0) < 0.6 AND probability >= 0.6 THEN 'medium' END AS severity FROM s) SELECT *, sha256('threshold_crossed|' || krs || '|' || CAST(as_of_date AS VARCHAR)) AS alert_id FROM a WHERE severity IS NOT NULL")
def score_threshold_alerts(t: Tables) -> DataFrame:
    rows = serving.threshold_alerts(t.score, [(0.9, "high"), (0.6, "medium")])
    return rows.select("krs", "as_of_date", "probability", "before", "severity", serving.alert_id(F.col("rule"), F.col("krs"), F.col("as_of_date")).alias("alert_id"))


@QUERIES.query(ALERTS + " SELECT krs, as_of_date, probability, before FROM s WHERE probability - before >= 0.1 AND probability >= 2 * before")
def score_jump_alerts(t: Tables) -> DataFrame:
    return serving.jump_alerts(t.score, 0.1, 2.0).select("krs", "as_of_date", "probability", "before")


@QUERIES.query(ALERTS + ", f AS (SELECT krs, as_of_date, probability > 0.7 AS on_now, lag(probability > 0.7) OVER (PARTITION BY krs ORDER BY as_of_date) AS was, row_number() OVER (PARTITION BY krs ORDER BY as_of_date) AS n FROM score) SELECT krs, as_of_date, 'risky' AS flag FROM f WHERE on_now AND n > 1 AND NOT coalesce(was, false)")
def flag_turned_alerts(t: Tables) -> DataFrame:
    return serving.flag_alerts(t.score.select("krs", "as_of_date", (F.col("probability") > 0.7).alias("risky")), ["risky"])


@QUERIES.query("""WITH st AS (SELECT krs, period_end, known_from AS submission_date FROM filing WHERE status = 'valid' AND known_from < DATE '1999-01-01'), se AS (SELECT DISTINCT krs, known_from AS searched_on FROM filing), l AS (SELECT krs, max(period_end) AS last_end FROM st GROUP BY krs), d AS (SELECT krs, CAST(last_end + INTERVAL 12 MONTH AS DATE) AS due_end FROM l),
x AS (SELECT krs, due_end, CAST(CASE WHEN due_end = last_day(due_end) THEN last_day(due_end + INTERVAL 6 MONTH) ELSE due_end + INTERVAL 6 MONTH END AS DATE) + 15 AS deadline FROM d), f AS (SELECT x.krs, x.due_end, x.deadline, min(searched_on) AS searched_on FROM x JOIN se ON se.krs = x.krs AND se.searched_on > x.deadline GROUP BY ALL)
SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM st WHERE st.krs = f.krs AND st.period_end = f.due_end AND st.submission_date <= f.searched_on)""")
def filing_overdue_alerts(t: Tables) -> DataFrame:
    statements = t.filing.filter("status = 'valid' and known_from < '1999-01-01'").select("krs", "period_end", F.col("known_from").alias("submission_date"))
    return serving.overdue_alerts(statements, t.filing.select("krs", F.col("known_from").alias("searched_on")).distinct())


@QUERIES.query("WITH a AS (SELECT krs, as_of_date, CASE WHEN probability >= 0.9 THEN 'high' WHEN probability >= 0.5 THEN 'medium' ELSE 'low' END AS severity FROM score) SELECT * FROM a ORDER BY list_position(['high', 'medium'], severity) NULLS LAST, as_of_date DESC, krs LIMIT 50")
def alerts_listing(t: Tables) -> DataFrame:
    """A page of alerts: the limit is the feature."""
    severity = F.when(F.col("probability") >= 0.9, "high").when(F.col("probability") >= 0.5, "medium").otherwise("low")
    return serving.alerts_listing(t.score.select("krs", "as_of_date", severity.alias("severity")), ["high", "medium"], limit=50)


@QUERIES.query("SELECT DISTINCT 'krs' AS \"column\", f.krs AS word FROM filing f JOIN entity e ON e.krs = f.krs")
def publish_leak_check(t: Tables) -> DataFrame:
    """Every filing as it would be published, against the identifiers of every entity."""
    published = t.filing.select("krs", F.concat_ws(" ", F.lit("ref"), F.col("document_ref").cast("string")).alias("note"))
    return serving.leaks(published, t.entity.select("krs"), "krs").select("column", "word")


@QUERIES.query("SELECT krs, tier, reason FROM (SELECT e.krs, CASE WHEN s.last_searched IS NULL THEN 0 WHEN s.last_searched < DATE '2001-01-01' THEN 1 WHEN s.n_bad > 3 THEN 2 END AS tier, CASE WHEN s.last_searched IS NULL THEN 'never' WHEN s.last_searched < DATE '2001-01-01' THEN 'stale' WHEN s.n_bad > 3 THEN 'broken' END AS reason FROM entity e LEFT JOIN (SELECT krs, max(known_from) AS last_searched, count(*) FILTER (WHERE status = 'quarantined') AS n_bad FROM filing GROUP BY krs) s ON s.krs = e.krs) WHERE tier IS NOT NULL")
def research_queue(t: Tables) -> DataFrame:
    seen = t.filing.groupBy("krs").agg(F.max("known_from").alias("last_searched"), F.count_if(F.col("status") == "quarantined").alias("n_bad"))
    tiers = [("never", F.col("last_searched").isNull()), ("stale", F.col("last_searched") < F.lit("2001-01-01").cast("date")), ("broken", F.col("n_bad") > 3)]
    return serving.search_queue(t.entity.join(seen, "krs", "left"), "2002-01-01", tiers).select("krs", "tier", "reason")


@QUERIES.query("SELECT as_of_date, count(*) AS n, round(avg(probability), 9) AS mean_score, quantile_cont(probability, 0.5) AS median_score, count(*) FILTER (WHERE probability >= 0.9) AS high FROM score GROUP BY as_of_date")
def month_end_summary(t: Tables) -> DataFrame:
    return t.score.groupBy("as_of_date").agg(F.count("*").alias("n"), F.round(F.avg("probability"), 9).alias("mean_score"), F.percentile("probability", 0.5).alias("median_score"), F.count_if(F.col("probability") >= 0.9).alias("high"))
