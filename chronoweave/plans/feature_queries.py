"""Queries over the panel, features and the feature store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators import features, panel
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book

QUERIES = Book()

#: Statements of each entity and year, from filings; a statement's year starts where the one before ended.
STATEMENTS = """statements AS (
  SELECT krs, document_ref, CAST(year(period_end) AS INT) AS fiscal_year, make_date(CAST(year(period_end) AS INT), 1, 1) AS period_start, make_date(CAST(year(period_end) AS INT), 12, 31) AS period_end, known_from, deleted_on, is_correction,
         CASE WHEN status = 'quarantined' THEN 'quarantined' ELSE 'pass' END AS quality_grade, CAST(CASE WHEN document_ref % 5 <> 0 THEN total END AS DECIMAL(20,2)) AS prior_assets FROM filing
)"""

PANEL = STATEMENTS + """, found AS (
  SELECT krs, document_ref, period_end, known_from, deleted_on, CASE WHEN is_correction THEN 'correction' ELSE 'filed' END AS kind, CAST(is_correction AS INT) AS rank FROM statements WHERE quality_grade <> 'quarantined'
  UNION ALL SELECT krs, document_ref, CAST(period_start - INTERVAL 1 DAY AS DATE), known_from, deleted_on, 'comparative', CAST(is_correction AS INT) + 2 FROM statements WHERE quality_grade <> 'quarantined' AND prior_assets IS NOT NULL AND prior_assets <> 0
), live AS (
  SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY krs, period_end, known_from, rank) AS n FROM found) WHERE n = 1 AND (deleted_on IS NULL OR deleted_on > known_from)
), days AS (
  SELECT krs, period_end, known_from AS day FROM live UNION SELECT krs, period_end, deleted_on FROM live WHERE deleted_on IS NOT NULL
), daily AS (
  SELECT d.krs, d.period_end, d.day,
    (SELECT c.kind FROM live c WHERE c.krs = d.krs AND c.period_end = d.period_end AND c.known_from <= d.day AND (c.deleted_on IS NULL OR c.deleted_on > d.day) ORDER BY c.kind <> 'comparative' DESC, c.known_from DESC, c.rank DESC LIMIT 1) AS kind,
    (SELECT c.document_ref FROM live c WHERE c.krs = d.krs AND c.period_end = d.period_end AND c.known_from <= d.day AND (c.deleted_on IS NULL OR c.deleted_on > d.day) ORDER BY c.kind <> 'comparative' DESC, c.known_from DESC, c.rank DESC LIMIT 1) AS document_ref
  FROM days d
), panel AS (
  SELECT krs, period_end, day AS known_from, coalesce(kind, 'withdrawn') AS kind, coalesce(document_ref, before_ref) AS document_ref
  FROM (SELECT *, lag(kind) OVER w AS before_kind, lag(document_ref) OVER w AS before_ref, row_number() OVER w AS k FROM daily WINDOW w AS (PARTITION BY krs, period_end ORDER BY day))
  WHERE (k = 1 AND kind IS NOT NULL) OR (k > 1 AND (kind IS DISTINCT FROM before_kind OR document_ref IS DISTINCT FROM before_ref))
)"""

VALUES = """, vals AS (
  SELECT document_ref, CAST(sum(value) FILTER (WHERE line_item <= 3) AS DECIMAL(20,2)) AS assets, CAST(sum(value) FILTER (WHERE line_item = 1) AS DECIMAL(20,2)) AS equity, CAST(sum(value * CASE WHEN line_item % 2 = 0 THEN 1 ELSE -1 END) AS DECIMAL(20,2)) AS profit FROM fact GROUP BY document_ref
), snaps AS (
  SELECT d.krs, d.known_on, p.period_end, arg_max(p.kind, p.known_from) AS kind, arg_max(p.document_ref, p.known_from) AS document_ref
  FROM (SELECT DISTINCT krs, known_from AS known_on FROM panel) d JOIN panel p ON p.krs = d.krs AND p.known_from <= d.known_on GROUP BY ALL
), filled AS (
  SELECT s.krs, s.known_on, s.period_end, s.kind, s.document_ref, v.assets, v.equity, v.profit FROM snaps s JOIN vals v ON v.document_ref = s.document_ref WHERE s.kind <> 'withdrawn'
), lasts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY krs, known_on ORDER BY period_end DESC) AS k FROM filled) WHERE k = 1
)"""

GRID_DAYS = ("1997-06-30", "1999-03-31", "2000-12-31")
DAYS = "days_at AS (SELECT CAST(unnest([DATE '1997-06-30', DATE '1999-03-31', DATE '2000-12-31']) AS DATE) AS as_of_date), grid_rows AS (SELECT e.krs, d.as_of_date FROM entity e CROSS JOIN days_at d)"


def _statements(t: Tables) -> DataFrame:
    year = F.year("period_end")
    return t.filing.select(
        "krs", "document_ref", year.alias("fiscal_year"), F.make_date(year, F.lit(1), F.lit(1)).alias("period_start"), F.make_date(year, F.lit(12), F.lit(31)).alias("period_end"), "known_from", "deleted_on", "is_correction",
        F.when(F.col("status") == "quarantined", "quarantined").otherwise("pass").alias("quality_grade"), F.when(F.col("document_ref") % 5 != 0, F.col("total")).cast("decimal(20,2)").alias("prior_assets"),
    )


def _panel(t: Tables) -> DataFrame:
    return panel.versions(panel.candidates(_statements(t)))


def _filled(t: Tables) -> DataFrame:
    odd = F.when(F.col("line_item") % 2 == 0, 1).otherwise(-1)
    values = t.fact.groupBy("document_ref").agg(
        F.sum(F.when(F.col("line_item") <= 3, F.col("value"))).cast("decimal(20,2)").alias("assets"), F.sum(F.when(F.col("line_item") == 1, F.col("value"))).cast("decimal(20,2)").alias("equity"),
        F.sum(F.col("value") * odd).cast("decimal(20,2)").alias("profit"),
    )
    return panel.snapshots(_panel(t)).join(values, "document_ref").drop("known_from")


def _grid(t: Tables) -> DataFrame:
    return t.entity.select("krs", F.explode(F.array(*[F.to_date(F.lit(d)) for d in GRID_DAYS])).alias("as_of_date"))


@QUERIES.query(f"WITH {PANEL} SELECT * FROM panel")
def panel_versions(t: Tables) -> DataFrame:
    return _panel(t)


@QUERIES.query(f"WITH {PANEL}{VALUES} SELECT krs, known_on, period_end, document_ref, round(CASE WHEN assets <> 0 THEN CAST(equity AS DOUBLE) / CAST(assets AS DOUBLE) END, 9) AS equity_to_assets, round(CASE WHEN equity > 0 THEN CAST(profit - equity AS DOUBLE) / CAST(equity AS DOUBLE) * 100.0 END, 9) AS margin FROM lasts")
def snapshot_ratios(t: Tables) -> DataFrame:
    rows = panel.latest_period(_filled(t))
    return rows.select("krs", "known_on", "period_end", "document_ref", F.round(panel.signed_ratio([(1, "equity")], [(1, "assets")]), 9).alias("equity_to_assets"), F.round(panel.signed_ratio([(1, "profit"), (-1, "equity")], [(1, "equity")], True, 100.0), 9).alias("margin"))


@QUERIES.query(f"""WITH {PANEL}{VALUES}, pairs AS (SELECT l.krs, l.known_on, l.period_end, l.assets AS now, f.assets AS past, row_number() OVER (PARTITION BY l.krs, l.known_on ORDER BY abs(f.period_end - CAST(l.period_end - INTERVAL 12 MONTH AS DATE)), f.period_end) AS k
  FROM lasts l JOIN filled f ON f.krs = l.krs AND f.known_on = l.known_on AND abs(f.period_end - CAST(l.period_end - INTERVAL 12 MONTH AS DATE)) <= 31)
SELECT l.krs, l.known_on, l.period_end, round(CASE WHEN p.past > 0 THEN (CAST(p.now AS DOUBLE) - CAST(p.past AS DOUBLE)) / CAST(p.past AS DOUBLE) END, 9) AS growth FROM lasts l LEFT JOIN pairs p ON p.krs = l.krs AND p.known_on = l.known_on AND p.k = 1""")
def assets_growth(t: Tables) -> DataFrame:
    return panel.growth(_filled(t), "assets", 1).withColumn("growth", F.round("growth", 9))


@QUERIES.query(f"""WITH {PANEL}{VALUES} SELECT l.krs, l.known_on, l.period_end, round(stddev_samp(CAST(f.assets AS DOUBLE)), 4) AS volatility FROM lasts l JOIN filled f ON f.krs = l.krs AND f.known_on = l.known_on AND f.period_end <= l.period_end AND f.period_end > CAST(l.period_end - INTERVAL 36 MONTH AS DATE)
GROUP BY ALL HAVING count(*) = 3 AND count(f.assets) = 3""")
def assets_volatility(t: Tables) -> DataFrame:
    return panel.volatility(_filled(t), "assets", 3).withColumn("volatility", F.round("volatility", 4))


@QUERIES.query("WITH v AS (SELECT document_ref, CAST(sum(value) FILTER (WHERE line_item = 1) AS DECIMAL(20,2)) AS equity, CAST(sum(value) FILTER (WHERE line_item = 2) AS DECIMAL(20,2)) AS reserve, CAST(sum(value) FILTER (WHERE line_item = 3) AS DECIMAL(20,2)) - CAST(sum(value) FILTER (WHERE line_item <= 2) AS DECIMAL(20,2)) AS result FROM fact GROUP BY 1) SELECT document_ref, CASE WHEN result IS NOT NULL AND reserve IS NOT NULL AND equity IS NOT NULL THEN -result * 3 > reserve * 3 + equity END AS tripped FROM v")
def tripwire_exact(t: Tables) -> DataFrame:
    line = lambda test: F.sum(F.when(test, F.col("value"))).cast("decimal(20,2)")
    item = F.col("line_item")
    values = t.fact.groupBy("document_ref").agg(line(item == 1).alias("equity"), line(item == 2).alias("reserve"), (line(item == 3) - line(item <= 2)).alias("result"))
    return values.select("document_ref", panel.tripwire(["result"], [(1, 1, "reserve"), (1, 3, "equity")]).alias("tripped"))


FILING_SQL = f"""WITH {DAYS}, seen AS (
  SELECT g.krs, g.as_of_date, f.* EXCLUDE (krs), CAST(last_day(f.period_end + INTERVAL 6 MONTH) AS DATE) + 15 AS deadline FROM grid_rows g JOIN filing f ON f.krs = g.krs AND f.known_from <= g.as_of_date AND (f.deleted_on IS NULL OR f.deleted_on > g.as_of_date)
), m AS (SELECT krs, as_of_date, CAST(arg_max(known_from - period_end, (period_end, known_from, document_ref)) AS DOUBLE) AS days_to_file,
  CAST(count(*) FILTER (WHERE known_from > deadline AND known_from > as_of_date - INTERVAL 36 MONTH) AS DOUBLE) AS late_filings, CAST(count(*) FILTER (WHERE is_correction AND known_from > as_of_date - INTERVAL 36 MONTH) AS DOUBLE) AS corrections,
  CAST(count(*) FILTER (WHERE status = 'quarantined') AS DOUBLE) AS statements_quarantined, CAST(arg_max(CASE WHEN status = 'needs_pdf_tier' THEN 1 ELSE 0 END, (period_end, known_from, document_ref)) AS DOUBLE) AS latest_filed_as_pdf, max(known_from) AS known_from,
  min(year(period_end)) AS first_year, year(CAST(as_of_date - 15 - INTERVAL 18 MONTH AS DATE)) + 1 AS due, count(DISTINCT year(period_end)) FILTER (WHERE year(period_end) <= year(CAST(as_of_date - 15 - INTERVAL 18 MONTH AS DATE)) + 1) AS held FROM seen GROUP BY krs, as_of_date)"""


@QUERIES.query(FILING_SQL + " SELECT krs, as_of_date, days_to_file, late_filings, corrections, statements_quarantined, latest_filed_as_pdf, known_from, CAST(greatest(due - first_year + 1, 0) - held AS DOUBLE) AS missing_years FROM m")
def filing_metrics(t: Tables) -> DataFrame:
    return features.filing_metrics(_grid(t), t.filing)


TYPES = ["bankruptcy_petition", "board_changed", "liquidation_opened"]
EVENTS_SQL = """WITH seen_from AS (SELECT krs, min(fetched_on) - 900 AS seen_on FROM fetches GROUP BY krs), days_in AS (SELECT s.krs, s.seen_on, CAST(unnest([DATE '2018-03-31', DATE '2019-06-30']) AS DATE) AS as_of_date FROM seen_from s),
firsts AS (SELECT krs, event_type, coalesce(event_date, known_from) AS happened, min(known_from) AS known_from FROM legal GROUP BY ALL), types AS (SELECT unnest(['bankruptcy_petition', 'board_changed', 'liquidation_opened']) AS event_type),
long_values AS (SELECT a.krs, a.as_of_date, t.event_type || '_24m' AS feature, CASE WHEN a.seen_on <= a.as_of_date THEN CAST(count(f.krs) AS DOUBLE) END AS value, max(f.known_from) AS known_from
FROM days_in a CROSS JOIN types t LEFT JOIN firsts f ON f.krs = a.krs AND f.event_type = t.event_type AND f.known_from <= a.as_of_date AND f.known_from > a.as_of_date - INTERVAL 24 MONTH GROUP BY a.krs, a.as_of_date, a.seen_on, t.event_type)"""


def _event_values(t: Tables) -> tuple[DataFrame, DataFrame]:
    seen = t.fetches.groupBy("krs").agg(F.date_sub(F.min("fetched_on"), 900).alias("seen_on"))
    grid = seen.select("krs", F.explode(F.array(F.to_date(F.lit("2018-03-31")), F.to_date(F.lit("2019-06-30")))).alias("as_of_date"))
    return grid, features.event_counts(grid, t.legal, TYPES, 24, seen)


@QUERIES.query(EVENTS_SQL + " SELECT * FROM long_values")
def event_counts_window(t: Tables) -> DataFrame:
    return _event_values(t)[1]


#: The four metrics as they stand, and as they stood with every later filing and deletion gone.
_FOUR = "[days_to_file, late_filings, corrections, CAST(greatest(due - first_year + 1, 0) - held AS DOUBLE)]"


@QUERIES.query(
    FILING_SQL + ", cut_days AS (SELECT as_of_date AS day FROM days_at), then_filing AS (SELECT c.day, f.* REPLACE (CASE WHEN f.deleted_on <= c.day THEN f.deleted_on END AS deleted_on) FROM filing f JOIN cut_days c ON f.known_from <= c.day), "
    "seen_then AS (SELECT g.krs, g.as_of_date, f.* EXCLUDE (krs, day), CAST(last_day(f.period_end + INTERVAL 6 MONTH) AS DATE) + 15 AS deadline FROM grid_rows g JOIN then_filing f ON f.krs = g.krs AND f.day = g.as_of_date AND f.known_from <= g.as_of_date AND (f.deleted_on IS NULL OR f.deleted_on > g.as_of_date)), m_then AS (SELECT krs, as_of_date, "
    + FILING_SQL.split("m AS (SELECT krs, as_of_date, ", 1)[1].replace("FROM seen ", "FROM seen_then ")
    + f", both_sides AS (SELECT krs, as_of_date, unnest(['days_to_file', 'late_filings', 'corrections', 'missing_years']) AS feature, unnest({_FOUR}) AS value FROM m WHERE as_of_date < DATE '2000-01-01'), then_side AS (SELECT krs, as_of_date, unnest(['days_to_file', 'late_filings', 'corrections', 'missing_years']) AS feature, unnest({_FOUR}) AS value_then FROM m_then WHERE as_of_date < DATE '2000-01-01')"
    " SELECT krs, as_of_date, feature, value, value_then FROM both_sides FULL JOIN then_side USING (krs, as_of_date, feature) WHERE value IS DISTINCT FROM value_then"
)
def truncation_diff(t: Tables) -> DataFrame:
    """The late-filing count, computed from everything and from what was known on the day."""

    def compute(rows: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
        made = features.filing_metrics(rows, sources["filing"])
        return made.unpivot(["krs", "as_of_date"], ["days_to_file", "late_filings", "corrections", "missing_years"], "feature", "value")

    return features.truncation_diff(compute, _grid(t), {"filing": t.filing}, list(GRID_DAYS[:2]))


@QUERIES.query(f"WITH {DAYS}, seen AS (SELECT g.krs, g.as_of_date, f.period_end, f.known_from, f.document_ref, CAST(CASE WHEN f.is_correction THEN 1 ELSE 0 END AS DOUBLE) AS v FROM grid_rows g JOIN filing f ON f.krs = g.krs AND f.known_from <= g.as_of_date AND (f.deleted_on IS NULL OR f.deleted_on > g.as_of_date)), p AS (SELECT krs, as_of_date, period_end, arg_max(v, (known_from, document_ref)) AS v, arg_max(known_from, (known_from, document_ref)) AS known_from FROM seen GROUP BY ALL) SELECT krs, as_of_date, 'latest_corrected' AS feature, arg_max(v, period_end) AS value, arg_max(known_from, period_end) AS known_from FROM p GROUP BY krs, as_of_date")
def latest_disclosure(t: Tables) -> DataFrame:
    return features.latest_flag(_grid(t), t.filing, F.col("is_correction"), "latest_corrected")


@QUERIES.query(FILING_SQL + """, w AS (SELECT g.krs, g.as_of_date, m.days_to_file, m.late_filings, m.corrections FROM grid_rows g LEFT JOIN m ON m.krs = g.krs AND m.as_of_date = g.as_of_date)
SELECT CAST(year(as_of_date) AS INT) AS "group", 'filing' AS family, (count(days_to_file) + count(late_filings)) / (2.0 * count(*)) AS share, count(*) AS n_rows FROM w GROUP BY 1 UNION ALL SELECT CAST(year(as_of_date) AS INT), 'correction', CAST(count(corrections) AS DOUBLE) / count(*), count(*) FROM w GROUP BY 1""")
def coverage_by_family(t: Tables) -> DataFrame:
    grid = _grid(t)
    store = grid.join(features.filing_metrics(grid, t.filing), ["krs", "as_of_date"], "left")
    return features.coverage(store, {"filing": ["days_to_file", "late_filings"], "correction": ["corrections"]}, F.year("as_of_date"))
