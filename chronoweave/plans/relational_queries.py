"""Queries of the relational core: joins, aggregates, windows, orders and sets, over the shared tables and the domain relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions import timeops, values
from chronoweave.operators import temporal
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book

QUERIES = Book()


@QUERIES.query("""WITH days AS (SELECT DISTINCT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS krs, d.as_of_date FROM customer, (SELECT CAST(unnest([DATE '1996-06-30', DATE '1998-06-30', DATE '2000-06-30', DATE '2001-12-31']) AS DATE) AS as_of_date) d),
snaps AS (SELECT krs, known_from, max(document_ref) AS document_ref, sum(total) AS total FROM filing GROUP BY krs, known_from)
SELECT d.krs, d.as_of_date, s.known_from, s.document_ref, round(s.total, 2) AS total FROM days d ASOF JOIN snaps s ON d.krs = s.krs AND d.as_of_date >= s.known_from""")
def asof_latest_snapshot(t: Tables) -> DataFrame:
    days = F.explode(F.array(*[F.to_date(F.lit(d)) for d in ("1996-06-30", "1998-06-30", "2000-06-30", "2001-12-31")]))
    grid = t.entity.select("krs", days.alias("as_of_date"))
    snaps = t.filing.groupBy("krs", "known_from").agg(F.max("document_ref").alias("document_ref"), F.sum("total").alias("total"))
    return temporal.asof_join(grid, snaps, ["krs"], "as_of_date", "known_from", ["document_ref", "total"]).withColumn("total", F.round("total", 2))


@QUERIES.query("SELECT krs, as_of_date, max(known_from) AS known_from, count(*) AS n FROM (SELECT f.krs, d.as_of_date, f.known_from FROM filing f, (SELECT CAST(unnest([DATE '1997-12-31', DATE '1999-12-31']) AS DATE) AS as_of_date) d WHERE f.known_from <= d.as_of_date) GROUP BY ALL")
def visible_filings(t: Tables) -> DataFrame:
    grid = t.filing.select("krs").distinct().select("krs", F.explode(F.array(F.to_date(F.lit("1997-12-31")), F.to_date(F.lit("1999-12-31")))).alias("as_of_date"))
    return temporal.visible_at(t.filing, grid, ["krs"]).groupBy("krs", "as_of_date").agg(F.max("known_from").alias("known_from"), F.count("*").alias("n"))


@QUERIES.query("SELECT * FROM (SELECT krs, document_ref, known_from, status, row_number() OVER (PARTITION BY krs ORDER BY known_from DESC, document_ref) AS n FROM filing) WHERE n = 1")
def latest_per_key(t: Tables) -> DataFrame:
    rows = t.filing.select("krs", "document_ref", "known_from", "status")
    return temporal.latest_per_key(rows, ["krs"], [F.desc("known_from"), F.asc("document_ref")]).withColumn("n", F.lit(1).cast("long"))


@QUERIES.query("SELECT krs, document_ref, known_from, lag(total) OVER w AS before, total - lag(total) OVER w AS change FROM filing WINDOW w AS (PARTITION BY krs ORDER BY known_from, document_ref)")
def previous_row(t: Tables) -> DataFrame:
    own = Window.partitionBy("krs").orderBy("known_from", "document_ref")
    return t.filing.select("krs", "document_ref", "known_from", F.lag("total").over(own).alias("before"), (F.col("total") - F.lag("total").over(own)).alias("change"))


@QUERIES.query("SELECT krs, known_from, document_ref, status FROM (SELECT *, lag(status) OVER (PARTITION BY krs ORDER BY known_from, document_ref) AS before FROM filing) WHERE before IS NULL OR before <> status")
def status_change_points(t: Tables) -> DataFrame:
    rows = t.filing.select("krs", "known_from", "document_ref", "status")
    return temporal.changed_rows(rows, ["krs"], [F.col("known_from"), F.col("document_ref")], ["status"])


@QUERIES.query("SELECT a.krs, a.document_ref, count(*) AS n_near, min(b.known_from) AS first_near FROM filing a JOIN filing b ON b.krs = a.krs AND b.known_from > a.known_from AND b.known_from <= a.known_from + INTERVAL 90 DAY GROUP BY ALL")
def interval_join_counts(t: Tables) -> DataFrame:
    right = t.filing.select("krs", F.col("known_from").alias("later"))
    left = t.filing.select("krs", "document_ref", "known_from")
    pairs = temporal.interval_join(left, right, ["krs"], F.col("later") > F.col("known_from"), F.col("later") <= F.date_add("known_from", 90))
    return pairs.groupBy("krs", "document_ref").agg(F.count("*").alias("n_near"), F.min("later").alias("first_near"))


@QUERIES.query("SELECT e.krs, e.segment FROM entity e WHERE EXISTS (SELECT 1 FROM filing f WHERE f.krs = e.krs AND f.status = 'quarantined')")
def semi_join_quarantined(t: Tables) -> DataFrame:
    return t.entity.join(t.filing.filter("status = 'quarantined'"), "krs", "left_semi").select("krs", "segment")


@QUERIES.query("SELECT e.krs, e.segment FROM entity e WHERE e.krs NOT IN (SELECT krs FROM filing WHERE status = 'valid')")
def anti_join_unfiled(t: Tables) -> DataFrame:
    return t.entity.join(t.filing.filter("status = 'valid'"), "krs", "left_anti").select("krs", "segment")


@QUERIES.query("""WITH a AS (SELECT krs, count(*) AS n FROM filing WHERE known_from < DATE '1999-01-01' GROUP BY krs), b AS (SELECT krs, count(*) AS n FROM filing WHERE known_from < DATE '1999-07-01' AND status = 'valid' GROUP BY krs)
SELECT coalesce(a.krs, b.krs) AS krs, a.n AS first_n, b.n AS second_n FROM a FULL JOIN b ON a.krs = b.krs WHERE a.n IS DISTINCT FROM b.n""")
def full_outer_diff(t: Tables) -> DataFrame:
    a = t.filing.filter("known_from < '1999-01-01'").groupBy("krs").agg(F.count("*").alias("first_n"))
    b = t.filing.filter("known_from < '1999-07-01' and status = 'valid'").groupBy("krs").agg(F.count("*").alias("second_n"))
    return a.join(b, ["krs"], "full").filter(values.differs(F.col("first_n"), F.col("second_n")))


@QUERIES.query("SELECT f.status, count(*) AS n, count(DISTINCT f.krs) AS entities, count(*) FILTER (WHERE f.is_correction) AS corrections, bool_or(f.deleted_on IS NOT NULL) AS any_deleted, bool_and(f.total > 0) AS all_positive, min(f.known_from) AS first_known, max(f.known_from) AS last_known FROM filing f GROUP BY f.status")
def filing_aggregates(t: Tables) -> DataFrame:
    return t.filing.groupBy("status").agg(
        F.count("*").alias("n"), F.count_distinct("krs").alias("entities"), F.count_if("is_correction").alias("corrections"), F.bool_or(F.col("deleted_on").isNotNull()).alias("any_deleted"),
        F.bool_and(F.col("total") > 0).alias("all_positive"), F.min("known_from").alias("first_known"), F.max("known_from").alias("last_known"),
    )


@QUERIES.query("SELECT krs, array_to_string(list(DISTINCT status ORDER BY status), ',') AS statuses, first(document_ref ORDER BY known_from, document_ref) AS first_ref, count(DISTINCT status) AS n_statuses FROM filing GROUP BY krs HAVING count(DISTINCT status) >= 2")
def distinct_lists(t: Tables) -> DataFrame:
    grouped = t.filing.groupBy("krs").agg(values.distinct_sorted(F.col("status")).alias("found"), F.min_by("document_ref", F.struct("known_from", "document_ref")).alias("first_ref"))
    return grouped.filter(F.size("found") >= 2).select("krs", F.array_join("found", ",").alias("statuses"), "first_ref", F.size("found").cast("long").alias("n_statuses"))


@QUERIES.query("SELECT segment, nation, count(*) AS n, quantile_cont(balance, 0.25) AS q1, quantile_cont(balance, 0.5) AS q2, quantile_cont(balance, 0.75) AS q3, stddev_samp(balance) AS spread FROM entity GROUP BY segment, nation")
def peers_quartiles(t: Tables) -> DataFrame:
    return t.entity.groupBy("segment", "nation").agg(F.count("*").alias("n"), *[F.percentile("balance", q).alias(n) for n, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.75))], F.stddev_samp("balance").alias("spread"))


@QUERIES.query("SELECT krs, segment, (below + upto) / (2.0 * n) AS percentile FROM (SELECT krs, segment, CAST(rank() OVER w - 1 AS DOUBLE) AS below, CAST(count(*) OVER (PARTITION BY segment ORDER BY balance RANGE UNBOUNDED PRECEDING) AS DOUBLE) AS upto, CAST(count(*) OVER (PARTITION BY segment) AS DOUBLE) AS n FROM entity WINDOW w AS (PARTITION BY segment ORDER BY balance))")
def peer_percentile(t: Tables) -> DataFrame:
    """The mid-rank of each balance among its segment."""
    own = Window.partitionBy("segment").orderBy("balance")
    below = F.rank().over(own) - 1
    upto = F.count("*").over(own.rangeBetween(Window.unboundedPreceding, 0))
    n = F.count("*").over(Window.partitionBy("segment"))
    return t.entity.select("krs", "segment", ((below + upto).cast("double") / (F.lit(2.0) * n)).alias("percentile"))


@QUERIES.query("SELECT status, CAST(year(known_from) AS INT) AS y, count(*) AS n FROM filing GROUP BY ALL UNION ALL SELECT 'all', CAST(year(known_from) AS INT), count(*) FROM filing GROUP BY ALL")
def union_with_total(t: Tables) -> DataFrame:
    one = t.filing.groupBy("status", F.year("known_from").alias("y")).agg(F.count("*").alias("n"))
    return one.unionByName(one.groupBy(F.lit("all").alias("status"), "y").agg(F.sum("n").alias("n")))


@QUERIES.query("SELECT krs, max(CASE WHEN status = 'valid' THEN n END) AS valid, max(CASE WHEN status = 'quarantined' THEN n END) AS quarantined, max(CASE WHEN status = 'needs_pdf_tier' THEN n END) AS needs_pdf_tier FROM (SELECT krs, status, count(*) AS n FROM filing GROUP BY ALL) GROUP BY krs")
def pivot_statuses(t: Tables) -> DataFrame:
    return t.filing.groupBy("krs").pivot("status", ["valid", "quarantined", "needs_pdf_tier"]).count()


@QUERIES.query("SELECT krs, metric, value FROM (UNPIVOT (SELECT krs, min(total) AS low, max(total) AS high, avg(total) AS mean FROM filing GROUP BY krs) ON low, high, mean INTO NAME metric VALUE value)")
def unpivot_totals(t: Tables) -> DataFrame:
    wide = t.filing.groupBy("krs").agg(F.min("total").alias("low"), F.max("total").alias("high"), F.avg("total").alias("mean"))
    return wide.unpivot(["krs"], ["low", "high", "mean"], "metric", "value")


@QUERIES.query("SELECT segment, krs, CAST(n AS BIGINT) AS place FROM (SELECT segment, krs, row_number() OVER (PARTITION BY segment ORDER BY abs(balance) DESC, krs) AS n FROM entity) WHERE n <= 5")
def top_five_by_segment(t: Tables) -> DataFrame:
    own = Window.partitionBy("segment").orderBy(F.desc(F.abs("balance")), "krs")
    return t.entity.withColumn("place", F.row_number().over(own)).filter("place <= 5").select("segment", "krs", F.col("place").cast("long").alias("place"))


@QUERIES.query("WITH r AS (SELECT c_mktsegment AS feature, sum(abs(c_acctbal)) AS total FROM customer GROUP BY 1), n AS (SELECT *, row_number() OVER (ORDER BY total DESC, feature) AS k FROM r) SELECT CASE WHEN k <= 3 THEN feature ELSE 'rest' END AS feature, round(sum(total), 2) AS total FROM n GROUP BY 1")
def top_features_and_rest(t: Tables) -> DataFrame:
    totals = t.customer.groupBy(F.col("c_mktsegment").alias("feature")).agg(F.sum(F.abs("c_acctbal")).alias("total"))
    first = totals.withColumn("k", F.row_number().over(Window.orderBy(F.desc("total"), "feature")))
    return first.groupBy(F.when(F.col("k") <= 3, F.col("feature")).otherwise("rest").alias("feature")).agg(F.round(F.sum("total"), 2).alias("total"))


@QUERIES.query("SELECT krs, as_of_date FROM (SELECT krs, unnest(generate_series(DATE '2019-01-01', fetched, INTERVAL 1 MONTH)) AS m, fetched FROM (SELECT krs, max(fetched_on) AS fetched FROM fetches GROUP BY krs)) q, LATERAL (SELECT CAST(last_day(m) AS DATE) AS as_of_date) WHERE as_of_date <= fetched")
def month_end_grid(t: Tables) -> DataFrame:
    last = t.fetches.groupBy("krs").agg(F.max("fetched_on").alias("fetched"))
    return last.select("krs", F.explode(timeops.month_ends(F.to_date(F.lit("2019-01-01")), F.col("fetched"))).alias("as_of_date"))


@QUERIES.query("""SELECT document_ref, CAST(CASE WHEN period_end = last_day(period_end) THEN last_day(period_end + INTERVAL 6 MONTH) ELSE period_end + INTERVAL 6 MONTH END AS DATE) + CAST(CASE WHEN period_end BETWEEN DATE '1997-09-30' AND DATE '1998-04-30' THEN 0 ELSE 0 END + 15 AS INT) AS deadline,
CAST(last_day(period_end + INTERVAL 12 MONTH) AS DATE) AS window_end FROM filing""")
def statutory_deadlines(t: Tables) -> DataFrame:
    return t.filing.select("document_ref", timeops.filing_deadline(F.col("period_end")).alias("deadline"), timeops.window_end(F.col("period_end"), 12).alias("window_end"))


@QUERIES.query("""WITH s AS (SELECT user_id, event_id, event_type <> 'purchase' AS found, sum(CASE WHEN event_type <> 'purchase' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS island FROM events)
SELECT user_id, CAST(island AS BIGINT) AS island, count(*) AS n, min(event_id) AS first_id FROM s WHERE found GROUP BY ALL HAVING count(*) >= 5""")
def outage_islands(t: Tables) -> DataFrame:
    rows = temporal.islands(t.events, ["user_id"], [F.col("ts"), F.col("event_id")], F.col("event_type") != "purchase")
    return rows.groupBy("user_id", "island").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id")).filter("n >= 5")


@QUERIES.query("""SELECT CAST(count(*) AS BIGINT) AS inside, w.name FROM events e JOIN (SELECT 'first' AS name, TIMESTAMP '2024-01-05' AS a, TIMESTAMP '2024-01-07' AS b UNION ALL SELECT 'second', TIMESTAMP '2024-01-20', TIMESTAMP '2024-01-20 12:00:00') w ON e.ts BETWEEN w.a AND w.b WHERE e.event_type = 'error' GROUP BY w.name""")
def searches_in_outages(t: Tables) -> DataFrame:
    windows = t.spark.sql("SELECT * FROM VALUES ('first', TIMESTAMP_NTZ '2024-01-05', TIMESTAMP_NTZ '2024-01-07'), ('second', TIMESTAMP_NTZ '2024-01-20', TIMESTAMP_NTZ '2024-01-20 12:00:00') AS w(name, a, b)")
    # The declared outages are a configuration table: two rows.
    inside = t.events.filter("event_type = 'error'").join(F.broadcast(windows), F.col("ts").between(F.col("a"), F.col("b")))
    return inside.groupBy("name").agg(F.count("*").alias("inside"))


@QUERIES.query("SELECT l_returnflag, l_linestatus, sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price, round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, avg(l_discount) AS avg_disc, count(*) AS count_order FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY ALL")
def pricing_summary(t: Tables) -> DataFrame:
    rows = t.lineitem.filter("l_shipdate <= timestamp_ntz'2000-09-02'")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_base_price"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("sum_disc_price"), F.avg("l_discount").alias("avg_disc"), F.count("*").alias("count_order"))
