"""Alerts, publication, read queries, work queues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.timeops import filing_deadline


def alert_id(*parts: Column) -> Column:
    """The same alert has the same id in every run."""
    return F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)


def threshold_alerts(scores: DataFrame, levels: list[tuple[float, str]]) -> DataFrame:
    """Scores that rose over a level since the series' last row: the highest level with before < level <= now. A first row counts as risen from 0."""
    own = Window.partitionBy("krs", "horizon_months", "model_name").orderBy("as_of_date")
    seen = scores.withColumn("before", F.lag("probability").over(own))
    name = F.lit(None).cast("string")
    for level, severity in sorted(levels):
        name = F.when((F.coalesce("before", F.lit(0.0)) < level) & (F.col("probability") >= level), severity).otherwise(name)
    return seen.withColumn("severity", name).filter("severity is not null").withColumn("rule", F.lit("threshold_crossed"))


def jump_alerts(scores: DataFrame, least: float, times: float) -> DataFrame:
    """Scores up by at least ``least`` and to at least ``times`` the one before."""
    own = Window.partitionBy("krs", "horizon_months", "model_name").orderBy("as_of_date")
    seen = scores.withColumn("before", F.lag("probability").over(own))
    return seen.filter((F.col("probability") - F.col("before") >= least) & (F.col("probability") >= times * F.col("before"))).withColumn("rule", F.lit("score_jump"))


def flag_alerts(store: DataFrame, flags: list[str]) -> DataFrame:
    """Flags that turned true since the entity's row before; a first row tells of no turn."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("on")) for f in flags]))
    own = Window.partitionBy("krs", "flag").orderBy("as_of_date")
    rows = store.select("krs", "as_of_date", each.alias("f")).select("krs", "as_of_date", "f.*")
    seen = rows.withColumn("before", F.lag("on").over(own)).withColumn("n", F.row_number().over(own))
    return seen.filter(F.col("on") & (F.col("n") > 1) & ~F.coalesce("before", F.lit(False))).select("krs", "as_of_date", "flag")


def overdue_alerts(statements: DataFrame, searches: DataFrame, cycles: int = 1) -> DataFrame:
    """Entities whose next statement was missing at the first complete search after its deadline, for so many cycles back.

    ``statements``: krs, period_end, submission_date. ``searches``: krs, searched_on. A period counts as filed by any statement for it
    submitted by the search.
    """
    last = statements.groupBy("krs").agg(F.max("period_end").alias("last_end"))
    due = last.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(cycles)))).select("krs", F.add_months("last_end", 12 * F.col("k")).alias("due_end"))
    due = due.withColumn("deadline", filing_deadline(F.col("due_end")))
    first = due.join(searches, "krs").filter("searched_on > deadline").groupBy("krs", "due_end", "deadline").agg(F.min("searched_on").alias("searched_on"))
    filed = statements.select("krs", F.col("period_end").alias("due_end"), "submission_date")
    return first.join(filed, (first["krs"] == filed["krs"]) & (first["due_end"] == filed["due_end"]) & (filed["submission_date"] <= first["searched_on"]), "left_anti")


def insert_new(stored: DataFrame, rows: DataFrame, key: list[str]) -> DataFrame:
    """The rows whose key isn't stored, once each: what an idempotent insert appends."""
    return rows.dropDuplicates(key).join(stored.select(*key), key, "left_anti")


def merged(stored: DataFrame, rows: DataFrame, key: list[str], replace: list[str]) -> DataFrame:
    """Stored rows with the named columns replaced where new rows have them, and the new rows."""
    new = rows.select(*key, *[F.col(c).alias(f"_{c}") for c in rows.columns if c not in key], F.lit(True).alias("_new"))
    both = stored.withColumn("_old", F.lit(True)).join(new, key, "full")
    columns = [F.col(k) for k in key]
    for c in [c for c in stored.columns if c not in key]:
        if f"_{c}" not in new.columns:
            columns.append(F.col(c))
        else:
            columns.append((F.when(F.col("_new"), F.col(f"_{c}")) if c in replace else F.when(F.col("_old").isNull(), F.col(f"_{c}"))).otherwise(F.col(c)).alias(c))
    return both.select(*columns)


def alerts_listing(alerts: DataFrame, severities: list[str], watched: DataFrame | None = None, severity: str | None = None, krs: str | None = None, limit: int = 100) -> DataFrame:
    """Alerts by severity, then latest; filters that are None don't filter. The limit is the page."""
    rows = alerts
    if severity is not None:
        rows = rows.filter(F.col("severity") == severity)
    if krs is not None:
        rows = rows.filter(F.col("krs") == krs)
    if watched is not None:
        rows = rows.join(watched.select("krs").distinct(), "krs", "left_semi")
    order = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(s) for s in severities]), F.col("severity")), F.lit(0)), F.lit(len(severities) + 1))
    return rows.orderBy(order, F.desc("as_of_date"), "krs").limit(limit)


def leaks(published: DataFrame, identifiers: DataFrame, identifier: str) -> DataFrame:
    """Values of string columns that are an identifier or hold one as a word: must be empty. Words meet identifiers by equality."""
    texts = [f.name for f in published.schema.fields if f.dataType.simpleString() == "string"]
    if not texts:
        return published.limit(0).select(F.lit("").alias("column"), F.lit("").alias("word"))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in texts]))
    words = published.select(each.alias("x")).select("x.column", F.explode(F.split("x.text", r"[^0-9A-Za-z]+")).alias("word")).filter("word <> ''")
    return words.join(identifiers.select(F.col(identifier).alias("word")).distinct(), "word", "left_semi").distinct()


def search_queue(entities: DataFrame, today: str, tiers: list[tuple[str, Column]]) -> DataFrame:
    """Entities by the first tier that holds, then by what was searched longest ago; never searched first."""
    tier = F.lit(None).cast("int")
    name = F.lit(None).cast("string")
    for i, (label, test) in reversed(list(enumerate(tiers))):
        tier, name = F.when(test, i).otherwise(tier), F.when(test, label).otherwise(name)
    return entities.withColumn("today", F.lit(today).cast("date")).withColumn("tier", tier).withColumn("reason", name).filter("tier is not null").orderBy("tier", F.asc_nulls_first("last_searched"), "krs")
