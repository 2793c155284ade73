"""The versioned panel of periods, its snapshots, and features of one period and of several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def candidates(statements: DataFrame) -> DataFrame:
    """Who may speak for a period: a statement for its own, and, by its prior-year column, for the one before.

    ``statements``: krs, document_ref, period_start, period_end, known_from, deleted_on, is_correction, quality_grade,
    prior_assets. Quarantined files and prior years without assets are left out. On one day a filed statement comes before a
    corrected one and both before prior-year columns; two of one rank on one day say nothing, nor does what was deleted when filed.
    """
    own = statements.filter("quality_grade <> 'quarantined'")
    corrected = F.col("is_correction").cast("int")
    filed = own.select("krs", "document_ref", "period_end", "known_from", "deleted_on", F.when(F.col("is_correction"), "correction").otherwise("filed").alias("kind"), corrected.alias("rank"))
    prior = own.filter("prior_assets is not null and prior_assets <> 0").select(
        "krs", "document_ref", F.date_sub("period_start", 1).alias("period_end"), "known_from", "deleted_on", F.lit("comparative").alias("kind"), (corrected + 2).alias("rank")
    )
    every = filed.unionByName(prior)
    clash = F.count("*").over(Window.partitionBy("krs", "period_end", "known_from", "rank"))
    return every.withColumn("_n", clash).filter("_n = 1 and (deleted_on is null or deleted_on > known_from)").drop("_n")


def versions(found: DataFrame) -> DataFrame:
    """(krs, period_end, known_from, kind, document_ref): who speaks for each period from which day on.

    On each day a source arrives or is deleted, filed statements win over comparatives and the latest over earlier ones; a
    version starts where the winner changes. A period whose last source is deleted is ``withdrawn``, attributed to that source.
    """
    days = found.select("krs", "period_end", F.col("known_from").alias("day")).unionByName(found.filter("deleted_on is not null").select("krs", "period_end", F.col("deleted_on").alias("day"))).distinct()
    speaking = days.join(found, ["krs", "period_end"]).withColumn("live", (F.col("known_from") <= F.col("day")) & (F.col("deleted_on").isNull() | (F.col("deleted_on") > F.col("day"))))
    order = F.struct((F.col("kind") != "comparative").cast("int"), "known_from", "rank", "document_ref")
    said = F.struct("kind", "document_ref")
    daily = speaking.groupBy("krs", "period_end", "day").agg(F.max_by(F.when(F.col("live"), said), F.when(F.col("live"), order)).alias("now"))
    before = Window.partitionBy("krs", "period_end").orderBy("day")
    changed = daily.withColumn("before", F.lag("now").over(before)).filter(~F.col("now").eqNullSafe(F.col("before")))
    return changed.select("krs", "period_end", F.col("day").alias("known_from"), F.coalesce("now.kind", F.lit("withdrawn")).alias("kind"), F.coalesce("now.document_ref", "before.document_ref").alias("document_ref"))


def snapshots(panel: DataFrame) -> DataFrame:
    """(krs, known_on, period_end, …): for each day on which anything became known, each period's version then, without those withdrawn."""
    days = panel.select("krs", F.col("known_from").alias("known_on")).distinct()
    rest = [c for c in panel.columns if c not in ("krs", "period_end")]
    latest = days.join(panel, "krs").filter("known_from <= known_on").groupBy("krs", "known_on", "period_end").agg(F.max_by(F.struct(*rest), "known_from").alias("v"))
    return latest.filter("v.kind <> 'withdrawn'").select("krs", "known_on", "period_end", *[F.col(f"v.{c}").alias(c) for c in rest])


def latest_period(rows: DataFrame) -> DataFrame:
    """Of each snapshot, its latest period."""
    rest = [c for c in rows.columns if c not in ("krs", "known_on", "period_end")]
    return rows.groupBy("krs", "known_on").agg(F.max_by(F.struct("period_end", *rest), "period_end").alias("v")).select("krs", "known_on", "v.*")


def signed_ratio(top: list[tuple[int, str]], bottom: list[tuple[int, str]], null_when_negative: bool = False, scale: float = 1.0) -> Column:
    """A ratio of signed sums; null where any part or the denominator is missing, 0, or, if asked, negative."""
    add = lambda parts: sum((F.col(c).cast("decimal(38,6)") * s for s, c in parts[1:]), F.col(parts[0][1]).cast("decimal(38,6)") * parts[0][0])
    over, under = add(top), add(bottom)
    usable = (under > 0) if null_when_negative else (under != 0)
    return F.when(usable, over.cast("double") / under.cast("double") * F.lit(scale))


def growth(rows: DataFrame, value: str, years: int, tolerance_days: int = 31) -> DataFrame:
    """(krs, known_on, period_end, growth) of the latest period against the one ``years`` back, nearest within the tolerance, then earliest."""
    now = latest_period(rows).select("krs", "known_on", "period_end", F.col(value).alias("now"))
    past = rows.select("krs", "known_on", F.col("period_end").alias("past_end"), F.col(value).alias("past"))
    goal = F.add_months("period_end", -12 * years)
    far = F.abs(F.datediff("past_end", goal))
    pairs = now.join(past, ["krs", "known_on"], "left").withColumn("far", far)
    near = pairs.groupBy("krs", "known_on", "period_end", "now").agg(F.min_by("past", F.when(F.col("far") <= tolerance_days, F.struct("far", "past_end"))).alias("past"))
    change = F.when(F.col("past") > 0, (F.col("now").cast("double") - F.col("past").cast("double")) / F.col("past").cast("double"))
    return near.select("krs", "known_on", "period_end", change.alias("growth"))


def volatility(rows: DataFrame, value: str, years: int, tolerance_days: int = 31) -> DataFrame:
    """Sample deviation of a value over a chain of yearly periods that must all be there."""
    chain = latest_period(rows).select("krs", "known_on", "period_end", F.array(F.col(value).cast("double")).alias("chain"), F.col("period_end").alias("at"))
    past = rows.select("krs", "known_on", F.col("period_end").alias("past_end"), F.col(value).cast("double").alias("past"))
    for _ in range(years - 1):
        pairs = chain.join(past, ["krs", "known_on"]).withColumn("far", F.abs(F.datediff("past_end", F.add_months("at", -12)))).filter(F.col("far") <= tolerance_days)
        step = pairs.groupBy("krs", "known_on", "period_end", "chain").agg(F.min_by(F.struct("past_end", "past"), F.struct("far", "past_end")).alias("p"))
        chain = step.select("krs", "known_on", "period_end", F.concat("chain", F.array("p.past")).alias("chain"), F.col("p.past_end").alias("at"))
    each = chain.filter(F.forall("chain", lambda x: x.isNotNull())).select("krs", "known_on", "period_end", F.explode("chain").alias("x"))
    return each.groupBy("krs", "known_on", "period_end").agg(F.stddev_samp("x").alias("volatility"))


def tripwire(loss: list[str], buffers: list[tuple[int, int, str]]) -> Column:
    """Whether a loss exceeds a sum of fractions of capitals, exactly: all in whole multiples of the fractions' denominators."""
    common = 1
    for _, denominator, _ in buffers:
        common *= denominator
    missing = [F.col(c).isNull() for c in loss] + [F.col(c).isNull() for _, _, c in buffers]
    total = sum((F.col(c).cast("decimal(30,2)") for c in loss[1:]), F.col(loss[0]).cast("decimal(30,2)"))
    limit = sum((F.col(c).cast("decimal(30,2)") * F.lit(n * common // d) for n, d, c in buffers), F.lit(0).cast("decimal(30,2)"))
    unknown = missing[0]
    for m in missing[1:]:
        unknown = unknown | m
    return F.when(unknown, None).otherwise(-total * F.lit(common) > limit)
