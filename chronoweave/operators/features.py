"""Features of an entity on a day, from what was known by then; the store, its leakage proofs and its coverage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.timeops import filing_deadline
from chronoweave.operators.temporal import visible_at

KEYS = ["krs", "as_of_date"]


def filing_metrics(grid: DataFrame, filings: DataFrame, late_years: int = 3) -> DataFrame:
    """Per grid row: days_to_file of the latest filing, late filings and corrections within years, quarantined ones, PDF-only latest, missing years.

    Rows see only filings known by their day and not deleted by it. A year-end is missing when its deadline has passed, the entity had
    filed before and no filing covers it.
    """
    seen = visible_at(filings, grid, ["krs"]).withColumn("live", F.col("deleted_on").isNull() | (F.col("deleted_on") > F.col("as_of_date"))).filter("live")
    deadline = filing_deadline(F.col("period_end"))
    recent = F.col("known_from") > F.add_months("as_of_date", -12 * late_years)
    metrics = seen.groupBy(*KEYS).agg(
        F.max_by(F.datediff("known_from", "period_end"), F.struct("period_end", "known_from", "document_ref")).cast("double").alias("days_to_file"),
        F.count_if((F.col("known_from") > deadline) & recent).cast("double").alias("late_filings"),
        F.count_if(F.col("is_correction") & recent).cast("double").alias("corrections"),
        F.count_if(F.col("status") == "quarantined").cast("double").alias("statements_quarantined"),
        F.max_by((F.col("status") == "needs_pdf_tier").cast("double"), F.struct("period_end", "known_from", "document_ref")).alias("latest_filed_as_pdf"),
        F.max("known_from").alias("known_from"),
        F.min(F.year("period_end")).alias("first_year"),
        F.collect_set(F.year("period_end")).alias("years"),
    )
    due = F.year(F.add_months(F.date_sub("as_of_date", 15), -18)) + 1
    wanted = F.when(due >= F.col("first_year"), F.sequence("first_year", due)).otherwise(F.array().cast("array<int>"))
    return metrics.withColumn("missing_years", F.size(F.array_except(wanted, "years")).cast("double")).drop("first_year", "years")


def event_counts(grid: DataFrame, events: DataFrame, types: list[str], months: int, seen_from: DataFrame) -> DataFrame:
    """Long values: events of each type first known within the months before the day; 0 counts once the sources were seen, else null."""
    first = events.groupBy("krs", "event_type", F.coalesce("event_date", "known_from").alias("happened")).agg(F.min("known_from").alias("known_from"))
    rows = grid.join(seen_from, "krs", "left").withColumn("seen", F.coalesce(F.col("seen_on") <= F.col("as_of_date"), F.lit(False)))
    pairs = rows.join(first, "krs").filter((F.col("known_from") <= F.col("as_of_date")) & (F.col("known_from") > F.add_months("as_of_date", -months)))
    counts = pairs.groupBy(*KEYS).pivot("event_type", types).agg(F.count(F.lit(1)).alias("n"), F.max("known_from").alias("k"))
    wide = rows.join(counts, KEYS, "left")
    out = F.explode(F.array(*[F.struct(F.lit(f"{t}_{months}m").alias("feature"), F.when(F.col("seen"), F.coalesce(F.col(f"{t}_n"), F.lit(0)).cast("double")).alias("value"), F.col(f"{t}_k").alias("known_from")) for t in types]))
    return wide.select(*KEYS, out.alias("f")).select(*KEYS, "f.feature", "f.value", "f.known_from")


def latest_flag(grid: DataFrame, files: DataFrame, value: Column, name: str) -> DataFrame:
    """Long value of the latest file of the latest period among those visible: latest per period, then latest period."""
    seen = visible_at(files, grid, ["krs"]).filter(F.col("deleted_on").isNull() | (F.col("deleted_on") > F.col("as_of_date")))
    per_period = seen.groupBy(*KEYS, "period_end").agg(F.max_by(F.struct(value.cast("double").alias("value"), "known_from"), F.struct("known_from", "document_ref")).alias("v"))
    last = per_period.groupBy(*KEYS).agg(F.max_by("v", "period_end").alias("v"))
    return last.select(*KEYS, F.lit(name).alias("feature"), F.col("v.value").alias("value"), F.col("v.known_from").alias("known_from"))


def widen(grid: DataFrame, long: DataFrame, names: list[str]) -> DataFrame:
    """The feature store: keys, and for each feature its value and the day it was known from."""
    wide = long.groupBy(*KEYS).pivot("feature", names).agg(F.first("value").alias("v"), F.first("known_from").alias("k"))
    columns = [c for n in names for c in (F.col(f"{n}_v").alias(n), F.col(f"{n}_k").alias(f"{n}__known_from"))]
    return grid.select(*KEYS).join(wide, KEYS, "left").select(*KEYS, *columns)


def leakage(store: DataFrame, names: list[str]) -> DataFrame:
    """The values of a store that were not known by their day: must be empty."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), F.col(n).alias("value"), F.col(f"{n}__known_from").alias("known_from")) for n in names]))
    return store.select(*KEYS, each.alias("f")).select(*KEYS, "f.*").filter("known_from > as_of_date")


def known_on(sources: dict[str, DataFrame], day: str) -> dict[str, DataFrame]:
    """The sources as they stood on a day: later rows gone, later dates in earlier rows null."""
    at = F.lit(day).cast("date")

    def cut(df: DataFrame) -> DataFrame:
        kept = df.filter(F.col("known_from") <= at) if "known_from" in df.columns else df
        return kept.withColumn("deleted_on", F.when(F.col("deleted_on") <= at, F.col("deleted_on"))) if "deleted_on" in df.columns else kept

    return {name: cut(df) for name, df in sources.items()}


def truncation_diff(compute: Callable[[DataFrame, dict[str, DataFrame]], DataFrame], grid: DataFrame, sources: dict[str, DataFrame], days: list[str]) -> DataFrame:
    """Values that change when they are computed from sources cut at their own day: must be empty. ``compute`` gives long values."""
    keys = [*KEYS, "feature"]
    out = None
    for day in days:
        rows = grid.filter(F.col("as_of_date") == F.lit(day).cast("date"))
        full = compute(rows, sources).select(*keys, "value")
        cut = compute(rows, known_on(sources, day)).select(*keys, F.col("value").alias("value_then"))
        diff = full.join(cut, keys, "full").filter(~F.col("value").eqNullSafe(F.col("value_then")))
        out = diff if out is None else out.unionByName(diff)
    return out


def coverage(store: DataFrame, families: dict[str, list[str]], by: Column) -> DataFrame:
    """Non-null shares of each family's features by a group."""
    names = [n for group in families.values() for n in group]
    counted = store.groupBy(by.alias("group")).agg(F.count("*").alias("n_rows"), *[F.count(n).alias(n) for n in names])
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("family"), F.lit(n).alias("feature"), F.col(n).alias("filled")) for f, group in families.items() for n in group]))
    return counted.select("group", "n_rows", each.alias("x")).groupBy("group", "x.family").agg((F.sum("x.filled") / F.sum("n_rows")).alias("share"), F.max("n_rows").alias("n_rows"))
