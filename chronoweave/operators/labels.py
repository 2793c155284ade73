"""Censored outcome labels on a month-end grid."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.timeops import month_ends, window_end
from chronoweave.functions.values import position


@dataclass(frozen=True)
class LabelRules:
    """What a label set is made by; dates as ISO strings."""

    grid_start: str = "2012-01-31"
    horizons: tuple[int, ...] = (12, 24)
    sources: tuple[str, ...] = ("KRS", "MSiG")
    precedence: tuple[str, ...] = ("bankruptcy", "restructuring", "liquidation", "silent_exit")
    regime_start: str = "2020-01-01"
    regime_end: str = "2021-12-31"
    launch: str = "2021-12-01"
    alive_lag_months: int = 12
    petition_expiry_months: int | None = 24
    version: str = "v4"


def cutoffs(fetches: DataFrame, sources: tuple[str, ...]) -> DataFrame:
    """(krs, cutoff_date): the earliest of the required sources' last fetches; an entity that lacks a source has none."""
    last = fetches.filter(F.col("source").isin(*sources)).groupBy(F.trim("krs").alias("krs"), "source").agg(F.max("fetched_on").alias("last"))
    return last.groupBy("krs").agg(F.min("last").alias("cutoff_date"), F.count_distinct("source").alias("n")).filter(F.col("n") == len(sources)).drop("n")


def month_end_grid(cuts: DataFrame, registered: DataFrame, start: str) -> DataFrame:
    """(krs, as_of_date, cutoff_date): month-ends from the later of start and registration to the cutoff."""
    first = F.coalesce("registered_on", F.lit(start).cast("date"))
    own = cuts.join(registered, "krs", "left").filter(F.col("cutoff_date") >= F.lit(start).cast("date"))
    days = month_ends(F.lit(start).cast("date"), F.col("cutoff_date"))
    return own.select("krs", "cutoff_date", first.alias("first"), F.explode(days).alias("as_of_date")).filter("as_of_date >= first").drop("first")


def in_proceeding(grid: DataFrame, canonical: DataFrame, expiry_months: int | None) -> DataFrame:
    """The grid rows (krs, as_of_date) within a proceeding.

    A petition or opening holds from its day until the first closing, on or after that day, of its class; a petition also ends by
    expiry. With that end known per event, the nested conditions on grid rows are one interval join.
    """
    began = canonical.filter(F.col("stage").isin("petition", "opening") & F.col("outcome_class").isin("bankruptcy", "restructuring", "liquidation", "silent_exit"))
    began = began.select("krs", "dedup_group_id", "stage", "outcome_class", F.col("effective_date").alias("began"))
    closed = canonical.filter("stage = 'closing'").select("krs", F.explode(F.split("ends", ",")).alias("outcome_class"), F.col("effective_date").alias("closed"))
    ended = began.join(closed, ["krs", "outcome_class"], "left").groupBy("krs", "dedup_group_id", "stage", "began").agg(F.min(F.when(F.col("closed") >= F.col("began"), F.col("closed"))).alias("closed"))
    if expiry_months is not None:
        ended = ended.withColumn("closed", F.least("closed", F.when(F.col("stage") == "petition", F.add_months("began", expiry_months))))
    days = grid.select("krs", "as_of_date").distinct()
    within = (F.col("began") <= F.col("as_of_date")) & (F.col("closed").isNull() | (F.col("as_of_date") < F.col("closed")))
    return days.join(ended.select("krs", "began", "closed"), "krs").filter(within).select("krs", "as_of_date").distinct()


def label_grid(canonical: DataFrame, fetches: DataFrame, rules: LabelRules) -> DataFrame:
    """Every grid row and horizon with its state, its label or censoring, and what they come from."""
    launch = F.lit(rules.launch).cast("date")
    registered = canonical.filter("event_type = 'registered'").groupBy("krs").agg(F.min("effective_date").alias("registered_on"))
    grid = month_end_grid(cutoffs(fetches, rules.sources), registered, rules.grid_start)
    left = canonical.filter("event_type = 'deregistered'").groupBy("krs").agg(F.min("effective_date").alias("left_on"))
    states = grid.join(left, "krs", "left").withColumn("deregistered", F.coalesce(F.col("left_on") <= F.col("as_of_date"), F.lit(False)))
    open_rows = in_proceeding(grid, canonical, rules.petition_expiry_months).withColumn("open", F.lit(True))
    states = states.join(open_rows, ["krs", "as_of_date"], "left").drop("left_on")
    rows = states.withColumn("horizon_months", F.explode(F.array(*[F.lit(h) for h in rules.horizons])))
    rows = rows.withColumn("window_end", window_end(F.col("as_of_date"), F.col("horizon_months")))
    rows = rows.withColumn("alive_limit", F.when(F.col("window_end") >= launch, F.add_months("cutoff_date", -rules.alive_lag_months)).otherwise(F.col("cutoff_date")))
    happened = canonical.filter("label_class is not null").select("krs", "label_class", "event_type", "event_date", F.col("known_from").alias("event_known_from"), "effective_date", "proceeding_id", "dedup_group_id")
    # The first event in the window, found by one pass over the pairs of an entity: no join back, no ranking of all of them.
    pairs = rows.join(happened, "krs").filter("effective_date > as_of_date and effective_date <= window_end")
    order = F.struct("effective_date", F.coalesce(position(list(rules.precedence), F.col("label_class")), F.lit(99)), "dedup_group_id")
    first = pairs.groupBy("krs", "as_of_date", "horizon_months").agg(F.min_by(F.struct("label_class", "event_type", "event_date", "event_known_from", "proceeding_id"), order).alias("t"))
    out = rows.join(first, ["krs", "as_of_date", "horizon_months"], "left")
    cls = F.col("t.label_class")
    merged = F.coalesce(cls == "merged_away", F.lit(False))
    note = F.when(cls.isNull() | merged | F.col("t.proceeding_id").isNotNull(), None).when(cls.isin("liquidation", "silent_exit") | (F.col("t.event_type") == "simplified_restructuring_announced"), "procedure_has_no_case").otherwise("source_omits_signature")
    return out.select(
        "krs",
        "as_of_date",
        "horizon_months",
        F.when(F.col("deregistered"), "deregistered").when(F.col("open"), "in_proceeding").alias("excluded_reason"),
        F.when(merged, None).when(cls.isNotNull(), cls).when(F.col("window_end") <= F.col("alive_limit"), "alive").alias("outcome_class"),
        (merged | (cls.isNull() & (F.col("window_end") > F.col("alive_limit")))).alias("censored"),
        F.col("t.event_date").alias("event_date"),
        F.col("t.event_known_from").alias("event_known_from"),
        F.col("t.event_type").alias("trigger_event_type"),
        F.col("t.proceeding_id").alias("proceeding_id"),
        note.alias("proceeding_id_note"),
        ((F.col("as_of_date") < F.lit(rules.regime_end).cast("date")) & (F.col("window_end") >= F.lit(rules.regime_start).cast("date"))).alias("regime_flag"),
        F.when(F.col("window_end") < launch, "pre_krz").when(F.col("as_of_date") >= F.date_sub(launch, 1), "krz").otherwise("mixed").alias("source_era"),
        "cutoff_date",
        F.lit(rules.version).alias("label_version"),
    )


def outcome_labels(grid: DataFrame) -> DataFrame:
    """The grid rows that count."""
    return grid.filter("excluded_reason is null").drop("excluded_reason")


def exclusions(grid: DataFrame, entities: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """How many grid rows each reason excludes by horizon, and the entities without a cutoff."""
    named = grid.filter("excluded_reason is not null").groupBy("horizon_months", F.col("excluded_reason").alias("reason")).agg(F.count_distinct("krs").alias("entities"), F.count("*").alias("n_rows"))
    none = entities.select("krs").distinct().join(grid.select("krs").distinct(), "krs", "left_anti").agg(F.count("*").alias("entities"))
    each = F.explode(F.array(*[F.lit(h) for h in horizons]))
    return named.unionByName(none.select(each.alias("horizon_months"), F.lit("no_cutoff").alias("reason"), "entities", F.lit(0).cast("long").alias("n_rows")))


def audits(grid: DataFrame, rules: LabelRules) -> DataFrame:
    """(audit, violations): what must be empty in a label grid."""
    end = window_end(F.col("as_of_date"), F.col("horizon_months"))
    on = F.coalesce("event_date", "event_known_from")
    launch = F.lit(rules.launch).cast("date")
    limit = F.when(end >= launch, F.add_months("cutoff_date", -rules.alive_lag_months)).otherwise(F.col("cutoff_date"))
    overlap = (F.col("as_of_date") < F.lit(rules.regime_end).cast("date")) & (end >= F.lit(rules.regime_start).cast("date"))
    tests = {
        "class_and_censoring_disagree": F.col("outcome_class").isNull() != F.col("censored"),
        "event_outside_window": on > end,
        "event_not_after_day": on <= F.col("as_of_date"),
        "alive_with_event": (F.col("outcome_class") == "alive") & F.col("trigger_event_type").isNotNull(),
        "alive_past_cutoff": (F.col("outcome_class") == "alive") & (end > limit),
        "event_without_case_or_reason": (F.col("outcome_class") != "alive") & F.col("proceeding_id").isNull() & F.col("proceeding_id_note").isNull(),
        "regime_flag_is_not_overlap": F.col("regime_flag") != overlap,
        "label_after_cutoff": F.col("as_of_date") > F.col("cutoff_date"),
        "not_a_month_end": F.col("as_of_date") != F.last_day("as_of_date"),
    }
    counts = grid.agg(*[F.count_if(F.coalesce(t, F.lit(False))).alias(n) for n, t in tests.items()])
    keys = grid.groupBy("krs", "as_of_date", "horizon_months").count().agg(F.count_if(F.col("count") > 1).alias("duplicate_key"))
    return counts.crossJoin(keys).unpivot([], [*tests, "duplicate_key"], "audit", "violations")


def frozen_hash(labels: DataFrame, keys: list[str]) -> str:
    """The content hash of a label set: sorted row digests, digested by prefix so that no group grows with the table."""
    columns = sorted(labels.columns)
    row = F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)
    part = labels.select(row.alias("row")).groupBy(F.substring("row", 1, 4).alias("part")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("row")), ""), 256).alias("digest"))
    return part.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "part", "digest"))), "\n"), 256)).first()[0]
