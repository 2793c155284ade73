"""From registry records to events: taxonomy, dates before registration, dedup groups, content changes, work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.values import all_reasons


def resolved(records: DataFrame, taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mapped, quarantined): records with the one mapping of their source and locator in force on their day.

    ``taxonomy``: source, locator, valid_from, valid_to (null: open), event_type. None in force is quarantined; two are an error of the
    taxonomy, reported as such.
    """
    rows = records.withColumn("_id", F.monotonically_increasing_id())
    both = rows.join(taxonomy, ["source", "locator"], "left")
    holds = F.col("event_type").isNotNull() & (F.col("known_from") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("known_from") <= F.col("valid_to")))
    judged = both.groupBy("_id", *records.columns).agg(F.count_if(holds).alias("n"), F.min(F.when(holds, F.col("event_type"))).alias("event_type"))
    bad = judged.filter("n <> 1").select(*records.columns, F.when(F.col("n") == 0, "no_mapping").otherwise("two_mappings").alias("reason"))
    return judged.filter("n = 1").select(*records.columns, "event_type"), bad


def dates_since_registration(events: DataFrame, source: str) -> DataFrame:
    """Nulls event dates of a source that lie before the entity was registered; ``date_dropped`` says where."""
    registered = F.min(F.when(F.col("event_type") == "registered", F.coalesce("event_date", "known_from"))).over(Window.partitionBy("krs"))
    before = (F.col("source") == source) & F.coalesce(F.col("event_date") < registered, F.lit(False))
    return events.withColumn("date_dropped", before).withColumn("event_date", F.when(~F.col("date_dropped"), F.col("event_date")))


def dedup_groups(events: DataFrame, within_days: int = 366) -> DataFrame:
    """Adds ``dedup_group_id``: one event told by several records.

    A record is anchored by its case, else its date, else its publication. One without a date joins the one dated group of its entity and
    type that was decided at most ``within_days`` before it became known, if there is exactly one such group.
    """
    kind = F.when(F.col("stage") == "opening", F.coalesce("outcome_class", "event_type")).otherwise(F.col("event_type"))
    anchor = F.when(F.col("proceeding_id").isNotNull(), F.concat(F.lit("case:"), "proceeding_id")).when(F.col("event_date").isNotNull(), F.concat(F.lit("date:"), F.col("event_date").cast("string"))).otherwise(F.concat(F.lit("known:"), F.col("known_from").cast("string")))
    rows = events.withColumn("_kind", kind).withColumn("_anchor", anchor)
    dated = rows.filter("event_date is not null").groupBy("krs", "_kind", "_anchor").agg(F.min("event_date").alias("_decided"))
    loose = rows.filter("event_date is null and proceeding_id is null").select("krs", "_kind", "known_from").distinct()
    near = loose.join(dated, ["krs", "_kind"]).filter((F.col("_decided") <= F.col("known_from")) & (F.datediff("known_from", "_decided") <= within_days))
    only = near.groupBy("krs", "_kind", "known_from").agg(F.count("*").alias("_n"), F.min("_anchor").alias("_adopted")).filter("_n = 1").drop("_n")
    joined = rows.join(only, ["krs", "_kind", "known_from"], "left")
    own = F.when(F.col("event_date").isNull() & F.col("proceeding_id").isNull(), F.coalesce("_adopted", "_anchor")).otherwise(F.col("_anchor"))
    return joined.withColumn("dedup_group_id", F.sha2(F.concat_ws("|", "krs", "_kind", own), 256)).drop("_kind", "_anchor", "_adopted")


def content_changes(fetches: DataFrame, key: str, at: str, content: Column) -> DataFrame:
    """The fetches whose content differs from the one before: unchanged content is stored once."""
    own = Window.partitionBy(key).orderBy(at)
    hashed = fetches.withColumn("content_hash", F.sha2(content.cast("string"), 256))
    return hashed.withColumn("_before", F.lag("content_hash").over(own)).filter(~F.col("_before").eqNullSafe(F.col("content_hash"))).drop("_before")


def violations(rows: DataFrame, key: str, rules: list[tuple[str, Column]]) -> DataFrame:
    """(key, reason) for every rule that a row violates."""
    return rows.select(key, F.explode(all_reasons(rules)).alias("reason"))


def pending(work: DataFrame, results: DataFrame, quarantined: DataFrame, key: list[str]) -> DataFrame:
    """Work with neither a result nor a quarantine row."""
    return work.join(results.select(*key), key, "left_anti").join(quarantined.select(*key), key, "left_anti")


def realised(scores: DataFrame, labels: DataFrame, today: str, keys: list[str], settles_on: Column) -> DataFrame:
    """Scores joined with outcomes of the cohorts that have settled by a day: what calibration may be judged on."""
    return scores.join(labels, keys).filter(settles_on <= F.lit(today).cast("date"))


def funnel(stages: dict[str, DataFrame], lists: DataFrame, key: str = "krs", name: str = "list_name") -> DataFrame:
    """Members of each list that reached each stage: a stage's members counted by list, 0 where none did."""
    out = None
    for stage, members in stages.items():
        reached = lists.join(members.select(key).distinct().withColumn("_in", F.lit(1)), key, "left").groupBy(name).agg(F.lit(stage).alias("stage"), F.count("_in").alias("n"))
        out = reached if out is None else out.unionByName(reached)
    return out


def filed_bodies(elements: DataFrame, alternatives: list[tuple[str, str]], fallback: str) -> DataFrame:
    """(file, bodies, fell_back): for each file the bodies whose path prefix an element has, joined by +; else the fallback, reported."""
    named = F.explode(F.array(*[F.struct(F.lit(b).alias("body"), F.lit(p).alias("prefix")) for b, p in alternatives]))
    rows = elements.select("file", "path", named.alias("a"))
    found = rows.groupBy("file").agg(F.array_sort(F.collect_set(F.when(F.col("path").startswith(F.col("a.prefix")), F.col("a.body")))).alias("found"))
    none = F.size("found") == 0
    return found.select("file", F.when(none, F.lit(fallback)).otherwise(F.array_join("found", "+")).alias("bodies"), none.alias("fell_back"))
