"""Legal events: signatures, canonical events, exits, coverage, proceedings that belong together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.values import distinct_sorted
from chronoweave.operators.temporal import settled

CLASSES = ("bankruptcy", "restructuring", "liquidation")


def normalised_signature(text: Column) -> Column:
    """A case signature in upper case, parts joined by slashes; what follows the year, its fourth part, is dropped. Null if empty."""
    parts = F.filter(F.split(F.upper(F.regexp_replace(F.trim(text), r"\.+$", "")), r"[\s/]+"), lambda p: p != "")
    four = F.when((F.size(parts) > 4) & F.get(parts, F.lit(3)).rlike(r"^(\d{2}|\d{4})$"), F.slice(parts, 1, 4)).otherwise(parts)
    return F.nullif(F.array_join(four, "/"), F.lit(""))


def canonical_events(events: DataFrame) -> DataFrame:
    """One event per dedup group, with the class a label takes from it.

    A deregistration takes the class of the latest earlier proceeding of its entity; without one it is a silent exit, or
    ``merged_away`` where an earlier event precludes that.
    """
    generic = F.col("event_type") == "restructuring_proceedings_opened"
    groups = events.groupBy("dedup_group_id").agg(
        F.min("krs").alias("krs"),
        F.min_by("event_type", F.struct(generic, "event_type")).alias("event_type"),
        F.min("outcome_class").alias("outcome_class"),
        F.min("stage").alias("stage"),
        F.min_by("ends", "event_type").alias("ends"),
        F.bool_or("precludes_silent_exit").alias("precludes_silent_exit"),
        F.min("event_date").alias("event_date"),
        F.min("known_from").alias("known_from"),
        F.min("proceeding_id").alias("proceeding_id"),
        distinct_sorted(F.col("source")).alias("sources"),
    )
    groups = groups.withColumn("effective_date", F.coalesce("event_date", "known_from"))
    exits = groups.filter("event_type = 'deregistered'").select("dedup_group_id", "krs", F.col("effective_date").alias("left_on"))
    before = groups.select("krs", F.col("dedup_group_id").alias("p_id"), F.col("outcome_class").alias("p_class"), F.col("proceeding_id").alias("p_case"), F.col("effective_date").alias("p_on"), "precludes_silent_exit")
    earlier = exits.join(before, "krs").filter("p_on <= left_on")
    # The latest day's proceeding, on one day the first by id: least by days back, then by id.
    days_back = F.struct(F.datediff("left_on", "p_on"), "p_id")
    latest = F.min_by(F.struct("p_class", "p_case"), F.when(F.col("p_class").isin(*CLASSES), days_back))
    found = earlier.groupBy("dedup_group_id").agg(
        latest.alias("prior"),
        F.coalesce(F.bool_or(F.col("precludes_silent_exit") & (F.col("p_id") != F.col("dedup_group_id"))), F.lit(False)).alias("precluded"),
    )
    label = (
        F.when(F.col("event_type") != "deregistered", F.col("outcome_class"))
        .when(F.col("prior.p_class").isNotNull(), F.col("prior.p_class"))
        .when(F.col("precluded"), "merged_away")
        .otherwise("silent_exit")
    )
    out = groups.join(found, "dedup_group_id", "left")
    return out.withColumn("label_class", label).withColumn("proceeding_id", F.coalesce("proceeding_id", "prior.p_case")).drop("prior", "precluded")


def coverage(canonical: DataFrame, registry_types: tuple[str, ...] = ("registered", "board_changed", "office_moved", "capital_changed")) -> DataFrame:
    """Events per source and year of publication; ``both`` where more than one source has an event. Registry types are left out."""
    source = F.when(F.size("sources") > 1, "both").otherwise(F.get("sources", F.lit(0)))
    rows = canonical.filter(~F.col("event_type").isin(*registry_types))
    return rows.groupBy(source.alias("source"), F.year("known_from").alias("event_year"), "event_type").agg(F.count("*").alias("events"), F.count_distinct("krs").alias("entities"))


def linked_proceedings(pairs: DataFrame, published: DataFrame) -> DataFrame:
    """(krs, signature, proceeding_id): signatures named together are one proceeding, within an entity.

    ``pairs``: krs, a, b. ``published``: krs, signature, published_on. A proceeding is named by the signature published first,
    then the first by alphabet. Rounds contract the pairs: every name goes over to the least of its neighbours and itself, and pairs
    of one name fall away, until none is left; a chain of any length takes about the logarithm of it. A signature that was never
    published links what is paired with it, but gets no row.
    """
    both = pairs.unionByName(pairs.select("krs", F.col("b").alias("a"), F.col("a").alias("b"))).filter("a is not null and b is not null").distinct()
    own = published.groupBy("krs", "signature").agg(F.min("published_on").alias("published_on"))
    unseen = both.select("krs", F.col("a").alias("signature")).distinct().join(own, ["krs", "signature"], "left_anti")
    # Names compare by day, unpublished ones last, then by alphabet.
    name = F.struct(F.col("published_on").isNull().alias("late"), F.col("published_on").alias("on"), F.col("signature").alias("signature"))
    names = own.unionByName(unseen.withColumn("published_on", F.lit(None).cast(own.schema["published_on"].dataType))).select("krs", "signature", name.alias("name"))
    named = lambda side: names.select("krs", F.col("signature").alias(side), F.col("name").alias(f"{side}_name"))
    edges = settled(both.join(named("a"), ["krs", "a"]).join(named("b"), ["krs", "b"]).select("krs", F.col("a_name").alias("a"), F.col("b_name").alias("b")).filter("not (a <=> b)").distinct())
    labels = settled(names.select("krs", "signature", F.col("name").alias("label")))
    while not edges.isEmpty():
        near = settled(edges.groupBy("krs", "a").agg(F.min("b").alias("least")).select("krs", F.col("a").alias("was"), F.least("a", "least").alias("now")))
        labels = settled(_moved(labels, "label", near))
        edges = settled(_moved(_moved(edges, "a", near), "b", near).filter("not (a <=> b)").distinct())
    return labels.join(own.select("krs", "signature"), ["krs", "signature"]).select("krs", "signature", F.col("label.signature").alias("proceeding_id"))


def _moved(rows: DataFrame, column: str, near: DataFrame) -> DataFrame:
    """The rows with a name replaced by the one it went over to, if it did."""
    # A signature has one name, so it stands for it.
    to = near.select("krs", F.col("was.signature").alias("_key"), F.col("now").alias("_now"))
    met = rows.withColumn("_key", F.col(f"{column}.signature")).join(to, ["krs", "_key"], "left")
    return met.select(*[F.coalesce("_now", column).alias(column) if c == column else F.col(c) for c in rows.columns])
