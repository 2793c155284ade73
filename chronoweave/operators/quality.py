"""Data quality: current rows of a log, checks with tolerance, severity and grade, pass rates, restatements, suspects."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.functions.values import ratio, suppress


def latest_run_rows(rows: DataFrame, run: str, seen_at: str) -> DataFrame:
    """The rows of the run last seen; ties by the run's id."""
    last = rows.groupBy(run).agg(F.max(seen_at).alias("_at")).orderBy(F.desc("_at"), run).limit(1).select(run)
    return rows.join(F.broadcast(last), run, "left_semi")


def check_status(left: Column, right: Column, tolerance: Column) -> Column:
    """pass within the tolerance, fail beyond it, not_applicable where a side is missing."""
    return F.when(left.isNull() | right.isNull(), "not_applicable").when(F.abs(left - right) <= tolerance, "pass").otherwise("fail")


def severity(status: Column, check: Column, kind: Column, difference: Column, assets: Column, share: float = 0.01, ties: tuple[str, ...] = ("balance", "profit", "cash_flow")) -> Column:
    """A failed check of the current year is material if it is a tie, or a subtotal off by more than a share of assets, or without assets."""
    far = assets.isNull() | (F.abs(difference) > F.lit(share).cast("decimal(10,4)") * F.abs(assets))
    return F.when((status == "fail") & (kind == "current_year") & (check.isin(*ties) | far), "material").when(status == "fail", "immaterial")


def grades(checks: DataFrame, file: list[str]) -> DataFrame:
    """quarantined with a material failure, warn with any, else pass; one row for each file."""
    worst = F.when(F.bool_or(F.coalesce(F.col("severity") == "material", F.lit(False))), "quarantined").when(F.bool_or(F.col("status") == "fail"), "warn").otherwise("pass")
    return checks.groupBy(*file).agg(worst.alias("quality_grade"), F.count_if(F.col("status") == "fail").alias("failed"))


def pass_rates(checks: DataFrame, file: list[str], by: list[str], entity: str, least_entities: int | None) -> DataFrame:
    """Files that passed, failed or had nothing to check, each once per check; measures of small cells are suppressed."""
    once = checks.groupBy(*by, *file, entity).agg(F.bool_or(F.col("status") == "fail").alias("failed"), F.bool_or(F.coalesce(F.col("severity") == "material", F.lit(False))).alias("material"), F.bool_and(F.col("status") == "not_applicable").alias("nothing"))
    counted = once.groupBy(*by).agg(
        F.count("*").alias("files"),
        F.count_if("failed").alias("files_failed"),
        F.count_if("material").alias("files_material"),
        F.count_if("nothing").alias("files_not_applicable"),
        F.count_if(~F.col("failed") & ~F.col("nothing")).alias("files_passed"),
        F.count_distinct(entity).alias("entities"),
    )
    rated = counted.withColumn("pass_rate", ratio(F.col("files_passed").cast("double"), (F.col("files_passed") + F.col("files_failed")).cast("double")))
    return suppress(rated, ["files_failed", "files_material", "files_not_applicable", "files_passed", "pass_rate"], "entities", least_entities)


def restatements(facts: DataFrame, tolerance: str = "0.05") -> DataFrame:
    """Prior-year values that differ from the year's own values as known before.

    ``facts``: krs, line_item, kind, period_start, period_end, known_from, document_ref, value. The earlier value is the latest one
    published before the restating file, for the period that ended on the day before the file's own starts.
    """
    now = facts.filter("kind = 'prior_year'").select("krs", "line_item", "document_ref", "known_from", F.date_sub("period_start", 1).alias("period_end"), F.col("value").alias("restated"))
    was = facts.filter("kind = 'current_year'").select("krs", "line_item", "period_end", F.col("known_from").alias("was_known"), F.col("document_ref").alias("was_ref"), F.col("value").alias("reported"))
    pairs = now.join(was, ["krs", "line_item", "period_end"]).filter("was_known < known_from")
    last = pairs.groupBy("krs", "line_item", "period_end", "document_ref", "known_from", "restated").agg(F.max_by(F.struct("was_ref", "reported"), F.struct("was_known", "was_ref", "reported")).alias("was"))
    out = last.select("krs", "line_item", "period_end", "document_ref", "known_from", F.col("was.was_ref").alias("restated_ref"), F.col("was.reported").alias("reported"), "restated")
    return out.withColumn("difference", F.col("restated") - F.col("reported")).filter(F.abs("difference") > F.lit(tolerance).cast("decimal(20,2)"))


def double_reported(facts: DataFrame) -> DataFrame:
    """(a_ref, b_ref, a, b): a file's value for its own year, and a later file's column for that year, of the same line."""
    own = facts.filter("kind = 'current_year'").select("krs", "line_item", "period_end", F.col("document_ref").alias("a_ref"), F.col("known_from").alias("a_known"), F.col("value").alias("a"))
    later = facts.filter("kind = 'prior_year'").select("krs", "line_item", F.date_sub("period_start", 1).alias("period_end"), F.col("document_ref").alias("b_ref"), F.col("known_from").alias("b_known"), F.col("value").alias("b"))
    return own.join(later, ["krs", "line_item", "period_end"]).filter("a_known < b_known").select("a_ref", "b_ref", "a", "b")


def unit_suspects(pairs: DataFrame, least_lines: int = 3, least_share: float = 0.5, near: float = 0.1, power: float = 3) -> DataFrame:
    """File pairs whose common lines lie about 10 ** ``power`` fold apart: ``pairs`` has a_ref, b_ref, a, b."""
    apart = F.abs(F.log10(F.abs(F.col("a").cast("double") / F.col("b").cast("double"))))
    usable = pairs.filter("a <> 0 and b <> 0").withColumn("apart", apart)
    found = usable.groupBy("a_ref", "b_ref").agg(F.count("*").alias("n_lines"), F.avg((F.abs(F.col("apart") - power) <= near).cast("double")).alias("share"), F.median("apart").alias("median_apart"))
    return found.filter((F.col("n_lines") >= least_lines) & (F.col("share") >= least_share))


def sign_suspects(facts: DataFrame, file: list[str], allowed: list[int], shown: int = 3) -> DataFrame:
    """Files with negative lines that may not be negative; the detail names the first ones."""
    below = facts.filter((F.col("value") < 0) & ~F.col("line_item").isin(*allowed))
    named = below.groupBy(*file).agg(F.array_sort(F.collect_set(F.col("line_item").cast("string"))).alias("found"))
    more = F.when(F.size("found") > shown, F.concat(F.lit(" and "), (F.size("found") - shown).cast("string"), F.lit(" more"))).otherwise("")
    return named.select(*file, F.size("found").cast("long").alias("n_lines"), F.concat(F.array_join(F.slice("found", 1, shown), ", "), more).alias("detail"))


@dataclass(frozen=True)
class Contract:
    """What a dataset promises: columns in order with types, a unique key, and conditions on each row."""

    schema: T.StructType
    unique: tuple[str, ...] = ()
    checks: dict[str, Column] = field(default_factory=dict)

    def violations(self, df: DataFrame) -> DataFrame:
        """(rule, violations): one pass for the row rules, one aggregate for the key."""
        names = [f.name for f in self.schema.fields]
        if df.columns != names or [f.dataType for f in df.schema.fields] != [f.dataType for f in self.schema.fields]:
            raise ValueError(f"columns are {df.dtypes}, not {[(f.name, f.dataType.simpleString()) for f in self.schema.fields]}")
        tests = {f"null:{f.name}": F.col(f.name).isNull() for f in self.schema.fields if not f.nullable}
        tests |= {n: ~F.coalesce(c, F.lit(True)) for n, c in self.checks.items()}
        rows = df.agg(F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in tests.items()]).unpivot([], [*tests, "rows"], "rule", "violations").filter("rule <> 'rows'")
        if not self.unique:
            return rows
        keys = df.groupBy(*self.unique).count().agg(F.count_if(F.col("count") > 1).alias("violations")).select(F.lit("unique:" + ",".join(self.unique)).alias("rule"), "violations")
        return rows.unionByName(keys)
