"""What is quarantined now, from whichever source knows it; identity checks by role and by rule; audits of both."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.values import distinct_sorted
from chronoweave.operators.quality import check_status

#: Log reasons that record something allowed, and those that flag a file without refusing it.
ALLOWED = ("xsd_tolerated", "unit_corrected")
FLAGS = ("unit_suspected", "sign_suspected")
PARSING, KEYED = ("C1", "C2"), ("A1", "A2", "A3", "A4", "C4")
SET = ["stage", "entity_key", "file_hash", "reason_codes", "known_from"]


def _latest(log: DataFrame, by: list[str], take: list[str]) -> DataFrame:
    """The distinct sorted reasons of each key's last day of detection: by day first, then the last day's, so no key is ranked."""
    daily = log.groupBy(*by, *take, "created_at").agg(distinct_sorted(F.col("reason_code")).alias("found"))
    last = daily.groupBy(*by).agg(F.max("created_at").alias("created_at"))
    return daily.join(last, [*by, "created_at"]).groupBy(*by, *take).agg(F.first("found").alias("reason_codes"))


def current_set(graded: DataFrame, checks: DataFrame, parsed: DataFrame, log: DataFrame, coverage: DataFrame) -> DataFrame:
    """stage, entity_key, file_hash, reason_codes, known_from, first_detected_at of everything quarantined now.

    ``graded``: entity_key, file_hash, known_from, quality_grade. ``checks``: file_hash, check_name, severity. ``parsed``: entity_key,
    file_hash, known_from, status, of the last run. ``log``: stage, entity_key, file_hash, reason_code, created_at, an
    append-only record of detections. ``coverage``: entity_key, file_hash, known_from, signal_type, attachment_errors, discarded, discard_reasons.

    Grades say E2 (reasons: the checks that failed materially); the last parsing run says C1 and C2 (stage and reasons of the latest
    detection); for acquisition keys the log alone speaks; text coverage says G1 (a file with an unreadable attachment) and G2 (a
    discarded signal). What the current rules let pass stays in the log and isn't selected.
    """
    because = checks.filter("severity = 'material'").groupBy("file_hash").agg(distinct_sorted(F.col("check_name")).alias("reason_codes"))
    e2 = graded.filter("quality_grade = 'quarantined'").select("entity_key", "file_hash", "known_from").distinct().join(because, "file_hash", "left").withColumn("stage", F.lit("E2"))
    told = _latest(log.filter(F.col("stage").isin(*PARSING) & ~F.col("reason_code").isin(*ALLOWED)), ["entity_key", "file_hash"], ["stage"])
    c = parsed.filter("status = 'quarantined'").select("entity_key", "file_hash", "known_from").join(told, ["entity_key", "file_hash"], "left")
    keyed = log.filter(F.col("stage").isin(*KEYED))
    a = _latest(keyed, ["stage", "entity_key"], []).withColumns({"file_hash": F.lit(None).cast("string"), "known_from": F.lit(None).cast("date")})
    g1 = coverage.filter(F.size("attachment_errors") > 0).groupBy("entity_key", "file_hash", "known_from").agg(F.max("attachment_errors").alias("reason_codes")).withColumn("stage", F.lit("G1"))
    g2 = coverage.filter("discarded > 0").select(F.concat_ws(":", "entity_key", "signal_type").alias("entity_key"), "file_hash", "known_from", F.col("discard_reasons").alias("reason_codes"), F.lit("G2").alias("stage"))
    every = reduce(lambda x, y: x.unionByName(y), [x.select(*SET) for x in (e2, c, a, g1, g2)])
    # Parsing stages are one stage to the log, and acquisition keys have no file.
    group = F.when(F.col("stage").isin(*PARSING), "C").otherwise(F.col("stage"))
    whose = F.when(~F.col("stage").isin(*KEYED), F.col("file_hash"))
    first = log.filter(~F.col("reason_code").isin(*ALLOWED, *FLAGS)).groupBy(group.alias("_group"), F.col("entity_key").alias("_key"), whose.alias("_hash")).agg(F.min("created_at").alias("first_detected_at"))
    met = every.join(first, (group == F.col("_group")) & (F.col("entity_key") == F.col("_key")) & whose.eqNullSafe(F.col("_hash")), "left")
    return met.select(*SET, "first_detected_at")


def quarantine_audits(current: DataFrame, graded: DataFrame, parsed: DataFrame) -> DataFrame:
    """(audit, violations): every key says why; a file is refused at one parsing stage; grades and the last run agree with the set."""
    counts = current.agg(
        F.count_if(F.coalesce(F.size("reason_codes"), F.lit(0)) <= 0).alias("no_reason"),
        F.count_if(F.col("stage") == "E2").alias("e2"),
        F.count_if(F.col("stage").isin(*PARSING)).alias("c"),
    )
    stages = current.filter(F.col("stage").isin(*PARSING, "E2")).groupBy("file_hash").agg(F.count_distinct("stage").alias("n")).agg(F.count_if(F.col("n") > 1).alias("two_stages"))
    files = graded.filter("quality_grade = 'quarantined'").select("entity_key", "file_hash").distinct().agg(F.count("*").alias("graded_files"))
    runs = parsed.filter("status = 'quarantined'").agg(F.count("*").alias("parsed_files"))
    one = counts.crossJoin(stages).crossJoin(files).crossJoin(runs)  # four rows of counts
    rules = {"no_reason": F.col("no_reason"), "two_parsing_stages": F.col("two_stages"), "grades_disagree": F.abs(F.col("e2") - F.col("graded_files")), "parsing_disagrees": F.abs(F.col("c") - F.col("parsed_files"))}
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("audit"), v.cast("long").alias("violations")) for n, v in rules.items()]))
    return one.select(each.alias("x")).select("x.*")


def mart_audits(cells: DataFrame, least: int | None, measures: list[str], whole: str, parts: list[str]) -> DataFrame:
    """(audit, violations): of published cells, none below the threshold unsuppressed, none suppressed without a threshold, no measure in
    a suppressed one, and parts that add up to the whole."""
    off = F.col("suppressed")
    anything = reduce(lambda a, b: a | b, [F.col(m).isNotNull() for m in measures])
    total = reduce(lambda a, b: a + b, [F.col(p) for p in parts])
    rules = {
        "small_cell_published": ~off & (F.col("entities") < F.lit(least)) if least is not None else F.lit(False),
        "suppressed_without_threshold": off if least is None else F.lit(False),
        "suppressed_with_measures": off & anything,
        "parts_do_not_add_up": ~off & (F.col(whole) != total),
    }
    counts = cells.agg(*[F.count_if(F.coalesce(r, F.lit(False))).alias(n) for n, r in rules.items()])
    return counts.unpivot([], list(rules), "audit", "violations")


def role_values(facts: DataFrame, keys: list[str], roles: dict[str, list]) -> DataFrame:
    """One row for each file and column with the value of each role: the first of its codes that is reported."""
    wanted = sorted({c for codes in roles.values() for c in codes})
    wide = facts.groupBy(*keys).agg(*[F.sum(F.when(F.col("line_item") == c, F.col("value"))).alias(f"_{c}") for c in wanted])
    return wide.select(*keys, *[F.coalesce(*[F.col(f"_{c}") for c in codes]).alias(role) for role, codes in roles.items()])


def ties(values: DataFrame, keys: list[str], tolerance: Column) -> DataFrame:
    """The checks that tie statements together: check_name, expected, actual, difference, status.

    Assets are equity and liabilities; the result is the balance sheet's; the net cash flow is closing less opening cash, and a
    difference that the exchange-rate effect explains passes. Where a side is missing the check does not apply.
    """
    movement = F.col("cash_closing") - F.col("cash_opening")
    pairs = {"balance": (F.col("assets"), F.col("equity_and_liabilities")), "profit": (F.col("result"), F.col("result_in_balance")), "cash_flow": (movement, F.col("net_cash_flow"))}
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("check_name"), e.alias("expected"), a.alias("actual")) for n, (e, a) in pairs.items()]))
    rows = values.select(*keys, "cash_fx", each.alias("x")).select(*keys, "cash_fx", "x.*")
    status = check_status(F.col("actual"), F.col("expected"), tolerance)
    fx = (F.col("check_name") == "cash_flow") & (F.col("cash_fx") != 0) & (F.abs(F.abs(F.col("expected") - F.col("actual")) - F.abs("cash_fx")) <= tolerance)
    rows = rows.withColumn("difference", F.col("actual") - F.col("expected"))
    return rows.withColumn("status", F.when((status == "fail") & F.coalesce(fx, F.lit(False)), "pass").otherwise(status)).drop("cash_fx")


def subtotals(facts: DataFrame, keys: list[str], rules: DataFrame, tolerance: Column) -> DataFrame:
    """Every reported line that a rule computes, against its reported operands; a line none of whose operands is reported isn't checked.

    ``rules``: line_item, sign, operand: a table of the forms, so small that it is joined, never looped over.
    """
    lines = facts.groupBy(*keys, "line_item").agg(F.sum("value").alias("value"))
    parts = lines.withColumnRenamed("line_item", "operand").join(rules, "operand")
    sums = parts.groupBy(*keys, "line_item").agg(F.sum(F.col("value") * F.col("sign")).alias("expected"))
    met = lines.withColumnRenamed("value", "actual").join(sums, [*keys, "line_item"])
    return met.withColumn("difference", F.col("actual") - F.col("expected")).withColumn("status", check_status(F.col("actual"), F.col("expected"), tolerance))


def attach_lineage(results: DataFrame, lineage: DataFrame, key: list[str]) -> DataFrame:
    """Check results with their file's lineage; a file with two lineages is an error."""
    twice = lineage.distinct().groupBy(*key).count().filter("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two lineages for {twice[0].asDict()}")
    return results.join(lineage.distinct(), key, "left")


def stale(stored: DataFrame, computed: DataFrame) -> DataFrame:
    """(side, n_rows): rows only stored, and rows only computed; none where the stored table is what its inputs give now."""
    columns = sorted(stored.columns)
    gone = stored.select(*columns).exceptAll(computed.select(*columns)).agg(F.count("*").alias("n_rows")).withColumn("side", F.lit("stored"))
    new = computed.select(*columns).exceptAll(stored.select(*columns)).agg(F.count("*").alias("n_rows")).withColumn("side", F.lit("computed"))
    return gone.unionByName(new).select("side", "n_rows")
