"""Families of features: what an entity's files, signals, reports and classes said by a day, and the store of them all.

Every family is a plan from a grid (krs, as_of_date) and named sources to long values (krs, as_of_date, feature, value,
known_from). A fact that isn't established gives no row, never a 0. ``FAMILIES`` names them; ``compute`` puts them together.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chronoweave.functions.values import ratio
from chronoweave.operators.features import KEYS, event_counts, filing_metrics
from chronoweave.operators.temporal import asof_join, visible_at

LONG = [*KEYS, "feature", "value", "known_from"]
SIZE_RANKS = ("micro", "small", "medium", "large")
READ = ("read", "partial")
DAYS_PER_YEAR = 365.25


def input_values(facts: DataFrame, items: dict[str, list]) -> DataFrame:
    """(document_ref, kind, input, line_item, value): the line that carries each named input of a file's column.

    ``items``: the line codes of each input. A column that carries an input by two codes is an error.
    """
    code = F.col("line_item")
    name = reduce(lambda out, i: F.when(code.isin(*items[i]), i).otherwise(out), reversed(items), F.lit(None).cast("string"))
    rows = facts.filter(F.col("kind").isin("current_year", "prior_year")).withColumn("input", name).filter("input is not null")
    found = rows.groupBy("document_ref", "kind", "input").agg(F.min("line_item").alias("line_item"), F.max("line_item").alias("_last"), F.max_by("value", "line_item").alias("value"))
    clash = found.filter("line_item <> _last").limit(1).collect()
    if clash:
        raise ValueError(f"{clash[0]['input']} is carried by {clash[0]['line_item']} and {clash[0]['_last']} in {clash[0]['document_ref']}")
    return found.drop("_last")


def statement_filings(parts: DataFrame, status: DataFrame, grades: DataFrame, types: list) -> DataFrame:
    """One row for each statement filing: its parts merged. Present while any part is: deleted once all are, on the last's day.

    ``parts``: krs, document_ref, type_code, file_name, period_start, period_end, submission_date, deleted_on, is_correction.
    A filing without a submission date is known on no day and left out. It is PDF if every part is, quarantined if any is.
    """
    key = ["krs", "document_ref"]
    told = status.groupBy(*key).agg(F.bool_or(F.col("status") == "needs_pdf_tier").alias("pdf"), F.bool_or(F.col("status") == "quarantined").alias("refused"))
    graded = grades.groupBy(*key).agg(F.bool_or(F.col("quality_grade") == "quarantined").alias("bad"))
    own = parts.filter(F.col("type_code").isin(*types) & F.col("submission_date").isNotNull()).join(told, key, "left").join(graded, key, "left")
    no = F.lit(False)
    pdf = F.coalesce("pdf", no) | F.coalesce(F.lower("file_name").endswith(".pdf"), no)
    merged = own.groupBy("krs", "period_start", "period_end", F.col("submission_date").alias("known_from"), F.coalesce("is_correction", no).alias("is_correction")).agg(
        F.when(F.count("deleted_on") == F.count("*"), F.max("deleted_on")).alias("deleted_on"),
        F.bool_and(pdf).alias("is_pdf"),
        F.bool_or(F.coalesce("refused", no) | F.coalesce("bad", no)).alias("is_quarantined"),
    )
    return merged.select("krs", "period_start", "period_end", "known_from", "deleted_on", "is_correction", "is_pdf", "is_quarantined")


def with_deletion(files: DataFrame, filings: DataFrame) -> DataFrame:
    """Rows of files with the day their filing was deleted; a filing listed twice counts by its least day, null first."""
    known = filings.groupBy("krs", "document_ref").agg(F.when(F.count("deleted_on") == F.count("*"), F.min("deleted_on")).alias("deleted_on"))
    return files.drop("deleted_on").join(known, ["krs", "document_ref"], "left")


def latest_files(grid: DataFrame, files: DataFrame, take: list[str], by: tuple[str, ...] = (), only: Column | None = None) -> DataFrame:
    """Of each period the latest file known on a grid row's day and not deleted by it, with the columns asked for.

    Later is by known_from, then document_ref and source_member: a correction replaces. ``by``: further keys; ``only``: files that count.
    """
    some = files if only is None else files.filter(only)
    seen = visible_at(some, grid.select(*KEYS), ["krs"]).filter(F.col("deleted_on").isNull() | (F.col("as_of_date") < F.col("deleted_on")))
    last = F.max_by(F.struct("known_from", *take), F.struct("known_from", "document_ref", "source_member"))
    return seen.groupBy(*KEYS, *by, "period_end").agg(last.alias("_newest")).select(*KEYS, *by, "period_end", "_newest.*")


def latest_period(periods: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Of those, each grid row's latest period."""
    rest = [c for c in periods.columns if c not in (*KEYS, *by)]
    return periods.groupBy(*KEYS, *by).agg(F.max_by(F.struct(*rest), "period_end").alias("_newest")).select(*KEYS, *by, "_newest.*")


def _long(rows: DataFrame, values: dict[str, Column], known: str = "known_from") -> DataFrame:
    """Long values of some columns; nulls say nothing."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("feature"), v.cast("double").alias("value")) for n, v in values.items()]))
    return rows.select(*KEYS, F.col(known).alias("known_from"), each.alias("x")).select(*KEYS, "x.feature", "x.value", "known_from").filter("value is not null")


def _flagged_years(periods: DataFrame, flag: Column, name: str | Column) -> DataFrame:
    """How many periods are flagged; known from the last of those, or of all seen where none is."""
    counted = periods.withColumn("_on", flag).groupBy(*KEYS, *([] if isinstance(name, str) else ["_name"])).agg(
        F.count_if("_on").cast("double").alias("value"), F.coalesce(F.max(F.when(F.col("_on"), F.col("known_from"))), F.max("known_from")).alias("known_from")
    )
    return counted.select(*KEYS, (F.lit(name) if isinstance(name, str) else F.col("_name")).alias("feature"), "value", "known_from")


def disclosures(grid: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Going concern in doubt, and employment, as the latest statement's introduction says them.

    ``disclosure``: a row for each file and item, value_bool or value_number.
    """
    files = sources["disclosure"]
    item = lambda name, column: F.max(F.when(F.col("item") == name, F.col(column)))
    wide = files.groupBy("krs", "document_ref", "source_member", "period_end", "known_from", "deleted_on").agg(item("going_concern", "value_bool").alias("sound"), item("employment", "value_number").alias("employment"))
    last = latest_period(latest_files(grid, wide, ["sound", "employment"]))
    return _long(last, {"going_concern_doubted": ~F.col("sound"), "employment": F.col("employment")})


def text_signals(grid: DataFrame, sources: dict[str, DataFrame], kind: str = "notes") -> DataFrame:
    """For each signal: whether the latest notes carry it, and in how many periods notes did.

    ``signal``: a row for each file, document_kind and signal_type, with status and kept_present. The flag is 1 if the signal was kept,
    0 only if the notes were read whole, else unknown. A period counts by its latest file that was read at least in part or has
    the signal: a correction nobody read doesn't erase what the original said.
    """
    own = sources["signal"].filter(F.col("document_kind") == kind)
    last = latest_period(latest_files(grid, own, ["status", "kept_present"], ("signal_type",)), ("signal_type",))
    flag = F.when(F.col("kept_present") > 0, 1.0).when(F.col("status") == "read", 0.0)
    flags = last.select(*KEYS, F.concat("signal_type", F.lit("_flag")).alias("feature"), flag.alias("value"), "known_from").filter("value is not null")
    seen = latest_files(grid, own, ["kept_present"], ("signal_type",), (F.col("kept_present") > 0) | F.col("status").isin(*READ))
    years = _flagged_years(seen.withColumn("_name", F.concat("signal_type", F.lit("_years"))), F.col("kept_present") > 0, F.col("_name"))
    return flags.unionByName(years)


def auditor_reports(reports: DataFrame, modified: tuple[str, ...] = ("qualified", "adverse", "disclaimer")) -> DataFrame:
    """Each report with ``modified_opinion`` and ``auditor_changed`` against the entity's latest report of an earlier period
    known when it was filed; both null where nothing is stated to compare.

    ``reports``: krs, document_ref, source_member, period_end, known_from, deleted_on, opinion, firm.
    """
    order = F.struct("b_end", "b_known", "b_ref", "b_member")
    before = reports.select("krs", F.col("period_end").alias("b_end"), F.col("known_from").alias("b_known"), F.col("document_ref").alias("b_ref"), F.col("source_member").alias("b_member"), F.col("firm").alias("b_firm"))
    pairs = reports.join(before, "krs").filter("b_end < period_end and b_known <= known_from")
    last = pairs.groupBy("krs", "document_ref", "source_member").agg(F.max_by(F.struct("b_ref", "b_firm"), order).alias("previous"))
    out = reports.join(last, ["krs", "document_ref", "source_member"], "left")
    changed = F.when(F.col("firm").isNotNull() & F.col("previous.b_firm").isNotNull(), F.col("firm") != F.col("previous.b_firm"))
    return out.withColumns({"modified_opinion": F.when(F.col("opinion").isNotNull(), F.col("opinion").isin(*modified)), "auditor_changed": changed, "compared_with": F.col("previous.b_ref")}).drop("previous")


def audits(grid: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """The latest auditor report's facts, the periods whose report showed them, and its age in years."""
    files = auditor_reports(sources["report"])
    last = latest_period(latest_files(grid, files, ["modified_opinion", "auditor_changed"]))
    age = F.datediff("as_of_date", "period_end") / DAYS_PER_YEAR
    out = _long(last, {"modified_opinion_flag": F.col("modified_opinion"), "auditor_changed_flag": F.col("auditor_changed"), "audit_age_years": age})
    for fact in ("modified_opinion", "auditor_changed"):
        out = out.unionByName(_flagged_years(latest_files(grid, files, [fact], only=F.col(fact).isNotNull()), F.col(fact), f"{fact}_years"))
    return out


def sizes(grid: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """The rank of the size class of the latest year known; nothing while that year is undetermined."""
    last = latest_period(latest_files(grid, sources["size"], ["size_class"]))
    rank = F.nullif(F.array_position(F.array(*[F.lit(c) for c in SIZE_RANKS]), F.col("size_class")), F.lit(0)) - 1
    return _long(last, {"size_rank": rank})


def revenue_bounds(codes: DataFrame, rules: list[tuple[str, list, list, list | None]]) -> DataFrame:
    """(document_ref, rule, low, high) of each file: the first rule all of whose codes the file carries.

    ``codes``: document_ref, line_item, value. A rule: its name, the codes it needs, and signed codes that sum up to the low and the high
    bound (None: no high one), of those it needs. No rule bounds nothing; nor does one whose bounds cross. A low bound is 0 at the least.
    """
    wanted = sorted({c for _, when, low, high in rules for c in [*when, *(c for _, c in [*low, *(high or [])])]})
    wide = codes.groupBy("document_ref").agg(*[F.sum(F.when(F.col("line_item") == c, F.col("value"))).alias(f"_{c}") for c in wanted])
    add = lambda parts: reduce(lambda a, b: a + b, [F.col(f"_{c}").cast("decimal(30,2)") * s for s, c in parts], F.lit(0).cast("decimal(30,2)")).cast("decimal(30,2)")
    found = F.lit(None).cast("struct<rule:string,low:decimal(30,2),high:decimal(30,2)>")
    for name, when, low, high in reversed(rules):
        holds = reduce(lambda a, b: a & b, [F.col(f"_{c}").isNotNull() for c in when])
        bounds = F.struct(F.lit(name).alias("rule"), add(low).alias("low"), (F.lit(None).cast("decimal(30,2)") if high is None else add(high)).alias("high"))
        found = F.when(holds, bounds).otherwise(found)
    rows = wide.select("document_ref", found.alias("b"))
    crossed = F.coalesce(F.col("b.high") < F.col("b.low"), F.lit(False))
    return rows.select("document_ref", F.col("b.rule").alias("rule"), F.when(~crossed, F.greatest(F.col("b.low"), F.lit(0).cast("decimal(30,2)"))).alias("low"), F.when(~crossed, F.col("b.high")).alias("high"))


def below_zero(value: Column) -> Column:
    """1 where a value is negative, 0 where it isn't, null where it is unknown."""
    return F.when(value.isNotNull(), (value < 0).cast("double"))


def financials(grid: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Features of the snapshot that a day sees: the latest one known by then.

    ``snapshot``: krs, known_on, period_end, assets, equity, profit, of each snapshot's latest period.
    """
    seen = asof_join(grid.select(*KEYS), sources["snapshot"], ["krs"], "as_of_date", "known_on", ["assets", "equity", "profit"])
    number = lambda c: F.col(c).cast("double")
    values = {"equity_to_assets": ratio(number("equity"), number("assets")), "return_on_assets": ratio(number("profit"), number("assets")), "profit_below_zero": below_zero(F.col("profit"))}
    return _long(seen, values, "known_on")


def filings(grid: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """How and when an entity files, and what its later filings restated."""
    names = ("days_to_file", "late_filings", "corrections", "statements_quarantined", "latest_filed_as_pdf", "missing_years")
    own = _long(filing_metrics(grid, sources["filing"]), {n: F.col(n) for n in names})
    seen = visible_at(sources["restatement"], grid.select(*KEYS), ["krs"]).filter(F.col("known_from") > F.add_months("as_of_date", -36))
    counted = seen.groupBy(*KEYS).agg(F.count_distinct("document_ref").alias("n"), F.max(F.abs("difference") / F.nullif(F.abs("reported"), F.lit(0))).alias("most"), F.max("known_from").alias("known_from"))
    return own.unionByName(_long(counted, {"restating_filings": F.col("n"), "restatement_max_share": F.col("most")}))


def _events(types: list[str], months: int) -> Callable[[DataFrame, dict[str, DataFrame]], DataFrame]:
    return lambda grid, sources: event_counts(grid, sources["legal"], types, months, sources["seen"]).select(*LONG).filter("value is not null")


#: Families of features: functions of (grid, sources) that give long values.
FAMILIES: dict[str, Callable[[DataFrame, dict[str, DataFrame]], DataFrame]] = {
    "financial": financials,
    "filing": filings,
    "registry": _events(["board_changed", "office_moved"], 24),
    "legal_history": _events(["bankruptcy_petition", "liquidation_opened"], 60),
    "disclosure": disclosures,
    "text": text_signals,
    "audit": audits,
    "size": sizes,
}

FEATURES = {
    "financial": ("equity_to_assets", "return_on_assets", "profit_below_zero"),
    "filing": ("days_to_file", "late_filings", "corrections", "statements_quarantined", "latest_filed_as_pdf", "missing_years", "restating_filings", "restatement_max_share"),
    "registry": ("board_changed_24m", "office_moved_24m"),
    "legal_history": ("bankruptcy_petition_60m", "liquidation_opened_60m"),
    "disclosure": ("going_concern_doubted", "employment"),
    "text": ("litigation_flag", "litigation_years", "going_concern_flag", "going_concern_years"),
    "audit": ("modified_opinion_flag", "auditor_changed_flag", "audit_age_years", "modified_opinion_years", "auditor_changed_years"),
    "size": ("size_rank",),
}


def compute(grid: DataFrame, sources: dict[str, DataFrame], families: tuple[str, ...] = tuple(FAMILIES)) -> DataFrame:
    """Every family's values for the grid, in one long table. A family reads only its own sources."""
    return reduce(lambda a, b: a.unionByName(b), [FAMILIES[f](grid, sources).select(*LONG) for f in families])
