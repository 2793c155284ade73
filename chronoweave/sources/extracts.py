"""Registry extracts and notices to events, histories to changes, and stored files to their fate; DataFrame functions only.

Whatever can't be read becomes a reject with a reason and the place it stands at, never nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEADER = "naglowekP.wpis"
DAY = "dd.MM.yyyy"


@dataclass(frozen=True)
class Rule:
    """What a record at a place of an extract means: its event, whose date is ``date_field`` (none: the entry's own), where ``test``
    (a field, and the values that count) holds and the day lies in force."""

    locator: str
    event_type: str
    stage: str
    outcome_class: str | None = None
    date_field: str | None = None
    test: tuple[str, tuple[str, ...]] | None = None
    valid_from: str | None = None
    valid_to: str | None = None


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def records(extracts: DataFrame, locators: list[str]) -> DataFrame:
    """(krs, locator, place, fields): every record at the given dotted places of an extract (krs, extract: JSON)."""
    each = []
    for locator in locators:
        found = F.from_json(F.get_json_object("extract", f"$.odpis.{locator}"), "array<map<string,string>>")
        each.append(extracts.select("krs", F.lit(locator).alias("locator"), F.posexplode(found).alias("place", "fields")))
    return _union(each)


def entry_dates(extracts: DataFrame) -> DataFrame:
    """(krs, entry, on, is_first): the dated entries of an extract's header."""
    rows = records(extracts, [HEADER]).select("krs", F.col("fields")["numerWpisu"].cast("long").alias("entry"), F.try_to_date(F.col("fields")["dataWpisu"], DAY).alias("on")).filter("entry is not null")
    first = rows.groupBy("krs").agg(F.min("entry").alias("first"))
    return rows.join(first, "krs").select("krs", "entry", "on", (F.col("entry") == F.col("first")).alias("is_first"))


def _in_force(rule: Rule, day: Column) -> Column:
    out = F.lit(True)
    if rule.valid_from:
        out = out & (day >= F.lit(rule.valid_from).cast("date"))
    if rule.valid_to:
        out = out & (day <= F.lit(rule.valid_to).cast("date"))
    return out


def extract_events(extracts: DataFrame, rules: list[Rule]) -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of extracts: krs, event_type, stage, outcome_class, event_date, known_from, removed_on, locator, place;
    and krs, locator, place, reason."""
    locators = sorted({r.locator for r in rules})
    rows = records(extracts, locators)
    dates = entry_dates(extracts).filter("on is not null")
    entered = dates.select("krs", F.col("entry").alias("entered"), F.col("on").alias("known_from"))
    removed = dates.select("krs", F.col("entry").alias("removed"), F.col("on").alias("removed_on"))
    number = lambda name: F.col("fields")[name].cast("long")
    rows = rows.withColumns({"entered": number("nrWpisuWprow"), "removed": number("nrWpisuWykr")}).join(entered, ["krs", "entered"], "left").join(removed, ["krs", "removed"], "left")
    fits = lambda r: (F.col("locator") == r.locator) & (F.lit(True) if r.test is None else F.coalesce(F.col("fields")[r.test[0]].isin(*r.test[1]), F.lit(False)))
    decided = lambda r: F.col("known_from") if r.date_field is None else F.try_to_date(F.col("fields")[r.date_field], DAY)
    said = F.lit(None).cast("struct<event_type:string,stage:string,outcome_class:string,event_date:date>")
    matches = F.lit(False)
    for r in reversed(rules):
        day = decided(r)
        one = F.struct(F.lit(r.event_type).alias("event_type"), F.lit(r.stage).alias("stage"), F.lit(r.outcome_class).cast("string").alias("outcome_class"), day.alias("event_date"))
        said = F.when(fits(r) & _in_force(r, F.coalesce(day, F.col("known_from"))), one).otherwise(said)
        matches = matches | fits(r)
    reason = F.when(~matches, "event_type_unmapped").when(F.col("known_from").isNull(), "entry_date_missing").when(said.isNull(), "no_mapping_in_force")
    judged = rows.withColumns({"reason": reason, "said": said})
    good = judged.filter("reason is null").select("krs", "said.*", "known_from", "removed_on", "locator", "place")
    return good, judged.filter("reason is not null").select("krs", "locator", "place", "reason")


def history_changes(extracts: DataFrame, replaced: dict[str, tuple[list[str], str]], membership: dict[str, tuple[str, str]], exit_field: str, exit_values: list[str]) -> tuple[DataFrame, DataFrame]:
    """(events, rejects): what a section's history says when its entries are compared.

    ``replaced``: of a place, the fields to compare and the event. A record entered later than the first entry, by an entry that
    removed another, is a change unless one it removed was the same. ``membership``: of a place, the events of joining and leaving; who was
    there at the first entry did not join, and what an exit (a header entry whose ``exit_field`` says so) removed did not leave.
    """
    dates = entry_dates(extracts)
    header = records(extracts, [HEADER])
    exits = header.filter(F.col("fields")[exit_field].isin(*exit_values)).select("krs", F.col("fields")["numerWpisu"].cast("long").alias("entry")).distinct()
    firsts = dates.filter("is_first").select("krs", F.col("entry").alias("first")).distinct()
    found = []
    for locator, (fields, event) in replaced.items():
        rows = records(extracts, [locator]).withColumns({"entry": F.col("fields")["nrWpisuWprow"].cast("long"), "removed": F.col("fields")["nrWpisuWykr"].cast("long")})
        what = F.array(*[F.coalesce(F.col("fields")[f], F.lit("")) for f in fields])
        new = rows.join(firsts, "krs").filter("entry is not null and entry <> first").select("krs", "place", "entry", what.alias("what"))
        old = rows.filter("removed is not null").select("krs", F.col("removed").alias("entry"), what.alias("was"))
        pairs = new.join(old, ["krs", "entry"]).groupBy("krs", "place", "entry").agg(F.bool_or(F.col("what") == F.col("was")).alias("same"))
        found.append(pairs.filter("not same").select("krs", "entry", F.lit(event).alias("event_type"), F.lit(locator).alias("locator"), "place"))
    for locator, (joins, leaves) in membership.items():
        rows = records(extracts, [locator])
        entered = rows.select("krs", F.col("fields")["nrWpisuWprow"].cast("long").alias("entry"), "place").filter("entry is not null").join(firsts, "krs").filter("entry <> first")
        gone = rows.select("krs", F.col("fields")["nrWpisuWykr"].cast("long").alias("entry"), "place").filter("entry is not null")
        for part, event in ((entered.drop("first"), joins), (gone, leaves)):
            found.append(part.join(exits, ["krs", "entry"], "left_anti").select("krs", "entry", F.lit(event).alias("event_type"), F.lit(locator).alias("locator"), "place"))
    met = _union(found).join(dates.filter("on is not null").select("krs", "entry", "on"), ["krs", "entry"], "left")
    good = met.filter("on is not null").select("krs", "event_type", F.col("on").alias("known_from"), F.col("on").alias("event_date"), "locator", "place")
    return good, met.filter("on is null").select("krs", "locator", "place", F.lit("entry_date_missing").alias("reason"))


def notice_events(notices: DataFrame, taxonomy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(events, rejects) of classified notices: notice_id, krs, kind (null: unclassified), published_on, decided_on, signature.

    ``taxonomy``: kind, event_type, valid_from, valid_to: which event a kind is on a day, the decision's or, without one, publication's.
    """
    day = F.coalesce("decided_on", "published_on")
    met = notices.join(taxonomy, "kind", "left").withColumn("_holds", F.col("event_type").isNotNull() & (day >= F.col("valid_from")) & (F.col("valid_to").isNull() | (day <= F.col("valid_to"))))
    judged = met.groupBy(*notices.columns).agg(F.min(F.when(F.col("_holds"), F.col("event_type"))).alias("event_type"))
    reason = F.when(F.col("kind").isNull(), "notice_unclassified").when(F.col("event_type").isNull(), "event_type_unmapped")
    good = judged.filter("event_type is not null").select("notice_id", "krs", "event_type", F.col("decided_on").alias("event_date"), F.col("published_on").alias("known_from"), "signature")
    return good, judged.filter("event_type is null").select("notice_id", "krs", reason.alias("reason"))


def split_violations(violations: DataFrame, tolerances: DataFrame) -> DataFrame:
    """Schema violations (file_id, structure, path, kind) with the tolerance that allows each, null where none does.

    ``tolerances``: tolerance_id, structure, kind, pattern: an entry for the structure that lists the kind and whose pattern the path
    matches; a ``*`` in a pattern is one step. A violation without a path is never tolerated. The first by id counts.
    """
    steps = F.concat(F.lit("^"), F.replace(F.replace("pattern", F.lit("."), F.lit("\\.")), F.lit("*"), F.lit("[^/]+")), F.lit("$")).alias("_steps")
    allowed = tolerances.select("tolerance_id", "structure", "kind", steps)
    rows = violations.withColumn("_row", F.monotonically_increasing_id())
    hits = rows.join(allowed, ["structure", "kind"]).filter(F.expr("path rlike _steps")).groupBy("_row").agg(F.min("tolerance_id").alias("tolerance_id"))
    return rows.join(hits, "_row", "left").drop("_row")


def classify_files(members: DataFrame, catalogue: DataFrame, violations: DataFrame) -> DataFrame:
    """Each member's fate: valid, not_yet_mapped, needs_pdf_tier or quarantined, with the reason of the first test that fails.

    ``members``: file_id, kind, reason (what unwrapping said, if it failed), structure, document_ref (null: no filing claims it).
    ``catalogue``: structure, mapped. ``violations``: as ``split_violations`` gives them. Detached signatures are no files.
    """
    refused = violations.filter("tolerance_id is null").groupBy("file_id").agg(F.count("*").alias("refused"))
    tolerated = violations.filter("tolerance_id is not null").groupBy("file_id").agg(F.count("*").alias("tolerated"))
    rows = members.filter("kind is null or kind <> 'detached_signature'").join(catalogue, "structure", "left").join(refused, "file_id", "left").join(tolerated, "file_id", "left")
    tests = [
        (F.col("reason").isNotNull(), "quarantined", F.col("reason")),
        (F.col("document_ref").isNull(), "quarantined", F.lit("member_not_in_filing_index")),
        (F.col("kind") == "pdf", "needs_pdf_tier", F.lit(None)),
        (F.col("mapped").isNull(), "quarantined", F.lit("unknown_structure_version")),
        (~F.col("mapped"), "not_yet_mapped", F.lit(None)),
        (F.col("refused") > 0, "quarantined", F.lit("xsd_invalid")),
    ]
    said = F.struct(F.lit("valid").alias("status"), F.lit(None).cast("string").alias("reason_code"))
    for test, status, why in reversed(tests):
        said = F.when(test, F.struct(F.lit(status).alias("status"), why.cast("string").alias("reason_code"))).otherwise(said)
    return rows.withColumn("_said", said).select("file_id", "document_ref", "_said.status", "_said.reason_code", F.coalesce("tolerated", F.lit(0)).cast("long").alias("tolerated"))


def introductions(statements: DataFrame, block: str, items: dict[str, tuple[str, str]], encoding: dict[str, bool]) -> tuple[DataFrame, DataFrame]:
    """(disclosures, rejects) of statements (file_id, xml): file_id, item, value_bool, value_number, value_text.

    ``items``: name to (element below the block, kind): a ``flag`` is read by the encoding, a ``number`` as one, ``text_present`` by
    whether the element says anything. An element that isn't there says nothing; two blocks, and values that can't be read, are rejects.
    """
    at = f"//*[local-name()='{block}']"
    rows = statements.withColumn("_blocks", F.xpath_int("xml", F.lit(f"count({at})"))).filter("_blocks > 0")
    told = []
    for name, (element, kind) in items.items():
        path = f"{at}/*[local-name()='{element}']"
        # XPath has no null: an element that is there is counted, then read.
        value = F.when(F.xpath_int("xml", F.lit(f"count({path})")) > 0, F.trim(F.xpath_string("xml", F.lit(path))))
        told.append(F.struct(F.lit(name).alias("item"), F.lit(kind).alias("kind"), value.alias("text")))
    each = rows.filter("_blocks = 1").select("file_id", F.explode(F.array(*told)).alias("x")).select("file_id", "x.*").filter("text is not null")
    known = F.create_map(*[F.lit(v) for pair in encoding.items() for v in pair])
    flag, number = F.element_at(known, F.col("text")), F.col("text").try_cast("decimal(30,6)")
    bad = ((F.col("kind") == "flag") & flag.isNull()) | ((F.col("kind") == "number") & number.isNull())
    value = F.when(F.col("kind") == "flag", flag).when(F.col("kind") == "text_present", F.col("text") != "")
    good = each.filter(~bad).select("file_id", "item", value.alias("value_bool"), F.when(F.col("kind") == "number", number).alias("value_number"), F.when(F.col("kind") != "text_present", F.col("text")).alias("value_text"))
    many = rows.filter("_blocks > 1").select("file_id", F.lit(None).cast("string").alias("item"), F.lit("introduction_ambiguous").alias("reason"))
    return good, many.unionByName(each.filter(bad).select("file_id", "item", F.lit("introduction_value_unknown").alias("reason")))
