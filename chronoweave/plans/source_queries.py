"""Queries over extracts, notices, schema tolerances, classification and introductions: documents made from the tables, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book
from chronoweave.sources import extracts as x

QUERIES = Book()

RULES = [
    x.Rule("dzial6.upadlosc", "bankruptcy_declared", "opening", "bankruptcy", "dataWydania", ("rodzaj", ("declared",)), valid_from="2016-06-01"),
    x.Rule("dzial6.likwidacja", "liquidation_opened", "opening", "liquidation", None),
]


def _extracts(t: Tables) -> DataFrame:
    """One extract for each entity: its dated entries, and records of proceedings, seats and board members."""
    day = lambda c: F.date_format(c, x.DAY)
    number = lambda c: F.col(c).cast("string")
    following = Window.partitionBy("krs").orderBy("event_id")
    seats = Window.partitionBy("krs", "event_type").orderBy("event_id")
    rows = t.legal.withColumns({"next_entry": F.lead("event_id").over(following), "next_seat": F.lead("event_id").over(seats)})
    kind = lambda *types: F.col("event_type").isin(*types)
    entry = F.struct(number("event_id").alias("numerWpisu"), F.when(F.col("event_id") % 17 != 0, day("known_from")).alias("dataWpisu"), F.when(kind("deregistered"), "exit").alias("opis"))
    case = F.when(kind("bankruptcy_declared", "bankruptcy_petition"), F.struct(number("event_id").alias("nrWpisuWprow"), day("event_date").alias("dataWydania"), F.when(kind("bankruptcy_declared"), "declared").otherwise("petition").alias("rodzaj"), number("next_entry").alias("nrWpisuWykr")))
    ending = F.when(kind("liquidation_opened"), F.struct(number("event_id").alias("nrWpisuWprow")))
    seat = F.when(kind("office_moved"), F.struct(number("event_id").alias("nrWpisuWprow"), F.concat(F.lit("city"), (F.col("event_id") % 3).cast("string")).alias("miejscowosc"), number("next_seat").alias("nrWpisuWykr")))
    board = F.when(kind("board_changed"), F.struct(number("event_id").alias("nrWpisuWprow"), number("next_entry").alias("nrWpisuWykr")))
    listed = lambda c: F.array_sort(F.collect_list(c))
    whole = F.struct(
        F.struct(listed(entry).alias("wpis")).alias("naglowekP"), F.struct(F.struct(listed(seat).alias("adres")).alias("siedziba")).alias("dzial1"), F.struct(listed(board).alias("zarzad")).alias("dzial2"),
        F.struct(listed(case).alias("upadlosc"), listed(ending).alias("likwidacja")).alias("dzial6"),
    )
    return rows.groupBy("krs").agg(F.to_json(F.struct(whole.alias("odpis"))).alias("extract"))


READ = "read_from AS (SELECT *, event_id % 17 <> 0 AS dated, lead(event_id) OVER (PARTITION BY krs ORDER BY event_id) AS next_entry FROM legal)"


@QUERIES.query(f"""WITH {READ} SELECT r.krs, r.event_type, 'opening' AS stage, r.outcome_class, CASE r.event_type WHEN 'liquidation_opened' THEN r.known_from ELSE r.event_date END AS event_date, r.known_from, CASE WHEN r.event_type = 'bankruptcy_declared' THEN o.known_from END AS removed_on
FROM read_from r LEFT JOIN read_from o ON o.krs = r.krs AND o.event_id = r.next_entry AND o.dated WHERE r.dated AND (r.event_type = 'liquidation_opened' OR (r.event_type = 'bankruptcy_declared' AND coalesce(r.event_date, r.known_from) >= DATE '2016-06-01'))""")
def extract_events(t: Tables) -> DataFrame:
    return x.extract_events(_extracts(t), RULES)[0].drop("locator", "place")


@QUERIES.query(f"""WITH {READ} SELECT krs, CASE WHEN event_type = 'bankruptcy_petition' THEN 'event_type_unmapped' WHEN NOT dated THEN 'entry_date_missing' ELSE 'no_mapping_in_force' END AS reason, count(*) AS n FROM read_from
WHERE event_type = 'bankruptcy_petition' OR (event_type IN ('bankruptcy_declared', 'liquidation_opened') AND NOT dated) OR (event_type = 'bankruptcy_declared' AND coalesce(event_date, known_from) < DATE '2016-06-01') GROUP BY ALL""")
def extract_rejects(t: Tables) -> DataFrame:
    return x.extract_events(_extracts(t), RULES)[1].groupBy("krs", "reason").agg(F.count("*").alias("n"))


@QUERIES.query(f"""WITH {READ}, firsts AS (SELECT krs, min(event_id) AS first_id FROM legal GROUP BY krs), gone AS (SELECT krs, event_id FROM legal WHERE event_type = 'deregistered'),
seats AS (SELECT *, lag(event_id % 3) OVER (PARTITION BY krs ORDER BY event_id) AS city_before FROM read_from WHERE event_type = 'office_moved'),
found AS (SELECT s.krs, s.event_id, 'seat_replaced' AS event_type FROM seats s JOIN firsts f ON f.krs = s.krs WHERE s.event_id <> f.first_id AND s.city_before <> s.event_id % 3
  UNION ALL SELECT b.krs, b.event_id, 'member_joined' FROM read_from b JOIN firsts f ON f.krs = b.krs WHERE b.event_type = 'board_changed' AND b.event_id <> f.first_id
  UNION ALL SELECT b.krs, b.next_entry, 'member_left' FROM read_from b WHERE b.event_type = 'board_changed' AND b.next_entry IS NOT NULL AND NOT EXISTS (SELECT 1 FROM gone g WHERE g.krs = b.krs AND g.event_id = b.next_entry))
SELECT f.krs, f.event_type, r.known_from FROM found f JOIN read_from r ON r.krs = f.krs AND r.event_id = f.event_id WHERE r.dated""")
def history_changes(t: Tables) -> DataFrame:
    found, _ = x.history_changes(_extracts(t), {"dzial1.siedziba.adres": (["miejscowosc"], "seat_replaced")}, {"dzial2.zarzad": ("member_joined", "member_left")}, "opis", ["exit"])
    return found.select("krs", "event_type", "known_from")


_KINDS = "kinds(kind, event_type, valid_from, valid_to) AS (VALUES ('opening', 'opened_old', DATE '2016-01-01', DATE '2018-12-31'), ('opening', 'opened_new', DATE '2019-01-01', NULL), ('closing', 'closed', DATE '2017-01-01', NULL))"
_NOTICES = "told AS (SELECT event_id, krs, CASE WHEN stage IN ('opening', 'closing') THEN stage END AS kind, event_date, known_from FROM legal WHERE source = 'MSiG')"


def _notices(t: Tables) -> tuple[DataFrame, DataFrame]:
    stage = F.when(F.col("stage").isin("opening", "closing"), F.col("stage"))
    notices = t.legal.filter("source = 'MSiG'").select(F.col("event_id").alias("notice_id"), "krs", stage.alias("kind"), F.col("known_from").alias("published_on"), F.col("event_date").alias("decided_on"), F.col("proceeding_id").alias("signature"))
    kinds = t.spark.sql("VALUES ('opening', 'opened_old', DATE '2016-01-01', DATE '2018-12-31'), ('opening', 'opened_new', DATE '2019-01-01', CAST(NULL AS DATE)), ('closing', 'closed', DATE '2017-01-01', CAST(NULL AS DATE)) AS k(kind, event_type, valid_from, valid_to)")
    return x.notice_events(notices, kinds)


@QUERIES.query(f"WITH {_KINDS}, {_NOTICES} SELECT n.event_id AS notice_id, n.krs, k.event_type, n.event_date, n.known_from FROM told n JOIN kinds k ON k.kind = n.kind AND coalesce(n.event_date, n.known_from) BETWEEN k.valid_from AND coalesce(k.valid_to, DATE '9999-01-01')")
def notice_events(t: Tables) -> DataFrame:
    return _notices(t)[0].drop("signature")


@QUERIES.query(f"WITH {_KINDS}, {_NOTICES} SELECT event_id AS notice_id, krs, CASE WHEN kind IS NULL THEN 'notice_unclassified' ELSE 'event_type_unmapped' END AS reason FROM told n WHERE NOT EXISTS (SELECT 1 FROM kinds k WHERE k.kind = n.kind AND coalesce(n.event_date, n.known_from) >= k.valid_from AND (k.valid_to IS NULL OR coalesce(n.event_date, n.known_from) <= k.valid_to))")
def notice_rejects(t: Tables) -> DataFrame:
    return _notices(t)[1]


_FILES = """files AS (SELECT document_ref AS file_id, CASE document_ref % 8 WHEN 0 THEN 'pdf' WHEN 1 THEN 'detached_signature' ELSE 'xml' END AS kind, CASE WHEN document_ref % 19 = 0 THEN 'xml_malformed' END AS reason, 'S:' || CAST(document_ref % 5 AS VARCHAR) AS structure, CASE WHEN document_ref % 23 <> 0 THEN document_ref END AS document_ref FROM filing),
broken AS (SELECT file_id, structure, CASE WHEN file_id % 7 <> 6 THEN 'Bilans/Aktywa_' || CAST(file_id % 3 AS VARCHAR) || '/KwotaA' END AS path, CASE WHEN file_id % 2 = 0 THEN 'pattern' ELSE 'missing' END AS kind FROM files WHERE file_id % 4 <> 0),
split AS (SELECT b.*, CASE WHEN structure = 'S:1' AND kind = 'pattern' AND path IS NOT NULL THEN 't1' WHEN structure = 'S:2' AND kind = 'missing' AND path = 'Bilans/Aktywa_1/KwotaA' THEN 't2' END AS tolerance_id FROM broken b)"""


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    ref = F.col("document_ref")
    files = t.filing.select(
        ref.alias("file_id"), F.when(ref % 8 == 0, "pdf").when(ref % 8 == 1, "detached_signature").otherwise("xml").alias("kind"), F.when(ref % 19 == 0, "xml_malformed").alias("reason"),
        F.concat(F.lit("S:"), (ref % 5).cast("string")).alias("structure"), F.when(ref % 23 != 0, ref).alias("document_ref"),
    )
    own = F.col("file_id")
    broken = files.filter("file_id % 4 <> 0").select("file_id", "structure", F.when(own % 7 != 6, F.concat(F.lit("Bilans/Aktywa_"), (own % 3).cast("string"), F.lit("/KwotaA"))).alias("path"), F.when(own % 2 == 0, "pattern").otherwise("missing").alias("kind"))
    tolerances = t.spark.sql("VALUES ('t1', 'S:1', 'pattern', 'Bilans/*/KwotaA'), ('t1', 'S:1', 'pattern', 'Bilans/Aktywa_0/KwotaA'), ('t2', 'S:2', 'missing', 'Bilans/Aktywa_1/KwotaA'), ('t3', 'S:2', 'missing', 'Bilans') AS v(tolerance_id, structure, kind, pattern)")
    return files, x.split_violations(broken, tolerances)


@QUERIES.query(f"WITH {_FILES} SELECT file_id, path, kind, tolerance_id FROM split")
def tolerated_violations(t: Tables) -> DataFrame:
    return _split(t)[1].select("file_id", "path", "kind", "tolerance_id")


@QUERIES.query(f"""WITH {_FILES}, bad AS (SELECT file_id, count(*) FILTER (WHERE tolerance_id IS NULL) AS refused, count(tolerance_id) AS tolerated FROM split GROUP BY file_id),
judged AS (SELECT f.*, coalesce(b.refused, 0) AS refused, coalesce(b.tolerated, 0) AS tolerated, CASE WHEN reason IS NOT NULL THEN 1 WHEN document_ref IS NULL THEN 2 WHEN kind = 'pdf' THEN 3 WHEN structure = 'S:4' THEN 4 WHEN structure = 'S:3' THEN 5 WHEN b.refused > 0 THEN 6 ELSE 7 END AS k FROM files f LEFT JOIN bad b USING (file_id) WHERE kind <> 'detached_signature')
SELECT file_id, document_ref, CASE WHEN k IN (1, 2, 4, 6) THEN 'quarantined' WHEN k = 3 THEN 'needs_pdf_tier' WHEN k = 5 THEN 'not_yet_mapped' ELSE 'valid' END AS status, CASE k WHEN 1 THEN reason WHEN 2 THEN 'member_not_in_filing_index' WHEN 4 THEN 'unknown_structure_version' WHEN 6 THEN 'xsd_invalid' END AS reason_code, tolerated FROM judged""")
def classified_files(t: Tables) -> DataFrame:
    files, violations = _split(t)
    catalogue = t.spark.sql("VALUES ('S:0', true), ('S:1', true), ('S:2', true), ('S:3', false) AS c(structure, mapped)")
    return x.classify_files(files, catalogue, violations)


def _statements(t: Tables) -> DataFrame:
    ref = F.col("document_ref")
    intro = F.concat(
        F.lit("<n:Wstep>"), F.when(ref % 3 != 0, F.concat(F.lit("<n:Kontynuacja>"), F.when(ref % 10 == 9, "maybe").when(ref % 2 == 0, "tak").otherwise("nie"), F.lit("</n:Kontynuacja>"))).otherwise(""),
        F.lit("<n:Zatrudnienie> "), F.when(ref % 13 == 0, "many").otherwise((ref % 700).cast("string")), F.lit("</n:Zatrudnienie>"), F.when(ref % 4 == 0, "<n:Opis/>").when(ref % 4 == 1, "<n:Opis>x</n:Opis>").otherwise(""), F.lit("</n:Wstep>"),
    )
    body = F.when(ref % 29 == 0, F.concat(intro, intro)).when(ref % 31 == 0, "").otherwise(intro)
    return t.filing.select(ref.alias("file_id"), F.concat(F.lit('<n:Jednostka xmlns:n="urn:x">'), body, F.lit("<n:Bilans>1</n:Bilans></n:Jednostka>")).alias("xml"))


_INTRO = "one AS (SELECT document_ref AS r FROM filing WHERE document_ref % 29 <> 0 AND document_ref % 31 <> 0)"
_ITEMS = {"going_concern": ("Kontynuacja", "flag"), "employment": ("Zatrudnienie", "number"), "described": ("Opis", "text_present")}


@QUERIES.query(f"""WITH {_INTRO} SELECT r AS file_id, 'going_concern' AS item, r % 2 = 0 AS value_bool, NULL::DECIMAL(30,6) AS value_number, CASE WHEN r % 2 = 0 THEN 'tak' ELSE 'nie' END AS value_text FROM one WHERE r % 3 <> 0 AND r % 10 <> 9
UNION ALL SELECT r, 'employment', NULL, CAST(r % 700 AS DECIMAL(30,6)), CAST(r % 700 AS VARCHAR) FROM one WHERE r % 13 <> 0 UNION ALL SELECT r, 'described', r % 4 = 1, NULL, NULL FROM one WHERE r % 4 IN (0, 1)""")
def introductions(t: Tables) -> DataFrame:
    return x.introductions(_statements(t), "Wstep", _ITEMS, {"tak": True, "nie": False})[0]


@QUERIES.query(f"""WITH {_INTRO} SELECT document_ref AS file_id, NULL::VARCHAR AS item, 'introduction_ambiguous' AS reason FROM filing WHERE document_ref % 29 = 0
UNION ALL SELECT r, 'going_concern', 'introduction_value_unknown' FROM one WHERE r % 3 <> 0 AND r % 10 = 9 UNION ALL SELECT r, 'employment', 'introduction_value_unknown' FROM one WHERE r % 13 = 0""")
def introduction_rejects(t: Tables) -> DataFrame:
    return x.introductions(_statements(t), "Wstep", _ITEMS, {"tak": True, "nie": False})[1]
