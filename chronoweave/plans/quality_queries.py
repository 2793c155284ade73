"""Queries over the quarantined set, the identity checks and their audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chronoweave.operators import quality, quarantine
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book

QUERIES = Book()

#: The five sources as CASEs over all filings: what each stage knows of every file.
SOURCES = """graded AS (SELECT krs || ':' || CAST(document_ref AS VARCHAR) AS entity_key, 'h' || CAST(document_ref AS VARCHAR) AS file_hash, known_from, CASE WHEN document_ref % 6 = 0 THEN 'quarantined' ELSE 'pass' END AS quality_grade FROM filing),
checks_of AS (SELECT 'h' || CAST(document_ref AS VARCHAR) AS file_hash, c AS check_name, CASE WHEN document_ref % 6 = 0 AND (document_ref // 6) % 3 <> i THEN 'material' END AS severity FROM filing CROSS JOIN (VALUES ('balance', 0), ('profit', 1)) v(c, i)),
parsed AS (SELECT krs || ':' || CAST(document_ref AS VARCHAR) AS entity_key, 'h' || CAST(document_ref AS VARCHAR) AS file_hash, known_from, CASE WHEN document_ref % 6 = 1 THEN 'quarantined' ELSE 'valid' END AS status FROM filing),
log AS (SELECT CASE document_ref % 6 WHEN 0 THEN 'E2' WHEN 1 THEN 'C' || CAST(1 + n % 2 AS VARCHAR) WHEN 2 THEN 'A' || CAST(1 + document_ref % 4 AS VARCHAR) WHEN 3 THEN 'C4' WHEN 4 THEN 'C1' ELSE 'G1' END AS stage,
    CASE WHEN document_ref % 6 IN (2, 3) THEN krs ELSE krs || ':' || CAST(document_ref AS VARCHAR) END AS entity_key, 'h' || CAST(document_ref AS VARCHAR) AS file_hash,
    CASE (document_ref + n) % 5 WHEN 0 THEN 'xsd_tolerated' WHEN 1 THEN 'xsd_invalid' WHEN 2 THEN 'unit_suspected' WHEN 3 THEN 'member_unknown' ELSE 'xml_malformed' END AS reason_code, known_from + n * 30 AS created_at FROM filing CROSS JOIN (VALUES (0), (1), (3)) d(n)),
covered AS (SELECT krs || ':' || CAST(document_ref AS VARCHAR) AS entity_key, 'h' || CAST(document_ref AS VARCHAR) AS file_hash, known_from, s AS signal_type, CASE WHEN document_ref % 6 = 5 THEN ['bad_base64', 'no_pages'] ELSE [] END AS attachment_errors, CASE WHEN document_ref % 12 = 4 AND s = 'litigation' THEN 1 ELSE 0 END AS discarded, ['no_quote'] AS discard_reasons FROM filing CROSS JOIN (VALUES ('litigation'), ('going_concern')) v(s))"""

CURRENT = SOURCES + """, kept_log AS (SELECT *, stage IN ('A1', 'A2', 'A3', 'A4', 'C4') AS by_key, stage IN ('C1', 'C2') AS in_parsing FROM log),
births AS (SELECT CASE WHEN in_parsing THEN 'C' ELSE stage END AS kin, entity_key, CASE WHEN NOT by_key THEN file_hash END AS own_hash, min(created_at) AS first_detected_at FROM kept_log WHERE reason_code NOT IN ('xsd_tolerated', 'unit_corrected', 'unit_suspected', 'sign_suspected') GROUP BY ALL),
told AS (SELECT stage, entity_key, file_hash, reason_code FROM kept_log WHERE in_parsing AND reason_code NOT IN ('xsd_tolerated', 'unit_corrected') QUALIFY created_at = max(created_at) OVER (PARTITION BY entity_key, file_hash)),
spoken AS (SELECT stage, entity_key, reason_code FROM kept_log WHERE by_key QUALIFY rank() OVER (PARTITION BY stage, entity_key ORDER BY created_at DESC) = 1),
stacked AS (
  SELECT 'E2' AS stage, g.entity_key, g.file_hash, (SELECT string_agg(DISTINCT k.check_name, ',' ORDER BY k.check_name) FROM checks_of k WHERE k.file_hash = g.file_hash AND k.severity = 'material') AS reasons, g.known_from FROM graded g WHERE g.quality_grade = 'quarantined'
  UNION ALL SELECT t.stage, p.entity_key, p.file_hash, string_agg(DISTINCT t.reason_code, ',' ORDER BY t.reason_code), p.known_from FROM parsed p LEFT JOIN told t USING (entity_key, file_hash) WHERE p.status = 'quarantined' GROUP BY ALL
  UNION ALL SELECT stage, entity_key, NULL, string_agg(DISTINCT reason_code, ',' ORDER BY reason_code), NULL FROM spoken GROUP BY stage, entity_key
  UNION ALL SELECT DISTINCT 'G1', entity_key, file_hash, array_to_string(attachment_errors, ','), known_from FROM covered WHERE len(attachment_errors) > 0
  UNION ALL SELECT 'G2', entity_key || ':' || signal_type, file_hash, array_to_string(discard_reasons, ','), known_from FROM covered WHERE discarded > 0
), current_set AS (SELECT s.*, b.first_detected_at FROM stacked s LEFT JOIN births b ON b.entity_key = s.entity_key AND b.kin = CASE WHEN s.stage IN ('C1', 'C2') THEN 'C' ELSE s.stage END AND b.own_hash IS NOT DISTINCT FROM s.file_hash)"""


def _sources(t: Tables) -> tuple[DataFrame, ...]:
    ref, key = F.col("document_ref"), F.concat_ws(":", "krs", F.col("document_ref").cast("string"))
    hashed = F.concat(F.lit("h"), ref.cast("string"))
    f = t.filing
    graded = f.select(key.alias("entity_key"), hashed.alias("file_hash"), "known_from", F.when(ref % 6 == 0, "quarantined").otherwise("pass").alias("quality_grade"))
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.lit(i).alias("i")) for i, n in enumerate(("balance", "profit"))]))
    checks = f.select(hashed.alias("file_hash"), ref, kinds.alias("c")).select("file_hash", F.col("c.name").alias("check_name"), F.when((ref % 6 == 0) & (F.floor(ref / 6) % 3 != F.col("c.i")), "material").alias("severity"))
    parsed = f.select(key.alias("entity_key"), hashed.alias("file_hash"), "known_from", F.when(ref % 6 == 1, "quarantined").otherwise("valid").alias("status"))
    n = F.col("n")
    stage = F.when(ref % 6 == 0, "E2").when(ref % 6 == 1, F.concat(F.lit("C"), (1 + n % 2).cast("string"))).when(ref % 6 == 2, F.concat(F.lit("A"), (1 + ref % 4).cast("string"))).when(ref % 6 == 3, "C4").when(ref % 6 == 4, "C1").otherwise("G1")
    reasons = F.array(*[F.lit(x) for x in ("xsd_tolerated", "xsd_invalid", "unit_suspected", "member_unknown", "xml_malformed")])
    log = f.withColumn("n", F.explode(F.array(F.lit(0), F.lit(1), F.lit(3)))).select(
        stage.alias("stage"), F.when((ref % 6).isin(2, 3), F.col("krs")).otherwise(key).alias("entity_key"), hashed.alias("file_hash"), F.get(reasons, ((ref + n) % 5).cast("int")).alias("reason_code"), F.date_add("known_from", n * 30).alias("created_at")
    )
    signal = F.explode(F.array(F.lit("litigation"), F.lit("going_concern")))
    covered = f.withColumn("signal_type", signal).select(
        key.alias("entity_key"), hashed.alias("file_hash"), "known_from", "signal_type", F.when(ref % 6 == 5, F.array(F.lit("bad_base64"), F.lit("no_pages"))).otherwise(F.array().cast("array<string>")).alias("attachment_errors"),
        F.when((ref % 12 == 4) & (F.col("signal_type") == "litigation"), 1).otherwise(0).alias("discarded"), F.array(F.lit("no_quote")).alias("discard_reasons"),
    )
    return graded, checks, parsed, log, covered


@QUERIES.query(f"WITH {CURRENT} SELECT stage, entity_key, file_hash, reasons AS reason_codes, known_from, first_detected_at FROM current_set")
def quarantine_current_set(t: Tables) -> DataFrame:
    return quarantine.current_set(*_sources(t)).withColumn("reason_codes", F.array_join("reason_codes", ","))


_FAULTY = CURRENT + ", faulty AS (SELECT stage, CASE WHEN entity_key LIKE '%7' THEN 'h7' ELSE file_hash END AS file_hash, CASE WHEN entity_key LIKE '%3' THEN NULL ELSE reasons END AS reasons FROM current_set WHERE NOT (stage = 'E2' AND entity_key LIKE '%2'))"


@QUERIES.query(f"""WITH {_FAULTY} SELECT 'no_reason' AS audit, count(*) FILTER (WHERE reasons IS NULL) AS violations FROM faulty
UNION ALL SELECT 'two_parsing_stages', count(*) FROM (SELECT file_hash FROM faulty WHERE stage IN ('C1', 'C2', 'E2') GROUP BY file_hash HAVING count(DISTINCT stage) > 1)
UNION ALL SELECT 'grades_disagree', abs((SELECT count(*) FROM faulty WHERE stage = 'E2') - (SELECT count(*) FROM graded WHERE quality_grade = 'quarantined'))
UNION ALL SELECT 'parsing_disagrees', abs((SELECT count(*) FROM faulty WHERE stage IN ('C1', 'C2')) - (SELECT count(*) FROM parsed WHERE status = 'quarantined'))""")
def quarantine_audits(t: Tables) -> DataFrame:
    """The audits on a set with planted faults: reasons taken away, files made one, graded files left out."""
    sources = _sources(t)
    current = quarantine.current_set(*sources)
    faulty = current.filter(~((F.coalesce("stage", F.lit("")) == "E2") & F.col("entity_key").endswith("2")))
    faulty = faulty.withColumns({"file_hash": F.when(F.col("entity_key").endswith("7"), "h7").otherwise(F.col("file_hash")), "reason_codes": F.when(~F.col("entity_key").endswith("3"), F.col("reason_codes"))})
    return quarantine.quarantine_audits(faulty, sources[0], sources[2])


ROLES = """valued AS (SELECT document_ref, kind, CAST(sum(value) FILTER (WHERE line_item = 1) AS DECIMAL(30,2)) AS l1, CAST(sum(value) FILTER (WHERE line_item = 2) AS DECIMAL(30,2)) AS l2, CAST(sum(value) FILTER (WHERE line_item = 3) AS DECIMAL(30,2)) AS l3,
  CAST(sum(value) FILTER (WHERE line_item = 4) AS DECIMAL(30,2)) AS l4, CAST(sum(value) FILTER (WHERE line_item = 5) AS DECIMAL(30,2)) AS l5, CAST(sum(value) FILTER (WHERE line_item = 6) AS DECIMAL(30,2)) AS l6, CAST(sum(value) FILTER (WHERE line_item = 7) AS DECIMAL(30,2)) AS l7 FROM fact GROUP BY ALL)"""


@QUERIES.query(f"""WITH {ROLES}, sides AS (SELECT document_ref, kind, 'balance' AS check_name, coalesce(l1, l7) AS expected, l2 AS actual, NULL AS fx FROM valued
UNION ALL SELECT document_ref, kind, 'profit', l3, coalesce(l4, l5), NULL FROM valued UNION ALL SELECT document_ref, kind, 'cash_flow', l2 - l1, l3, l4 FROM valued)
SELECT document_ref, kind, check_name, expected, actual, actual - expected AS difference,
  CASE WHEN expected IS NULL OR actual IS NULL THEN 'not_applicable' WHEN abs(actual - expected) <= 15000 THEN 'pass' WHEN fx <> 0 AND abs(abs(expected - actual) - abs(fx)) <= 15000 THEN 'pass' ELSE 'fail' END AS status FROM sides""")
def statement_ties(t: Tables) -> DataFrame:
    roles = {"assets": [1, 7], "equity_and_liabilities": [2], "result": [3], "result_in_balance": [4, 5], "cash_opening": [1], "cash_closing": [2], "net_cash_flow": [3], "cash_fx": [4]}
    values = quarantine.role_values(t.fact, ["document_ref", "kind"], roles)
    values = values.withColumns({r: F.col(r).cast("decimal(30,2)") for r in roles})
    return quarantine.ties(values, ["document_ref", "kind"], F.lit(15000))


@QUERIES.query("""WITH lines AS (SELECT document_ref, kind, line_item, sum(value) AS v FROM fact GROUP BY ALL), rules(code, sign, part) AS (VALUES (1, 1, 2), (1, 1, 3), (4, 1, 5), (4, -1, 6)),
s AS (SELECT l.document_ref, l.kind, l.line_item, l.v AS actual, sum(r.sign * p.v) AS expected FROM lines l JOIN rules r ON r.code = l.line_item JOIN lines p ON p.document_ref = l.document_ref AND p.kind = l.kind AND p.line_item = r.part GROUP BY ALL)
SELECT document_ref, kind, line_item, CAST(actual AS DECIMAL(30,2)) AS actual, CAST(expected AS DECIMAL(30,2)) AS expected, CASE WHEN abs(actual - expected) <= 20000 THEN 'pass' ELSE 'fail' END AS status FROM s""")
def subtotal_checks(t: Tables) -> DataFrame:
    rules = t.spark.sql("VALUES (1, 1, 2), (1, 1, 3), (4, 1, 5), (4, -1, 6) AS r(line_item, sign, operand)")
    out = quarantine.subtotals(t.fact, ["document_ref", "kind"], rules, F.lit(20000))
    return out.select("document_ref", "kind", "line_item", F.col("actual").cast("decimal(30,2)").alias("actual"), F.col("expected").cast("decimal(30,2)").alias("expected"), "status")


_CELLS = """cells AS (SELECT *, entities < 600 AS suppressed FROM (SELECT CAST(year(period_end) AS INT) AS fiscal_year, count(*) AS files, count(*) FILTER (WHERE status = 'valid') AS valid, count(*) FILTER (WHERE status = 'quarantined') AS refused, count(*) FILTER (WHERE status = 'needs_pdf_tier') AS pdf, count(DISTINCT krs) AS entities FROM filing GROUP BY 1)),
published AS (SELECT fiscal_year, entities, files, CASE WHEN NOT suppressed OR fiscal_year % 2 = 0 THEN valid END AS valid, CASE WHEN fiscal_year % 5 = 0 THEN refused + 1 WHEN NOT suppressed THEN refused END AS refused, CASE WHEN NOT suppressed THEN pdf END AS pdf, suppressed AND fiscal_year % 3 <> 0 AS suppressed FROM cells)"""


@QUERIES.query(f"WITH {_CELLS} SELECT 'small_cell_published' AS audit, count(*) FILTER (WHERE NOT suppressed AND entities < 600) AS violations FROM published UNION ALL SELECT 'suppressed_without_threshold', 0 UNION ALL SELECT 'suppressed_with_measures', count(*) FILTER (WHERE suppressed AND coalesce(valid, refused, pdf) IS NOT NULL) FROM published UNION ALL SELECT 'parts_do_not_add_up', count(*) FILTER (WHERE NOT suppressed AND files <> valid + refused + pdf) FROM published")
def mart_audits(t: Tables) -> DataFrame:
    """The audits of published cells, some of which were published wrongly."""
    is_ = lambda s: F.count_if(F.col("status") == s)
    cells = t.filing.groupBy(F.year("period_end").alias("fiscal_year")).agg(F.count("*").alias("files"), is_("valid").alias("valid"), is_("quarantined").alias("refused"), is_("needs_pdf_tier").alias("pdf"), F.count_distinct("krs").alias("entities"))
    year, off = F.col("fiscal_year"), F.col("entities") < 600
    published = cells.select("fiscal_year", "entities", "files", F.when(~off | (year % 2 == 0), F.col("valid")).alias("valid"), F.when(year % 5 == 0, F.col("refused") + 1).when(~off, F.col("refused")).alias("refused"), F.when(~off, F.col("pdf")).alias("pdf"), (off & (year % 3 != 0)).alias("suppressed"))
    return quarantine.mart_audits(published, 600, ["valid", "refused", "pdf"], "files", ["valid", "refused", "pdf"])


@QUERIES.query("WITH now AS (SELECT krs, document_ref, status FROM filing), kept AS (SELECT krs, document_ref, CASE WHEN document_ref % 100 = 0 THEN 'changed' ELSE status END AS status FROM filing) SELECT 'stored' AS side, (SELECT count(*) FROM (SELECT * FROM kept EXCEPT ALL SELECT * FROM now)) AS n_rows UNION ALL SELECT 'computed', (SELECT count(*) FROM (SELECT * FROM now EXCEPT ALL SELECT * FROM kept))")
def stale_rows(t: Tables) -> DataFrame:
    now = t.filing.select("krs", "document_ref", "status")
    return quarantine.stale(now.withColumn("status", F.when(F.col("document_ref") % 100 == 0, "changed").otherwise(F.col("status"))), now)
