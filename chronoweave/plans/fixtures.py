"""Domain relations over the shared tables, as SQL that Spark and DuckDB both read.

The registered queries apply the operators to these; the same text heads the SQL they are held against.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SQL: dict[str, str] = {
    "entity": """
SELECT lpad(CAST(c_custkey AS STRING), 10, '0') AS krs, c_mktsegment AS segment, c_nationkey AS nation, c_acctbal AS balance FROM customer""",
    "filing": """
SELECT lpad(CAST(o_custkey AS STRING), 10, '0') AS krs, CAST(o_orderkey AS BIGINT) AS document_ref, CAST(o_orderdate AS DATE) AS known_from,
       last_day(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH) AS period_end, o_orderpriority = '1-URGENT' AS is_correction,
       CASE WHEN o_orderstatus = 'P' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 300 AS INT) END AS deleted_on,
       CASE WHEN o_orderkey % 7 = 0 THEN 'quarantined' WHEN o_orderkey % 11 = 0 THEN 'needs_pdf_tier' ELSE 'valid' END AS status,
       CAST(o_totalprice AS DOUBLE) AS total FROM orders""",
    "fact": """
SELECT f.krs, f.document_ref, f.known_from, f.period_start, f.period_end, CAST(l.l_linenumber AS INT) AS line_item, CAST(l.l_extendedprice AS DECIMAL(20,2)) AS value,
       CASE l.l_returnflag WHEN 'N' THEN 'current_year' WHEN 'A' THEN 'prior_year' ELSE 'prior_year_restated' END AS kind,
       CAST(l.l_quantity AS DECIMAL(20,2)) AS quantity
FROM lineitem l JOIN (
  SELECT lpad(CAST(o_custkey AS STRING), 10, '0') AS krs, CAST(o_orderkey AS BIGINT) AS document_ref, CAST(o_orderdate AS DATE) AS known_from,
         last_day(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH) AS period_end,
         CASE WHEN o_orderkey % 9 = 0 THEN last_day(CAST(o_orderdate AS DATE) - INTERVAL 24 MONTH) ELSE last_day(CAST(o_orderdate AS DATE) - INTERVAL 18 MONTH) END + 1 AS period_start FROM orders) f ON f.document_ref = l.l_orderkey""",
    "legal": """
SELECT event_id, krs, source, event_type, stage, outcome_class, ends, event_type IN ('bankruptcy_declared', 'arrangement_approved', 'liquidation_opened', 'bankruptcy_petition', 'merger_division_transformation') AS precludes_silent_exit,
       CASE WHEN event_id % 11 <> 0 THEN day END AS event_date, day + CAST(event_id % 40 AS INT) AS known_from,
       CASE WHEN stage IN ('petition', 'opening') AND event_id % 4 <> 0 THEN 'P' || CAST(event_id % 97 AS STRING) END AS proceeding_id,
       krs || ':' || event_type || ':' || CAST(year(day) AS STRING) AS dedup_group_id
FROM (SELECT *, CASE WHEN event_type IN ('bankruptcy_declared', 'arrangement_approved', 'liquidation_opened') THEN 'opening' WHEN event_type = 'bankruptcy_petition' THEN 'petition'
              WHEN event_type IN ('bankruptcy_proceeding_ended', 'restructuring_proceeding_ended', 'liquidation_closed') THEN 'closing' WHEN event_type = 'deregistered' THEN 'exit' ELSE 'signal' END AS stage,
             CASE event_type WHEN 'bankruptcy_declared' THEN 'bankruptcy' WHEN 'bankruptcy_petition' THEN 'bankruptcy' WHEN 'arrangement_approved' THEN 'restructuring'
              WHEN 'liquidation_opened' THEN 'liquidation' WHEN 'deregistered' THEN 'silent_exit' END AS outcome_class,
             CASE event_type WHEN 'bankruptcy_proceeding_ended' THEN 'bankruptcy' WHEN 'restructuring_proceeding_ended' THEN 'restructuring' WHEN 'liquidation_closed' THEN 'liquidation'
              WHEN 'deregistered' THEN 'bankruptcy,restructuring,liquidation' ELSE '' END AS ends
      FROM (SELECT event_id, lpad(CAST(user_id AS STRING), 10, '0') AS krs, CASE WHEN event_id % 2 = 0 THEN 'KRS' ELSE 'MSiG' END AS source,
                   DATE '2016-01-01' + CAST((event_id * 37) % 2500 AS INT) AS day,
                   CASE WHEN event_id % 16 = 3 AND event_type = 'error' THEN CASE event_id % 3 WHEN 0 THEN 'bankruptcy_declared' WHEN 1 THEN 'arrangement_approved' ELSE 'liquidation_opened' END
                        WHEN event_id % 16 = 5 AND event_type = 'click' THEN 'bankruptcy_petition'
                        WHEN event_id % 8 = 1 AND event_type = 'view' THEN CASE event_id % 3 WHEN 0 THEN 'bankruptcy_proceeding_ended' WHEN 1 THEN 'restructuring_proceeding_ended' ELSE 'liquidation_closed' END
                        WHEN event_id % 128 = 7 AND event_type = 'purchase' THEN 'deregistered'
                        WHEN event_id % 64 = 9 AND event_type = 'purchase' THEN 'merger_division_transformation'
                        WHEN event_type = 'signup' AND event_id % 4 = 0 THEN 'registered'
                        WHEN event_id % 2 = 0 THEN 'board_changed' ELSE 'office_moved' END AS event_type
            FROM events) a) b""",
    "fetches": """
SELECT lpad(CAST(user_id AS STRING), 10, '0') AS krs, CASE WHEN event_id % 10 >= 4 THEN 'RDF' WHEN event_id % 2 = 0 THEN 'KRS' ELSE 'MSiG' END AS source,
       DATE '2019-06-30' + CAST(event_id % 400 AS INT) AS fetched_on FROM events""",
    "disclosure": """
SELECT f.krs, f.document_ref, f.source_member, f.period_end, f.known_from, f.deleted_on, i.item, CASE WHEN i.item = 'going_concern' AND f.document_ref % 9 <> 0 THEN f.document_ref % 4 <> 0 END AS value_bool,
       CASE WHEN i.item = 'employment' AND f.document_ref % 5 <> 0 THEN CAST(f.document_ref % 700 AS DOUBLE) END AS value_number
FROM (SELECT krs, document_ref, 'm' || CAST(document_ref % 2 AS STRING) AS source_member, period_end, known_from, deleted_on FROM filing) f CROSS JOIN (VALUES ('going_concern'), ('employment')) AS i(item)""",
    "signal": """
SELECT f.krs, f.document_ref, f.source_member, f.period_end, f.known_from, f.deleted_on, CASE WHEN f.document_ref % 6 = 5 THEN 'auditor_report' ELSE 'notes' END AS document_kind, i.signal_type,
       CASE (f.document_ref + i.shift) % 4 WHEN 0 THEN 'partial' WHEN 1 THEN 'not_read' ELSE 'read' END AS status, CASE WHEN (f.document_ref + i.shift) % 5 = 0 THEN 2 ELSE 0 END AS kept_present
FROM (SELECT krs, document_ref, 'm' || CAST(document_ref % 2 AS STRING) AS source_member, period_end, known_from, deleted_on FROM filing) f CROSS JOIN (VALUES ('litigation', 1), ('going_concern', 2)) AS i(signal_type, shift)""",
    "report": """
SELECT krs, document_ref, 'm' || CAST(document_ref % 2 AS STRING) AS source_member, period_end, known_from, deleted_on,
       CASE document_ref % 7 WHEN 0 THEN 'qualified' WHEN 1 THEN 'adverse' WHEN 2 THEN NULL ELSE 'unqualified' END AS opinion, CASE WHEN document_ref % 6 <> 0 THEN 4000 + document_ref % 3 END AS firm FROM filing""",
    "size": """
SELECT krs, document_ref, 'm' || CAST(document_ref % 2 AS STRING) AS source_member, period_end, known_from, deleted_on,
       CASE document_ref % 5 WHEN 0 THEN 'micro' WHEN 1 THEN 'small' WHEN 2 THEN 'medium' WHEN 3 THEN 'large' ELSE 'undetermined' END AS size_class FROM filing""",
    "score": """
SELECT lpad(CAST(user_id AS STRING), 10, '0') AS krs, last_day(DATE '2020-01-31' + CAST(30 * (event_id % 24) AS INT)) AS as_of_date,
       max(CAST(event_id % 1000 AS DOUBLE) / 1000.0) AS probability, 12 AS horizon_months, 'logistic' AS model_name
FROM events GROUP BY 1, 2""",
    "prediction": """
SELECT d.doc_id, d.lang AS stratum, d.source AS krs, CAST(d.n_chars AS DOUBLE) / (CAST(d.n_chars AS DOUBLE) + 5000.0) AS probability, CAST(l.toxic AS INT) AS y, CAST(l.quality + 1 AS DOUBLE) AS weight
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
}


class Tables:
    """The shared tables and the relations over them, by attribute; nothing is read before it is used."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name in SQL:
            return self.sql(SQL[name])
        raise AttributeError(name)

    def sql(self, text: str) -> DataFrame:
        """SQL over the shared tables, named by themselves."""
        for name in SQL:
            if re.search(rf"\b(FROM|JOIN) {name}\b", text):
                text = re.sub(rf"\b(FROM|JOIN) {name}\b", lambda m, body=SQL[name]: f"{m[1]} ({body.strip()})", text)
        used = {t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)}
        return self.spark.sql(re.sub(r"\b(FROM|JOIN) (\w+)\b", lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in used else m[0], text), **{t: self.table(t) for t in used})


def oracle(text: str) -> str:
    """SQL for DuckDB, headed by the relations that it names."""
    named = {n for n in SQL if re.search(rf"\b{n}\b", text)}
    # A relation may stand on one before it.
    named |= {n for n in SQL for own in named if re.search(rf"\b(FROM|JOIN) {n}\b", SQL[own])}
    heads = [f"{n} AS ({body.strip()})" for n, body in SQL.items() if n in named]
    text = text.strip()
    if not heads:
        return text
    if text[:5].upper() == "WITH ":
        return "WITH " + ", ".join(heads) + ", " + text[5:]
    return "WITH " + ", ".join(heads) + " " + text
