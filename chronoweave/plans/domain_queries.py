"""Queries over legal events, labels, filings and their quality."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.operators import labels, legal
from chronoweave.plans.fixtures import Tables
from chronoweave.plans.query import Book

QUERIES = Book()

RULES = labels.LabelRules(grid_start="2016-01-31", launch="2019-12-01", regime_start="2018-01-01", regime_end="2018-12-31", horizons=(6, 12))

#: Events folded by group, and what a deregistration inherits: all pairs of an exit with what came before it, summed up once.
CANONICAL = """folded AS (
  SELECT dedup_group_id, min(krs) AS krs, arg_min(event_type, replace(event_type, 'restructuring_proceedings_opened', '~')) AS event_type, min(outcome_class) AS outcome_class, min(stage) AS stage,
         arg_min(ends, event_type) AS ends, count(*) FILTER (WHERE precludes_silent_exit) > 0 AS precludes_silent_exit, min(event_date) AS event_date, min(known_from) AS known_from,
         CASE WHEN count(event_date) > 0 THEN min(event_date) ELSE min(known_from) END AS effective_date, min(proceeding_id) AS own_case, list_sort(array_agg(DISTINCT source)) AS sources
  FROM legal GROUP BY dedup_group_id
), past AS (
  SELECT x.dedup_group_id AS exit_id, p.dedup_group_id AS past_id, p.effective_date AS past_day, p.outcome_class AS past_class, p.own_case AS past_case, p.precludes_silent_exit AND p.dedup_group_id <> x.dedup_group_id AS bars,
         p.outcome_class IN ('bankruptcy', 'restructuring', 'liquidation') AS leads
  FROM folded x JOIN folded p ON p.krs = x.krs AND p.effective_date <= x.effective_date WHERE x.event_type = 'deregistered'
), last_day_of AS (
  SELECT exit_id, max(past_day) AS past_day FROM past WHERE leads GROUP BY exit_id
), inherited AS (
  SELECT exit_id, min(struct_pack(id := past_id, class := past_class, of_case := past_case)) AS heir FROM past JOIN last_day_of USING (exit_id, past_day) WHERE leads GROUP BY exit_id
), barred AS (
  SELECT DISTINCT exit_id FROM past WHERE bars
), canonical AS (
  SELECT f.dedup_group_id, f.krs, f.event_type, f.outcome_class, f.stage, f.ends, f.precludes_silent_exit, f.event_date, f.known_from, f.effective_date, f.sources, coalesce(f.own_case, i.heir.of_case) AS proceeding_id,
         CASE f.event_type WHEN 'deregistered' THEN coalesce(i.heir.class, CASE WHEN b.exit_id IS NULL THEN 'silent_exit' ELSE 'merged_away' END) ELSE f.outcome_class END AS label_class
  FROM folded f LEFT JOIN inherited i ON i.exit_id = f.dedup_group_id LEFT JOIN barred b ON b.exit_id = f.dedup_group_id
)"""

#: The label grid from intervals: a proceeding is a span of days, and an entity's exit, registration and cutoff are one day each.
GRID = CANONICAL + """, reach AS (
  SELECT krs, least(max(fetched_on) FILTER (WHERE source = 'KRS'), max(fetched_on) FILTER (WHERE source = 'MSiG')) AS cutoff_date FROM fetches GROUP BY krs
  HAVING count(*) FILTER (WHERE source = 'KRS') > 0 AND count(*) FILTER (WHERE source = 'MSiG') > 0
), span AS (
  SELECT krs, min(effective_date) FILTER (WHERE event_type = 'registered') AS born, min(effective_date) FILTER (WHERE event_type = 'deregistered') AS died FROM canonical GROUP BY krs
), endings AS (
  SELECT krs, unnest(string_split(ends, ',')) AS closes, effective_date AS closed_on FROM canonical WHERE stage = 'closing'
), proceedings AS (
  SELECT o.krs, o.effective_date AS from_day,
         least(min(e.closed_on), CASE WHEN o.stage = 'petition' THEN CAST(o.effective_date + INTERVAL 24 MONTH AS DATE) END) AS to_day
  FROM canonical o LEFT JOIN endings e ON e.krs = o.krs AND e.closes = o.outcome_class AND e.closed_on >= o.effective_date
  WHERE o.stage IN ('opening', 'petition') AND o.outcome_class IS NOT NULL GROUP BY o.dedup_group_id, o.krs, o.effective_date, o.stage
), points AS (
  SELECT r.krs, r.cutoff_date, CAST(last_day(CAST(q.d AS DATE)) AS DATE) AS as_of_date, s.died
  FROM reach r LEFT JOIN span s USING (krs), unnest(generate_series(TIMESTAMP '2016-01-01', CAST(r.cutoff_date AS TIMESTAMP), INTERVAL 1 MONTH)) q(d)
  WHERE last_day(CAST(q.d AS DATE)) <= r.cutoff_date AND (s.born IS NULL OR s.born <= last_day(CAST(q.d AS DATE)))
), busy AS (
  SELECT DISTINCT p.krs, p.as_of_date FROM points p JOIN proceedings i ON i.krs = p.krs AND i.from_day <= p.as_of_date AND (i.to_day IS NULL OR p.as_of_date < i.to_day)
), ahead AS (
  SELECT p.*, b.krs IS NOT NULL AS in_proceeding, h AS horizon_months, CAST(last_day(p.as_of_date + to_months(h)) AS DATE) AS window_end
  FROM points p LEFT JOIN busy b USING (krs, as_of_date), (VALUES (6), (12)) v(h)
), happening AS (
  SELECT krs, effective_date AS day, CASE label_class WHEN 'bankruptcy' THEN 1 WHEN 'restructuring' THEN 2 WHEN 'liquidation' THEN 3 WHEN 'silent_exit' THEN 4 ELSE 9 END AS turn, dedup_group_id AS id, label_class, event_type, event_date, known_from, proceeding_id
  FROM canonical WHERE label_class IS NOT NULL
), first_hit AS (
  SELECT a.krs, a.as_of_date, a.horizon_months, min(struct_pack(day := h.day, turn := h.turn, id := h.id, class := h.label_class, kind := h.event_type, dated := h.event_date, known := h.known_from, of_case := h.proceeding_id)) AS hit
  FROM ahead a JOIN happening h ON h.krs = a.krs AND h.day > a.as_of_date AND h.day <= a.window_end GROUP BY ALL
), judged AS (
  SELECT a.*, f.hit, CASE WHEN f.hit IS NULL THEN 'none' WHEN f.hit.class = 'merged_away' THEN 'merged' ELSE 'hit' END AS found,
         a.window_end <= CASE WHEN a.window_end < DATE '2019-12-01' THEN a.cutoff_date ELSE CAST(a.cutoff_date - INTERVAL 12 MONTH AS DATE) END AS settled
  FROM ahead a LEFT JOIN first_hit f USING (krs, as_of_date, horizon_months)
), grid AS (
  SELECT krs, as_of_date, horizon_months, CASE WHEN died <= as_of_date THEN 'deregistered' WHEN in_proceeding THEN 'in_proceeding' END AS excluded_reason,
         CASE found WHEN 'hit' THEN hit.class WHEN 'none' THEN CASE WHEN settled THEN 'alive' END END AS outcome_class, found = 'merged' OR (found = 'none' AND NOT settled) AS censored,
         hit.dated AS event_date, hit.known AS event_known_from, hit.kind AS trigger_event_type, hit.of_case AS proceeding_id,
         CASE WHEN found = 'hit' AND hit.of_case IS NULL THEN CASE WHEN hit.turn IN (3, 4) THEN 'procedure_has_no_case' ELSE 'source_omits_signature' END END AS proceeding_id_note,
         window_end >= DATE '2018-01-01' AND as_of_date < DATE '2018-12-31' AS regime_flag,
         CASE WHEN as_of_date >= DATE '2019-11-30' THEN 'krz' WHEN window_end >= DATE '2019-12-01' THEN 'mixed' ELSE 'pre_krz' END AS source_era, cutoff_date, 'v4' AS label_version
  FROM judged
)"""

#: The grid with planted faults, for the audits: by the last digit of an entity's key.
DAMAGED = """damaged AS (
  SELECT * REPLACE (CASE WHEN krs LIKE '%1' THEN NOT censored ELSE censored END AS censored, CASE WHEN krs LIKE '%2' AND event_known_from IS NOT NULL THEN CAST(as_of_date - 1 AS DATE) ELSE event_date END AS event_date,
    CASE WHEN krs LIKE '%3' THEN NULL ELSE proceeding_id_note END AS proceeding_id_note, CASE WHEN krs LIKE '%4' THEN NOT regime_flag ELSE regime_flag END AS regime_flag,
    CASE WHEN krs LIKE '%5' THEN CAST(as_of_date - 100 AS DATE) ELSE cutoff_date END AS cutoff_date, CASE WHEN krs LIKE '%6' THEN CAST(as_of_date - 1 AS DATE) ELSE as_of_date END AS as_of_date) FROM grid
  UNION ALL SELECT * FROM grid WHERE krs LIKE '%7'
)"""


def _audit_sql(table: str) -> str:
    """Violations of each rule, counted by SQL."""
    end = "CAST(last_day(as_of_date + to_months(horizon_months)) AS DATE)"
    rules = {
        "class_and_censoring_disagree": "(outcome_class IS NULL) <> censored",
        "event_outside_window": f"coalesce(event_date, event_known_from) > {end}",
        "event_not_after_day": "coalesce(event_date, event_known_from) <= as_of_date",
        "alive_with_event": "outcome_class = 'alive' AND trigger_event_type IS NOT NULL",
        "alive_past_cutoff": f"outcome_class = 'alive' AND {end} > CASE WHEN {end} >= DATE '2019-12-01' THEN CAST(cutoff_date - INTERVAL 12 MONTH AS DATE) ELSE cutoff_date END",
        "event_without_case_or_reason": "outcome_class <> 'alive' AND proceeding_id IS NULL AND proceeding_id_note IS NULL",
        "regime_flag_is_not_overlap": f"regime_flag <> (as_of_date < DATE '2018-12-31' AND {end} >= DATE '2018-01-01')",
        "label_after_cutoff": "as_of_date > cutoff_date",
        "not_a_month_end": "as_of_date <> last_day(as_of_date)",
    }
    counted = " UNION ALL ".join(f"SELECT '{n}' AS audit, count(*) FILTER (WHERE {rule}) AS violations FROM {table}" for n, rule in rules.items())
    return f"{counted} UNION ALL SELECT 'duplicate_key', count(*) FROM (SELECT 1 FROM {table} GROUP BY krs, as_of_date, horizon_months HAVING count(*) > 1)"


def _canonical(t: Tables) -> DataFrame:
    return legal.canonical_events(t.legal)


def _grid(t: Tables) -> DataFrame:
    return labels.label_grid(_canonical(t), t.fetches, RULES)


@QUERIES.query(f"WITH {CANONICAL} SELECT * EXCLUDE (sources), array_to_string(sources, ',') AS sources FROM canonical")
def canonical_events(t: Tables) -> DataFrame:
    return _canonical(t).withColumn("sources", F.array_join("sources", ","))


@QUERIES.query(f"WITH {CANONICAL} SELECT CASE WHEN len(sources) > 1 THEN 'both' ELSE sources[1] END AS source, CAST(year(known_from) AS INT) AS event_year, event_type, count(*) AS events, count(DISTINCT krs) AS entities FROM canonical WHERE event_type NOT IN ('registered', 'board_changed', 'office_moved', 'capital_changed') GROUP BY ALL")
def event_coverage_by_year(t: Tables) -> DataFrame:
    return legal.coverage(_canonical(t))


@QUERIES.query(f"WITH {GRID} SELECT krs, as_of_date FROM busy")
def in_proceeding_state(t: Tables) -> DataFrame:
    canonical = _canonical(t)
    registered = canonical.filter("event_type = 'registered'").groupBy("krs").agg(F.min("effective_date").alias("registered_on"))
    grid = labels.month_end_grid(labels.cutoffs(t.fetches, RULES.sources), registered, RULES.grid_start)
    return labels.in_proceeding(grid, canonical, RULES.petition_expiry_months)


@QUERIES.query(f"WITH {GRID} SELECT * FROM grid")
def label_grid(t: Tables) -> DataFrame:
    return _grid(t)


@QUERIES.query(f"WITH {GRID} SELECT * EXCLUDE (excluded_reason) FROM grid WHERE excluded_reason IS NULL")
def outcome_labels(t: Tables) -> DataFrame:
    return labels.outcome_labels(_grid(t))


@QUERIES.query(f"""WITH {GRID} SELECT horizon_months, excluded_reason AS reason, count(DISTINCT krs) AS entities, count(*) AS n_rows FROM grid WHERE excluded_reason IS NOT NULL GROUP BY ALL
UNION ALL SELECT h.horizon_months, 'no_cutoff', (SELECT count(*) FROM entity e WHERE e.krs NOT IN (SELECT krs FROM grid)), 0 FROM (SELECT unnest([6, 12]) AS horizon_months) h""")
def label_exclusions(t: Tables) -> DataFrame:
    return labels.exclusions(_grid(t), t.entity, RULES.horizons)


@QUERIES.query(f"WITH {GRID} {_audit_sql('grid')}")
def label_audits(t: Tables) -> DataFrame:
    return labels.audits(_grid(t), RULES)


@QUERIES.query(f"WITH {GRID}, {DAMAGED} {_audit_sql('damaged')}")
def label_audits_on_faults(t: Tables) -> DataFrame:
    """The same audits on a grid with planted faults: each must count them."""
    grid = _grid(t)
    ends = lambda digit: F.col("krs").endswith(str(digit))
    day_before = F.date_sub("as_of_date", 1)
    damaged = grid.withColumns(
        {
            "censored": F.when(ends(1), ~F.col("censored")).otherwise(F.col("censored")),
            "event_date": F.when(ends(2) & F.col("event_known_from").isNotNull(), day_before).otherwise(F.col("event_date")),
            "proceeding_id_note": F.when(~ends(3), F.col("proceeding_id_note")),
            "regime_flag": F.col("regime_flag") != ends(4),
            "cutoff_date": F.when(ends(5), F.date_sub("as_of_date", 100)).otherwise(F.col("cutoff_date")),
            "as_of_date": F.when(ends(6), day_before).otherwise(F.col("as_of_date")),
        }
    )
    return labels.audits(damaged.unionByName(grid.filter(ends(7))), RULES)


@QUERIES.query(f"WITH {GRID} SELECT outcome_class, horizon_months, CAST(year(as_of_date) AS INT) AS as_of_year, count(*) AS n_rows, count(DISTINCT krs) AS entities FROM grid WHERE excluded_reason IS NULL GROUP BY ALL")
def labels_by_year(t: Tables) -> DataFrame:
    return labels.outcome_labels(_grid(t)).groupBy("outcome_class", "horizon_months", F.year("as_of_date").alias("as_of_year")).agg(F.count("*").alias("n_rows"), F.count_distinct("krs").alias("entities"))
