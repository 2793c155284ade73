"""From evaluation to serving: cells that may be judged, runs, attributions, month-end scoring, hazards, registry, drift, reads."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.operators.evaluation import population_shift
from chronoweave.operators.temporal import settled

ALIASES = ("champion", "incumbent")


def paired(one: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Two models' predictions (keys, y, probability) of the same rows: y, probability, probability_other. Rows that only one
    model scored, or that disagree on the outcome, are an error: a comparison must be of the same rows."""
    right = other.select(*keys, F.col("y").alias("_y"), F.col("probability").alias("probability_other"))
    both = one.select(*keys, "y", "probability").join(right, keys, "full")
    bad = both.filter(F.col("probability").isNull() | F.col("probability_other").isNull() | ~F.col("y").eqNullSafe(F.col("_y"))).limit(1).collect()
    if bad:
        raise ValueError(f"the models were not scored on the same rows: {bad[0].asDict()}")
    return both.drop("_y")


def evaluable_cells(predictions: DataFrame, by: list[str], least_events: int) -> DataFrame:
    """n_rows, events and ``evaluable`` of each cell: enough events, and a row without one to tell them from."""
    cells = predictions.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum("y").cast("long").alias("events"))
    return cells.withColumn("evaluable", (F.col("events") >= least_events) & (F.col("events") < F.col("n_rows")))


def pooled(predictions: DataFrame, fold: str, by: list[str], least_events: int) -> DataFrame:
    """The rows of folds that speak: those that have a cell's least events are pooled, the others are counted and left out."""
    cells = evaluable_cells(predictions, [*by, fold], least_events)
    met = predictions.join(cells.select(*by, fold, "evaluable"), [*by, fold])
    brier = F.pow(F.col("probability") - F.col("y"), 2)
    return met.groupBy(*by).agg(
        F.count_if("evaluable").alias("n_rows"), F.sum(F.when(F.col("evaluable"), F.col("y"))).cast("long").alias("events"), F.avg(F.when(F.col("evaluable"), brier)).alias("brier"),
        F.count_distinct(F.when(F.col("evaluable"), F.col(fold))).alias("folds"), F.count_distinct(F.when(~F.col("evaluable"), F.col(fold))).alias("folds_left_out"),
    )


def runs(rows: DataFrame) -> DataFrame:
    """The three runs of a fold (rows with ``side`` train or test): main; no_regime, trained without regime rows; entity_disjoint,
    trained without the entities that are tested."""
    rows = settled(rows)  # read by every run
    test = rows.filter("side = 'test'")
    train = rows.filter("side = 'train'")
    apart = train.join(test.select("krs").distinct(), "krs", "left_anti").select(*rows.columns)
    named = {"main": train, "no_regime": train.filter(~F.col("regime_flag")), "entity_disjoint": apart}
    return reduce(lambda a, b: a.unionByName(b), [part.unionByName(test).withColumn("run", F.lit(name)) for name, part in named.items()])


def attributions(rows: DataFrame, keys: list[str], coefficients: dict[str, float], means: dict[str, float]) -> DataFrame:
    """(keys, feature, contribution) of a linear model: what each input adds to the score of an average row; nulls stand at the mean."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), (F.coalesce(F.col(f).cast("double") - F.lit(means[f]), F.lit(0.0)) * F.lit(w)).alias("contribution")) for f, w in coefficients.items()]))
    return rows.select(*keys, each.alias("x")).select(*keys, "x.feature", "x.contribution")


def importance(contributions: DataFrame) -> DataFrame:
    """(feature, importance): mean absolute contribution."""
    return contributions.groupBy("feature").agg(F.avg(F.abs("contribution")).alias("importance"))


def month_end_rows(store: DataFrame, day: str, states: DataFrame, trained: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows to score, exclusions) of a month-end: entities at risk on it, and why each other one is not.

    ``states``: krs, excluded_reason on that day (null: at risk). A row of the training data is refused: a score must be out of sample.
    """
    own = store.filter(F.col("as_of_date") == F.lit(day).cast("date"))
    seen = own.join(trained.select("krs", "as_of_date").distinct(), ["krs", "as_of_date"], "left_semi").limit(1).collect()
    if seen:
        raise ValueError(f"{seen[0]['krs']} on {day} is in the training data")
    met = own.join(states.select("krs", "excluded_reason", F.lit(True).alias("_known")), "krs", "left")
    reason = F.when(F.col("_known").isNull(), "not_on_grid").otherwise(F.col("excluded_reason"))
    told = met.withColumn("reason", reason)
    return told.filter("reason is null").select(*store.columns), told.filter("reason is not null").select("krs", "as_of_date", "reason")


def hazard_probabilities(hazards: DataFrame, keys: list[str], horizon: int) -> DataFrame:
    """(keys, probability): 1 - S(h), the product of one less the hazards of the months up to the horizon; null where a month lacks."""
    own = hazards.filter(F.col("month").between(1, horizon)).groupBy(*keys).agg(
        F.count("hazard").alias("n"), F.max("hazard").alias("most"), F.sum(F.when(F.col("hazard") < 1, F.log(1 - F.col("hazard")))).alias("log_survival")
    )
    survival = F.when(F.col("most") >= 1, F.lit(0.0)).otherwise(F.exp("log_survival"))
    return own.select(*keys, F.when(F.col("n") == horizon, 1 - survival).alias("probability"))


def classical_fit(train: DataFrame, score: Column, label: str = "y"):
    """(model, left_out): a one-variable logistic regression on the score's mid-rank; rows without a score are left out and counted."""
    from chronoweave.operators.modelling import mid_rank, rank_logistic

    scored = train.withColumn("_score", score)
    left_out = scored.filter("_score is null").count()
    own = scored.filter("_score is not null")
    ranked = mid_rank(own.select("_score"), own, "_score", "_rank")
    return rank_logistic(ranked, ["_rank"], label), left_out


def score_intervals(train: DataFrame, rows: DataFrame, fit: Callable[[DataFrame, str], Callable[[DataFrame], DataFrame]], entity: str, keys: list[str], replicates: int = 100, seed: int = 20261009, level: float = 0.9) -> DataFrame:
    """(keys, low, high): percentiles of a row's score over models fitted on entities drawn anew.

    ``fit(train, weight)`` gives a function that adds ``probability``. How often an entity is drawn is a Poisson count from a hash of
    seed, replicate and entity, so reruns agree and no draw is collected; one fit a replicate runs from the driver.
    """
    out = None
    for r in range(replicates):
        u = (F.pmod(F.xxhash64(F.lit(seed), F.lit(r), F.col(entity)), F.lit(1 << 32)) / F.lit(float(1 << 32))).cast("double")
        # Poisson(1): its cumulative probabilities up to 6.
        times = reduce(lambda out, p: out + (u >= p).cast("int"), [0.36787944, 0.73575888, 0.91969860, 0.98101184, 0.99634015, 0.99940582], F.lit(0))
        drawn = train.withColumn("_times", times.cast("double")).filter("_times > 0")
        scored = fit(drawn, "_times")(rows).select(*keys, "probability")
        out = scored if out is None else out.unionByName(scored)
    return out.groupBy(*keys).agg(F.percentile("probability", (1 - level) / 2).alias("low"), F.percentile("probability", (1 + level) / 2).alias("high"))


def registered_aliases(models: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(horizon_months, alias, version): which version each alias names once verdicts are in.

    ``models``: horizon_months, version, role (incumbent or challenger), with the champion there was in ``was_champion``. ``verdicts``:
    horizon_months, verdict, weighted. The incumbent's newest version is always named; a promoted challenger becomes champion; a provisional
    verdict leaves the champion there was; a weighted one that promotes nothing takes the alias away.
    """
    newest = models.groupBy("horizon_months").agg(F.max(F.when(F.col("role") == "incumbent", F.col("version"))).alias("incumbent"), F.max(F.when(F.col("role") == "challenger", F.col("version"))).alias("challenger"), F.max(F.when(F.col("was_champion"), F.col("version"))).alias("before"))
    met = newest.join(verdicts, "horizon_months", "left")
    champion = F.when(F.col("verdict") == "promoted", F.col("challenger")).when(F.coalesce(F.col("weighted"), F.lit(False)) & (F.col("verdict") != "provisional"), None).otherwise(F.col("before"))
    each = F.explode(F.array(F.struct(F.lit("champion").alias("alias"), champion.alias("version")), F.struct(F.lit("incumbent").alias("alias"), F.col("incumbent").alias("version"))))
    return met.select("horizon_months", each.alias("x")).select("horizon_months", "x.*").filter("version is not null")


def served_version(aliases: DataFrame, horizon: int) -> DataFrame:
    """The version served for a horizon: the champion, else the incumbent. A horizon without either is refused."""
    own = aliases.filter(F.col("horizon_months") == horizon)
    turn = F.array_position(F.array(*[F.lit(a) for a in ALIASES]), F.col("alias"))
    found = own.filter(turn > 0).agg(F.min_by(F.struct("alias", "version"), turn).alias("v")).filter("v is not null").select(F.lit(horizon).alias("horizon_months"), "v.*")
    if found.isEmpty():
        raise ValueError(f"no model is served for {horizon} months")
    return found


def input_drift(before: DataFrame, after: DataFrame, columns: list[str], psi_limit: float = 0.2, ks_limit: float = 0.1) -> DataFrame:
    """(feature, psi, ks, missing_before, missing_after, drifted) of each input: the training rows against the rows scored last."""
    parts = []
    for c in columns:
        share = lambda df, name, c=c: df.agg((F.count_if(F.col(c).isNull()) / F.count("*")).alias(name))
        shift = population_shift(before.filter(F.col(c).isNotNull()).select(F.col(c).cast("double").alias("x")), after.filter(F.col(c).isNotNull()).select(F.col(c).cast("double").alias("x")), "x")
        one = shift.crossJoin(share(before, "missing_before")).crossJoin(share(after, "missing_after"))  # one row each
        parts.append(one.select(F.lit(c).alias("feature"), "psi", "ks", "missing_before", "missing_after", ((F.col("psi") >= psi_limit) | (F.col("ks") >= ks_limit)).alias("drifted")))
    return reduce(lambda a, b: a.unionByName(b), parts)


def scores_of(scores: DataFrame, served: DataFrame, krs: str | None = None, horizon: int | None = None, day: str | None = None) -> DataFrame:
    """Scores of served (model_name, version) pairs only; a filter that is None does not filter."""
    rows = scores.join(served.select("model_name", "version").distinct(), ["model_name", "version"], "left_semi")
    for column, value in (("krs", krs), ("horizon_months", horizon)):
        rows = rows if value is None else rows.filter(F.col(column) == value)
    return rows if day is None else rows.filter(F.col("as_of_date") == F.lit(day).cast("date"))


def score_history(scores: DataFrame, served: DataFrame, krs: str, horizon: int | None = None) -> DataFrame:
    """An entity's served scores, latest first."""
    return scores_of(scores, served, krs, horizon).orderBy(F.desc("as_of_date"), "horizon_months", "model_name")


def with_intervals(scores: DataFrame, served: DataFrame, intervals: DataFrame) -> DataFrame:
    """Served scores with their intervals, null where none was made."""
    key = ["krs", "as_of_date", "horizon_months", "model_name"]
    return scores_of(scores, served).join(intervals.select(*key, "low", "high"), key, "left")


def check_served(scores: DataFrame, served: DataFrame) -> DataFrame:
    """(model_name, version): pairs that are served but have no score: a service must refuse to start on any."""
    return served.select("model_name", "version").distinct().join(scores.select("model_name", "version").distinct(), ["model_name", "version"], "left_anti")


def current_status(scores: DataFrame, peers: list[str]) -> DataFrame:
    """Each entity's latest score with its percentile among its peers, the share of them that score lower, ties half."""
    last = scores.groupBy("krs", "model_name", "horizon_months").agg(F.max_by(F.struct("as_of_date", "probability", *[p for p in peers if p not in ("krs", "model_name", "horizon_months")]), "as_of_date").alias("_l"))
    rows = last.select("krs", "model_name", "horizon_months", "_l.*")
    by = ["model_name", "horizon_months", *[p for p in peers if p not in ("model_name", "horizon_months")]]
    # One row for each distinct score, then running counts of those.
    counts = rows.groupBy(*by, "probability").agg(F.count("*").alias("n"))
    upto = Window.partitionBy(*by).orderBy("probability").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    placed = counts.withColumn("percentile", (F.coalesce(F.sum("n").over(upto), F.lit(0)) + F.col("n") / 2) / F.sum("n").over(whole)).drop("n")
    return rows.join(placed, [*by, "probability"])


def acknowledged(stored: DataFrame, new: DataFrame) -> DataFrame:
    """(alert_id, acknowledged_at): the first acknowledgement of each alert is kept."""
    return stored.unionByName(new).groupBy("alert_id").agg(F.min("acknowledged_at").alias("acknowledged_at"))


def downloads(filings: DataFrame) -> DataFrame:
    """One row for each stored object with its filing rows, in order of their refs; deleted rows and rows without an object are left out."""
    row = F.struct("document_ref", "file_name", "known_from", "period_end")
    own = filings.filter("object_key is not null and deleted_on is null")
    return own.groupBy("krs", "object_key").agg(F.array_sort(F.collect_list(row)).alias("rows"))


def text_sources(files: DataFrame) -> DataFrame:
    """Distinct dated, non-deleted XML files; a key that two filings claim with different period ends is left out."""
    own = files.filter("kind = 'xml' and deleted_on is null and known_from is not null")
    return own.groupBy("krs", "file_key").agg(F.min("period_end").alias("period_end"), F.min("known_from").alias("known_from"), F.count_distinct("period_end").alias("_n")).filter("_n = 1").drop("_n")


def guarded(files: DataFrame) -> DataFrame:
    """Valid files with the reason that stops mapping them, null for none: no submission date, or a period unlike the index row's."""
    return files.withColumn("reason", F.when(F.col("known_from").isNull(), "submission_date_missing").when(~F.col("stated_start").eqNullSafe(F.col("period_start")) | ~F.col("stated_end").eqNullSafe(F.col("period_end")), "period_mismatch"))


def compare_digests(first: DataFrame, second: DataFrame, stored: DataFrame) -> DataFrame:
    """(dataset, verdict) of a chain run twice: ``same``, ``changed_between_runs``, ``differs_from_stored``, or what is missing."""
    a = first.select("dataset", F.col("digest").alias("a"))
    b = second.select("dataset", F.col("digest").alias("b"))
    c = stored.select("dataset", F.col("digest").alias("c"))
    met = a.join(b, "dataset", "full").join(c, "dataset", "full")
    verdict = F.when(F.col("a").isNull() | F.col("b").isNull(), "missing_in_a_run").when(F.col("a") != F.col("b"), "changed_between_runs").when(F.col("c").isNull(), "not_stored").when(F.col("a") != F.col("c"), "differs_from_stored").otherwise("same")
    return met.select("dataset", verdict.alias("verdict"))


def one_identity(store: DataFrame, version: str) -> str:
    """The one hash of a feature store, which must hold exactly the version asked for."""
    found = store.select("feature_set_version", "feature_set_hash").distinct().limit(3).collect()
    if len(found) != 1 or found[0]["feature_set_version"] != version:
        raise ValueError(f"the store holds {[tuple(r) for r in found]}, not {version} alone")
    return found[0]["feature_set_hash"]


def acceptance(hints: DataFrame, events: DataFrame) -> DataFrame:
    """(krs, expected, found, accepted): each hint's class against the classes of the entity's events; none found isn't accepted."""
    classes = events.filter("outcome_class is not null").groupBy("krs").agg(F.array_sort(F.collect_set("outcome_class")).alias("found"))
    met = hints.join(classes, "krs", "left")
    return met.select("krs", "expected", F.coalesce(F.array_join("found", ","), F.lit("")).alias("found"), F.coalesce(F.array_contains("found", F.col("expected")), F.lit(False)).alias("accepted"))


def replayed(requests: DataFrame, store: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(answered, to_send): requests by the hash of all they say, once each; those the store has answered are never sent again."""
    keyed = requests.withColumn("request_key", F.sha2(F.to_json(F.struct(*sorted(requests.columns)), {"ignoreNullFields": "false"}), 256))
    once = keyed.groupBy("request_key").agg(F.count("*").alias("asked"), *[F.min(c).alias(c) for c in requests.columns])
    return keyed.join(store.select("request_key", "answer"), "request_key"), once.join(store.select("request_key"), "request_key", "left_anti")


def picks_checked(picks: DataFrame, start: float, step: float, n: int) -> DataFrame:
    """(pick, fault) of a logged systematic draw (pick, place): missing or repeated picks, and places other than floor(start + pick * step)."""
    # As many rows as the draw states.
    expected = picks.sparkSession.range(n).select(F.col("id").alias("pick"), F.floor(F.lit(start) + F.col("id") * F.lit(step)).alias("_place"))
    told = picks.groupBy("pick").agg(F.count("*").alias("_n"), F.min("place").alias("_least"), F.max("place").alias("_most"))
    met = expected.join(told, "pick", "full")
    fault = F.when(F.col("_n").isNull(), "missing").when(F.col("_place").isNull(), "unexpected").when(F.col("_n") > 1, "repeated").when((F.col("_least") != F.col("_place")) | (F.col("_most") != F.col("_place")), "wrong_place")
    return met.select("pick", fault.alias("fault")).filter("fault is not null")


def paired_members(members: DataFrame, rows: DataFrame, by: list[str]) -> DataFrame:
    """(member, document_ref): members and rows that are each other's only match by the given columns; a group of more stays unpaired."""
    m = members.groupBy(*by).agg(F.count("*").alias("_m"), F.min("member").alias("member")).filter("_m = 1")
    r = rows.groupBy(*by).agg(F.count("*").alias("_r"), F.min("document_ref").alias("document_ref")).filter("_r = 1")
    return m.join(r, by).select("member", "document_ref")


def personal_markers(texts: DataFrame, key: str, text: str, words: list[str]) -> DataFrame:
    """(key, marker, n): what is left of personal data in a file's text: runs of eleven digits, and words that were to be removed."""
    word = F.array(*[F.struct(F.lit(w).alias("marker"), F.regexp_count(F.col(text), F.lit(rf"(?i)\b{w}\b")).alias("n")) for w in words])
    digits = F.array(F.struct(F.lit("eleven_digits").alias("marker"), F.regexp_count(F.col(text), F.lit(r"(?<!\d)\d{11}(?!\d)")).alias("n")))
    return texts.select(key, F.explode(F.concat(digits, word)).alias("x")).select(key, "x.marker", F.col("x.n").cast("long").alias("n")).filter("n > 0")
