"""Modelling data: populations, draws with known probabilities, purged folds, scores, survival records, scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.functions.timeops import month_index, settled_by, window_end
from chronoweave.functions.values import first_reason
from chronoweave.operators.temporal import running_sums


def modelling_dataset(labels: DataFrame, store: DataFrame, horizon: int, classes: list[str]) -> DataFrame:
    """Uncensored labels of one horizon with their features, y = 1 for the classes. A label without a feature row is an error."""
    own = labels.filter((F.col("horizon_months") == horizon) & ~F.col("censored"))
    missing = own.join(store, ["krs", "as_of_date"], "left_anti").limit(1).collect()
    if missing:
        raise ValueError(f"no features for {missing[0].asDict()}")
    return own.join(store, ["krs", "as_of_date"]).withColumn("y", F.col("outcome_class").isin(*classes).cast("int"))


def purged_fold(rows: DataFrame, year: int, launch: str, lag_months: int) -> DataFrame:
    """Adds ``side``: test for days in the year; train where the window had closed and its label settled by the eve of the year; else null."""
    eve = F.make_date(F.lit(year), F.lit(1), F.lit(1))
    end = window_end(F.col("as_of_date"), F.col("horizon_months"))
    settled = settled_by(end, F.lit(launch).cast("date"), lag_months)
    return rows.withColumn("side", F.when(F.year("as_of_date") == year, "test").when((end < eve) & (settled < eve), "train"))


def fold_report(rows: DataFrame) -> DataFrame:
    """Rows, entities and distinct events of each side."""
    event = F.when(F.col("y") == 1, F.struct("krs", "event_known_from"))
    return rows.filter("side is not null").groupBy("side").agg(F.count("*").alias("n_rows"), F.count_distinct("krs").alias("entities"), F.sum("y").cast("long").alias("positives"), F.count_distinct(event).alias("distinct_events"))


def linear_score(constant: float, terms: dict[str, float], zones: list[tuple[str, float | None, float | None]]) -> tuple[Column, Column]:
    """A classical score and its zone; both null where any term is."""
    score = reduce(lambda s, t: s + F.lit(t[1]) * F.col(t[0]), terms.items(), F.lit(constant))
    zone = F.lit(None).cast("string")
    for name, low, high in zones:
        inside = (F.lit(True) if low is None else score >= low) & (F.lit(True) if high is None else score < high)
        zone = F.when(score.isNotNull() & inside, name).otherwise(zone)
    return score, zone


def mid_rank(train: DataFrame, rows: DataFrame, column: str, name: str) -> DataFrame:
    """Adds each value's mid-rank among the training values, (below + not above) / 2n: both sides in one ordered pass."""
    both = train.select(F.col(column).alias("_x"), F.lit(1).alias("_t")).filter("_x is not null").groupBy("_x").agg(F.sum("_t").alias("_t"))
    wanted = rows.select(F.col(column).alias("_x")).filter("_x is not null").distinct().withColumn("_t", F.lit(0).cast("long"))
    values = both.unionByName(wanted).groupBy("_x").agg(F.sum("_t").alias("_t"))
    # Distinct values, range-sorted: no task holds them all.
    ranked = running_sums(values, [], ["_x"], {"_upto": "_t"}).crossJoin(F.broadcast(values.agg(F.sum("_t").alias("_n"))))
    ranked = ranked.select("_x", ((F.col("_upto") * 2 - F.col("_t")) / (F.col("_n") * 2)).alias(name))
    return rows.join(ranked, rows[column] == ranked["_x"], "left").drop("_x")


def rank_logistic(train: DataFrame, features: list[str], label: str = "y", weight: str | None = None, c: float = 1.0):
    """An L2 logistic regression on ranked features: regParam = 1 / (C * total weight), unstandardised."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    total = train.agg(F.sum(weight) if weight else F.count("*")).first()[0]
    model = LogisticRegression(featuresCol="_features", labelCol=label, regParam=1.0 / (c * float(total)), elasticNetParam=0.0, standardization=False, maxIter=200, tol=1e-9)
    if weight:
        model = model.setWeightCol(weight)
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="_features"), model]).fit(train)


def boosted_trees(train: DataFrame, features: list[str], label: str = "y", rounds: int = 20, depth: int = 3, seed: int = 20261009):
    """Gradient-boosted trees; a missing value is imputed by the median beside a flag of its absence, as trees here know no missing."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import Imputer, VectorAssembler

    flags = [f"{f}__missing" for f in features]
    flagged = train.withColumns({n: F.col(f).isNull().cast("double") for f, n in zip(features, flags, strict=True)})
    filled = [f"{f}__filled" for f in features]
    stages = [Imputer(strategy="median", inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled + flags, outputCol="_features"), GBTClassifier(featuresCol="_features", labelCol=label, maxIter=rounds, maxDepth=depth, seed=seed)]
    return Pipeline(stages=stages).fit(flagged)


def person_periods(records: DataFrame, max_months: int) -> DataFrame:
    """One row for each month at risk: krs, start, month, event in that month. ``records``: krs, start, ended_on, event."""
    months = F.least(month_index(F.col("ended_on")) - month_index(F.col("start")), F.lit(max_months))
    each = records.withColumn("months", F.greatest(months, F.lit(0))).filter("months > 0").withColumn("month", F.explode(F.sequence(F.lit(1), F.col("months"))))
    whole = month_index(F.col("ended_on")) - month_index(F.col("start")) <= max_months
    return each.select("krs", "start", "month", (F.col("event") & whole & (F.col("month") == F.col("months"))).cast("int").alias("event"))


def survival_curve(periods: DataFrame, by: list[str]) -> DataFrame:
    """Hazard and survival by month: the product of one less the hazards."""
    hazard = periods.groupBy(*by, "month").agg(F.count("*").alias("at_risk"), F.sum("event").cast("long").alias("events"))
    upto = Window.partitionBy(*by).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    h = F.col("events") / F.col("at_risk")
    return hazard.select(*by, "month", "at_risk", "events", h.alias("hazard"), F.when(F.max(F.when(h >= 1, 1).otherwise(0)).over(upto) == 1, F.lit(0.0)).otherwise(F.exp(F.sum(F.when(h < 1, F.log(1 - h))).over(upto))).alias("survival"))


def permutation_draw(frame: DataFrame, stratum: str, key: str, n: int, seed: str) -> DataFrame:
    """The first n of each stratum in the order of a seeded hash, with their exact probability as a fraction.

    Every task keeps the first n it has of a stratum, and only those are ordered: at most n rows a task and stratum.
    """
    digest = F.sha2(F.concat_ws(":", F.lit(seed), F.col(key)), 256)
    rows = frame.withColumn("_digest", digest).withColumn("_task", F.spark_partition_id())
    sizes = frame.groupBy(stratum).agg(F.count("*").alias("pi_denominator"))
    ranked = lambda rows, *by: rows.withColumn("position", F.row_number().over(Window.partitionBy(*by).orderBy("_digest", key)).cast("long")).filter(F.col("position") <= n)
    drawn = ranked(ranked(rows, stratum, "_task"), stratum).withColumnRenamed(stratum, "_stratum")
    met = drawn.join(sizes, F.col("_stratum").eqNullSafe(F.col(stratum)))
    return met.select(stratum, key, "position", F.least(F.lit(n).cast("long"), F.col("pi_denominator")).alias("pi_numerator"), "pi_denominator")


def systematic_picks(frame: DataFrame, key: str, start: float, step: float) -> DataFrame:
    """Rows at places floor(start + i * step) of the frame ordered by key, from 0; the frame is range-sorted, never in one task."""
    placed = running_sums(frame.withColumn("_one", F.lit(1).cast("long")), [], [key], {"place": "_one"}).withColumn("place", (F.col("place") - 1).cast("int"))
    i = F.ceil((F.col("place") - F.lit(start)) / F.lit(step))
    return placed.withColumn("pick", F.greatest(i, F.lit(0)).cast("long")).filter(F.floor(F.lit(start) + F.col("pick") * F.lit(step)) == F.col("place")).select(key, "place", "pick")


def nonresponse_weights(draw: DataFrame, responded: str, by: list[str]) -> DataFrame:
    """1 / probability, raised in each group by the drawn weight over the responding weight; of those who responded."""
    base = draw.withColumn("base", F.col("pi_denominator") / F.col("pi_numerator"))
    own = Window.partitionBy(*by)
    factor = F.sum("base").over(own) / F.nullif(F.sum(F.when(F.col(responded), F.col("base"))).over(own), F.lit(0.0))
    return base.withColumn("factor", factor).filter(responded).withColumn("weight", F.col("base") * F.col("factor"))


def population(rows: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Why an entity is left out: the first rule that holds, null if it is in."""
    return rows.withColumn("left_out", first_reason(rules)).withColumn("included", F.col("left_out").isNull())


def complete_cases(store: DataFrame, features: dict[str, float], constant: float, shown: int = 5) -> DataFrame:
    """Scores of rows that have every input; otherwise the missing inputs. The drivers are the largest contributions, ties by name."""
    missing = F.filter(F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in features]), lambda x: x.isNotNull())
    total = reduce(lambda s, f: s + F.col(f) * F.lit(features[f]), features, F.lit(constant))
    parts = F.array(*[F.struct((-F.abs(F.col(f) * F.lit(w))).alias("order"), F.lit(f).alias("feature"), (F.col(f) * F.lit(w)).alias("contribution")) for f, w in features.items()])
    top = F.transform(F.slice(F.array_sort(parts), 1, shown), lambda x: F.struct(x["feature"].alias("feature"), x["contribution"].alias("contribution")))
    return store.withColumn("missing_inputs", missing).withColumn("probability", F.when(F.size("missing_inputs") == 0, 1 / (1 + F.exp(-total)))).withColumn("top_drivers", F.when(F.size("missing_inputs") == 0, top))


def driver_movement(before: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """Contributions by feature, before and now, and their change; a feature absent on a side counts 0 there."""
    a = before.select(*keys, "feature", F.col("contribution").alias("was"))
    b = now.select(*keys, "feature", F.col("contribution").alias("became"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return a.join(b, [*keys, "feature"], "full").select(*keys, "feature", zero("was").alias("was"), zero("became").alias("became"), (zero("became") - zero("was")).alias("moved"))
