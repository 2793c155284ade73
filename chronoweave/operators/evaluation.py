"""Evaluation: weighted metrics, reliability, bootstrap intervals, champion rule, shift and drift, rates with intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.operators.temporal import running_sums

EPSILON = 1e-15


def brier(y: Column, p: Column, w: Column) -> Column:
    return F.sum(w * (p - y) * (p - y)) / F.sum(w)


def log_loss(y: Column, p: Column, w: Column) -> Column:
    q = F.least(F.greatest(p, F.lit(EPSILON)), F.lit(1 - EPSILON))
    return -F.sum(w * F.when(y == 1, F.log(q)).otherwise(F.log(1 - q))) / F.sum(w)


def metrics(rows: DataFrame, by: list[str], y: str = "y", p: str = "probability", w: Column | None = None, tie: list[str] | None = None) -> DataFrame:
    """n, events, base_rate, brier, log_loss, auc, top_decile of each group.

    AUC counts each positive-negative pair by the product of weights, ties half: one row per score, then a running sum. The top decile takes
    the highest scores up to a tenth of the weight, the row on the edge by the part that fits; ties by the ``tie`` columns.
    """
    weight = F.lit(1.0) if w is None else w
    base = rows.select(*by, F.col(y).cast("double").alias("_y"), F.col(p).alias("_p"), weight.cast("double").alias("_w"), *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tie or [])])
    ties = [F.col(f"_t{i}") for i in range(len(tie or []))]
    plain = base.groupBy(*by).agg(
        F.count("*").alias("n"), F.sum("_y").cast("long").alias("events"), (F.sum(F.col("_w") * F.col("_y")) / F.sum("_w")).alias("base_rate"),
        brier(F.col("_y"), F.col("_p"), F.col("_w")).alias("brier"), log_loss(F.col("_y"), F.col("_p"), F.col("_w")).alias("log_loss"),
    )
    scores = base.groupBy(*by, "_p").agg(F.sum(F.col("_w") * F.col("_y")).alias("pos"), F.sum(F.col("_w") * (1 - F.col("_y"))).alias("neg"))
    ranked = running_sums(scores, by, ["_p"], {"_upto": "neg"}).withColumn("below", F.col("_upto") - F.col("neg"))
    area = ranked.groupBy(*by).agg((F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2)) / F.nullif(F.sum("pos") * F.sum("neg"), F.lit(0.0))).alias("auc"))
    # From the highest score on; a group's rows lie over many tasks, and no task orders a group alone.
    summed = running_sums(base.withColumn("_down", -F.col("_p")), by, ["_down", *[f"_t{i}" for i in range(len(ties))]], {"_upto": "_w"})
    totals = base.groupBy(*by).agg((F.sum("_w") / 10).alias("_goal"))
    taken = summed.join(totals, by) if by else summed.crossJoin(F.broadcast(totals))
    room = F.col("_goal") - (F.col("_upto") - F.col("_w"))
    taken = taken.withColumn("_got", F.least(F.greatest(room, F.lit(0.0)), F.col("_w")))
    top = taken.groupBy(*by).agg((F.sum(F.col("_got") * F.col("_y")) / F.first("_goal")).alias("top_decile"))
    if not by:
        return plain.crossJoin(area).crossJoin(top)
    return plain.join(area, by).join(top, by)


def reliability(rows: DataFrame, bins: int = 10, y: str = "y", p: str = "probability", w: Column | None = None) -> DataFrame:
    """Mean score and (weighted) rate of each of equal-width bins; the last holds 1."""
    weight = (F.lit(1.0) if w is None else w).cast("double")
    bin_of = F.least(F.floor(F.col(p) * bins), F.lit(bins - 1)).cast("int")
    return rows.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.sum(F.col(y)).cast("long").alias("events"), (F.sum(weight * F.col(p)) / F.sum(weight)).alias("mean_score"), (F.sum(weight * F.col(y)) / F.sum(weight)).alias("rate"))


def bootstrap_brier(rows: DataFrame, entity: str, replicates: int = 1000, seed: int = 20260927, level: float = 0.95, strata: str | None = None) -> DataFrame:
    """Percentile interval of the Brier score when entities are drawn anew (within strata).

    A draw is a hash of seed, replicate and place, so every run draws the same; rows are never repeated, they are weighted by how
    often their entity was drawn. Sums per entity come first, so a replicate touches entities and not rows.
    """
    group = [strata] if strata else []
    sums = rows.groupBy(*group, entity).agg(F.sum(F.pow(F.col("probability") - F.col("y"), 2)).alias("s"), F.count("*").alias("m"))
    sizes = sums.groupBy(*group).agg(F.count("*").alias("size"))
    placed = running_sums(sums.withColumn("_one", F.lit(1).cast("long")), group, [entity], {"place": "_one"}).withColumn("place", F.col("place") - 1).drop("_one")
    placed = placed.join(sizes, group) if group else placed.crossJoin(F.broadcast(sizes))
    draws = placed.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    draws = draws.select(*group, "replicate", F.pmod(F.xxhash64(F.lit(seed), *group, "replicate", "place"), F.col("size")).alias("drawn"))
    times = draws.groupBy(*group, "replicate", "drawn").agg(F.count("*").alias("times"))
    drawn = times.join(placed.select(*group, F.col("place").alias("drawn"), "s", "m"), [*group, "drawn"])
    scored = drawn.groupBy("replicate").agg((F.sum(F.col("times") * F.col("s")) / F.sum(F.col("times") * F.col("m"))).alias("brier"))
    low, high = (1 - level) / 2, (1 + level) / 2
    return scored.agg(F.count("*").alias("replicates"), F.percentile("brier", low).alias("low"), F.percentile("brier", 0.5).alias("middle"), F.percentile("brier", high).alias("high"))


def champion(paired: DataFrame, interval_high: Column, auc_margin: float, least_events: int) -> DataFrame:
    """The verdict on a challenger: promoted where its Brier is surely lower, its AUC no worse than by the margin, and events suffice."""
    enough = F.col("events") >= least_events
    better = (interval_high < 0) & (F.col("auc_challenger") >= F.col("auc_incumbent") - auc_margin)
    return paired.withColumn("verdict", F.when(~enough, "provisional").when(better, "promoted").otherwise("kept"))


def quantiles(rows: DataFrame, value: str, at: list[float]) -> DataFrame:
    """(value): the exact quantiles, between two neighbours by their distance, from distinct values and running counts.

    A row for each quantile; no buffer holds more than the values a task has sorted.
    """
    counts = rows.filter(F.col(value).isNotNull()).groupBy(F.col(value).cast("double").alias("x")).agg(F.count("*").alias("n"))
    placed = running_sums(counts, [], ["x"], {"upto": "n"}).crossJoin(F.broadcast(counts.agg(F.sum("n").alias("total"))))
    spots = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.lit(float(q)) * (F.col("total") - 1)).alias("spot")) for i, q in enumerate(at)]))
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    found = placed.select("x", first.alias("first"), last.alias("last"), spots.alias("s")).select("x", "first", "last", "s.i", "s.spot")
    # A value that stands at the place below or above a spot, or at it.
    low, high = F.floor("spot"), F.ceil("spot")
    holds = lambda place: (F.col("first") <= place) & (place <= F.col("last"))
    ends = found.filter(holds(low) | holds(high)).groupBy("i", "spot").agg(F.max(F.when(holds(low), F.col("x"))).alias("a"), F.max(F.when(holds(high), F.col("x"))).alias("b"))
    return ends.select((F.col("a") + (F.col("b") - F.col("a")) * (F.col("spot") - F.floor("spot"))).alias("value"))


def population_shift(before: DataFrame, after: DataFrame, value: str, bins: int = 10, floor: float = 1e-4) -> DataFrame:
    """PSI over the quantile bins of the earlier values, and the Kolmogorov-Smirnov distance. One row."""
    edges = quantiles(before, value, [i / bins for i in range(1, bins)]).agg(F.array_sort(F.collect_list("value")).alias("e"))
    both = before.select(F.col(value).alias("x"), F.lit(0).alias("side")).unionByName(after.select(F.col(value).alias("x"), F.lit(1).alias("side")))
    bin_of = F.size(F.filter(F.array_distinct("e"), lambda e: e < F.col("x")))
    # One row of quantiles against all rows.
    counts = both.crossJoin(F.broadcast(edges)).groupBy(bin_of.alias("bin")).agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
    every = Window.partitionBy()
    a = F.greatest(F.col("a") / F.sum("a").over(every), F.lit(floor))
    b = F.greatest(F.col("b") / F.sum("b").over(every), F.lit(floor))
    psi = counts.select(((b - a) * F.log(b / a)).alias("part")).agg(F.sum("part").alias("psi"))
    steps = both.groupBy("x").agg(F.count_if(F.col("side") == 0).alias("a"), F.count_if(F.col("side") == 1).alias("b"))
    totals = steps.agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"))
    summed = running_sums(steps, [], ["x"], {"upto_a": "a", "upto_b": "b"}).crossJoin(F.broadcast(totals))
    gap = F.abs(F.col("upto_a") / F.col("n_a") - F.col("upto_b") / F.col("n_b"))
    return psi.crossJoin(summed.agg(F.max(gap).alias("ks")))


def wilson(k: Column, n: Column, z: float = 1.959963984540054) -> tuple[Column, Column]:
    """Wilson's interval for k of n."""
    p, d = k / n, 1 + z * z / n
    mid = (p + z * z / (2 * n)) / d
    half = z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)) / d
    return F.greatest(mid - half, F.lit(0.0)), F.least(mid + half, F.lit(1.0))


def clustered_ratio(rows: DataFrame, cluster: str, numerator: Column, denominator: Column, z: float = 1.959963984540054) -> DataFrame:
    """A ratio of sums over clusters with its linearised interval. The sums are one row, met by each cluster's."""
    per = rows.groupBy(cluster).agg(F.sum(numerator).cast("double").alias("a"), F.sum(denominator).cast("double").alias("b"))
    whole = per.agg((F.sum("a") / F.sum("b")).alias("ratio"))
    rest = F.col("a") - F.col("ratio") * F.col("b")
    out = per.crossJoin(F.broadcast(whole)).agg(F.first("ratio").alias("ratio"), F.count("*").alias("clusters"), F.sum(rest * rest).alias("uu"), F.sum("b").alias("b"))
    half = F.lit(z) * F.sqrt(F.col("clusters") / (F.col("clusters") - 1) * F.col("uu")) / F.col("b")
    return out.select("ratio", "clusters", (F.col("ratio") - half).alias("low"), (F.col("ratio") + half).alias("high"))
