"""Joins and filters over time: as-of, interval, visibility, latest rows, change points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def settled(df: DataFrame) -> DataFrame:
    """Ends the lineage of a table that rounds build on, in the folder named by ``spark.checkpoint.dir``.

    Only a local session without such a folder keeps it in memory instead.
    """
    context = df.sparkSession.sparkContext
    folder = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None and folder:
        context.setCheckpointDir(folder)
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        return df.cache()
    return df.checkpoint()


def running_sums(df: DataFrame, group: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """Adds, by name, the running sum of a column within each group along the order, the row itself included.

    The table is range-sorted by group and order, so a group as large as the table lies over many tasks; each sums its own rows,
    and what the tasks before it hold of the group is added: a row for each group and task. Rows equal in group and order may
    change places.
    """
    spread = df.repartitionByRange(*group, *order).withColumn("__task", F.spark_partition_id())
    there = settled(spread.sortWithinPartitions(*group, *order).withColumn("__row", F.monotonically_increasing_id()))
    parts = there.groupBy(*group, "__task").agg(*[F.sum(c).alias(f"__s_{n}") for n, c in sums.items()])
    earlier = Window.partitionBy(*group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(*[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], F.col("__task").alias("__t"), *[F.coalesce(F.sum(f"__s_{n}").over(earlier), F.lit(0)).alias(f"__b_{n}") for n in sums])
    own = Window.partitionBy("__task", *group).orderBy("__row").rowsBetween(Window.unboundedPreceding, 0)
    summed = there.select("*", *[F.sum(c).over(own).alias(f"__o_{n}") for n, c in sums.items()])
    same = [F.col(g).eqNullSafe(F.col(f"__g{i}")) for i, g in enumerate(group)]
    met = summed.join(before, [*same, F.col("__t") == F.col("__task")])
    return met.select(*df.columns, *[(F.col(f"__o_{n}") + F.col(f"__b_{n}")).alias(n) for n in sums])


def asof_join(left: DataFrame, right: DataFrame, by: list[str], left_on: str, right_on: str, take: list[str], how: str = "inner") -> DataFrame:
    """Each left row with the latest right row of its key at or before its time.

    Both sides are one stream per key, and the last right row seen is carried forward: one shuffle on the key, one sort, no
    comparison of all pairs. The right side is unique by key and time.
    """
    carried = F.struct(F.col(right_on).alias("_at"), *[F.col(c) for c in take])
    rest = [c for c in left.columns if c not in by]
    one = left.select(*by, F.col(left_on).alias("_time"), F.lit(1).alias("_side"), F.struct(*rest).alias("_left"))
    two = right.select(*by, F.col(right_on).alias("_time"), F.lit(0).alias("_side"), carried.alias("_right"))
    stream = one.unionByName(two, allowMissingColumns=True)
    upto = Window.partitionBy(*by).orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, 0)
    held = stream.withColumn("_seen", F.last("_right", ignorenulls=True).over(upto)).filter("_side = 1")
    if how == "inner":
        held = held.filter("_seen is not null")
    return held.select(*by, *[F.col(f"_left.{c}").alias(c) for c in rest], F.col("_seen._at").alias(right_on), *[F.col(f"_seen.{c}").alias(c) for c in take])


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key under an order."""
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(first)).filter("_n = 1").drop("_n")


def visible_at(facts: DataFrame, grid: DataFrame, by: list[str], known: str = "known_from", day: str = "as_of_date") -> DataFrame:
    """Every grid row with every fact of its key that was known by its day: the one way features read facts."""
    return grid.join(facts, by).filter(F.col(known) <= F.col(day))


def changed_rows(df: DataFrame, keys: list[str], order: list[str], state: list[str]) -> DataFrame:
    """The rows whose state differs from the row before them of the same key; the first always does."""
    before = Window.partitionBy(*keys).orderBy(*order)
    now = F.struct(*state)
    seen = df.withColumn("_state", now).withColumn("_before", F.lag("_state").over(before))
    return seen.filter(F.col("_before").isNull() | (F.col("_before") != F.col("_state"))).drop("_state", "_before")


def interval_join(left: DataFrame, right: DataFrame, by: list[str], after: Column, upto: Column, how: str = "inner") -> DataFrame:
    """An equi-join with a range left over as the residual condition: never a comparison across keys."""
    own = right.select(*[F.col(k).alias(f"_{k}") for k in by], *[c for c in right.columns if c not in by])
    keys = [left[k] == own[f"_{k}"] for k in by]
    return left.join(own, [*keys, after, upto], how).drop(*[f"_{k}" for k in by])


def one_to_one(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """The frame, after a check that no key repeats."""
    bad = df.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if bad:
        raise ValueError(f"{what}: keys repeat, as {bad[0].asDict()}")
    return df


def islands(df: DataFrame, keys: list[str], order: list[str], member: Column) -> DataFrame:
    """Numbers the runs of consecutive member rows of each key (gaps and islands); other rows are left out."""
    every = Window.partitionBy(*keys).orderBy(*order)
    breaks = F.sum(F.when(member, 0).otherwise(1)).over(every.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("island", breaks).filter(member)
