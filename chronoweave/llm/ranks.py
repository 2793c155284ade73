"""Ranks over a whole table without bringing any group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.llm.store import cut


def ranked_within(df: DataFrame, group: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """Adds the rank from 0 of each row within its group by the order columns.

    The table is range-sorted by group and order, so a group as large as a third of all rows lies over many
    tasks; each task counts its rows of a group, and the counts before it are its offset. Rows equal in all
    columns named may change places.
    """
    spread = df.repartitionByRange(*group, *order) if order else df.repartitionByRange(*group)
    there = cut(spread.sortWithinPartitions(*group, *order).withColumn("__row", F.monotonically_increasing_id()))
    there = there.withColumn("__task", F.shiftright("__row", 33))
    parts = there.groupBy(*group, "__task").agg(F.count("*").alias("__n"), F.min("__row").alias("__first"))
    # One row for each group and for each further task it spans.
    earlier = Window.partitionBy(*group).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0)))
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    at = before.select(*[F.col(g).alias(f"__{g}") for g in group], F.col("__task").alias("__t"), "__first", "__before")
    out = there.join(at, [*same, F.col("__t") == F.col("__task")])
    return out.withColumn(name, F.col("__row") - F.col("__first") + F.col("__before")).select(*df.columns, name)
