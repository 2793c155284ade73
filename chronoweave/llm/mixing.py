"""Mixes sources to target weights by systematic sampling.

Sizes are words. Sources, by code point and null last, weigh ``weights`` in turn and share ``total`` times all words;
a target stops at ``most`` times its source's size and the excess is shared again by weight among the others, until none
is above: with sources in order of what fills them, the full ones are a prefix, so one pass over the table of sources
gives the fixed point.

Within a source every document expects target / size copies. Documents are ordered by size, then id; the expected copies
are summed along that order, one offset in [0, 1) drawn by hash for the source is added, and a document is emitted once
for each integer that its part of the sum crosses. As the order is by size, the words taken come within about the largest
document of the target. The order is total and the offset hashed, so reruns agree.

A null text has size 0; a source whose documents are all empty has target 0 and gives none; a null source is a source. Rows that
repeat an id are rows like others; other columns are ignored unless asked for. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chronoweave.llm.ranks import ranked_within

WEIGHTS, TOTAL, MOST, SEED = (3, 1, 2), 1.5, 2.0, "mix-1"


def words_in(text: str = "text"):
    """Number of words; native, without an array of them."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, total: float = TOTAL, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size): one row for each source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int")))
    weighed = weighed.withColumn("room", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    fill = Window.orderBy(F.col("room") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = fill.rowsBetween(Window.unboundedPreceding, -1)
    level = weighed.withColumn("all", F.sum("source_size").over(every) * F.lit(float(total)))
    level = level.withColumn("full", F.coalesce(F.sum("room").over(upto), F.lit(0.0)))
    level = level.withColumn("left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    level = level.withColumn("share", (F.col("all") - F.col("full")) / F.col("left"))
    # The first source that its share doesn't fill sets the level; shares only fall after it, so it is the largest of those.
    level = level.withColumn("share", F.max(F.when(F.col("share") * F.col("weight") <= F.col("room"), F.col("share"))).over(every))
    return level.select("source", "source_size", F.least("room", F.coalesce(F.col("share") * F.col("weight"), F.col("room"))).alias("target"))


def copies_of(docs: DataFrame, weights: tuple = WEIGHTS, total: float = TOTAL, most: float = MOST, seed: str = SEED, extra: tuple = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies) for each row, and ``extra`` columns, which also break ties."""
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), words_in().alias("size"), *extra)
    placed = ranked_within(sized, ["source"], ["size", "doc_id", *extra])
    goal = targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), weights, total, most)
    goal = goal.withColumnRenamed("source", "_source")
    rows = placed.join(goal, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(F.lit(0.0))
    named = F.concat(F.lit(seed), F.lit(":"), F.coalesce(F.col("source"), F.lit("")))
    offset = F.conv(F.substring(F.sha2(named, 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))
    crossed = F.floor((F.col("rank") + 1) * rate + offset) - F.floor(F.col("rank") * rate + offset)
    return rows.select("doc_id", "source", "size", "source_size", "target", *extra, crossed.cast("long").alias("copies"))


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
         source_size * 2.0::DOUBLE AS room FROM sources
), levels AS (
  SELECT *, (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS alls, coalesce(sum(room) OVER upto, 0.0::DOUBLE) AS filled,
         sum(weight) OVER () - coalesce(sum(weight) OVER upto, 0.0::DOUBLE) AS remain
  FROM weighed WINDOW upto AS (ORDER BY room / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), shared AS (
  SELECT *, (alls - filled) / remain AS share FROM levels
), goal AS (
  SELECT source, source_size, least(room, coalesce(max(CASE WHEN share * weight <= room THEN share END) OVER () * weight, room)) AS target FROM shared
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, doc_id) - 1 AS rank FROM sized
), rated AS (
  SELECT p.doc_id, p.size, p.rank, g.source_size, g.target,
         CASE WHEN g.source_size > 0 THEN least(g.target / g.source_size, 2.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(sha256('mix-1:' || coalesce(p.source, '')), 1, 12))::BIGINT::DOUBLE / 281474976710656.0::DOUBLE AS start
  FROM placed p JOIN goal g ON p.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, (size * (floor((rank + 1) * rate + start) - floor(rank * rate + start)))::BIGINT AS taken FROM rated
"""
