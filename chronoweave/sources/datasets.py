"""Datasets on disk: declared schemas, atomic replacement, frozen sets, digests, content-addressed objects."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class NotMaterialised(Exception):
    """A dataset that no run has written yet."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def read_dataset(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """A dataset under its declared schema; an error if it was never written. Between the two renames of a replacement, or after a
    crash there, the version before is read."""
    path = f"{root}/{name}"
    if not exists(spark, path):
        path = _before(root, name)
        if not exists(spark, path):
            raise NotMaterialised(f"{name} has not been written to {root}")
    return spark.read.schema(schema).parquet(path)


def _before(root: str, name: str) -> str:
    """Where a dataset's version before stands while it is replaced."""
    return f"{root}/_before-{name}"


def external_view(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """A view over a dataset, or an empty one of the declared columns."""
    try:
        df = read_dataset(spark, root, name, schema)
    except NotMaterialised:
        df = spark.createDataFrame([], schema)
    df.createOrReplaceTempView(name)
    return df


def write_dataset(df: DataFrame, root: str, name: str, keys: list[str], partition: str | None = None) -> None:
    """Replaces a dataset as a whole: written beside it, then renamed. Its partition column stays in the files as well.

    At every moment either the version before or the new one can be read (``read_dataset``).
    """
    spark = df.sparkSession
    stage, path = f"{root}/_stage-{uuid.uuid4().hex}", f"{root}/{name}"
    if partition:
        df = df.withColumn(f"{partition}_part", F.col(partition)).repartition(partition).sortWithinPartitions(partition, *keys)
        df.write.option("compression", "zstd").partitionBy(f"{partition}_part").parquet(stage)
    else:
        df.sortWithinPartitions(*keys).write.option("compression", "zstd").parquet(stage)
    fs, staged, path_of = _fs(spark, stage)
    target, old = path_of(path), path_of(_before(root, name))
    if fs.exists(target):
        fs.delete(old, True)  # left by a crash after the new version stood
        fs.rename(target, old)
    if not fs.rename(staged, target):
        raise OSError(f"could not put {name} in place")
    fs.delete(old, True)


def digest(df: DataFrame) -> str:
    """A digest of a table's rows that no order or layout changes: sorted columns, a hash for each row, hashes sorted and hashed by prefix."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    hashed = df.select(row.alias("row"))
    parts = hashed.groupBy(F.substring("row", 1, 4).alias("part")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list("row")), ""), 256).alias("h"))
    return parts.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("part", "h"))), ""), 256)).first()[0]


def column_digests(df: DataFrame) -> DataFrame:
    """(column, digest) by an order-free sum of hashes: which columns of two tables differ."""
    sums = [F.sum(F.xxhash64(F.lit(c), F.col(c)).cast("decimal(38,0)")).cast("string").alias(c) for c in df.columns]
    return df.agg(*sums).unpivot([], df.columns, "column", "digest")


def freeze_set(df: DataFrame, root: str, prefix: str, keys: list[str]) -> str:
    """Writes a set under its content hash, once; returns the hash."""
    found = digest(df)
    if not exists(df.sparkSession, f"{root}/{prefix}={found}"):
        write_dataset(df, root, f"{prefix}={found}", keys)
    return found


def load_frozen(spark: SparkSession, root: str, prefix: str, wanted: str, schema: T.StructType) -> DataFrame:
    """A frozen set; an error if its rows no longer hash to its name."""
    df = read_dataset(spark, root, f"{prefix}={wanted}", schema)
    if digest(df) != wanted:
        raise ValueError(f"{prefix}={wanted} does not hold the rows it was frozen with")
    return df


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tables hold the same rows as often."""
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def content_addressed(files: DataFrame, stored: DataFrame) -> DataFrame:
    """The files (binaryFile rows) not stored yet, once each, by SHA-256."""
    return files.withColumn("sha256", F.sha2("content", 256)).dropDuplicates(["sha256"]).join(stored.select("sha256"), "sha256", "left_anti")


def jdbc_table(spark: SparkSession, url: str, table: str, columns: list[str], **options) -> DataFrame:
    """Named columns of a table behind JDBC; filters and the projection reach it."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load().select(*columns)
