"""Every registered query with the DuckDB SQL it is held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chronoweave.plans import domain_queries, family_queries, feature_queries, golden_queries, lifecycle_queries, model_queries, quality_queries, registry_queries, relational_queries, source_queries, text_queries
from chronoweave.plans.query import Query

_ALL: list[Query] = [*relational_queries.QUERIES, *domain_queries.QUERIES, *feature_queries.QUERIES, *family_queries.QUERIES, *model_queries.QUERIES, *lifecycle_queries.QUERIES, *golden_queries.QUERIES, *quality_queries.QUERIES, *text_queries.QUERIES, *registry_queries.QUERIES, *source_queries.QUERIES]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {q.name: q.run for q in _ALL}
ORACLE_SQL: dict[str, str] = {q.name: q.oracle for q in _ALL if q.oracle}
