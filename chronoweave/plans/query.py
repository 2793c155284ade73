"""A registered query: a function of the tables, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from chronoweave.plans.fixtures import Tables, oracle


@dataclass(frozen=True)
class Query:
    name: str
    plan: Callable[[Tables], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.plan(Tables(spark, sf_dir))

    @property
    def oracle(self) -> str | None:
        return oracle(self.sql) if self.sql else None


class Book(list):
    """Queries as they are defined; ``@book.query(sql)`` names one by its function."""

    def query(self, sql: str | None = None):
        def add(plan: Callable[[Tables], DataFrame]):
            self.append(Query(plan.__name__, plan, sql))
            return plan

        return add
