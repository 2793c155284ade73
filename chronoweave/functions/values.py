"""Null-aware predicates, safe division, small cells and hash draws, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differs(a: Column, b: Column) -> Column:
    """True where two values differ, a null being a value."""
    return ~a.eqNullSafe(b)


def ratio(a: Column, b: Column) -> Column:
    """a / b; null where b is 0."""
    return a / F.nullif(b, F.lit(0))


def hidden_after(day: Column, fact: Column) -> Column:
    """A date later than the day is a fact not known then: null."""
    return F.when(fact <= day, fact)


def suppress(df: DataFrame, measures: list[str], count: str, least: int | None, flag: str = "suppressed") -> DataFrame:
    """Nulls the measures of rows that fewer than ``least`` stand behind, keeps the rows and flags them; None: never."""
    small = F.lit(False) if least is None else F.col(count) < least
    return df.withColumns({m: F.when(~small, F.col(m)) for m in measures}).withColumn(flag, small)


def position(options: list[str], value: Column) -> Column:
    """1 for the first option; null for none of them."""
    return F.nullif(F.array_position(F.array(*[F.lit(o) for o in options]), value), F.lit(0))


def unit_hash(*parts: Column, seed: str = "") -> Column:
    """A number in [0, 1) from the SHA-256 of seed and parts: the same everywhere and in every run."""
    text = F.concat_ws(":", F.lit(seed), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds; null if none does."""
    return reduce(lambda out, rule: F.when(rule[1], rule[0]).otherwise(out), reversed(rules), F.lit(None).cast("string"))


def all_reasons(rules: list[tuple[str, Column]]) -> Column:
    """The names of all rules that hold, in order."""
    return F.filter(F.array(*[F.when(test, name) for name, test in rules]), lambda x: x.isNotNull())


def distinct_sorted(value: Column) -> Column:
    """The sorted distinct non-null values of a group; null where there are none."""
    found = F.array_sort(F.collect_set(value))
    return F.when(F.size(found) > 0, found)
