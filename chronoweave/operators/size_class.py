"""Size classes by statutory regime: three criteria, two of which decide, held over two years."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date

import pandas as pd
from pyspark.sql import DataFrame

CLASSES = ("micro", "small", "medium", "large")


@dataclass(frozen=True)
class Regime:
    """Thresholds of assets, revenue and employment up to micro, small and medium, from a date on."""

    name: str
    starts: date
    carry_over: bool
    limits: tuple[tuple[float, float, float], ...]


# The statutory thresholds.
REGIMES = (
    Regime("uor_2017", date(2017, 1, 1), False, ((1_500_000, 3_000_000, 10), (17_000_000, 34_000_000, 50), (110_000_000, 220_000_000, 250))),
    Regime("uor_2019", date(2019, 1, 1), False, ((1_500_000, 3_000_000, 10), (25_500_000, 51_000_000, 50), (110_000_000, 220_000_000, 250))),
    Regime("uor_2024", date(2024, 1, 1), True, ((2_000_000, 4_000_000, 10), (33_000_000, 66_000_000, 50), (110_000_000, 220_000_000, 250))),
)


def possible(regime: Regime, bounds: tuple[tuple[float, float], ...]) -> frozenset[int]:
    """The classes that values within bounds can have: the least level that two of three criteria don't exceed.

    A criterion given as (low, high) can be of any level between those of its ends; an unknown one of any.
    """
    levels = [tuple(sum(v > limit[i] for limit in regime.limits) for v in ends) for i, ends in enumerate(bounds)]
    low, high = sorted(a for a, _ in levels)[1], sorted(b for _, b in levels)[1]
    return frozenset(range(low, high + 1))


def regime_on(day: date, regimes: tuple[Regime, ...] = REGIMES) -> Regime | None:
    return max((r for r in regimes if r.starts <= day), key=lambda r: r.starts, default=None)


def history(years: list[dict], regimes: tuple[Regime, ...] = REGIMES) -> Iterator[dict]:
    """For each fiscal year in order: the class, or why it is undecided.

    A class takes hold when this year and the one before could only be it; a first year decides alone. Under a regime with carry-over,
    a single deviating year leaves the class as it was.
    """
    before, held = None, None
    for year in sorted(years, key=lambda y: y["fiscal_year"]):
        regime = regime_on(year["period_start"], regimes)
        if regime is None:
            yield {**year, "regime": None, "size_class": None, "reason": "no_regime"}
            continue
        bounds = tuple((year[f"{c}_low"] if pd.notna(year[f"{c}_low"]) else float("-inf"), year[f"{c}_high"] if pd.notna(year[f"{c}_high"]) else float("inf")) for c in ("assets", "revenue", "employment"))
        now = possible(regime, bounds)
        follows = before is not None and before[0] == year["fiscal_year"] - 1
        if len(now) > 1:
            found, reason = None, "undecided"
        elif not follows:
            found, reason = next(iter(now)), "first_year"
        elif now == before[1]:
            found, reason = next(iter(now)), "two_years"
        elif held is not None and (regime.carry_over or len(before[1]) == 1):
            found, reason = held, "carried_over"
        else:
            found, reason = None, "year_before_undecided"
        held = found if found is not None else held
        before = year["fiscal_year"], now
        yield {**year, "regime": regime.name, "size_class": None if found is None else CLASSES[found], "reason": reason}


def size_class_history(years: DataFrame, regimes: tuple[Regime, ...] = REGIMES) -> DataFrame:
    """Class per entity and year; the one operator whose state runs across years, so an entity's few years meet in one call.

    ``years``: krs, fiscal_year, period_start, and low and high of assets, revenue and employment.
    """

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame(history(rows.to_dict("records"), regimes))
        return out[["krs", "fiscal_year", "regime", "size_class", "reason"]]

    return years.groupBy("krs").applyInPandas(one, "krs string, fiscal_year int, regime string, size_class string, reason string")
