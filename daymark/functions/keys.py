"""The keys of a patient-day table and NULL-safe matching on them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STAY = ["subject_id", "stay_id"]
DAY = "chart_date"
KEYS = [*STAY, DAY]


def over_calendar(aggregate: str, frame: str) -> Column:
    """An aggregate over calendar days around a row's own, as "2 PRECEDING AND CURRENT ROW".

    It shares the exchange and the sort of windows over the recorded days of a stay.
    """
    return F.expr(f"{aggregate} OVER (PARTITION BY {', '.join(STAY)} ORDER BY {DAY} RANGE BETWEEN {frame})")


def no_null_keys() -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in KEYS])


def match(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    never_null: Sequence[str] = (),
) -> DataFrame:
    """Join on ``keys`` where NULL matches NULL; the left keys are kept.

    Keys in ``never_null`` are compared plainly, which can reuse a partitioning.
    """
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = [
        F.col(k) == F.col(f"_right_{k}")
        if k in never_null
        else F.col(k).eqNullSafe(F.col(f"_right_{k}"))
        for k in keys
    ]
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])
