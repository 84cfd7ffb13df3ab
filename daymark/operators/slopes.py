"""Short-term trends as least-squares slopes over the last days, with the real gaps between them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.keys import DAY, STAY, match, over_calendar
from daymark.operators.checks import reject_columns

SUMS = ("n", "x", "y", "xx", "xy")


def _whole(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def _moments(column: str, unit: float) -> dict[str, Column]:
    """What one row adds to the sums of a column; a missing value (or NaN) adds nothing."""
    value, day = F.col(column).cast("double"), F.unix_date(DAY).cast("long")
    y = F.when(~F.isnan(value), F.round(value / F.lit(float(unit))).cast("long"))
    x = F.when(y.isNotNull(), day)
    return {"n": F.when(y.isNotNull(), F.lit(1).cast("long")), "x": x, "y": y, "xx": x * x, "xy": x * y}


def _slope(column: str, unit: float) -> Column:
    """Value per day; NULL without two different days. Numerator and denominator are exact whole numbers."""
    n, x, y, xx, xy = (_whole(F.col(f"_{column}_{s}")) for s in SUMS)
    # Each factor is cast again, so that a product keeps all its digits.
    above = (n * xy).cast("decimal(38,0)") - (x * y).cast("decimal(38,0)")
    below = (n * xx).cast("decimal(38,0)") - (x * x).cast("decimal(38,0)")
    return F.try_divide(above.cast("double") * F.lit(float(unit)), below.cast("double"))


def with_slopes(
    days: DataFrame, columns: Mapping[str, float], last_days: int = 3, unique_days: bool = False
) -> DataFrame:
    """Add ``<column>_slope<last_days>`` for each column: the trend over that many calendar days up to the row's own.

    ``columns`` gives the unit that a column's values are rounded to; sums of
    whole units are exact in any order. A frame of calendar days takes gaps
    for what they are and leaves days without a value out. Rows of a repeated
    day all count; they are summed per day before the shuffle, and share the
    result. A row without a day has no slope.
    """
    new = {f"{c}_slope{last_days}": c for c in columns}
    reject_columns(days, new)
    frame = f"{last_days - 1} PRECEDING AND CURRENT ROW"
    parts = {f"_{c}_{s}": part for c, unit in columns.items() for s, part in _moments(c, unit).items()}
    slopes = {name: F.when(F.col(DAY).isNotNull(), _slope(c, columns[c])) for name, c in new.items()}
    if unique_days:
        summed = days.withColumns(parts).withColumns({p: over_calendar(f"sum(`{p}`)", frame) for p in parts})
        return summed.withColumns(slopes).drop(*parts)
    per_day = days.filter(F.col(DAY).isNotNull()).groupBy(*STAY, DAY).agg(
        *[F.sum(part).alias(name) for name, part in parts.items()]
    )
    totals = per_day.withColumns({p: over_calendar(f"sum(`{p}`)", frame) for p in parts}).withColumns(slopes)
    return match(days, totals.select(*STAY, DAY, *new), [*STAY, DAY])
