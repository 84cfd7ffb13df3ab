"""Time to transition: how many stays are still free of a criterion, day by day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.keys import DAY, STAY, no_null_keys


def times_to_event(
    days: DataFrame, status: str, start: Column | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """One row for each stay: days from its start to the first day with ``status`` 1, or to its last known day.

    A stay starts on its first day on which ``start`` holds (by default its
    first day) and is left out without one, or if the status is never known
    from then on. ``event`` is 1 for a transition and 0 for a stay that was
    last seen without one (censored). ``keep`` are columns that are the same
    for a whole stay. Days with a NULL key are left out.

    Both aggregations combine before the shuffle, so a stay may have any
    number of rows; the second one needs the first one's result and is a join
    on the stay.
    """
    keyed = days.filter(no_null_keys())
    begun = F.lit(True) if start is None else start
    first = keyed.groupBy(*STAY).agg(F.min(F.when(begun, F.col(DAY))).alias("_start"))
    known = F.col(status).isNotNull()
    since = keyed.join(first.filter("_start IS NOT NULL"), STAY).filter(F.col(DAY) >= F.col("_start"))
    ends = since.groupBy(*STAY, "_start", *keep).agg(
        F.min(F.when(F.col(status) == 1, F.col(DAY))).alias("_event"),
        F.max(F.when(known, F.col(DAY))).alias("_last"),
    )
    return ends.filter("_last IS NOT NULL").select(
        *STAY,
        *keep,
        F.datediff(F.coalesce("_event", "_last"), "_start").alias("days"),
        F.col("_event").isNotNull().cast("int").alias("event"),
    )


def product_limit(times: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """The product-limit curve (Kaplan and Meier) with Greenwood's standard error.

    One row for each number of days (and group) at which a stay ends:
    ``n_at_risk``, ``n_events``, ``n_censored``, ``free`` (the share still
    without the event after that day) and ``std_error``. Stays are counted per
    day before the shuffle; the calendar bounds the days.
    """
    groups = list(groups)
    ended = times.groupBy(*groups, "days").agg(
        F.count(F.when(F.col("event") == 1, 1)).alias("n_events"),
        F.count(F.when(F.col("event") == 0, 1)).alias("n_censored"),
    )
    by_day = Window.partitionBy(*groups).orderBy("days")
    later = Window.partitionBy(*groups).orderBy(F.desc("days"))
    at_risk = F.sum(F.col("n_events") + F.col("n_censored")).over(later)
    counted = ended.withColumn("n_at_risk", at_risk)
    n, d = F.col("n_at_risk"), F.col("n_events")
    # The product is a sum of logarithms until all stays at risk end at once.
    survivors = F.when(n > d, F.log1p(-(d / n)))
    none_left = F.max((n == d).cast("int")).over(by_day) == 1
    spread = F.when(n > d, d / (n * (n - d)))
    curve = counted.withColumns({
        "free": F.when(none_left, F.lit(0.0)).otherwise(F.exp(F.sum(survivors).over(by_day))),
        "_spread": F.sum(spread).over(by_day),
    })
    error = F.when(F.col("free") > 0, F.col("free") * F.sqrt("_spread"))
    return curve.select(*groups, "days", "n_at_risk", "n_events", "n_censored", "free", error.alias("std_error"))
