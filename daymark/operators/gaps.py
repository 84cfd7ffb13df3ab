"""When and together with what values are missing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.keys import DAY, STAY
from daymark.operators.checks import reject_columns


def _known(column: str) -> Column:
    return F.col(column).isNotNull()


def with_days_since_known(days: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_days_since``: calendar days since the stay's last known value, 0 where it is known.

    NULL before the first known value. Days must be unique; all columns share
    one window.
    """
    new = [f"{c}_days_since" for c in columns]
    reject_columns(days, new)
    upto = Window.partitionBy(*STAY).orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
    last = {c: F.last(F.when(_known(c), F.col(DAY)), ignorenulls=True).over(upto) for c in columns}
    return days.withColumns({n: F.datediff(DAY, last[c]) for n, c in zip(new, columns, strict=True)})


def missing_runs(days: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Unbroken runs of recorded days without a value: one row for each column, stay and run.

    ``first_day`` and ``last_day`` are the run's recorded days and ``n_days``
    their number; ``opens`` and ``closes`` tell whether the run begins with
    the stay or ends with it. Days must be unique.

    All columns share one window: the number of known values so far names the
    run, and only missing days leave the row.
    """
    upto = Window.partitionBy(*STAY).orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
    stay = Window.partitionBy(*STAY).orderBy(DAY)
    runs = {f"_run_{i}": F.count(c).over(upto) for i, c in enumerate(columns)}
    ends = {"_first": F.lag(DAY).over(stay).isNull(), "_last": F.lead(DAY).over(stay).isNull()}
    placed = days.withColumns(runs | ends)
    missing = F.array_compact(F.array(*[
        F.when(~_known(c), F.struct(F.lit(c).alias("column_name"), F.col(f"_run_{i}").alias("_run")))
        for i, c in enumerate(columns)
    ]))
    rows = placed.select(*STAY, DAY, "_first", "_last", F.explode(missing).alias("_at")).select("*", "_at.*")
    return rows.groupBy("column_name", *STAY, "_run").agg(
        F.min(DAY).alias("first_day"),
        F.max(DAY).alias("last_day"),
        F.count(F.lit(1)).alias("n_days"),
        F.max("_first").alias("opens"),
        F.max("_last").alias("closes"),
    ).drop("_run")


def run_lengths(runs: DataFrame) -> DataFrame:
    """How many runs of each length a column has."""
    return runs.groupBy("column_name", "n_days").agg(
        F.count(F.lit(1)).alias("n_runs"), F.count(F.when(F.col("opens") & F.col("closes"), 1)).alias("n_whole_stays")
    )


def joint_missingness(days: DataFrame, columns: Sequence[str]) -> DataFrame:
    """For every two columns: rows that lack both, the first only, the second only, or neither.

    Rows are counted per set of missing columns, before the shuffle; the sets
    that hold a pair are then summed, so no pair reads the table again.
    """
    columns = list(columns)
    bits = [F.when(~_known(c), 1 << i).otherwise(0).cast("long") for i, c in enumerate(columns)]
    sets = days.groupBy(reduce(lambda a, b: a + b, bits).alias("_set")).agg(F.count(F.lit(1)).alias("n"))
    pairs = [
        F.struct(
            F.lit(a).alias("first_column"),
            F.lit(b).alias("second_column"),
            (F.col("_set").bitwiseAND(F.lit(1 << i)) != 0).alias("_a"),
            (F.col("_set").bitwiseAND(F.lit(1 << j)) != 0).alias("_b"),
        )
        for i, a in enumerate(columns) for j, b in enumerate(columns) if i < j
    ]
    each = sets.select("n", F.inline(F.array(*pairs)))

    def rows(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0).cast("long"))

    a, b = F.col("_a"), F.col("_b")
    return each.groupBy("first_column", "second_column").agg(
        rows(a & b).alias("n_both"),
        rows(a & ~b).alias("n_first_only"),
        rows(~a & b).alias("n_second_only"),
        rows(~a & ~b).alias("n_neither"),
    )
