"""Features of the hours before a moment, such as "the preceding 24 hours".

The window of a moment ``e`` is ``[e - hours, e)``, to the microsecond. It is
made of whole panes (an hour each) and, unless the moment falls on the border
of a pane, of a piece of a pane at both ends:

* measurements become one row per stay and pane before the shuffle, and a RANGE
  frame over pane numbers adds up the whole ones. The calendar bounds the panes
  of a stay, so a patient with very many measurements, or very many moments,
  makes no large window;
* pieces are running totals within one pane, only of panes that some moment
  cuts. A stay is spread over its panes there.

Averages come from sums and counts, so whole-number values give exact results.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.keys import STAY
from daymark.operators.checks import reject_columns, require_columns
from daymark.operators.features import Measure

HOUR = 3_600_000_000  # microseconds
PARTS = {"avg": ("sum", "count"), "min": ("min",), "max": ("max",), "sum": ("sum",), "count": ("count",)}
MERGED = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}


def microseconds(df: DataFrame, time: str) -> Column:
    """The place of a timestamp on a line; without a time zone that of the clock on the wall."""
    if df.schema[time].dataType == T.TimestampNTZType():
        second = F.date_part(F.lit("SECOND"), F.col(time)) * 1_000_000
        whole = F.unix_date(F.to_date(time)).cast("long") * 24 + F.hour(time)
        return whole * HOUR + F.minute(time).cast("long") * 60_000_000 + second.cast("long")
    return F.unix_micros(F.col(time).cast("timestamp"))


def pane_of(moment: str, width: int) -> Column:
    """The number of the pane that holds a moment, in whole numbers also before 1970."""
    return F.expr(f"({moment} - pmod({moment}, {width}L)) div {width}L")


class _Parts:
    """The partial results that the measures are made of, and how they merge."""

    def __init__(self, measures: Sequence[Measure]):
        self.measures = list(measures)
        self.how = {
            f"_{i}_{part}": (part, measure)
            for i, measure in enumerate(self.measures)
            for part in PARTS[measure.how]
        }

    def of_rows(self, item: str, value: str) -> list[Column]:
        return [replace(m, name=name, how=part).column(item, value) for name, (part, m) in self.how.items()]

    def merged(self, suffix: str = "") -> list[Column]:
        return [MERGED[part](name + suffix).alias(name) for name, (part, _) in self.how.items()]

    def over(self, window, suffix: str) -> dict[str, Column]:
        return {name + suffix: MERGED[part](name).over(window) for name, (part, _) in self.how.items()}

    def nothing(self, rows: DataFrame) -> list[Column]:
        return [F.lit(None).cast(rows.schema[name].dataType).alias(name) for name in self.how]

    def results(self) -> dict[str, Column]:
        out = {}
        for i, measure in enumerate(self.measures):
            if measure.how == "avg":
                out[measure.name] = F.try_divide(F.col(f"_{i}_sum"), F.col(f"_{i}_count"))
            elif measure.how == "count":
                out[measure.name] = F.coalesce(F.col(f"_{i}_count"), F.lit(0).cast("long"))
            else:
                out[measure.name] = F.col(f"_{i}_{measure.how}")
        return out


def trailing_values(
    measurements: DataFrame,
    anchors: DataFrame,
    measures: Sequence[Measure],
    hours: int = 24,
    at: str = "at",
    time: str = "charttime",
    item: str = "item",
    value: str = "value",
) -> DataFrame:
    """Every row of ``anchors`` with the measures of its stay over the ``hours`` before ``at``.

    A measurement at the moment itself is not before it; one exactly ``hours``
    earlier is within. An anchor with a NULL stay or moment has no values: its
    counts are 0 and all else is NULL, as for a window without measurements.
    Repeated anchors each keep their row.
    """
    require_columns(measurements, [*STAY, time, item, value])
    require_columns(anchors, [*STAY, at])
    reject_columns(anchors, [m.name for m in measures])
    parts = _Parts(measures)
    panes_back, reach = hours, hours * HOUR

    timed = measurements.withColumn("_t", microseconds(measurements, time)).dropna(subset=[*STAY, "_t"])
    rows = timed.withColumn("_pane", pane_of("_t", HOUR))
    placed = anchors.withColumn("_e", microseconds(anchors, at))
    moments = placed.select(*STAY, "_e").dropna().distinct()
    moments = moments.withColumns({"_pane": pane_of("_e", HOUR), "_cut": F.expr(f"pmod(_e, {HOUR}L) > 0")})

    panes = rows.groupBy(*STAY, "_pane").agg(*parts.of_rows(item, value))
    found = _whole_panes(panes, moments, parts, panes_back).unionByName(
        _pieces(rows, moments.filter("_cut"), parts, reach, item, value)
    )
    features = found.groupBy(*STAY, "_e").agg(*parts.merged())
    joined = placed.join(features, [*STAY, "_e"], "left")
    return joined.withColumns(parts.results()).select(*[f"`{c}`" for c in anchors.columns], *[m.name for m in measures])


def _whole_panes(panes: DataFrame, moments: DataFrame, parts: _Parts, back: int) -> DataFrame:
    """(stay, _e, parts) over the whole panes of each moment's window."""
    asked = moments.select(*STAY, "_pane").distinct()
    line = panes.withColumn("_asked", F.lit(False)).unionByName(
        asked.select(*STAY, "_pane", *parts.nothing(panes), F.lit(True).alias("_asked"))
    )
    in_stay = Window.partitionBy(*STAY).orderBy("_pane")
    totals = line.withColumns(parts.over(in_stay.rangeBetween(-back, -1), "_whole"))
    # The first pane of a moment within a pane is not whole.
    if back > 1:
        totals = totals.withColumns(parts.over(in_stay.rangeBetween(1 - back, -1), "_inner"))
    else:
        totals = totals.withColumns({name + "_inner": F.lit(None) for name in parts.how})
    answers = totals.filter("_asked").drop(*parts.how)
    chosen = [F.when(F.col("_cut"), F.col(n + "_inner")).otherwise(F.col(n + "_whole")).alias(n) for n in parts.how]
    return moments.join(answers, [*STAY, "_pane"]).select(*STAY, "_e", *chosen)


def _pieces(
    rows: DataFrame, moments: DataFrame, parts: _Parts, reach: int, item: str, value: str
) -> DataFrame:
    """(stay, _e, parts) of the pieces of panes at both ends of each window."""
    ends = F.array(
        F.struct(F.col("_e").alias("_x"), F.lit(True).alias("_ends")),
        F.struct((F.col("_e") - reach).alias("_x"), F.lit(False).alias("_ends")),
    )
    cuts = moments.select(*STAY, F.explode(ends).alias("_end")).select(*STAY, "_end.*")
    cuts = cuts.groupBy(*STAY, "_x").agg(F.max("_ends").alias("_ends"), F.min("_ends").alias("_only_ends"))
    cuts = cuts.withColumn("_pane", pane_of("_x", HOUR))
    cut_panes = cuts.select(*STAY, "_pane").distinct()
    near = rows.join(cut_panes, [*STAY, "_pane"], "left_semi")
    # Measurements of one moment are one row, combined before the shuffle.
    per_time = near.groupBy(*STAY, "_pane", F.col("_t").alias("_x")).agg(*parts.of_rows(item, value))
    no_cut = {"_ends": F.lit(None).cast("boolean"), "_only_ends": F.lit(None).cast("boolean")}
    line = per_time.withColumns(no_cut).unionByName(
        cuts.select(*STAY, "_pane", "_x", "_ends", "_only_ends", *parts.nothing(per_time))
    )
    # A cut comes before the measurements of its own moment.
    is_row = F.col("_ends").isNull()
    in_pane = Window.partitionBy(*STAY, "_pane")
    upto = in_pane.orderBy("_x", is_row).rowsBetween(Window.unboundedPreceding, -1)
    after = in_pane.orderBy(F.desc("_x"), is_row.desc()).rowsBetween(Window.unboundedPreceding, -1)
    totals = line.withColumns(parts.over(upto, "_upto")).withColumns(parts.over(after, "_after"))
    answers = totals.filter(~is_row)

    def piece(suffix: str) -> list[Column]:
        return [F.col(name + suffix).alias(name) for name in parts.how]

    last = answers.filter("_ends").select(*STAY, F.col("_x").alias("_e"), *piece("_upto"))
    first = answers.filter("NOT _only_ends").select(*STAY, (F.col("_x") + reach).alias("_e"), *piece("_after"))
    return last.unionByName(first)
