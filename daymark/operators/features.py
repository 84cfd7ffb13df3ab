"""Building the patient-day table: daily values, trends, cohort and split."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.keys import DAY, STAY
from daymark.operators.checks import reject_columns
from daymark.operators.series import Neighbour, over_stays

DAILY = {"avg": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "count": F.count}


@dataclass(frozen=True)
class Measure:
    """One daily column: ``how`` over the values of ``items`` (or of all but ``excluding``)."""

    name: str
    how: str
    items: tuple[str, ...] = ()
    excluding: tuple[str, ...] = ()

    def column(self, item: str, value: str) -> Column:
        taken = F.col(value)
        if self.items:
            taken = F.when(F.col(item).isin(*self.items), taken)
        if self.excluding:
            taken = F.when(~F.col(item).isin(*self.excluding), taken)
        return DAILY[self.how](taken).alias(self.name)


def daily_values(
    measurements: DataFrame,
    measures: Sequence[Measure],
    time: str = "charttime",
    item: str = "item",
    value: str = "value",
    day_starts_at: int = 0,
) -> DataFrame:
    """One row per stay and day from a long table of measurements.

    A day is the 24 hours from ``day_starts_at`` (an hour) and carries the date
    on which it starts.

    All measures come from one aggregation, combined before the shuffle, so a
    patient with very many measurements sends few rows.
    """
    start = F.make_dt_interval(hours=F.lit(day_starts_at))
    day = F.to_date(F.col(time) - start if day_starts_at else time)
    return measurements.groupBy(*STAY, day.alias(DAY)).agg(
        *[m.column(item, value) for m in measures]
    )


def with_trends(
    days: DataFrame,
    lags: Mapping[str, Sequence[int]] | None = None,
    deltas: Sequence[str] = (),
    **over,
) -> DataFrame:
    """Add ``<column>_lag<k>`` for each lag and ``<column>_delta`` to the row before."""
    lags = {c: list(distances) for c, distances in (lags or {}).items()}
    looks = {f"{c}_lag{k}": (c, -k) for c, distances in lags.items() for k in distances}
    before = {c: f"{c}_lag1" if 1 in lags.get(c, ()) else f"_{c}_before" for c in deltas}
    scratch = [name for name in before.values() if name not in looks]
    reject_columns(days, [*looks, *[f"{c}_delta" for c in deltas]])

    def step(rows: DataFrame, neighbour: Neighbour) -> DataFrame:
        rows = neighbour(rows, looks | {name: (c, -1) for c, name in before.items()})
        rows = rows.withColumns({f"{c}_delta": F.col(c) - F.col(before[c]) for c in deltas})
        return rows.drop(*scratch)

    return over_stays(days, step, **over)


def adults(patients: DataFrame, age: str = "age", at_least: int = 18) -> DataFrame:
    return patients.filter(F.col(age) >= at_least)


def with_infection(days: DataFrame, infections: DataFrame, keys: Sequence[str] = ("subject_id",)):
    """Rows whose keys appear in ``infections``; that side is reduced to its keys first."""
    return days.join(infections.select(*keys).distinct(), list(keys), "left_semi")


def cohort(
    days: DataFrame, patients: DataFrame, infections: DataFrame, at_least: int = 18
) -> DataFrame:
    """Days of adult patients with a suspected infection, with the columns of ``patients``.

    Patients are narrowed down first, so that the days are joined once.
    """
    wanted = with_infection(adults(patients, at_least=at_least), infections)
    return days.join(wanted, "subject_id")


def split_bucket(subject: str = "subject_id", buckets: int = 100) -> Column:
    """A bucket from the subject id alone, the same on every engine and every run."""
    head = F.substring(F.md5(F.col(subject).cast("string").cast("binary")), 1, 8)
    return F.pmod(F.conv(head, 16, 10).cast("long"), F.lit(buckets)).cast("int")


def with_split(
    days: DataFrame, train: int = 70, validation: int = 15, subject: str = "subject_id"
) -> DataFrame:
    """Add ``split``; a subject's days all fall on one side. Needs no shuffle."""
    bucket = split_bucket(subject)
    return days.withColumn(
        "split",
        F.when(bucket < train, "train")
        .when(bucket < train + validation, "validation")
        .otherwise("test"),
    )
