"""Threshold scores and criteria, described as data and compiled to columns.

A :class:`Score` maps one measurement to points through an ordered list of
bands. A :class:`Criterion` adds several scores up, compares the sum with a
cut-off and names the columns that come out. Both compile to plain column
expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

import operator
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARE = {"<": operator.lt, ">": operator.gt, ">=": operator.ge}


@dataclass(frozen=True)
class Band:
    """``points`` for values that compare ``op`` with ``cut``."""

    op: str
    cut: float
    points: int

    def holds(self, value: Column) -> Column:
        met = COMPARE[self.op](value, F.lit(float(self.cut)))
        # Spark sorts NaN above every number; a NaN measurement meets no band.
        return met if self.op == "<" else met & ~F.isnan(value)


@dataclass(frozen=True)
class Score:
    """Points for one measurement: the first band that holds, else 0.

    ``missing`` is the score of a NULL measurement (NULL, or 0 where an
    unmeasured sign counts as normal). ``control`` is subtracted first.
    """

    name: str
    source: str
    bands: tuple[Band, ...]
    missing: int | None = None
    control: float = 0.0

    def column(self) -> Column:
        raw = F.col(self.source)
        value = raw - F.lit(float(self.control)) if self.control else raw
        points = F.when(raw.isNull(), F.lit(self.missing).cast("int"))
        for band in self.bands:
            points = points.when(band.holds(value), F.lit(band.points))
        return points.otherwise(F.lit(0))

    def rescaled(self, factor: float) -> Score:
        """The same score for a measurement stored in another unit."""
        return replace(self, bands=tuple(replace(b, cut=b.cut * factor) for b in self.bands))


@dataclass(frozen=True)
class Criterion:
    """A scored clinical criterion and the names of its output columns.

    ``parts`` are the named sums that come before the total: each is itself
    the sum of some scores (JAAM counts its SIRS signs that way).
    """

    name: str
    scores: tuple[Score, ...]
    cut: int
    today: str
    tomorrow: str
    onset: str
    total: str | None = None
    parts: tuple[tuple[str, tuple[Score, ...]], ...] = ()

    @property
    def part_scores(self) -> tuple[Score, ...]:
        return tuple(s for _, scores in self.parts for s in scores)

    @property
    def inputs(self) -> list[str]:
        return list(dict.fromkeys(s.source for s in self.part_scores + self.scores))

    @property
    def day_columns(self) -> list[str]:
        """Columns that depend on the day alone."""
        named = [n for name, scores in self.parts for n in (*[s.name for s in scores], name)]
        named += [s.name for s in self.scores]
        return named + ([self.total] if self.total else []) + [self.today]

    @property
    def outputs(self) -> list[str]:
        return self.day_columns + [self.tomorrow, self.onset]


def total_of(names: list[str]) -> Column:
    """Sum that is NULL as soon as one term is NULL."""
    return reduce(operator.add, [F.col(n) for n in names])


def flag_at(total: Column, cut: int) -> Column:
    """1 at or above ``cut``, 0 below, NULL where the total is unknown."""
    return (total >= F.lit(cut)).cast("int")


def score_days(days: DataFrame, criterion: Criterion) -> DataFrame:
    """Add every column of ``criterion`` that depends on the day alone."""
    for name, scores in criterion.parts:
        days = days.withColumns({s.name: s.column() for s in scores})
        days = days.withColumn(name, total_of([s.name for s in scores]))
    days = days.withColumns({s.name: s.column() for s in criterion.scores})
    terms = [name for name, _ in criterion.parts] + [s.name for s in criterion.scores]
    total = total_of(terms)
    if criterion.total:
        days = days.withColumn(criterion.total, total)
        total = F.col(criterion.total)
    return days.withColumn(criterion.today, flag_at(total, criterion.cut))


def onset_of(today: str, tomorrow: str) -> Column:
    """1 where a negative day is followed by a positive one.

    NULL without a known follow-up; an unknown present counts as no onset.
    """
    came_on = F.col(today).eqNullSafe(0) & (F.col(tomorrow) == 1)
    return F.when(F.col(tomorrow).isNotNull(), came_on.cast("int"))
