"""Counts over label tables: yield, agreement of criteria, missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.criteria import ISTH, JAAM, SIC
from daymark.functions.scoring import Criterion


def _rows_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def label_yield(
    labelled: DataFrame, *criteria: Criterion, sic: Criterion = SIC
) -> DataFrame:
    """One row per criterion: how many days are scored, labelled and transitions.

    The ``sic_`` counts are over the days that :func:`on_sic_days` keeps.
    """
    criteria = criteria or (ISTH, JAAM)
    counts, rows = [], []
    for c in criteria:
        known = F.col(c.onset).isNotNull()
        onset = F.col(c.onset) == 1
        on_sic = F.col(sic.today) == 1
        columns = {
            "n_days": F.count(F.lit(1)),
            "n_scored": F.count(c.today),
            "n_positive": _rows_where(F.col(c.today) == 1),
            "n_labelled": F.count(c.onset),
            "n_transitions": _rows_where(onset),
            "n_sic_labelled": _rows_where(on_sic & known),
            "n_sic_transitions": _rows_where(on_sic & onset),
        }
        counts += [column.alias(f"{c.name}_{name}") for name, column in columns.items()]
        rows.append(
            F.struct(
                F.lit(c.name).alias("criterion"),
                *[F.col(f"{c.name}_{name}").alias(name) for name in columns],
            )
        )
    return labelled.agg(*counts).select(F.inline(F.array(*rows)))


def criteria_crosstab(
    labelled: DataFrame, first: Criterion = ISTH, second: Criterion = JAAM
) -> DataFrame:
    """Days by status under two criteria; unknown is a status of its own."""
    return labelled.groupBy(first.today, second.today).agg(F.count(F.lit(1)).alias("n_days"))


def missingness(days: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with its NULL count and rate, from one pass over the table."""
    counted = days.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in columns]
    )
    rows = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_known")) for c in columns]
    )
    return counted.select("_rows", F.inline(rows)).select(
        "column_name",
        F.col("_rows").alias("n_rows"),
        (F.col("_rows") - F.col("n_known")).alias("n_missing"),
        F.try_divide(F.col("_rows") - F.col("n_known"), "_rows").alias("missing_rate"),
    )
