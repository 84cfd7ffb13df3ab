"""A patient-day table derived from the ``events`` table.

Clinically meaningless: event types stand in for measurements, which gives
realistic shapes (missing values, gaps between days, two stays per subject).
Values are whole cents until one final division, so results do not depend on
the order of summation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.keys import DAY, STAY
from daymark.operators.features import Measure, daily_values

MEASURES = (
    Measure("platelet_sum", "sum", excluding=("error",)),
    Measure("platelet_n", "count", excluding=("error",)),
    Measure("inr_sum", "sum", excluding=("signup",)),
    Measure("inr_n", "count", excluding=("signup",)),
    Measure("sofa_sum", "sum", excluding=("view",)),
    Measure("sofa_n", "count", excluding=("view",)),
    Measure("any_sum", "sum"),
    Measure("any_n", "count"),
    Measure("any_max", "max"),
    Measure("not_click_sum", "sum", excluding=("click",)),
    Measure("not_click_n", "count", excluding=("click",)),
    Measure("not_click_max", "max", excluding=("click",)),
    Measure("not_purchase_min", "min", excluding=("purchase",)),
)


def measurements(events: DataFrame) -> DataFrame:
    """Events as a long measurement table: stay keys, time, item, value in cents."""
    half = F.when(F.dayofmonth(F.to_date("ts")) <= 15, 1).otherwise(2)
    return events.select(
        F.col("user_id").alias("subject_id"),
        (F.col("user_id") * 10 + half).alias("stay_id"),
        F.col("ts").alias("charttime"),
        F.col("event_type").alias("item"),
        F.round(F.col("value") * 100).cast("long").alias("value"),
    )


def patient_days(events: DataFrame) -> DataFrame:
    """One row per stay and day with every measurement the criteria use."""
    daily = daily_values(measurements(events), MEASURES)

    def mean(what: str, per: int) -> Column:
        count = F.nullif(F.col(f"{what}_n"), F.lit(0))
        return F.col(f"{what}_sum").cast("double") / (count * per)

    def number(column: Column) -> Column:
        return column.cast("double")

    return daily.select(
        *STAY,
        DAY,
        mean("platelet", 50).alias("platelet_avg"),
        mean("inr", 3000).alias("inr_avg"),
        mean("sofa", 1500).alias("average_sofa_score"),
        mean("any", 50).alias("mean_heart_rate"),
        (number(F.col("any_max")) / 400).alias("mean_resp_rate"),
        (number(F.col("any_max") + 105000) / 3000).alias("max_temperature"),
        number(F.col("not_click_max")).alias("wbc_avg"),
        (mean("not_click", 500) + 8).alias("pt_avg"),
        (number(F.col("not_purchase_min")) / 25).alias("fibrinogen_avg"),
        (number(F.col("any_max") * 3) / 5).alias("d_dimer_avg"),
    )


def sparse(days: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``days`` with NULL in a seventh of the values of each column, and NaN in another."""
    place = F.col("subject_id") + F.dayofmonth(DAY)

    def thinned(name: str, i: int) -> Column:
        k = (place + i) % 7
        return F.when(k == 0, None).when(k == 1, F.lit(float("nan"))).otherwise(F.col(name))

    return days.withColumns({c: thinned(c, i) for i, c in enumerate(columns)})


def event_rows(events: DataFrame) -> DataFrame:
    """Each event as a row of its own, repeated days and NULL ids included, with three measurements."""
    cents = F.round(F.col("value") * 100).cast("long")
    known = F.when(F.col("event_id") % 50 != 0, F.col("user_id"))
    return events.select(
        known.alias("subject_id"),
        (known * 10 + 1).alias("stay_id"),
        F.to_date("ts").alias(DAY),
        "event_id",
        (cents.cast("double") / 50).alias("platelet_avg"),
        (cents.cast("double") / 3000).alias("inr_avg"),
        (cents.cast("double") / 1500).alias("average_sofa_score"),
    )


def patients(events: DataFrame) -> DataFrame:
    """One row per subject; the number in the first event stands in for the age."""
    age = F.regexp_extract("props", "[0-9]+", 0).try_cast("int")
    return events.groupBy(F.col("user_id").alias("subject_id")).agg(
        F.min_by(age, "event_id").alias("age")
    )


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def read_patient_days(spark: SparkSession, folder: str) -> DataFrame:
    return patient_days(read_events(spark, folder))
