"""Checks on a patient-day table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.keys import KEYS, no_null_keys


def require_columns(days: DataFrame, names: Iterable[str]) -> None:
    """Raise if the table lacks one of ``names``."""
    have = {c.lower() for c in days.columns}
    lacking = [n for n in names if n.lower() not in have]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")


def reject_columns(days: DataFrame, names: Iterable[str]) -> None:
    """Raise if the table already has one of ``names``, e.g. is labelled already."""
    have = {c.lower() for c in days.columns}
    taken = [n for n in names if n.lower() in have]
    if taken:
        raise ValueError(f"columns already present: {', '.join(taken)}")


def repeated_keys(days: DataFrame) -> DataFrame:
    """Every (subject, stay, day) held by more than one row, with its row count."""
    rows = days.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.filter(F.col("n_rows") > 1)


def key_report(days: DataFrame) -> DataFrame:
    """One row: rows, rows with a NULL key, keys that repeat, rows under such keys, the most rows of a key.

    A key with NULLs is a key like any other here, so its repeats are counted
    too: a window over the keys brings them together all the same. Days are
    unique if no key repeats.
    """
    per_key = days.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    repeated = F.col("n") > 1

    def total(condition, amount):
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0).cast("long"))

    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0).cast("long")).alias("n_rows"),
        total(~no_null_keys(), F.col("n")).alias("n_null_key_rows"),
        total(repeated, F.lit(1).cast("long")).alias("n_repeated_keys"),
        total(repeated, F.col("n")).alias("n_repeated_key_rows"),
        F.coalesce(F.max("n"), F.lit(0).cast("long")).alias("n_largest_key_rows"),
    )
