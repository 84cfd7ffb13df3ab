"""The label tables as versioned tables, and their upkeep when new days arrive."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.criteria import ISTH, JAAM, SIC
from daymark.functions.keys import DAY, KEYS, STAY, no_null_keys
from daymark.functions.scoring import Criterion
from daymark.operators.features import split_bucket
from daymark.operators.labels import label_days, on_sic_days, with_sic_labels
from daymark.plans.tables import LabelTables
from daymark.session import cut_lineage
from daymark.sources import versions

Label = Callable[[DataFrame], DataFrame]


def _from(spark: SparkSession, *paths: str) -> dict[str, str]:
    return versions.versions_of(spark, paths)


def renew_sic_tables(spark: SparkSession, source: str, target: LabelTables, sic: Criterion = SIC, **over) -> None:
    """The SIC label table and the merged table, from versioned patient-days."""
    made_from = _from(spark, source)
    followed = cut_lineage(with_sic_labels(versions.read(spark, source), sic, **over))
    narrow = followed.select(*KEYS, *sic.inputs, *sic.outputs).sortWithinPartitions("stay_id", DAY)
    made = versions.replace(narrow, target.sic_labels, made_from)
    merged = followed.filter(no_null_keys())
    versions.replace(merged, target.days_with_follow_up, made_from | {target.sic_labels: made})


def renew_labels(spark: SparkSession, target: LabelTables, criterion: Criterion, labels: str, **over) -> None:
    """The DIC label table of one criterion, from the merged table."""
    merged = target.days_with_follow_up
    made_from = _from(spark, merged)
    versions.replace(label_days(versions.read(spark, merged), criterion, **over), labels, made_from)


def renew_progression(
    spark: SparkSession, criterion: Criterion, labels: str, progression: str, sic: Criterion = SIC, if_absent: bool = False
) -> None:
    """The days with SIC among the labelled ones; ``if_absent`` leaves an existing table as it is."""
    made_from = _from(spark, labels)
    write = versions.create_if_absent if if_absent else versions.replace
    write(on_sic_days(versions.read(spark, labels), criterion, sic), progression, made_from)


def renew_label_tables(
    spark: SparkSession,
    source: str,
    target: LabelTables,
    sic: Criterion = SIC,
    isth: Criterion = ISTH,
    jaam: Criterion = JAAM,
    keep_last: bool = False,
    **over,
) -> None:
    """All six tables, each replaced in one step; ``source`` is a versioned table, too.

    A failure leaves every table whole, in its old or its new version, and
    :func:`stale_tables` names those that are behind.
    """
    renew_sic_tables(spark, source, target, sic, **over)
    renew_labels(spark, target, isth, target.isth_labels, **over)
    renew_progression(spark, isth, target.isth_labels, target.sic_to_dic_isth, sic)
    renew_labels(spark, target, jaam, target.jaam_labels, **over)
    renew_progression(spark, jaam, target.jaam_labels, target.sic_to_dic_jaam, sic, if_absent=keep_last)


def stale_tables(spark: SparkSession, source: str, target: LabelTables) -> DataFrame:
    tables = {f.name: getattr(target, f.name) for f in fields(target)}
    return versions.staleness(spark, {"patient_days": source} | tables)


# --- New days ------------------------------------------------------------------


def start_upkeep(days: DataFrame, days_path: str, labels_path: str, label: Label, buckets: int) -> None:
    """Patient-days and their labels as tables in buckets of whole subjects.

    ``label`` makes labelled rows from days, each stay by itself, and keeps the
    keys. Rows with a NULL key have no place in a stay; they are refused.
    """
    spark = days.sparkSession
    bucket = split_bucket("subject_id", buckets)
    whole = F.when(no_null_keys(), bucket).otherwise(F.raise_error(F.lit("a day with a NULL key")).cast("int"))
    made = versions.replace_buckets(days, days_path, whole)
    labelled = label(versions.read(spark, days_path))
    versions.replace_buckets(labelled, labels_path, bucket, inputs={days_path: made})


def add_days(new_days: DataFrame, days_path: str, labels_path: str, label: Label, buckets: int) -> list[int]:
    """Add days (or replace days of the same key) and bring the labels up to date; returns the changed buckets.

    Only buckets with a subject of ``new_days`` are read and written. In them
    only stays with a new day are labelled again, since a label depends on its
    own stay alone; the labels of other stays are carried over. The days are
    committed before the labels: a job that fails in between leaves labels that
    :func:`daymark.sources.versions.staleness` reports, and that
    :func:`repair_labels` brings up to date.
    """
    spark = new_days.sparkSession
    before = versions.state(spark, days_path)
    bucket = split_bucket("subject_id", buckets)
    new_days = cut_lineage(new_days)
    # At most as many numbers as there are buckets.
    changed = sorted(r[0] for r in new_days.filter(no_null_keys()).select(bucket.alias("b")).distinct().collect())
    if not new_days.filter(~no_null_keys()).isEmpty():
        raise ValueError("a day with a NULL key")
    if versions.state(spark, labels_path).inputs.get(days_path) != before.version:
        raise ValueError(f"{labels_path} is not up to date with {days_path}")
    if not changed:
        return []
    old_days = versions.read(spark, days_path, changed)
    kept = old_days.join(new_days.select(*KEYS), KEYS, "left_anti")
    made = versions.replace_buckets(kept.unionByName(new_days), days_path, bucket, changed)

    stays = new_days.select(*STAY).distinct()
    again = label(versions.read(spark, days_path, changed).join(stays, STAY, "left_semi"))
    same = versions.read(spark, labels_path, changed).join(stays, STAY, "left_anti")
    columns = versions.read(spark, labels_path).columns
    versions.replace_buckets(
        same.unionByName(again).select(*[f"`{c}`" for c in columns]), labels_path, bucket, changed, {days_path: made}
    )
    return changed


def repair_labels(spark: SparkSession, days_path: str, labels_path: str, label: Label, buckets: int) -> None:
    """Label all days again, for labels that a failed job left behind."""
    made_from = _from(spark, days_path)
    labelled = label(versions.read(spark, days_path))
    versions.replace_buckets(labelled, labels_path, split_bucket("subject_id", buckets), inputs=made_from)
