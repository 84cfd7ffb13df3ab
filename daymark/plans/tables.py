"""The six stored label tables: three jobs, each reading what the one before wrote."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

from daymark.functions.criteria import ISTH, JAAM, SIC
from daymark.functions.keys import DAY, KEYS, STAY, no_null_keys
from daymark.functions.scoring import Criterion
from daymark.operators.labels import label_days, on_sic_days, with_sic_labels
from daymark.session import cut_lineage
from daymark.sources.tables import is_path, read_table, write_table


@dataclass(frozen=True)
class LabelTables:
    """Where the tables go: catalog names or Parquet paths."""

    sic_labels: str
    days_with_follow_up: str
    isth_labels: str
    sic_to_dic_isth: str
    jaam_labels: str
    sic_to_dic_jaam: str

    @classmethod
    def under(cls, place: str) -> LabelTables:
        """Tables below a folder ("/data/labels") or a catalog schema ("labels")."""
        sep = "/" if is_path(place) else "."
        return cls(**{f.name: f"{place.rstrip('/')}{sep}{f.name}" for f in fields(cls)})


def build_sic_tables(
    spark: SparkSession,
    source: str,
    target: LabelTables,
    sic: Criterion = SIC,
    buckets: int | None = None,
    **over,
) -> None:
    """From patient-days: the SIC label table, and the whole rows of its days.

    With ``buckets`` (catalog tables only) the merged table is stored bucketed
    by stay and sorted by day, so the DIC label tables are built from it
    without an exchange; a bucket holds whole stays, hence only with
    ``unique_days``.
    """
    if source.rstrip("/") in {getattr(target, f.name) for f in fields(target)}:
        raise ValueError(f"{source} would be replaced while it is read")
    layout = {}
    if buckets:
        if not over.get("unique_days"):
            raise ValueError("buckets need unique_days")
        layout = {"bucket_by": STAY, "sort_by": [*STAY, DAY], "buckets": buckets}

    # Both tables come from one pass over the stays, so they cannot disagree.
    followed = cut_lineage(with_sic_labels(read_table(spark, source), sic, **over))
    narrow = followed.select(*KEYS, *sic.inputs, *sic.outputs)
    write_table(narrow, target.sic_labels, sort_by=["stay_id", DAY])
    merged = followed.filter(no_null_keys())
    merged = merged.repartition(buckets, *STAY) if buckets else merged
    write_table(merged, target.days_with_follow_up, **layout)


def build_progression_tables(
    spark: SparkSession,
    merged: str,
    criterion: Criterion,
    labels: str,
    progression: str,
    sic: Criterion = SIC,
    mode: str = "overwrite",
    **over,
) -> None:
    """From the merged table: all days with DIC labels, and the days with SIC among them.

    ``mode="ignore"`` leaves an existing ``progression`` table as it is.
    """
    write_table(label_days(read_table(spark, merged), criterion, **over), labels)
    chosen = on_sic_days(read_table(spark, labels), criterion, sic)
    write_table(chosen, progression, mode=mode)


def build_label_tables(
    spark: SparkSession,
    source: str,
    target: LabelTables,
    sic: Criterion = SIC,
    isth: Criterion = ISTH,
    jaam: Criterion = JAAM,
    buckets: int | None = None,
    last_mode: str = "overwrite",
    **over,
) -> None:
    """All three jobs; ``last_mode`` is for the last table, the JAAM progression set."""
    build_sic_tables(spark, source, target, sic, buckets, **over)
    merged = target.days_with_follow_up
    build_progression_tables(
        spark, merged, isth, target.isth_labels, target.sic_to_dic_isth, sic, **over
    )
    build_progression_tables(
        spark, merged, jaam, target.jaam_labels, target.sic_to_dic_jaam, sic, last_mode, **over
    )
