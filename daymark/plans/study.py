"""Registered queries around the labels: the hours before, upkeep, definitions, uncertainty, time and gaps.

As in ``queries.py``, all start from the whole ``events`` table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.criteria import ISTH, JAAM, SIC
from daymark.functions.keys import KEYS, STAY
from daymark.operators import gaps, labels, models, recalibrate, selection, slopes, survival, uncertainty
from daymark.operators.calendar import follow_up_distances, label_days_by_date
from daymark.operators.features import Measure, split_bucket
from daymark.operators.trailing import trailing_values
from daymark.plans import queries, upkeep
from daymark.plans.tables import LabelTables
from daymark.session import cut_lineage, shared_folder
from daymark.sources import versions
from daymark.sources.events import event_rows, measurements, read_events, read_patient_days

Query = Callable[[SparkSession, str], DataFrame]

BEFORE = (
    Measure("n_values", "count"),
    Measure("value_avg", "avg"),
    Measure("value_sum", "sum"),
    Measure("view_min", "min", items=("view",)),
    Measure("other_max", "max", excluding=("view", "click")),
    Measure("n_clicks", "count", items=("click",)),
)
BUCKETS = 16


def place_of(spark: SparkSession, name: str) -> str:
    """A new folder for the stored tables of one run of a query."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# --- The preceding 24 hours ----------------------------------------------------


def preceding_24_hours(spark, folder):
    """Before each error: a moment to the microsecond."""
    long = measurements(read_events(spark, folder))
    anchors = long.filter("item = 'error'").select(*STAY, F.col("charttime").alias("at"))
    return _with_text_time(trailing_values(long, anchors, BEFORE))


def _with_text_time(rows):
    return rows.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def preceding_24_hours_of_days(spark, folder):
    """Before six in the morning of each recorded day, and before its end."""
    days = read_patient_days(spark, folder).select(*KEYS)
    midnight = F.col("chart_date").cast("timestamp_ntz")
    hours = F.explode(F.array(F.lit(6), F.lit(24)))
    anchors = days.select(*STAY, midnight.alias("day"), hours.alias("hour")).select(
        *STAY, "hour", (F.col("day") + F.make_dt_interval(hours=F.col("hour"))).alias("at")
    )
    return _with_text_time(trailing_values(measurements(read_events(spark, folder)), anchors, BEFORE))


def preceding_3_hours(spark, folder):
    long = measurements(read_events(spark, folder))
    anchors = long.filter("item = 'signup'").select(*STAY, F.col("charttime").alias("at"))
    return _with_text_time(trailing_values(long, anchors, BEFORE, hours=3))


def recent_slopes(spark, folder, unique_days=True):
    days = queries.read_patient_days(spark, folder)
    units = {"platelet_avg": 0.01, "inr_avg": 0.01}
    sloped = slopes.with_slopes(days, units, last_days=4, unique_days=unique_days)
    return sloped.select(*KEYS, *[F.round(f"{c}_slope4", 6).alias(f"{c}_slope4") for c in units])


def recent_slopes_repeated_days(spark, folder):
    """Single events as rows: days repeat, and ids can be NULL."""
    days = event_rows(read_events(spark, folder))
    sloped = slopes.with_slopes(days, {"platelet_avg": 0.01}, last_days=3)
    return sloped.select("event_id", F.round("platelet_avg_slope3", 6).alias("platelet_avg_slope3"))


# --- Stored tables -------------------------------------------------------------


def _versioned_tables(spark, folder, name):
    place = place_of(spark, name)
    source, tables = f"{place}/patient_days", LabelTables.under(place)
    versions.replace(read_patient_days(spark, folder), source)
    upkeep.renew_label_tables(spark, source, tables, unique_days=True)
    return source, tables


def stale_label_tables(spark, folder):
    """The six versioned tables after one of them, the JAAM label table, was made anew."""
    source, tables = _versioned_tables(spark, folder, "stale")
    upkeep.renew_labels(spark, tables, JAAM, tables.jaam_labels, unique_days=True)
    report = upkeep.stale_tables(spark, source, tables)
    counts = [
        versions.read(spark, getattr(tables, name)).agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
        for name in queries.STORED
    ]
    counted = reduce(DataFrame.unionByName, counts)
    return counted.join(report, "table_name").select(
        "table_name", "n_rows", "stale", F.array_join("because", ",").alias("because")
    )


def table_after_failed_job(spark, folder):
    """The versioned JAAM progression set after a job to replace it died among its rows."""
    _, tables = _versioned_tables(spark, folder, "failed")
    rows = versions.read(spark, tables.sic_to_dic_jaam)
    broken = F.raise_error(F.lit("the job dies here")).cast("double")
    dying = rows.withColumn("inr_avg", F.when(F.col("subject_id") % 7 == 3, broken).otherwise(F.col("inr_avg")))
    failed = False
    try:
        versions.replace(dying, tables.sic_to_dic_jaam)
    except Exception as error:
        if "the job dies here" not in str(error):
            raise
        failed = True
    return versions.read(spark, tables.sic_to_dic_jaam).withColumn("a_job_failed", F.lit(failed))


def _label_both(days):
    return labels.label_progression(days, ISTH, JAAM, unique_days=True)


def _tables_with_late_days(spark, folder, name):
    """Tables built without the days of some subjects from the 20th on, and with wrong values on others; then corrected."""
    place = place_of(spark, name)
    paths = (f"{place}/days", f"{place}/labels")
    days = cut_lineage(read_patient_days(spark, folder))
    late = (F.col("subject_id") % 5 == 1) & (F.dayofmonth("chart_date") >= 20)
    wrong = (F.col("subject_id") % 11 == 2) & (F.dayofmonth("chart_date") == 5)
    first = days.filter(~late).withColumn("platelet_avg", F.when(wrong, 1.0).otherwise(F.col("platelet_avg")))
    upkeep.start_upkeep(first, *paths, _label_both, BUCKETS)
    before = versions.state(spark, paths[1])
    upkeep.add_days(days.filter(late | wrong), *paths, _label_both, BUCKETS)
    return paths, before, versions.state(spark, paths[1])


def labels_after_new_days(spark, folder):
    """Labels kept up to date with late and corrected days: the same rows as labels of all days at once."""
    paths, _, _ = _tables_with_late_days(spark, folder, "upkeep")
    return versions.read(spark, paths[1])


def buckets_after_new_days(spark, folder):
    """Which buckets of the label table hold a late or corrected day, and which were written again."""
    _, before, after = _tables_with_late_days(spark, folder, "buckets")
    rows = [(b, after.buckets.get(b) != before.buckets.get(b)) for b in sorted({*before.buckets, *after.buckets})]
    return spark.createDataFrame(rows, "bucket int, rewritten boolean")


# --- Definitions of tomorrow -----------------------------------------------------


def sic_labels_by_date(spark, folder):
    labelled = label_days_by_date(read_patient_days(spark, folder), SIC, unique_days=True)
    return labelled.select(*KEYS, "sic_today", "sic_tomorrow", "sic_next_day", "sic_tomorrow_by_date", "sic_next_day_by_date")


def sic_labels_by_date_repeated_days(spark, folder):
    """Single events as rows; the first row of a day speaks for it."""
    labelled = label_days_by_date(event_rows(read_events(spark, folder)), SIC, ties=["event_id"])
    return labelled.select("event_id", "sic_today", "sic_tomorrow", "sic_tomorrow_by_date", "sic_next_day_by_date")


def next_day_distances(spark, folder):
    return follow_up_distances(read_patient_days(spark, folder), SIC)


# --- Uncertainty, folds, calibration ---------------------------------------------

REPLICATES = 100


def _replicates(spark, folder):
    """One row for each group and replicate, used twice by a report of differences."""
    return uncertainty.auroc_replicates(queries.scored_days(spark, folder), REPLICATES, groups=["grp"])


def fairness_replicates(spark, folder):
    return _replicates(spark, folder)


def fairness_intervals(spark, folder):
    found = uncertainty.auroc_intervals(_replicates(spark, folder), ["grp"])
    return found.withColumns({c: F.round(c, 9) for c in ("low", "high")})


def fairness_differences(spark, folder):
    found = uncertainty.auroc_differences(cut_lineage(_replicates(spark, folder)), "grp")
    return found.withColumns({c: F.round(c, 9) for c in ("difference", "low", "high")})


FOLDS = 4
FOLD_FEATURES = ["platelet_avg", "inr_avg", "average_sofa_score", "mean_heart_rate"]
CANDIDATES = {
    "logistic": partial(models.fit_logistic, maxIter=20),
    "trees": partial(models.fit_boosted_trees, maxIter=3, maxDepth=3),
}


def _fold_rows(spark, folder):
    labelled = queries.sic_merge_onepass(spark, folder)
    return models.modelling_table(labelled, SIC.onset, FOLD_FEATURES)


def out_of_fold_rows(spark, folder):
    """Rows that each candidate scored, by fold; no subject is on two sides of a fit."""
    scored = selection.out_of_fold(_fold_rows(spark, folder), FOLD_FEATURES, CANDIDATES, FOLDS)
    return scored.groupBy("candidate", "fold").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct(*KEYS).alias("n_days"),
        F.countDistinct("subject_id").alias("n_subjects"),
        F.sum("label").alias("n_pos"),
        F.count(F.when(F.col("score").between(0, 1), 1)).alias("n_scored"),
    )


def candidates_by_folds(spark, folder):
    """Out-of-fold AUROC of each candidate, best first."""
    return selection.best_candidate(selection.out_of_fold(_fold_rows(spark, folder), FOLD_FEATURES, CANDIDATES, FOLDS))


def penalty_by_folds(spark, folder):
    """Mean AUROC over folds of whole subjects, for each penalty of a logistic regression."""
    penalties = [0.0, 0.1, 10.0]
    found = selection.search_penalty(_fold_rows(spark, folder), FOLD_FEATURES, penalties, FOLDS)
    rows = list(zip(penalties, map(float, found.avgMetrics), strict=True))
    return spark.createDataFrame(rows, "penalty double, mean_auroc double")


def isotonic_rates(spark, folder):
    """The isotonic rate at each score of two digits."""
    coarse = F.floor(F.col("score") * 100) / 100
    scored = cut_lineage(queries.scored_days(spark, folder).select("label", coarse.alias("score")))
    model = recalibrate.fit_isotonic(scored, digits=2)
    counts = recalibrate.score_counts(scored, digits=2)
    fitted = recalibrate.recalibrated(model, counts)
    return fitted.select("score", "n_rows", "n_pos", F.round("calibrated", 9).alias("calibrated"))


# --- Time and gaps ---------------------------------------------------------------


def _free_of(spark, folder, criterion):
    days = labels.label_progression(read_patient_days(spark, folder), criterion, unique_days=True)
    return survival.times_to_event(days, criterion.today, start=F.col(SIC.today) == 1).withColumn(
        "criterion", F.lit(criterion.name)
    )


def time_to_dic(spark, folder):
    """Days from the first day with SIC to DIC, for each stay and both criteria."""
    return _free_of(spark, folder, ISTH).unionByName(_free_of(spark, folder, JAAM))


def free_of_dic(spark, folder):
    """The product-limit curve of both criteria."""
    curve = survival.product_limit(time_to_dic(spark, folder), ["criterion"])
    return curve.withColumns({c: F.round(c, 9) for c in ("free", "std_error")})


LABS = ("platelet_avg", "inr_avg", "pt_avg", "fibrinogen_avg")


def missing_run_lengths(spark, folder):
    return gaps.run_lengths(gaps.missing_runs(read_patient_days(spark, folder), LABS))


def missing_runs(spark, folder):
    return gaps.missing_runs(read_patient_days(spark, folder), LABS)


def days_since_known(spark, folder):
    days = gaps.with_days_since_known(read_patient_days(spark, folder), LABS)
    return days.select(*KEYS, *[f"{c}_days_since" for c in LABS])


def joint_missingness(spark, folder):
    return gaps.joint_missingness(read_patient_days(spark, folder), LABS)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        preceding_24_hours,
        preceding_24_hours_of_days,
        preceding_3_hours,
        recent_slopes,
        recent_slopes_repeated_days,
        stale_label_tables,
        table_after_failed_job,
        labels_after_new_days,
        buckets_after_new_days,
        sic_labels_by_date,
        sic_labels_by_date_repeated_days,
        next_day_distances,
        fairness_replicates,
        fairness_intervals,
        fairness_differences,
        out_of_fold_rows,
        candidates_by_folds,
        penalty_by_folds,
        isotonic_rates,
        time_to_dic,
        free_of_dic,
        missing_run_lengths,
        missing_runs,
        days_since_known,
        joint_missingness,
    )
}
