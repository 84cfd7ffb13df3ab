"""Every registered query: ``name -> function(spark, folder) -> DataFrame``.

All of them start from the patient-days derived from the whole ``events``
table. That table is grouped by its keys, so days are unique and a stay is
bounded by the calendar (``unique_days=True``). The ``*_big_stays`` queries
make no use of that: they go the way that holds for stays of any size.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.functions.criteria import ISTH, JAAM, SIC, sirs
from daymark.functions.keys import KEYS
from daymark.functions.scoring import score_days
from daymark.operators import evaluate, features, labels, models, reports
from daymark.operators.checks import key_report
from daymark.plans.tables import LabelTables, build_label_tables
from daymark.session import cut_lineage, shared_folder
from daymark.sources.events import (
    event_rows,
    measurements,
    patients,
    read_events,
    read_patient_days,
    sparse,
)
from daymark.sources.tables import read_table, write_table

Query = Callable[[SparkSession, str], DataFrame]

# Columns of a patient-day table.
MEASURED = (
    "platelet_avg",
    "inr_avg",
    "average_sofa_score",
    "mean_heart_rate",
    "mean_resp_rate",
    "max_temperature",
    "wbc_avg",
    "pt_avg",
    "fibrinogen_avg",
    "d_dimer_avg",
)
TRENDS = {
    "lags": {"platelet_avg": [1, 2], "inr_avg": [1]},
    "deltas": ["platelet_avg", "inr_avg", "average_sofa_score"],
}
TREND_COLUMNS = [
    "platelet_avg_lag1",
    "platelet_avg_lag2",
    "inr_avg_lag1",
    "platelet_avg_delta",
    "inr_avg_delta",
    "average_sofa_score_delta",
]


# --- Patient-days and features -----------------------------------------------


def patient_day(spark, folder):
    return read_patient_days(spark, folder)


def daily_measurements(spark, folder):
    M = features.Measure
    return features.daily_values(
        measurements(read_events(spark, folder)),
        [
            M("n_values", "count"),
            M("view_avg", "avg", items=("view",)),
            M("purchase_min", "min", items=("purchase",)),
            M("purchase_max", "max", items=("purchase",)),
            M("other_avg", "avg", excluding=("view", "purchase")),
        ],
    )


def daily_measurements_from_seven(spark, folder):
    """Days from seven in the morning on."""
    M = features.Measure
    return features.daily_values(
        measurements(read_events(spark, folder)),
        [M("n_values", "count"), M("value_min", "min"), M("value_sum", "sum")],
        day_starts_at=7,
    )


def lag_delta(spark, folder, unique_days=True):
    days = read_patient_days(spark, folder)
    days = features.with_trends(days, **TRENDS, unique_days=unique_days)
    return days.select(*KEYS, *TREND_COLUMNS)


def lag_delta_big_stays(spark, folder):
    return lag_delta(spark, folder, unique_days=False)


def cohort(spark, folder):
    events = read_events(spark, folder)
    suspected = events.filter((F.col("event_type") == "error") & (F.col("value") > 100))
    infections = suspected.select(F.col("user_id").alias("subject_id"))
    chosen = features.cohort(read_patient_days(spark, folder), patients(events), infections)
    return chosen.select(*KEYS, "age", "platelet_avg", "inr_avg", "average_sofa_score")


def patient_split(spark, folder):
    days = read_patient_days(spark, folder)
    bucket = features.split_bucket().alias("bucket")
    return features.with_split(days).select(*KEYS, bucket, "split")


# --- SIC ---------------------------------------------------------------------


def sic_scores(spark, folder):
    scored = score_days(read_patient_days(spark, folder), SIC)
    return scored.select(*KEYS, *SIC.day_columns)


def _sparse_scores(spark, folder, criterion, columns):
    days = sparse(read_patient_days(spark, folder), MEASURED)
    return score_days(days, criterion).select(*KEYS, *columns)


def sic_scores_sparse(spark, folder):
    return _sparse_scores(spark, folder, SIC, SIC.day_columns)


def isth_scores_sparse(spark, folder):
    return _sparse_scores(spark, folder, ISTH, ISTH.day_columns)


def jaam_scores_sparse(spark, folder):
    return _sparse_scores(spark, folder, JAAM, JAAM.day_columns)


def sic_labels(spark, folder):
    return labels.sic_labels(read_patient_days(spark, folder), unique_days=True)


def sic_labels_big_stays(spark, folder):
    return labels.sic_labels(read_patient_days(spark, folder))


def sic_labels_repeated_days(spark, folder):
    """Single events as rows: days repeat, and their order in a day is that of the hash of their id."""
    days = event_rows(read_events(spark, folder))
    return labels.with_sic_labels(days, ties=["event_id"])


def sic_merge_join(spark, folder):
    days = read_patient_days(spark, folder)
    return labels.merge_by_join(days, labels.sic_labels(days, unique_days=True))


def sic_merge_onepass(spark, folder):
    return labels.merge_in_one_pass(read_patient_days(spark, folder), unique_days=True)


# --- SIC to DIC --------------------------------------------------------------


def isth_scores(spark, folder):
    scored = score_days(read_patient_days(spark, folder), ISTH)
    return scored.select(*KEYS, *ISTH.day_columns)


def isth_dic_labels(spark, folder):
    return labels.label_progression(read_patient_days(spark, folder), ISTH, unique_days=True)


def sic_to_dic_isth(spark, folder):
    return labels.sic_to_dic(read_patient_days(spark, folder), ISTH, unique_days=True)


def sirs_scores(spark, folder):
    scored = score_days(read_patient_days(spark, folder), JAAM)
    return scored.select(*KEYS, *[s.name for s in sirs()], "sirs_score")


def jaam_scores(spark, folder):
    scored = score_days(read_patient_days(spark, folder), JAAM)
    return scored.select(*KEYS, *JAAM.day_columns)


def jaam_dic_labels(spark, folder):
    return labels.label_progression(read_patient_days(spark, folder), JAAM, unique_days=True)


def sic_to_dic_jaam(spark, folder):
    return labels.sic_to_dic(read_patient_days(spark, folder), JAAM, unique_days=True)


def sic_to_dic_jaam_big_stays(spark, folder):
    return labels.sic_to_dic(read_patient_days(spark, folder), JAAM)


def dic_labels_both(spark, folder):
    return labels.label_progression(read_patient_days(spark, folder), ISTH, JAAM, unique_days=True)


def _stored_tables(spark, folder, name, **options):
    """The six tables, built from stored patient-days in a place of this query's own."""
    place = f"{shared_folder(spark)}/{name}"
    write_table(read_patient_days(spark, folder), f"{place}/patient_days")
    tables = LabelTables.under(place)
    build_label_tables(spark, f"{place}/patient_days", tables, unique_days=True, **options)
    return tables


STORED = {
    "sic_labels": SIC,
    "days_with_follow_up": SIC,
    "isth_labels": ISTH,
    "sic_to_dic_isth": ISTH,
    "jaam_labels": JAAM,
    "sic_to_dic_jaam": JAAM,
}


def label_tables(spark, folder):
    """All six stored tables: rows and onsets of each."""
    tables = _stored_tables(spark, folder, "label_tables")
    counts = [
        read_table(spark, getattr(tables, name)).agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count(F.when(F.col(criterion.onset) == 1, 1)).alias("n_onsets"),
        )
        for name, criterion in STORED.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _stored_table(name: str) -> Query:
    def query(spark, folder):
        return read_table(spark, getattr(_stored_tables(spark, folder, f"stored_{name}"), name))

    query.__name__ = f"stored_{name}"
    query.__doc__ = f"The rows of the stored table {name}."
    return query


STORED_TABLES = [_stored_table(name) for name in STORED]


def stored_create_if_absent(spark, folder):
    """The last table after a second run, over fewer days, that creates it only if it is absent."""
    tables = _stored_tables(spark, folder, "stored_create_if_absent")
    fewer = read_patient_days(spark, folder).filter(F.col("subject_id") % 2 == 0)
    source = f"{shared_folder(spark)}/stored_create_if_absent/fewer_days"
    write_table(fewer, source)
    build_label_tables(spark, source, tables, unique_days=True, last_mode="ignore")
    return read_table(spark, tables.sic_to_dic_jaam)


def stored_sort(spark, folder):
    """Rows of the stored SIC label table that stand before a smaller (stay, day) in their file."""
    rows = read_table(spark, _stored_tables(spark, folder, "stored_sort").sic_labels)
    place = F.struct("stay_id", "chart_date")
    # A file of the table is what one task wrote.
    in_file = Window.partitionBy("_file").orderBy("_row")
    placed = rows.select(
        place.alias("_place"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    behind = placed.select((F.lag("_place").over(in_file) > F.col("_place")).alias("_wrong"))
    return behind.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(F.when(F.col("_wrong"), 1)).alias("n_out_of_order")
    )


# --- Checks and reports ------------------------------------------------------


def key_check(spark, folder):
    """Single events as rows: days repeat, and a fiftieth of the rows have NULL ids."""
    return key_report(event_rows(read_events(spark, folder)))


def key_check_days(spark, folder):
    return key_report(read_patient_days(spark, folder))


def label_yield(spark, folder):
    return reports.label_yield(dic_labels_both(spark, folder))


def criteria_crosstab(spark, folder):
    return reports.criteria_crosstab(dic_labels_both(spark, folder))


def missingness(spark, folder):
    return reports.missingness(read_patient_days(spark, folder), MEASURED)


# --- Evaluation --------------------------------------------------------------


def scored_days(spark, folder):
    """SIC-labelled days with a deterministic stand-in for a predicted probability."""
    cents = F.round(F.col("mean_resp_rate") * 400).cast("long")
    return sic_merge_onepass(spark, folder).select(
        *KEYS,
        F.col("sic_next_day").alias("label"),
        (F.pmod(cents, F.lit(1000)).cast("double") / 1000).alias("score"),
        (F.col("subject_id") % 4).cast("int").alias("grp"),
    )


def auroc(spark, folder):
    return evaluate.auroc(scored_days(spark, folder))


def _rounded(metrics: DataFrame) -> DataFrame:
    """AUPRC is a sum of fractions; the order of summation shows in its last digits."""
    return metrics.withColumn("auprc", F.round("auprc", 9))


def auprc(spark, folder):
    return _rounded(evaluate.auprc(scored_days(spark, folder)))


def finely_scored_days(spark, folder):
    """Scores that need every bit: below 1e-12, closer than 1e-12 to each other, or endless fractions."""
    score, subject = F.col("score"), F.col("subject_id")
    fine = (
        F.when(subject % 3 == 0, score * 1e-13)
        .when(subject % 3 == 1, F.floor(score * 10) / 10 + (subject % 16) * 1e-15)
        .otherwise(score / 3)
    )
    return scored_days(spark, folder).withColumn("score", fine)


def auroc_fine_scores(spark, folder):
    return evaluate.auroc(finely_scored_days(spark, folder))


def auprc_fine_scores(spark, folder):
    return _rounded(evaluate.auprc(finely_scored_days(spark, folder)))


def confusion(spark, folder):
    return evaluate.confusion(scored_days(spark, folder), threshold=0.5)


def calibration(spark, folder):
    return evaluate.calibration(scored_days(spark, folder))


def fairness(spark, folder):
    return _rounded(evaluate.summary(scored_days(spark, folder), threshold=0.5, groups=["grp"]))


def fairness_calibration(spark, folder):
    return evaluate.calibration(scored_days(spark, folder), bins=5, groups=["grp"])


# --- Models ------------------------------------------------------------------

MODEL_FEATURES = [*MEASURED, *TREND_COLUMNS]


def _days_with_trends(spark, folder):
    return features.with_trends(read_patient_days(spark, folder), **TRENDS, unique_days=True)


def _split(labelled, onset):
    """The modelling rows with their split: train, validation or test."""
    return features.with_split(models.modelling_table(labelled, onset, MODEL_FEATURES))


def _part(rows, name):
    return rows.filter(F.col("split") == name).drop("split")


def _sic_onset_rows(spark, folder):
    """Next-day SIC: trends and labels come from one exchange and one sort."""
    labelled = labels.merge_in_one_pass(_days_with_trends(spark, folder), unique_days=True)
    return _split(labelled, SIC.onset)


def _dic_progression_rows(spark, folder):
    """Next-day DIC among the days with SIC."""
    days = _days_with_trends(spark, folder)
    return _split(labels.sic_to_dic(days, JAAM, unique_days=True), JAAM.onset)


TASKS = {"sic": _sic_onset_rows, "dic": _dic_progression_rows}
FITS = {"logistic": models.fit_logistic, "trees": models.fit_boosted_trees}


def _predicted(rows, fit):
    """All rows outside of the training split, scored by a model of the training split."""
    model = fit(_part(rows, "train"), MODEL_FEATURES)
    return models.predict(model, rows.filter(F.col("split") != "train"))


def logistic(spark, folder):
    return _predicted(_sic_onset_rows(spark, folder), models.fit_logistic)


def gbt(spark, folder):
    return _predicted(_sic_onset_rows(spark, folder), models.fit_boosted_trees)


def gbt_dic_progression(spark, folder):
    return _predicted(_dic_progression_rows(spark, folder), models.fit_boosted_trees)


def model_rows(spark, folder):
    """The rows that models are judged on: every one of them has a probability."""
    scored = logistic(spark, folder)
    known = F.col("score").between(0, 1)
    return scored.select(*KEYS, "label", "split", known.alias("scored"))


def _model_scores(spark, folder):
    """Predictions of both models for both tasks, with a group of subjects for each row.

    The fits run side by side: each is a chain of short jobs that leaves most cores idle.
    """

    def scores(task, rows, name):
        return _predicted(rows, FITS[name]).select(
            F.lit(task).alias("task"),
            F.lit(name).alias("model"),
            "split",
            (F.col("subject_id") % 4).cast("int").alias("grp"),
            "label",
            "score",
        )

    with ThreadPoolExecutor(len(TASKS) * len(FITS)) as pool:

        def at_once(function, arguments):
            task = inheritable_thread_target(spark)(function)
            return list(pool.map(lambda given: task(*given), arguments))

        tables = at_once(lambda name: TASKS[name](spark, folder), [(name,) for name in TASKS])
        rows = dict(zip(TASKS, tables, strict=True))
        parts = at_once(scores, [(task, rows[task], name) for task in TASKS for name in FITS])
    return cut_lineage(reduce(DataFrame.unionByName, parts))


def model_evaluation(spark, folder):
    """For each task the model with the better AUROC on the validation split, judged on the test split."""
    scores = _model_scores(spark, folder)
    validation = scores.filter("split = 'validation'")
    by_model = evaluate.auroc(validation, groups=["task", "model"])
    # One row for each task and model.
    best = by_model.groupBy("task").agg(F.max_by("model", F.struct("auroc", "model")).alias("model"))
    chosen = scores.filter("split = 'test'").join(F.broadcast(best), ["task", "model"])
    return evaluate.summary(chosen, threshold=0.2, groups=["task", "model"])


def model_calibration(spark, folder):
    """Predicted against observed rates on the test split, for each task and model."""
    test = _model_scores(spark, folder).filter("split = 'test'")
    return evaluate.calibration(test, bins=5, groups=["task", "model"])


def model_fairness(spark, folder):
    """Every metric on the test split, for each task, model and group of subjects."""
    test = _model_scores(spark, folder).filter("split = 'test'")
    return evaluate.summary(test, threshold=0.2, groups=["task", "model", "grp"])


def model_group_counts(spark, folder):
    """Positives and negatives that the ranking metrics of each task, model, split and group count."""
    keys = ["task", "model", "split", "grp"]
    return evaluate.summary(_model_scores(spark, folder), groups=keys).select(*keys, "n_pos", "n_neg")


def _one_flag_rows(spark, folder):
    """One feature that is 0 or 1, and one that is the same in all rows."""
    days = sic_merge_onepass(spark, folder).select(
        *KEYS,
        F.col(SIC.onset).alias("label"),
        F.coalesce((F.col("platelet_avg") < 100).cast("double"), F.lit(0.0)).alias("low"),
        F.lit(1.0).alias("same"),
    )
    return cut_lineage(days)


def _scores_by_flag(model, rows):
    scored = models.predict(model, rows).join(rows.select(*KEYS, "low"), KEYS)
    return scored.groupBy(F.col("low").cast("int").alias("low")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.min("score"), 6).alias("lowest"),
        F.round(F.max("score"), 6).alias("highest"),
    )


def logistic_one_flag(spark, folder):
    """Without penalty, a logistic regression on one flag predicts the rate of each value."""
    rows = _one_flag_rows(spark, folder)
    model = models.fit_logistic(rows, ["low"], tol=1e-12)
    return _scores_by_flag(model, rows).withColumn("converged", F.lit(models.converged(model)))


def trees_one_flag(spark, folder):
    """One boosting round of depth one on a flag has a closed form, too."""
    rows = _one_flag_rows(spark, folder)
    return _scores_by_flag(models.fit_boosted_trees(rows, ["low"], maxIter=1, maxDepth=1), rows)


def importance_one_flag(spark, folder):
    """All importance falls on the flag, none on the feature that is the same everywhere."""
    rows = _one_flag_rows(spark, folder)
    names = ["low", "same"]
    trees = models.fit_boosted_trees(rows, names, maxIter=2, maxDepth=1)
    inside = models.tree_importance(trees, names, spark)
    loss = models.permutation_importance(trees, rows, names)
    return inside.join(loss, "feature").select(
        "feature",
        F.round("importance", 6).alias("importance"),
        F.when(F.col("feature") == "same", F.round("auroc_loss", 6)).alias("loss_of_same"),
        (F.col("auroc_loss") > 0).alias("matters"),
    )


def tree_importance(spark, folder):
    train = _part(_sic_onset_rows(spark, folder), "train")
    trees = models.fit_boosted_trees(train, MODEL_FEATURES)
    return models.tree_importance(trees, MODEL_FEATURES, spark)


def permutation_importance(spark, folder):
    rows = _sic_onset_rows(spark, folder)
    model = models.fit_logistic(_part(rows, "train"), MODEL_FEATURES)
    return models.permutation_importance(model, _part(rows, "test"), MODEL_FEATURES)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        patient_day,
        daily_measurements,
        daily_measurements_from_seven,
        lag_delta,
        lag_delta_big_stays,
        cohort,
        patient_split,
        sic_scores,
        sic_scores_sparse,
        isth_scores_sparse,
        jaam_scores_sparse,
        sic_labels,
        sic_labels_big_stays,
        sic_labels_repeated_days,
        sic_merge_join,
        sic_merge_onepass,
        isth_scores,
        isth_dic_labels,
        sic_to_dic_isth,
        sirs_scores,
        jaam_scores,
        jaam_dic_labels,
        sic_to_dic_jaam,
        sic_to_dic_jaam_big_stays,
        dic_labels_both,
        label_tables,
        *STORED_TABLES,
        stored_create_if_absent,
        stored_sort,
        key_check,
        key_check_days,
        label_yield,
        criteria_crosstab,
        missingness,
        auroc,
        auprc,
        auroc_fine_scores,
        auprc_fine_scores,
        confusion,
        calibration,
        fairness,
        fairness_calibration,
        logistic,
        gbt,
        gbt_dic_progression,
        model_rows,
        model_evaluation,
        model_calibration,
        model_fairness,
        model_group_counts,
        logistic_one_flag,
        trees_one_flag,
        importance_one_flag,
        tree_importance,
        permutation_importance,
    )
}
