"""DuckDB SQL for the registered queries, written apart from the Spark code.

Scores are sums of truth values here rather than bands, ranking metrics come
from ranks and row windows rather than from a curve, so that an error on one
side does not repeat itself on the other.
"""

from __future__ import annotations

# --- Relations shared by the statements below --------------------------------

_PATIENT_DAY = """
events_by_day AS (
  SELECT user_id, CAST(ts AS DATE) AS chart_date, event_type AS kind,
         CAST(round(value * 100) AS BIGINT) AS c
  FROM events
),
patient_day AS (
  SELECT user_id AS subject_id,
         user_id * 10 + CASE WHEN day(chart_date) <= 15 THEN 1 ELSE 2 END AS stay_id,
         chart_date,
         CAST(sum(c) FILTER (kind <> 'error') AS DOUBLE)
           / (nullif(count(c) FILTER (kind <> 'error'), 0) * 50) AS platelet_avg,
         CAST(sum(c) FILTER (kind <> 'signup') AS DOUBLE)
           / (nullif(count(c) FILTER (kind <> 'signup'), 0) * 3000) AS inr_avg,
         CAST(sum(c) FILTER (kind <> 'view') AS DOUBLE)
           / (nullif(count(c) FILTER (kind <> 'view'), 0) * 1500) AS average_sofa_score,
         CAST(sum(c) AS DOUBLE) / (nullif(count(c), 0) * 50) AS mean_heart_rate,
         CAST(max(c) AS DOUBLE) / 400 AS mean_resp_rate,
         CAST(max(c) + 105000 AS DOUBLE) / 3000 AS max_temperature,
         CAST(max(c) FILTER (kind <> 'click') AS DOUBLE) AS wbc_avg,
         CAST(sum(c) FILTER (kind <> 'click') AS DOUBLE)
           / (nullif(count(c) FILTER (kind <> 'click'), 0) * 500) + 8 AS pt_avg,
         CAST(min(c) FILTER (kind <> 'purchase') AS DOUBLE) / 25 AS fibrinogen_avg,
         CAST(max(c) * 3 AS DOUBLE) / 5 AS d_dimer_avg
  FROM events_by_day
  GROUP BY user_id, chart_date
)"""

_SIC_DAY = """
sic_points AS (
  SELECT *,
         CAST(platelet_avg < 100 AS INTEGER) + CAST(platelet_avg < 50 AS INTEGER)
           AS platelet_score,
         CAST(inr_avg >= 1.2 AS INTEGER) + CAST(inr_avg > 1.4 AS INTEGER) AS inr_score,
         CAST(average_sofa_score >= 2 AS INTEGER) AS sofa_indicator
  FROM patient_day
),
sic_day AS (
  SELECT *, CAST(platelet_score + inr_score + sofa_indicator >= 4 AS INTEGER) AS sic_today
  FROM sic_points
)"""

_SIC_KEPT = """
sic_ahead AS (
  SELECT *, lead(sic_today) OVER stay AS sic_tomorrow
  FROM sic_day
  WINDOW stay AS (PARTITION BY subject_id, stay_id ORDER BY chart_date NULLS FIRST)
),
sic_kept AS (
  SELECT *,
         CAST(coalesce(sic_today = 0, false) AND sic_tomorrow = 1 AS INTEGER) AS sic_next_day
  FROM sic_ahead
  WHERE sic_tomorrow IS NOT NULL
)"""


def _isth_day(source: str) -> str:
    return f"""
isth_points AS (
  SELECT *,
         CAST(platelet_avg < 100 AS INTEGER) + CAST(platelet_avg < 50 AS INTEGER)
           AS dic_platelet_score,
         CAST(pt_avg - 12 >= 3 AS INTEGER) + CAST(pt_avg - 12 >= 6 AS INTEGER) AS dic_pt_score,
         CAST(fibrinogen_avg < 100 AS INTEGER) AS dic_fibrinogen_score,
         2 * CAST(d_dimer_avg >= 500 AS INTEGER) + CAST(d_dimer_avg > 5000 AS INTEGER)
           AS dic_d_dimer_score
  FROM {source}
),
isth_sum AS (
  SELECT *, dic_platelet_score + dic_pt_score + dic_fibrinogen_score + dic_d_dimer_score
              AS dic_score
  FROM isth_points
),
isth_day AS (SELECT *, CAST(dic_score >= 5 AS INTEGER) AS dic_today FROM isth_sum)"""


_ISTH_LABELS = """
isth_ahead AS (
  SELECT *, lead(dic_today) OVER stay AS dic_tomorrow
  FROM isth_day
  WINDOW stay AS (PARTITION BY subject_id, stay_id ORDER BY chart_date NULLS FIRST)
),
isth_labels AS (
  SELECT *,
         CASE WHEN dic_tomorrow IS NOT NULL
              THEN CAST(coalesce(dic_today = 0, false) AND dic_tomorrow = 1 AS INTEGER)
         END AS dic_next_day
  FROM isth_ahead
)"""


def _jaam_day(source: str) -> str:
    return f"""
jaam_points AS (
  SELECT *,
         CAST(coalesce(mean_heart_rate > 90, false) AS INTEGER) AS sirs_hr,
         CAST(coalesce(mean_resp_rate > 20, false) AS INTEGER) AS sirs_rr,
         CAST(coalesce(max_temperature NOT BETWEEN 36 AND 38, false) AS INTEGER) AS sirs_temp,
         CAST(coalesce(wbc_avg NOT BETWEEN 4000 AND 12000, false) AS INTEGER) AS sirs_wbc,
         CAST(platelet_avg < 120 AS INTEGER) + 2 * CAST(platelet_avg < 80 AS INTEGER)
           AS jaam_platelet_score,
         CAST(inr_avg >= 1.2 AS INTEGER) AS jaam_inr_score
  FROM {source}
),
jaam_signs AS (
  SELECT *, sirs_hr + sirs_rr + sirs_temp + sirs_wbc AS sirs_score FROM jaam_points
),
jaam_sum AS (
  SELECT *, sirs_score + jaam_platelet_score + jaam_inr_score AS jaam_score FROM jaam_signs
),
jaam_day AS (SELECT *, CAST(jaam_score >= 4 AS INTEGER) AS jaam_dic_today FROM jaam_sum)"""


_JAAM_LABELS = """
jaam_ahead AS (
  SELECT *, lead(jaam_dic_today) OVER stay AS jaam_dic_tomorrow
  FROM jaam_day
  WINDOW stay AS (PARTITION BY subject_id, stay_id ORDER BY chart_date NULLS FIRST)
),
jaam_labels AS (
  SELECT *,
         CASE WHEN jaam_dic_tomorrow IS NOT NULL
              THEN CAST(coalesce(jaam_dic_today = 0, false) AND jaam_dic_tomorrow = 1 AS INTEGER)
         END AS jaam_dic_progression
  FROM jaam_ahead
)"""

_SCORED = """
scored AS (
  SELECT subject_id, stay_id, chart_date, sic_next_day AS label,
         CAST(CAST(round(mean_resp_rate * 400) AS BIGINT) % 1000 AS DOUBLE) / 1000 AS score,
         CAST(subject_id % 4 AS INTEGER) AS grp
  FROM sic_kept
)"""

# The same names as _SCORED, so that the statements over it serve both.
_FINELY_SCORED = """
coarse AS (
  SELECT *, CAST(CAST(round(mean_resp_rate * 400) AS BIGINT) % 1000 AS DOUBLE) / 1000 AS r
  FROM sic_kept
),
scored AS (
  SELECT sic_next_day AS label,
         CASE subject_id % 3
           WHEN 0 THEN r * CAST('1e-13' AS DOUBLE)
           WHEN 1 THEN floor(r * 10) / 10 + (subject_id % 16) * CAST('1e-15' AS DOUBLE)
           ELSE r / 3 END AS score
  FROM coarse
)"""


def _with(*relations: str) -> str:
    return "WITH " + ",".join(relations)


_TO_SIC = (_PATIENT_DAY, _SIC_DAY, _SIC_KEPT)
_TO_ISTH = (*_TO_SIC, _isth_day("sic_kept"), _ISTH_LABELS)
_TO_JAAM = (*_TO_SIC, _jaam_day("sic_kept"), _JAAM_LABELS)
_TO_BOTH = (*_TO_ISTH, _jaam_day("isth_labels"), _JAAM_LABELS)
_TO_SCORED = (*_TO_SIC, _SCORED)
_TO_FINE = (*_TO_SIC, _FINELY_SCORED)

_SIC_LABEL_TABLE = f"""{_with(*_TO_SIC)}
SELECT * EXCLUDE (mean_heart_rate, mean_resp_rate, max_temperature, wbc_avg,
                  pt_avg, fibrinogen_avg, d_dimer_avg)
FROM sic_kept"""

_MERGED = f"{_with(*_TO_SIC)} SELECT * FROM sic_kept"

_TO_DIC_JAAM = f"""{_with(*_TO_JAAM)}
SELECT * FROM jaam_labels WHERE sic_today = 1 AND jaam_dic_progression IS NOT NULL"""

_LAG_DELTA = f"""{_with(_PATIENT_DAY)}
SELECT subject_id, stay_id, chart_date,
       lag(platelet_avg) OVER stay AS platelet_avg_lag1,
       lag(platelet_avg, 2) OVER stay AS platelet_avg_lag2,
       lag(inr_avg) OVER stay AS inr_avg_lag1,
       platelet_avg - lag(platelet_avg) OVER stay AS platelet_avg_delta,
       inr_avg - lag(inr_avg) OVER stay AS inr_avg_delta,
       average_sofa_score - lag(average_sofa_score) OVER stay AS average_sofa_score_delta
FROM patient_day
WINDOW stay AS (PARTITION BY subject_id, stay_id ORDER BY chart_date NULLS FIRST)"""


def _ranking(partition: str, key: str) -> str:
    """Pairwise wins from mid-ranks, average precision from rows at or above each score."""
    return f"""
ranked AS (
  SELECT *,
         2 * rank() OVER ({partition} ORDER BY score)
           + count(*) OVER ({partition} {"," if partition else "PARTITION BY"} score) - 1
           AS twice_midrank,
         CAST(sum(label) OVER ({partition} ORDER BY score DESC) AS DOUBLE)
           / count(*) OVER ({partition} ORDER BY score DESC) AS precision_here
  FROM scored
),
ranking AS (
  SELECT {key}
         CAST(sum(label) AS BIGINT) AS n_pos,
         CAST(sum(1 - label) AS BIGINT) AS n_neg,
         CAST(sum(CASE WHEN label = 1 THEN twice_midrank ELSE 0 END)
              - sum(label) * (sum(label) + 1) AS DOUBLE)
           / nullif(2 * CAST(sum(label) AS DOUBLE) * CAST(sum(1 - label) AS DOUBLE), 0) AS auroc,
         round(sum(CASE WHEN label = 1 THEN precision_here END) / nullif(sum(label), 0), 9)
           AS auprc
  FROM ranked {"GROUP BY ALL" if key else ""}
)"""


def _confusion(key: str) -> str:
    return f"""
called AS (
  SELECT {key}
         count(*) FILTER (label = 1 AND score >= 0.5) AS tp,
         count(*) FILTER (label = 0 AND score >= 0.5) AS fp,
         count(*) FILTER (label = 0 AND score < 0.5) AS tn,
         count(*) FILTER (label = 1 AND score < 0.5) AS fn
  FROM scored {"GROUP BY ALL" if key else ""}
),
rates AS (
  SELECT *, tp / nullif(tp + fn, 0) AS sensitivity, tn / nullif(tn + fp, 0) AS specificity,
         tp / nullif(tp + fp, 0) AS ppv, tn / nullif(tn + fn, 0) AS npv,
         2 * tp / nullif(2 * tp + fp + fn, 0) AS f1
  FROM called
)"""


def _calibration(key: str, bins: int) -> str:
    return f"""{_with(*_TO_SCORED)}
SELECT {key} CAST(least(floor(score * {bins}), {bins - 1}) AS INTEGER) AS bin,
       count(*) AS n_rows,
       count(*) FILTER (label = 1) AS n_pos,
       CAST(sum(CAST(round(score * 1e12) AS BIGINT)) AS DOUBLE) / (count(*) * 1e12) AS mean_score,
       count(*) FILTER (label = 1) / count(*) AS observed_rate
FROM scored GROUP BY ALL"""


def _yield_row(name: str, today: str, onset: str) -> str:
    return f"""
SELECT '{name}' AS criterion, count(*) AS n_days, count({today}) AS n_scored,
       count(*) FILTER ({today} = 1) AS n_positive,
       count({onset}) AS n_labelled,
       count(*) FILTER ({onset} = 1) AS n_transitions,
       count({onset}) FILTER (sic_today = 1) AS n_sic_labelled,
       count(*) FILTER (sic_today = 1 AND {onset} = 1) AS n_sic_transitions
FROM jaam_labels"""


def _table_row(name: str, source: str, onset: str, where: str = "") -> str:
    return f"""
SELECT '{name}' AS table_name, count(*) AS n_rows, count(*) FILTER ({onset} = 1) AS n_onsets
FROM {source} {where}"""


# Columns of a patient-day table.
_MEASURED = (
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

# A value that meets no threshold, in the place of NaN.
_NEUTRAL = {
    "platelet_avg": 1e9,
    "inr_avg": 0,
    "average_sofa_score": 0,
    "mean_heart_rate": 0,
    "mean_resp_rate": 0,
    "max_temperature": 37,
    "wbc_avg": 8000,
    "pt_avg": 0,
    "fibrinogen_avg": 1e9,
    "d_dimer_avg": 0,
}


def _sparse_day() -> str:
    """Patient-days with holes; the plain relation moves aside so that score statements read these."""
    columns = ", ".join(
        f"""CASE (subject_id + day(chart_date) + {i}) % 7 WHEN 0 THEN NULL
            WHEN 1 THEN {_NEUTRAL[c]} ELSE {c} END AS {c}"""
        for i, c in enumerate(_MEASURED)
    )
    whole = _PATIENT_DAY.replace("patient_day AS", "whole_day AS")
    return f"{whole}, patient_day AS (SELECT subject_id, stay_id, chart_date, {columns} FROM whole_day)"


_EVENT_ROWS = """
event_rows AS (
  SELECT CASE WHEN event_id % 50 <> 0 THEN user_id END AS subject_id,
         CASE WHEN event_id % 50 <> 0 THEN user_id * 10 + 1 END AS stay_id,
         CAST(ts AS DATE) AS chart_date, event_id,
         CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) / 50 AS platelet_avg,
         CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) / 3000 AS inr_avg,
         CAST(CAST(round(value * 100) AS BIGINT) AS DOUBLE) / 1500 AS average_sofa_score
  FROM events
)"""


def _key_counts(source: str) -> str:
    return f"""
SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS n_rows,
       CAST(coalesce(sum(n) FILTER (incomplete), 0) AS BIGINT) AS n_null_key_rows,
       count(*) FILTER (n > 1) AS n_repeated_keys,
       CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS n_repeated_key_rows,
       coalesce(max(n), 0) AS n_largest_key_rows
FROM (SELECT subject_id IS NULL OR stay_id IS NULL OR chart_date IS NULL AS incomplete, count(*) AS n
      FROM {source} GROUP BY subject_id, stay_id, chart_date)"""


_SPLIT = """CASE WHEN CAST('0x' || left(md5(CAST(subject_id AS VARCHAR)), 8) AS BIGINT) % 100 >= 85
  THEN 'test' WHEN CAST('0x' || left(md5(CAST(subject_id AS VARCHAR)), 8) AS BIGINT) % 100 >= 70
  THEN 'validation' ELSE 'train' END"""

_ONE_FLAG = """
flagged AS (
  SELECT CAST(coalesce(platelet_avg < 100, false) AS INTEGER) AS low, count(*) AS n_rows,
         avg(sic_next_day) AS rate
  FROM sic_kept GROUP BY ALL
)"""


def _group_counts(task: str, model: str, source: str, onset: str) -> str:
    return f"""
SELECT '{task}' AS task, '{model}' AS model, {_SPLIT} AS split, CAST(subject_id % 4 AS INTEGER) AS grp,
       count(*) FILTER ({onset} = 1) AS n_pos, count(*) FILTER ({onset} = 0) AS n_neg
FROM {source} WHERE {_SPLIT} <> 'train' GROUP BY ALL"""


def _missing_row(column: str) -> str:
    return f"""
SELECT '{column}' AS column_name, count(*) AS n_rows,
       count(*) FILTER ({column} IS NULL) AS n_missing,
       count(*) FILTER ({column} IS NULL) / nullif(count(*), 0) AS missing_rate
FROM patient_day"""


ORACLES: dict[str, str] = {
    "patient_day": f"{_with(_PATIENT_DAY)} SELECT * FROM patient_day",
    "daily_measurements": """
WITH long AS (
  SELECT user_id AS subject_id, CAST(ts AS DATE) AS chart_date, event_type AS item,
         CAST(round(value * 100) AS BIGINT) AS value
  FROM events
)
SELECT subject_id,
       subject_id * 10 + CASE WHEN day(chart_date) <= 15 THEN 1 ELSE 2 END AS stay_id,
       chart_date,
       count(value) AS n_values,
       avg(value) FILTER (item = 'view') AS view_avg,
       min(value) FILTER (item = 'purchase') AS purchase_min,
       max(value) FILTER (item = 'purchase') AS purchase_max,
       avg(value) FILTER (item NOT IN ('view', 'purchase')) AS other_avg
FROM long GROUP BY subject_id, chart_date""",
    "lag_delta": _LAG_DELTA,
    "lag_delta_big_stays": _LAG_DELTA,
    "cohort": f"""{_with(_PATIENT_DAY)},
numbered AS (
  SELECT user_id, TRY_CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS age,
         row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n
  FROM events
)
SELECT subject_id, stay_id, chart_date, age, platelet_avg, inr_avg, average_sofa_score
FROM patient_day JOIN numbered ON user_id = subject_id
WHERE n = 1 AND age >= 18
  AND subject_id IN (SELECT user_id FROM events WHERE event_type = 'error' AND value > 100)""",
    "patient_split": f"""{_with(_PATIENT_DAY)},
bucketed AS (
  SELECT subject_id, stay_id, chart_date,
         CAST(CAST('0x' || left(md5(CAST(subject_id AS VARCHAR)), 8) AS BIGINT) % 100 AS INTEGER)
           AS bucket
  FROM patient_day
)
SELECT *, CASE WHEN bucket >= 85 THEN 'test' WHEN bucket >= 70 THEN 'validation' ELSE 'train' END
            AS split
FROM bucketed""",
    "sic_scores": f"""{_with(_PATIENT_DAY, _SIC_DAY)}
SELECT subject_id, stay_id, chart_date, platelet_score, inr_score, sofa_indicator, sic_today
FROM sic_day""",
    "sic_labels": _SIC_LABEL_TABLE,
    "sic_labels_big_stays": _SIC_LABEL_TABLE,
    "sic_merge_join": _MERGED,
    "sic_merge_onepass": _MERGED,
    "isth_scores": f"""{_with(_PATIENT_DAY, _isth_day("patient_day"))}
SELECT subject_id, stay_id, chart_date, dic_platelet_score, dic_pt_score, dic_fibrinogen_score,
       dic_d_dimer_score, dic_score, dic_today
FROM isth_day""",
    "isth_dic_labels": f"{_with(*_TO_ISTH)} SELECT * FROM isth_labels",
    "sic_to_dic_isth": f"""{_with(*_TO_ISTH)}
SELECT * FROM isth_labels WHERE sic_today = 1 AND dic_next_day IS NOT NULL""",
    "sirs_scores": f"""{_with(_PATIENT_DAY, _jaam_day("patient_day"))}
SELECT subject_id, stay_id, chart_date, sirs_hr, sirs_rr, sirs_temp, sirs_wbc, sirs_score
FROM jaam_day""",
    "jaam_scores": f"""{_with(_PATIENT_DAY, _jaam_day("patient_day"))}
SELECT subject_id, stay_id, chart_date, sirs_hr, sirs_rr, sirs_temp, sirs_wbc, sirs_score,
       jaam_platelet_score, jaam_inr_score, jaam_score, jaam_dic_today
FROM jaam_day""",
    "jaam_dic_labels": f"{_with(*_TO_JAAM)} SELECT * FROM jaam_labels",
    "sic_to_dic_jaam": _TO_DIC_JAAM,
    "sic_to_dic_jaam_big_stays": _TO_DIC_JAAM,
    "dic_labels_both": f"{_with(*_TO_BOTH)} SELECT * FROM jaam_labels",
    "label_tables": _with(*_TO_BOTH)
    + " UNION ALL ".join(
        (
            _table_row("sic_labels", "sic_kept", "sic_next_day"),
            _table_row("days_with_follow_up", "sic_kept", "sic_next_day"),
            _table_row("isth_labels", "isth_labels", "dic_next_day"),
            _table_row(
                "sic_to_dic_isth",
                "isth_labels",
                "dic_next_day",
                "WHERE sic_today = 1 AND dic_next_day IS NOT NULL",
            ),
            _table_row("jaam_labels", "jaam_labels", "jaam_dic_progression"),
            _table_row(
                "sic_to_dic_jaam",
                "jaam_labels",
                "jaam_dic_progression",
                "WHERE sic_today = 1 AND jaam_dic_progression IS NOT NULL",
            ),
        )
    ),
    "key_check": f"""{_with(_EVENT_ROWS)} {_key_counts("event_rows")}""",
    "key_check_days": f"""{_with(_PATIENT_DAY)} {_key_counts("patient_day")}""",
    "label_yield": _with(*_TO_BOTH)
    + _yield_row("isth", "dic_today", "dic_next_day")
    + " UNION ALL "
    + _yield_row("jaam", "jaam_dic_today", "jaam_dic_progression"),
    "criteria_crosstab": f"""{_with(*_TO_BOTH)}
SELECT dic_today, jaam_dic_today, count(*) AS n_days FROM jaam_labels GROUP BY ALL""",
    "missingness": _with(_PATIENT_DAY) + " UNION ALL ".join(_missing_row(c) for c in _MEASURED),
    "auroc": f"""{_with(*_TO_SCORED, _ranking("", ""))}
SELECT n_pos, n_neg, auroc FROM ranking""",
    "auprc": f"""{_with(*_TO_SCORED, _ranking("", ""))}
SELECT n_pos, n_neg, auprc FROM ranking""",
    "auroc_fine_scores": f"""{_with(*_TO_FINE, _ranking("", ""))}
SELECT n_pos, n_neg, auroc FROM ranking""",
    "auprc_fine_scores": f"""{_with(*_TO_FINE, _ranking("", ""))}
SELECT n_pos, n_neg, auprc FROM ranking""",
    "confusion": f"{_with(*_TO_SCORED, _confusion(''))} SELECT * FROM rates",
    "calibration": _calibration("", 10),
    "fairness": f"""{_with(*_TO_SCORED, _ranking("PARTITION BY grp", "grp,"), _confusion("grp,"))}
SELECT * FROM ranking JOIN rates USING (grp)""",
    "fairness_calibration": _calibration("grp,", 5),
    "sic_labels_repeated_days": f"""{_with(
        _EVENT_ROWS,
        "patient_day AS (SELECT * FROM event_rows)",
        _SIC_DAY,
        _SIC_KEPT.replace(
            "chart_date NULLS FIRST", "chart_date NULLS FIRST, md5('{\"event_id\":' || event_id || '}')"
        ),
    )}
SELECT * FROM sic_kept""",
    "daily_measurements_from_seven": """
WITH long AS (
  SELECT user_id AS subject_id, user_id * 10 + CASE WHEN day(CAST(ts AS DATE)) <= 15 THEN 1 ELSE 2 END AS stay_id,
         CAST(ts - INTERVAL 7 HOUR AS DATE) AS chart_date, CAST(round(value * 100) AS BIGINT) AS value
  FROM events
)
SELECT subject_id, stay_id, chart_date, count(value) AS n_values, min(value) AS value_min,
       CAST(sum(value) AS BIGINT) AS value_sum
FROM long GROUP BY ALL""",
    "sic_scores_sparse": f"""{_with(_sparse_day(), _SIC_DAY)}
SELECT subject_id, stay_id, chart_date, platelet_score, inr_score, sofa_indicator, sic_today
FROM sic_day""",
    "isth_scores_sparse": f"""{_with(_sparse_day(), _isth_day("patient_day"))}
SELECT subject_id, stay_id, chart_date, dic_platelet_score, dic_pt_score, dic_fibrinogen_score,
       dic_d_dimer_score, dic_score, dic_today
FROM isth_day""",
    "jaam_scores_sparse": f"""{_with(_sparse_day(), _jaam_day("patient_day"))}
SELECT subject_id, stay_id, chart_date, sirs_hr, sirs_rr, sirs_temp, sirs_wbc, sirs_score,
       jaam_platelet_score, jaam_inr_score, jaam_score, jaam_dic_today
FROM jaam_day""",
    "stored_sic_labels": _SIC_LABEL_TABLE,
    "stored_days_with_follow_up": _MERGED,
    "stored_isth_labels": f"{_with(*_TO_ISTH)} SELECT * FROM isth_labels",
    "stored_sic_to_dic_isth": f"""{_with(*_TO_ISTH)}
SELECT * FROM isth_labels WHERE sic_today = 1 AND dic_next_day IS NOT NULL""",
    "stored_jaam_labels": f"{_with(*_TO_JAAM)} SELECT * FROM jaam_labels",
    "stored_sic_to_dic_jaam": _TO_DIC_JAAM,
    "stored_create_if_absent": _TO_DIC_JAAM,
    "stored_sort": f"""{_with(*_TO_SIC)}
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_out_of_order FROM sic_kept""",
    "model_rows": f"""{_with(*_TO_SIC)}
SELECT subject_id, stay_id, chart_date, sic_next_day AS label, {_SPLIT} AS split, true AS scored
FROM sic_kept WHERE {_SPLIT} <> 'train'""",
    "model_group_counts": f"{_with(*_TO_JAAM)},"
    + """
progression AS (
  SELECT * FROM jaam_labels WHERE sic_today = 1 AND jaam_dic_progression IS NOT NULL
)"""
    + " UNION ALL ".join(
        _group_counts(task, model, source, onset)
        for task, source, onset in (
            ("sic", "sic_kept", "sic_next_day"),
            ("dic", "progression", "jaam_dic_progression"),
        )
        for model in ("logistic", "trees")
    ),
    "logistic_one_flag": f"""{_with(*_TO_SIC, _ONE_FLAG)}
SELECT low, n_rows, round(rate, 6) AS lowest, round(rate, 6) AS highest, true AS converged FROM flagged""",
    "trees_one_flag": f"""{_with(*_TO_SIC, _ONE_FLAG)}
SELECT low, n_rows, round(1 / (1 + exp(-2 * (2 * rate - 1))), 6) AS lowest,
       round(1 / (1 + exp(-2 * (2 * rate - 1))), 6) AS highest
FROM flagged""",
    "importance_one_flag": f"""{_with(*_TO_SIC, _ONE_FLAG)}
SELECT 'low' AS feature, 1.0::DOUBLE AS importance, NULL::DOUBLE AS loss_of_same, count(*) = 2 AS matters
FROM flagged
UNION ALL
SELECT DISTINCT 'same', 0.0::DOUBLE, 0.0::DOUBLE, false FROM flagged""",
}
