"""DuckDB SQL for the queries of ``study.py``: range joins, cross-checks by definition, and closed forms."""

from __future__ import annotations

import math

from daymark.plans.oracles import (
    _EVENT_ROWS,
    _PATIENT_DAY,
    _SIC_DAY,
    _TO_BOTH,
    _TO_DIC_JAAM,
    _TO_SCORED,
    _TO_SIC,
    ORACLES as LABEL_ORACLES,
    _with,
)

_LONG = """
long AS (
  SELECT user_id AS subject_id,
         user_id * 10 + CASE WHEN day(CAST(ts AS DATE)) <= 15 THEN 1 ELSE 2 END AS stay_id,
         ts AS charttime, event_type AS item, CAST(round(value * 100) AS BIGINT) AS value
  FROM events
)"""


def _before(anchors: str, hours: int, extra: str = "") -> str:
    """Every anchor with every measurement of its window."""
    return f"""{_with(_LONG, _PATIENT_DAY, anchors)},
numbered AS (SELECT *, row_number() OVER () AS n FROM anchors)
SELECT a.subject_id, a.stay_id, {extra} strftime(a.at, '%Y-%m-%d %H:%M:%S.%f') AS at,
       count(m.value) AS n_values, avg(m.value) AS value_avg, CAST(sum(m.value) AS BIGINT) AS value_sum,
       min(m.value) FILTER (m.item = 'view') AS view_min,
       max(m.value) FILTER (m.item NOT IN ('view', 'click')) AS other_max,
       count(m.value) FILTER (m.item = 'click') AS n_clicks
FROM numbered a LEFT JOIN long m ON m.subject_id = a.subject_id AND m.stay_id = a.stay_id
  AND m.charttime >= a.at - INTERVAL {hours} HOUR AND m.charttime < a.at
GROUP BY a.n, a.subject_id, a.stay_id, {extra} a.at"""


def _moments(item: str) -> str:
    return f"anchors AS (SELECT subject_id, stay_id, charttime AS at FROM long WHERE item = '{item}')"


_DAY_ANCHORS = """
anchors AS (
  SELECT subject_id, stay_id, hour, CAST(chart_date AS TIMESTAMP) + hour * INTERVAL 1 HOUR AS at
  FROM patient_day, (VALUES (6), (24)) AS h(hour)
)"""

_SLOPE = """nullif(round(regr_slope(
  CAST(round(p.{0} / 0.01) AS BIGINT) * 0.01::DOUBLE, p.chart_date - d.chart_date), 6), 'nan'::DOUBLE)"""

_AHEAD_BY_DATE = """
by_date AS (
  SELECT d.*, n.sic_today AS sic_tomorrow_by_date,
         lead(d.sic_today) OVER stay AS sic_tomorrow,
         lead(d.chart_date) OVER stay - d.chart_date AS distance
  FROM sic_day d LEFT JOIN sic_day n ON n.subject_id = d.subject_id AND n.stay_id = d.stay_id
    AND n.chart_date = d.chart_date + 1
  WINDOW stay AS (PARTITION BY d.subject_id, d.stay_id ORDER BY d.chart_date)
),
both_ways AS (
  SELECT *, CASE WHEN sic_tomorrow IS NOT NULL
              THEN CAST(coalesce(sic_today = 0, false) AND sic_tomorrow = 1 AS INTEGER) END AS sic_next_day,
         CASE WHEN sic_tomorrow_by_date IS NOT NULL
              THEN CAST(coalesce(sic_today = 0, false) AND sic_tomorrow_by_date = 1 AS INTEGER) END
           AS sic_next_day_by_date
  FROM by_date
)"""

_HASHED = """md5('{"event_id":' || event_id || '}')"""
_REPEATED_BY_DATE = f"""{_with(_EVENT_ROWS, "patient_day AS (SELECT * FROM event_rows)", _SIC_DAY)},
firsts AS (
  SELECT subject_id, stay_id, chart_date, arg_min(sic_today, {_HASHED}) AS status FROM sic_day GROUP BY ALL
),
ahead AS (
  SELECT event_id, subject_id, stay_id, chart_date, sic_today, lead(sic_today) OVER (
    PARTITION BY subject_id, stay_id ORDER BY chart_date, {_HASHED}) AS sic_tomorrow
  FROM sic_day
)
SELECT event_id, sic_today, sic_tomorrow, status AS sic_tomorrow_by_date,
       CASE WHEN status IS NOT NULL
            THEN CAST(coalesce(sic_today = 0, false) AND status = 1 AS INTEGER) END AS sic_next_day_by_date
FROM ahead a LEFT JOIN firsts f ON f.subject_id IS NOT DISTINCT FROM a.subject_id
  AND f.stay_id IS NOT DISTINCT FROM a.stay_id AND f.chart_date = a.chart_date + 1"""

# Poisson with mean 1: the weight is the number of cuts at or below the draw.
_DRAW = "CAST('0x' || left(md5(subject_id || ':' || replicate), 8) AS BIGINT)"
_WEIGHT = " + ".join(
    f"CAST({_DRAW} >= {math.floor(2**32 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1)))} AS INTEGER)"
    for k in range(12)
)
_REPLICATES = f"""
drawn AS (
  SELECT *, CASE WHEN replicate = 0 THEN 1 ELSE {_WEIGHT} END AS w
  FROM (SELECT *, unnest(range(0, 101))::INTEGER AS replicate FROM scored)
),
below AS (
  SELECT *, sum(w * (1 - label)) OVER upto AS low_or_even,
         sum(w * (1 - label)) OVER (PARTITION BY grp, replicate, score) AS even
  FROM drawn WHERE w > 0
  WINDOW upto AS (PARTITION BY grp, replicate ORDER BY score)
),
replicates AS (
  SELECT grp, replicate, CAST(sum(w * label) AS BIGINT) AS n_pos, CAST(sum(w * (1 - label)) AS BIGINT) AS n_neg,
         CAST(sum(w * label * (2 * low_or_even - even)) AS DOUBLE)
           / nullif(2 * CAST(sum(w * label) AS DOUBLE) * CAST(sum(w * (1 - label)) AS DOUBLE), 0) AS auroc
  FROM below GROUP BY grp, replicate
)"""


def _interval(value: str, name: str) -> str:
    drawn = f"CASE WHEN replicate > 0 THEN {value} END"
    return f"""max(CASE WHEN replicate = 0 THEN {value} END) AS {name}, count({drawn}) AS n_replicates,
  round(quantile_cont({drawn}, 0.025), 9) AS low, round(quantile_cont({drawn}, 0.975), 9) AS high"""


_BUCKET = "CAST('0x' || left(md5(CAST(subject_id AS VARCHAR)), 8) AS BIGINT) % {0}"

_FOLD_ROWS = f"""{_with(*_TO_SIC)}
SELECT c.candidate, CAST({_BUCKET.format(4)} AS INTEGER) AS fold, count(*) AS n_rows, count(*) AS n_days,
       count(DISTINCT subject_id) AS n_subjects, CAST(sum(sic_next_day) AS BIGINT) AS n_pos, count(*) AS n_scored
FROM sic_kept, (VALUES ('logistic'), ('trees')) AS c(candidate) GROUP BY ALL"""

# The rate at a score is the largest, over blocks that begin at or below it, of the least rate of their extensions.
_ISOTONIC = f"""{_with(*_TO_SCORED)},
counts AS (
  SELECT floor(score * 100) / 100 AS score, count(*) AS n_rows, CAST(sum(label) AS BIGINT) AS n_pos
  FROM scored GROUP BY 1
),
sums AS (SELECT *, sum(n_rows) OVER upto AS n, sum(n_pos) OVER upto AS p FROM counts WINDOW upto AS (ORDER BY score)),
blocks AS (
  SELECT a.score AS low, b.score AS high, (b.p - a.p + a.n_pos) / (b.n - a.n + a.n_rows) AS rate
  FROM sums a JOIN sums b ON a.score <= b.score
),
least AS (
  SELECT c.score, low, min(rate) AS rate FROM counts c JOIN blocks ON low <= c.score AND c.score <= high GROUP BY ALL
)
SELECT score, n_rows, n_pos, round(rate, 9) AS calibrated
FROM counts JOIN (SELECT score, max(rate) AS rate FROM least GROUP BY score) USING (score)"""


def _times(name: str, status: str) -> str:
    return f"""
SELECT subject_id, stay_id, coalesce(min(chart_date) FILTER ({status} = 1), max(chart_date) FILTER ({status} IS NOT NULL))
         - any_value(since) AS days,
       CAST(count(*) FILTER ({status} = 1) > 0 AS INTEGER) AS event, '{name}' AS criterion
FROM (SELECT *, min(CASE WHEN sic_today = 1 THEN chart_date END) OVER (PARTITION BY subject_id, stay_id) AS since
      FROM jaam_labels)
WHERE chart_date >= since GROUP BY subject_id, stay_id HAVING count({status}) > 0"""


_TIMES = f"{_with(*_TO_BOTH)}, times AS ({_times('isth', 'dic_today')} UNION ALL {_times('jaam', 'jaam_dic_today')})"

_FREE = f"""{_TIMES},
ended AS (
  SELECT criterion, days, count(*) FILTER (event = 1) AS n_events, count(*) FILTER (event = 0) AS n_censored
  FROM times GROUP BY ALL
),
risk AS (
  SELECT e.*, (SELECT count(*) FROM times t WHERE t.criterion = e.criterion AND t.days >= e.days) AS n_at_risk
  FROM ended e
),
curve AS (
  SELECT a.criterion, a.days, a.n_at_risk, a.n_events, a.n_censored,
         product(1 - b.n_events / b.n_at_risk) AS free,
         sum(b.n_events / (b.n_at_risk * nullif(b.n_at_risk - b.n_events, 0))) AS spread
  FROM risk a JOIN risk b ON a.criterion = b.criterion AND b.days <= a.days GROUP BY ALL
)
SELECT criterion, days, n_at_risk, n_events, n_censored, round(free, 9) AS free,
       CASE WHEN free > 0 THEN round(free * sqrt(spread), 9) END AS std_error
FROM curve"""

_LABS = ("platelet_avg", "inr_avg", "pt_avg", "fibrinogen_avg")

_LAB_DAYS = (
    "lab_days AS ("
    + " UNION ALL ".join(
        f"SELECT subject_id, stay_id, chart_date, '{c}' AS column_name, {c} AS value FROM patient_day" for c in _LABS
    )
    + ")"
)

# A run is a difference of two row numbers: among all days of the stay, and among its missing ones.
_RUNS = f"""{_with(_PATIENT_DAY, _LAB_DAYS)},
placed AS (
  SELECT *, row_number() OVER stay AS k, count(*) OVER (PARTITION BY column_name, subject_id, stay_id) AS n
  FROM lab_days WINDOW stay AS (PARTITION BY column_name, subject_id, stay_id ORDER BY chart_date)
),
islands AS (
  SELECT *, k - row_number() OVER (PARTITION BY column_name, subject_id, stay_id ORDER BY chart_date) AS island
  FROM placed WHERE value IS NULL
),
runs AS (
  SELECT column_name, subject_id, stay_id, min(chart_date) AS first_day, max(chart_date) AS last_day,
         count(*) AS n_days, min(k) = 1 AS opens, max(k) = any_value(n) AS closes
  FROM islands GROUP BY column_name, subject_id, stay_id, island
)"""

_PAIR = """
SELECT '{a}' AS first_column, '{b}' AS second_column,
       count(*) FILTER ({a} IS NULL AND {b} IS NULL) AS n_both,
       count(*) FILTER ({a} IS NULL AND {b} IS NOT NULL) AS n_first_only,
       count(*) FILTER ({a} IS NOT NULL AND {b} IS NULL) AS n_second_only,
       count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS n_neither
FROM patient_day"""


def _stale_row(name: str, source: str, where: str = "", because: str = "") -> str:
    stale = "true" if because else "false"
    return f"SELECT '{name}' AS table_name, count(*) AS n_rows, {stale} AS stale, '{because}' AS because FROM {source} {where}"


ORACLES: dict[str, str] = {
    "preceding_24_hours": _before(_moments("error"), 24),
    "preceding_24_hours_of_days": _before(_DAY_ANCHORS, 24, "a.hour,"),
    "preceding_3_hours": _before(_moments("signup"), 3),
    "recent_slopes": f"""{_with(_PATIENT_DAY)}
SELECT d.subject_id, d.stay_id, d.chart_date, {_SLOPE.format("platelet_avg")} AS platelet_avg_slope4,
       {_SLOPE.format("inr_avg")} AS inr_avg_slope4
FROM patient_day d JOIN patient_day p ON p.subject_id = d.subject_id AND p.stay_id = d.stay_id
  AND p.chart_date BETWEEN d.chart_date - 3 AND d.chart_date
GROUP BY ALL""",
    "recent_slopes_repeated_days": f"""{_with(_EVENT_ROWS)},
distinct_days AS (SELECT DISTINCT subject_id, stay_id, chart_date FROM event_rows),
sloped AS (
  SELECT d.subject_id, d.stay_id, d.chart_date, {_SLOPE.format("platelet_avg")} AS slope
  FROM distinct_days d JOIN event_rows p ON p.subject_id IS NOT DISTINCT FROM d.subject_id
    AND p.chart_date BETWEEN d.chart_date - 2 AND d.chart_date
  GROUP BY ALL
)
SELECT event_id, slope AS platelet_avg_slope3
FROM event_rows e JOIN sloped s ON s.subject_id IS NOT DISTINCT FROM e.subject_id AND s.chart_date = e.chart_date""",
    "stale_label_tables": _with(*_TO_BOTH)
    + " UNION ALL ".join((
        _stale_row("sic_labels", "sic_kept"),
        _stale_row("days_with_follow_up", "sic_kept"),
        _stale_row("isth_labels", "isth_labels"),
        _stale_row("sic_to_dic_isth", "isth_labels", "WHERE sic_today = 1 AND dic_next_day IS NOT NULL"),
        _stale_row("jaam_labels", "jaam_labels"),
        _stale_row("sic_to_dic_jaam", "jaam_labels", "WHERE sic_today = 1 AND jaam_dic_progression IS NOT NULL", "jaam_labels"),
    )),
    "table_after_failed_job": f"SELECT *, true AS a_job_failed FROM ({_TO_DIC_JAAM})",
    "labels_after_new_days": LABEL_ORACLES["dic_labels_both"],
    "buckets_after_new_days": f"""{_with(*_TO_SIC)},
touched AS (
  SELECT DISTINCT {_BUCKET.format(16)} AS bucket FROM patient_day
  WHERE (subject_id % 5 = 1 AND day(chart_date) >= 20) OR (subject_id % 11 = 2 AND day(chart_date) = 5)
)
SELECT DISTINCT CAST({_BUCKET.format(16)} AS INTEGER) AS bucket,
       {_BUCKET.format(16)} IN (SELECT bucket FROM touched) AS rewritten
FROM sic_kept""",
    "sic_labels_by_date": f"""{_with(_PATIENT_DAY, _SIC_DAY, _AHEAD_BY_DATE)}
SELECT subject_id, stay_id, chart_date, sic_today, sic_tomorrow, sic_next_day, sic_tomorrow_by_date, sic_next_day_by_date
FROM both_ways""",
    "sic_labels_by_date_repeated_days": _REPEATED_BY_DATE,
    "next_day_distances": f"""{_with(_PATIENT_DAY, _SIC_DAY, _AHEAD_BY_DATE)}
SELECT CAST(distance AS INTEGER) AS distance, count(*) AS n_rows, count(sic_next_day) AS n_known_by_row,
       count(sic_next_day_by_date) AS n_known_by_date, count(*) FILTER (sic_next_day = 1) AS n_onsets_by_row,
       count(*) FILTER (sic_next_day_by_date = 1) AS n_onsets_by_date,
       count(*) FILTER (sic_next_day IS DISTINCT FROM sic_next_day_by_date) AS n_labels_differ
FROM both_ways GROUP BY ALL""",
    "fairness_replicates": f"{_with(*_TO_SCORED, _REPLICATES)} SELECT * FROM replicates",
    "fairness_intervals": f"""{_with(*_TO_SCORED, _REPLICATES)}
SELECT grp, {_interval("auroc", "auroc")} FROM replicates GROUP BY grp""",
    "fairness_differences": f"""{_with(*_TO_SCORED, _REPLICATES)},
apart AS (
  SELECT a.grp AS first_group, b.grp AS second_group, replicate, a.auroc - b.auroc AS gap
  FROM replicates a JOIN replicates b USING (replicate) WHERE a.grp < b.grp
),
found AS (SELECT first_group, second_group, {_interval("gap", "difference")} FROM apart GROUP BY ALL)
SELECT * REPLACE (round(difference, 9) AS difference) FROM found""",
    "out_of_fold_rows": _FOLD_ROWS,
    "isotonic_rates": _ISOTONIC,
    "time_to_dic": f"{_TIMES} SELECT * REPLACE (CAST(days AS INTEGER) AS days) FROM times",
    "free_of_dic": _FREE.replace("SELECT criterion, days, n_at", "SELECT criterion, CAST(days AS INTEGER) AS days, n_at"),
    "missing_runs": f"{_RUNS} SELECT * FROM runs",
    "missing_run_lengths": f"""{_RUNS}
SELECT column_name, n_days, count(*) AS n_runs, count(*) FILTER (opens AND closes) AS n_whole_stays
FROM runs GROUP BY ALL""",
    "days_since_known": f"""{_with(_PATIENT_DAY)}
SELECT d.subject_id, d.stay_id, d.chart_date, {", ".join(
    f"CAST(d.chart_date - max(CASE WHEN p.{c} IS NOT NULL THEN p.chart_date END) AS INTEGER) AS {c}_days_since"
    for c in _LABS)}
FROM patient_day d JOIN patient_day p ON p.subject_id = d.subject_id AND p.stay_id = d.stay_id
  AND p.chart_date <= d.chart_date
GROUP BY d.subject_id, d.stay_id, d.chart_date""",
    "joint_missingness": _with(_PATIENT_DAY)
    + " UNION ALL ".join(_PAIR.format(a=a, b=b) for i, a in enumerate(_LABS) for b in _LABS[i + 1 :]),
}
