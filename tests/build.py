"""Small patient-day tables for the tests."""

from datetime import date, timedelta

from daymark.functions.keys import KEYS

MEASURED = [
    "platelet_avg",
    "inr_avg",
    "average_sofa_score",
    "pt_avg",
    "fibrinogen_avg",
    "d_dimer_avg",
    "mean_heart_rate",
    "mean_resp_rate",
    "max_temperature",
    "wbc_avg",
]
SCHEMA = "subject_id bigint, stay_id bigint, chart_date date, " + ", ".join(
    f"{c} double" for c in MEASURED
)
START = date(2024, 1, 1)

# Measurements that give a wanted flag.
SIC = {
    1: {"platelet_avg": 40.0, "inr_avg": 1.5, "average_sofa_score": 0.0},
    0: {"platelet_avg": 200.0, "inr_avg": 1.0, "average_sofa_score": 0.0},
}
ISTH = {
    1: {"pt_avg": 20.0, "fibrinogen_avg": 50.0, "d_dimer_avg": 6000.0},
    0: {"pt_avg": 12.0, "fibrinogen_avg": 200.0, "d_dimer_avg": 0.0},
}


def day(n):
    return None if n is None else START + timedelta(days=n)


def days_of(spark, rows, extra=()):
    """Rows of (subject, stay, day number, {measurement: value})."""
    extra_names = [e.split()[0] for e in extra]
    data = [
        (subject, stay, day(n), *[values.get(c) for c in MEASURED + extra_names])
        for subject, stay, n, values in rows
    ]
    return spark.createDataFrame(data, ", ".join([SCHEMA, *extra]))


def by_key(df, *columns):
    """{day number: tuple of columns}, for tables with unique days of one stay."""
    return {
        (row["chart_date"] - START).days: tuple(row[c] for c in columns)
        for row in df.select(*KEYS, *columns).collect()
    }


def rows_of(df):
    """Rows as a sorted list, columns in name order."""
    names = sorted(df.columns)
    return sorted(repr(tuple(row[n] for n in names)) for row in df.collect())
