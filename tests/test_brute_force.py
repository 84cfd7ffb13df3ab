"""The whole chain against a row-by-row model, over random tables with NULL and NaN."""

import math
import random

import pytest

from daymark.functions.keys import KEYS
from daymark.functions.criteria import ISTH, JAAM, SIC
from daymark.operators import labels
from tests.build import day, days_of

NAN = float("nan")
# Values on, just below and just above the cut-offs.
POOL = {
    "platelet_avg": [10, 49.9, 50, 79.9, 80, 99.9, 100, 119.9, 120, 200],
    "inr_avg": [1.0, 1.19, 1.2, 1.3, 1.4, 1.41, 3.0],
    "average_sofa_score": [0, 1.9, 2, 5],
    "pt_avg": [12, 14.9, 15, 17.9, 18, 25],
    "fibrinogen_avg": [50, 99.9, 100, 300],
    "d_dimer_avg": [100, 499, 500, 5000, 5001],
    "mean_heart_rate": [60, 90, 90.5, 120],
    "mean_resp_rate": [12, 20, 20.5, 30],
    "max_temperature": [35.5, 36, 37, 38, 38.5],
    "wbc_avg": [1000, 4000, 8000, 12000, 20000],
}


def step(value, *cuts):
    """Points of the first cut met, None for a missing value; NaN meets none."""
    if value is None:
        return None
    return next((points for test, points in cuts if not math.isnan(value) and test(value)), 0)


def summed(*scores):
    return None if None in scores else sum(scores)


def flag(total, cut):
    return None if total is None else int(total >= cut)


def sic_today(r):
    platelets = step(r["platelet_avg"], (lambda v: v < 50, 2), (lambda v: v < 100, 1))
    inr = step(r["inr_avg"], (lambda v: v > 1.4, 2), (lambda v: v >= 1.2, 1))
    sofa = step(r["average_sofa_score"], (lambda v: v >= 2, 1))
    return flag(summed(platelets, inr, sofa), 4)


def isth_today(r):
    return flag(
        summed(
            step(r["platelet_avg"], (lambda v: v < 50, 2), (lambda v: v < 100, 1)),
            step(r["pt_avg"], (lambda v: v >= 18, 2), (lambda v: v >= 15, 1)),
            step(r["fibrinogen_avg"], (lambda v: v < 100, 1)),
            step(r["d_dimer_avg"], (lambda v: v > 5000, 3), (lambda v: v >= 500, 2)),
        ),
        5,
    )


def jaam_today(r):
    signs = (
        step(r["mean_heart_rate"], (lambda v: v > 90, 1)),
        step(r["mean_resp_rate"], (lambda v: v > 20, 1)),
        step(r["max_temperature"], (lambda v: v < 36 or v > 38, 1)),
        step(r["wbc_avg"], (lambda v: v < 4000 or v > 12000, 1)),
    )
    platelets = step(r["platelet_avg"], (lambda v: v < 80, 3), (lambda v: v < 120, 1))
    inr = step(r["inr_avg"], (lambda v: v >= 1.2, 1))
    return flag(summed(sum(s or 0 for s in signs), platelets, inr), 4)


def with_next(rows, today):
    out = []
    for i, r in enumerate(rows):
        now, then = today(r), today(rows[i + 1]) if i + 1 < len(rows) else None
        out.append((now, then, None if then is None else int(now == 0 and then == 1)))
    return out


def expected(stays):
    result = {}
    for (subject, stay), rows in stays.items():
        labelled = list(zip(rows, with_next(rows, sic_today)))
        kept = [(r, flags) for r, flags in labelled if flags[1] is not None]
        days = [r for r, _ in kept]
        both = zip(with_next(days, isth_today), with_next(days, jaam_today))
        for (r, sic), (isth, jaam) in zip(kept, both):
            result[subject, stay, r["chart_date"]] = (*sic, *isth, *jaam)
    return result


@pytest.mark.parametrize("over", [{"unique_days": True}, {"ties": KEYS}])
def test_chain(spark, over):
    rng = random.Random(5)
    stays, rows = {}, []
    for subject in range(60):
        for stay in (subject * 10, subject * 10 + 1):
            days = sorted(rng.sample(range(40), rng.randrange(1, 14)))
            for n in days:
                # Lean towards ill patients, so that all flags come up.
                values = {
                    c: rng.choice([*pool, *pool[: len(pool) // 2], None, NAN])
                    for c, pool in POOL.items()
                }
                values = {c: None if v is None else float(v) for c, v in values.items()}
                rows.append((subject, stay, n, values))
                stays.setdefault((subject, stay), []).append(values | {"chart_date": day(n)})
    rng.shuffle(rows)
    got = labels.label_progression(days_of(spark, rows), **over)
    names = [n for c in (SIC, ISTH, JAAM) for n in (c.today, c.tomorrow, c.onset)]
    found = {
        (r.subject_id, r.stay_id, r.chart_date): tuple(r[n] for n in names) for r in got.collect()
    }
    wanted = expected(stays)
    assert found == wanted
    for place in range(9):
        assert {flags[place] for flags in wanted.values()} >= {0, 1}
