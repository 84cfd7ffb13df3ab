from daymark.operators import labels, reports
from tests.build import days_of


def test_label_yield(small_days):
    both = labels.label_progression(small_days, unique_days=True).cache()
    rows = {r.criterion: r for r in reports.label_yield(both).collect()}
    assert set(rows) == {"isth", "jaam"}
    for name, today, onset in [
        ("isth", "dic_today", "dic_next_day"),
        ("jaam", "jaam_dic_today", "jaam_dic_progression"),
    ]:
        row = rows[name]
        assert row.n_days == both.count() == 296
        assert row.n_scored == both.filter(f"{today} IS NOT NULL").count()
        assert row.n_positive == both.filter(f"{today} = 1").count()
        assert row.n_labelled == both.filter(f"{onset} IS NOT NULL").count()
        assert row.n_transitions == both.filter(f"{onset} = 1").count()
    assert (rows["isth"].n_sic_labelled, rows["isth"].n_sic_transitions) == (25, 1)
    assert (rows["jaam"].n_sic_labelled, rows["jaam"].n_sic_transitions) == (29, 5)


def test_crosstab_covers_every_day(small_days):
    both = labels.label_progression(small_days, unique_days=True)
    table = reports.criteria_crosstab(both).collect()
    assert sum(r.n_days for r in table) == 296
    assert any(r.dic_today is None for r in table)


def test_missingness(spark):
    days = days_of(spark, [(1, 1, i, {"inr_avg": 1.0 if i else None}) for i in range(4)])
    rows = reports.missingness(days, ["inr_avg", "pt_avg"]).collect()
    assert [tuple(r) for r in rows] == [("inr_avg", 4, 1, 0.25), ("pt_avg", 4, 4, 1.0)]
    assert reports.missingness(days.limit(0), ["inr_avg"]).first().missing_rate is None
