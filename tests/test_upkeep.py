import random

import pytest
from pyspark.sql import functions as F

from daymark.functions.criteria import JAAM
from daymark.functions.keys import KEYS
from daymark.operators import labels
from daymark.operators.features import split_bucket
from daymark.plans import upkeep
from daymark.plans.tables import LabelTables
from daymark.sources import versions
from tests.build import days_of, rows_of
from tests.test_brute_force import POOL


def random_days(spark, seed, n_subjects=40):
    rng = random.Random(seed)
    rows = []
    for subject in range(n_subjects):
        for stay in (subject * 10, subject * 10 + 1):
            for n in rng.sample(range(30), rng.randrange(1, 9)):
                rows.append((subject, stay, n, {c: float(rng.choice(pool)) for c, pool in POOL.items()}))
    return days_of(spark, rows).cache()


def both(days):
    return labels.label_progression(days, unique_days=True)


def test_new_days_give_the_same_labels_as_a_rebuild(spark, tmp_path):
    paths = (str(tmp_path / "days"), str(tmp_path / "labels"))
    everything = random_days(spark, 1)
    early = everything.filter("dayofmonth(chart_date) <= 15 AND subject_id % 8 <> 3")
    upkeep.start_upkeep(early, *paths, both, buckets=8)
    assert rows_of(versions.read(spark, paths[1])) == rows_of(both(early))
    batches = [
        everything.filter("dayofmonth(chart_date) > 15 AND subject_id IN (1, 2)"),
        everything.filter("subject_id % 8 = 3"),  # subjects that are new
        everything.filter("dayofmonth(chart_date) > 15 AND subject_id % 8 <> 3"),  # some days come again
    ]
    for batch in batches:
        before = versions.state(spark, paths[1]).buckets
        days_before = versions.state(spark, paths[0]).buckets
        changed = upkeep.add_days(batch, *paths, both, buckets=8)
        touched = {r[0] for r in batch.select(split_bucket("subject_id", 8)).collect()}
        assert set(changed) == touched
        for old, path in ((before, paths[1]), (days_before, paths[0])):
            now = versions.state(spark, path).buckets
            assert {b for b in {*old, *now} if old.get(b) != now.get(b)} <= touched
            assert all(now[b] != old.get(b) for b in touched & set(now))
        report = versions.staleness(spark, {"days": paths[0], "labels": paths[1]})
        assert not any(r.stale for r in report.collect())
    assert rows_of(versions.read(spark, paths[0])) == rows_of(everything)
    assert rows_of(versions.read(spark, paths[1])) == rows_of(both(everything))


def test_corrected_days_replace_old_ones(spark, tmp_path):
    paths = (str(tmp_path / "days"), str(tmp_path / "labels"))
    days = random_days(spark, 2, 12)
    upkeep.start_upkeep(days.withColumn("platelet_avg", F.lit(500.0)), *paths, both, buckets=4)
    upkeep.add_days(days, *paths, both, buckets=4)
    assert rows_of(versions.read(spark, paths[1])) == rows_of(both(days))
    assert upkeep.add_days(days.limit(0), *paths, both, buckets=4) == []


def test_only_stays_with_a_new_day_are_labelled_again(spark, tmp_path):
    paths = (str(tmp_path / "days"), str(tmp_path / "labels"))
    days = random_days(spark, 3, 12)
    upkeep.start_upkeep(days.filter("stay_id <> 31"), *paths, both, buckets=2)
    seen = []

    def watched(rows):
        seen.append({(r.subject_id, r.stay_id) for r in rows.select("subject_id", "stay_id").distinct().collect()})
        return both(rows)

    upkeep.add_days(days.filter("stay_id = 31"), *paths, watched, buckets=2)
    assert seen == [{(3, 31)}]
    assert rows_of(versions.read(spark, paths[1])) == rows_of(both(days))


def test_a_failure_between_days_and_labels_is_seen_and_repaired(spark, tmp_path):
    paths = (str(tmp_path / "days"), str(tmp_path / "labels"))
    days = random_days(spark, 4, 10)
    upkeep.start_upkeep(days.filter("dayofmonth(chart_date) < 20"), *paths, both, buckets=4)

    def fails(rows):
        raise RuntimeError("killed")

    late = days.filter("dayofmonth(chart_date) >= 20")
    with pytest.raises(RuntimeError, match="killed"):
        upkeep.add_days(late, *paths, fails, buckets=4)
    report = versions.staleness(spark, {"days": paths[0], "labels": paths[1]}).collect()
    assert {r.table_name: r.stale for r in report} == {"days": False, "labels": True}
    with pytest.raises(ValueError, match="up to date"):
        upkeep.add_days(late, *paths, both, buckets=4)
    upkeep.repair_labels(spark, *paths, both, buckets=4)
    assert rows_of(versions.read(spark, paths[1])) == rows_of(both(days))


def test_null_keys_are_refused(spark, tmp_path):
    paths = (str(tmp_path / "days"), str(tmp_path / "labels"))
    days = days_of(spark, [(1, 1, 0, {}), (2, None, 1, {})])
    with pytest.raises(Exception, match="NULL key"):
        upkeep.start_upkeep(days, *paths, both, buckets=2)
    upkeep.start_upkeep(days.filter("stay_id IS NOT NULL"), *paths, both, buckets=2)
    with pytest.raises(ValueError, match="NULL key"):
        upkeep.add_days(days, *paths, both, buckets=2)


def test_six_versioned_tables(spark, small_days, tmp_path):
    source, tables = str(tmp_path / "days"), LabelTables.under(str(tmp_path / "out"))
    versions.replace(small_days, source)
    upkeep.renew_label_tables(spark, source, tables, unique_days=True)
    assert rows_of(versions.read(spark, tables.jaam_labels)) == rows_of(
        labels.label_progression(small_days, JAAM, unique_days=True)
    )
    assert not any(r.stale for r in upkeep.stale_tables(spark, source, tables).collect())
    versions.replace(small_days.filter("subject_id < 7"), source)
    upkeep.renew_label_tables(spark, source, tables, keep_last=True, unique_days=True)
    stale = {r.table_name: r.because for r in upkeep.stale_tables(spark, source, tables).collect() if r.stale}
    assert stale == {"sic_to_dic_jaam": ["jaam_labels"]}
    assert versions.read(spark, tables.sic_labels).filter("subject_id >= 7").isEmpty()
    assert KEYS == versions.read(spark, tables.sic_labels).columns[:3]
