import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from daymark.functions.criteria import ISTH, JAAM, SIC
from daymark.functions.keys import KEYS
from daymark.operators import labels
from daymark.operators.checks import key_report, repeated_keys
from tests import build
from tests.build import by_key, days_of, rows_of


@pytest.fixture(scope="module")
def sequence(spark):
    """One stay with gaps; SIC per day 1, 0, unknown, 1, 1, 0 and DIC 0, 1, 0, 0, 1, 1."""
    rows = []
    for n, sic, dic in [(0, 1, 0), (2, 0, 1), (3, None, 0), (4, 1, 0), (8, 1, 1), (9, 0, 1)]:
        values = dict(build.SIC[0 if sic is None else sic]) | build.ISTH[dic]
        if sic is None:
            values["average_sofa_score"] = None
        # Platelets serve both criteria; keep the ISTH flag where SIC needs them high.
        if dic and not sic:
            values |= {"pt_avg": 20.0, "fibrinogen_avg": 50.0, "d_dimer_avg": 6000.0}
        if not dic and sic:
            values |= {"pt_avg": 12.0, "fibrinogen_avg": 200.0, "d_dimer_avg": 0.0}
        rows.append((1, 1, n, values))
    return days_of(spark, rows)


@pytest.mark.parametrize("over", [{"unique_days": True}, {}, {"ties": KEYS}])
def test_sequence(sequence, over):
    merged = labels.merge_in_one_pass(sequence, **over)
    assert by_key(merged, "sic_today", "sic_tomorrow", "sic_next_day") == {
        0: (1, 0, 0),
        3: (None, 1, 0),
        4: (1, 1, 0),
        8: (1, 0, 0),
    }
    progression = labels.label_progression(sequence, ISTH, **over)
    assert by_key(progression, "dic_today", "dic_tomorrow", "dic_next_day") == {
        0: (0, 0, 0),
        3: (0, 0, 0),
        4: (0, 1, 1),
        8: (1, None, None),
    }
    chosen = by_key(labels.on_sic_days(progression, ISTH), "dic_next_day")
    assert chosen == {0: (0,), 4: (1,)}


def test_fused_chain_equals_stored_steps(small_days):
    merged = labels.merge_in_one_pass(small_days, unique_days=True)
    both = labels.label_progression(small_days, ISTH, JAAM, unique_days=True)
    for criterion in (ISTH, JAAM):
        alone = labels.label_days(merged, criterion, unique_days=True)
        assert rows_of(alone) == rows_of(both.select(*alone.columns))


def test_label_table_has_twelve_columns(small_days):
    table = labels.sic_labels(small_days, unique_days=True)
    assert table.columns == [*KEYS, *SIC.inputs, *SIC.outputs]
    assert table.count() == 296


def test_join_and_one_pass_agree_on_unique_keys(small_days):
    table = labels.sic_labels(small_days)
    joined = labels.merge_by_join(small_days, table)
    one_pass = labels.merge_in_one_pass(small_days)
    assert joined.columns == one_pass.columns == [*small_days.columns, *SIC.outputs]
    assert rows_of(joined) == rows_of(one_pass)


@pytest.fixture(scope="module")
def repeated(spark):
    return days_of(spark, [(1, 1, n, build.SIC[s]) for n, s in [(0, 0), (0, 0), (1, 1)]])


@pytest.mark.parametrize("over", [{}, {"ties": KEYS}])
def test_repeated_key(repeated, over):
    table = labels.sic_labels(repeated, **over)
    assert table.count() == 2
    assert labels.merge_by_join(repeated, table, fan_out=True).count() == 4
    with pytest.raises(SparkRuntimeException, match="repeated key"):
        labels.merge_by_join(repeated, table).collect()
    one_pass = labels.merge_in_one_pass(repeated, **over)
    assert sorted(r.sic_tomorrow for r in one_pass.collect()) == [0, 1]
    assert repeated_keys(repeated).select("n_rows").collect() == [(2,)]
    assert key_report(repeated).first() == (3, 0, 1, 2, 2)


@pytest.mark.parametrize("over", [{}, {"ties": KEYS}])
def test_null_keys(spark, over):
    rows = [(None, 1, n, build.SIC[0]) for n in (0, 1, 2)]
    rows += [(2, 2, n, build.SIC[0]) for n in (None, 0, 1)]
    days = days_of(spark, rows)
    table = labels.sic_labels(days, **over)
    assert table.count() == 4  # two of the NULL stay, and the undated day sees the first one
    assert labels.merge_by_join(days, table).count() == 1
    assert labels.merge_in_one_pass(days, **over).count() == 1
    assert key_report(days).first() == (6, 4, 0, 0, 1)


def test_labelled_input_is_rejected(small_days):
    labelled = labels.merge_in_one_pass(small_days, unique_days=True)
    with pytest.raises(ValueError, match="sic_today"):
        labels.merge_in_one_pass(labelled)
    with pytest.raises(ValueError, match="already present"):
        labels.label_days(small_days.withColumn("SIRS_HR", F.lit(1)), JAAM)
    with pytest.raises(ValueError, match="missing columns: inr_avg"):
        labels.sic_labels(small_days.drop("inr_avg"))


@pytest.mark.parametrize("over", [{"unique_days": True}, {"ties": KEYS}])
def test_other_columns_pass_through(spark, over):
    extra = ["note string", "tags array<string>", "more map<string,int>", "ward.name string"]
    rows = [
        (1, 1, n, build.SIC[0] | {"note": f"n{n}", "tags": ["a"], "more": {"k": n}})
        for n in (0, 1)
    ]
    names = [e.split()[0] for e in extra]
    days = days_of(spark, rows, extra[:3]).withColumn("ward.name", F.lit("x"))
    got = labels.merge_in_one_pass(days, **over)
    assert got.columns == [*days.columns, *SIC.outputs]
    assert got.select(*[f"`{n}`" for n in names]).collect() == [("n0", ["a"], {"k": 0}, "x")]


def test_row_order_and_partitions_do_not_matter(spark, small_days):
    expected = rows_of(labels.label_progression(small_days, unique_days=True))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (1, 7):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            mixed = small_days.orderBy(F.rand(partitions))
            assert rows_of(labels.label_progression(mixed, unique_days=True)) == expected
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_progression_counts(small_days):
    both = labels.label_progression(small_days, unique_days=True)
    isth = labels.on_sic_days(both, ISTH)
    jaam = labels.on_sic_days(both, JAAM)
    assert (isth.count(), isth.filter("dic_next_day = 1").count()) == (25, 1)
    assert (jaam.count(), jaam.filter("jaam_dic_progression = 1").count()) == (29, 5)


@pytest.mark.parametrize("criterion", [ISTH, JAAM])
@pytest.mark.parametrize("over", [{"unique_days": True}, {"ties": KEYS}])
def test_lighter_progression_set(small_days, criterion, over):
    days = small_days.withColumns(
        {
            "ward.name": F.concat(F.lit("w"), F.col("subject_id")),
            "Note": F.when(F.col("subject_id") % 2 == 0, F.col("chart_date")),
            "more": F.create_map(F.lit("k"), F.col("wbc_avg")),
        }
    )
    labelled = labels.label_progression(days, criterion, unique_days=True)
    expected = labels.on_sic_days(labelled, criterion)
    got = labels.sic_to_dic(days, criterion, **over)
    assert got.dtypes == expected.dtypes
    assert rows_of(got) == rows_of(expected)


def test_progression_set_without_other_columns(small_days):
    days = small_days.select(*KEYS, *SIC.inputs, "pt_avg", "fibrinogen_avg", "d_dimer_avg")
    assert labels.sic_to_dic(days, ISTH, unique_days=True).count() == 25
