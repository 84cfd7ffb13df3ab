import pytest
from pyspark.errors import AnalysisException

from daymark.__main__ import main
from daymark.functions.criteria import ISTH, JAAM
from daymark.operators import labels
from daymark.plans.tables import LabelTables, build_label_tables
from daymark.sources.tables import read_table, write_table
from tests.build import rows_of


def expected(days):
    both = labels.label_progression(days, unique_days=True)
    return {
        "sic_labels": 296,
        "days_with_follow_up": 296,
        "isth_labels": 296,
        "sic_to_dic_isth": labels.on_sic_days(both, ISTH).count(),
        "jaam_labels": 296,
        "sic_to_dic_jaam": labels.on_sic_days(both, JAAM).count(),
    }


def sizes(spark, tables):
    return {n: read_table(spark, getattr(tables, n)).count() for n in tables.__dataclass_fields__}


def test_six_tables_by_path(spark, small_days, tmp_path):
    source = str(tmp_path / "days")
    write_table(small_days, source)
    tables = LabelTables.under(str(tmp_path / "out"))
    build_label_tables(spark, source, tables)
    assert sizes(spark, tables) == expected(small_days)
    fused = labels.label_progression(small_days, JAAM, unique_days=True)
    assert rows_of(read_table(spark, tables.jaam_labels)) == rows_of(fused)

    # A rerun over fewer days replaces all tables, or all but the last.
    half = str(tmp_path / "half")
    write_table(small_days.filter("subject_id < 7"), half)
    before = sizes(spark, tables)
    build_label_tables(spark, half, tables, last_mode="ignore")
    after = sizes(spark, tables)
    assert after.pop("sic_to_dic_jaam") == before.pop("sic_to_dic_jaam")
    assert all(after[n] < before[n] for n in after)
    build_label_tables(spark, half, tables)
    assert sizes(spark, tables)["sic_to_dic_jaam"] < expected(small_days)["sic_to_dic_jaam"]


def test_six_tables_bucketed(spark, small_days):
    spark.sql("CREATE DATABASE IF NOT EXISTS marks")
    write_table(small_days, "marks.days")
    tables = LabelTables.under("marks")
    build_label_tables(spark, "marks.days", tables, buckets=4, unique_days=True)
    assert sizes(spark, tables) == expected(small_days)
    merged = read_table(spark, tables.days_with_follow_up)
    labelled = labels.label_days(merged, ISTH, JAAM, unique_days=True)
    plan = labelled._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Sort [") == 1
    with pytest.raises(ValueError, match="unique_days"):
        build_label_tables(spark, "marks.days", tables, buckets=4)


def test_modes(spark, small_days, tmp_path):
    with pytest.raises(ValueError, match="mode"):
        write_table(small_days, str(tmp_path / "x"), mode="append")
    with pytest.raises(ValueError, match="catalog"):
        write_table(small_days, str(tmp_path / "x"), bucket_by=["stay_id"], buckets=2)


def test_a_table_is_not_replaced_while_it_is_read(spark, small_days, tmp_path):
    tables = LabelTables.under(str(tmp_path))
    write_table(small_days, tables.jaam_labels)
    with pytest.raises(ValueError, match="while it is read"):
        build_label_tables(spark, tables.jaam_labels + "/", tables)
    assert read_table(spark, tables.jaam_labels).count() == 397

    write_table(small_days, "own_days")
    with pytest.raises(AnalysisException):
        write_table(read_table(spark, "own_days"), "own_days")


def test_command_line(spark, small_days, tmp_path):
    source, target = str(tmp_path / "days"), str(tmp_path / "labels")
    write_table(small_days, source)
    main([source, target + "/", "--unique-days", "--white-cell-unit", "1000"])
    tables = LabelTables.under(target)
    assert sizes(spark, tables)["isth_labels"] == 296
    counts = read_table(spark, tables.jaam_labels).agg({"sirs_wbc": "sum"}).first()[0]
    default = labels.label_progression(small_days, JAAM, unique_days=True)
    assert counts != default.agg({"sirs_wbc": "sum"}).first()[0]
