"""Every query against its DuckDB statement, on the given tables and on skewed ones."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from daymark.sources.events import read_events
from tests.conftest import SMALL
from tests.duck import assert_equal, connect


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Events of which a third belong to one user, most of them copies of one event."""
    events = read_events(spark, SMALL)
    spread = events.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(39))))
    spread = spread.withColumn("user_id", F.col("user_id") + 1000 * F.col("k")).drop("k")
    hot = events.withColumn("user_id", F.lit(7).cast("long"))
    copies = hot.filter("event_id = 3")
    copies = copies.withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(19_000)))).drop("k")
    folder = tmp_path_factory.mktemp("skewed")
    spread.unionByName(hot).unionByName(copies).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def test_every_oracle_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_oracle(spark, duck, name):
    assert_equal(driver.queries()[name](spark, SMALL), duck, driver.oracle_sql()[name])


@pytest.mark.parametrize(
    "name",
    [
        "patient_day",
        "daily_measurements",
        "dic_labels_both",
        "sic_to_dic_jaam",
        "sic_labels_big_stays",
        "lag_delta_big_stays",
        "cohort",
        "fairness",
        "key_check",
    ],
)
def test_oracle_on_skewed_events(spark, skewed, name):
    assert_equal(driver.queries()[name](spark, skewed), connect(skewed), driver.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - set(driver.oracle_sql())))
def test_queries_without_oracle_give_rows(spark, name):
    assert driver.queries()[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert driver.entry(spark).count() == 29
