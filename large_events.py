"""A large, skewed ``events`` table from the given one, and the queries over it, timed and checked.

``python large_events.py make FOLDER [COPIES]`` writes FOLDER/events.parquet: COPIES (default 200) copies
of the events with users of their own, and half as many rows of one user, half of these copies of one event.
``python large_events.py run FOLDER [NAME ...]`` times queries over it (second run, noop sink) and
compares each with its DuckDB statement by row count and a sum of row hashes over rounded columns.

Environment: BENCH_SF_DIR (the source, default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

import duckdb
from pyspark.sql import functions as F

from daymark.plans.oracles import ORACLES
from daymark.plans.queries import QUERIES
from daymark.session import local_session
from daymark.sources.events import read_events

NAMES = [
    "patient_day",
    "key_check",
    "sic_labels",
    "sic_merge_onepass",
    "sic_merge_join",
    "sic_to_dic_jaam",
    "dic_labels_both",
    "lag_delta",
    "cohort",
    "auroc",
]


def make(spark, folder: str, copies: int) -> None:
    events = read_events(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"))
    numbered = events.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    spread = numbered.withColumn("user_id", F.col("user_id") + 1_000_000 * F.col("k")).drop("k")
    hot = numbered.filter(F.col("k") < copies // 4).withColumn("user_id", F.lit(7).cast("long")).drop("k")
    one = events.filter("event_id = 3").first().asDict() | {"user_id": 7}
    same = spark.range(0, events.count() * (copies // 4), numPartitions=64).select(
        *[F.lit(one[c]).cast(t).alias(c) for c, t in events.dtypes]
    )
    spread.unionByName(hot).unionByName(same).write.mode("overwrite").parquet(f"{folder}/events.parquet")


def digests(columns: dict[str, str]) -> str:
    """Per column: how many values are known, and the sum of their hundredths."""
    parts = ["count(*) AS n_rows"]
    for name, kind in sorted(columns.items()):
        parts.append(f"count({name}) AS n_{name}")
        if kind in ("int", "bigint", "double"):
            parts.append(f"sum(CAST(round(CAST({name} AS DOUBLE) * 100) AS DECIMAL(38, 0))) AS s_{name}")
    return ", ".join(parts)


def run(spark, folder: str, names: list[str]) -> None:
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds = time.perf_counter() - start
        result = QUERIES[name](spark, folder)
        columns = digests(dict(result.dtypes))
        result.createOrReplaceTempView("result")
        own = [str(x) for x in spark.sql(f"SELECT {columns} FROM result").first()]
        other = [str(x) for x in duck.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()[0]]
        print(json.dumps({"query": name, "seconds": round(seconds, 1), "agrees": own == other}), flush=True)


def main(what: str, folder: str, *rest: str) -> None:
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, partitions=4 * cores, memory="16g")
    if what == "make":
        make(spark, folder, int(rest[0]) if rest else 200)
    else:
        run(spark, folder, list(rest) or NAMES)
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
