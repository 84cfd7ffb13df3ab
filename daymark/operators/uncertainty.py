"""How sure a ranking metric is: a bootstrap over subjects, from weights that are the same on every run."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.keys import match
from daymark.operators.evaluate import auroc

DRAW_BITS = 32
MOST_OFTEN = 12  # a weight above it has a chance below 1e-10, less than one draw


def poisson_cuts(draws: int = 1 << DRAW_BITS) -> list[int]:
    """A draw below the k-th cut, and not below an earlier one, has weight k: Poisson with mean 1."""
    shares = [math.exp(-1) / math.factorial(k) for k in range(MOST_OFTEN)]
    return [math.floor(draws * sum(shares[: k + 1])) for k in range(MOST_OFTEN)]


def _draw(subject: Column, replicate: Column) -> Column:
    """A hash of both as hexadecimal digits, which are ordered as the numbers they stand for."""
    text = F.concat_ws(":", subject.cast("string"), replicate.cast("string"))
    return F.substring(F.md5(text.cast("binary")), 1, DRAW_BITS // 4)


def _weight_of(draw: Column) -> Column:
    """How many of the cuts are not above the draw. ``draw`` is read once for each cut, so it has to be a plain column."""
    reached = [(draw >= F.lit(f"{cut:0{DRAW_BITS // 4}x}")).cast("int") for cut in poisson_cuts()]
    return reduce(lambda a, b: a + b, reached)


def subject_weight(subject: Column, replicate: Column) -> Column:
    """How often a subject counts in a replicate, from a hash of both alone."""
    # As the only element of an array the hash is worked out once for all cuts.
    return F.element_at(F.transform(F.array(_draw(subject, replicate)), _weight_of), 1)


def replicated(
    scored: DataFrame, replicates: int, subject: str = "subject_id", keep: Sequence[str] = ()
) -> DataFrame:
    """Every row once for each replicate in which its subject counts, with ``replicate`` and ``weight``.

    All rows of a subject have one weight, as days of one patient are not
    independent. Replicate 0 is the data as they are. Rows without a subject
    are left out.
    """
    rows = scored.filter(F.col(subject).isNotNull()).select(subject, *keep)
    numbered = rows.withColumn("replicate", F.explode(F.sequence(F.lit(0), F.lit(replicates))))
    # The hash is a column of its own, and the filter names it once: the optimizer repeats
    # an expression wherever a filter or a later column stands for it.
    drawn = numbered.withColumn("_draw", _draw(F.col(subject), F.col("replicate")))
    least = f"{poisson_cuts()[0]:0{DRAW_BITS // 4}x}"
    counted = drawn.filter((F.col("replicate") == 0) | (F.col("_draw") >= least))
    weight = F.when(F.col("replicate") == 0, 1).otherwise(_weight_of(F.col("_draw")))
    return counted.withColumn("weight", weight).drop("_draw")


def auroc_replicates(
    scored: DataFrame,
    replicates: int = 200,
    label: str = "label",
    score: str = "score",
    groups: Sequence[str] = (),
    subject: str = "subject_id",
) -> DataFrame:
    """AUROC of each group in each replicate, from one pass over the rows.

    Rows multiply within the task that reads them and are added up per
    replicate, group and distinct score before the shuffle.
    """
    rows = replicated(scored, replicates, subject, [*groups, label, score])
    return auroc(rows, label, score, [*groups, "replicate"], weight="weight")


def _interval(value: Column, level: float) -> list[Column]:
    low, high = (1 - level) / 2, (1 + level) / 2
    drawn = F.when(F.col("replicate") > 0, value)
    return [
        F.max(F.when(F.col("replicate") == 0, value)).alias("auroc"),
        F.count(drawn).alias("n_replicates"),
        F.percentile(drawn, F.lit(low)).alias("low"),
        F.percentile(drawn, F.lit(high)).alias("high"),
    ]


def auroc_intervals(by_replicate: DataFrame, groups: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """AUROC of each group with the percentile interval of its replicates.

    Replicates in which a group has no pair have no AUROC and don't count;
    ``n_replicates`` tells how many do.
    """
    return by_replicate.groupBy(*groups).agg(*_interval(F.col("auroc"), level))


def auroc_differences(by_replicate: DataFrame, group: str, level: float = 0.95) -> DataFrame:
    """AUROC of one group less that of another, for every two groups, with its percentile interval.

    Both are taken from the same replicate, so that subjects shared by chance
    don't widen the interval. There is one row for each two groups, of which
    there are as many as a report can hold.
    """
    first = by_replicate.select(F.col(group).alias("first_group"), "replicate", F.col("auroc").alias("_a"))
    second = by_replicate.select(F.col(group).alias("second_group"), "replicate", F.col("auroc").alias("_b"))
    both = match(first, second, ["replicate"], "inner", never_null=["replicate"])
    apart = both.filter("first_group < second_group")
    value = F.col("_a") - F.col("_b")
    return apart.groupBy("first_group", "second_group").agg(*_interval(value, level)).withColumnRenamed(
        "auroc", "difference"
    )
