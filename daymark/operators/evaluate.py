"""Evaluation of predicted probabilities, overall or by group.

Ranking metrics need the number of positives above every distinct score. Rows
are first counted per distinct score; the running totals are then built on
three levels of the score's own bits, so that no window of a group ever holds
more than ``1 << LEVEL_BITS`` rows, however the scores are distributed. Scores
are told apart to the last bit, near 0 as well as near 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.keys import match

LEVEL_BITS = 21
MANTISSA_BITS = 52
SMALLEST_EXPONENT = -1074
MEAN_SCALE = 10**12  # digits of a score that go into a mean, so that sums are exact


def checked(score: str | Column) -> Column:
    """The score, or an error if it is no probability (NaN is none)."""
    score = F.col(score) if isinstance(score, str) else score
    return F.when(score.between(0, 1) | score.isNull(), score).otherwise(
        F.raise_error(F.lit("a score must be a probability")).cast("double")
    )


def _order_key(score: Column) -> Column:
    """A whole number that orders scores in [0, 1] as they are: exponent, then mantissa.

    Multiplying by powers of two is exact, so different scores get different numbers.
    """
    guess = F.floor(F.log2(score)).cast("int")
    too_high = F.pow(F.lit(2.0), guess) > score
    too_low = F.pow(F.lit(2.0), guess + 1) <= score
    exponent = F.greatest(
        guess - too_high.cast("int") + too_low.cast("int"), F.lit(SMALLEST_EXPONENT)
    )
    # Two steps, as the power itself would be beyond the largest number for tiny scores.
    half = (exponent / 2).cast("int")
    mantissa = score * F.pow(F.lit(2.0), -half) * F.pow(F.lit(2.0), half - exponent)
    above = F.shiftleft((exponent - SMALLEST_EXPONENT + 1).cast("long"), MANTISSA_BITS)
    key = above + ((mantissa - 1) * F.lit(float(1 << MANTISSA_BITS))).cast("long")
    return _never_null(F.when(score > 0, key))


def _score_of(key: Column) -> Column:
    """The score that :func:`_order_key` made into a number."""
    exponent = F.shiftright(key, MANTISSA_BITS) - 1 + SMALLEST_EXPONENT
    half = (exponent / 2).cast("int")
    fraction = key.bitwiseAND(F.lit((1 << MANTISSA_BITS) - 1)) / F.lit(float(1 << MANTISSA_BITS))
    score = (1 + fraction) * F.pow(F.lit(2.0), exponent - half) * F.pow(F.lit(2.0), half)
    return F.when(key > 0, score).otherwise(0.0)


def _never_null(column: Column) -> Column:
    """Tells the optimizer so; it would add NULL filters that keep exchanges from being shared."""
    return F.coalesce(column, F.lit(0).cast("long"))


def _known(scored: DataFrame, label: str, score: str) -> DataFrame:
    return scored.filter(F.col(label).isNotNull() & F.col(score).isNotNull())


def _with_totals_above(counts: DataFrame, within: Sequence[str], digit: str) -> DataFrame:
    above = (
        Window.partitionBy(*within)
        .orderBy(F.desc(digit))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return counts.withColumns(
        {f"_{n}_above": F.coalesce(F.sum(n).over(above), F.lit(0)) for n in ("n_pos", "n_neg")}
    )


def _last_totals(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals per key; running totals only grow, so the largest one is the total."""
    return counts.groupBy(*keys).agg(
        *[F.max(F.col(n) + F.col(f"_{n}_above")).alias(n) for n in ("n_pos", "n_neg")]
    )


def _with_carry(counts: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    names = ("_n_pos_above", "_n_neg_above")
    carry = carry.select(*keys, *[F.col(n).alias(f"{n}_carry") for n in names])
    return match(counts, carry, keys, "inner", never_null=keys[-1:]).select(
        *[c for c in counts.columns if c not in names],
        *[(F.col(n) + F.col(f"{n}_carry")).alias(n) for n in names],
    )


def _per_score(
    scored: DataFrame, label: str, score: str, groups: Sequence[str], weight: str | None
) -> DataFrame:
    """Labels (or their weights, whole numbers) counted per distinct score, with the score as a number."""

    def labels(where: Column) -> Column:
        if weight is None:
            return F.count(F.when(where, 1))
        return F.sum(F.when(where, F.col(weight).cast("long")).otherwise(0))

    return (
        _known(scored, label, score)
        .groupBy(*groups, checked(score).alias("score"))
        .agg(labels(F.col(label) == 1).alias("n_pos"), labels(F.col(label) != 1).alias("n_neg"))
        .withColumn("_key", _order_key(F.col("score")))
        .drop("score")
        .withColumn("_middle", _never_null(F.shiftright("_key", LEVEL_BITS)))
    )


def ranking_curve(
    scored: DataFrame,
    label: str = "label",
    score: str = "score",
    groups: Sequence[str] = (),
) -> DataFrame:
    """One row per distinct score (and group) with running totals.

    ``n_pos``/``n_neg`` count labels at the score, ``tp``/``fp`` those at or
    above it.
    """
    groups = list(groups)
    per_score = _per_score(scored, label, score, groups, None)
    # Each level is counted from the running totals of the finer one, which has
    # just been brought together by that level's bits: no exchange of its own.
    by_score = _with_totals_above(per_score, [*groups, "_middle"], "_key")
    per_middle = _last_totals(by_score, [*groups, "_middle"]).withColumn(
        "_top", _never_null(F.shiftright("_middle", LEVEL_BITS))
    )
    by_middle = _with_totals_above(per_middle, [*groups, "_top"], "_middle")
    by_top = _with_totals_above(_last_totals(by_middle, [*groups, "_top"]), groups, "_top")

    by_middle = _with_carry(by_middle, by_top, [*groups, "_top"])
    curve = _with_carry(by_score, by_middle, [*groups, "_middle"])
    return curve.select(
        *groups,
        _score_of(F.col("_key")).alias("score"),
        "n_pos",
        "n_neg",
        (F.col("_n_pos_above") + F.col("n_pos")).alias("tp"),
        (F.col("_n_neg_above") + F.col("n_neg")).alias("fp"),
    )


def _whole(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def auroc_columns() -> list[Column]:
    """Aggregates over a ranking curve; a tie counts as half a win.

    Pairs split into wins, losses and ties, so twice (wins + ties / 2) is
    pairs + wins - losses.
    """
    positives, negatives = F.sum("n_pos"), F.sum("n_neg")
    wins = F.sum(_whole(F.col("n_neg")) * _whole(F.col("tp") - F.col("n_pos")))
    losses = F.sum(_whole(F.col("n_pos")) * _whole(F.col("fp") - F.col("n_neg")))
    pairs = _whole(positives) * _whole(negatives)
    return [
        positives.alias("n_pos"),
        negatives.alias("n_neg"),
        F.try_divide((pairs + wins - losses).cast("double"), 2 * pairs.cast("double")).alias(
            "auroc"
        ),
    ]


def auprc_column() -> Column:
    """Average precision: precision at each distinct score, weighted by its positives."""
    precision = F.col("tp").cast("double") / (F.col("tp") + F.col("fp"))
    return F.try_divide(F.sum(F.col("n_pos") * precision), F.sum("n_pos")).alias("auprc")


def _with_lead(counts: DataFrame, within: Sequence[str], digit: str) -> DataFrame:
    """``_lead`` grows by the pairs that differ first in ``digit``: wins less losses, exact."""
    above = _with_totals_above(counts, within, digit)
    wins = _whole(F.col("n_neg")) * _whole(F.col("_n_pos_above"))
    losses = _whole(F.col("n_pos")) * _whole(F.col("_n_neg_above"))
    return above.withColumn("_lead", (F.col("_lead") + (wins - losses)).cast("decimal(38,0)"))


def _summed(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return counts.groupBy(*keys).agg(
        F.sum("n_pos").alias("n_pos"),
        F.sum("n_neg").alias("n_neg"),
        F.sum("_lead").cast("decimal(38,0)").alias("_lead"),
    )


def auroc(
    scored: DataFrame,
    label="label",
    score="score",
    groups: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Share of pairs of a positive and a negative that the score ranks rightly, a tie as half.

    Two scores differ first on one of the three levels of their bits; each
    level counts its own pairs and hands its totals up, so nothing is handed
    down again as for the whole curve. ``weight`` names a column of whole
    numbers that rows count for.
    """
    groups = list(groups)
    start = _per_score(scored, label, score, groups, weight).withColumn("_lead", F.lit(0).cast("decimal(38,0)"))
    by_score = _with_lead(start, [*groups, "_middle"], "_key")
    per_middle = _summed(by_score, [*groups, "_middle"]).withColumn(
        "_top", _never_null(F.shiftright("_middle", LEVEL_BITS))
    )
    per_top = _summed(_with_lead(per_middle, [*groups, "_top"], "_middle"), [*groups, "_top"])
    total = _summed(_with_lead(per_top, groups, "_top"), groups)
    pairs = _whole(F.col("n_pos")) * _whole(F.col("n_neg"))
    share = F.try_divide((pairs + F.col("_lead")).cast("double"), 2 * pairs.cast("double"))
    return total.select(*groups, "n_pos", "n_neg", share.alias("auroc"))


def auprc(scored: DataFrame, label="label", score="score", groups: Sequence[str] = ()) -> DataFrame:
    return (
        ranking_curve(scored, label, score, groups)
        .groupBy(*groups)
        .agg(F.sum("n_pos").alias("n_pos"), F.sum("n_neg").alias("n_neg"), auprc_column())
    )


def _rates(counts: DataFrame) -> DataFrame:
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    return counts.withColumns(
        {
            "sensitivity": F.try_divide(tp, tp + fn),
            "specificity": F.try_divide(tn, tn + fp),
            "ppv": F.try_divide(tp, tp + fp),
            "npv": F.try_divide(tn, tn + fn),
            "f1": F.try_divide(2 * tp, 2 * tp + fp + fn),
        }
    )


def confusion(
    scored: DataFrame,
    threshold: float = 0.5,
    label: str = "label",
    score: str = "score",
    groups: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts and the rates from them; positive means at or above ``threshold``."""
    positive, called = F.col(label) == 1, checked(score) >= F.lit(float(threshold))

    def rows(condition: Column, name: str) -> Column:
        return F.count(F.when(condition, 1)).alias(name)

    counts = (
        _known(scored, label, score)
        .groupBy(*groups)
        .agg(
            rows(positive & called, "tp"),
            rows(~positive & called, "fp"),
            rows(~positive & ~called, "tn"),
            rows(positive & ~called, "fn"),
        )
    )
    return _rates(counts)


def calibration(
    scored: DataFrame,
    bins: int = 10,
    label: str = "label",
    score: str = "score",
    groups: Sequence[str] = (),
) -> DataFrame:
    """Mean score against observed rate in equal-width score bins (1.0 joins the last)."""
    value = checked(score)
    digits = _whole(F.round(value * F.lit(float(MEAN_SCALE))).cast("long"))
    n = F.count(F.lit(1))
    return (
        _known(scored, label, score)
        .groupBy(
            *groups,
            F.least(F.floor(value * bins), F.lit(bins - 1)).cast("int").alias("bin"),
        )
        .agg(
            n.alias("n_rows"),
            F.count(F.when(F.col(label) == 1, 1)).alias("n_pos"),
            (F.sum(digits).cast("double") / (n * F.lit(float(MEAN_SCALE)))).alias("mean_score"),
            (F.count(F.when(F.col(label) == 1, 1)) / n).alias("observed_rate"),
        )
    )


def summary(
    scored: DataFrame,
    threshold: float = 0.5,
    label: str = "label",
    score: str = "score",
    groups: Sequence[str] = (),
) -> DataFrame:
    """AUROC, AUPRC, confusion counts and rates in one row per group.

    Everything is taken from the ranking curve, so the rows are read once.
    """
    called = F.col("score") >= F.lit(float(threshold))
    counts = [
        F.coalesce(F.sum(F.when(when, F.col(n))), F.lit(0).cast("long")).alias(name)
        for name, n, when in (
            ("tp", "n_pos", called),
            ("fp", "n_neg", called),
            ("tn", "n_neg", ~called),
            ("fn", "n_pos", ~called),
        )
    ]
    curve = ranking_curve(scored, label, score, groups)
    return _rates(curve.groupBy(*groups).agg(*auroc_columns(), auprc_column(), *counts))
