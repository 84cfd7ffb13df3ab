"""Label tables: SIC onset, and progression from SIC to DIC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.criteria import ISTH, JAAM, SIC
from daymark.functions.keys import KEYS, no_null_keys
from daymark.functions.scoring import Criterion, onset_of, score_days
from daymark.operators.checks import reject_columns, require_columns
from daymark.operators.series import Neighbour, over_stays


def _look_ahead(days: DataFrame, criteria: Sequence[Criterion], neighbour: Neighbour) -> DataFrame:
    """Add next-row status and onset to scored days; all criteria share one window."""
    days = neighbour(days, {c.tomorrow: (c.today, 1) for c in criteria})
    return days.withColumns({c.onset: onset_of(c.today, c.tomorrow) for c in criteria})


def _score_all(days: DataFrame, criteria: Sequence[Criterion]) -> DataFrame:
    for criterion in criteria:
        days = score_days(days, criterion)
    return days


def _known_ahead(days: DataFrame, criterion: Criterion, neighbour: Neighbour) -> DataFrame:
    """Scored days whose next row has a known status, with that status and onset."""
    followed = _look_ahead(days, (criterion,), neighbour)
    return followed.filter(F.col(criterion.tomorrow).isNotNull())


def _check(days: DataFrame, criteria: tuple[Criterion, ...]) -> None:
    require_columns(days, KEYS + [c for one in criteria for c in one.inputs])
    reject_columns(days, [c for one in criteria for c in one.outputs])


def label_days(days: DataFrame, *criteria: Criterion, **over) -> DataFrame:
    """Every row, with the label columns of ``criteria``.

    "Tomorrow" is the next row of the stay, whatever its date. ``over`` is
    passed on to :func:`daymark.operators.series.over_stays`.
    """
    _check(days, criteria)
    scored = _score_all(days, criteria)
    return over_stays(scored, lambda rows, look: _look_ahead(rows, criteria, look), **over)


def with_sic_labels(days: DataFrame, criterion: Criterion = SIC, **over) -> DataFrame:
    """Whole rows with their SIC labels, for all days with a known follow-up."""
    _check(days, (criterion,))
    scored = score_days(days, criterion)
    return over_stays(scored, lambda rows, look: _known_ahead(rows, criterion, look), **over)


def sic_labels(days: DataFrame, criterion: Criterion = SIC, **over) -> DataFrame:
    """Label table: keys, inputs and labels of the days with a known follow-up."""
    _check(days, (criterion,))
    return with_sic_labels(days.select(*KEYS, *criterion.inputs), criterion, **over)


def merge_in_one_pass(days: DataFrame, criterion: Criterion = SIC, **over) -> DataFrame:
    """Whole rows with their SIC labels, for the days with a known follow-up.

    Equals :func:`merge_by_join` on unique keys, without reading ``days``
    twice. A repeated key keeps one label per row. Rows with a NULL key are
    left out, as no join would match them; they are dropped before the
    window, which cannot change another row's follow-up.
    """
    return with_sic_labels(days.filter(no_null_keys()), criterion, **over)


def merge_by_join(
    days: DataFrame, labels: DataFrame, criterion: Criterion = SIC, fan_out: bool = False
) -> DataFrame:
    """Whole rows joined with a stored label table on the three keys.

    A key that repeats in ``labels`` stops the job, because the join would
    pair all rows with all labels of that key. ``fan_out`` allows the pairs.
    """
    reject_columns(days, criterion.outputs)
    labels = labels.select(*KEYS, *criterion.outputs).filter(no_null_keys())
    if not fan_out:
        labels = _one_label_per_key(labels, criterion.outputs)
    joined = days.join(labels, KEYS, "left").filter(F.col(criterion.tomorrow).isNotNull())
    return joined.select(*[f"`{c}`" for c in days.columns], *criterion.outputs)


def _one_label_per_key(labels: DataFrame, names: list[str]) -> DataFrame:
    counted = labels.groupBy(*KEYS).agg(
        *[F.first(n).alias(n) for n in names], F.count(F.lit(1)).alias("_labels")
    )
    single = F.when(F.col("_labels") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit("repeated key in the label table")).cast("boolean")
    )
    return counted.filter(single).drop("_labels")


def label_progression(
    days: DataFrame, *criteria: Criterion, sic: Criterion = SIC, **over
) -> DataFrame:
    """From patient-days to progression labels in one exchange and one sort.

    The DIC window runs over the days that the SIC follow-up kept, so a
    dropped day is skipped by "tomorrow". With several criteria all of them
    share that window.
    """
    criteria = criteria or (ISTH, JAAM)
    _check(days, (sic, *criteria))

    def step(rows: DataFrame, neighbour: Neighbour) -> DataFrame:
        kept = _known_ahead(rows, sic, neighbour)
        return _look_ahead(_score_all(kept, criteria), criteria, neighbour)

    return over_stays(score_days(days.filter(no_null_keys()), sic), step, **over)


def on_sic_days(labelled: DataFrame, criterion: Criterion, sic: Criterion = SIC) -> DataFrame:
    """Days with SIC whose DIC onset is known: the set used for modelling."""
    return labelled.filter((F.col(sic.today) == 1) & F.col(criterion.onset).isNotNull())


def sic_to_dic(
    days: DataFrame, criterion: Criterion, sic: Criterion = SIC, **over
) -> DataFrame:
    """:func:`on_sic_days` of :func:`label_progression`, with a lighter exchange.

    Days without SIC are needed to follow a stay but never leave the job, and
    they are most of the table. Columns that no rule reads therefore travel
    only with the days that have SIC.
    """
    _check(days, (sic, criterion))
    read = [c.lower() for c in (*KEYS, *sic.inputs, *criterion.inputs)]
    carried = [c for c in days.columns if c.lower() not in read]

    # The flag has to be known before the exchange; it is a function of the day.
    scored = score_days(days.filter(no_null_keys()), sic)
    load = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(carried)])
    light = scored.select(
        *[f"`{c}`" for c in days.columns if c.lower() in read],
        *sic.day_columns,
        *([F.when(F.col(sic.today) == 1, load).alias("_load")] if carried else []),
    )

    def step(rows: DataFrame, neighbour: Neighbour) -> DataFrame:
        kept = score_days(_known_ahead(rows, sic, neighbour), criterion)
        return on_sic_days(_look_ahead(kept, (criterion,), neighbour), criterion, sic)

    chosen = over_stays(light, step, **over)
    unpacked = {c: F.col(f"_load.c{i}").alias(c) for i, c in enumerate(carried)}
    return chosen.select(
        *[unpacked.get(c, F.col(f"`{c}`")) for c in days.columns],
        *sic.outputs,
        *criterion.outputs,
    )
