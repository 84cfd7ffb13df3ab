"""The next calendar day, beside the next recorded one.

"Tomorrow" of the label tables is the next row of the stay, however far off.
Here it is the following date: a status is known only if the stay has a row on
that very day, so that a label speaks of the next 24 hours.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.keys import DAY, STAY, match, over_calendar
from daymark.functions.scoring import Criterion, onset_of, score_days
from daymark.operators.checks import reject_columns
from daymark.operators.labels import label_days
from daymark.operators.series import tie_break

def tomorrow_by_date(criterion: Criterion) -> str:
    return f"{criterion.tomorrow}_by_date"


def onset_by_date(criterion: Criterion) -> str:
    return f"{criterion.onset}_by_date"


def with_status_by_date(
    days: DataFrame, columns: dict[str, str], unique_days: bool = False, ties: Sequence[str] = ()
) -> DataFrame:
    """Add ``{new: old}``: the value of ``old`` on the following date of the stay, NULL without one.

    A frame of exactly one day ahead shares the exchange and the sort of
    LEAD. Where days may repeat, the first row of a day speaks for it, in the
    order of :func:`daymark.operators.series.over_stays`; each day is reduced
    to that row before the shuffle, and a join finds the date.
    """
    reject_columns(days, columns)
    if unique_days:
        following = {new: over_calendar(f"first(`{old}`)", "1 FOLLOWING AND 1 FOLLOWING") for new, old in columns.items()}
        return days.withColumns({new: F.when(F.col(DAY).isNotNull(), value) for new, value in following.items()})
    content = tie_break([f"`{c}`" for c in days.columns])
    order = F.concat(tie_break(ties), content) if ties else content
    carried = F.struct(*[F.col(old).alias(f"c{i}") for i, old in enumerate(columns.values())])
    per_day = days.filter(F.col(DAY).isNotNull()).groupBy(*STAY, F.date_sub(DAY, 1).alias(DAY)).agg(
        F.min_by(carried, order).alias("_following")
    )
    found = match(days, per_day, [*STAY, DAY])
    return found.withColumns({new: F.col(f"_following.c{i}") for i, new in enumerate(columns)}).drop("_following")


def label_days_by_date(
    days: DataFrame, *criteria: Criterion, unique_days: bool = False, ties: Sequence[str] = ()
) -> DataFrame:
    """Every row with the label columns of ``criteria``, and both looks ahead side by side.

    ``<tomorrow>_by_date`` and ``<onset>_by_date`` follow the calendar,
    ``<tomorrow>`` and ``<onset>`` the recorded days.
    """
    scored = days
    for criterion in criteria:
        scored = score_days(scored, criterion)
    ahead = {tomorrow_by_date(c): c.today for c in criteria}
    dated = with_status_by_date(scored, ahead, unique_days, ties).select(
        *[f"`{c}`" for c in days.columns], *ahead
    )
    labelled = label_days(dated, *criteria, unique_days=unique_days, ties=ties)
    return labelled.withColumns({onset_by_date(c): onset_of(c.today, tomorrow_by_date(c)) for c in criteria})


def _rows_where(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def follow_up_distances(days: DataFrame, criterion: Criterion) -> DataFrame:
    """How far off the next recorded day is, and what that does to the labels; days must be unique.

    One row for each distance in days (NULL: no further row): rows, known
    follow-ups and onsets under both definitions, and rows on which the onset
    labels differ, an unknown one included.
    """
    stay = Window.partitionBy(*STAY).orderBy(DAY)
    labelled = label_days_by_date(days, criterion, unique_days=True)
    ahead = labelled.withColumn("distance", F.datediff(F.lead(DAY).over(stay), F.col(DAY)))
    by_row, by_date = F.col(criterion.onset), F.col(onset_by_date(criterion))
    return ahead.groupBy("distance").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(by_row).alias("n_known_by_row"),
        F.count(by_date).alias("n_known_by_date"),
        _rows_where(by_row == 1).alias("n_onsets_by_row"),
        _rows_where(by_date == 1).alias("n_onsets_by_date"),
        _rows_where(~by_row.eqNullSafe(by_date)).alias("n_labels_differ"),
    )
