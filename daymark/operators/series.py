"""Looking at the neighbouring day of a stay, at any size of stay.

``over_stays`` runs a step that needs LEAD or LAG. If days are unique, a window
over the stay is the best plan: one exchange, one sort, shared by every window of
the step, and the calendar bounds a stay.

A table with repeated days, copied rows or missing ids can hold a stay, or a
day of one, that is far too big for one task. Without ``unique_days`` every stay
therefore takes a way on which no window holds more than a slice of a day, or
one row for each slice of a stay's days:

* equal rows are one row with a count, combined before the shuffle. Which of them
  comes first makes no difference;
* rows of a day stand in the order of a hash of their content (or of the ``ties``
  columns), so the result does not depend on partitions or on a rerun;
* the first digits of that hash are the slice. Each slice sends its first (or
  last) few rows to the slices before (or after) it, in its own day or the next.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from daymark.functions.keys import DAY, STAY

Neighbour = Callable[[DataFrame, Mapping[str, tuple[str, int]]], DataFrame]
Step = Callable[[DataFrame, Neighbour], DataFrame]

SLICE_DIGITS = 2  # hexadecimal: 256 slices of a day
COPIES_AT_ONCE = 10_000

# Keys of a counted row. As structs they are never NULL, so that plain equality
# also finds rows with a NULL id or day, and joins and windows share exchanges.
SLICED_DAY = ["_stay", "_day", "_slice"]
COUNTED = [*SLICED_DAY, "_tie", "_copies"]


def neighbour_in_window(days: DataFrame, columns: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Add ``{new: (old, step)}``: the value of ``old`` that many rows ahead in the stay.

    A negative step looks back. All columns of one call share one window.
    """
    stay = Window.partitionBy(*STAY).orderBy(DAY)
    return days.withColumns(
        {new: F.lead(old, step).over(stay) for new, (old, step) in columns.items()}
    )


def over_stays(
    days: DataFrame, step: Step, unique_days: bool = False, ties: Sequence[str] = ()
) -> DataFrame:
    """Run ``step(rows, neighbour)``; it may add columns and filter rows.

    ``unique_days`` states that no ``(subject, stay, day)`` repeats, NULL keys
    included, as in a table grouped by those keys or one for which
    ``key_report`` finds no repeated key.

    Otherwise rows of the same day follow each other in the order of
    :func:`tie_break`, the MD5 of the ``ties`` columns as JSON (all columns by default). Rows that agree in
    ``ties`` but differ elsewhere are ordered by the MD5 of the whole row.
    """
    if days.schema[DAY].dataType != T.DateType():
        raise ValueError(f"{DAY} must be a date")
    if unique_days:
        return step(days, neighbour_in_window)
    done = step(_counted(days, ties), neighbour_in_slices)
    return _one_row_per_copy(done).drop(*COUNTED)


def tie_break(columns: Sequence[str]) -> Column:
    return F.md5(F.to_json(F.struct(*columns)).cast("binary"))


def _counted(days: DataFrame, ties: Sequence[str]) -> DataFrame:
    """One row for all that have the same content, with their number; combined before the shuffle."""
    names = [f"`{c}`" for c in days.columns]
    content = tie_break(names)
    tie = F.concat(tie_break(ties), content) if ties else content
    keyed = days.select(
        F.struct(*STAY).alias("_stay"),
        F.struct(DAY).alias("_day"),
        F.substring(tie, 1, SLICE_DIGITS).alias("_slice"),
        tie.alias("_tie"),
        F.struct(*names).alias("_row"),
    )
    once = keyed.groupBy(*SLICED_DAY, "_tie").agg(
        F.first("_row").alias("_row"), F.count(F.lit(1)).alias("_copies")
    )
    return once.select(*[F.col("_row")[c].alias(c) for c in days.columns], *COUNTED)


def neighbour_in_slices(days: DataFrame, columns: Mapping[str, tuple[str, int]]) -> DataFrame:
    """``neighbour_in_window`` for counted rows.

    Copies of a row see each other; the last few also what follows, the first few what is before. So a
    row becomes as many as there are different views, each with its count.
    """
    ahead = max((k for _, k in columns.values() if k > 0), default=0)
    back = max((-k for _, k in columns.values() if k < 0), default=0)
    olds = list(dict.fromkeys(old for old, _ in columns.values()))
    here = {old: f"c{i}" for i, old in enumerate(olds)}
    days = days.withColumn("_here", F.struct(*[F.col(o).alias(n) for o, n in here.items()]))
    for reach, forward, name in ((ahead, True, "_after"), (back, False, "_before")):
        if reach:
            days = _with_rows_beyond(days, reach, forward, name)

    cells = F.least(F.col("_copies"), F.lit(back + ahead + 1))
    days = days.withColumn("_cell", F.explode(F.sequence(F.lit(0).cast("long"), cells - 1)))
    to_start = F.least("_cell", F.lit(back))
    to_end = F.least(cells - 1 - F.col("_cell"), F.lit(ahead))
    in_middle = F.col("_copies") - cells + 1

    def seen(old: str, k: int) -> Column:
        copies, others = (to_end, "_after") if k > 0 else (to_start, "_before")
        other = F.get(F.col(others), (F.lit(abs(k) - 1) - copies).cast("int"))
        return F.when(copies >= abs(k), F.col(old)).otherwise(other[here[old]])

    days = days.withColumns({new: seen(old, k) for new, (old, k) in columns.items()})
    return days.withColumns(
        {
            "_copies": F.when(F.col("_cell") == back, in_middle).otherwise(1),
            "_tie": F.concat("_tie", F.lpad(F.col("_cell").cast("string"), 4, "0")),
        }
    ).drop("_here", "_after", "_before", "_cell")


def _with_rows_beyond(days: DataFrame, reach: int, forward: bool, name: str) -> DataFrame:
    """Add the values of the next ``reach`` rows of the stay (or the ones before), copies included."""

    def order(column: str) -> Column:
        return F.asc(column) if forward else F.desc(column)

    def first_rows(own: Column, near: Column) -> Column:
        return F.slice(F.concat(own, near), 1, reach)

    def following(column: Column, rows: WindowSpec) -> Column:
        return F.slice(F.flatten(F.collect_list(column).over(rows.rowsBetween(1, reach))), 1, reach)

    in_slice = Window.partitionBy(*SLICED_DAY).orderBy(order("_tie"))
    own = F.array_repeat(F.col("_here"), F.least("_copies", F.lit(reach)).cast("int"))
    days = days.withColumn("_own", own).withColumns(
        {"_near": following(F.col("_own"), in_slice), "_nth": F.row_number().over(in_slice)}
    )
    # The first row of a slice speaks for it; the calendar and the digits bound the slices of a stay.
    slices = days.filter("_nth = 1").select(*SLICED_DAY, first_rows(F.col("_own"), F.col("_near")).alias("_first"))
    in_stay = Window.partitionBy("_stay").orderBy(order("_day"), order("_slice"))
    beyond = slices.select(*SLICED_DAY, following(F.col("_first"), in_stay).alias("_beyond"))
    days = days.join(beyond, SLICED_DAY)
    return days.withColumn(name, first_rows(F.col("_near"), F.col("_beyond"))).drop("_own", "_near", "_nth", "_beyond")


def _one_row_per_copy(rows: DataFrame) -> DataFrame:
    """Write out the copies; those of one row are dealt over tasks in parts."""
    many = rows.filter("_copies > 1").withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, F.lit(COPIES_AT_ONCE).cast("long")))
    )
    part = F.least(F.lit(COPIES_AT_ONCE), F.col("_copies") - F.col("_from"))
    # As many parts as the session has: their rows are few and small before they are written out.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    many = many.repartition(parts, "_tie", "_from").withColumn("_copy", F.explode(F.sequence(F.lit(1), part.cast("int"))))
    return rows.filter("_copies = 1").unionByName(many.drop("_from", "_copy"))
