"""Chat formatting: who speaks in a transcript, by a hidden Markov model over its lines.

States are roles, each as the first line of a turn or a later one. A line shows a speaker
marker ("User:", "### Assistant", ...) or none, its length, its last character and whether it looks like a list
item or code. Viterbi's path gives roles and turns, which are rendered in one canonical form.

A transcript may be of any length. Its rows are numbered and cut into segments; each gives the best score from
any entering to any leaving state, a small matrix. The matrices of some segments are multiplied (a sum for each step, the
best for each choice), the products are chained for each transcript, and what they say is handed back to the
segments, each of which follows its own part of the path. Turns that cross a border are put together. The result is
the path of the whole, whatever the size of a segment.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import let_workers_import, map_batches

ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)  # 2 r: the first line of a turn of role r, 2 r + 1: a later line
START = STATES  # before the first line

# Names that speakers go by.
NAMES = {
    "system": "system",
    "instructions": "system",
    "user": "user",
    "human": "user",
    "question": "user",
    "q": "user",
    "assistant": "assistant",
    "ai": "assistant",
    "bot": "assistant",
    "gpt": "assistant",
    "answer": "assistant",
    "a": "assistant",
}
MARKER = re.compile(r"^\s*(?:<\|(\w+)\|>|#{1,4}\s*(\w+)\s*:?\s*$|\[?(\w+)\]?\s*:)\s*", re.IGNORECASE)
LENGTHS = (1, 20, 60, 120, 240, 480, 1000)
# A line's features as one number each: marker, length, ending, shape.
SIZES = (1 + len(ROLES), len(LENGTHS) + 1, 4, 3)


def marker(line: str) -> tuple[int, str]:
    """0 or 1 + the role that the line names, and the line without the marker."""
    found = MARKER.match(line)
    name = found and next(g for g in found.groups() if g is not None)
    role = NAMES.get(name.lower()) if name else None
    return (1 + ROLES.index(role), line[found.end() :]) if role else (0, line)


def line_features(line: str) -> tuple[int, ...]:
    named, rest = marker(line)
    length = int(np.searchsorted(LENGTHS, len(rest), side="right"))
    end = rest.rstrip()[-1:]
    ending = 1 if end == "?" else 2 if end in (".", "!") and end else 3 if not end else 0
    shape = 1 if re.match(r"\s*([-*•]|\d+[.)])\s", rest) else 2 if re.match(r"\s*(```|\t| {4})", rest) else 0
    return named, length, ending, shape


@dataclass
class RoleModel:
    """Logarithms of the probabilities of transitions (the last row: from the start) and features."""

    transitions: np.ndarray
    features: list[np.ndarray]

    def lines(self, lines: list[str]) -> np.ndarray:
        """The log probability of each line in each state."""
        rows = np.array([line_features(x) for x in lines], dtype=np.int64).reshape(-1, len(SIZES))
        return sum(table[:, rows[:, i]].T for i, table in enumerate(self.features))


def _steps(model: RoleModel, shown: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Viterbi over the lines from ``begin`` (score of each state before, start included): scores and choices."""
    score, choices = begin, []
    for row in shown:
        ways = score[:, None] + model.transitions
        choices.append(ways.argmax(axis=0))
        score = np.concatenate([ways.max(axis=0) + row, [-np.inf]])
    return score, choices


def segment_matrix(model: RoleModel, lines: list[str]) -> np.ndarray:
    """Best scores from each state before the segment (rows, start last) to each state at its end."""
    out = np.full((STATES + 1, STATES + 1), -np.inf)
    np.fill_diagonal(out, 0.0)
    for row in model.lines(lines):
        best = (out[:, :, None] + model.transitions[None, :, :]).max(axis=1) + row
        out = np.concatenate([best, np.full((STATES + 1, 1), -np.inf)], axis=1)
    return out


def product(matrices: list[np.ndarray]) -> np.ndarray:
    """Best scores over several segments."""
    out = matrices[0]
    for matrix in matrices[1:]:
        out = (out[:, :, None] + matrix[None, :, :]).max(axis=1)
    return out


def chain(matrices: list[np.ndarray], before: int = START, end: int | None = None) -> list[tuple[int, int]]:
    """The states before and at the end of each segment, on the best path through all (between two given states)."""
    score = np.full(STATES + 1, -np.inf)
    score[before] = 0
    choices = []
    for matrix in matrices:
        ways = score[:, None] + matrix
        choices.append(ways.argmax(axis=0))
        score = ways.max(axis=0)
    ends, state = [], int(score.argmax()) if end is None else end
    for choice in reversed(choices):
        entered = int(choice[state])
        ends.append((entered, state))
        state = entered
    return ends[::-1]


def path(model: RoleModel, lines: list[str], before: int = START, end: int | None = None) -> list[int]:
    """The best states of the lines between two given ones; without an end, of a whole transcript."""
    begin = np.full(STATES + 1, -np.inf)
    begin[before] = 0
    score, choices = _steps(model, model.lines(lines), begin)
    states = [int(score.argmax()) if end is None else end]
    for choice in reversed(choices[1:]):
        states.append(int(choice[states[-1]]))
    return states[::-1]


def _features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(role, text) of turns -> counts of (feature, state, value) among their lines."""
    counts: dict[tuple[int, int, int], int] = {}
    for batch in batches:
        for role, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for i, line in enumerate(text.split("\n")):
                state = 2 * ROLES.index(role) + (i > 0)
                for feature, value in enumerate(line_features(line)):
                    key = (feature, state, value)
                    counts[key] = counts.get(key, 0) + 1
            key = (len(SIZES), 2 * ROLES.index(role), text.count("\n"))
            counts[key] = counts.get(key, 0) + 1
    columns = list(zip(*(k + (n,) for k, n in counts.items()), strict=True)) or [[]] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())],
        names=["feature", "state", "value", "n"],
    )


SLICE_DIGITS = 2  # hexadecimal: 256 slices of a place
TURNS_PER_BLOCK = 1024
SEGMENTS_PER_GROUP = 64
PLACE = ("conv_id", "turn", "slice")


def distinct_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, slice, tie, role, text: rows equal in conv_id, turn, role and text once, a null turn as -1.

    Rows of one place follow each other in the order of ``tie``, a hash of role and text whose first digits
    are the slice. So any number of rows may share a place, and copies change nothing.
    """
    turns = turns.select("conv_id", F.coalesce("turn", F.lit(-1).cast("long")).alias("turn"), "role", "text")
    tie = F.md5(F.to_json(F.struct("text", "role")).cast("binary"))
    rows = turns.dropDuplicates(["conv_id", "turn", "role", "text"]).withColumn("tie", tie)
    return rows.select(
        "conv_id", "turn", F.substring("tie", 1, SLICE_DIGITS).alias("slice"), "tie", "role", F.coalesce("text", F.lit("")).alias("text")
    )


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with their number in the transcript, from 0, counted by places and by blocks of turns, and ``all``, how many it has."""
    keyed = rows.withColumns({"_conv": F.struct("conv_id"), "_block": F.floor(F.col("turn") / TURNS_PER_BLOCK)})
    place = ["_conv", "_block", "turn", "slice"]
    keyed = keyed.withColumn("_nth", F.row_number().over(Window.partitionBy(*place).orderBy("tie")) - 1)

    def before(*keys: str, order: list[str]) -> F.Column:
        earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        return F.coalesce(F.sum("_n").over(earlier), F.lit(0))

    places = keyed.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    blocks = places.groupBy("_conv", "_block").agg(F.sum("_n").alias("_n"))
    in_all = F.sum("_n").over(Window.partitionBy("_conv"))
    from_block = blocks.select("_conv", "_block", before("_conv", order=["_block"]).alias("_from"), in_all.alias("all"))
    starts = places.withColumn("_at", before("_conv", "_block", order=["turn", "slice"])).drop("_n")
    starts = starts.join(from_block, ["_conv", "_block"])
    row = F.col("_from") + F.col("_at") + F.col("_nth")
    return keyed.join(starts, place).select("conv_id", "turn", "text", row.alias("row"), "all")


def _following(known: DataFrame) -> DataFrame:
    """_before, role and count: roles of rows and of those before them, null at a start or after a gap."""
    in_slice = Window.partitionBy(*PLACE).orderBy("tie")
    slices = Window.partitionBy("conv_id", "turn").orderBy("slice")
    inner = known.withColumn("_before", F.lag("role").over(in_slice)).filter("_before IS NOT NULL")
    ends = known.groupBy(*PLACE).agg(
        F.min_by("role", "tie").alias("role"), F.max_by("role", "tie").alias("_end")
    )
    chained = ends.withColumn("_within", F.lag("_end").over(slices))
    last = ends.groupBy("conv_id", "turn").agg(F.max_by("_end", "slice").alias("_earlier"))
    last = last.select(F.col("conv_id").alias("_conv"), (F.col("turn") + 1).alias("_turn"), "_earlier")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("turn") == F.col("_turn"))
    heads = chained.join(last, same, "left").select(F.coalesce("_within", "_earlier").alias("_before"), "role")
    return inner.select("_before", "role").unionByName(heads).groupBy("_before", "role").count()


def train(turns: DataFrame, usable: F.Column | None = None) -> RoleModel:
    """Count transitions and features in ``turns`` of known roles (conv_id, turn, role, text), each plus one.

    ``text`` may begin with a speaker marker, as in a transcript. What is collected are counts: a fixed
    number for each state and feature.
    """
    known = distinct_rows(turns.filter(usable) if usable is not None else turns)
    known = known.withColumn("role", F.lower("role")).filter(F.col("role").isin(*ROLES))
    counted = map_batches(known.select("role", "text"), _features_of, "feature int, state int, value long, n long")
    is_lines = F.col("feature") == len(SIZES)
    summed = counted.groupBy(
        "feature", "state", F.when(is_lines, F.least("value", F.lit(1))).otherwise(F.col("value")).alias("v")
    ).agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("value")).alias("total"))
    features = [np.ones((STATES, size)) for size in SIZES]
    turns_of, later_lines = np.ones(len(ROLES)), np.ones(len(ROLES))
    for r in summed.collect():
        if r["feature"] == len(SIZES):
            turns_of[r["state"] // 2] += r["n"]
            later_lines[r["state"] // 2] += r["total"]
        else:
            features[r["feature"]][r["state"], r["v"]] += r["n"]
    follows = _following(known).collect()
    next_role = np.ones((len(ROLES) + 1, len(ROLES)))
    for r in follows:
        row = len(ROLES) if r["_before"] is None else ROLES.index(r["_before"])
        next_role[row, ROLES.index(r["role"])] += r["count"]
    next_role /= next_role.sum(axis=1, keepdims=True)
    transitions = np.zeros((STATES + 1, STATES))
    for role in range(len(ROLES)):
        on = later_lines[role] / (later_lines[role] + turns_of[role])
        for state in (2 * role, 2 * role + 1):
            transitions[state, 0::2] = (1 - on) * next_role[role]
            transitions[state, 2 * role + 1] = on
    transitions[START, 0::2] = next_role[len(ROLES)]
    with np.errstate(divide="ignore"):
        logs = np.log(transitions)
    return RoleModel(logs, [np.log(f / f.sum(axis=1, keepdims=True)) for f in features])


def _lines(table: pa.Table) -> tuple[list[tuple[int, int]], list[str]]:
    rows = sorted(zip(*(table[c].to_pylist() for c in ("row", "turn", "text")), strict=True))
    places, lines = [], []
    for _, turn, text in rows:
        for i, line in enumerate(text.split("\n")):
            places.append((turn, i))
            lines.append(line)
    return places, lines


def _decoded(matrices: list[bytes]) -> list[np.ndarray]:
    return [np.frombuffer(m).reshape(STATES + 1, STATES + 1) for m in matrices]


def _one_matrix(table: pa.Table, key: str, matrix: np.ndarray) -> pa.Table:
    columns = {"conv_id": table["conv_id"][:1], key: table[key][:1], "matrix": pa.array([matrix.tobytes()], pa.binary())}
    return pa.table(columns)


def _matrix(model: RoleModel) -> Callable:
    return lambda table: _one_matrix(table, "segment", segment_matrix(model, _lines(table)[1]))


def _in_order(table: pa.Table) -> tuple[list[int], list[np.ndarray]]:
    rows = sorted(zip(table["segment"].to_pylist(), table["matrix"].to_pylist(), strict=True))
    return [s for s, _ in rows], _decoded([m for _, m in rows])


def _multiply(table: pa.Table) -> pa.Table:
    return _one_matrix(table, "group", product(_in_order(table)[1]))


def _ends(conv: int | None, name: str, places: list[int], ends: list[tuple[int, int]]) -> dict:
    return {
        "conv_id": pa.array([conv] * len(places), pa.int64()),
        name: pa.array(places, pa.int64()),
        "before": pa.array([e[0] for e in ends], pa.int32()),
        "end": pa.array([e[1] for e in ends], pa.int32()),
    }


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products sorted by (conv_id, group): the states around each of them."""

    def ended(conv: int | None, rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
        found = chain(_decoded([m for _, m in rows]))
        return pa.RecordBatch.from_pydict(_ends(conv, "group", [g for g, _ in rows], found))

    conv, rows = None, []
    for batch in batches:
        for own, group, matrix in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if rows and own != conv:
                yield ended(conv, rows)
                rows = []
            conv = own
            rows.append((group, matrix))
    if rows:
        yield ended(conv, rows)


def _inside(table: pa.Table, around: pa.Table) -> pa.Table:
    """The states around each segment of a group, from those around the group."""
    segments, matrices = _in_order(table)
    found = chain(matrices, around["before"][0].as_py(), around["end"][0].as_py())
    return pa.table(_ends(table["conv_id"][0].as_py(), "segment", segments, found))


def render(role: str, lines: list[str]) -> str:
    """The canonical form of a turn."""
    body = "\n".join([marker(lines[0])[1], *lines[1:]]).strip()
    return f"<|{role}|>\n{body}\n<|end|>"


def _follow(model: RoleModel) -> Callable:
    """The turns of a segment. What may go on over a border is ``open`` and has its bare lines: ``nth`` is 0 for what
    continues the turn before, and else counts the turns that begin in the segment."""

    def run(table: pa.Table, around: pa.Table) -> pa.Table:
        places, lines = _lines(table)
        states = path(model, lines, around["before"][0].as_py(), around["end"][0].as_py())
        heads = [i for i, s in enumerate(states) if s % 2 == 0]
        begins = heads if heads[:1] == [0] else [0, *heads]
        out = []
        for k, (low, high) in enumerate(zip(begins, [*begins[1:], len(lines)], strict=True)):
            nth = k + (begins is heads)
            last, role = high == len(lines), ROLES[states[low] // 2]
            text = "\n".join(lines[low:high]) if last or nth == 0 else render(role, lines[low:high])
            out.append((nth, last or nth == 0, *places[low], role, text))
        names = ("nth", "open", "turn", "line", "role", "text")
        types = (pa.int64(), pa.bool_(), pa.int64(), pa.int32(), pa.string(), pa.string())
        n, columns = len(out), list(zip(*out, strict=True))
        return pa.table({
            "conv_id": pa.array([table["conv_id"][0].as_py()] * n, pa.int64()),
            "segment": pa.array([table["segment"][0].as_py()] * n, pa.int64()),
            **{name: pa.array(c, t) for name, c, t in zip(names, columns, types, strict=True)},
        })

    return run


def _whole(model: RoleModel) -> Callable:
    """The turns of a transcript that is one segment."""

    def run(table: pa.Table) -> pa.Table:
        places, lines = _lines(table)
        states = path(model, lines)
        heads = [i for i, s in enumerate(states) if s % 2 == 0]
        roles = [ROLES[states[i] // 2] for i in heads]
        ends = [*heads[1:], len(lines)]
        texts = [render(role, lines[a:b]) for role, a, b in zip(roles, heads, ends, strict=True)]
        return pa.table({
            "conv_id": pa.array([table["conv_id"][0].as_py()] * len(heads), pa.int64()),
            "turn": pa.array([places[i][0] for i in heads], pa.int64()),
            "line": pa.array([places[i][1] for i in heads], pa.int32()),
            "role": pa.array(roles, pa.string()),
            "rendered": pa.array(texts, pa.string()),
        })

    return run


def _join_parts(table: pa.Table) -> pa.Table:
    """One turn from its parts in one or more segments."""
    names = ("segment", "turn", "line", "role", "text")
    rows = sorted(zip(*(table[c].to_pylist() for c in names), strict=True))
    _, turn, line, role, _ = rows[0]
    lines = [x for part in rows for x in part[4].split("\n")]
    return pa.table({
        "conv_id": table["conv_id"][:1],
        "turn": pa.array([turn], pa.int64()),
        "line": pa.array([line], pa.int32()),
        "role": pa.array([role], pa.string()),
        "rendered": pa.array([render(role, lines)], pa.string()),
    })


def format_chats(turns: DataFrame, model: RoleModel, rows_per_segment: int = 256) -> DataFrame:
    """conv_id, turn, line, role, rendered: one row for each turn that the model finds.

    ``turns`` (conv_id, turn, text) are the parts of transcripts in order; where parts begin tells the model
    nothing. ``turn`` and ``line`` are the place of a found turn's first line. Null texts count as an empty line, rows without a
    conv_id as one transcript, a null turn as -1; rows equal in conv_id, turn, text and role (if there is one) count once, others
    of one place follow each other in the order of a hash. Other columns are not read, an empty table gives no rows.
    A transcript of one segment is read at once, with the same result.
    """
    role = F.col("role") if "role" in turns.columns else F.lit(None).cast("string")
    rows = numbered(distinct_rows(turns.select("conv_id", "turn", role.alias("role"), "text")))
    rows = stored(rows.withColumn("segment", F.floor(F.col("row") / rows_per_segment)), "rows")
    let_workers_import(turns.sparkSession)
    found = "conv_id long, turn long, line int, role string, rendered string"
    short = F.col("all") <= rows_per_segment
    at_once = rows.filter(short).groupBy("conv_id").applyInArrow(_whole(model), found)
    rows = rows.filter(~short)
    matrices = rows.groupBy("conv_id", "segment").applyInArrow(
        _matrix(model), "conv_id long, segment long, matrix binary"
    )
    matrices = stored(matrices.withColumn("group", F.floor(F.col("segment") / SEGMENTS_PER_GROUP)), "matrices")
    products = matrices.groupBy("conv_id", "group").applyInArrow(_multiply, "conv_id long, group long, matrix binary")
    in_order = products.repartition("conv_id").sortWithinPartitions("conv_id", "group")
    states = "before int, end int"
    around = map_batches(in_order, _chain, f"conv_id long, group long, {states}")
    around = around.withColumnsRenamed({"conv_id": "conv", "group": "own"})
    segments = matrices.groupBy("conv_id", "group").cogroup(around.groupBy("conv", "own"))
    ends = segments.applyInArrow(_inside, f"conv_id long, segment long, {states}")
    ends = ends.withColumnsRenamed({"conv_id": "conv", "segment": "own"})
    parts = rows.groupBy("conv_id", "segment").cogroup(ends.groupBy("conv", "own")).applyInArrow(
        _follow(model), "conv_id long, segment long, nth long, open boolean, turn long, line int, role string, text string"
    )
    parts = stored(parts, "parts")
    whole = parts.filter("NOT open").select("conv_id", "turn", "line", "role", F.col("text").alias("rendered"))
    # Turns are counted over the segments of a transcript, of which there is one row each.
    crossing = parts.filter("open").withColumn("_conv", F.struct("conv_id"))
    begun = crossing.groupBy("_conv", "segment").agg(F.max("nth").alias("_n"))
    earlier = Window.partitionBy("_conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("_conv", "segment", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_from"))
    crossing = crossing.join(begun, ["_conv", "segment"]).withColumn("head", F.col("_from") + F.col("nth"))
    joined = crossing.drop("_conv").groupBy("conv_id", "head").applyInArrow(_join_parts, found)
    return at_once.unionByName(whole).unionByName(joined)
