"""Best-fit packing of token pieces into sequences by minimum bin slack.

Which piece of a length goes where does not matter for how full the sequences
are, so the bins are planned on the counts of each length alone: a table of at
most ``limit`` numbers, whatever the size of the corpus. Each planned bin is
repeated as often as the counts allow. Pieces of a length are then numbered,
and the number tells the sequence and the place in it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import let_workers_import, map_batches
from daymark.llm.text import slices
from daymark.llm.tokens import SLICE_BYTES, encoder, with_end

PIECES = "doc_id long, piece int, start long, length long, ids binary, part long, number long"


def _numbered(lengths: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The number of each piece among those of its length so far; ``used`` is brought up to date."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    runs = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.concatenate([runs, [len(ordered)]]))
    out = np.empty(len(lengths), dtype=np.int64)
    out[order] = np.arange(len(ordered)) - np.repeat(runs, sizes) + used[ordered]
    used[ordered[runs]] += sizes
    return out


def _cut(path: str, limit: int, end: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, used, encode = TaskContext.get().partitionId(), np.zeros(limit + 1, np.int64), encoder(path)
        for batch in batches:
            for low, high in slices(batch.column(1), SLICE_BYTES):
                ids, offsets = with_end(*encode.encode(batch.column(1)[low:high]), end)
                sizes = np.diff(offsets)
                pieces = -(-sizes // limit)
                row = np.repeat(np.arange(len(sizes)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * limit
                length = np.minimum(limit, sizes[row] - start)
                bounds = np.concatenate([[0], np.cumsum(length * 4)]).astype(np.int32)
                binary = pa.Array.from_buffers(
                    pa.binary(), len(row), [None, pa.py_buffer(bounds), pa.py_buffer(ids.astype("<u4"))]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[low:high].take(pa.array(row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        binary,
                        pa.array(np.full(len(row), task)),
                        pa.array(_numbered(length, used)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids", "part", "number"],
                )

    return run


def cut_documents(
    docs: DataFrame,
    tokenizer: str,
    limit: int = 2048,
    end: int = 0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """The token ids of each document, with ``end`` after them, in pieces of at most ``limit``.

    doc_id, piece (from 0), start, length and ids (little-endian unsigned 32
    bit), stored, and the columns part and number that ``pack`` reads. A null
    or empty text is one piece with the id ``end``. Repeated rows are cut each
    for itself, a null id stays null, other columns are not read.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return stored(map_batches(texts, _cut(tokenizer, limit, end), PIECES), "pieces")


def _fullest(counts: list[int], room: int) -> list[tuple[int, int]]:
    """(length, copies) whose lengths add up to the most that is at most ``room``.

    Bit s of a layer tells whether lengths down to that layer's can add up to s.
    """
    reach, layers = 1, []
    inside = (1 << (room + 1)) - 1
    for length in range(room, 0, -1):
        if not counts[length]:
            continue
        copies, before, step = min(counts[length], room // length), reach, 1
        while copies:
            step = min(step, copies)
            reach |= (reach << (step * length)) & inside
            copies -= step
            step *= 2
        layers.append((length, before))
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, []
    for length, before in reversed(layers):
        copies = 0
        while not before >> total & 1:
            total -= length
            copies += 1
        if copies:
            chosen.append((length, copies))
    return chosen[::-1]


def minimum_bin_slack(histogram: dict[int, int], limit: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Bins as (how many alike, [(length, copies in each)]), for a count of each length up to ``limit``.

    Each bin takes the longest piece left and the fullest combination beside it.
    """
    counts = [0] * (limit + 1)
    for length, n in histogram.items():
        counts[length] = n
    bins = []
    for longest in range(limit, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            content = dict(_fullest(counts, limit - longest))
            counts[longest] += 1
            content[longest] = content.get(longest, 0) + 1
            alike = min(counts[length] // copies for length, copies in content.items())
            for length, copies in content.items():
                counts[length] -= alike * copies
            bins.append((alike, sorted(content.items(), reverse=True)))
    return bins


class Places:
    """Sequence and offset of the n-th piece of a length, from the planned bins."""

    def __init__(self, bins: list[tuple[int, list[tuple[int, int]]]]):
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        given: dict[int, int] = {}
        sequence = 0
        for alike, content in bins:
            offset = 0
            for length, copies in content:
                rows.setdefault(length, []).append((given.get(length, 0), sequence, copies, offset))
                given[length] = given.get(length, 0) + alike * copies
                offset += length * copies
            sequence += alike
        self.sequences = sequence
        self.by_length = {length: np.array(x, dtype=np.int64).T for length, x in rows.items()}

    def of(self, lengths: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sequence, offset = np.empty_like(lengths), np.empty_like(lengths)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            first, base, copies, place = self.by_length[length]
            k = np.searchsorted(first, numbers[at], side="right") - 1
            nth, slot = np.divmod(numbers[at] - first[k], copies[k])
            sequence[at] = base[k] + nth
            offset[at] = place[k] + slot * length
        return sequence, offset


def pack(pieces: DataFrame, limit: int = 2048) -> DataFrame:
    """``pieces`` with sequence_id and offset instead of part and number.

    ``pieces`` is what ``cut_documents`` returns, with any columns more or
    less. In each sequence the offsets follow each other without a gap and end
    at ``limit`` or before. No pieces give no rows.
    """
    by_part = pieces.groupBy("part", "length").agg((F.max("number") + 1).alias("_n"))
    totals = by_part.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most `limit` rows
    places = Places(minimum_bin_slack({r["length"]: r["n"] for r in totals}, limit))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("part", "length", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))

    let_workers_import(pieces.sparkSession)

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, offset = places.of(length.to_numpy(), number.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    placed = pieces.join(bases, ["part", "length"]).withColumn(
        "_at", place("length", F.col("number") + F.col("_base"))
    )
    kept = [c for c in pieces.columns if c not in ("part", "number", "sequence_id", "offset")]
    return placed.select(*kept, "_at.sequence_id", "_at.offset")
