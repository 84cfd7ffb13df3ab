"""Document quality by Bradley-Terry ranking of preference pairs.

A document of label 1 is preferred to one of label 0. The chance that x is preferred
to y is the logistic function of w (f(x) - f(y)); w is fitted by Newton
steps on the logistic loss of feature differences. Ranking leaves the zero of the scale
open: the threshold is the cut of training scores with the fewest errors.

Every labelled document is learned from. Documents are dealt into blocks, and in a block every one of label 1
is preferred to every one of label 0, so that pairs grow with the documents and not with their square.
Spark adds up the sums of the blocks in each Newton step, and the errors of each cut; only these sums reach the driver.

Features describe only the text: shares of byte classes, word and line shapes, repetition.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import let_workers_import, map_batches
from daymark.llm.text import NOT_SPACE, find_words, slices, text_offsets

PAIRS = 120_000  # what all pairs together weigh against the penalty
BLOCK_ROWS = 256  # of the label that has more rows, on average
LEAST_ROWS = 128  # of the other label, if there are as many
SUM_BITS = 24  # binary digits that a block's sums keep, so that they add up alike in any order
STEPS_PER_UNIT = 256  # cuts in a unit of raw scores
ROWS_AT_ONCE = 1_000
PENALTY = 3.0
CUT = 0.3  # the score at the threshold
BYTE_CLASSES = 96  # printable ASCII each, all others together
LONG_RUN = 24


def _shares(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers for each text; a null or empty text has zeros."""
    words = find_words(texts, NOT_SPACE)
    n_texts, n_words = len(texts), words.counts()
    offsets = text_offsets(texts)
    sizes = np.diff(offsets)
    data = words.data
    owner = np.repeat(np.arange(n_texts), sizes)
    kind = np.where((data >= 0x20) & (data < 0x7F), data - 0x20 + 1, 0).astype(np.int64)
    shares = np.bincount(owner * BYTE_CLASSES + kind, minlength=n_texts * BYTE_CLASSES)
    shares = _shares(shares.reshape(n_texts, -1), sizes[:, None])
    upper = shares[:, 0x41 - 0x1F : 0x5B - 0x1F].sum(axis=1)
    lower = shares[:, 0x61 - 0x1F : 0x7B - 0x1F].sum(axis=1)
    digits = shares[:, 0x30 - 0x1F : 0x3A - 0x1F].sum(axis=1)
    signs = shares[:, 1:].sum(axis=1) - upper - lower - digits

    hashes, word_owner = words.hashes(), np.repeat(np.arange(n_texts), n_words)
    pair_hash = hashes ^ (word_owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    distinct, first, times = np.unique(pair_hash, return_index=True, return_counts=True)
    n_distinct = np.bincount(word_owner[first], minlength=n_texts)
    most = np.zeros(n_texts)
    np.maximum.at(most, word_owner[first], times)
    same = (hashes[1:] == hashes[:-1]) & (word_owner[1:] == word_owner[:-1])
    repeats = np.bincount(word_owner[1:][same], minlength=n_texts)
    lengths = words.ends - words.starts
    total = np.bincount(word_owner, lengths, n_texts)
    squares = np.bincount(word_owner, lengths.astype(float) ** 2, n_texts)
    mean = _shares(total, n_words)
    spread = np.sqrt(np.maximum(0, _shares(squares, n_words) - mean**2))
    long_words = np.bincount(word_owner[lengths > LONG_RUN], minlength=n_texts)
    signs_only = np.zeros(n_texts)
    if len(words):
        is_letter = np.concatenate([[0], np.cumsum((data | 0x20) - 0x61 < 26) + np.cumsum(data >= 0x80)])
        bare = is_letter[words.ends] == is_letter[words.starts]
        signs_only = np.bincount(word_owner[bare], minlength=n_texts)
    lines = np.bincount(owner[data == 0x0A], minlength=n_texts) + (sizes > 0)
    return np.column_stack(
        [
            np.sqrt(shares),
            np.sqrt(np.column_stack([upper, digits, np.maximum(signs, 0)])),
            _shares(n_distinct, n_words),
            np.sqrt(_shares(most, n_words)),
            np.sqrt(_shares(repeats, n_words)),
            mean / 10,
            spread / 10,
            np.sqrt(_shares(long_words, n_words)),
            np.sqrt(_shares(signs_only, n_words)),
            np.log1p(n_words) / 5,
            np.sqrt(_shares(lines, n_words)),
        ]
    )


@dataclass
class Ranking:
    """Weights of features and the threshold of their sum."""

    weights: np.ndarray
    threshold: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """0 to 1, ``CUT`` at the threshold."""
        odds = np.log(CUT / (1 - CUT)) + self.raw(rows) - self.threshold
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _sums(good: np.ndarray, bad: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Slope, then curve, of the log likelihood over all pairs of a row of ``good`` and one of ``bad``."""
    apart = (good @ weights)[:, None] - (bad @ weights)[None, :]
    preferred = 1 / (1 + np.exp(-np.clip(apart, -500, 500)))
    slope = (1 - preferred).sum(1) @ good - (1 - preferred).sum(0) @ bad
    pull = preferred * (1 - preferred)
    across = good.T @ (pull @ bad)
    curve = (good * pull.sum(1)[:, None]).T @ good + (bad * pull.sum(0)[:, None]).T @ bad - across - across.T
    return np.concatenate([slope, curve.ravel()])


def _newton(width: int, sums_at: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Weights that maximize the penalized likelihood; ``sums_at`` gives its slope and curve at some weights."""
    weights = np.zeros(width)
    for _ in range(25):
        sums = sums_at(weights)
        slope = sums[:width] - PENALTY * weights
        step = np.linalg.solve(sums[width:].reshape(width, width) + PENALTY * np.eye(width), slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return weights


def _steps(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.floor(rows @ weights * STEPS_PER_UNIT).astype(np.int64)


def _best_cut(steps: np.ndarray, good: np.ndarray, bad: np.ndarray) -> float:
    """The middle one of the cuts with the fewest errors: ``good`` rows below it, ``bad`` ones not below it."""
    steps, at = np.unique(steps, return_inverse=True)
    good, bad = (np.bincount(at, n, len(steps)).astype(np.int64) for n in (good, bad))
    # All cuts above one step and not above the next have the same errors.
    errors = np.concatenate([[0], np.cumsum(good)]) + bad.sum() - np.concatenate([[0], np.cumsum(bad)])
    first = np.concatenate([steps[:1], steps + 1])
    last = np.concatenate([steps, steps[-1:] + 1])
    best = errors == errors.min()
    upto = np.cumsum((last - first + 1)[best])
    middle = int(upto[-1]) // 2
    at = int(np.searchsorted(upto, middle, side="right"))
    return float((last[best][at] - (upto[at] - 1 - middle)) / STEPS_PER_UNIT)


def _passing_all(width: int) -> Ranking:
    return Ranking(np.zeros(width), -1.0)


def fit(rows: np.ndarray, labels: np.ndarray) -> Ranking:
    """Bradley-Terry weights from all pairs of the two labels; without both, every text passes.

    Pairs are made for some rows at a time, so that memory doesn't grow with their number.
    """
    good, bad = rows[labels == 1], rows[labels == 0]
    if not len(good) or not len(bad):
        return _passing_all(rows.shape[1])
    scale = PAIRS / (len(good) * len(bad))
    starts = range(0, len(good), ROWS_AT_ONCE)
    weights = _newton(
        rows.shape[1], lambda at: scale * sum(_sums(good[low : low + ROWS_AT_ONCE], bad, at) for low in starts)
    )
    return Ranking(weights, _best_cut(_steps(rows, weights), labels == 1, labels == 0))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of texts and other columns, with the bytes of a text's numbers in its place."""
    for batch in batches:
        for low, high in slices(batch.column(0)):
            part = batch.slice(low, high - low)
            rows = [row.tobytes() for row in features(part.column(0)).astype(np.float32)]
            columns = [pa.array(rows, pa.binary()), *part.columns[1:]]
            yield pa.RecordBatch.from_arrays(columns, names=[str(i) for i in range(len(columns))])


def _width() -> int:
    return features(pa.array([""])).shape[1]


def _matrix(rows: bytes) -> np.ndarray:
    return np.frombuffer(rows, np.float32).reshape(-1, _width()).astype(np.float64)


def _learned_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(row, _id) of every row of ``docs`` whose text is the smallest of its id, copies included.

    Only texts of ids that have several are compared.
    """
    texts = docs.select(F.col(text_column).alias("text"), F.col(id_column).alias("_id"))
    texts = texts.filter("_id IS NOT NULL").withColumn("_hash", F.xxhash64("text"))
    spread = texts.groupBy("_id").agg(F.min("_hash").alias("_low"), F.max("_hash").alias("_high"))
    # Stored first, so that where there are few, as usual, no texts are dealt by id.
    several = stored(spread.filter("_low != _high").select("_id"), "several")
    smallest = texts.join(several, "_id").groupBy("_id").agg(F.xxhash64(F.min("text")).alias("_smallest"))
    rows = map_batches(texts, _features, f"row binary, _id {dict(texts.dtypes)['_id']}, _hash long")
    known = rows.join(smallest, "_id", "left").filter("_smallest IS NULL OR _smallest = _hash")
    return known.select("row", "_id")


def _block(block: pa.Table) -> pa.Table:
    """The rows of each label of a block, as one row."""
    labels, rows = block["label"].to_numpy(), np.array(block["row"].to_pylist(), dtype=object)
    # Sorted, for the same sums however Spark ordered the rows.
    good, bad = (sorted(rows[labels == label]) for label in (1, 0))
    return pa.table(
        {
            "good": pa.array([b"".join(good)], pa.binary()),
            "bad": pa.array([b"".join(bad)], pa.binary()),
            "pairs": pa.array([len(good) * len(bad)], pa.int64()),
        }
    )


def _block_sums(weights: np.ndarray, scale: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights) * (len(weights) + 1))
        for batch in batches:
            for good, bad in zip(batch.column(0), batch.column(1), strict=True):
                sums = _sums(_matrix(good.as_buffer()), _matrix(bad.as_buffer()), weights)
                # Whole multiples of one small number add up exactly, in any order.
                total += np.rint(sums * (scale * 2**SUM_BITS)) / 2**SUM_BITS
        places = pa.array(np.arange(len(total), dtype=np.int32))
        yield pa.RecordBatch.from_arrays([places, pa.array(total)], names=["place", "total"])

    return run


def _block_steps(weights: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for good, bad in zip(batch.column(0), batch.column(1), strict=True):
                high, low = (_steps(_matrix(rows.as_buffer()), weights) for rows in (good, bad))
                is_good = np.repeat([1, 0], [len(high), len(low)])
                columns = [pa.array(np.concatenate([high, low])), pa.array(is_good.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=["step", "label"])

    return run


def _fit_all(rows: DataFrame, counts: dict[int, int]) -> Ranking:
    """Weights and threshold from all of ``rows`` (_id, label, row), of which there are ``counts`` of each label.

    Each row of the label with more rows goes to one block, each of the other to as many as
    give every block rows to compare with. Only sums and counts of raw scores reach the driver.
    """
    width = _width()
    rarer, more = sorted((1, 0), key=counts.get)
    blocks = math.ceil(counts[more] / BLOCK_ROWS)
    copies = min(blocks, math.ceil(LEAST_ROWS * blocks / counts[rarer]))
    last = F.when(F.col("label") == rarer, copies - 1).otherwise(0)
    first = F.xxhash64("_id", "label")
    dealt = rows.withColumn("_copy", F.explode(F.sequence(F.lit(0), last))).select(
        F.pmod(F.pmod(first, F.lit(blocks)) + F.col("_copy"), F.lit(blocks)).alias("block"), "label", "row"
    )
    let_workers_import(rows.sparkSession)
    blocked = stored(
        dealt.groupBy("block").applyInArrow(_block, "good binary, bad binary, pairs long"), "blocks"
    )
    pairs = blocked.agg(F.sum("pairs")).first()[0]
    sides = blocked.select("good", "bad")

    def sums_at(weights: np.ndarray) -> np.ndarray:
        parts = map_batches(sides, _block_sums(weights, PAIRS / max(pairs, 1)), "place int, total double")
        found = parts.groupBy("place").agg(F.sum("total").alias("total")).toArrow().sort_by("place")
        return found["total"].to_numpy()

    weights = _newton(width, sums_at)
    tally = map_batches(sides, _block_steps(weights), "step long, label int").groupBy("step").agg(
        F.sum("label").alias("good"), F.sum(1 - F.col("label")).alias("bad")
    )
    found = tally.toArrow()
    of_label = {1: found["good"].to_numpy(), 0: found["bad"].to_numpy()}
    # Every row of the rarer label was counted in each of its blocks.
    of_label[more] = of_label[more] * copies
    return Ranking(weights, _best_cut(found["step"].to_numpy(), of_label[1], of_label[0]))


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: F.Column | None = None,
    max_rows_per_label: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> Ranking:
    """Fit on all labelled documents, or on at most ``max_rows_per_label`` of each label, chosen by a hash of their id.

    ``labels`` has doc_id and quality; ``usable`` is a condition on its rows. Labels other
    than 0 and 1 and null ids are left out. A document that has both labels counts for both. Of rows that
    share an id the smallest text is learned from. Without a bound the fit is made of sums over blocks of
    documents; with one, the chosen rows are fitted on the driver.
    """
    labels = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    labels = labels.filter(usable) if usable is not None else labels
    labels = labels.select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("label"))
    present = docs.select(F.col(id_column).alias("_id"))
    labels = labels.join(present, "_id", "left_semi").distinct()
    if max_rows_per_label is not None:
        parts = [labels.filter(F.col("label") == label) for label in (0, 1)]
        first, second = (p.orderBy(F.xxhash64("_id"), "_id").limit(max_rows_per_label) for p in parts)
        labels = first.union(second)
    labels = stored(labels, "learned")
    counts = {0: 0, 1: 0} | {r.label: r["count"] for r in labels.groupBy("label").count().collect()}
    if not counts[0] or not counts[1]:
        return _passing_all(_width())
    rows = _learned_texts(docs, id_column, text_column).join(labels, "_id")
    rows = rows.groupBy("_id", "label").agg(F.first("row").alias("row"))
    if max_rows_per_label is None:
        return _fit_all(rows, counts)
    chosen = rows.orderBy("label", "row").toArrow()
    return fit(_matrix(b"".join(chosen["row"].to_pylist())), chosen["label"].to_numpy())


def _score(model: Ranking, text_at: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(text_at)):
                part = batch.slice(low, high - low)
                scores = model.scores(features(part.column(text_at)))
                columns = [part.column(i) for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(scores)], names=[str(i) for i in range(len(columns) + 1)]
                )

    return run


def with_quality(docs: DataFrame, model: Ranking, text_column: str = "text", result: str = "score") -> DataFrame:
    """``docs`` with a column ``result`` (replaced if there): 0 to 1, higher is better.

    Null and empty texts are scored alike, repeated rows too; other columns pass through unread.
    """
    docs = docs.drop(result)
    schema = ", ".join([f"`{c.replace('`', '``')}` {t}" for c, t in [*docs.dtypes, (result, "double")]])
    return map_batches(docs, _score(model, docs.columns.index(text_column)), schema)
