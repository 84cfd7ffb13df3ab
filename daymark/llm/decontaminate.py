"""Benchmark decontamination: passages of test items inside documents.

The normalised n-grams of the items form a hash set that travels to every
task. Tasks hash all windows of their texts at once, look them up, and compare
the words of each hit before it counts. The set is bounded: items beyond
``MAX_BLOCK_CHARS`` characters are taken block by block, each block against
all documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import map_batches
from daymark.llm.text import LETTER_OR_DIGIT, Words, find_words, slices, window_hashes

MAX_BLOCK_CHARS = 4_000_000  # some 20 MB of windows on the driver and in each worker
FILTER_BITS = 20

FOUND = "struct<n_words: long, hits: array<int>, items: array<long>>"
FOUND_TYPE = pa.struct(
    [("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.int64()))]
)


class WindowSet:
    """The windows of some items: ``size`` consecutive words, or all words of a shorter item.

    Held as arrays: the hash of each window, in order, and where it begins among the words of all items.
    """

    def __init__(self, items: list[tuple[int | None, str | None]], size: int):
        self.words = find_words(pa.array([text for _, text in items], pa.string()), LETTER_OR_DIGIT)
        self.ids = [item for item, _ in items]
        first, counts = self.words.first[:-1], self.words.counts()
        hashes, lengths = self.words.hashes(), np.minimum(size, counts)
        self.by_length = {}
        for length in np.unique(lengths[lengths > 0]).tolist():
            of = np.flatnonzero(lengths == length)
            n = counts[of] - length + 1
            starts = np.repeat(first[of], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            keys = window_hashes(hashes, length)[starts]
            order = np.argsort(keys, kind="stable")
            near = np.zeros(1 << FILTER_BITS, dtype=bool)
            near[keys >> np.uint64(64 - FILTER_BITS)] = True
            owners = np.repeat(of, n)[order].astype(np.int32)
            self.by_length[length] = (keys[order], near, starts[order].astype(np.int32), owners)

    def find(self, words: Words) -> list[tuple[int, int, list[int]]]:
        """(first word, length, items) of each window that occurs, in no order."""
        hashes = words.hashes()
        last = np.repeat(words.first[1:], words.counts())
        found = []
        for length, (known, near, starts, owners) in self.by_length.items():
            windows = window_hashes(hashes, length)
            at = np.flatnonzero(near[windows >> np.uint64(64 - FILTER_BITS)])
            at = at[at + length <= last[at]]
            low = np.searchsorted(known, windows[at], side="left")
            high = np.searchsorted(known, windows[at], side="right")
            for i, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
                if a == b:
                    continue
                spelled = _joined(words, i, length)
                same = {int(owners[k]) for k in range(a, b) if _joined(self.words, int(starts[k]), length) == spelled}
                if same:
                    found.append((i, length, [self.ids[k] for k in same if self.ids[k] is not None]))
        return found


def _joined(words: Words, i: int, length: int) -> bytes:
    return b" ".join(words.word(k) for k in range(i, i + length))


def _scan(windows: WindowSet, text_at: int, found_at: int | None) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(text_at)):
                part = batch.slice(low, high - low)
                words = find_words(part.column(text_at), LETTER_OR_DIGIT)
                hits: list[list[int]] = [[] for _ in range(len(part))]
                items: list[set[int]] = [set() for _ in range(len(part))]
                if found_at is not None:
                    for row, earlier in enumerate(part.column(found_at).to_pylist()):
                        hits[row] += earlier["hits"]
                        items[row].update(earlier["items"])
                for i, length, ids in windows.find(words):
                    row = int(np.searchsorted(words.first, i, side="right")) - 1
                    begin = i - int(words.first[row])
                    hits[row] += (begin, begin + length)
                    items[row].update(ids)
                counts = words.counts().tolist()
                found = [
                    {"n_words": n, "hits": _merged(h), "items": sorted(x)}
                    for n, h, x in zip(counts, hits, items, strict=True)
                ]
                columns = [part.column(i) for i in range(part.num_columns) if i != found_at]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(found, FOUND_TYPE)],
                    names=[str(i) for i in range(len(columns) + 1)],
                )

    return run


def _merged(ranges: list[int]) -> list[int]:
    """Overlapping or touching (begin, end) pairs joined; flat, in order."""
    out: list[int] = []
    for begin, end in sorted(zip(ranges[::2], ranges[1::2], strict=True)):
        if out and begin <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += (begin, end)
    return out


def _cut(text_at: int, found_at: int) -> Callable:
    """Texts without the words that ``hits`` names and what stands between them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in slices(batch.column(text_at)):
                part = batch.slice(low, high - low)
                texts = part.column(text_at).to_pylist()
                for row, found in enumerate(part.column(found_at).to_pylist()):
                    if found["hits"]:
                        raw = texts[row].encode()
                        words = find_words(pa.array([texts[row]]), LETTER_OR_DIGIT)
                        keep, done = [], 0
                        for a, b in zip(found["hits"][::2], found["hits"][1::2], strict=True):
                            keep.append(raw[done : words.starts[a]])
                            done = words.ends[b - 1]
                        texts[row] = b"".join([*keep, raw[done:]]).decode()
                columns = [part.column(i) for i in range(part.num_columns)]
                columns[text_at] = pa.array(texts, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)

    return run


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    size: int = 13,
    result: str = "found",
    max_block_chars: int = MAX_BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with a column ``result``: n_words, hits and items of each text.

    ``benchmark`` has item_id and text. ``hits`` are the word ranges (begin,
    end, begin, end, ...) that windows of items cover, ``items`` the sorted ids of
    the items with such windows. Null and empty texts have no words and no hits;
    an item without words matches nothing, one without an id hits but is not
    listed. Repeated rows get equal results. A column named as ``result`` is
    replaced; all others are kept, whatever they hold. An empty ``benchmark``
    hits nothing.
    """
    docs = docs.drop(result)
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text")).distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-chars // max_block_chars))
    columns = [f"`{c.replace('`', '``')}` {t}" for c, t in docs.dtypes]
    schema = ", ".join([*columns, f"`{result}` {FOUND}"])
    text_at, out = docs.columns.index(text_column), docs
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        windows = WindowSet([(r[0], r[1]) for r in rows], size)
        out = map_batches(out, _scan(windows, text_at, len(docs.columns) if block else None), schema)
        out = stored(out, "found") if blocks > 1 else out
    return out


def hit_words(found: str = "found") -> F.Column:
    """How many words the hits cover."""
    ends = F.transform(F.col(f"{found}.hits"), lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(ends, F.lit(0).cast("long"), lambda a, x: a + x)


def contaminated(found: str = "found", share: int = 20) -> F.Column:
    """At least one in ``share`` words of the text is hit."""
    return (hit_words(found) > 0) & (share * hit_words(found) >= F.col(f"{found}.n_words"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones."""
    found = find_benchmark(docs, benchmark, text_column, result="_found")
    return found.filter(~contaminated("_found")).drop("_found")


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with the hit words cut out of their texts."""
    found = find_benchmark(docs, benchmark, text_column, result="_found")
    columns = found.columns
    cut = _cut(columns.index(text_column), len(columns) - 1)
    return map_batches(found, cut, found.schema).drop("_found")
