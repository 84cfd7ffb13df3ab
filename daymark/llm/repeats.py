"""Removal of long byte strings that occur more than once, by prefix-free parsing.

Triggers. Every string of ``length`` bytes is marked by the smallest rolling
hash of the shorter strings in it. Consecutive strings with one mark form a
phrase; a phrase holds all their bytes, so it reaches ``length - 1`` bytes into
the next one and the parse of a passage depends on nothing outside it. Equal
strings always carry one mark, wherever they stand.

Dictionary and parse. Distinct phrases are the dictionary; the parse says where
each occurs. Strings of a phrase that occurs twice are repeated without a look
at its bytes, which settles copied text. A phrase whose mark occurs at no other
place holds no repeated string, which settles text that is not copied. Of the
rest (edges of copied passages, text that repeats itself) each distinct phrase
travels once.

Corpus order. Phrases of one mark meet in one task, which builds the suffix
array of its part of the dictionary by prefix doubling up to ``length`` bytes.
As phrases overlap, a suffix of that length never needs the phrase that
follows: suffixes that tie there are exactly the strings that repeat. A mark
with very many phrases is dealt to several tasks; these compare names of the
strings that they hold.

Marks are hashes of 43 bits, and phrases are told apart by a mark and a hash of 64 bits.

Defined results: a null text is empty. Every row is a document of its own, so
repeated rows repeat each other. Rows with a null id count. Strings never cross
documents; texts shorter than ``length`` stay whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import let_workers_import, map_batches
from daymark.llm.terms import text_bytes
from daymark.llm.text import RAW_VALUE, STEP, _Powers, mix, slices, text_offsets

LENGTH = 200
BLOCK_BYTES = 1 << 20
STARTS = 1 << 20
MOST_STRINGS = 256
CHUNK_BYTES = 1 << 20
PHRASES_PER_TASK = 8192

BLOCK = "block bigint, doc_ids array<bigint>, sizes array<bigint>, data binary"
REQUEST = "anchor bigint, phrase bigint, block bigint, n int, inner boolean"
PLACED = "block bigint, begin bigint, stop bigint, anchor bigint, salts bigint, data binary"
FOUND = "block bigint, begin bigint, stop bigint, anchor bigint, name bigint"
CLEANED = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, left binary"

VALUES = (RAW_VALUE, mix(RAW_VALUE))
PLACE_BITS = np.uint64(21)
PLACES = np.uint64((1 << 21) - 1)


def _one_list(values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values))


def _blocks(limit: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents of about ``limit`` bytes, or one longer one, as one compressed row."""
        numbers = itertools.count(TaskContext.get().partitionId() << 33)
        for batch in batches:
            for low, high in slices(batch.column("text"), limit):
                rows = batch.slice(low, high - low)
                texts, ids = rows.column("text"), rows.column("doc_id")
                packed = pa.compress(pa.py_buffer(text_bytes(texts)), codec="zstd", asbytes=True)
                yield pa.RecordBatch.from_pydict({
                    "block": pa.array([next(numbers)], pa.int64()),
                    "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    "sizes": _one_list(np.diff(text_offsets(texts))),
                    "data": pa.array([packed], pa.binary()),
                })

    return blocks


class Block:
    """The bytes of some documents, one after the other."""

    def __init__(self, row: pa.RecordBatch | pa.Table):
        if isinstance(row, pa.Table):
            row = row.combine_chunks().to_batches()[0]
        self.number = row.column("block")[0].as_py()
        self.doc_ids = row.column("doc_ids").flatten()
        self.sizes = row.column("sizes").flatten().to_numpy()
        size = int(self.sizes.sum())
        packed = row.column("data")[0].as_buffer()
        data = pa.decompress(packed, size, codec="zstd") if size else b""
        self.data = np.frombuffer(data, dtype=np.uint8)


class Phrases:
    """Phrases of a block: each has the strings that start from ``begin`` to before ``stop``.

    ``inner`` marks phrases that hold their mark at two places, so that a
    string may occur twice within the phrase.
    """

    def __init__(self, block: Block, length: int):
        parts = list(_phrases(block, length))
        columns = zip(*parts, strict=True) if parts else [[]] * 5
        kinds = (np.int64, np.int64, np.uint64, np.uint64, bool)
        self.begin, self.stop, self.anchor, self.phrase, self.inner = (
            np.concatenate([np.zeros(0, kind), *column]) for column, kind in zip(columns, kinds, strict=True)
        )


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    upto = np.minimum.accumulate(rows, axis=1).ravel()
    after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[: n - width + 1], upto[width - 1 : n])


def _phrases(block: Block, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    gram = max(1, length // 4)
    n = len(block.data)
    last = np.repeat(np.cumsum(block.sizes), block.sizes) - length
    for low in range(0, n - length + 1, STARTS):
        data = block.data[low : low + STARTS + length - 1]
        up, down = _Powers.upto(len(data))
        sums = np.zeros((2, len(data) + 1), dtype=np.uint64)
        for i, values in enumerate(VALUES):
            np.cumsum(values[data] * up[: len(data)], out=sums[i, 1:])
        rolling = mix((sums[0, gram:] - sums[0, :-gram]) * down[: len(data) - gram + 1])
        at = np.arange(len(rolling), dtype=np.uint64)
        # The least value with its first place and with its last one, in the low bits.
        leading = _sliding_least((rolling & ~PLACES) | at, length - gram + 1)
        trailing = _sliding_least((rolling & ~PLACES) | (PLACES - at), length - gram + 1)
        mark = leading >> PLACE_BITS
        starts = low + np.arange(len(mark))
        valid = starts <= last[starts]
        joined = valid[1:] & valid[:-1] & (mark[1:] == mark[:-1])
        opens, closes = valid.copy(), valid.copy()
        opens[1:] &= ~joined
        closes[:-1] &= ~joined
        begin, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        # A text that repeats itself would make endless phrases; equal strings keep their mark when these are cut.
        cuts = -(-(stop - begin) // MOST_STRINGS)
        nth = np.arange(int(cuts.sum())) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        begin = np.repeat(begin, cuts) + nth * MOST_STRINGS
        stop = np.minimum(np.repeat(stop, cuts), begin + MOST_STRINGS)
        end = stop - 1 + length
        first, second = ((sums[i, end] - sums[i, begin]) * down[begin] for i in (0, 1))
        phrase = mix(mix(first) + second * STEP + (stop - begin).astype(np.uint64))
        inner = (leading[begin] & PLACES) + (trailing[stop - 1] & PLACES) != PLACES
        yield begin + low, stop + low, mark[begin], phrase, inner


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _requests(length: int):
    def requests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each distinct phrase of a block once, with 1 or 2 for "once" or "more often"."""
        for batch in batches:
            for i in range(batch.num_rows):
                block = Block(batch.slice(i, 1))
                found = Phrases(block, length)
                phrase, at, n = np.unique(found.phrase, return_index=True, return_counts=True)
                yield pa.RecordBatch.from_pydict({
                    "anchor": _signed(found.anchor[at]),
                    "phrase": _signed(phrase),
                    "block": pa.array(np.full(len(phrase), block.number, dtype=np.int64)),
                    "n": pa.array(np.minimum(n, 2).astype(np.int32)),
                    "inner": pa.array(found.inner[at]),
                })

    return requests


def _place(length: int):
    def place(block: pa.Table, states: pa.Table) -> pa.Table:
        """Strings of repeated phrases, and the bytes of phrases that are to be compared."""
        block = Block(block)
        found = Phrases(block, length)
        states = states.combine_chunks()
        phrase = states.column("phrase").to_numpy().view(np.uint64)
        sure = np.isin(found.phrase, phrase[states.column("repeated").to_numpy(zero_copy_only=False)])
        begin, stop = _joined(found.begin[sure], found.stop[sure])
        asked = states.filter(states.column("compared"))
        wanted = asked.column("phrase").to_numpy().view(np.uint64)
        distinct, at = np.unique(found.phrase, return_index=True)
        at = at[np.searchsorted(distinct, wanted)]
        sent_begin, sent_stop = found.begin[at], found.stop[at]
        data = block.data.tobytes()
        texts = [data[b : e + length - 1] for b, e in zip(sent_begin.tolist(), sent_stop.tolist(), strict=True)]
        nothing = [None] * len(begin)
        return pa.Table.from_pydict({
            "block": pa.array(np.full(len(begin) + len(at), block.number, dtype=np.int64)),
            "begin": pa.array(np.concatenate([begin, sent_begin])),
            "stop": pa.array(np.concatenate([stop, sent_stop])),
            "anchor": pa.chunked_array([pa.array(nothing, pa.int64()), _signed(found.anchor[at])]),
            "salts": pa.chunked_array([pa.array(nothing, pa.int64()), *asked.column("salts").chunks]),
            "data": pa.array(nothing + texts, pa.binary()),
        })

    return place


def _joined(begin: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges in ascending order, adjacent ones put together."""
    if len(begin) == 0:
        return begin, stop
    apart = begin[1:] != stop[:-1]
    return begin[np.concatenate([[True], apart])], stop[np.concatenate([apart, [True]])]


def corpus_order(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """The rank of the string of ``length`` bytes at each start; equal strings share a rank.

    Prefix doubling: the order by 8 bytes gives that by 16, and so on.
    """
    n = len(data)
    reach = min(8, length)
    padded = np.concatenate([data, np.zeros(reach, dtype=np.uint8)])
    key = np.zeros(n, dtype=np.uint64)
    for j in range(reach):
        key = (key << np.uint64(8)) | padded[j : j + n]
    rank = np.unique(key, return_inverse=True)[1].astype(np.uint64)
    while 2 * reach <= length:
        key = rank << np.uint64(32)
        key[: n - reach] |= rank[reach:]
        rank = np.unique(key, return_inverse=True)[1].astype(np.uint64)
        reach *= 2
    pair = (rank[starts] << np.uint64(32)) | rank[starts + length - reach]
    return np.unique(pair, return_inverse=True)[1]


def _names(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    up, down = _Powers.upto(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(VALUES[1][data] * up[: len(data)], out=sums[1:])
    return mix((sums[starts + length] - sums[starts]) * down[starts])


def _compared(phrases: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """Repeated strings among some phrases; for marks dealt to several tasks also the names of all strings."""
    texts = phrases.column("data").combine_chunks()
    data, offsets = text_bytes(texts), text_offsets(texts)
    offsets = offsets - offsets[0]
    column = {c: phrases.column(c).to_numpy() for c in ("block", "begin", "stop", "anchor", "salts")}
    counts = column["stop"] - column["begin"]
    of = np.repeat(np.arange(len(counts)), counts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = offsets[of] + nth
    rank = corpus_order(data, starts, length)
    times = np.bincount(rank)
    repeated = times[rank] > 1
    at = column["begin"][of] + nth

    kept = np.flatnonzero(repeated)
    apart = np.ones(len(kept), dtype=bool)
    apart[1:] = (of[kept][1:] != of[kept][:-1]) | (kept[1:] != kept[:-1] + 1)
    first, last = kept[apart], kept[np.concatenate([apart[1:], [True]])[: len(kept)]]
    yield _found(column["block"][of[first]], at[first], at[last] + 1)

    shared = np.flatnonzero(column["salts"][of] > 1)
    if len(shared):
        shared = shared[np.unique(rank[shared], return_index=True)[1]]
        asks = ~repeated[shared]
        yield _found(
            column["block"][of[shared]],
            pa.array(at[shared], mask=~asks),
            pa.array(at[shared] + 1, mask=~asks),
            column["anchor"][of[shared]],
            _signed(_names(data, starts[shared], length)),
        )


def _found(block, begin, stop, anchor=None, name=None) -> pa.RecordBatch:
    nothing = pa.nulls(len(block), pa.int64())
    return pa.RecordBatch.from_pydict({
        "block": block,
        "begin": begin,
        "stop": stop,
        "anchor": nothing if anchor is None else anchor,
        "name": nothing if name is None else name,
    })


def _compare(length: int, limit: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Chunks of whole groups, which come in ascending order."""
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if sum(b.column("data").nbytes for b in held) < limit:
                    continue
            table = pa.Table.from_batches(held).combine_chunks() if held else None
            if table is None or table.num_rows == 0:
                continue
            group = table.column("group").to_numpy()
            # The last group may go on in the next batch.
            edge = len(group) if batch is None else int(np.searchsorted(group, group[-1]))
            low = 0
            while low < edge:
                high = _end_of_chunk(table, group, low, edge, limit)
                yield from _compared(table.slice(low, high - low), length)
                low = high
            held = table.slice(edge).to_batches()

    return compare


def _end_of_chunk(table: pa.Table, group: np.ndarray, low: int, edge: int, limit: int) -> int:
    """The end of the last whole group within ``limit`` bytes from ``low``, or of the first one."""
    offsets = text_offsets(table.column("data").chunk(0))
    high = int(np.searchsorted(offsets, offsets[low] + limit))
    if high >= edge:
        return edge
    first = int(np.searchsorted(group, group[high]))
    return first if first > low else int(np.searchsorted(group, group[high], side="right"))


def _clean(length: int):
    def clean(block: pa.Table, repeated: pa.Table) -> pa.Table:
        block = Block(block)
        n = len(block.data)
        cover = np.zeros(n + 1, dtype=np.int64)
        np.add.at(cover, repeated.column("begin").to_numpy(), 1)
        np.add.at(cover, repeated.column("stop").to_numpy() + length - 1, -1)
        gone = np.cumsum(cover[:-1]) > 0
        bounds = np.concatenate([[0], np.cumsum(block.sizes)])
        border = np.zeros(n + 1, dtype=bool)
        border[bounds] = True
        opens, closes = gone.copy(), gone.copy()
        opens[1:] &= ~gone[:-1] | border[1:-1]
        closes[:-1] &= ~gone[1:] | border[1:-1]
        start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        first = np.searchsorted(start, bounds).astype(np.int32)
        base = np.repeat(bounds[:-1], np.diff(first))
        spans = pa.StructArray.from_arrays([pa.array(start - base), pa.array(end - base)], ["start", "end"])
        sums = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(~gone, out=sums[1:])
        left = np.ascontiguousarray(block.data[~gone])
        offsets = sums[bounds].astype(np.int32)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(left)]
        return pa.Table.from_pydict({
            "doc_id": block.doc_ids,
            "n_bytes": pa.array(block.sizes),
            "spans": pa.ListArray.from_arrays(pa.array(first), spans),
            "left": pa.Array.from_buffers(pa.binary(), len(block.sizes), buffers),
        })

    return clean


def _states(requests: DataFrame) -> DataFrame:
    """(asking, phrase, repeated, compared, salts) for phrases whose mark occurs more than once."""
    marks = requests.groupBy("anchor").agg(
        F.sum("n").alias("total"), F.min("phrase").alias("low"), F.max("phrase").alias("high"),
        F.max("inner").alias("inner"),
    ).filter("total > 1 OR inner")
    salts = F.ceil(F.col("total") / PHRASES_PER_TASK)
    several = (F.col("low") != F.col("high")) | F.col("inner")
    met = marks.select("anchor", several.alias("several"), salts.alias("salts"))
    alike = Window.partitionBy("anchor", "phrase")
    counted = requests.join(met, "anchor").withColumns({
        "times": F.sum("n").over(alike), "example": F.min("block").over(alike),
    })
    repeated = F.col("times") > 1
    compared = F.col("several") & (~repeated | (F.col("block") == F.col("example")))
    chosen = counted.select(F.col("block").alias("asking"), "phrase", repeated.alias("repeated"), compared.alias("compared"), "salts")
    return chosen.filter("repeated OR compared")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """One row for each document: doc_id, n_bytes, ``spans`` of removed bytes, and the bytes ``left``.

    A byte goes if a string of ``length`` bytes that covers it also starts
    anywhere else in ``docs``, which has doc_id and text; other columns are
    ignored. ``left`` is binary: a cut may fall within a character.
    """
    let_workers_import(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = stored(map_batches(rows, _blocks(BLOCK_BYTES), BLOCK), "blocks")
    requests = map_batches(blocks.select("block", "doc_ids", "sizes", "data"), _requests(length), REQUEST)
    asked = blocks.groupBy("block").cogroup(_states(requests).groupBy("asking"))
    placed = stored(asked.applyInArrow(_place(length), PLACED), "phrases")

    salt = F.pmod(F.xxhash64("block", "begin"), F.col("salts"))
    phrases = placed.filter("data IS NOT NULL").withColumn("group", F.xxhash64("anchor", salt))
    dealt = phrases.repartition("group").sortWithinPartitions("group")
    found = stored(map_batches(dealt, _compare(length, CHUNK_BYTES), FOUND), "repeats")
    same = Window.partitionBy("anchor", "name")
    named = found.filter("anchor IS NOT NULL").withColumn("times", F.count(F.lit(1)).over(same))
    ranges = ["block", "begin", "stop"]
    repeated = (
        placed.filter("data IS NULL").select(*ranges)
        .unionByName(found.filter("anchor IS NULL").select(*ranges))
        .unionByName(named.filter("times > 1 AND begin IS NOT NULL").select(*ranges))
    )
    holding = repeated.withColumnRenamed("block", "holding").groupBy("holding")
    return blocks.groupBy("block").cogroup(holding).applyInArrow(_clean(length), CLEANED)
