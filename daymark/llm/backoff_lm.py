"""Scoring texts by a weighted backoff automaton over smoothed n-grams.

Its states are the histories seen in training. A seen n-gram is an arc with
the logarithm of its smoothed probability; a failure arc leads from a history
h to the one a word shorter and weighs mu / (c(h) + mu). The arc of w at h weighs

    p(w | h) = (c(h w) + mu p(w | shorter h)) / (c(h) + mu)

and the root has p(w) = (c(w) + 1) / (N + V + 1). A text is read once from left to
right; each token follows its arc, after the failure arcs that lead to a state that has it.

The automaton of a large corpus fits no machine, so each block of documents
gets the part that its own texts walk through. Blocks send the sorted hashes of their
n-grams and the counts among their training documents, cut into ranges
of hashes; a range adds up what all blocks sent and tells each block the totals
that differ from its own counts. Rows number no more than distinct n-grams of blocks.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.tasks import let_workers_import, map_batches
from daymark.llm.text import NOT_SPACE, find_words, mix, slices, window_hashes

BEGIN, END = mix(np.array([0xB0, 0xE0], dtype=np.uint64))
BLOCK_BYTES = 12 << 20
BYTES_PER_RANGE = 12 << 20
TEXTS = 0  # the "order" of a row that holds the texts of a block
SENT = "order int, range int, block long, data binary"
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def squeeze(*arrays: np.ndarray) -> bytes:
    """Arrays of integers as compressed byte planes; sorted unsigned ones as differences."""
    press, parts = zstandard.ZstdCompressor(level=1), []
    for array in arrays:
        rising = array.dtype == np.uint64
        values = np.diff(array, prepend=np.uint64(0)) if rising else array
        planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T)
        data = press.compress(planes.tobytes())
        parts += [struct.pack("<II4s", len(data), len(array), array.dtype.str[1:].encode()), data]
    return b"".join(parts)


def unsqueeze(data: bytes) -> list[np.ndarray]:
    expand, at, out = zstandard.ZstdDecompressor(), 0, []
    while at < len(data):
        size, n, kind = struct.unpack_from("<II4s", data, at)
        dtype = np.dtype(f"<{kind.rstrip(bytes(1)).decode()}")
        raw = np.frombuffer(expand.decompress(data[at + 12 : at + 12 + size]), np.uint8)
        values = np.ascontiguousarray(raw.reshape(dtype.itemsize, n).T).reshape(-1).view(dtype)
        out.append(np.cumsum(values, dtype=np.uint64) if dtype == np.uint64 else values)
        at += 12 + size
    return out


def _grams(hashes: np.ndarray, heads: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The places at which an n-gram of a text ends, and its hash. ``heads``: where texts begin."""
    if order == 1:
        return np.arange(len(hashes)), hashes
    keys = window_hashes(hashes, order)
    lengths = np.diff(np.concatenate([heads, [len(hashes)]]))
    inside = np.arange(len(hashes)) - np.repeat(heads, lengths) >= order - 1
    at = np.flatnonzero(inside)
    return at, keys[at - order + 1]


def _read(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, a begin before and an end after each text, and where texts begin."""
    words = find_words(texts, NOT_SPACE)
    hashes = words.hashes()
    n = words.counts()
    hashes = np.insert(hashes, np.repeat(words.first[1:], 2), np.tile([END, BEGIN], len(n)))
    # Every text is now followed by its end and by the next one's begin.
    hashes = np.concatenate([[BEGIN], hashes[:-1]])
    return hashes, np.concatenate([[0], np.cumsum(n + 2)[:-1]]).astype(np.int64)


def _send(orders: range, ranges: int, with_texts: bool) -> Callable:
    """Rows (order, range, block, data) of documents (doc_id, text, held_out)."""
    bounds = (np.arange(1, ranges) * ((1 << 64) // ranges)).astype(np.uint64) if ranges > 1 else np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for low, high in slices(batch.column(1), BLOCK_BYTES):
                part = batch.slice(low, high - low)
                hashes, heads = _read(part.column(1))
                trained = ~part.column(2).to_numpy(zero_copy_only=False).astype(bool)
                lengths = np.diff(np.concatenate([heads, [len(hashes)]]))
                counted = np.repeat(trained, lengths)
                rows = []
                for order in orders:
                    at, keys = _grams(hashes, heads, order)
                    known, which = np.unique(keys, return_inverse=True)
                    counts = np.bincount(which[counted[at]], minlength=len(known)).astype(np.uint32)
                    cuts = np.concatenate([[0], np.searchsorted(known, bounds), [len(known)]])
                    for i in np.flatnonzero(np.diff(cuts)).tolist():
                        here = slice(cuts[i], cuts[i + 1])
                        rows.append((order, i, squeeze(known[here], counts[here])))
                    if order == 1 and with_texts:
                        ids = part.column(0)
                        data = squeeze(
                            known,
                            counts,
                            which.astype(np.uint32),
                            lengths.astype(np.uint32),
                            ids.fill_null(0).to_numpy().astype(np.int64),
                            np.array(ids.is_null()).astype(np.uint8),
                            trained.astype(np.uint8),
                        )
                        rows.append((TEXTS, 0, data))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in rows], pa.int32()),
                        pa.array([r[1] for r in rows], pa.int32()),
                        pa.array([block] * len(rows), pa.int64()),
                        pa.array([r[2] for r in rows], pa.binary()),
                    ],
                    names=["order", "range", "block", "data"],
                )
                block += 1

    return run


def _ranges_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple[int, bytes]]]]:
    """Rows of a range together; batches are sorted by (order, range). Texts come one by one."""
    key, rows = None, []
    for batch in batches:
        for order, number, block, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if order == TEXTS:
                yield (TEXTS, 0), [(block, data)]
                continue
            if (order, number) != key:
                if rows:
                    yield key, rows
                key, rows = (order, number), []
            rows.append((block, data))
    if rows:
        yield key, rows


def _totals(rows: list[tuple[int, bytes]]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Distinct keys, their totals, and (place, own count) for each row's keys."""
    sent = [unsqueeze(data) for _, data in rows]
    keys, which = np.unique(np.concatenate([s[0] for s in sent]), return_inverse=True)
    totals = np.bincount(which, np.concatenate([s[1] for s in sent]), len(keys)).astype(np.int64)
    ends = np.cumsum([len(s[0]) for s in sent])
    own = [(w, s[1]) for w, s in zip(np.split(which, ends[:-1]), sent, strict=True)]
    return keys, totals, own


def _vocabulary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, rows in _ranges_of(batches):
        keys, totals, _ = _totals(rows)
        totals = totals[keys != BEGIN]
        yield pa.RecordBatch.from_pydict(
            {"types": pa.array([int((totals > 0).sum())]), "tokens": pa.array([int(totals.sum())])}
        )


def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block, which of its keys of a range (counted from the first) have another total."""
    for (order, number), rows in _ranges_of(batches):
        if order == TEXTS:
            out = [(block, data) for block, data in rows]
        else:
            _, totals, own = _totals(rows)
            out = []
            for (block, _), (which, counts) in zip(rows, own, strict=True):
                total = totals[which]
                other = np.flatnonzero(total != counts)
                data = squeeze(other.astype(np.uint64), total[other]) + struct.pack("<Q", len(which))
                out.append((block, data))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([order] * len(out), pa.int32()),
                pa.array([number] * len(out), pa.int32()),
                pa.array([x[0] for x in out], pa.int64()),
                pa.array([x[1] for x in out], pa.binary()),
            ],
            names=["order", "range", "block", "data"],
        )


class Automaton:
    """States, arcs and failure arcs for the n-grams of one block, with the counts of the whole corpus.

    State 0 is the root; every other one is a history seen in training, of up
    to ``order - 1`` words. The arc of a word at a state has a log10 weight
    and leads to the longest history that ends in the word; words are codes of
    the block. ``failure`` leads to the history that is a word shorter.
    """

    def __init__(self, order: int, prior: float, tokens: int, types: int):
        self.order, self.prior = order, prior
        self.unknown = 1 / (tokens + types + 1)
        self.failure, self.penalty = [np.zeros(1, np.int64)], [np.zeros(1)]
        self.arcs: list[tuple[np.ndarray, ...]] = []
        self.states = 1
        # Of each distinct n-gram one word shorter: its state, probability and count.
        self.state, self.probability, self.count = np.zeros(1, np.int64), None, None

    def add(self, word: np.ndarray, history: np.ndarray, suffix: np.ndarray, count: np.ndarray) -> None:
        """Add the distinct n-grams of the next length: the code of the last word, the numbers of the n-grams
        without their last and without their first word, and counts in training."""
        if self.probability is None:
            probability = (count + 1) * self.unknown
            source, shorter = np.zeros(len(word), np.int64), np.zeros(len(word), np.int64)
            n = 1
        else:
            n = self.length + 1
            probability = (count + self.prior * self.probability[suffix]) / (self.count[history] + self.prior)
            source, shorter = self.state[history], self.state[suffix]
        self.length = n
        seen = count > 0
        state = shorter.copy()
        if n < self.order:
            new = np.flatnonzero(seen)
            state[new] = self.states + np.arange(len(new))
            self.failure.append(shorter[new])
            self.penalty.append(np.log10(self.prior / (count[new] + self.prior)))
            self.states += len(new)
        self.arcs.append((source[seen], word[seen], np.log10(probability[seen]), state[seen]))
        self.state, self.probability, self.count = state, probability, count

    def finish(self) -> None:
        source, word, self.weight, self.target = (np.concatenate(x) for x in zip(*self.arcs, strict=True))
        keys = (source.astype(np.uint64) << np.uint64(32)) | word.astype(np.uint64)
        order = np.argsort(keys)
        self.keys, self.weight, self.target = keys[order], self.weight[order], self.target[order]
        self.fails, self.costs = np.concatenate(self.failure), np.concatenate(self.penalty)

    def step(self, state: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next state and the log10 probability of ``word`` at each state."""
        log, after = np.zeros(len(state)), np.zeros(len(state), np.int64)
        left, here, asked = np.arange(len(state)), state, word.astype(np.uint64)
        while len(left):
            keys = (here.astype(np.uint64) << np.uint64(32)) | asked
            at = np.searchsorted(self.keys, keys)
            found = at < len(self.keys)
            found[found] = self.keys[at[found]] == keys[found]
            log[left[found]] += self.weight[at[found]]
            after[left[found]] = self.target[at[found]]
            # A word that not even the root knows leads back to the root.
            lost = ~found & (here == 0)
            log[left[lost]] += np.log10(self.unknown)
            on = ~found & ~lost
            log[left[on]] += self.costs[here[on]]
            left, here, asked = left[on], self.fails[here[on]], asked[on]
        return after, log

    def walk(self, words: np.ndarray, heads: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The log10 probability of each text, read from left to right after its begin; all texts move on together."""
        score = np.zeros(len(heads))
        order = np.argsort(-lengths, kind="stable")
        heads, lengths = heads[order], lengths[order]
        state, _ = self.step(np.zeros(len(heads), np.int64), words[heads])
        going = np.searchsorted(-lengths, -np.arange(int(lengths.max(initial=1))), side="left")
        for t in range(1, int(lengths.max(initial=1))):
            n = going[t]
            state, log = self.step(state[:n], words[heads[:n] + t])
            score[order[:n]] += log
        return score


def _walk(order: int, prior: float, tokens: int, types: int) -> Callable:
    """Scores of the texts of one block, from its texts and the answers of all ranges."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table[c].to_pylist() for c in ("order", "range", "data")), strict=True))
        known, counts, which, lengths, ids, no_id, trained = unsqueeze(rows[0][2])
        lengths = lengths.astype(np.int64)
        heads = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        hashes, counted = known[which], np.repeat(trained.astype(bool), lengths)
        automaton = Automaton(order, prior, tokens, types)
        number = None  # of the n-gram one word shorter that ends at each place
        for n in range(1, order + 1):
            if n == 1:
                at, place, own = np.arange(len(which)), which.astype(np.int64), counts.astype(np.int64)
            else:
                at, keys = _grams(hashes, heads, n)
                distinct, place = np.unique(keys, return_inverse=True)
                own = np.bincount(place[counted[at]], minlength=len(distinct)).astype(np.int64)
            base = 0
            for _, _, data in (r for r in rows if r[0] == n):
                other, total = unsqueeze(data[:-8])
                own[base + other.astype(np.int64)] = total
                base += struct.unpack("<Q", data[-8:])[0]
            one = np.zeros(len(own), dtype=np.int64)
            one[place] = at  # where some occurrence of each n-gram ends
            if n == 1:
                single = own
                automaton.add(np.arange(len(own)), one, one, own)
            else:
                automaton.add(which[one], number[one - 1], number[one], own)
            number = np.zeros(len(which), dtype=np.int64)
            number[at] = place
        automaton.finish()
        begins = np.zeros(len(which), dtype=bool)
        begins[heads] = True
        count = single[which]
        base_log = np.where(begins, 0.0, np.log10((count + 1) * automaton.unknown))
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64(), mask=no_id.astype(bool)),
                "held_out": pa.array(trained == 0),
                "n_tokens": pa.array(lengths - 1),
                "n_known": pa.array(np.add.reduceat(((count > 0) & ~begins).astype(np.int64), heads)),
                "base_score": pa.array(np.add.reduceat(base_log, heads)),
                "score": pa.array(automaton.walk(which, heads, lengths)),
            }
        )

    return run


def score_texts(
    docs: DataFrame,
    held_out: F.Column,
    order: int = 2,
    prior: float = 100.0,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every text.

    The model learns from the rows that are not ``held_out`` (null: not). Texts are the words between
    white space, A-Z lower-cased, and one end. A null or empty text is its end alone. ``n_known`` tokens were
    seen in training. Scores are log10 probabilities: ``base_score`` of single tokens, ``score`` along the
    automaton of n-grams up to ``order``. ``prior`` is mu. Repeated rows count and are scored each, a null id
    stays null, other columns are not read; without rows to learn from, tokens are equally likely.
    """
    docs = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = 1 << max(0, (size // BYTES_PER_RANGE)).bit_length()

    def in_ranges(sent: DataFrame) -> DataFrame:
        texts_apart = F.when(F.col("order") == TEXTS, F.col("block")).otherwise(F.col("range"))
        # A number that grows with the corpus, so that no task does.
        return sent.repartition(ranges * (order + 1), "order", texts_apart).sortWithinPartitions("order", "range")

    words = map_batches(docs, _send(range(1, 2), ranges, False), SENT)
    found = map_batches(in_ranges(words), _vocabulary, "types long, tokens long")
    types, tokens = found.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("types", "tokens")]).first()

    sent = map_batches(docs, _send(range(1, order + 1), ranges, True), SENT)
    answers = map_batches(in_ranges(sent), _answer, SENT)
    let_workers_import(docs.sparkSession)
    scores = answers.groupBy("block").applyInArrow(_walk(order, prior, tokens, types), SCORES)
    return scores.select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
