"""How quality filters overlap, over every order of applying them, from a sparse document-term matrix.

Words of all documents get ids of one dictionary for the whole table. Each
shard of documents is a matrix in compressed sparse rows: a row is a document,
a column a word id, a value the number of times the word occurs there. Row sums
and nonzero counts decide the filters on words; the other filters are attached
to the rows, and counts per set of failed filters give the figures of all
orders.

Defined results: a null text is empty, a null source is the empty string. Rows
that repeat an id count each. A row with a null id counts, has no labels, and
neither is a copy nor makes others one. A label table with several rows of an
id counts a label if any of them has it. An empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.storage import stored
from daymark.llm.tasks import let_workers_import, map_batches
from daymark.llm.terms import encoded_words, text_bytes
from daymark.llm.text import NOT_SPACE, slices, text_offsets

FILTERS = "ABCDE"
SHARD_BYTES = 6 << 20
IDS_AT_ONCE = 1 << 20

ROWS = "doc_ids array<bigint>, sources array<string>, hashes array<binary>, n_upper array<bigint>, n_chars array<bigint>, signs array<boolean>"
# Codes and counts are compressed 32-bit whole numbers; those of the matrix are plain little-endian ones.
ENCODED = f"shard bigint, {ROWS}, words array<binary>, indptr binary, codes binary, counts binary"
ANSWER = "asking bigint, codes binary, ids binary"
MATRIX = f"shard bigint, {ROWS}, indptr binary, columns binary, counts binary"
STATISTICS = "doc_id bigint, source string, hash binary, n_words bigint, n_distinct bigint, n_upper bigint, n_chars bigint, sign boolean"

UPPER = np.zeros(256, dtype=bool)
UPPER[0x41:0x5B] = True
FIRST_OF_CHAR = (np.arange(256) & 0xC0) != 0x80
SIGN = np.zeros(256, dtype=bool)
SIGN[list(b"#$%&*|")] = True


def _packed(values: np.ndarray) -> bytes:
    return pa.compress(pa.py_buffer(np.ascontiguousarray(values)), codec="zstd", asbytes=True)


def _unpacked(values: pa.Scalar, n: int, kind: type) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(values.as_buffer(), size, codec="zstd") if size else b"", dtype=kind)


def _one_list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many bytes of each text have the flag."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def _shard(batch: pa.RecordBatch, number: int) -> pa.RecordBatch:
    """The rows of ``batch`` as one shard, with word codes of its own dictionary."""
    texts = batch.column("text")
    codes, words, first = encoded_words(texts, NOT_SPACE)
    rows = np.repeat(np.arange(len(texts)), np.diff(first))
    width = max(len(words), 1)
    cells, counts = np.unique(rows * width + codes, return_counts=True)
    data = text_bytes(texts)
    offsets = text_offsets(texts)
    offsets = offsets - offsets[0]
    fields = {
        "shard": pa.array([number], pa.int64()),
        "doc_ids": _one_list(batch.column("doc_id")),
        "sources": _one_list(batch.column("source")),
        "hashes": _one_list(batch.column("hash")),
        "n_upper": _one_list(pa.array(_per_text(UPPER[data], offsets))),
        "n_chars": _one_list(pa.array(_per_text(FIRST_OF_CHAR[data], offsets))),
        "signs": _one_list(pa.array(_per_text(SIGN[data], offsets) > 0)),
        "words": _one_list(words),
        "indptr": pa.array([np.searchsorted(cells, np.arange(len(texts) + 1) * width).astype("<i8").tobytes()]),
        "codes": pa.array([_packed((cells % width).astype("<i4"))]),
        "counts": pa.array([_packed(counts.astype("<i4"))]),
    }
    return pa.RecordBatch.from_pydict(fields)


def _shards(limit: int):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 33)
        for batch in batches:
            for low, high in slices(batch.column("text"), limit):
                yield _shard(batch.slice(low, high - low), next(numbers))

    return shards


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of words, which come in order: each word that differs from the one before is a new one.

    The ids go back to the shards that asked, some of them at once.
    """
    last, number = None, TaskContext.get().partitionId() << 40
    held, size = [], 0
    for batch in batches:
        words = batch.column("word")
        if len(words) == 0:
            continue
        new = np.ones(len(words), dtype=np.int64)
        new[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        new[0] = words[0] != last
        ids = number + np.cumsum(new)
        last, number = words[-1], int(ids[-1])
        held.append((batch.column("shard").to_numpy(), batch.column("code").to_numpy(), ids))
        size += len(words)
        if size >= IDS_AT_ONCE:
            yield _answers(held)
            held, size = [], 0
    if held:
        yield _answers(held)


def _answers(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    shards, codes, ids = (np.concatenate(column) for column in zip(*held, strict=True))
    order = np.argsort(shards, kind="stable")
    asking, first = np.unique(shards[order], return_index=True)
    parts = np.split(order, first[1:])
    return pa.RecordBatch.from_pydict({
        "asking": pa.array(asking),
        "codes": pa.array([_packed(codes[p].astype("<i4")) + len(p).to_bytes(8, "little") for p in parts]),
        "ids": pa.array([_packed(ids[p].astype("<i8")) for p in parts]),
    })


def _with_word_ids(shard: pa.Table, answers: pa.Table) -> pa.Table:
    """The shard with ids of the whole table's dictionary as columns of its matrix."""
    shard = shard.combine_chunks()
    indptr = np.frombuffer(shard.column("indptr")[0].as_buffer(), dtype="<i8")
    n = int(indptr[-1])
    codes = _unpacked(shard.column("codes")[0], n, "<i4")
    of_code = np.zeros(int(codes.max(initial=-1)) + 1, dtype="<i8")
    for code, ids in zip(answers.column("codes"), answers.column("ids"), strict=True):
        raw = code.as_buffer()
        size = int.from_bytes(raw.to_pybytes()[-8:], "little")
        at = np.frombuffer(pa.decompress(raw.slice(0, raw.size - 8), 4 * size, codec="zstd"), dtype="<i4")
        of_code[at] = _unpacked(ids, size, "<i8")
    columns = pa.array([of_code[codes].tobytes()])
    counts = pa.array([_unpacked(shard.column("counts")[0], n, "<i4").tobytes()])
    kept = shard.drop_columns(["codes", "counts"])
    return kept.append_column("columns", columns).append_column("counts", counts)


def term_matrix(docs: DataFrame) -> DataFrame:
    """Shards of the document-term matrix in compressed sparse rows.

    ``docs`` has doc_id, text and source. Row i of a shard has the columns
    ``columns[indptr[i]:indptr[i + 1]]``, ids of words that are the same in all
    shards, and the values ``counts`` at the same places; these are 64-bit,
    64-bit and 32-bit little-endian whole numbers. A shard holds about
    ``SHARD_BYTES`` of text, or one longer text.

    A shard asks once for each of its words, so that no word has more rows than
    there are shards. One exchange brings equal words together, and a second
    one takes their ids back.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.unhex(F.sha2(text, 256)).alias("hash"),
        text.alias("text"),
    )
    shards = stored(map_batches(rows, _shards(SHARD_BYTES), ENCODED), "shards")
    asked = shards.select("shard", F.posexplode("words").alias("code", "word"))
    in_order = asked.repartition("word").sortWithinPartitions("word")
    answers = map_batches(in_order, _numbered, ANSWER)
    let_workers_import(docs.sparkSession)
    plain = shards.drop("words").groupBy("shard")
    return plain.cogroup(answers.groupBy("asking")).applyInArrow(_with_word_ids, MATRIX)


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            indptr = np.frombuffer(batch.column("indptr")[i].as_buffer(), dtype="<i8")
            counts = np.frombuffer(batch.column("counts")[i].as_buffer(), dtype="<i4")
            sums = np.zeros(len(counts) + 1, dtype=np.int64)
            np.cumsum(counts, out=sums[1:])

            def of_rows(name: str, batch=batch, i=i) -> pa.Array:
                return batch.column(name).slice(i, 1).flatten()

            yield pa.RecordBatch.from_pydict({
                "doc_id": of_rows("doc_ids"),
                "source": of_rows("sources"),
                "hash": of_rows("hashes"),
                "n_words": pa.array(np.diff(sums[indptr])),
                "n_distinct": pa.array(np.diff(indptr)),
                "n_upper": of_rows("n_upper"),
                "n_chars": of_rows("n_chars"),
                "sign": of_rows("signs"),
            })


def document_statistics(docs: DataFrame) -> DataFrame:
    """One row for each document: row sums and nonzero counts of its matrix row, and its other measures."""
    return map_batches(term_matrix(docs), _statistics, STATISTICS)


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def failed_filters(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, source, and ``failed``, the bits of the filters A to E that it fails."""
    measured = stored(document_statistics(docs), "measured")
    tests = {
        "A": F.col("n_words") < 200,
        "B": 100 * F.col("n_distinct") < 50 * F.col("n_words"),
        "C": 100 * F.col("n_upper") > 2 * F.col("n_chars"),
        "D": F.col("sign"),
    }
    bits = sum((F.when(test, _bit(letter)).otherwise(0) for letter, test in tests.items()), F.lit(0))
    flagged = measured.select("doc_id", "source", "hash", bits.alias("failed"))
    known = flagged.filter("doc_id IS NOT NULL")
    # The id is part of the key, so that many copies of one text don't meet in one task.
    firsts = known.groupBy("hash").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    copies = known.join(firsts, ["doc_id", "hash"], "left")
    failed = F.when(F.col("first").isNull(), F.col("failed") + _bit("E")).otherwise(F.col("failed"))
    checked = copies.select("doc_id", "source", failed.alias("failed"))
    return checked.unionByName(flagged.filter("doc_id IS NULL").select("doc_id", "source", "failed"))


def _with_labels(flagged: DataFrame, labels: DataFrame) -> DataFrame:
    any_label = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    known = flagged.filter("doc_id IS NOT NULL").join(any_label, "doc_id", "left")
    unknown = flagged.filter("doc_id IS NULL").withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return known.unionByName(unknown).fillna(0, ["good", "toxic"])


def _in_every_order(sets: DataFrame) -> DataFrame:
    """Each row for every step of every order, with the bits of the step's filter and of all earlier ones."""
    orders = ["".join(order) for order in itertools.permutations(FILTERS)]
    bit_of = f"shiftleft(1, instr('{FILTERS}', x) - 1)"
    each = sets.withColumn("filter_order", F.explode(F.lit(orders)))
    each = each.withColumn("step", F.explode(F.lit(list(range(1, len(FILTERS) + 1)))))
    bits = each.withColumn("bits", F.expr(f"transform(split(filter_order, ''), x -> {bit_of})"))
    return bits.withColumns({
        "bit": F.expr("bits[step - 1]"),
        "earlier": F.expr("aggregate(slice(bits, 1, step - 1), 0, (a, x) -> a + x)"),
    })


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each source, order of the filters and step: what the step keeps, removes, repeats and loses.

    ``docs`` has doc_id, text, source, ``labels`` doc_id, quality, toxic;
    other columns are ignored. ``shapley`` is the filter's removals summed
    over all orders: a document that fails k filters counts 120 / k for each.
    """
    labelled = _with_labels(failed_filters(docs), labels)
    sets = labelled.groupBy(F.col("source").alias("part"), "failed").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    each = _in_every_order(sets)
    failed, bit, earlier = F.col("failed"), F.col("bit"), F.col("earlier")
    fails = failed.bitwiseAND(bit) != 0
    left = failed.bitwiseAND(earlier) == 0

    def count(of: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(of)).otherwise(0)).cast("long")

    share = F.expr("n * (120 div greatest(bit_count(failed), 1))")
    return each.groupBy("part", "filter_order", "step").agg(
        count("n", left & ~fails).alias("kept"),
        count("n", left & fails).alias("removed"),
        count("n", ~left & fails).alias("redundant"),
        count("n", failed == bit).alias("unique_fails"),
        count("good", left & fails).alias("good_lost"),
        count("toxic", left & fails).alias("toxic_lost"),
        F.sum(F.when(fails, share).otherwise(0)).cast("long").alias("shapley"),
    )
