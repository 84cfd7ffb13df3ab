import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from daymark.llm.planes import BLOCK, read_ids, read_segment, segment_starts, write_ids, write_segment
from daymark.llm.queries import tokenizer
from tests.llm.odd import documents, odd_rows

BYTES = "byte_bpe_50k.json"


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("dtype", [np.uint16, np.uint32])
@pytest.mark.parametrize("n", [0, 1, 7, BLOCK, 2 * BLOCK + 13])
def test_segment_round_trip(bits, dtype, n):
    ids = np.random.default_rng(n).integers(0, np.iinfo(dtype).max, n).astype(dtype)
    docs, lengths = [5, None, -3], np.array([n, 0, 0])
    got = read_segment(write_segment(docs, lengths, ids, bits))
    assert got[0] == docs and got[1].tolist() == lengths.tolist() and (got[2] == ids).all()


@pytest.mark.parametrize("bits", [False, True])
def test_files_hold_all_ids_in_order(spark, tmp_path, bits):
    rows = odd_rows()
    target = str(tmp_path / "ids")
    write_ids(documents(spark, rows).repartition(5), target, tokenizer(BYTES), bits=bits)
    got = (
        read_ids(spark, target)
        .join(segment_starts(spark, target), ["shard", "segment"])
        .select("doc_id", (F.col("segment_start") + F.col("place")).alias("start"), "ids")
        .orderBy("start")
        .collect()
    )
    library = Tokenizer.from_file(tokenizer(BYTES))
    start = 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    assert len(got) == len(order)
    for row, (doc, text) in zip(got, order):
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        assert (row.doc_id, row.start, zlib.crc32(row.ids)) == (doc, start, zlib.crc32(ids))
        start += len(ids) // 4


def test_empty_table(spark, tmp_path):
    target = str(tmp_path / "none")
    write_ids(documents(spark, []), target, tokenizer(BYTES))
    assert read_ids(spark, target).collect() == [] and segment_starts(spark, target).collect() == []
