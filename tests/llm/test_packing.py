import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from daymark.llm.packing import cut_documents, minimum_bin_slack, pack
from daymark.llm.queries import tokenizer
from tests.llm.odd import collected, documents, odd_rows

WORDS = "word_bpe_49k.json"


def expected_pieces(rows, limit):
    library = Tokenizer.from_file(tokenizer(WORDS))
    library.encode_special_tokens = True
    out = []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for p, start in enumerate(range(0, len(ids), limit)):
            part = ids[start : start + limit]
            out.append((doc, p, start, len(part), np.array(part, "<u4").tobytes()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("limit", [7, 2048])
def test_pieces_and_places(spark, limit):
    rows = odd_rows()
    pieces = cut_documents(documents(spark, rows), tokenizer(WORDS), limit)
    packed = pack(pieces, limit)
    assert collected(packed, "doc_id", "piece", "start", "length", "ids") == [
        (d, p, s, n, bytearray(b)) for d, p, s, n, b in expected_pieces(rows, limit)
    ]
    sequences = defaultdict(list)
    for r in packed.collect():
        sequences[r.sequence_id].append((r.offset, r.length))
    for content in sequences.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= limit
    total = sum(n for c in sequences.values() for _, n in c)
    assert len(sequences) <= -(-total // limit) + 1


def test_empty_table(spark):
    assert collected(pack(cut_documents(documents(spark, []), tokenizer(WORDS)))) == []


@pytest.mark.parametrize("seed", range(6))
def test_bins_hold_all_pieces(seed):
    rng, limit = random.Random(seed), 60
    counts = {rng.randrange(1, limit + 1): rng.randrange(1, 50) for _ in range(rng.randrange(1, 30))}
    used = Counter()
    bins = minimum_bin_slack(counts, limit)
    for alike, content in bins:
        assert sum(n * c for n, c in content) <= limit
        for n, c in content:
            used[n] += alike * c
    assert used == Counter(counts)


def test_the_fullest_combination_is_found():
    # Best fit by size alone would put 6 + 3 first and need three bins.
    assert minimum_bin_slack({6: 1, 5: 1, 4: 1, 3: 1, 2: 1}, 10) == [(1, [(6, 1), (4, 1)]), (1, [(5, 1), (3, 1), (2, 1)])]
    assert minimum_bin_slack({5: 1_000_000, 10: 3}, 10) == [(3, [(10, 1)]), (500_000, [(5, 2)])]
    assert minimum_bin_slack({}, 10) == []
