import random
from collections import defaultdict

import numpy as np
import pytest

from daymark.llm import repeats
from daymark.llm.repeats import corpus_order, remove_repeats
from tests.llm.odd import documents, odd_rows


def brute(rows, length):
    """(id, bytes, spans, bytes left) of every row, from all strings of all texts."""
    texts = [(i, (t or "").encode()) for i, t in rows]
    places = defaultdict(list)
    for k, (_, b) in enumerate(texts):
        for p in range(len(b) - length + 1):
            places[b[p : p + length]].append((k, p))
    gone = [np.zeros(len(b) + 1, dtype=bool) for _, b in texts]
    for found in places.values():
        for k, p in found if len(found) > 1 else ():
            gone[k][p : p + length] = True
    out = []
    for (i, b), g in zip(texts, gone, strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], g]).astype(int)))
        spans = tuple(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        out.append((i, len(b), spans, bytes(x for x, y in zip(b, g, strict=False) if not y)))
    return sorted(out, key=repr)


def found(df):
    rows = ((r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.left)) for r in df.collect())
    return sorted(rows, key=repr)


def text_rows(seed, n_docs=80):
    """Texts that share passages of all lengths, repeat themselves, or run on in one byte."""
    rng = random.Random(seed)

    def prose(n):
        return " ".join(f"w{rng.randrange(3000)}é" for _ in range(n))

    passages = [prose(60) for _ in range(5)] + ["-" * 900, "ab" * 300, prose(300)]
    rows = []
    for i in range(n_docs):
        text = prose(rng.randrange(1, 80))
        for _ in range(rng.randrange(3)):
            passage = rng.choice(passages)
            low = rng.randrange(len(passage))
            text += rng.choice([" ", "|"]) + passage[low : rng.randrange(low, len(passage) + 1)] + prose(rng.randrange(1, 20))
        rows.append((i, text + rng.choice(["", "", "", rng.choice(passages)])))
    for i in range(n_docs, n_docs + 20):
        rows.append((i, prose(5) + prose(2) * rng.randrange(2, 40) + prose(5)))
    return rows + [(500, None), (None, prose(40)), (501, ""), (502, rows[3][1]), (3, rows[3][1]), (None, None)]


@pytest.mark.parametrize("length", [200, 7])
@pytest.mark.parametrize("per_task, chunk", [(8192, 1 << 20), (3, 3000)])
def test_against_all_strings(spark, monkeypatch, length, per_task, chunk):
    monkeypatch.setattr(repeats, "PHRASES_PER_TASK", per_task)
    monkeypatch.setattr(repeats, "CHUNK_BYTES", chunk)
    rows = text_rows(length)
    assert found(remove_repeats(documents(spark, rows), length)) == brute(rows, length)


def test_odd_rows(spark):
    rows = odd_rows()
    assert found(remove_repeats(documents(spark, rows))) == brute(rows, 200)


def test_a_hot_mark_is_compared_across_tasks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "PHRASES_PER_TASK", 16)
    rng = random.Random(8)
    passage = " ".join(f"p{rng.randrange(10**6)}" for _ in range(50))
    rows = [(i, f"{rng.randrange(10**9):09} {passage} {rng.randrange(10**9):09} {'z' * rng.randrange(400)}") for i in range(300)]
    assert found(remove_repeats(documents(spark, rows))) == brute(rows, 200)


def test_long_text_in_slices(spark, monkeypatch):
    """A text that is longer than a block, and slices of its strings."""
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1 << 10)
    rng = random.Random(2)
    unit = "".join(rng.choice("abcdefgh") for _ in range(700))
    long_text = "".join(rng.choice("abcdefgh") for _ in range(5000)) + unit + "x" * 3000 + unit
    rows = [(1, long_text), (2, "short"), (3, unit[100:400])]
    assert found(remove_repeats(documents(spark, rows))) == brute(rows, 200)
    whole = repeats.Phrases(_block([long_text]), 200)
    monkeypatch.setattr(repeats, "STARTS", 1 << 10)
    parts = repeats.Phrases(_block([long_text]), 200)
    n = len(long_text) - 199
    assert len(parts.begin) > len(whole.begin)
    for found_phrases in (whole, parts):
        counts = found_phrases.stop - found_phrases.begin
        assert counts.sum() == n and (found_phrases.begin[1:] == found_phrases.stop[:-1]).all()
    # Cuts move no string to another mark.
    marks = [np.repeat(p.anchor, p.stop - p.begin) for p in (whole, parts)]
    assert (marks[0] == marks[1]).all()


def _block(texts):
    block = repeats.Block.__new__(repeats.Block)
    raw = [t.encode() for t in texts]
    block.sizes = np.array([len(b) for b in raw])
    block.data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    return block


@pytest.mark.parametrize("length", [1, 3, 8, 13, 16, 200])
def test_corpus_order_is_the_order_of_suffixes(length):
    rng = np.random.default_rng(length)
    data = rng.integers(97, 99, 900, dtype=np.uint8)
    data[300:600] = data[:300]
    starts = np.arange(len(data) - length + 1)
    strings = [data[s : s + length].tobytes() for s in starts]
    ranks = {x: k for k, x in enumerate(sorted(set(strings)))}
    assert corpus_order(data, starts, length).tolist() == [ranks[x] for x in strings]


def test_sliding_least():
    values = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64)
    for width in (1, 2, 151, 1000):
        expected = [values[i : i + width].min() for i in range(len(values) - width + 1)]
        assert repeats._sliding_least(values, width).tolist() == expected


def test_empty_table(spark):
    assert remove_repeats(documents(spark, [])).collect() == []
    assert found(remove_repeats(documents(spark, [(1, ""), (2, None)]))) == [(1, 0, (), b""), (2, 0, (), b"")]
