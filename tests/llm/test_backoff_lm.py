import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import backoff_lm
from daymark.llm.backoff_lm import score_texts, squeeze, unsqueeze
from tests.llm.odd import collected, documents, odd_rows


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered) + ["</s>"]


def brute(rows, held_out, order, prior):
    counts = [Counter() for _ in range(order + 1)]
    for doc, text in rows:
        if not held_out(doc):
            padded = ["<s>", *tokens(text)]
            for n in range(1, order + 1):
                counts[n].update(tuple(padded[i : i + n]) for i in range(len(padded) - n + 1))
    begins = counts[1].pop(("<s>",), 0)
    total, types = sum(counts[1].values()), len(counts[1])
    counts[1][("<s>",)] = begins
    out = []
    for doc, text in rows:
        padded = ["<s>", *tokens(text)]
        score = base = 0.0
        for i in range(1, len(padded)):
            p = (counts[1][tuple(padded[i : i + 1])] + 1) / (total + types + 1)
            base += math.log10(p)
            for n in range(2, order + 1):
                if i - n + 1 >= 0:
                    gram = tuple(padded[i - n + 1 : i + 1])
                    p = (counts[n][gram] + prior * p) / (counts[n - 1][gram[:-1]] + prior)
            score += math.log10(p)
        known = sum(counts[1][(w,)] > 0 for w in padded[1:])
        out.append((doc, held_out(doc), len(padded) - 1, known, total, base, score))
    return sorted(out, key=repr)


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("block", [1 << 12, 12 << 20])
def test_against_counts(spark, order, block, monkeypatch):
    monkeypatch.setattr(backoff_lm, "BLOCK_BYTES", block)
    monkeypatch.setattr(backoff_lm, "BYTES_PER_RANGE", block)
    rows = odd_rows()
    docs = documents(spark, rows).repartition(3)
    got = collected(score_texts(docs, F.col("doc_id") % 5 == 2, order, prior=10.0))
    expected = brute(rows, lambda d: d is not None and d % 5 == 2, order, 10.0)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert np.allclose([g[5:] for g in got], [e[5:] for e in expected], rtol=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_add_up(spark, order):
    """After every history, seen or not, the known words, the end and the share of unknown words make one.

    There is one unknown word of probability 1 / (N + V + 1) at the root; it keeps the share of all of them.
    """
    texts = [(i, t) for i, t in enumerate(["a b a b c", "a a b", "c b", "b"])]
    histories = ["", "a", "b", "c", "a b", "b a", "a a", "c c", "unseen", "a unseen", "a b c"]
    words = ["a", "b", "c", "other"]
    asked = [(h, w) for h in histories for w in [*words, None]]
    rows = texts + [(100 + i, " ".join(x for x in (h, w) if x)) for i, (h, w) in enumerate(asked)]
    scored = score_texts(documents(spark, rows), F.col("doc_id") >= 100, order, prior=2.0)
    got = {r.doc_id: r.score for r in scored.collect()}
    text = {asked[i]: got[100 + i] for i in range(len(asked))}

    def after(history, word):
        """The probability of a word after a history: of its text less that of the end, over that of the history alone."""
        return brute_step(texts, history, word, order, 2.0)

    for history in histories:
        total = sum(10 ** after(history, w) for w in words) + 10 ** after(history, None)
        assert total == pytest.approx(1.0)
        for w in [*words, None]:
            whole = (history.split() + [w]) if w else history.split()
            steps = sum(after(" ".join(whole[:k]), x) for k, x in enumerate([*whole, None]))
            assert text[history, w] == pytest.approx(steps, abs=1e-9)


def brute_step(texts, history, word, order, prior):
    """log10 of p(word | history) by the formula, None for the end."""
    padded = ["<s>", *history.split(), "</s>" if word is None else word]
    counts = [Counter() for _ in range(order + 1)]
    for _, t in texts:
        line = ["<s>", *tokens(t)]
        for n in range(1, order + 1):
            counts[n].update(tuple(line[i : i + n]) for i in range(len(line) - n + 1))
    total = sum(c for (w,), c in counts[1].items() if w != "<s>")
    p = (counts[1][(padded[-1],)] + 1) / (total + len(counts[1]) - 1 + 1)
    for n in range(2, min(order, len(padded)) + 1):
        gram = tuple(padded[-n:])
        p = (counts[n][gram] + prior * p) / (counts[n - 1][gram[:-1]] + prior)
    return math.log10(p)


def test_automaton_fails_over_to_shorter_histories():
    """Words 0 to 3 with the bigrams 0 1 and 1 2; 3 was never seen."""
    automaton = backoff_lm.Automaton(2, prior=1.0, tokens=6, types=3)
    none = np.zeros(4, np.int64)
    automaton.add(np.arange(4), none, none, np.array([3, 2, 1, 0]))
    automaton.add(np.array([1, 2]), np.array([0, 1]), np.array([1, 2]), np.array([2, 1]))
    automaton.finish()
    assert automaton.states == 4 and automaton.fails.tolist() == [0, 0, 0, 0]
    state, log = automaton.step(np.array([0, 1, 1, 2, 3]), np.array([0, 1, 2, 3, 0]))
    assert state.tolist() == [1, 2, 3, 0, 1]
    p1 = np.array([4, 3, 2, 1]) / 10
    expected = [p1[0], (2 + p1[1]) / 4, p1[2] / 4, p1[3] / 3, p1[0] / 2]
    assert np.allclose(10**log, expected)


def test_without_rows(spark):
    assert collected(score_texts(documents(spark, []), F.lit(False))) == []
    all_out = collected(score_texts(documents(spark, [(1, "a b"), (2, None)]), F.lit(True)))
    assert [r[:5] for r in all_out] == [(1, True, 3, 0, 0), (2, True, 1, 0, 0)]
    assert all(r[5] == 0.0 and r[6] == 0.0 for r in all_out)


def test_squeezed_arrays_come_back():
    draw = np.random.default_rng(0)
    keys = np.unique(draw.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    arrays = [keys, draw.integers(0, 9, 1000).astype(np.uint32), keys[:0], np.array([-5, 7])]
    assert all((a == b).all() for a, b in zip(arrays, unsqueeze(squeeze(*arrays)), strict=True))
