import random
import re

import pytest

from daymark.llm.decontaminate import contaminated, find_benchmark, hit_words, remove_documents, remove_spans
from tests.llm.odd import documents, odd_rows


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items, size=13):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(size, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        out.append((doc, len(w), len(hit), sorted(x for x in found if x is not None), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def cases():
    rng = random.Random(2)
    rows = odd_rows()
    long = next(t for i, t in rows if i == 60).split()
    items = [(1, " ".join(long[100:140])), (2, " ".join(long[120:133])), (3, "two words"), (4, None), (5, "")]
    items += [(6, "One"), (7, "...!"), (None, " ".join(long[5:25])), (1, " ".join(long[300:320]).upper())]
    rows += [(70 + i, ", ".join(long[s : s + 12 + i]) + " end") for i, s in enumerate(range(95, 130, 7))]
    rows += [(90, "Two, WORDS; and two_words"), (91, " ".join(long[100:140] * 30)), (92, "naïve été 東京 two words")]
    rng.shuffle(rows)
    return rows, items


@pytest.mark.parametrize("limit", [10**9, 150])
def test_against_brute_force(spark, limit):
    rows, items = cases()
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, found string")
    docs = documents(spark, rows)
    found = find_benchmark(docs, benchmark, max_block_chars=limit)
    assert found.columns == [*[c for c in docs.columns if c != "found"], "found"]
    got = found.select("doc_id", "found.n_words", hit_words(), "found.items", contaminated()).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, items)


def test_removal(spark):
    item = "the quick brown fox jumps over the lazy dog and then runs home again"
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    rows = [(1, f"Before! {item.upper()}, after"), (2, "clean text"), (3, None), (4, item + " filler" * 600)]
    docs = documents(spark, rows)
    kept = remove_documents(docs, benchmark)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {2, 3, 4}
    cut = {r.doc_id: r.text for r in remove_spans(docs, benchmark).collect()}
    assert cut == {1: "Before! , after", 2: "clean text", 3: None, 4: " filler" * 600}


def test_empty_tables(spark):
    benchmark = spark.createDataFrame([], "item_id long, text string")
    found = find_benchmark(documents(spark, [(1, "a b"), (2, None)]), benchmark).collect()
    assert sorted((r.doc_id, r.found.n_words, r.found.hits) for r in found) == [(1, 2, []), (2, 0, [])]
    assert find_benchmark(documents(spark, []), benchmark).collect() == []
