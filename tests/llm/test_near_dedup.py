import random
import re

import numpy as np
import pytest

from daymark.llm.groups import components
from daymark.llm.near_dedup import near_duplicates, rare_pairs, signatures, unsettled
from tests.llm.odd import collected, documents, odd_rows


def shingles(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return frozenset()
    return frozenset(tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1)))


def brute(rows, size, percent):
    """(doc_id, n_shingles, component_id, kept) of every row, by comparing all pairs."""
    sets = [shingles(t, size) for _, t in rows]
    low = {i: i for i, _ in rows if i is not None}
    moved = True
    while moved:
        moved = False
        for (i, _), s in zip(rows, sets):
            for (j, _), t in zip(rows, sets):
                if None in (i, j) or not s or not t:
                    continue
                if 100 * len(s & t) >= percent * len(s | t) and low[i] < low[j]:
                    low[j], moved = low[i], True
    return sorted(
        ((i, len(s), low.get(i), i is None or low[i] == i) for (i, _), s in zip(rows, sets)), key=repr
    )


@pytest.mark.parametrize("size", [4, 5])
def test_against_all_pairs(spark, size):
    rows = odd_rows()
    assert collected(near_duplicates(documents(spark, rows), words=size)) == brute(rows, size, 80)


def test_large_groups_of_graded_copies(spark):
    """Many links hang on one text or on each other only; unlike ones share its passages."""
    rng = random.Random(5)
    base = [f"b{i}" for i in range(90)]
    rows = [(0, " ".join(base))]
    for i in range(1, 160):
        copy = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 4, 8, 15])):
            copy[rng.randrange(len(copy))] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(copy)))
    got = collected(near_duplicates(documents(spark, rows), words=4))
    expected = brute(rows, 4, 80)
    assert got == expected
    assert len({r[2] for r in expected}) > 10


def test_empty_table(spark):
    assert collected(near_duplicates(documents(spark, []))) == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 1 << 63, 1000).astype(np.uint64)
    for shared in (0, 300, 600):
        a, b = pool[:600], np.concatenate([pool[:shared], pool[1000 - 600 + shared :]])[:600]
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        values = signatures([np.unique(a), np.unique(b)], 256)
        assert abs((values[0] == values[1]).mean() - true) < 0.12
    one = signatures([pool[:1], pool[:0]], 64)
    assert len(np.unique(one[0] >> np.uint64(56))) == 64  # a permutation of the ranks
    assert (one[1] == np.iinfo(np.uint64).max).all()


def test_components_of_a_long_path(spark):
    n = 60
    links = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(100, 101)], "a long, b long")
    got = dict(collected(components(links.repartition(7))))
    assert got == {**{i: 0 for i in range(1, n + 1)}, 101: 100}
    assert collected(components(links.filter("a < 0"))) == []


def test_exact_remainder_misses_no_link(spark):
    rng = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    texts = []
    for i in range(80):
        copy = list(base)
        for _ in range(rng.randrange(6)):
            copy[rng.randrange(60)] = f"y{rng.randrange(40)}"
        texts.append((i, " ".join(copy)))
    members = spark.createDataFrame([(1, i) for i, _ in texts], "bucket long, node long")
    nodes = unsettled(members, spark.createDataFrame([], "a long, b long"))
    assert nodes.count() == 80
    pairs = rare_pairs(nodes, spark.createDataFrame(texts, "node long, text string"), 4, 80)
    sets = {i: shingles(t, 4) for i, t in texts}
    linked = {
        (i, j) for i in sets for j in sets
        if i < j and sets[i] != sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    }
    assert linked and linked <= {tuple(sorted(p)) for p in collected(pairs)}


def test_an_id_with_several_texts_is_linked_by_any_of_them(spark):
    rng = random.Random(9)

    def text(start):
        return [f"{start}{i}" for i in range(60)]

    def near(words):
        copy = list(words)
        copy[rng.randrange(60)] = f"y{rng.randrange(10**6)}"
        return " ".join(copy)

    a, b, c = text("a"), text("b"), text("c")
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a)), (3, near(b)), (0, " ".join(b))]
    rows += [(7, " ".join(c)), (8, near(c)), (9, "alone here"), (8, near(a)), (9, None)]
    assert collected(near_duplicates(documents(spark, rows), words=4)) == brute(rows, 4, 80)
    many = [(i % 7, near(rng.choice([a, b, c, text("d")]))) for i in range(40)]
    assert collected(near_duplicates(documents(spark, many), words=4)) == brute(many, 4, 80)
