import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from daymark.llm import source_divergence
from daymark.llm.source_divergence import divergence, priced_product
from tests.llm.odd import CLASHING, odd_rows

CLASHES = CLASHING + ("term", "total", "value", "rank", "other", "price", "in_lang", "n_docs")


def table(spark, rows):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], schema)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, least, most=50):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered(text))
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def prices(source, lang=lang, kept=kept):
            count = counts[lang, source]
            total = sum(count[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (count[t] + 5) // total for t in kept}

        p, q = {s: prices(s) for s in sources}, prices(None)
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            above = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, limit in (("pair", pairs, None), ("term", above, most)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(items[:limit], start=1)]
    return sorted(out)


def divergence_rows(seed=1, n_sources=9):
    rng = random.Random(seed)
    rows = [(i, t, rng.choice(["en", None, ""]), rng.choice(["a", "b", None])) for i, t in odd_rows(seed)]
    for i in range(100, 400):
        s = min(rng.randrange(2 * n_sources), n_sources)
        text = " ".join(rng.choice("aBcdé") + rng.choice("xyzö") * rng.randrange(1, 2 + s % 5) for _ in range(rng.randrange(30)))
        rows.append((i, text + " 1,2-three", rng.choice(["en", "de"]), f"s{s}"))
    return rows + [(900, "few words", "xx", "only"), (901, "few", "xx", "two"), (902, None, "zz", "one"), rows[-1], rows[-1]]


@pytest.mark.parametrize("tile, slab", [(32, 8192), (3, 10)])
def test_against_plain_python(spark, monkeypatch, tile, slab):
    monkeypatch.setattr(source_divergence, "GROUPS_PER_TILE", tile)
    monkeypatch.setattr(source_divergence, "TERMS_PER_SLAB", slab)
    monkeypatch.setattr(source_divergence, "SLICE", 1 << 12)
    rows = divergence_rows()
    got = divergence(table(spark, rows), least_documents=3)
    names = ("lang", "source", "part", "item", "value", "rank")
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == brute(rows, 3)


def test_languages_without_kept_terms(spark):
    rows = divergence_rows()
    got = divergence(table(spark, rows), least_documents=10**6).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 10**6)
    assert {r.value for r in got} == {0}


def test_prices_of_large_counts_are_exact(spark):
    n, total = 9_000_000_000_000_003, 9_100_000_000_000_000_007
    df = spark.createDataFrame([(n, total, 1000)], "n long, total long, n_terms long")
    price = df.select(source_divergence._price("n", "total")).first()[0]
    assert price == 1 + 10**9 * (n + 5) // (total + 5000)


@pytest.mark.parametrize("columns", [2048, 8])
def test_product_is_the_sum_over_terms(monkeypatch, columns):
    monkeypatch.setattr(source_divergence, "MOST_COLUMNS", columns)
    monkeypatch.setattr(source_divergence, "FEWEST_TERMS", 2)
    rng = np.random.default_rng(2)
    prices = rng.integers(1, 30, (500, 7)) ** 3
    prices[:, 3] = 10**9
    left, right = np.array([0, 3, 4]), np.array([1, 2, 5, 6])
    expected = np.abs(prices[:, left, None] - prices[:, None, right]).sum(axis=0)
    assert (priced_product(prices, left, right) == expected).all()


def test_empty_table(spark):
    assert divergence(table(spark, [])).collect() == []
