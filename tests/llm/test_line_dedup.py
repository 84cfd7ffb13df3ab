import random
import re

import pytest

from daymark.llm import line_dedup
from daymark.llm.line_dedup import deduplicate_lines
from tests.llm.odd import CLASHING, documents, odd_rows


def brute(rows, percent=80):
    """{(id, text): (n_lines, n_removed, text)}; rows with one id share line numbers."""
    sets = [
        (i, n, frozenset(w for w in re.split(r"[ \t\x0b\f\r]", line.lower()) if w))
        for i, t in rows if i is not None and t is not None
        for n, line in enumerate(t.split("\n"))
    ]
    gone = set()
    for i, n, s in sets:
        for j, m, t in sets:
            if s and t and (j, m) < (i, n) and 100 * len(s & t) >= percent * len(s | t):
                gone.add((i, n))
                break
    out = {}
    for i, t in rows:
        lines = [] if t is None else t.split("\n")
        left = [x for n, x in enumerate(lines) if (i, n) not in gone]
        out[i, t] = (len(lines), len(lines) - len(left), None if t is None else "\n".join(left))
    return out


def line_rows(seed, n_docs=40):
    rng = random.Random(seed)
    base = [" ".join(f"w{rng.randrange(60)}" for _ in range(rng.choice([3, 4, 5, 9, 20]))) for _ in range(25)]
    rows = []
    for i in range(n_docs):
        lines = []
        for _ in range(rng.randrange(1, 12)):
            words = rng.choice(base).split()
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(60)}"
            lines.append(rng.choice([" ", "  ", "\t"]).join(words).title())
        rows.append((i, "\n".join([*lines, rng.choice(["", " ", "The common line."])])))
    return rows


@pytest.mark.parametrize("rows", [line_rows(1), line_rows(2), odd_rows()], ids=["lines", "more lines", "odd"])
def test_against_all_pairs(spark, rows):
    docs = documents(spark, rows)
    got = deduplicate_lines(docs)
    kept = [c for c in CLASHING if c not in ("n_lines", "n_removed")]
    assert got.columns == ["doc_id", "text", *kept, "n_lines", "n_removed"]
    expected = brute(rows)
    assert sorted(((r.doc_id, r.n_lines, r.n_removed, r.text) for r in got.collect()), key=repr) == sorted(
        ((i, *expected[i, t]) for i, t in rows), key=repr
    )


@pytest.mark.parametrize("direct, often", [(128, 20_000), (3, 20_000), (128, 5)])
def test_many_near_copies_of_one_line(spark, monkeypatch, direct, often):
    monkeypatch.setattr(line_dedup, "DIRECT", direct)
    monkeypatch.setattr(line_dedup, "OFTEN", often)
    rng = random.Random(3)
    base = [f"b{i}" for i in range(40)]
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
            words[rng.randrange(40)] = f"y{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    expected = brute(rows)
    got = deduplicate_lines(documents(spark, rows)).collect()
    assert {(r.doc_id, r.n_removed) for r in got} == {(i, expected[i, t][1]) for i, t in rows}


@pytest.mark.parametrize("at_once", [32, 1])
def test_lines_that_share_frequent_words_only(spark, monkeypatch, at_once):
    monkeypatch.setattr(line_dedup, "OFTEN", 5)
    monkeypatch.setattr(line_dedup, "DIRECT", 10)
    monkeypatch.setattr(line_dedup, "MOST_AT_ONCE", at_once)
    rng = random.Random(4)
    rows = []
    for i in range(150):
        words = rng.choice([[f"a{k}" for k in range(n)] for n in (5, 6, 9, 14, 30)])
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice([f"a{rng.randrange(30)}", f"y{i}"])
        rows.append((i, " ".join(words)))
    expected = brute(rows)
    got = deduplicate_lines(documents(spark, rows)).collect()
    assert {(r.doc_id, r.n_removed) for r in got} == {(i, expected[i, t][1]) for i, t in rows}


def test_long_lines_that_share_words_make_no_pairs(spark, monkeypatch):
    made = []

    def counted(df, name, plain=line_dedup.stored):
        out = plain(df, name)
        if name == "pairs":
            made.append(out.count())
        return out

    monkeypatch.setattr(line_dedup, "stored", counted)
    rng = random.Random(5)
    words = [f"w{k}" for k in range(2000)]
    rows = [(i, " ".join(rng.sample(words, 160))) for i in range(200)]
    got = deduplicate_lines(documents(spark, rows)).collect()
    assert sum(r.n_removed for r in got) == 0
    assert sum(made) < 200


def test_empty_table(spark):
    assert deduplicate_lines(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    docs = documents(spark, line_rows(1, 5))
    lines = line_dedup.lines_of(docs)
    ranks, often = (line_dedup.rarity(lines).select(c).scalar() for c in ("ranks", "often"))
    for df in (line_dedup.bucket_rows(lines, 80, ranks, often), deduplicate_lines(docs)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())
