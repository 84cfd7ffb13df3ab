import itertools
import random
import re
from collections import Counter

import numpy as np

from daymark.llm import filter_audit
from daymark.llm.filter_audit import audit, document_statistics, term_matrix
from tests.llm.odd import CLASHING, odd_rows

CLASHES = tuple(c for c in CLASHING if c not in ("source",)) + ("hash", "failed", "first", "shard", "code", "word")


def table(spark, rows):
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *["x"] * len(CLASHES)) for r in rows], schema)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def failures(rows):
    smallest = {}
    for i, t, _ in rows:
        if i is not None:
            smallest[t or ""] = min(i, smallest.get(t or "", i))
    for i, t, _ in rows:
        w, t = words(t), t or ""
        yield {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": bool(re.search("[#$%&*|]", t)),
            "E": i is not None and smallest[t] < i,
        }


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    counts, shapley, parts = Counter(), Counter(), set()
    for (i, _, source), fails in zip(rows, failures(rows), strict=True):
        part = source or ""
        parts.add(part)
        for order in map("".join, itertools.permutations("ABCDE")):
            gone = False
            for step, x in enumerate(order, start=1):
                at = (part, order, step)
                counts[at, "kept"] += not gone and not fails[x]
                counts[at, "removed"] += not gone and fails[x]
                counts[at, "redundant"] += gone and fails[x]
                counts[at, "unique_fails"] += fails[x] and sum(fails.values()) == 1
                counts[at, "good_lost"] += not gone and fails[x] and i in good
                counts[at, "toxic_lost"] += not gone and fails[x] and i in toxic
                shapley[part, x] += not gone and fails[x]
                gone = gone or fails[x]
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
    return sorted(
        (part, order, step, *(counts[(part, order, step), n] for n in names), shapley[part, order[step - 1]])
        for part in parts for order in map("".join, itertools.permutations("ABCDE")) for step in range(1, 6)
    )


def audit_rows(seed=3):
    rng = random.Random(seed)
    rows = [(i, t, rng.choice(["a", "b", None, ""])) for i, t in odd_rows(seed)]
    for i in range(100, 160):
        text = " ".join(rng.choice(["Word", "word", f"w{rng.randrange(999)}", "é", "x#"][: rng.randrange(1, 6)]) for _ in range(rng.choice([150, 200, 260])))
        rows.append((i, text, "hot"))
    return rows + [(i, rows[-1][1], rng.choice(["hot", "b"])) for i in range(90, 100)] + [rows[-1], rows[-1]]


def test_against_plain_python(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 1 << 12)
    rows = audit_rows()
    rng = random.Random(4)
    labels = [(rng.choice([None, *range(160)]), rng.choice([0, 1, None]), rng.choice([0, 1])) for _ in range(200)]
    labelled = spark.createDataFrame([(*x, "y") for x in labels], "doc_id long, quality int, toxic int, failed string")
    got = audit(table(spark, rows), labelled)
    names = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert sorted(tuple(r[c] for c in names) for r in got.collect()) == brute(rows, labels)


def test_matrix_has_one_id_for_a_word_in_all_shards(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "SHARD_BYTES", 100)
    rows = [(i, " ".join(f"w{j % 7}" for j in range(i)), "s") for i in range(40)]
    shards = term_matrix(table(spark, rows)).collect()
    assert len(shards) > 8
    seen = {}
    for shard in shards:
        indptr, columns = (np.frombuffer(x, dtype="<i8") for x in (shard.indptr, shard.columns))
        counts = np.frombuffer(shard.counts, dtype="<i4")
        for k, doc in enumerate(shard.doc_ids):
            low, high = indptr[k], indptr[k + 1]
            row = dict(zip(columns[low:high].tolist(), counts[low:high].tolist(), strict=True))
            expected = Counter(f"w{j % 7}" for j in range(doc))
            assert sorted(row.values()) == sorted(expected.values())
            seen[doc] = row
    assert set(seen[39]) == set(seen[7]) and len(set(seen[39])) == 7
    assert sum(seen[20].values()) == 20


def test_measures(spark):
    rows = audit_rows()
    got = document_statistics(table(spark, rows)).collect()
    expected = Counter((i, s or "", len(words(t)), len(set(words(t))), len(t or "")) for i, t, s in rows)
    assert Counter((r.doc_id, r.source, r.n_words, r.n_distinct, r.n_chars) for r in got) == expected


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit(table(spark, []), none).collect() == []
    assert audit(table(spark, [(1, None, None)]), none).count() == 600
