"""Awkward documents for all operators, and plain Python versions of what they compute."""

import random

# Columns beside the two that operators read, with names that operators use themselves.
CLASHING = (
    "kept", "score", "n_lines", "n_removed", "found", "node", "bucket", "line", "ids", "part",
    "length", "a", "b", "component", "label", "words", "paragraph", "block", "n",
)


def documents(spark, rows):
    """(doc_id, text) rows with clashing columns, all of them null in every second row."""
    schema = "doc_id long, text string, " + ", ".join(f"`{c}` string" for c in CLASHING)
    data = [(i, t, *[c if k % 2 else None for c in CLASHING]) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, schema)


def words(rng, n, of=200):
    return [f"w{rng.randrange(of)}" for _ in range(n)]


def odd_rows(seed=1):
    """Nulls, empty and blank texts, short and very long ones, copies, near copies and repeated rows."""
    rng = random.Random(seed)
    base = words(rng, 120, of=4000)
    rows = [(1, None), (2, ""), (3, " \t\n\x0b "), (4, "one"), (5, "two words"), (6, "One")]
    rows += [(7, " ".join(base)), (8, " ".join(base).upper()), (9, " ".join(base[:100]))]
    for i in range(10, 40):
        changed = list(base)
        for _ in range(rng.randrange(8)):
            changed[rng.randrange(len(changed))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(changed)))
    rows += [(i, " ".join(words(rng, rng.randrange(1, 60)))) for i in range(40, 60)]
    rows += [(60, " ".join(words(rng, 60_000, of=9000))), (61, "é" * 50_000), (62, "a  b   c\n\nd ")]
    rows += [rows[6], rows[6], (63, "tie tie tie tie tie tie"), (None, "no id"), (None, None)]
    rng.shuffle(rows)
    return rows


def collected(df, *columns):
    rows = df.select(*columns).collect() if columns else df.collect()
    return sorted((tuple(r) for r in rows), key=repr)
