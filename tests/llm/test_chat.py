import hashlib
import itertools
import json
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import chat
from daymark.llm.queries import QUERIES
from tests.conftest import SMALL


def model(seed=0):
    draw = np.random.default_rng(seed)
    return chat.RoleModel(
        np.log(draw.dirichlet(np.ones(chat.STATES), chat.STATES + 1)),
        [np.log(draw.dirichlet(np.ones(n), chat.STATES)) for n in chat.SIZES],
    )


def best_by_trying_all(m, lines):
    shown = m.lines(lines)
    scored = []
    for states in itertools.product(range(chat.STATES), repeat=len(lines)):
        before, total = chat.START, 0.0
        for i, s in enumerate(states):
            total += m.transitions[before, s] + shown[i, s]
            before = s
        scored.append((total, states))
    return max(scored)


LINES = ["User: hi?", "- a", "", "```", "Assistant: Well."]


@pytest.mark.parametrize("cuts", [[5], [2, 3], [1, 1, 1, 1, 1]])
def test_segments_give_the_path_of_the_whole(cuts):
    m = model()
    bounds = np.concatenate([[0], np.cumsum(cuts)])
    parts = [LINES[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
    ends = chat.chain([chat.segment_matrix(m, p) for p in parts])
    got = [s for p, (a, b) in zip(parts, ends) for s in chat.path(m, p, a, b)]
    assert tuple(got) == best_by_trying_all(m, LINES)[1]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, line string")


def conversations():
    rows = []
    for c in range(40):
        rows.append((c, 0, "system", "System: You are helpful."))
        for t in range(1, 7):
            role = ("user", "assistant")[(t + 1) % 2]
            mark = {"user": "Human: ", "assistant": "AI: "}[role] if (c + t) % 4 else ""
            rows.append((c, t, role, mark + ("What is it?" if role == "user" else "It is this.\nAnd " + "more " * 30)))
    return rows


def test_roles_are_recovered(spark):
    rows = conversations()
    turns = frame(spark, rows)
    found = chat.format_chats(turns, chat.train(turns.filter("conv_id < 30")), rows_per_segment=4).collect()
    truth = {(c, t): r for c, t, r, _ in rows if c >= 30}
    got = {(r.conv_id, r.turn): r.role for r in found if r.line == 0 and r.conv_id >= 30}
    assert sum(got.get(k) == r for k, r in truth.items()) >= 0.9 * len(truth)
    one = next(r.rendered for r in found if (r.conv_id, r.turn) == (30, 0))
    assert one == "<|system|>\nYou are helpful.\n<|end|>"


def test_odd_rows(spark):
    rows = [(1, 0, "user", None), (1, None, None, "x"), (None, 0, "user", ""), (2, 3, "USER", "a\n\nb"), (2, 3, "USER", "a\n\nb")]
    rows += [(3, t, "user" if t % 2 else "assistant", f"User: {t}") for t in range(700)]
    turns = frame(spark, rows)
    found = chat.format_chats(turns, chat.train(turns)).collect()
    assert {r.conv_id for r in found} == {1, 2, 3, None}
    assert sum(r.conv_id == 2 and r.line == 0 for r in found) == 1
    assert chat.format_chats(frame(spark, []), chat.train(turns)).collect() == []
    assert chat.format_chats(turns, chat.train(frame(spark, []))).count() > 0


def test_markers():
    assert chat.marker("### Assistant:") == (3, "") and chat.marker("<|user|>hi") == (2, "hi")
    assert chat.marker("System: be brief") == (1, "be brief") and chat.marker("Note: none") == (0, "Note: none")


def test_registered_query_keeps_every_line(spark):
    found = QUERIES["op8_chat_roles"](spark, SMALL).collect()
    turns = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    assert {r.conv_id for r in found} == {r.conv_id for r in turns}
    at = {(r.conv_id, r.turn): r.role for r in found if r.line == 0}
    assert np.mean([at.get((r.conv_id, r.turn)) == r.role for r in turns]) > 0.8


@pytest.mark.parametrize("conv", [None, 5])
def test_different_rows_of_one_place_all_stay(spark, conv):
    """Many transcripts under one id, more at one turn than fit a slice, copies, and null turns."""
    rows = [(conv, t, "user", f"User: text {t} {i}") for t in (0, 1, 300) for i in range(40)]
    rows += [(conv, 2, "assistant", f"Assistant: many {i}") for i in range(5000)]
    rows += [(conv, None, "user", f"User: no turn {i}") for i in range(5)]
    rows += [(conv, 3, role, "the same") for role in ("user", "assistant")]
    turns = frame(spark, rows + rows[:50])
    kept = chat.distinct_rows(turns).collect()
    assert sorted(r.text for r in kept) == sorted(r[3] for r in rows)
    found = chat.format_chats(turns, chat.train(turns)).collect()
    lines = [x for r in found for x in r.rendered.split("\n")[1:-1]]
    assert sorted(x for x in lines if x) == sorted(chat.marker(r[3])[1] for r in rows)


def place_order(rows):
    """Rows of one place in the order of the hash of text and role."""

    def tie(row):
        body = {k: v for k, v in (("text", row[3]), ("role", row[2])) if v is not None}
        return hashlib.md5(json.dumps(body, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()

    return sorted(rows, key=tie)


def test_roles_that_follow_within_a_place(spark):
    first = [(None, 0, "system", "a"), (None, 0, "user", "b")]
    rows = [*first, (None, 1, "assistant", "c"), (1, 7, "user", "d")]
    known = chat.distinct_rows(frame(spark, rows))
    got = {(r["_before"], r["role"]): r["count"] for r in chat._following(known).collect()}
    a, b = (r[2] for r in place_order(first))
    assert got == Counter([(None, a), (a, b), (b, "assistant"), (None, "user")])
    many = chat.distinct_rows(frame(spark, [(1, 0, "user", f"t{i}") for i in range(1000)]))
    got = {(r["_before"], r["role"]): r["count"] for r in chat._following(many).collect()}
    assert got == {(None, "user"): 1, ("user", "user"): 999}


def test_numbers_of_rows(spark, monkeypatch):
    monkeypatch.setattr(chat, "TURNS_PER_BLOCK", 3)
    rng = random.Random(3)
    rows = [(c, rng.choice([None, *range(-4, 9), 10**12]), "user", f"t{i}") for i in range(300) for c in (None, 1)]
    got = chat.numbered(chat.distinct_rows(frame(spark, rows))).collect()
    for conv in (None, 1):
        mine = [x for x in rows if x[0] == conv]
        turns = sorted({-1 if x[1] is None else x[1] for x in mine})
        order = [x[3] for t in turns for x in place_order([x for x in mine if (-1 if x[1] is None else x[1]) == t])]
        found = sorted((r.row, r.text) for r in got if r.conv_id == conv)
        assert [n for n, _ in found] == list(range(len(order))) and [t for _, t in found] == order


def whole_path(m, rows):
    """(turn, line, role, rendered) of one transcript read at once."""
    by_turn = sorted({x[1] for x in rows})
    ordered = [x for t in by_turn for x in place_order([x for x in rows if x[1] == t])]
    places = [(x[1], i, line) for x in ordered for i, line in enumerate(x[3].split("\n"))]
    matrix = chat.segment_matrix(m, [p[2] for p in places])
    states = chat.path(m, [p[2] for p in places], *chat.chain([matrix])[0])
    heads = [i for i, s in enumerate(states) if s % 2 == 0]
    return sorted(
        (*places[a][:2], chat.ROLES[states[a] // 2], chat.render(chat.ROLES[states[a] // 2], [p[2] for p in places[a:b]]))
        for a, b in zip(heads, [*heads[1:], len(places)])
    )


def long_transcript(seed, n=120, conv=1):
    rng = random.Random(seed)
    kinds = ["User: why?", "- a\n- b", "plain words", "Assistant: because.\n" + "more\n" * 6, "```\ncode\n```"]
    return [(conv, rng.randrange(60), rng.choice(["user", None]), f"{rng.choice(kinds)} {i}") for i in range(n)]


@pytest.mark.parametrize("size", [1, 4, 256])
@pytest.mark.parametrize("group", [2, 64])
def test_any_size_of_segments_gives_the_path_of_the_whole(spark, monkeypatch, size, group):
    monkeypatch.setattr(chat, "SEGMENTS_PER_GROUP", group)
    m = model(4)
    rows = {c: long_transcript(c or 9, conv=c) for c in (1, 2, None)}
    turns = frame(spark, [x for part in rows.values() for x in part])
    found = chat.format_chats(turns, m, rows_per_segment=size)
    assert found.columns == ["conv_id", "turn", "line", "role", "rendered"]
    got = found.collect()
    for conv, part in rows.items():
        assert sorted(tuple(r)[1:] for r in got if r.conv_id == conv) == whole_path(m, part)


def test_copies_change_nothing(spark):
    rows = long_transcript(5, 40)
    model_of = {}
    for name, more in (("once", []), ("copied", [rows[3]] * 300 + rows)):
        turns = frame(spark, rows + more)
        trained = chat.train(turns)
        found = chat.format_chats(turns, trained, rows_per_segment=8)
        model_of[name] = (trained.transitions.tolist(), sorted(map(tuple, found.collect()), key=repr))
    assert model_of["once"] == model_of["copied"]


def test_a_hot_transcript_is_dealt_to_many_groups(spark):
    turns = frame(spark, [(None, i % 5, "user", f"User: {i}") for i in range(3000)])
    rows = chat.numbered(chat.distinct_rows(turns)).withColumn("segment", F.floor(F.col("row") / 64))
    sizes = [r["count"] for r in rows.groupBy("segment").count().collect()]
    assert len(sizes) == 47 and max(sizes) == 64


def test_product_is_associative_with_chaining():
    m = model(7)
    parts = [chat.segment_matrix(m, [line]) for line in LINES * 3]
    whole = chat.segment_matrix(m, LINES * 3)
    assert np.allclose(chat.product(parts), whole) and np.allclose(chat.product([chat.product(parts[:4]), *parts[4:]]), whole)
    assert chat.chain(parts)[-1][1] == int(whole[chat.START].argmax())
