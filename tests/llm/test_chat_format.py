"""Role repair against all ways of repairing short conversations."""

import functools
import itertools
import random

import pytest

from hazardflow.llm import chat_format as C


def legal(roles):
    rest = roles[1:] if roles[:1] == ("system",) else roles
    return bool(rest) and len(rest) % 2 == 0 and all(r == ("user", "assistant")[i % 2] for i, r in enumerate(rest))


def least_cost(roles):
    """Over all role choices, merges and insertions of up to two empty messages between turns."""
    if not roles:
        return 0
    best = 1 << 30
    gaps = [()] + [(r,) for r in ("user", "assistant")] + [("user", "assistant"), ("assistant", "user")]
    for labels in itertools.product(C.ROLES, repeat=len(roles)):
        relabel = sum(C.RELABEL for a, b in zip(roles, labels) if a != b)
        for merges in itertools.product((False, True), repeat=len(roles) - 1):
            if any(m and labels[i] != labels[i + 1] for i, m in enumerate(merges)):
                continue
            base = relabel + C.MERGE * sum(merges)
            if base >= best:
                continue
            messages = [labels[0]] + [labels[i + 1] for i, m in enumerate(merges) if not m]
            for inserted in itertools.product(gaps, repeat=len(messages) + 1):
                cost = base + C.INSERT * sum(map(len, inserted))
                if cost < best:
                    whole = list(inserted[0])
                    for message, gap in zip(messages, inserted[1:]):
                        whole += [message, *gap]
                    if legal(tuple(whole)):
                        best = cost
    return best


def solved(roles):
    total = functools.reduce(C.product, [C.turn_matrix(r) for r in roles], C.unit())
    return min(total[s] + C.ENDING[s][0] for s in range(C.STATES))


@pytest.mark.parametrize("n", [1, 2, 3])
def test_least_cost(n):
    for roles in itertools.product((*C.ROLES, "tool"), repeat=n):
        assert solved(roles) == least_cost(roles), roles


def rendered(rows):
    """Conversation -> list of (role, text) read back from its fragments."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.conv_id, r.turn, r.position)):
        out.setdefault(r.conv_id, []).append(r.fragment)
    found = {}
    for conv, parts in out.items():
        text = "".join(parts)
        assert text.endswith(C.CLOSE)
        messages = [m for m in text.split(C.CLOSE)[:-1]]
        found[conv] = [tuple(m[2:].split("|>\n", 1)) for m in messages]
    return found


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    given = []
    for conv in range(25):
        for turn in range(rnd.choice((1, 2, 5, 9))):
            given.append((conv, turn, rnd.choice((*C.ROLES, "user", "assistant", None, "tool")), f"t{conv}.{turn}"))
    given += [(30, t, "user" if t % 3 else "assistant", "x" * (t % 5)) for t in range(700)]
    given += [(31, t, rnd.choice(("user", "assistant")), f"n{t}") for t in range(-300, 20)]
    given += [(32, 5, "user", None), (32, None, "user", "null turn"), (32, 5, "user", "same turn"), (32, 5, "user", "same turn")]
    given += [(None, 0, "user", "no conversation"), (33, 0, "user", "y" * 200_000)]
    return given


def test_repaired_conversations_are_legal_and_cheapest(spark, rows):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumnRenamed("x", "x").repartition(4)
    got = C.repair(frame.selectExpr("*", "1 AS child", "2 AS parent", "3 AS matrix")).collect()
    order = lambda r: (r[1] or 0, r[2] is not None, r[2] or "", r[3] or "")
    for conv, messages in rendered(got).items():
        own = sorted({r for r in rows if r[0] == conv}, key=order)
        assert legal(tuple(role for role, _ in messages))
        cost = {r.cost for r in got if r.conv_id == conv}
        assert cost == {solved([r[2] for r in own])}
        assert "".join(t for _, t in messages).replace("\n\n", "") == "".join(r[3] or "" for r in own)
        paid = sum(C.RELABEL * ("relabel" in r.edit) + C.MERGE * ("merge" in r.edit) + C.INSERT * ("insert" in r.edit)
                   for r in got if r.conv_id == conv)
        last = [r.new_role for r in sorted(got, key=lambda r: (r.turn, r.position)) if r.conv_id == conv][-1]
        assert cost == {paid + C.ENDING[C.ROLES.index(last) + 1][0]}
    assert {r.conv_id for r in got} == {r[0] for r in rows} - {None}


def test_blocks_do_not_change_the_result(spark, rows, monkeypatch):
    frame = spark.createDataFrame([r for r in rows if r[0] in (3, 30, 31)], "conv_id long, turn long, role string, text string")
    one = sorted(map(tuple, C.repair(frame).collect()), key=str)
    monkeypatch.setattr(C, "BLOCK", 7)
    small = sorted(map(tuple, C.repair(frame).collect()), key=str)
    assert [(r[0], r[1], r[-1]) for r in one] == [(r[0], r[1], r[-1]) for r in small]
    assert one == small


def test_empty_table(spark):
    assert C.repair(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


@pytest.mark.parametrize("block", [4, 256])
def test_turns_without_numbers_are_dealt_over_blocks(spark, monkeypatch, block):
    """A conversation whose turns have one number or none, beside others: places, fragments and cost as by one sort."""
    monkeypatch.setattr(C, "BLOCK", block)
    rnd = random.Random(5)
    rows = [(7, None if i % 3 else 0, rnd.choice([*C.ROLES, None]), f"text {rnd.randrange(900)}") for i in range(1500)]
    rows += [(7, 1, "user", f"later {i}") for i in range(20)] + [(c, t, rnd.choice(C.ROLES), "hello") for c in (-3, 6, 8) for t in (-2, -1, 0, 5)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(6)
    if block == 4:
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # a conversation over several tasks
    try:
        got = C.repair(frame).collect()
        blocks = C._numbered(frame.selectExpr("conv_id AS conv", "coalesce(turn, 0) AS turn", "role", "text").distinct()).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    for conv in (7, -3, 6, 8):
        want = sorted({(t or 0, r is not None, r or "", x) for c, t, r, x in rows if c == conv})
        assert [(b.turn, b.role is not None, b.role or "", b.text) for b in sorted((b for b in blocks if b.conv == conv), key=lambda b: b.place)] == want
        assert sorted(b.place for b in blocks if b.conv == conv) == list(range(len(want)))
        own = sorted((r for r in got if r.conv_id == conv), key=lambda r: (r.turn, r.position))
        assert [(r.turn, r.role is not None, r.role or "") for r in own] == [w[:3] for w in want]
        seen = {}
        for r in own:
            assert r.position == seen.setdefault(r.turn, 0)
            seen[r.turn] += 1
        assert {r.cost for r in own} == {solved([r.role for r in own])}
