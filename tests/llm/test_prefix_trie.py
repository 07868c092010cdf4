"""The conversation trie against a plain one held in dictionaries."""

import hashlib
import random
import zlib

import pytest

from hazardflow.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, least long, conv string"


def rebuilt(rows, every=100, folds=6):
    """conv_id -> list of (role, text), by the rule of the query."""
    own = {}
    for c, t, r, x, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((t is not None, t or 0, (r or "", x or "")))
    own = {c: [y for *_, y in sorted(v, key=lambda z: z[:2])] for c, v in own.items()}
    out = {}
    for c, v in own.items():
        base = c - int(c - int(c / every) * every)
        h = zlib.crc32(str(c).encode()) % folds
        out[c] = own.get(base, [])[:h] + v[h:]
    return out


def expected(conversations):
    members, ends = {}, {}
    for c, seq in conversations.items():
        ends.setdefault(tuple(seq), []).append(c)
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    rows = []
    for node, inside in members.items():
        under = [u for u in members if u[: len(node)] == node]
        childless = [u for u in under if not any(len(w) == len(u) + 1 and w[: len(u)] == u for w in members)]
        rows.append((
            min(inside), len(node), min(members[node[:-1]]) if node else None, len(inside),
            sum(len(u) == len(node) + 1 for u in under), len(childless),
            sum((len(members[u]) - 1) * (len(u[-1][1]) if u else 0) for u in under),
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
    return sorted(rows, key=str)


def answer(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


def built(frame, strips):
    return prefix_trie.trie(prefix_trie.with_shared_heads(prefix_trie.turns(frame)), strips)


@pytest.mark.parametrize("strips,block", [(1, 4096), (3, 2), (6, 4)])
def test_equals_plain_trie(spark, monkeypatch, strips, block):
    """Shared heads, copies, prefixes of others, null turns, roles and texts, unknown bases, long conversations."""
    monkeypatch.setattr(prefix_trie, "BLOCK", block)
    rnd = random.Random(5)
    said = ["", "hello", "Ünï😀", "yes\nno", None]
    rows = []
    for c in [*range(95, 130), *range(200, 212), 305, 307, -5, -107, 9_000_000_000]:
        length = rnd.choice((1, 2, 3, 7, 12))
        for t in range(length):
            rows.append((c, t if rnd.random() < 0.9 or t else None, rnd.choice(("user", "assistant", None)), rnd.choice(said)))
    for c in (400, 401, 402, 500, 501):  # long ones, copies and a prefix of each other
        rows += [(c, t, "user", f"turn {t % 9}") for t in range(23 if c != 402 else 17)]
    rows += [(None, 1, "user", "nobody's")]
    rows = [(*r, 1, 2, "x") for r in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert answer(built(frame, strips)) == expected(rebuilt(rows))


def test_without_shared_heads(spark):
    rows = [(1, 1, "a", "xy"), (1, 2, "b", "z"), (2, 1, "a", "xy"), (3, None, None, None)]
    frame = spark.createDataFrame([(*r, 0, 0, "") for r in rows], SCHEMA)
    got = answer(prefix_trie.trie(prefix_trie.with_roots(prefix_trie.turns(frame))))
    assert got == expected({1: [("a", "xy"), ("b", "z")], 2: [("a", "xy")], 3: [("", "")]})


def test_ties_and_repeated_rows_do_not_depend_on_the_order(spark):
    rows = [(7, 1, r, x) for r, x in (("a", "p"), ("b", "q"), ("a", "p"), (None, "r"))] + [(8, None, "u", "s")] * 3
    rows = [(*r, 0, 0, "") for r in rows]
    one = answer(built(spark.createDataFrame(rows, SCHEMA).repartition(5), 3))
    two = answer(built(spark.createDataFrame(rows[::-1], SCHEMA).coalesce(1), 2))
    assert one == two and max(r[1] for r in one) >= 2


def test_empty_table(spark):
    assert built(spark.createDataFrame([], SCHEMA), 4).collect() == []


def test_a_conversation_with_most_of_the_turns(spark):
    """One conversation of 30,000 turns, of which two others are prefixes, in few strips."""
    deep = [(1, t, "user", f"t{t % 7}") for t in range(30_000)] + [(2, t, "user", f"t{t % 7}") for t in range(15_000)]
    rows = [(*r, 0, 0, "") for r in deep + [(3, 0, "user", "t0")]]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    nodes = {r.depth: r for r in prefix_trie.trie(prefix_trie.with_roots(prefix_trie.turns(frame))).collect()}
    assert len(nodes) == 30_001 and nodes[0].n_convs == 3 and nodes[0].n_leaves == 1
    assert [nodes[d].n_convs for d in (1, 2, 15_000, 15_001, 30_000)] == [3, 2, 2, 1, 1]
    assert nodes[0].saved_tokens == 2 * 2 + 2 * 14_999 and nodes[14_999].saved_tokens == 4 and nodes[15_001].saved_tokens == 0
    assert nodes[30_000].n_children == 0 and nodes[15_000].ends_sha256 == hashlib.sha256(b"2").hexdigest()
