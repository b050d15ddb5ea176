"""List ranking and the conversation trie against walking them in plain Python."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest

from millrace.llm import conversation_trie as t, queries
from millrace.llm.list_ranking import chains, ranked
from tests.llm.rows import rows_of  # noqa: F401

SMALL = "/root/testdata/sf0.001"
COLUMNS = "conv_id long, turn long, role string, text string, depth string, a int, n_convs string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows) -> dict:
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            convs[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in convs.items()}


def with_heads(convs: dict) -> dict:
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = convs.get(c - c % 20, [])[:h] + own[h:]
    return out


def brute(convs: dict) -> list[tuple]:
    members, below = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                below[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len((node[-1][1] if node else "").encode().split())
        leaves[node] = sum(leaves[k] for k in below[node]) or 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in below[node])
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(below[n]), leaves[n], saved[n],
         hashlib.sha256(",".join(map(str, sorted(c for c in m if len(convs[c]) == len(n)))).encode()).hexdigest()) for n, m in members.items())


def rows(df) -> list[tuple]:
    found = [tuple(r) for r in df.select(*NAMES).collect()]
    return sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in found)


def table(rows_of, made):  # noqa: F811
    return rows_of([(*m, "d", 1, "n") for m in made], COLUMNS)


def test_whole_table(spark):
    frame = pd.read_parquet(f"{SMALL}/conversations.parquet")[["conv_id", "turn", "role", "text"]]
    found = queries.op11_conversation_trie(spark, SMALL)
    assert found.columns == NAMES
    assert rows(found) == brute(with_heads(ordered(frame.itertuples(index=False, name=None))))


def test_shared_turns_and_a_ranking_in_rounds(rows_of):  # noqa: F811
    """Most conversations share their first turns; ids are wide apart; the tour is ranked by many rounds."""
    rng, made = random.Random(2), []
    for k in range(150):
        conv = rng.randrange(10**15) if k % 2 else k
        for turn in range(rng.randrange(1, 7)):
            same = turn < 2 and rng.random() < 0.8
            made.append((conv, turn, ("user", "assistant")[turn % 2], "a common start of it" if same else rng.choice("abc") + " words"))
    found = t.prefix_trie(table(rows_of, made), final=5)
    assert rows(found) == brute(ordered(made))
    left = sorted(r["left_over"] for r in found.collect())
    assert len(set(left)) == len(left) and left[-1] == 2 * len(left)


def test_one_very_long_conversation(rows_of):  # noqa: F811
    made = [(7, i, "user", "turn %d" % (i // 2)) for i in range(3 * t.STRETCH // 2)] + [(8, i, "user", "turn %d" % (i // 2)) for i in range(40)]
    assert rows(t.prefix_trie(table(rows_of, made), final=1_000)) == brute(ordered(made))


def test_odd_rows(rows_of):  # noqa: F811
    made = [(None, 0, "user", "x"), (20, None, None, None), (20, None, None, None), (20, 1, "user", "é " * 50_000), (21, 0, "user", ""), (23, 5, "b", "t"),
            (23, 5, "a", "t"), (23, 5, "a", "t"), (1, 0, "user", "only"), (2, 0, "user", "only"), (3, 0, None, "only"), (-5, 0, "ab", "c"), (-6, 0, "a", "bc")]
    own = t.placed(table(rows_of, made))
    turns, members = t.rebuilt(own)
    want = with_heads(ordered(made))
    assert any(not turns for turns in want.values())
    assert rows(t.trie(turns, members)) == brute(want)
    assert t.prefix_trie(table(rows_of, made).limit(0)).collect() == []
    assert t.prefix_trie(table(rows_of, made[:1])).collect() == []


def test_chains_of_a_block():
    rng = np.random.default_rng(1)
    items = rng.permutation(1_000)
    link = np.append(items[1:], -1)
    link[rng.choice(999, 30, replace=False)] = 5_000
    mixed = rng.permutation(1_000)
    sums, left, head = chains(items[mixed], link[mixed], np.ones((1, 1_000), np.int64))
    steps = np.zeros(1_000, int)
    for i in range(999, -1, -1):
        steps[i] = 1 + (steps[i + 1] if i < 999 and link[i] == items[i + 1] else 0)
    assert (sums[0] == steps[mixed]).all() and set(left) == {-1, 5_000} and head.sum() == 31
    with pytest.raises(ValueError):
        chains(np.array([1, 2]), np.array([2, 1]), np.ones((1, 2), np.int64))


def test_ranking_of_several_lists(rows_of):  # noqa: F811
    rng, made, want = random.Random(6), [], {}
    for base in range(0, 4_000, 1_000):
        items = rng.sample(range(base, base + 1_000), 300)
        for i, item in enumerate(items):
            made.append((item, items[i + 1] if i < 299 else None, rng.randrange(9), item % 7))
        total = 0
        for item in reversed(items):
            total += item % 7
            want[item] = total
    found = ranked(rows_of(made, "item long, next long, block int, weight long"), ["weight"], final=20)
    assert {r["item"]: r["weight"] for r in found.collect()} == want
