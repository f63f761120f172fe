"""The prefix trie against one built turn by turn."""

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest

from riskflow.llm.prefix_trie import SlotTable, prefix_trie, rebuild
from riskflow.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, k1 string, seg int, `a.b` string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(r, t) for _, r, t in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def truth(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[q] for q in below) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1].encode()) if p else 0) + sum(saved[q] for q in below)
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(children.get(p, [])), leaves[p], saved[p],
                   sha256(",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p)).encode()).hexdigest()) for p, m in members.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def chats(spark):
    rng = random.Random(3)
    rows = []
    for c in range(120):
        if c % 7 == 5:
            continue
        rows += [(c, t, "user" if t % 2 else "bot", rng.choice(["hi", "é", "yes", ""])) for t in range(rng.choice([1, 2, 5, 12, 20]))]
    rows += [(500, t, "user", f"turn {t % 3}") for t in range(900)] + [(503, t, "user", f"turn {t % 3}") for t in range(700)]
    rows += [(501, None, "user", "hi")] * 30 + [(502, 1, r, t) for r in ("a", None) for t in ("x", "y", None)]
    rows += [(None, 1, "user", "hi"), (-7, 1, "user", "hi"), (-5, 2, None, None), (7001, None, None, None), (7002, None, None, None)]
    return rows


@pytest.mark.parametrize("segment,size", [(4096, 200_000), (16, 150)])
def test_equal_to_a_trie_by_turns(spark, chats, segment, size):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in chats], SCHEMA).repartition(5)
    assert rows_of(prefix_trie(df, segment, size)) == truth(chats)


def test_rebuilt_turns(spark, chats):
    turns, convs = rebuild(spark.createDataFrame(chats, "conv_id long, turn long, role string, text string"), 100)
    want = rebuilt(chats)
    assert {r.conv_id: r.n_turns for r in convs.collect()} == {c: len(t) for c, t in want.items()}
    got = {}
    for r in turns.collect():
        got.setdefault(r.conv_id, []).append((r.d, r.last))
    assert {c: sorted(v) for c, v in got.items()} == {c: [(d, d == len(t)) for d in range(1, len(t) + 1)] for c, t in want.items() if t}


def test_no_rows(spark):
    assert prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie(spark.createDataFrame([(None, 1, "user", "hi", "x", 1, "y")], SCHEMA)).count() == 0


def test_slots_are_minimal_and_verified():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000):
        keys = rng.integers(0, 1 << 63, (n, 2)).astype(np.uint64)
        table = SlotTable(keys)
        assert sorted(table.slots(keys)) == list(range(n))
        with pytest.raises(KeyError):
            table.slots(rng.integers(0, 1 << 63, (50, 2)).astype(np.uint64))


def test_query_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    chats = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op12_prefix_trie"](spark, sf)) == truth(chats)
