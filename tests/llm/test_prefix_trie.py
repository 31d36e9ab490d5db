import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from chronomart.llm import prefix_trie
from chronomart.llm.prefix_trie import NodeTable
from chronomart.llm.queries import QUERIES, SQL
from tests.compare import connect, difference

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie(paths):
    """``paths``: conversation to its list of turns."""
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, some in members.items():
        value = (len(some) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += value
            leaves[node[:d]] += node not in children
    return sorted(
        (min(some), len(node), min(members[node[:-1]]) if node else None, len(some), children.get(node, 0), leaves[node], saved[node],
         hashlib.sha256(",".join(str(c) for c in sorted(some) if len(paths[c]) == len(node)).encode()).hexdigest())
        for node, some in members.items()
    )


def rebuilt(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(some)] for c, some in turns.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 6 for c in turns}
    return {c: turns.get(c - c % 100, [])[: heads[c]] + some[heads[c] :] for c, some in turns.items()}


def found(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def conversations(seed=4):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 260), *range(301, 330), *range(1000, 1400, 7)]:
        n = rng.randint(0, 9)
        rows += [(c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "😀x", "", None, "c\0d"]))
                 for t in range(n)]
    rows += [(5000 + c, t, "user", f"hello {t}") for c in range(90) for t in range(c % 12)]
    rows += [(700, t, "user", f"turn {t % 17}") for t in range(400)] + [(None, 1, "user", "a")] * 3
    rows += rows[:40]  # repeated rows are turns of their own
    return rows


@pytest.fixture()
def folder(spark, tmp_path):
    rows = [(*r, 1) for r in conversations()]
    spark.createDataFrame(rows, SCHEMA + ", depth int").write.parquet(f"{tmp_path}/conversations.parquet")
    return str(tmp_path)


def test_query_against_brute_force(spark, folder):
    assert found(QUERIES["op12_prefix_trie"](spark, folder)) == trie(rebuilt(conversations()))


def test_query_against_sql(spark, folder):
    name = "op12_prefix_trie"
    assert difference(spark, connect(folder), name, QUERIES[name], SQL[name], folder) is None


def test_bands_shards_and_ids_without_turns(spark):
    """Long conversations that share their first bands, cut into small bands and many shards."""
    rng = random.Random(9)
    paths = {}
    for c in range(120):
        shared = rng.choice([0, 3, 4, 8, 20, 33])
        paths[c * 3] = [("u", f"common {d}") for d in range(shared)] + [
            ("u", f"own {rng.randrange(3)}") for _ in range(rng.choice([0, 0, 1, 4, 5, 30]))
        ]
    paths |= {c: list(paths[0]) for c in range(10_000, 10_060)}
    turns = [(c, d, *turn) for c, path in paths.items() for d, turn in enumerate(path, 1)]
    df = spark.createDataFrame(turns, "conv long, depth long, role string, text string")
    ids = spark.createDataFrame([(c,) for c in paths], "conv long")
    assert found(prefix_trie.prefix_trie(df, ids, per_shard=100, per_band=4)) == trie(paths)


def test_conversations_that_grow_turn_by_turn(spark):
    paths = {c: [("u", f"{d}") for d in range(c)] for c in range(1, 60)}
    turns = [(c, d, *turn) for c, path in paths.items() for d, turn in enumerate(path, 1)]
    df = spark.createDataFrame(turns, "conv long, depth long, role string, text string")
    assert found(prefix_trie.prefix_trie(df, per_shard=50, per_band=7)) == trie(paths)


def test_no_conversations(spark):
    empty = spark.createDataFrame([], "conv long, depth long, role string, text string")
    assert prefix_trie.prefix_trie(empty).count() == 0
    ids = spark.createDataFrame([(4,), (2,)], "conv long")
    assert found(prefix_trie.prefix_trie(empty, ids)) == trie({4: [], 2: []})


def test_node_table_is_minimal_perfect_and_checked():
    rng = np.random.default_rng(3)
    high, low = (rng.integers(0, 2**62, 5000) for _ in range(2))
    low[:100] = low[100:200]  # halves may repeat, digests not
    table = NodeTable(np.tile(high, 2), np.tile(low, 2))
    slots = table.slots(high, low)
    assert sorted(slots.tolist()) == list(range(5000)) and table.n == 5000
    assert (table.slots(high, low + 1) == -1).all()
    assert NodeTable(high[:0], low[:0]).n == 0


def test_clashing_digests_are_refused():
    with pytest.raises(ValueError, match="one digest"):
        prefix_trie._agreed(np.array([0, 1, 0]), np.array([5, 6, 7]), 2)


def test_long_member_lists_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 10)
    ids = random.Random(1).sample(range(10**6), 4000)
    ends = spark.createDataFrame([(i % 3 // 2, 7, c) for i, c in enumerate(ids)], "high long, low long, conv long")
    want = {k: hashlib.sha256(",".join(map(str, sorted(c for i, c in enumerate(ids) if i % 3 // 2 == k))).encode()).hexdigest() for k in (0, 1)}
    hashed = prefix_trie.member_hashes(ends.repartition(13)).collect()
    assert {r.high: r.ends_sha256 for r in hashed} == want and len(hashed) == 2
