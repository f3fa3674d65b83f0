import hashlib
import random
import zlib

import pytest

from edgeloom.llm import prefix_trie
from edgeloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            digest = hashlib.sha256((text or "").encode()).hexdigest()
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", digest, text or ""))
    own = {c: [(r, t) for *_, r, _, t in sorted(turns)] for c, turns in own.items()}
    found = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        family = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        found[c] = own.get(family, [])[:h] + turns[h:]
    return found


def brute(sequences):
    """Nodes of ``{conv: [(key, text)]}`` by all prefixes."""
    members = {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = leaves.get(p, 0) + (not children.get(p))
        saved[p] = saved.get(p, 0) + ((len(members[p]) - 1) * len(p[-1][1].encode()) if p else 0)
        if p:
            up = p[:-1]
            children[up] = children.get(up, 0) + 1
            leaves[up] = leaves.get(up, 0) + leaves[p]
            saved[up] = saved.get(up, 0) + saved[p]
    rows = []
    for p, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(sequences[c]) == len(p))
        rows.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), children.get(p, 0),
                     leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def result(df):
    assert df.columns == prefix_trie.COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    expected = brute(rebuilt([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]))
    assert result(QUERIES["op12_prefix_trie"](spark, sf_dir)) == expected


@pytest.mark.parametrize("shard", [1, 7, 60, 1 << 17])
def test_boundaries_between_shards(spark, shard):
    """Copies, chains, one very long conversation, turnless ones, over many small shards."""
    rng = random.Random(shard)
    said = [("user", "a"), ("assistant", "bé"), ("user", ""), ("", "cc")]
    found, base = {}, [rng.choice(said) for _ in range(300)]
    for c in range(-20, 400):
        kind = rng.random()
        n = rng.randrange(6)
        found[c] = base[:5] if kind < 0.3 else base[:n] if kind < 0.5 else [rng.choice(said) for _ in range(n)]
    found[1000], found[1001] = base, base[:200] + [said[0]] * 3
    ids = {s: i for i, s in enumerate(said)}
    rows = [(c, [ids[t] for t in turns], [len(t[1].encode()) for t in turns]) for c, turns in found.items()]
    df = spark.createDataFrame(rows, "conv_id long, ids array<long>, sizes array<long>").repartition(5)
    assert result(prefix_trie.prefix_trie(df, shard)) == brute(found)


def test_awkward_rows(spark):
    rng = random.Random(2)
    rows = [(c, t, rng.choice(["user", "assistant", None]), rng.choice(["hi", "", None, "x" * 1000, "é"]))
            for c in (0, 1, 2, 3, 4, 7, 8, 9, 10, 11, -7, -5, -3, 30) for t in (None, 0, 1, 1, 2, 5, 9, 12)]
    rows += [(None, 1, "user", "nobody"), (0, 1, "user", "hi"), (0, 1, "user", "hi"), (22, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for name in ("ids", "sizes", "mark", "id", "n", "first", "key", "depth", "n_bytes"):
        df = df.selectExpr("*", f"'own' AS {name}")
    assert result(prefix_trie.trie_report(df)) == brute(rebuilt(rows))


def test_empty_table(spark):
    assert prefix_trie.trie_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_tree_is_balanced():
    tree = prefix_trie.TernaryTree()
    tree.insert_all([([i], [1], [i]) for i in range(1000)])
    depth, todo = 0, [(tree.below[0], 1)]
    while todo:
        at, d = todo.pop()
        depth = max(depth, d)
        todo += [(n, d + 1) for n in (tree.low[at], tree.high[at]) if n >= 0]
    assert depth == 10 and len(tree.walk()) == 1001
