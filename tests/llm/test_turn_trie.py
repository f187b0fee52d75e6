"""The trie of conversations against plain prefixes of every conversation."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from touchline.llm import turn_trie
from touchline.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    for c in convs:
        tie = lambda x: hashlib.sha256(f"{len(x[2])}:{x[2]}{x[3]}".encode()).digest()
        convs[c] = [x[2:] for x in sorted(convs[c], key=lambda x: (x[:2], tie(x)))]
    new = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        new[c] = convs.get(c - int(np.fmod(c, 100)), [])[:h] + own[h:]
    members = defaultdict(list)
    for c in sorted(new):
        for d in range(len(new[c]) + 1):
            members[tuple(new[c][:d])].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    out = Counter()
    for p, m in members.items():
        ends = ",".join(str(c) for c in m if len(new[c]) == len(p))
        out[m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def run(spark, rows, ranges=None, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    out = turn_trie.trie(turn_trie.rebuilt(turn_trie.turns(df)), **kw)
    return Counter(tuple(r) for r in out.select(turn_trie.NODE_COLUMNS).collect())


def conversations(n, kinds, seed=0, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-200, 3 * n), n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]), "t" * rng.randint(0, kinds)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,kinds,size", [(60, 2, 300), (400, 40, 1 << 20), (300, 1, 50)])
def test_same_as_plain_prefixes(spark, n, kinds, size):
    rows = conversations(n, kinds, seed=n)
    assert run(spark, rows, range_bytes=size) == plain(rows)


def test_hot_turn_copies_and_long_conversations(spark):
    rows = [(c, 0, "user", "hello") for c in range(300)] + [(c, 1, "user", f"{c}") for c in range(0, 300, 2)]
    rows += [(c, t, "user", "same") for c in range(1000, 1500) for t in range(8)]
    rows += [(c, t, "user", "x") for c in (2001, 2002) for t in range(700)] + [(2002, 700, "user", "last")]
    assert run(spark, rows, range_bytes=500) == plain(rows)


def test_null_and_repeated_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b"), (None, 1, "user", "a"), (2, 5, None, "a"), (2, 5, "a", None),
            (3, None, "", ""), (100, 1, "user", "é"), (101, 2, "user", "zz"), (-150, 1, "u", "n"), (-100, 1, "u", "base"), (7, 1, "a", "b"), (8, 1, "ab", "")]
    assert run(spark, rows) == plain(rows)


def test_turnless_conversations_only(spark):
    rows = [(c, 0, "u", "t") for c in range(201, 260) if zlib.crc32(str(c).encode()) % 6 > 0]
    got = run(spark, rows)
    assert got == plain(rows) and len(got) == 1


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame(conversations(20, 3), SCHEMA)
    more = df.selectExpr("*", "role as key", "turn as depth", "text as node", "conv_id as range")
    a, b = (Counter(map(tuple, turn_trie.trie(turn_trie.rebuilt(turn_trie.turns(x))).collect())) for x in (df, more))
    assert a == b
    assert turn_trie.trie(turn_trie.rebuilt(turn_trie.turns(df.limit(0)))).count() == 0


def test_layouts_grow():
    tree, rng = turn_trie.Tree(), random.Random(5)
    keys = {bytes(rng.choices(range(256), k=4)) * 4 for _ in range(900)} | {bytes([i]) * 16 for i in range(256)}
    for i, k in enumerate(sorted(keys, key=lambda _: rng.random())):
        tree.insert(k, (i, 1, None), [1])
    assert len(tree.root.children) == 256
    found, todo, sizes = [], [(tree.root, b"")], set()
    while todo:
        node, at = todo.pop()
        sizes.add(len(node.children))
        if node.value is not None:
            found.append(at)
        todo += [(c, at + c.path) for c in node.ordered()]
    assert set(found) == keys and len(found) == len(keys)
    small = turn_trie.Node(b"", None)
    for b in rng.sample(range(256), 256):
        small.put(b, b)
        assert small.child(b) == b
    assert small.ordered() == list(range(256))


def test_query_columns(spark):
    out = QUERIES["op12_turn_trie"](spark, "/root/testdata/sf0.001")
    assert out.columns == turn_trie.NODE_COLUMNS
    assert [t for _, t in out.dtypes] == ["bigint"] * 7 + ["string"]
