from __future__ import annotations

import glob
import hashlib
import os
import random
import zlib

import numpy as np
import pytest

from tallywright.llm import prefix_trie, queries

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def by_hand(rows):
    def mark(role, text):
        return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()

    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn, mark(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts, key=lambda t: (t[0], t[1] or 0, t[2]))] for c, ts in turns.items()}
    paths = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        paths[c] = own.get(base, [])[:h] + own[c][h:]
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    out = []
    for node, who in members.items():
        under = [v for v in members if v[: len(node)] == node]
        children = [v for v in under if len(v) == len(node) + 1]
        leaves = [v for v in under if not any(len(x) == len(v) + 1 and x[: len(v)] == v for x in under)]
        spared = sum((len(members[v]) - 1) * len(v[-1][1].encode()) for v in under if v)
        ends = ",".join(str(c) for c in sorted(who) if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(who), len(node), parent, len(who), len(children), len(leaves), spared, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.fixture
def talks(spark):
    def make(rows):
        kind = "conv_id long, turn long, role string, text string, c long, pos string, depth int, last boolean"
        return spark.createDataFrame([(*r, 1, "x", 2, True) for r in rows], kind)

    return make


def found(frame, **how):
    return sorted((tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(frame, **how).collect()), key=repr)


def random_talks(rng, convs, long=12):
    rows = []
    for c in convs:
        for turn in range(rng.randint(1, long)):
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["user", None, "bot"]), rng.choice(["é", "a", "a", "a", None, "longer text"])))
    return rows


def test_random_conversations_by_brute_force(talks):
    rng = random.Random(3)
    rows = random_talks(rng, [*range(25), -7, -5, 1000, 1004, 10**12]) + [(None, 1, "user", "a")] * 3
    rows += rows[:4]
    rng.shuffle(rows)
    assert found(talks(rows)) == by_hand(rows)


def test_many_ranges_and_a_full_sketch_change_nothing(spark, talks, monkeypatch):
    """One conversation over many ranges, hot keys at both joins, estimates that are mostly too high."""
    monkeypatch.setattr(prefix_trie, "RANGE_ROWS", 10)
    monkeypatch.setattr(prefix_trie, "HOT_SHARE", 0.05)
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 3)
    monkeypatch.setattr(prefix_trie, "BLOCK_CELLS", 16)
    rng = random.Random(4)
    rows = random_talks(rng, range(40), 9)
    for c in (15, 16, 17):  # long ones with equal beginnings and, two of them, equal ends
        rows = [r for r in rows if r[0] != c] + [(c, k, "user", f"t{k if k < 30 or c < 17 else -k}") for k in range(60)]
    for c in range(50, 70):  # a common conversation
        rows += [(c, k, "user", f"same {k}") for k in range(9)]
    assert found(talks(rows), most_cells=16) == by_hand(rows)


def test_turnless_and_empty(talks):
    assert found(talks([])) == found(talks([(None, 0, "user", "x")])) == []
    one = [(11, 0, "user", "x")]  # crc32 decides whether the own turn stays, base 10 is absent
    assert found(talks(one)) == by_hand(one)
    empty = [(k, None, None, None) for k in range(20)]
    assert found(talks(empty)) == by_hand(empty)


def test_estimates_are_never_too_low():
    rng = np.random.default_rng(1)
    d1, d2 = rng.integers(-(2**63), 2**63, (2, 500))
    n = rng.integers(1, 4, 500)
    width = 256
    cells = np.zeros(2 * width, np.int64)
    at = prefix_trie.Sketch.places(width, np.repeat(d1, n), np.repeat(d2, n))
    np.add.at(cells, at.ravel(), 1)
    sketch = prefix_trie.Sketch(width, prefix_trie._pack(np.minimum(cells, 2).astype(np.uint8)))
    assert (prefix_trie._unpack(sketch.packed) == np.minimum(cells, 2)).all()
    assert (sketch.estimates(d1, d2) >= np.minimum(n, 2)).all()


def test_tails_are_not_shuffled_for_grouping(spark, sf):
    """The sketch proves what it can: in the given table all prefixes with one member."""
    conversations = spark.read.parquet(f"{sf}/conversations.parquet")
    nodes = prefix_trie.prefix_trie(conversations)
    singles = nodes.where("n_convs = 1").count()
    base = spark.conf.get("spark.checkpoint.dir")
    newest = max(glob.glob(f"{base}/llm-screened-*"), key=lambda p: os.path.getmtime(p))
    assert spark.read.parquet(newest).where("single").count() == singles


def test_query_against_sql(spark, sf):
    from tests import oracle

    assert oracle.compare(queries.op13_prefix_trie(spark, sf), oracle.duck(sf), queries.SQL["op13_prefix_trie"]) == []
