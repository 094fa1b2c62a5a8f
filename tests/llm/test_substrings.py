from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from tallywright.llm import queries, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def gone_by_hand(rows, length):
    """The removed word positions of each row."""
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (doc, _), w in zip(rows, words):
        for k in range(len(w) - length + 1):
            if doc is not None:
                key = tuple(w[k : k + length])
                first[key] = min(first.get(key, doc), doc)
    out = []
    for (doc, _), w in zip(rows, words):
        gone = set()
        for k in range(len(w) - length + 1):
            if doc is not None and first[tuple(w[k : k + length])] < doc:
                gone |= set(range(k, k + length))
        out.append((w, gone))
    return out


def check(frame, rows, length):
    got = substrings.remove_repeats(frame(rows), length).collect()
    want = [(d, len(w), len(g), " ".join(x for k, x in enumerate(w) if k not in g)) for (d, _), (w, g) in zip(rows, gone_by_hand(rows, length))]
    mine = [(r.doc_id, r.repeats.n_words, r.repeats.n_removed, r.repeats.kept) for r in got]
    assert sorted(mine, key=repr) == sorted(want, key=repr)
    for r in got:
        assert sum(e - s for s, e in r.repeats.removed) == r.repeats.n_removed


def test_whole_table_by_brute_force(spark, sf, texts):
    rows = list(texts.items())
    want = {
        d: (len(w), len(g), hashlib.sha256(" ".join(x for k, x in enumerate(w) if k not in g).encode()).hexdigest())
        for (d, _), (w, g) in zip(rows, gone_by_hand(rows, 13))
    }
    got = {r[0]: tuple(r)[1:] for r in queries.op5_substring_dedup(spark, sf).collect()}
    assert got == want and any(n for _, n, _ in want.values())


@pytest.mark.parametrize("length", [1, 5, 13])
def test_random_texts_with_shared_passages(frame, length, monkeypatch):
    monkeypatch.setattr(substrings, "FLUSH", 50)  # several batches a task
    random.seed(length)
    passage = [random.choice("abcdefgh") + str(random.randint(0, 50)) for _ in range(60)]
    rows = []
    for doc in random.sample(range(-50, 500), 60):
        words = [random.choice("xyz") + str(random.randint(0, 3 * length)) for _ in range(random.randint(0, 50))]
        at, n = random.randint(0, 40), random.randint(length - 2 if length > 2 else 1, 25)
        rows.append((doc, " ".join(words + passage[at : at + n] + words[:3])))
    check(frame, rows, length)


def test_every_pair_of_positions_shares_an_anchor():
    for m, cover in substrings.COVERS.items():
        for i in range(m):
            for j in range(m):
                assert any((i + d) % m in cover and (j + d) % m in cover for d in range(m))


def test_nulls_repeats_same_ids_and_clashing_columns(frame):
    p = " ".join(f"w{k}" for k in range(20))
    rows = [(2, p), (2, p), (1, f"{p} tail"), (None, p), (3, None), (4, ""), (5, f"a\n{p}\tb"), (5, f"other {p}"), (6, "w0 w1"), (7, "é" * 9)]
    check(frame, rows, 13)


def test_text_layout_keeps_what_stays_as_it_was(frame):
    p = " ".join(f"w{k}" for k in range(13))
    rows = [(1, p), (2, f"  head\n{p}\n\ntail  end "), (3, " two  spaces "), (4, f"x {p}"), (5, None)]
    got = {r.doc_id: r.repeats.kept for r in substrings.remove_repeats(frame(rows), 13, layout="text").collect()}
    assert got == {1: p, 2: "  head\ntail  end ", 3: " two  spaces ", 4: "x ", 5: ""}


def test_empty_table_and_wrong_arguments(frame):
    assert substrings.remove_repeats(frame([])).count() == 0
    with pytest.raises(ValueError):
        substrings.remove_repeats(frame([]), 0)


def test_hot_passage_costs_each_task_two_entries():
    docs = np.repeat(np.arange(1000), 3)
    keys = np.tile(np.array([5, 6, 7], np.uint64), 1000)
    sent, known = substrings._send_anchors(docs, keys, 4)
    assert sum(len(b) for b in sent["docs"].to_pylist()) == 8 * 6
    assert sum(len(b) for b in known["docs"].to_pylist()) == 8 * 3000
