from __future__ import annotations

import random
import re

import numpy as np

from tallywright.llm import near_dup, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def grouped_by_hand(rows, n, percent=80):
    sets = [shingles(t, n) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and None not in (rows[i][0], rows[j][0]) and 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                a, b = group[i], group[j]
                group = [a if g == b else g for g in group]
    out = []
    for i, (doc, _) in enumerate(rows):
        least = None if doc is None else min(rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None)
        out.append((doc, len(sets[i]), least, doc is None or doc == least))
    return sorted(out, key=repr)


def check(frame, rows, n=4, percent=80):
    got = near_dup.near_duplicates(frame(rows), n, percent).collect()
    assert sorted(map(tuple, got), key=repr) == grouped_by_hand(rows, n, percent)


def test_whole_table_by_brute_force(spark, sf, texts):
    got = queries.op10_near_duplicates(spark, sf).collect()
    assert sorted(map(tuple, got), key=repr) == grouped_by_hand(list(texts.items()), 4)


def test_a_large_family_of_edited_copies(frame):
    random.seed(2)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for doc in range(160):
        words = base[:]
        for at in random.sample(range(150), random.randint(0, 9)):
            words[at] = random.choice(["new", f"x{random.randint(0, 400)}"])
        rows.append((1000 - doc, " ".join(words)))
    check(frame, rows)


def test_chains_link_over_several_steps(frame):
    words = [f"w{k}" for k in range(100)]
    rows = [(50 - k, " ".join(words[2 * k : 2 * k + 60])) for k in range(15)]
    check(frame, rows)


def test_nulls_short_texts_repeats_and_same_ids(frame):
    rows = [(5, None), (6, ""), (7, " \n"), (8, "One two"), (9, "one  TWO"), (9, "one  TWO"), (None, "one two"), (4, "one two three"), (3, "É a b c d"), (2, "é a b c d"), (1, "a b c d"), (10, "a b c d")]
    check(frame, rows)
    assert near_dup.near_duplicates(frame([])).count() == 0
    assert near_dup.near_duplicates(frame([(1, None)])).collect()[0].component_id == 1


def test_signatures_estimate_similarity_with_low_variance():
    rng = np.random.default_rng(1)
    errors = []
    for share in (0.3, 0.5, 0.8):
        for _ in range(20):
            n, common = 200, int(200 * 2 * share / (1 + share))
            pool = rng.integers(0, 2**63, 2 * n - common, dtype=np.uint64)
            both = np.concatenate([pool[:n], pool[n - common :]])
            s = near_dup.super_minhash(both, np.repeat([0, 1], [n, len(both) - n]), 2)
            errors.append(float((s[0] == s[1]).mean()) - common / len(pool))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.045  # independent hashes: about 0.04


def test_signatures_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (1, 3, 40, 500)]
    owner = np.repeat(range(4), [len(s) for s in sets])
    whole = near_dup.super_minhash(np.concatenate(sets), owner, 4)
    for k, s in enumerate(sets):
        assert (near_dup.super_minhash(s, np.zeros(len(s), int), 1)[0] == whole[k]).all()
        ranks = np.sort(whole[k] >> np.uint64(53))
        assert len(s) > 1 or (ranks == np.arange(near_dup.SLOTS)).all()  # one element fills every slot once


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 400), (400, 500), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in near_dup.components(links).collect()}
    assert got == {k: 0 for k in range(201)} | {400: 400, 500: 400}


def test_very_long_sets_are_drawn_in_slices(monkeypatch):
    rng = np.random.default_rng(3)
    sets = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (700, 3, 250, 0, 90)]
    owner, elements = np.repeat(range(5), [len(s) for s in sets]), np.concatenate(sets)
    whole = near_dup.super_minhash(elements, owner, 5)
    monkeypatch.setattr(near_dup, "DRAWN_AT_ONCE", 100)
    assert (near_dup.signatures(elements, owner, 5) == whole).all()


def template(rng, words, own):
    """A template's words with a share of own ones."""
    return " ".join(f"own{rng.getrandbits(60)}" if rng.random() < own else w for w in words)


def meetings(spark, monkeypatch, frame, rows):
    """Pairs compared after the pivots, and the result."""
    seen = []
    confirmed = near_dup._confirmed
    monkeypatch.setattr(near_dup, "_confirmed", lambda pairs, *a: seen.append(pairs.count()) or confirmed(pairs, *a))
    got = near_dup.near_duplicates(frame(rows), 4, 80).collect()
    return seen, {r.doc_id: r.component_id for r in got}


def test_documents_of_one_template_do_not_all_meet(spark, monkeypatch, frame):
    rng = random.Random(4)
    words = [f"w{k}" for k in range(400)]
    rows = [(k, template(rng, words, 0.04)) for k in range(60)]
    seen, component = meetings(spark, monkeypatch, frame, rows)
    assert component == {k: k for k in range(60)}
    assert seen[0] <= 32 * 60 and sum(seen[1:]) < 60  # of 1,770 pairs: with pivots at most one a band, then hardly any


def test_links_beyond_the_pivots_are_found(frame):
    """Edits that put some members of a family just below the threshold to its centre."""
    rng = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, template(rng, words, rng.choice([0.0, 0.01, 0.02, 0.03]))) for k in range(40)]
    rows += [(100 + k, rows[k][1] + f" tail{k} more words here") for k in range(0, 40, 3)]
    check(frame, rows)


def test_rows_repeated_many_times(frame):
    base = [f"w{k}" for k in range(120)]
    two = [(1, " ".join(base)), (2, " ".join(base[:-3]))] * 40 + [(2, " ".join(base[:-2]))] * 5 + [(None, " ".join(base))] * 3
    check(frame, two)
