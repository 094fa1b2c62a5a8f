from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallywright.llm import queries, variants

RUN = re.compile("[A-Za-zÀ-ÿ]+")
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def counted(rows, least, noise):
    out = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= least}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def by_hand(rows, least=6, count=5, ratio=5, noise=None):
    n = {w: k for w, k in counted(rows, least, noise).items() if k >= count}
    found = {}
    for w in n:
        close = sorted((x for x in n if near(w, x)), key=lambda x: (-n[x], x))
        form = close[0] if close and n[close[0]] >= ratio * n[w] else None
        found[w] = (form, len(close))
    out = []
    for w, (form, k) in found.items():
        root = w
        while found[root][0] is not None:
            root = found[root][0]
        out.append((w, form, root, n[w], k, n[form] if form else None))
    return sorted(out, key=repr)


def found(docs, **how):
    return sorted((tuple(r[c] for c in COLUMNS) for r in variants.spelling_variants(docs, **how).collect()), key=repr)


def test_index_finds_exactly_the_near_words():
    rng = random.Random(1)
    for level in (1, 2, 1, 2, 3) * 20:
        words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(1, 40))})
        work = [(w, *variants.piece(len(w), level, k)) for w in words for k in range(2**level)]
        who, number = variants.near_words(variants.Index(words), [w for w, _, _ in work], *(np.array(x) for x in list(zip(*work))[1:]))
        got = sorted((work[a][0], words[b]) for a, b in zip(who.tolist(), number.tolist()))
        assert got == sorted((a, b) for a in words for b in words if len(b) >= len(a) and a != b and near(a, b))


def test_intervals_of_both_directions_agree():
    index = variants.Index(["abab", "abb", "ba"])
    text = "".join("$%ab"[c] for c in index.text)
    assert text == "%abab%abb%ba%$"
    for pattern in ("a", "ab", "ba", "%ab", "b%", "abb", "bab%"):
        for order in (range(len(pattern)), range(len(pattern) - 1, -1, -1)):
            state = index.whole(1)
            for k in order:
                state = index.extend(state, np.array(["$%ab".index(pattern[k])]), right=order.step > 0)
            suffixes = sorted(text[k:] for k in range(len(text)))
            turned = sorted(text[:-1][::-1][k:] + "$" for k in range(len(text)))
            low = [s.startswith(pattern) for s in suffixes].index(True)
            back = [s.startswith(pattern[::-1]) for s in turned].index(True)
            assert state[:, 0].tolist() == [low, back, sum(s.startswith(pattern) for s in suffixes)]


def words_with_errors(rng, bases, times):
    out = []
    for _ in range(times):
        word = rng.choice(bases)
        for _ in range(rng.choice([0, 0, 0, 0, 0, 1, 1, 2])):
            k = rng.randrange(len(word))
            word = rng.choice([word[:k] + word[k + 1 :], word[:k] + rng.choice("aé") + word[k:], word[:k] + rng.choice("aé") + word[k + 1 :]])
        out.append(word.title() if rng.random() < 0.2 else word)
    return out


def test_random_texts_by_brute_force(frame):
    rng = random.Random(2)
    bases = ["aaaaaa", "aaaaaaa", "aaaéaaé", "receive", "recieve", "Écoutés", "straße", "aàaàaàaà"]
    rows = [(k, " 7,".join(words_with_errors(rng, bases, 120))) for k in range(20)] + [(None, "receive recieve " * 9)] * 2
    docs = frame(rows).cache()
    assert found(docs, least_count=2, ratio=2, noise=7) == by_hand(rows, count=2, ratio=2, noise=7)
    assert found(docs, least_length=3) == by_hand(rows, least=3)


def test_keys_that_many_words_share_are_cut_further(frame, monkeypatch):
    """Words with the same long beginning and end, far over the bounds of a key and of a shard."""
    monkeypatch.setattr(variants, "KEY_WORDS", 8)
    monkeypatch.setattr(variants, "SHARD_ROWS", 50)
    rng = random.Random(3)
    words = {"commonpart" + "".join(rng.choice("abc") for _ in range(rng.randint(3, 5))) + rng.choice(["", "ending"]) for _ in range(120)}
    words |= {w[1:] for w in words if rng.random() < 0.2}
    rows = [(1, " ".join(w for w in words for _ in range(rng.choice([1, 2, 9]))))]
    assert found(frame(rows), least_count=1, ratio=2) == by_hand(rows, count=1, ratio=2)


def test_whole_table_by_brute_force(spark, sf, texts):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in queries.op11_spelling_variants(spark, sf).collect()), key=repr)
    n = {w: k for w, k in counted(texts.items(), 6, 199).items() if k >= 5}
    by_rest = {}
    for w in n:  # only words that lose a letter to the same rest can be near
        for rest in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))}:
            by_rest.setdefault(rest, set()).add(w)
    assert {r[0]: r[3] for r in got} == n
    for w, form, _, k, n_near, form_n in got:
        close = {x for rest in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))} for x in by_rest.get(rest, ()) if x != w and near(w, x)}
        best = min(close, key=lambda x: (-n[x], x), default=None)
        assert n_near == len(close)
        assert (form, form_n) == ((best, n[best]) if best and n[best] >= 5 * k else (None, None))


def test_empty_nulls_and_one_very_long_word(frame):
    assert found(frame([])) == found(frame([(1, None), (2, ""), (3, "12 - short")])) == []
    long = "ab" * 10_000
    rows = [(1, " ".join([long] * 5 + [long + "a"] * 25 + [long[1:]] * 4))]
    assert found(frame(rows)) == [(long, long + "a", long + "a", 5, 1, 25), (long + "a", None, long + "a", 25, 1, None)]
    with pytest.raises(ValueError):
        variants.spelling_variants(frame([]), ratio=1)


def test_roots_over_a_long_chain(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(40)], "word string, form string")
    assert {r.root for r in variants.roots(forms).collect()} == {"w40"}
