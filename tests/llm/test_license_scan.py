from __future__ import annotations

import random
import re

import pytest

from tallywright.llm import license_scan, queries
from tallywright.llm.license_scan import NOTICES, PHRASES, Notice

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def by_hand(text, notices=NOTICES):
    """Every span of whole words against every notice."""
    words = [(m.group(), m.start(), m.end()) for m in WORD.finditer(lowered(text))]
    out = []
    for notice in notices:
        most, spans = license_scan.allowed(notice), []
        for i in range(len(words)):
            for j in range(i, len(words)):
                span = " ".join(w for w, _, _ in words[i : j + 1])
                if len(span) > len(notice.text) + most:
                    break
                if len(span) < len(notice.text) - most:
                    continue
                errors = distance(span, notice.text)
                if errors <= most and (not errors or set(notice.keep) <= set(span.split())):
                    spans.append((errors, i, j))
        chosen = []
        for errors, i, j in sorted(spans):
            if not errors or all(j < a or i > b for _, a, b in chosen):
                chosen.append((errors, i, j))
        out += [(i, j, notice.text, e, words[i][1], words[j][2]) for e, i, j in chosen]
    return sorted(out)


def found(text, notices=NOTICES):
    scanned = license_scan.scanner(notices)(None if text is None else text.encode())
    return sorted((m["first_word"], m["last_word"], m["notice"], m["errors"], m["start"], m["end"]) for m in scanned["matches"])


def edited(rng, text, edits):
    for _ in range(edits):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1 :], text[:at] + rng.choice("aeblx é") + text[at:], text[:at] + rng.choice("aeblx") + text[at + 1 :]])
    return text


def test_edited_notices_by_brute_force():
    rng = random.Random(5)
    for _ in range(40):
        notice = rng.choice(NOTICES)
        parts = ["été", "Words; here", edited(rng, notice.text, rng.randint(0, license_scan.allowed(notice) + 1)), rng.choice(["", "license", "the public", notice.text[: len(notice.text) // 2]]), edited(rng, rng.choice(PHRASES).text.title(), 1)]
        rng.shuffle(parts)
        text = rng.choice([" ", "\n# ", " -- "]).join(parts)
        assert found(text) == by_hand(text), text


def test_whole_table_by_brute_force(spark, sf, texts):
    got = {r.doc_id: r for r in queries.op12_license_scan(spark, sf).collect()}
    assert set(got) == set(texts)
    for doc, text in texts.items():
        words = WORD.findall(lowered(text))
        places = [(k, p.label) for p in PHRASES for k in range(len(words)) if words[k : k + len(p.text.split())] == p.text.split()]
        starts = [k for k, _ in places]
        row = got[doc]
        base = sorted({label for _, label in places})
        assert (row.n_words, row.n_base, row.first_word, row.last_word) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert row.base_labels == ",".join(base) and set(base) <= set(filter(None, row.labels.split(",")))
        assert (row.score > 0) == bool(row.labels) and 0 <= row.score <= 1 and (not places or row.score == 1)
    assert any(r.n_base for r in got.values())
    for doc in sorted(texts)[:30]:
        if len(texts[doc] or "") < 900:
            assert found(texts[doc]) == by_hand(texts[doc])


def test_misspelled_and_broken_notices():
    assert [(m[2], m[3]) for m in found("Released under the MIT Licence.")] == [("mit license", 1)]
    assert [(m[2], m[3]) for m in found("// GNU Generall\n// Publik License")] == [("gnu general public license", 2)]
    assert [m[3] for m in found("Permission is hereby granted, free of charge, to any persn obtaining copy of")] == [3]
    assert found("accept it license") == found("submit license") == found("ccby c by") == []
    assert [m[:2] for m in found("MIT license mit license")] == [(0, 1), (2, 3)]


def test_overlapping_unchanged_places_all_count():
    notices = [Notice("x", "aa bb aa", errors=0)]
    assert [m[0] for m in found("aa bb aa bb aa", notices)] == [0, 2]
    edited = [Notice("x", "aa bb aa", errors=1)]
    assert [(m[0], m[3]) for m in found("aa bb aa bb aa bc aa", edited)] == [(0, 0), (2, 0)]


def test_nulls_repeats_empty_and_clashing_columns(spark, frame):
    rows = [(1, None), (2, ""), (3, " \n-"), (None, "MIT License"), (None, "MIT License"), (4, "cc by " * 3), (5, "x")]
    docs = frame(rows).withColumnRenamed("n", "licenses")
    got = license_scan.scan(docs)
    assert sorted(got.columns) == sorted(docs.columns)
    seen = sorted(((r.doc_id, r.text, r.licenses.n_words, len(r.licenses.matches)) for r in got.collect()), key=repr)
    assert seen == sorted([(1, None, 0, 0), (2, "", 0, 0), (3, " \n-", 0, 0), (None, "MIT License", 2, 1), (None, "MIT License", 2, 1), (4, "cc by " * 3, 6, 3), (5, "x", 1, 0)], key=repr)
    assert license_scan.scan(frame([])).count() == 0
    assert all(not r.licenses.matches for r in license_scan.scan(frame([(1, "mit license")]), []).collect())
    with pytest.raises(ValueError):
        license_scan.scan(docs, [Notice("x", "Not Lower")])


def test_very_long_texts_take_linear_time():
    import time

    def seconds(times):
        start = time.perf_counter()
        found("the mit licens all rights reserve, permission to use copy " * times)
        return time.perf_counter() - start

    seconds(100)
    assert seconds(20_000) < 40 * max(seconds(2_000), 0.05)
