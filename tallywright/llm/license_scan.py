"""License scans: short notices found with a bounded number of edits.

A notice that occurs with at most k edits keeps at least p - k of any p disjoint parts of it unchanged
(pigeonhole).  So every notice is cut into seeds of about SEED characters, k + 1 of them at least, one
automaton finds the seeds of all notices in a single pass over a text, and each hit says where the notice
may begin.  Where enough different seeds of a notice agree on that to within k characters, the ``regex``
library looks for the notice with a bounded number of errors, and a match counts if it stands between
word boundaries and keeps the words that carry a license's name.

Texts are compared as words: A-Z lower-cased, every other ASCII character but digits is a gap.  Line
breaks, punctuation and quoting signs of comments therefore cost no edits.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F

from tallywright.llm.common import binary

#: Lower-cases A-Z and makes a space of every ASCII character that belongs to no word.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: One edit is allowed for so many characters of a notice (at least the license's name must be longer).
CHARACTERS_AN_EDIT = 10
#: Characters of a seed, where the edits leave room for that.
SEED = 6


class Notice(NamedTuple):
    label: str
    text: str
    #: Edits allowed; None takes one for CHARACTERS_AN_EDIT characters.
    errors: int | None = None
    #: Words that a match must hold unchanged: a short name has near words enough.
    keep: tuple[str, ...] = ()
    #: Whether an occurrence without edits counts as a base place.
    base: bool = False


#: Phrases whose places are counted, and their labels (fixed values).
PHRASES = (
    Notice("gpl", "gnu general public license", keep=("gnu",), base=True),
    Notice("apache", "apache license", base=True),
    Notice("cc-by", "cc by", errors=0, base=True),
    Notice("mit", "mit license", keep=("mit",), base=True),
)
#: Wordings of common licenses beyond the phrases.
WORDINGS = (
    Notice("gpl", "you can redistribute it and or modify it under the terms of the gnu"),
    Notice("lgpl", "gnu lesser general public license", keep=("gnu",)),
    Notice("agpl", "gnu affero general public license", keep=("gnu",)),
    Notice("gpl", "spdx license identifier gpl", errors=1, keep=("gpl",)),
    Notice("apache", "spdx license identifier apache", errors=1, keep=("apache",)),
    Notice("mit", "spdx license identifier mit", errors=1, keep=("mit",)),
    Notice("apache", "you may not use this file except in compliance with the license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    Notice("isc", "permission to use copy modify and or distribute this software for any purpose"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice("mpl", "mozilla public license"),
    Notice("epl", "eclipse public license"),
    Notice("cc-by", "creative commons attribution"),
    Notice("unlicense", "this is free and unencumbered software released into the public domain"),
    Notice("proprietary", "all rights reserved", errors=1),
)
NOTICES = PHRASES + WORDINGS

_WORD = regex.compile("[^ ]+")
_RESULT = """struct<n_words: bigint, matches: array<struct<label: string, notice: string, base: boolean, errors: int,
    first_word: bigint, last_word: bigint, start: bigint, end: bigint, similarity: double>>>"""
_FOUND = pa.struct(
    [("n_words", pa.int64())]
    + [("matches", pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("base", pa.bool_()), ("errors", pa.int32()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("similarity", pa.float64())])))]
)


def allowed(notice: Notice) -> int:
    return len(notice.text) // CHARACTERS_AN_EDIT if notice.errors is None else notice.errors


def seeds(text: str, errors: int) -> list[tuple[int, str]]:
    """Disjoint parts of a text that cover it, with their places; more than ``errors``."""
    parts = max(errors + 1, len(text) // SEED)
    ends = [len(text) * k // parts for k in range(parts + 1)]
    return [(a, text[a:b]) for a, b in zip(ends, ends[1:])]


class Scanner:
    """Finds notices in a text of words separated by single spaces."""

    def __init__(self, notices: Iterable[Notice] = NOTICES):
        self.notices = list(notices)
        places: dict[str, list[tuple[int, int]]] = {}
        self.patterns, self.needed = [], []
        for k, notice in enumerate(self.notices):
            errors = allowed(notice)
            if not notice.text or notice.text != " ".join(_normal(notice.text.encode()).split()):
                raise ValueError(f"a notice is lower-case words with single spaces: {notice.text!r}")
            if errors >= len(notice.text):
                raise ValueError(f"more edits than characters: {notice.text!r}")
            parts = seeds(notice.text, errors)
            self.needed.append(len(parts) - errors)
            for at, seed in parts:
                places.setdefault(seed, []).append((k, at))
            self.patterns.append(regex.compile(rf"(?b)(?:{regex.escape(notice.text)}){{e<={errors}}}") if errors else None)
        self.automaton = ahocorasick.Automaton()
        for seed, owners in places.items():
            self.automaton.add_word(seed, (len(seed), owners))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(notice, start, end, errors): every unchanged occurrence, and of the spans of whole words
        within the allowed edits those with fewest, the first and the shortest of equal ones, that
        overlap no other of their notice."""
        if not self.notices:
            return []
        hits: dict[int, list[tuple[int, int]]] = {}
        for end, (length, owners) in self.automaton.iter(text):
            for k, at in owners:
                hits.setdefault(k, []).append((end - length + 1 - at, at))
        out = []
        for k, found in sorted(hits.items()):
            if len(found) >= self.needed[k]:
                found.sort()
                out += self._verified(text, k, sorted(set(_agreeing(found, self.needed[k], allowed(self.notices[k])))))
        return out

    def _verified(self, text: str, k: int, begins: list[int]) -> list[tuple[int, int, int, int]]:
        notice, pattern, keep = self.notices[k].text, self.patterns[k], set(self.notices[k].keep)
        errors = allowed(self.notices[k])
        out = [(k, b, b + len(notice), 0) for b in begins if b >= 0 and text.startswith(notice, b) and _bounded(text, b, b + len(notice))]
        if pattern is None:
            return out
        # Stretches in which the notice may lie with edits, joined where they overlap.
        stretches: list[list[int]] = []
        for b in begins:
            low, high = max(0, b - errors), min(len(text), b + len(notice) + errors)
            if stretches and low <= stretches[-1][1]:
                stretches[-1][1] = max(stretches[-1][1], high)
            elif low < high:
                stretches.append([low, high])
        spans = []
        for low, high in stretches:
            words = [m.span() for m in _WORD.finditer(text, low, high)]
            words = [w for w in words if _bounded(text, *w)]
            for i, (begin, _) in enumerate(words):
                for _, end in words[i:]:
                    if end - begin > len(notice) + errors:
                        break
                    if end - begin >= len(notice) - errors and (found := pattern.fullmatch(text, begin, end)):
                        if (edits := sum(found.fuzzy_counts)) and keep <= set(text[begin:end].split(" ")):
                            spans.append((edits, begin, end))
        taken = sorted((b, e) for _, b, e, _ in out)
        for edits, begin, end in sorted(spans):
            at = bisect.bisect_left(taken, (end, 0))  # the spans before that begin before ``end``
            if not at or taken[at - 1][1] <= begin:
                taken.insert(at, (begin, end))
                out.append((k, begin, end, edits))
        return out


def _agreeing(hits: list[tuple[int, int]], needed: int, errors: int) -> list[int]:
    """Beginnings told by ``needed`` different seeds or more, to within ``errors`` characters."""
    if needed == 1:
        return [b for b, _ in hits]
    kept: list[int] = []
    seen: dict[int, int] = {}
    first = taken = 0  # hits[first : k + 1] lie within ``errors``; those before ``taken`` are kept already
    for k, (begin, seed) in enumerate(hits):
        seen[seed] = seen.get(seed, 0) + 1
        while begin - hits[first][0] > errors:
            seen[hits[first][1]] -= 1
            if not seen[hits[first][1]]:
                del seen[hits[first][1]]
            first += 1
        if len(seen) >= needed:
            kept += [b for b, _ in hits[max(first, taken) : k + 1]]
            taken = k + 1
    return kept


def _bounded(text: str, begin: int, end: int) -> bool:
    return (begin == 0 or text[begin - 1] == " ") and (end == len(text) or text[end] == " ")


def _normal(raw: bytes) -> str:
    return b" ".join(raw.translate(_WORDS).split(b" ")).decode("utf-8", "replace")


def scanner(notices: Iterable[Notice]) -> Callable[[bytes | None], dict]:
    """A function from a text to its number of words and its matches, as plain values."""
    find = Scanner(notices)

    def scan(raw: bytes | None) -> dict:
        spaced = (raw or b"").translate(_WORDS)
        words = spaced.split()
        if not words:
            return {"n_words": 0, "matches": []}
        text = b" ".join(words).decode("utf-8", "replace")
        found = find.find(text)
        return {"n_words": len(words), "matches": _described(find.notices, text, spaced, found) if found else []}

    return scan


def _described(notices: list[Notice], text: str, spaced: bytes, found: list[tuple[int, int, int, int]]) -> list[dict]:
    original = spaced.decode("utf-8", "replace")
    spans = [m.span() for m in _WORD.finditer(original)]
    breaks = [k for k, c in enumerate(text) if c == " "]
    out = []
    for k, begin, end, errors in sorted(found, key=lambda x: (x[1], x[2], x[0])):
        notice = notices[k]
        first, last = bisect.bisect_left(breaks, begin), bisect.bisect_left(breaks, end - 1)
        out.append(
            {
                "label": notice.label,
                "notice": notice.text,
                "base": notice.base and errors == 0,
                "errors": errors,
                "first_word": first,
                "last_word": last,
                "start": spans[first][0],
                "end": spans[last][1],
                "similarity": 1 - errors / (allowed(notice) + 1),
            }
        )
    return out


def scan(docs: DataFrame, notices: Iterable[Notice] = NOTICES, text_column: str = "text", result: str = "licenses") -> DataFrame:
    """``docs`` with a struct ``result``: ``n_words`` and ``matches``.

    A match has the notice's ``label`` and text, ``errors`` (edits), ``first_word`` and ``last_word``
    (from 0), ``start`` and ``end`` (code points of the text, half open), ``base`` (an unchanged
    occurrence of a notice marked so) and ``similarity`` (1 unchanged, less by 1 / (allowed + 1) an
    edit).  Matches stand by place.  All unchanged occurrences count, overlapping ones too; occurrences
    with edits are those with the fewest that overlap no other of the same notice.

    Null texts count as empty: no words, no matches.  Rows, repeated ones and those with null ids too,
    and all other columns stay as they are, but for one named ``result``, which is replaced.  An empty
    table stays empty.  One text is scanned by one task, in time linear in its length.
    """
    notices = list(notices)
    Scanner(notices)  # fails early
    kept = [c for c in docs.columns if c != result]
    position = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(kept)]
    text = F.col(f"`{text_column}`").cast("string").alias("scanned")
    source = docs.select(*position, text)
    schema = ", ".join(f"c{k} {source.schema[f'c{k}'].dataType.simpleString()}" for k in range(len(kept)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(notices)
        for batch in batches:
            columns = batch.columns[:-1]
            found = pa.array(map(find, binary(batch.column(len(columns)))), _FOUND)
            yield pa.RecordBatch.from_arrays([*columns, found], names=[*batch.schema.names[:-1], "found"])

    found = source.mapInArrow(run, f"{schema}{', ' if schema else ''}found {_RESULT}")
    return found.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], F.col("found").alias(result))


def labels(matches: Column) -> Column:
    """The distinct labels of matches, sorted and joined by commas; '' without any."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")


def best(matches: Column) -> Column:
    """The similarity of the best match, 0 without any."""
    return F.coalesce(F.array_max(F.transform(matches, lambda m: m["similarity"])), F.lit(0.0))
