"""Token counts by the whole-token shortcut of byte-level BPE.

Most pre-tokens of a text are vocabulary entries.  Such an entry may only be counted as one
token when merging its bytes really ends in that entry, so this is proven once per vocabulary
(:func:`whole_tokens`); the proven strings go to every task, matching pre-tokens count as one,
and only the remaining pre-tokens are merged.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tallywright.llm.common import Memo

# Fixed value: the pre-token pattern of byte-level BPE.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


_NEVER = 1 << 60


class _Loose(Exception):
    """A space-separated stretch that is empty or has other white space at an end."""


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """The parts of a ``tokenizers`` byte-level BPE file that counting needs."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        wrong = [
            what
            for what, bad in (
                ("model", model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges")),
                ("normalizer", spec.get("normalizer") is not None),
                ("pre_tokenizer", split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True)),
                ("added_tokens", any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"])),
            )
            if bad
        ]
        if wrong:
            raise ValueError(f"not a plain byte-level BPE file: {', '.join(wrong)}")
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.ranks = {tuple(pair): k for k, pair in enumerate(pairs)}
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}

    @classmethod
    def of(cls, parts: dict) -> Vocabulary:
        """From ``vars`` of another one: broadcasts carry plain values."""
        made = cls.__new__(cls)
        made.__dict__.update(parts)
        return made

    def merge(self, letters: str) -> list[str]:
        """The pieces that a pre-token, given in byte letters, ends as."""
        pieces, rank = list(letters), self.ranks.get
        ranks = [rank(pair, _NEVER) for pair in zip(pieces, pieces[1:])]
        while ranks:
            best = min(ranks)
            if best == _NEVER:
                break
            k = ranks.index(best)
            pieces[k : k + 2] = [pieces[k] + pieces[k + 1]]
            del ranks[k]
            if k:
                ranks[k - 1] = rank((pieces[k - 1], pieces[k]), _NEVER)
            if k < len(ranks):
                ranks[k] = rank((pieces[k], pieces[k + 1]), _NEVER)
        return pieces


def whole_tokens(vocabulary: Vocabulary) -> list[str]:
    """Vocabulary strings proven to be one pre-token that merges to one token."""
    letter = {c: b for b, c in enumerate(byte_letters())}
    find, proven = regex.compile(PATTERN).findall, []
    for entry in vocabulary.ids:
        if any(c not in letter for c in entry):
            continue  # an added token, not made of bytes
        try:
            text = bytes(letter[c] for c in entry).decode()
        except UnicodeDecodeError:
            continue  # part of a character: never a pre-token by itself
        if find(text) == [text] and vocabulary.merge(entry) == [entry]:
            proven.append(text)
    return proven


def counter(vocabulary: Vocabulary, proven: list[str]) -> Callable[[str], int]:
    """A function from a text to its number of tokens."""
    letters, whole = byte_letters(), dict.fromkeys(proven, 1)

    def merged(token: str) -> int:
        if token in whole:
            return 1
        data = token.encode()
        if len(data) > 400:  # a run too long for repeated scans
            return _long_run(vocabulary, "".join(letters[b] for b in data))
        return len(vocabulary.merge("".join(letters[b] for b in data)))

    sizes = Memo(merged)
    size, find = sizes.__getitem__, regex.compile(PATTERN).findall
    special = regex.compile("|".join(map(regex.escape, sorted(vocabulary.special, key=len, reverse=True)))) if vocabulary.special else None

    def spaced(stretch: str) -> int:
        if not stretch or stretch[0].isspace() or stretch[-1].isspace():
            raise _Loose
        return sum(map(size, find(" " + stretch)))

    stretches = Memo(spaced).__getitem__

    def part(text: str) -> int:
        # A pre-token begins at every single space between two other characters, so the stretches
        # in between count by themselves, and each distinct one needs the pattern once.
        first, *rest = text.split(" ")
        try:
            if first and rest and first[-1].isspace():
                raise _Loose
            return sum(map(size, find(first))) + sum(map(stretches, rest))
        except _Loose:
            return sum(map(size, find(text)))

    def count(text: str) -> int:
        if special is None or not any(s in text for s in vocabulary.special):
            return part(text)
        between = special.split(text)
        return len(between) - 1 + sum(map(part, between))

    return count


def _long_run(vocabulary: Vocabulary, letters: str) -> int:
    """Merging with a heap of pairs, for pre-tokens of any length."""
    import heapq

    n, ranks = len(letters), vocabulary.ranks
    piece, left, right = list(letters), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, k, piece[k], piece[k + 1]) for k in range(n - 1) if (r := ranks.get((piece[k], piece[k + 1]))) is not None]
    heapq.heapify(heap)
    count = n
    while heap:
        _, k, a, b = heapq.heappop(heap)
        after = right[k] if piece[k] is not None else n
        if piece[k] != a or after >= n or piece[after] != b:
            continue  # one of the two has been merged meanwhile
        piece[k], piece[after] = a + b, None
        right[k] = right[after]
        if right[k] < n:
            left[right[k]] = k
        count -= 1
        for at in (left[k], k):
            if at >= 0 and right[at] < n:
                pair = (piece[at], piece[right[at]])
                if pair in ranks:
                    heapq.heappush(heap, (ranks[pair], at, *pair))
    return count


def count_tokens(docs: DataFrame, path: str, limit: int = 512, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of every row.

    Null texts count as empty (0 bytes, 0 tokens); repeated rows stay repeated; a null id stays
    null; special strings of the vocabulary inside a text are one token each.  Other columns are
    not read, so their names cannot clash.  The vocabulary (bounded by its file, not by the data)
    is proven once on the driver and broadcast.
    """
    spark = docs.sparkSession
    vocabulary = Vocabulary(path)
    shared = spark.sparkContext.broadcast((vars(vocabulary), whole_tokens(vocabulary)))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, proven = shared.value
        count = counter(Vocabulary.of(parts), proven)
        for batch in batches:
            tokens = pa.array((count(t) if t else 0 for t in batch.column(2).to_pylist()), pa.int64())
            yield pa.record_batch([batch.column(0), batch.column(1), tokens], names=[id_column, "n_bytes", "n_tokens"])

    text = F.coalesce(F.col(f"`{text_column}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias(id_column), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(counted, f"`{id_column}` long, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
