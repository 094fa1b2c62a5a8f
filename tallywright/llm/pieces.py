"""SentencePiece encoding and decoding with a batched numpy Viterbi pass.

Texts are first cut wherever two neighbouring characters stand side by side in no piece: nothing can
merge across.  The distinct stretches of a batch that are not yet known are grouped by length, and all
stretches of a length advance together, one character at a time.  Hashes of the substrings that end
there probe the sorted piece keys, and the best of the candidates is stored as a backpointer.

For unigram models the best candidate is the one with the largest sum of scores.  For BPE models sums
of scores do not give the library's result, because BPE is the outcome of ranked merges.  Here a
candidate counts if it may follow the last piece of the prefix before it, that is, if merging the two
pieces' characters gives back the two pieces.  A sequence of pieces is the BPE encoding exactly if all
its neighbours have this property, so one candidate is left at each position and the same backward
walk yields the library's ids.
"""

from __future__ import annotations

import codecs
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tallywright.llm.common import MEMO_ENTRIES

SPACE = "▁"
_BASE = 0x9E3779B97F4A7C15
_NEVER = 2**62
_NONE = -1


def load(path: str, kind: str = "bpe") -> dict:
    """The parts of a model file that tasks need, as plain values."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.vocab_size()
    if any(model.is_unused(k) for k in range(n)):
        raise ValueError("unused pieces are not supported")
    probe = "Ａ  ﬁ b "
    if model.decode(model.encode(probe)) != probe or model.id_to_piece(model.encode("a")[0])[0] != SPACE:
        raise ValueError("only models that keep their text and add a leading space are supported")
    plain = [not (model.is_byte(k) or model.is_control(k) or model.is_unknown(k)) for k in range(n)]
    return describe(
        [model.id_to_piece(k) for k in range(n)],
        [model.get_score(k) for k in range(n)],
        plain,
        {int(model.id_to_piece(k)[3:5], 16): k for k in range(n) if model.is_byte(k)},
        model.unk_id(),
        kind,
    )


def describe(pieces: list[str], scores: list[float], plain: list[bool], byte_ids: dict[int, int], unknown: int, kind: str) -> dict:
    """Tables derived from a vocabulary once, on the driver; their size is bounded by it."""
    if kind not in ("bpe", "unigram"):
        raise ValueError("kind must be bpe or unigram")
    ids = {p: k for k, p in enumerate(pieces) if plain[k]}
    parts = {"pieces": pieces, "scores": scores, "plain": plain, "byte_ids": byte_ids, "unknown": unknown, "kind": kind, "ids": ids}
    if kind == "bpe":
        by_score = sorted(ids.values(), key=lambda k: -scores[k])
        rank = {pieces[k]: r for r, k in enumerate(by_score)}
        parts["rank"] = rank
        left, right, whole = [_NONE] * len(pieces), [_NONE] * len(pieces), [False] * len(pieces)
        for piece, k in ids.items():
            halves = _last_merge(piece, rank)
            whole[k] = halves is not None
            if halves and len(piece) > 1:
                left[k], right[k] = ids[halves[0]], ids[halves[1]]
        for k, ok in enumerate(whole):
            if ok and left[k] != _NONE and not all(len(pieces[h]) == 1 or rank[pieces[h]] < rank[pieces[k]] for h in (left[k], right[k])):
                raise ValueError("a piece is ranked before its own parts")
        parts |= {"left": left, "right": right, "whole": whole}
    return parts


def _last_merge(piece: str, rank: dict[str, int]) -> tuple[str, str] | None:
    """The two pieces merged last when ``piece`` is encoded alone; None if it does not end as itself."""
    symbols = list(piece)
    if len(symbols) == 1:
        return (piece, "")
    while len(symbols) > 2:
        best = min(range(len(symbols) - 1), key=lambda k: rank.get(symbols[k] + symbols[k + 1], _NEVER))
        if symbols[best] + symbols[best + 1] not in rank:
            return None
        symbols[best : best + 2] = [symbols[best] + symbols[best + 1]]
    return (symbols[0], symbols[1])


class Encoder:
    """Ids of stretches of text, many at a time."""

    def __init__(self, parts: dict):
        self.parts, self.bpe = parts, parts["kind"] == "bpe"
        pieces, ids = parts["pieces"], parts["ids"]
        n = len(pieces)
        self.longest = max(map(len, ids), default=1)
        self.powers = np.array([pow(_BASE, k, 2**64) for k in range(self.longest + 1)], np.uint64)
        hashes = np.array([self._hash(p) for p in ids], np.uint64)
        order = np.argsort(hashes)
        self.keys, self.key_ids = hashes[order], np.array(list(ids.values()), np.int64)[order]
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("piece keys collide")
        self.key_lengths = np.array([len(pieces[k]) for k in self.key_ids])
        self.scores = np.append(np.array(parts["scores"], np.float64), 0.0)
        self.stranger = n  # stands for a character without a piece
        if self.bpe:
            ranks = np.full(n + 1, -1, np.int64)  # characters are there from the beginning
            for p, k in ids.items():
                if len(p) > 1:
                    ranks[k] = parts["rank"][p]
            self.ranks = ranks
            self.left = np.append(np.array(parts["left"], np.int64), _NONE)
            self.right = np.append(np.array(parts["right"], np.int64), _NONE)
            self.whole = np.append(np.array(parts["whole"], bool), True)
            pairs = [(ids[p[:c]] * (n + 1) + ids[p[c:]], parts["rank"][p]) for p in ids for c in range(1, len(p)) if p[:c] in ids and p[c:] in ids]
            pairs.sort()
            self.pair_keys = np.array([k for k, _ in pairs] + [_NEVER], np.int64)
            self.pair_ranks = np.array([r for _, r in pairs] + [_NEVER], np.int64)
        letters = sorted({c for p in ids for c in p})
        self.letter = np.zeros(0x110000, np.uint16)
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.meet = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for p in ids:
            at = self.letter[[ord(c) for c in p]]
            self.meet[at[:-1], at[1:]] = True
        self.memo: dict[str, bytes] = {}

    def _hash(self, text: str) -> int:
        value = 0
        for c in text:
            value = (value * _BASE + ord(c) + 1) % 2**64
        return value

    def stretches(self, text: str) -> list[str]:
        """The text as the model sees it, cut where no piece can reach across."""
        text = SPACE + text.replace(" ", SPACE)
        at = self.letter[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
        ends = (np.flatnonzero(~self.meet[at[:-1], at[1:]]) + 1).tolist()
        return [text[a:b] for a, b in zip([0, *ends], [*ends, len(text)])]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids (little-endian unsigned 32-bit) of each text."""
        cut = [self.stretches(t) if t else [] for t in texts]
        fresh = {s for stretches in cut for s in stretches if s not in self.memo}
        if len(self.memo) + len(fresh) > MEMO_ENTRIES:
            self.memo, fresh = {}, {s for stretches in cut for s in stretches}
        by_length: dict[int, list[str]] = {}
        for s in fresh:
            by_length.setdefault(len(s), []).append(s)
        for length, group in by_length.items():
            step = max(1, 400_000 // (length * min(length, self.longest)))
            for k in range(0, len(group), step):
                some = group[k : k + step]
                self.memo.update(zip(some, self._together(some, length)))
        return [b"".join(map(self.memo.__getitem__, stretches)) for stretches in cut]

    def _together(self, group: list[str], n: int) -> list[bytes]:
        """All stretches of one length at once: forward pass and backward walk."""
        codes = np.frombuffer("".join(group).encode("utf-32-le"), np.uint32).reshape(-1, n)
        w, most = len(group), min(n, self.longest)
        prefix = np.zeros((w, n + 1), np.uint64)
        for k in range(n):
            prefix[:, k + 1] = prefix[:, k] * self.powers[1] + codes[:, k] + np.uint64(1)
        last = np.full((w, n + 1), self.stranger, np.int64)  # the piece that ends here: the backpointer
        best = np.zeros((w, n + 1))
        floor = self.scores[:-1].min() - 10.0
        lengths = np.append(np.array([len(p) for p in self.parts["pieces"]]), 1)
        for end in range(1, n + 1):
            if self.bpe:
                open_ = np.arange(w)
                for size in range(min(end, most), 0, -1):
                    piece = self._probe(prefix, open_, end, size)
                    ok = piece != _NONE
                    if size == 1:
                        last[open_, end] = np.where(ok, piece, self.stranger)
                        break
                    rows, found = open_[ok], piece[ok]
                    good = self.whole[found]
                    if end > size:
                        good &= self._follows(last[rows, end - size], found)
                    last[rows[good], end] = found[good]
                    done = np.zeros(w, bool)
                    done[rows[good]] = True
                    open_ = open_[~done[open_]]
                    if not len(open_):
                        break
            else:
                top = best[:, end - 1] + floor
                rows = np.arange(w)
                for size in range(min(end, most), 0, -1):
                    piece = self._probe(prefix, rows, end, size)
                    value = np.where(piece != _NONE, best[:, end - size] + self.scores[piece], -np.inf)
                    better = value > top
                    top = np.where(better, value, top)
                    last[better, end] = piece[better]
                best[:, end] = top
        walk, out = np.full(w, n), []
        while (walk > 0).any():
            rows = np.arange(w)
            piece = np.where(walk > 0, last[rows, walk], _NONE)
            out.append((piece, walk.copy()))
            walk = np.where(walk > 0, walk - lengths[piece], 0)
        steps = np.array([p for p, _ in out][::-1]).T.reshape(w, -1)
        ends = np.array([e for _, e in out][::-1]).T.reshape(w, -1)
        strange = (steps == self.stranger).any(1)
        plain = steps.astype("<u4")
        keep = steps != _NONE
        return [self._with_bytes(group[k], steps[k], ends[k]) if strange[k] else plain[k][keep[k]].tobytes() for k in range(w)]

    def _with_bytes(self, text: str, steps: np.ndarray, ends: np.ndarray) -> bytes:
        """Characters without a piece as their bytes, or as the unknown id."""
        out, byte_ids, before = [], self.parts["byte_ids"], False
        for piece, end in zip(steps.tolist(), ends.tolist()):
            if piece == _NONE:
                continue
            strange = piece == self.stranger
            if not strange:
                out.append(piece)
            elif byte_ids:
                out.extend(byte_ids[b] for b in text[end - 1].encode())
            elif not before:
                out.append(self.parts["unknown"])
            before = strange
        return np.array(out, "<u4").tobytes()

    def _probe(self, prefix: np.ndarray, rows: np.ndarray, end: int, size: int) -> np.ndarray:
        """Pieces that are the ``size`` characters before ``end``, -1 where there is none."""
        key = prefix[rows, end] - prefix[rows, end - size] * self.powers[size]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (self.key_lengths[at] == size), self.key_ids[at], _NONE)

    def _follows(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Whether merging the characters of both pieces gives the two pieces.

        The pieces' own merges are undone from the latest to the earliest.  At each moment one symbol
        of either piece touches the border; had their merge come before the next of the pieces' own
        merges (of equal ones the leftmost is first), it would have crossed the border.
        """
        fine = np.ones(len(one), bool)
        rows = np.arange(len(one))
        x, y = one.copy(), two.copy()
        limit_x, limit_y = np.full(len(one), _NEVER), np.full(len(one), _NEVER)
        while len(rows):
            key = x * (self.stranger + 1) + y
            at = np.searchsorted(self.pair_keys, key)
            merged = np.where(self.pair_keys[at] == key, self.pair_ranks[at], _NEVER)
            crossed = (merged < limit_x) & (merged <= limit_y) & (merged < _NEVER)
            fine[rows[crossed]] = False
            rank_x, rank_y = self.ranks[x], self.ranks[y]
            go = ~crossed & ((rank_x >= 0) | (rank_y >= 0))
            later_y = rank_y >= rank_x  # of equal merges the right one came last
            limit_y = np.where(later_y, rank_y, limit_y)[go]
            limit_x = np.where(later_y, limit_x, rank_x)[go]
            x, y = np.where(later_y, x, self.right[x])[go], np.where(later_y, self.left[y], y)[go]
            rows = rows[go]
        return fine


def decoder(parts: dict) -> Callable[[bytes], str]:
    """A function from ids to text.  Control ids vanish, the unknown id is a mark, bytes that form no
    character are one replacement mark each."""

    def each_byte(error: UnicodeDecodeError):
        return "�" * (error.end - error.start), error.end

    codecs.register_error("each-byte", each_byte)
    shown = [p.encode() if ok else b"" for p, ok in zip(parts["pieces"], parts["plain"])]
    shown[parts["unknown"]] = " ⁇ ".encode()
    for b, k in parts["byte_ids"].items():
        shown[k] = bytes([b])

    def decode(ids: bytes) -> str:
        text = b"".join(map(shown.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode(errors="each-byte")
        return text.replace(SPACE, " ").removeprefix(" ")

    return decode


def encode(docs: DataFrame, path: str, kind: str = "bpe", id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``text`` and ``ids`` (binary, little-endian unsigned 32-bit) of every row.

    Null texts are taken as empty and have no ids.  Repeated rows stay, null ids stay null, other
    columns are not read.  Tables of the vocabulary are broadcast; they do not grow with the data.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path, kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                ids = encoder.encode(rows.column(1).to_pylist())
                yield pa.record_batch([rows.column(0), rows.column(1), pa.array(ids, pa.binary())], names=[id_column, "text", "ids"])

    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias(id_column), F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"`{id_column}` long, text string, ids binary")


def decode(encoded: DataFrame, path: str, result: str = "decoded") -> DataFrame:
    """The rows with the text of their ``ids`` as a further column (null ids give null)."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(path))
    kept = encoded.drop(result)
    at = kept.columns.index("ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text_of = decoder(shared.value)
        for batch in batches:
            texts = [None if x is None else text_of(x) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, result])

    return kept.mapInArrow(run, StructType(list(kept.schema.fields)).add(result, "string"))
