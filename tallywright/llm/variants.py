"""Spelling variants: words that differ by one inserted, deleted or replaced code point, grouped under
their frequent forms.

Words that differ by one edit agree in all but one of the pieces that a word is cut into.  So words are
dealt to shards by what lies outside a piece: at first the pieces are the two halves, and a half that
too many words share is cut further, down to single letters.  Words whose keys agree are in the same
shard, for each pair under exactly one key.

A shard keeps its words as one delimited text in a bidirectional FM-index: rank tables of the
Burrows-Wheeler transforms of the text and of its reversal, with one interval in each kept in step, so
a pattern grows at either end.  A search matches one half of a word and its delimiter exactly, goes on
over the other half with one error allowed, and ends at the other delimiter.  Then the interval holds one
suffix that begins with a delimiter, and its rank among these is the number of the word found.  All
words of a shard take a step together.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tallywright.llm.common import parts, saved

#: Runs of letters that words are made of.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Rows of a shard on average, and most words that may share a key before its piece is cut again.
SHARD_ROWS, KEY_WORDS = 8_000, 4_000
#: Distinct words a task counts before it sends them on.
COUNTED_AT_ONCE = 500_000
#: Letters of the words of a shard that take steps together.
LETTERS_AT_ONCE = 60_000

_LOWER = {c: c + 32 for c in range(65, 91)}


def count_words(docs: DataFrame, least_length: int = 1, noise: int | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(word, n) of the letter runs of all texts, A-Z lower-cased, with ``least_length`` code points or more.

    With ``noise``, a run first loses the code point at h % its length where ``noise`` divides h, the
    CRC-32 of ``<id>:<run>``.  Null texts have no words; a null id is an empty one.  Tasks count before
    the shuffle.
    """
    find = re.compile(LETTERS).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, int] = {}
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for word in find(text.translate(_LOWER)) if text else ():
                    if len(word) < least_length:
                        continue
                    if noise is not None:
                        h = zlib.crc32(word.encode(), start)
                        if not h % noise:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least_length:
                                continue
                    totals[word] = totals.get(word, 0) + 1
                if len(totals) >= COUNTED_AT_ONCE:
                    yield counted(totals)
                    totals = {}
        if totals:
            yield counted(totals)

    def counted(totals: dict[str, int]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(totals.keys(), pa.string()), pa.array(totals.values(), pa.int64())], names=["word", "n"])

    source = docs.select(F.col(f"`{id_column}`").cast("string"), F.col(f"`{text_column}`").cast("string"))
    return source.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def piece(length: int, level: int, k: int) -> tuple[int, int]:
    """Where piece k of 2 ** level pieces of a word begins and ends (halves of halves)."""
    low, high = 0, length
    for bit in range(level - 1, -1, -1):
        middle = (low + high) // 2
        low, high = (middle, high) if k >> bit & 1 else (low, middle)
    return low, high


def keys(word: str, length: int, level: int, k: int) -> str:
    """What a word and those near it share if the error lies in piece k of the shorter one's ``length``."""
    low, high = piece(length, level, k)
    return f"{length}.{level}.{k}.{word[:low]}.{word[len(word) - (length - high) :]}"


class Index:
    """Bidirectional FM-index of distinct sorted words.  Letters are numbered in code-point order from
    2; 1 is the delimiter and 0 the end."""

    def __init__(self, words: list[str]):
        points = [np.frombuffer(w.encode("utf-32-le"), "<u4") for w in words]
        self.alphabet, codes = np.unique(np.concatenate(points), return_inverse=True)
        lengths = np.array([len(p) for p in points])
        ends = np.cumsum(lengths + 1)
        text = np.ones(ends[-1] + 1, np.int32)
        inside = np.ones(len(text), bool)
        inside[0] = inside[ends] = False
        text[inside] = codes.ravel() + 2
        self.codes = dict(zip(map(chr, self.alphabet.tolist()), range(2, len(self.alphabet) + 2)))
        self.size = len(self.alphabet) + 2
        self.text = np.append(text, 0)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.text, minlength=self.size))])
        self.ranks = [self._ranks(self.text), self._ranks(np.append(text[::-1], 0))]

    def _ranks(self, text: np.ndarray) -> np.ndarray:
        """[i, c]: letters below c among the first i of the transform."""
        n = len(text)
        at, rank, step = np.arange(n), text.astype(np.int64), 1
        while True:  # suffixes sorted by their first ``step`` letters, doubled each time
            second = np.zeros(n, np.int64)
            second[: n - step] = rank[step:] + 1
            pair = rank * (n + self.size + 1) + second
            at = np.argsort(pair, kind="stable")
            new = np.empty(n, np.int64)
            new[at] = np.concatenate([[0], np.cumsum(np.diff(pair[at]) != 0)])
            if new[at[-1]] == n - 1:
                break
            rank, step = new, 2 * step
        before = text[at - 1]
        table = np.zeros((n + 1, self.size + 1), np.int32)
        table[np.arange(1, n + 1), before + 1] = 1
        np.cumsum(table, 0, out=table)
        return np.cumsum(table, 1, out=table)

    def whole(self, n: int) -> np.ndarray:
        """Intervals of the empty pattern: forward begin, backward begin, size."""
        return np.tile(np.array([[0], [0], [len(self.text)]]), n)

    def extend(self, state: np.ndarray, letters: np.ndarray, right: bool) -> np.ndarray:
        """Intervals of patterns made longer by a letter on the right or on the left."""
        table, (grows, follows) = self.ranks[right], ((1, 0) if right else (0, 1))
        low, high = state[grows], state[grows] + state[2]
        below, until = table[low, letters], table[low, letters + 1]
        lower = table[high, letters] - below
        out = np.empty_like(state)
        out[grows] = self.first[letters] + until - below
        out[follows] = state[follows] + lower
        out[2] = table[high, letters + 1] - until - lower
        return out

    def following(self, state: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """(state, letter) of all letters by which a pattern can grow, delimiters apart."""
        table, low = self.ranks[right], state[1 if right else 0]
        counts = np.diff(table[low + state[2]] - table[low], axis=1)
        counts[:, :2] = 0
        return np.nonzero(counts)


def near_words(index: Index, words: list[str], lows: np.ndarray, highs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(search, number of the word found): words of the index that come from a search's word by replacing
    one letter of its piece low..high, or by inserting one before a letter of the piece (or at the word's
    end, if the piece ends there).  An inserted letter differs from the one that it precedes, so each
    pair is found once only.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    order = np.argsort(lengths, kind="stable")
    for right in (True, False):
        # An error right of the middle: begin with the left delimiter, and the other way round.
        chosen = order[(lows[order] >= lengths[order] // 2) == right]
        at = 0
        while at < len(chosen):  # words of similar length together
            end = min(len(chosen), at + max(1, LETTERS_AT_ONCE // int(lengths[chosen[at]] + 2)))
            while end > at + 1 and (end - at) * int(lengths[chosen[end - 1]] + 2) > 2 * LETTERS_AT_ONCE:
                end = at + (end - at) // 2
            some = chosen[at:end]
            who, number = _searched(index, [words[k] for k in some.tolist()], lengths[some], lows[some], highs[some], right)
            found.append((some[who], number))
            at = end
    return tuple(np.concatenate(x) for x in zip(*found))


def _searched(index: Index, words: list[str], n: np.ndarray, low: np.ndarray, high: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
    letters = np.zeros((len(words), int(n.max()) + 2), np.int64)
    for k, word in enumerate(words):
        letters[k, : len(word) + 2] = [1, *map(index.codes.__getitem__, word), 1]
    # Step s reads column s, or n + 1 - s going left; the piece's letters are read from begin to end.
    begin, end = (low + 1, high + 1) if right else (n - high + 1, n - low + 1)
    last = np.where(high == n, n + 1 if right else 1, -1)  # the step at which a letter may be added to the word's end
    who, state, wrong = np.arange(len(words)), index.whole(len(words)), np.zeros(len(words), bool)
    out = []
    for step in range(int(n.max()) + 2):
        letter = letters[who, step if right else n[who] + 1 - step]
        plain = index.extend(state, letter, right)
        grown = [(who, plain, wrong)]
        inside = ~wrong & (step >= begin[who]) & (step < end[who])
        at_end = ~wrong & (step == last[who])

        def more(source: np.ndarray, states: np.ndarray) -> None:
            grown.append((who[source], states, np.ones(len(source), bool)))

        may = np.flatnonzero(inside | at_end)
        if len(may):
            source, other = index.following(state[:, may], right)
            source = may[source]
            first = index.extend(state[:, source], other, right)
            replaced = inside[source] & (other != letter[source])
            more(source[replaced], first[:, replaced])
            # A letter on the near side of this one: before it going right, at the word's end going left.
            added = at_end[source] | (replaced if right else False)
            more(source[added], index.extend(first[:, added], letter[source[added]], right))
        if not right and len(may := np.flatnonzero(inside & (plain[2] > 0))):
            source, other = index.following(plain[:, may], right)
            source = may[source]
            added = other != letter[source]
            more(source[added], index.extend(plain[:, source[added]], other[added], right))
        who, state, wrong = (np.concatenate(x, -1) for x in zip(*grown))
        done = step == n[who] + 1
        hit = done & wrong & (state[2] > 0)
        out.append((who[hit], state[0, hit] - index.first[1] - 1))
        alive = ~done & (state[2] > 0)
        who, state, wrong = who[alive], state[:, alive], wrong[alive]
        if not len(who):
            break
    return tuple(np.concatenate(x) for x in zip(*out))


def _dealt(level: int, least_length: int):
    """From words, or from rows of keys to cut further, to rows of the next level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, counts = batch.column("word").to_pylist(), batch.column("n").to_pylist()
            if level == 1:
                # A word meets those as long or one longer, and those one shorter.
                work = [(w, n, m, k) for w, n in zip(words, counts) for m in (len(w), len(w) - 1) if m >= least_length for k in (0, 1)]
            else:
                old = zip(words, counts, batch.column("length").to_pylist(), batch.column("piece").to_pylist())
                work = [(w, n, m, k) for w, n, m, p in old for k in (2 * p, 2 * p + 1)]
            for at in range(0, len(work), 50_000):
                word, n, length, k = zip(*work[at : at + 50_000])
                codes = [xxhash.xxh3_64_intdigest(keys(*x)) - 2**63 for x in zip(word, length, [level] * len(word), k)]
                low, high = zip(*(piece(m, level, p) for m, p in zip(length, k)))
                columns = [pa.array(x, pa.int64()) for x in (n, length, k, codes, low, high)]
                yield pa.record_batch([pa.array(word, pa.string()), *columns], names=["word", "n", "length", "piece", "key", "low", "high"])

    return run


_DEALT = "word string, n long, length long, piece long, key long, low long, high long"


def _shards(words: DataFrame, least_length: int) -> DataFrame:
    """Rows of words under keys that few enough words share."""
    rows, level, out = saved(words.mapInArrow(_dealt(1, least_length), _DEALT), "dealt"), 1, None
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.col("high") - F.col("low")).alias("letters"))
        # One key in KEY_WORDS rows at most.
        large = saved(sizes.where((F.col("size") > KEY_WORDS) & (F.col("letters") > 1)).select("key"), "large")
        small = rows.join(F.broadcast(large), "key", "left_anti").select(rows.columns)
        out = small if out is None else out.unionByName(small)
        if large.isEmpty():
            return out
        level += 1
        again = rows.join(F.broadcast(large), "key", "left_semi").select("word", "n", "length", "piece")
        rows = saved(again.mapInArrow(_dealt(level, least_length), _DEALT), "dealt")


def _searches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of the words of one shard, in both directions."""
    tables = [b for b in batches if b.num_rows]
    if not tables:
        return
    shard = pa.Table.from_batches(tables)
    words, n = shard["word"].to_pylist(), shard["n"].to_pylist()
    times = dict(zip(words, n))
    known = sorted(times)
    index = Index(known)
    length, low, high = (shard[name].to_numpy() for name in ("length", "low", "high"))
    own = np.flatnonzero(length == np.array([len(w) for w in words]))
    search, number = near_words(index, [words[k] for k in own.tolist()], low[own], high[own])
    for at in range(0, len(search), 100_000):
        one = [words[k] for k in own[search[at : at + 100_000]].tolist()]
        two = [known[k] for k in number[at : at + 100_000].tolist()]
        # An equally long word finds this one by itself.
        longer = [(b, a) for a, b in zip(one, two) if len(b) > len(a)]
        word, near = zip(*zip(one, two), *longer)
        yield pa.record_batch([pa.array(word), pa.array(near), pa.array([times[w] for w in near], pa.int64())], names=["word", "near", "near_n"])


def near_pairs(words: DataFrame, least_length: int = 6) -> DataFrame:
    """(word, near, near_n) for each word of ``words`` (distinct ``word``, ``n``) and each other one that
    differs by one inserted, deleted or replaced code point.  Words below ``least_length`` code points take
    no part; it must be two or more."""
    if least_length < 2:
        raise ValueError("words need two letters, one for each half")
    rows = saved(_shards(words.where(F.length("word") >= least_length).select("word", "n"), least_length), "keyed")
    shards = parts(words.sparkSession, rows.count(), SHARD_ROWS)
    return rows.repartition(shards, "key").mapInArrow(_searches, "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of words and their forms (word, form): the last form reached.  Forms must not form
    circles.  Each round doubles the steps taken; a round is written to the shared folder."""
    found = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = saved(found.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        found = stepped.select("word", "root")
        if stepped.where("moved").isEmpty():
            return found


def spelling_variants(
    docs: DataFrame,
    least_length: int = 6,
    least_count: int = 5,
    ratio: int = 5,
    noise: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``word``, ``form``, ``root``, ``n``, ``n_near`` and ``form_n`` of every frequent word.

    Words are letter runs (:func:`count_words`) of at least ``least_length`` code points and ``least_count``
    occurrences.  A word's form is its near word of largest count (the first in code-point order of equal
    ones) if that is ``ratio`` times its own or more, else null; its root is where forms lead to in the end,
    the word itself without one.  ``ratio`` must be above 1, so that counts rise from form to form.

    Null and empty texts have no words; repeated rows count as often as they occur; a table without
    words gives no rows.  Other columns are not read.
    """
    if ratio <= 1:
        raise ValueError("a form must be more frequent than its word")
    words = saved(count_words(docs, least_length, noise, id_column, text_column).where(F.col("n") >= least_count), "words")
    best = near_pairs(words, least_length).groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    top = -F.col("best.less")
    judged = words.join(best, "word", "left").select(
        "word",
        F.when(top >= ratio * F.col("n"), F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(top >= ratio * F.col("n"), top).alias("form_n"),
    )
    judged = saved(judged, "forms")
    last = roots(judged.where("form IS NOT NULL"))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


SQL = r"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
    counted AS (
        SELECT run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS code
        FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
    hashed AS (
        SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, [('0x' || code[2 * i - 1 : 2 * i])::BIGINT FOR i IN range(1, len(code) // 2 + 1)]),
            lambda a, b: list_reduce([xor(a, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda s, k: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295::BIGINT) AS h
        FROM counted),
    kept AS (SELECT CASE WHEN h % 199 = 0 THEN run[1 : h % length(run)] || run[h % length(run) + 2 :] ELSE run END AS word, n FROM hashed),
    words AS (SELECT word, sum(n)::BIGINT AS n FROM kept WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
    without AS (SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM words, unnest(range(1, length(word) + 1)) AS t(i)),
    near AS (
        SELECT a.word, b.word AS near, b.n FROM without AS a JOIN without AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM without AS a JOIN words AS b ON a.rest = b.word
        UNION SELECT b.word, a.word, a.n FROM without AS a JOIN words AS b ON a.rest = b.word),
    best AS (SELECT word, count(*) AS n_near, max(n) AS most, first(near ORDER BY n DESC, encode(near)) AS near FROM near GROUP BY word),
    judged AS (
        SELECT word, CASE WHEN most >= 5 * n THEN near END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN most >= 5 * n THEN most END AS form_n
        FROM words LEFT JOIN best USING (word)),
    chain(word, root, steps) AS (
        SELECT word, word, 0 FROM judged
        UNION ALL SELECT chain.word, judged.form, steps + 1 FROM chain JOIN judged ON judged.word = chain.root WHERE judged.form IS NOT NULL),
    last AS (SELECT word, max_by(root, steps) AS root FROM chain GROUP BY word)
    SELECT word, form, root, n, n_near, form_n FROM judged JOIN last USING (word)
"""
