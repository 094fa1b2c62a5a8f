"""Toxicity scores from a learned lexicon, matched with spelling errors and weighed in context.

The lexicon is learned: stems that occur in toxic training documents far more often than in others.
Words meet it in a Levenshtein automaton intersected with the trie of the stems.  The product is
determinised while it is used: a state is the set of (trie node, errors) reached so far, transitions
are remembered, and most words leave the automaton after two or three letters.  Each hit is then
judged by the words around it: inside quotation marks or beside words of reporting it counts as
quoted, beside words of address as aimed at somebody.  A logistic model over these counts gives the
score.

Errors are only forgiven where that is safe: a misspelling that turns up in other training documents
too (because a common word begins that way) is exempt, the stem's other misspellings count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Mapping, Set

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from tallywright.llm.common import Memo

#: Labelled documents of each class that the lexicon and the model are fitted on, at most.
FIT_ROWS = 10_000
#: A stem needs so many toxic documents and so many times the share of the others; at most so many stems.
LEAST_DOCS, LIFT, MOST_STEMS = 5, 20.0, 2_000
#: Errors are forgiven for stems of this share of the toxic documents and more.
TERM_SHARE = 0.03
#: A root that is also found in other words needs this lift by documents, and this share of the toxic ones.
ROOT_LIFT, ROOT_SHARE = 4.0, 0.03
STEM_LETTERS = (4, 12)
#: Words on each side of a hit that tell quotation from abuse, and the longest quotation in words.
CONTEXT, QUOTE_WORDS = 6, 60
#: Determinised states a task keeps before it starts afresh.
MOST_STATES = 50_000

# Words of reporting and of address, and quotation marks.
REPORTING = "said says wrote writes called calls quoted quote quoting reported word words term sagte sagt schrieb nannte wort zitat dit écrit appelle mot citation dijo dice escribió llamó palabra cita".split()
ADDRESS = "you your yours you're u du dich dir dein euch ihr tu te toi vous votre ton tú ti usted ustedes vosotros".split()
OPENING, CLOSING = "\"“„«‘‹", "\"”“»’›"
_STRIP = "\"“”„«»‘’‹›'`.,;:!?()[]{}<>*_~#$%&|-–—…¡¿/\\"

_EXACT, _CLOSE, _REPORTS, _ADDRESSES, _OPENS, _CLOSES = (1 << k for k in range(6))
FEATURES = ("hits", "close", "quoted", "aimed", "density")
#: A misspelled hit counts as this part of an exact one until the documents tell otherwise.
CLOSE_PART = 0.5
#: Stems of this length may have one letter replaced, longer ones errors of any kind.
SHORT_STEM = 4


def errors_allowed(stem: str) -> int:
    """Short stems must match exactly; long ones may have two errors."""
    return 0 if len(stem) < 5 else 1 if len(stem) < 9 else 2


class Automaton:
    """Tells whether a word begins with a stem, up to the stem's number of errors."""

    def __init__(self, stems: Mapping[str, int]):
        self.children: list[dict[str, int]] = [{}]
        self.allowed, self.ends = [0], [-1]  # most errors below a node; errors allowed if a stem ends here
        self.names = [""]
        for stem, most in stems.items():
            node = 0
            self.allowed[0] = max(self.allowed[0], most)
            for letter in stem:
                after = self.children[node].get(letter)
                if after is None:
                    after = self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.allowed.append(0)
                    self.ends.append(-1)
                    self.names.append("")
                node = after
                self.allowed[node] = max(self.allowed[node], most)
            self.ends[node], self.names[node] = most, stem
        self._fresh()

    def _fresh(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.hits_of: list[tuple[int, str]] = []  # fewest errors with which a stem is complete in a state, or -1
        self.steps: list[dict[str, int]] = []
        self.start = self._state({(0, 0)})

    def _state(self, reached: set[tuple[int, int]]) -> int:
        """The number of the state with these positions and those that skip letters of a stem."""
        best: dict[int, int] = {}
        open_ = list(reached)
        while open_:
            node, errors = open_.pop()
            if errors > self.allowed[node] or best.get(node, 99) <= errors:
                continue
            best[node] = errors
            open_.extend((child, errors + 1) for child in self.children[node].values())
        key = frozenset(best.items())
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.states)
            self.states.append(key)
            self.steps.append({})
            self.hits_of.append(min(((e, self.names[n]) for n, e in key if e <= self.ends[n]), default=(-1, "")))
        return number

    def _step(self, state: int, letter: str) -> int:
        reached = set()
        for node, errors in self.states[state]:
            reached.add((node, errors + 1))  # a letter too many
            for own, child in self.children[node].items():
                reached.add((child, errors + (own != letter)))
        after = self.steps[state][letter] = self._state(reached)
        return after

    def errors(self, word: str) -> int:
        """The fewest errors of a stem at the word's beginning, -1 without one."""
        return self.match(word)[0]

    def match(self, word: str) -> tuple[int, str]:
        """The fewest errors and the stem."""
        if len(self.states) > MOST_STATES:
            self._fresh()
        state, found = self.start, (-1, "")
        for letter in word:
            after = self.steps[state].get(letter)
            state = self._step(state, letter) if after is None else after
            if not self.states[state]:
                break
            hit = self.hits_of[state]
            if hit[0] == 0:
                return hit
            if hit[0] > 0 and (found[0] < 0 or hit < found):
                found = hit
        return found


    def hits(self, word: str, exempt: Set[str] = frozenset()) -> Iterator[tuple[int, str, str]]:
        """(errors, stem, beginning of the word that comes near it) of each beginning, up to an exact one.  After
        an exempt beginning only an exact one counts."""
        if len(self.states) > MOST_STATES:
            self._fresh()
        state, forgiving = self.start, True
        for at, letter in enumerate(word, 1):
            after = self.steps[state].get(letter)
            state = self._step(state, letter) if after is None else after
            if not self.states[state]:
                return
            errors, stem = self.hits_of[state]
            forgiving = forgiving and word[:at] not in exempt
            if errors == 0 or (errors > 0 and forgiving):
                yield errors, stem, word[:at]
            if errors == 0:
                return


def short_stems(stems: Iterable[str]) -> Callable[[str], str]:
    """A function that gives the short stem that a word's beginning makes with one letter replaced, or ''."""
    patterns = {(k, s[:k], s[k + 1 :]): s for s in sorted(stems) if len(s) == SHORT_STEM for k in range(SHORT_STEM)}

    def look(begin: str) -> str:
        return next((s for k in range(SHORT_STEM) if (s := patterns.get((k, begin[:k], begin[k + 1 :])))), "") if len(begin) == SHORT_STEM else ""

    return Memo(look).__getitem__ if patterns else lambda begin: ""


def near_stem(automaton: Automaton, short: Callable[[str], str], word: str, exempt: Set[str] = frozenset()) -> tuple[int, str, str]:
    """The fewest errors, the stem and the word's beginning that comes near it; -1 errors without one."""
    errors, stem = automaton.match(word)
    if errors == 0:
        return 0, stem, word
    if errors > 0 and (best := min(automaton.hits(word, exempt), default=None)):
        return best
    begin = word[:SHORT_STEM]
    if (stem := short(begin)) and begin not in exempt:
        return 1, stem, begin
    return -1, "", ""


def plain(token: str) -> str:
    return token.strip(_STRIP).lower()


def features(stems: Mapping[str, int], exempt: Set[str] = frozenset()) -> Callable[[str | None], tuple[float, ...]]:
    """A function from a text to its FEATURES."""
    automaton, short, reporting, address = Automaton(stems), short_stems(stems), set(REPORTING), set(ADDRESS)

    def look(token: str) -> int:
        word = plain(token)
        errors = near_stem(automaton, short, word, exempt)[0] if word else -1
        code = _EXACT if errors == 0 else _CLOSE if errors > 0 else 0
        code |= _REPORTS * (word in reporting) | _ADDRESSES * (word in address)
        return code | _OPENS * (token[0] in OPENING) | _CLOSES * (token.rstrip(".,;:!?")[-1:] in tuple(CLOSING))

    codes_of = Memo(look).__getitem__

    def of(text: str | None) -> tuple[float, ...]:
        tokens = text.split() if text else ()
        codes = np.fromiter(map(codes_of, tokens), np.uint8, len(tokens))
        hits = np.flatnonzero(codes & (_EXACT | _CLOSE))
        if not len(hits):
            return (0.0,) * len(FEATURES)
        inside = _quoted(codes)
        exact = close = quoted = aimed = 0
        for at in hits.tolist():
            around = codes[max(0, at - CONTEXT) : at + CONTEXT + 1]
            if inside[at] or (around & _REPORTS).any():
                quoted += 1
                continue
            aimed += bool((around & _ADDRESSES).any())
            if codes[at] & _EXACT:
                exact += 1
            else:
                close += 1
        return (math.log1p(exact + CLOSE_PART * close), math.log1p(close), math.log1p(quoted), math.log1p(aimed), min(1.0, 10 * (exact + close) / len(tokens)))

    return of


def _quoted(codes: np.ndarray) -> np.ndarray:
    """Words between an opening mark and the next closing one, if that comes soon enough."""
    inside = np.zeros(len(codes), bool)
    closes = np.flatnonzero(codes & _CLOSES)
    until = -1
    for at in np.flatnonzero(codes & _OPENS).tolist():
        if at <= until:
            continue
        k = np.searchsorted(closes, at)
        if k < len(closes) and closes[k] - at < QUOTE_WORDS:
            until = int(closes[k])
            inside[at : until + 1] = True
    return inside


def learn_stems(labelled: DataFrame, text_column: str = "text") -> dict[str, float]:
    """Stems of toxic documents and their share of these, from a bounded frame with a column ``toxic``.

    Documents are counted per word beginning in Spark; only beginnings that pass the thresholds, at
    most ten times MOST_STEMS of them, reach the driver.
    """
    least, most = STEM_LETTERS
    row = labelled.select("toxic", F.monotonically_increasing_id().alias("row"), F.lower(F.col(f"`{text_column}`")).alias("text"))
    words = row.select("toxic", "row", F.explode(F.regexp_extract_all("text", F.lit(r"(\p{L}+)"))).alias("word")).where(F.length("word") >= least)
    words = words.groupBy("toxic", "row", "word").agg(F.count("*").alias("n")).persist()
    try:
        sizes = {r.toxic: r.n for r in words.groupBy("toxic").agg(F.sum("n").alias("n")).collect()}
        if not sizes.get(1) or not sizes.get(0):
            return {}
        docs = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        begins = words.select("toxic", "row", "n", F.explode(F.transform(F.sequence(F.lit(least), F.least(F.length("word"), F.lit(most))), lambda k: F.substr("word", F.lit(1), k))).alias("stem"))
        in_docs = begins.groupBy("stem", "toxic", "row").agg(F.sum("n").alias("n"))
        told = lambda kind, value: F.sum(F.when(F.col("toxic") == kind, value).otherwise(0))
        counted = in_docs.groupBy("stem").agg(
            *[told(kind, F.lit(1)).alias(name) for kind, name in ((1, "docs"), (0, "other_docs"))],
            *[told(kind, F.col("n")).alias(name) for kind, name in ((1, "toxic"), (0, "other"))],
        )
        by_docs = (F.col("docs") / docs[1]) / ((F.col("other_docs") + 0.5) / docs[0])
        by_occurrences = (F.col("toxic") / sizes[1]) / ((F.col("other") + 0.5) / sizes[0])
        # A root that common words share is told by being repeated where it is abuse, in many documents.
        root = (by_occurrences >= LIFT) & (by_docs >= ROOT_LIFT) & (F.col("docs") >= ROOT_SHARE * docs[1])
        passed = counted.where((F.col("docs") >= LEAST_DOCS) & ((by_docs >= LIFT) | root)).orderBy(F.desc("docs"), "stem").limit(10 * MOST_STEMS)
        found = {r.stem: r.docs for r in passed.select("stem", "docs").collect()}
        return {stem: found[stem] / docs[1] for stem in choose_stems(found)}
    finally:
        words.unpersist()


def choose_stems(found: dict[str, int]) -> list[str]:
    """The shortest stems, each drawn out while nearly the same documents have it."""
    chosen: set[str] = set()
    following: dict[str, list[str]] = {}
    for stem in found:
        following.setdefault(stem[:-1], []).append(stem)
    for stem in sorted(found, key=lambda s: (len(s), s)):
        if any(stem[:k] in found for k in range(STEM_LETTERS[0], len(stem))):
            continue
        docs = found[stem]
        while longer := [s for s in following.get(stem, ()) if found[s] >= 0.9 * docs]:
            stem = max(longer, key=lambda s: (found[s], s))
        chosen.add(stem)
    return sorted(sorted(chosen, key=lambda s: (-found[s], s))[:MOST_STEMS])


def exempt_beginnings(labelled: DataFrame, stems: Mapping[str, int], text_column: str = "text") -> frozenset[str]:
    """Beginnings of words that come near a stem but occur in other documents too: all that do not occur LIFT times
    as often in toxic ones.  They come from the bounded sample and are misspellings of the stems, which
    bounds what reaches the driver."""
    shared = labelled.sparkSession.sparkContext.broadcast(dict(stems))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, short = Automaton(shared.value), short_stems(shared.value)

        def look(token: str) -> tuple[str, ...]:
            word = plain(token)
            errors, _, begin = near_stem(automaton, short, word)
            return () if errors <= 0 else tuple({begin, *(begin for _, _, begin in automaton.hits(word))})

        met = Memo(look)
        for batch in batches:
            found = [(kind, begin) for kind, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for begin in {b for t in set(text.split() if text else ()) for b in met[t]}]
            kinds, begins = zip(*found) if found else ((), ())
            yield pa.record_batch([pa.array(kinds, pa.int32()), pa.array(begins, pa.string())], names=["toxic", "begin"])

    sizes = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    near = labelled.select("toxic", F.col(f"`{text_column}`").alias("text")).mapInArrow(run, "toxic int, begin string")
    counted = near.groupBy("begin").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("other"))
    rare = F.col("toxic") / sizes.get(1, 1) < LIFT * F.col("other") / sizes.get(0, 1)
    return frozenset(r.begin for r in counted.where((F.col("other") > 0) & rare).select("begin").collect())


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, weights: np.ndarray | None = None) -> list[float]:
    """Weights of a logistic model, intercept first, by Newton steps; rows count as often as ``weights`` say."""
    times = np.ones(len(y)) if weights is None else weights
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    keep = np.r_[0.01, np.full(x.shape[1] - 1, ridge)]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        step = np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + np.diag(keep), x.T @ (times * (y - p)) - keep * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def held_out(id_column: str, folds: int = 5):
    """Rows that are never learned from; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % folds == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", fit_rows: int = FIT_ROWS
) -> tuple[dict[str, int], frozenset[str], list[float]]:
    """(stems with their errors, exempt beginnings, weights) from at most ``fit_rows`` labelled documents of each
    class, those with the smallest hashes of their ids, outside the held-out fold.

    A class of which only a part is taken counts as much as all of it, so scores do not depend on the bound.
    Labels other than 0 and 1 are left out; several rows of a label are one, and of several rows of an
    id one is taken.  Without documents of both classes there are no stems and the weights are the
    intercept of their share."""
    known = labels.select(F.col(f"`{id_column}`").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("toxic IN (0, 1) AND id IS NOT NULL")
    known = known.where(~held_out("id")).distinct()
    first = [known.where(F.col("toxic") == kind).orderBy(F.xxhash64("id"), "id").limit(fit_rows) for kind in (0, 1)]  # the first of each task, then of all
    chosen = first[0].unionByName(first[1]).persist()
    totals = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic").persist()
    try:
        # A stem of a few documents, as the odd words of one that was copied, says nothing about its misspellings.
        stems = {stem: errors_allowed(stem) if share >= TERM_SHARE else 0 for stem, share in learn_stems(sample).items()}
        exempt = exempt_beginnings(sample, stems)
        rows = np.array([[r.toxic, *(r.features[f] for f in FEATURES)] for r in with_features(sample, ["toxic"], stems, exempt=exempt).collect()])
        taken = {r.toxic: r.n for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    finally:
        sample.unpersist()
        chosen.unpersist()
    if not len(rows) or len(set(rows[:, 0])) < 2:
        return {}, frozenset(), [35.0 if len(rows) and rows[0, 0] else -35.0] + [0.0] * len(FEATURES)
    rows = rows[np.lexsort(rows.T)]  # whatever the order in which they came
    weights = np.array([totals[k] / taken[k] for k in rows[:, 0].astype(int)])
    return stems, exempt, fit(rows[:, 1:], rows[:, 0], weights=weights)


def with_features(
    docs: DataFrame, carry: list[str], stems: Mapping[str, int], text_column: str = "text", result: str = "features", exempt: Set[str] = frozenset()
) -> DataFrame:
    """The columns ``carry`` and a struct of FEATURES of every row; null texts are empty."""
    shared = docs.sparkSession.sparkContext.broadcast((dict(stems), frozenset(exempt)))
    kept = docs.select(*[F.col(f"`{c}`") for c in carry if c != result], F.col(f"`{text_column}`").cast("string").alias("__text"))
    kind = StructType()
    for name in FEATURES:
        kind.add(name, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = features(*shared.value)
        for batch in batches:
            rows = [of(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [pa.array(c, pa.float64()) for c in zip(*rows)] or [pa.array([], pa.float64())] * len(FEATURES)
            struct = pa.StructArray.from_arrays(columns, names=list(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], names=[*batch.schema.names[:-1], result])

    return kept.mapInArrow(run, StructType(kept.schema.fields[:-1]).add(result, kind))


def score(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``held_out``, ``score``, ``predicted`` and ``features`` of every row.

    Empty and null texts have no hits and get the model's score for that.  Repeated rows are scored
    alike; a null id is not held out and has no label.  Several labels of an id all count.  Other
    columns are not read.
    """
    stems, exempt, weights = train(docs, labels, id_column, text_column)
    scored = with_features(docs, [id_column], stems, text_column, exempt=exempt)
    linear = F.lit(weights[0])
    for name, weight in zip(FEATURES, weights[1:]):
        linear = linear + F.col(f"features.{name}") * weight
    value = 1 / (1 + F.exp(-linear))
    return scored.select(id_column, held_out(id_column).alias("held_out"), value.alias("score"), (value >= 0.5).cast("int").alias("predicted"), "features")
