from __future__ import annotations

import collections
import random
import re

import numpy as np

from tallywright.llm import quality, queries
from tallywright.llm.common import word_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_by_hand(text):
    w = WORD.findall(text or "")
    windows = collections.Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    repeated = {k + d for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(repeated), len(lines)


def base_failed(c):
    return c[0] < 50 or 100 * c[4] > 50 * c[0]


def kept_by_hand(rows):
    """Verdicts with thresholds from all values of each group, binned like a sketch."""

    def binned(v):
        return 0.0 if v < quality.LEAST else quality.GAMMA ** np.ceil(round(np.log(v) / np.log(quality.GAMMA), 9)) * 2 / (quality.GAMMA + 1)

    def lend(own, wider):
        total = sum(wider.values())
        return own + collections.Counter({k: int(np.floor(n / total * (quality.BORROWED * quality.UNIT) + 0.5)) for k, n in wider.items()})

    def fence(sketch, margins):
        keys = sorted(sketch)
        up_to = np.cumsum([sketch[k] for k in keys])
        low, high = (keys[int(np.argmax(4 * up_to >= q * up_to[-1]))] for q in (1, 3))
        below, above = margins
        reach = quality.SPREAD * (high - low)
        return -np.inf if below is None else low - max(reach, below), high + max(reach, above)

    counts = [counts_by_hand(t) for t, _, _ in rows]
    values = [{} if base_failed(c) else {"symbols": c[2] / c[0], "dup_lines": c[3] / max(c[5], 1), "repeats": c[4] / c[0], "word_length": c[1] / c[0]} for c in counts]
    limits = {}
    for name, margins in quality.MARGINS.items():
        sketch = lambda fits: collections.Counter({k: quality.UNIT * n for k, n in collections.Counter(binned(v[name]) for r, v in zip(rows, values) if v and fits(r)).items()})  # noqa: E731, B023
        every = sketch(lambda r: True)
        for group in {r[1:] for r, v in zip(rows, values) if v}:
            lang = lend(sketch(lambda r: r[1] == group[0]), every)  # noqa: B023
            own = lend(sketch(lambda r: r[1:] == group), lang)  # noqa: B023
            fences = [fence(x, margins) for x in (own, lang, *([every] if name in quality.SHARES else []))]
            limits[group, name] = max(f[0] for f in fences), min(f[1] for f in fences)
    return [bool(v) and all(limits[r[1:], n][0] <= x <= limits[r[1:], n][1] for n, x in v.items()) for r, v in zip(rows, values)]


def test_whole_table_by_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op6_quality_rules(spark, sf).collect()}
    kept = kept_by_hand([(d.text, d.lang, d.source) for d in docs])
    for d, k in zip(docs, kept):
        c = counts_by_hand(d.text)
        assert tuple(got[d.doc_id])[1:] == (*c[:5], base_failed(c), k)
    assert 0 < sum(kept) < len(kept)


def test_clean_documents_stay_and_junk_goes(spark, sf):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.op6_quality_rules(spark, sf).collect() if r.doc_id in labels and not r.base_failed]
    assert all(r.kept for r in rows if labels[r.doc_id])
    assert not any(r.kept for r in rows if not labels[r.doc_id])


def test_counts_of_odd_texts():
    random.seed(1)
    some = [None, "", " \t\n", "a", "a b c a b c", "x\n\nx\n x\nx", "é#$ ü|", "a " * 500, "\x0b\x0c\x1c\x85 \xa0"]
    some += ["".join(random.choices(["a", "b", " ", "\n", "#", "é", "\t"], k=60)) for _ in range(300)]
    codes = word_codes()
    for text in some:
        data = None if text is None else text.encode()
        assert quality.counts(data, codes(data)) == counts_by_hand(text)


def test_small_groups_borrow_and_nulls_form_a_group(spark):
    random.seed(3)
    word = lambda: "".join(random.choices("abcdefgh", k=random.randint(2, 9)))
    rows = [(" ".join(word() for _ in range(random.randint(50, 90))), random.choice(["en", "de", None]), random.choice(["a", "b", None])) for _ in range(700)]
    rows += [("word# " * 3 + " ".join(word() + "#" for _ in range(80)), "en", "a"), ("w " + "x" * 400, "xx", "new"), (None, None, None), ("", "en", "a")]
    kinds = "text string, lang string, source string, quality int, n_words string"
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], kinds)
    got = quality.judge_quality(docs).collect()
    by_hand = kept_by_hand([(t, x or "", y or "") for t, x, y in rows])
    assert [bool(r.quality.kept) for r in got] == by_hand and {r.n_words for r in got} == {"x"}
    assert not by_hand[700] and all(by_hand[:700])
    assert quality.judge_quality(docs.limit(0)).count() == 0


def test_merged_sketches_equal_the_sketch_of_all(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    measured = quality.measure(docs, ["doc_id", "lang", "source"]).persist()
    one = lambda df: quality.sketches(df, "lang", "source")
    halves = one(measured.where("doc_id % 2 = 0")).unionByName(one(measured.where("doc_id % 2 = 1")))
    merged = halves.groupBy("lang", "source", "measure", "bin").sum("n").collect()
    assert sorted(map(tuple, merged)) == sorted(map(tuple, one(measured).collect()))
    measured.unpersist()


def test_a_source_one_third_junk_does_not_keep_it(spark):
    random.seed(5)
    word = lambda: "".join(random.choices("abcdefgh", k=random.randint(3, 7)))
    text = lambda mark, size=60: " ".join(word() + mark for _ in range(size))
    rows = [(text(""), "en", source) for source in ("a", "b") for _ in range(200)]
    rows += [(text("" if n % 3 else "#$%"), "en", "hot") for n in range(150)]
    rows += [(text("x" * 15), "long", "a") for _ in range(120)]
    rows += [(text("#$%", 20), "en", "a") for _ in range(150)]  # too short: fail the base
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    got = quality.judge_quality(docs).collect()
    assert [r.quality.kept for r in got] == ["#" not in t for t, _, _ in rows]
    counted = quality.sketches(quality.measure(docs, ["lang", "source"]), "lang", "source").where("measure = 'symbols'")
    assert sum(r.n for r in counted.collect()) == len(rows) - 150


def test_one_measure_is_judged_by_what_is_usual_in_a_source(spark):
    random.seed(9)
    text = lambda letters: " ".join("".join(random.choices("abcdefgh", k=letters)) for _ in range(60))
    rows = [(text(4), "en", "chat") for _ in range(400)] + [(text(9), "en", "chemistry") for _ in range(400)]
    rows += [(text(11), "en", "chat"), (text(11), "en", "chemistry"), (text(11), "en", "new")]
    docs = spark.createDataFrame([(*r, n) for n, r in enumerate(rows)], "text string, lang string, source string, n int")
    got = sorted(quality.judge_quality(docs, ["n"]).collect())
    assert [r.quality.kept for r in got] == kept_by_hand(rows)
    assert all(r.quality.kept for r in got[:800]) and [r.quality.kept for r in got[800:]] == [False, True, True]


def test_fences_move_smoothly_with_the_size_of_a_group(spark):
    """No number of documents at which a group is suddenly judged by itself."""
    sketch = [("en", "big", "word_length", b, 1000) for b in range(80, 90)]
    fences = []
    for n in (50, 99, 100, 101, 400, 4000):
        rows = [(*r[:4], r[4] if r[1] == "big" else n) for r in [*sketch, ("en", "own", "word_length", 100, 0)]]
        found = quality.limits(spark.createDataFrame(rows, "lang string, source string, measure string, bin int, n long"))
        fences.append(found.where("source = 'own'").first().word_length_most)
    assert abs(fences[1] - fences[2]) < 0.2 and abs(fences[2] - fences[3]) < 0.2
