from __future__ import annotations

import random
import zlib

from tallywright.llm import queries, toxicity


def distance_to_beginning(stem, word):
    row = list(range(len(word) + 1))
    for i, c in enumerate(stem, 1):
        new = [i]
        for j, x in enumerate(word, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (c != x)))
        row = new
    return min(row)


def test_automaton_by_brute_force(monkeypatch):
    monkeypatch.setattr(toxicity, "MOST_STATES", 300)
    random.seed(1)
    stems = {s: toxicity.errors_allowed(s) for s in ("abcde", "abcd", "badcafe", "cabbageabc", "ddddd", "fade")} | {"gaga": 1}
    automaton = toxicity.Automaton(stems)
    for _ in range(20_000):
        word = "".join(random.choices("abcdefg", k=random.randint(1, 12)))
        if random.random() < 0.5:
            word = "".join(c for c in random.choice([*stems]) if random.random() < 0.9) + random.choice(["", "x", "abc"])
        if word:
            errors = [(distance_to_beginning(s, word), n) for s, n in stems.items()]
            assert automaton.errors(word) == min((e for e, n in errors if e <= n), default=-1)


def test_held_out_documents(spark, sf):
    folder = sf.replace("sf0.001", "sf0.01")
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    got = queries.op7_toxicity(spark, folder).collect()
    assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert sum(b for a, b in held if a) >= 0.6 * sum(a for a, _ in held)


def documents(spark):
    random.seed(4)
    word = lambda: "".join(random.choices("aeioutnrs", k=random.randint(2, 8)))
    rows, labels = [], []
    for doc in range(400):
        words = [word() for _ in range(40)]
        toxic = doc % 4 == 0
        if toxic:
            for at in random.sample(range(40), 4):
                words[at] = random.choice(["wretchful", "blockhead", "numbskull"])
        elif doc % 4 == 1:
            words[5:8] = ["said", '"blockhead"', "yesterday"]
        rows.append((doc, " ".join(words)))
        labels.append((doc, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_misspelled_abuse_is_caught_and_quotation_is_not(spark, frame):
    rows, labels = documents(spark)
    rest = "ten rota nisan tea " * 6
    more = [(1000, f"you wretchfull blokhead {rest} numbskul wrechful blockhed"), (1001, f'{rest} "blockhead" said he {rest}'), (1002, None), (1003, ""), (1002, None), (None, rest)]
    scored = toxicity.score(frame(rows + more), labels)
    got = {r.doc_id: r for r in scored.collect()}
    assert len(got) + 1 == scored.count()
    assert got[1000].predicted == 1 and got[1001].predicted == 0
    assert got[1002].score == got[1003].score < 0.5 and not got[None].held_out
    assert sum(got[d].predicted != (d % 4 == 0) for d in range(400)) <= 4


def test_labels_of_the_held_out_fold_are_never_learned(spark, frame):
    rows, labels = documents(spark)
    fold = [d for d, _ in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    turned = labels.selectExpr("doc_id", f"IF(doc_id IN ({','.join(map(str, fold))}), 1 - toxic, toxic) AS toxic")
    assert toxicity.train(frame(rows), labels) == toxicity.train(frame(rows), turned)


def test_without_labels_or_documents(spark, frame):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    (only,) = toxicity.score(frame([(1, "idiot")]), none).collect()
    assert only.predicted == 0
    assert toxicity.score(frame([]), none).count() == 0


def test_quotations():
    of = toxicity.features({"idiot": 0})
    assert of("the idiot left")[0] > 0
    assert of('he wrote the "idiot" left')[0] == 0 and of("an “utter idiot here” left")[2] > 0
    assert of("you are an idiot")[3] > 0 and of(None) == of("") == (0.0,) * 5


def test_hits_of_beginnings_by_brute_force():
    random.seed(2)
    stems = {"abcde": 1, "badcafe": 1, "gabbagebc": 2, "face": 0, "dead": 0}
    automaton, short = toxicity.Automaton(stems), toxicity.short_stems(stems)
    for _ in range(5000):
        word = "".join(random.choices("abcdefg", k=random.randint(1, 11)))
        if random.random() < 0.6:
            word = "".join(c for c in random.choice([*stems]) if random.random() < 0.9) + random.choice(["", "g", "abc"])
        distances = [(distance_to_beginning(s, word), n) for s, n in stems.items()] if word else []
        want = min((e for e, n in distances if e <= n), default=-1)
        if want < 0 and any(sum(a != b for a, b in zip(s, word[:4])) == 1 for s in ("face", "dead") if len(word) >= 4):
            want = 1
        assert toxicity.near_stem(automaton, short, word)[0] == want


def test_exempt_beginnings_spare_only_themselves(spark):
    """A clean word that begins like a misspelled stem switches off that misspelling, not the others."""
    clean = [(f"oronal tea {k}", 0) for k in range(40)] + [("loses all", 0)] * 3
    toxic = [(f"you moron loser scum {k}", 1) for k in range(30)] + [("m0ron", 1)]
    sample = spark.createDataFrame(clean + toxic, "text string, toxic int")
    stems = {s: toxicity.errors_allowed(s) for s in ("moron", "loser", "scum")}
    exempt = toxicity.exempt_beginnings(sample, stems)
    assert {"oron", "lose"} <= exempt and not exempt & {"m0ron", "moro", "mor0n", "l0ser"}
    automaton, short = toxicity.Automaton(stems), toxicity.short_stems(stems)
    near = {w: toxicity.near_stem(automaton, short, w, exempt)[1] for w in "m0ron mor0n l0ser scvm scum! oronal loses moron loser seum cum".split()}
    assert near == {"m0ron": "moron", "mor0n": "moron", "l0ser": "loser", "scvm": "scum", "scum!": "scum", "oronal": "", "loses": "", "moron": "moron", "loser": "loser", "seum": "scum", "cum": ""}


def test_roots_are_learned_by_their_occurrences(spark):
    """A root shared with common words: in every fifth clean document once, in toxic ones again and again."""
    random.seed(5)
    ends = ["ab", "cd", "ef", "gh", "ij", "kl", "mn", "op"]
    word = lambda: "".join(random.choices("aeioutnrs", k=random.randint(3, 8)))
    filler = lambda: [word() for _ in range(60)]
    toxic = [(" ".join(filler() + [f"vrukl{random.choice(ends)}" for _ in range(8)]), 1) for _ in range(60)]
    clean = [(" ".join(filler() + [f"vrukl{random.choice(ends)}"] * (k % 6 == 0)), 0) for k in range(240)]
    stems = toxicity.learn_stems(spark.createDataFrame(toxic + clean, "text string, toxic int"))
    assert "vrukl" in stems and not any(s.startswith("vrukl") and s != "vrukl" for s in stems)


def test_scores_do_not_depend_on_the_bound_of_the_sample(spark, frame):
    rows, labels = documents(spark)
    docs = frame(rows)
    *_, whole = toxicity.train(docs, labels)
    *_, part = toxicity.train(docs, labels, fit_rows=100)  # all toxic ones, a third of the others
    assert abs(whole[0] - part[0]) < 1.2


def test_repeated_documents_and_labels_of_an_id_are_one(spark, frame):
    rows, labels = documents(spark)
    assert toxicity.train(frame(rows * 3), labels.unionByName(labels)) == toxicity.train(frame(rows), labels)


def test_scores_by_hand(spark, frame):
    """The score of every row from the trained parts, with features counted anew."""
    import math

    rows, labels = documents(spark)
    rows = rows + [(1000, "blockhead said blokhead you numbskul! wretchfu"), (1001, 'a "wretchful blockhead" of numbskull rite')]
    stems, exempt, weights = toxicity.train(frame(rows), labels)
    got = {r.doc_id: r.score for r in toxicity.score(frame(rows), labels).collect()}
    automaton, short = toxicity.Automaton(stems), toxicity.short_stems(stems)
    for doc, text in rows:
        tokens = text.split()
        words = [t.strip(toxicity._STRIP).lower() for t in tokens]
        quote, inside = False, []
        for t in tokens:
            opens, closes = t[0] in toxicity.OPENING and not quote, t.rstrip(".,;:!?")[-1:] in tuple(toxicity.CLOSING)
            quote = quote or opens
            inside.append(quote)
            quote = quote and not closes
        exact = close = quoted = aimed = 0
        for at, word in enumerate(words):
            errors = toxicity.near_stem(automaton, short, word, exempt)[0] if word else -1
            if errors < 0:
                continue
            around = words[max(0, at - 6) : at + 7]
            if inside[at] or set(around) & set(toxicity.REPORTING):
                quoted += 1
                continue
            aimed += bool(set(around) & set(toxicity.ADDRESS))
            exact, close = exact + (errors == 0), close + (errors > 0)
        x = (math.log1p(exact + 0.5 * close), math.log1p(close), math.log1p(quoted), math.log1p(aimed), min(1.0, 10 * (exact + close) / len(tokens)))
        assert abs(got[doc] - 1 / (1 + math.exp(-weights[0] - sum(w * v for w, v in zip(weights[1:], x))))) < 1e-9
