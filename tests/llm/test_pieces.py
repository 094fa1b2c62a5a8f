from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from tallywright.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def parts():
    return pieces.load(PATH)


def ids(encoded):
    return [np.frombuffer(x, "<u4").tolist() for x in encoded]


def test_whole_table_like_the_library(spark, sf, texts, library):
    got = queries.op9_sentencepiece(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        want = np.array(library.encode(texts[r.doc_id]), "<u4")
        assert (r.n_bytes, r.n_ids, r.ids_crc32, r.round_trip) == (len(texts[r.doc_id].encode()), len(want), zlib.crc32(want.tobytes()), True)


def test_random_texts_like_the_library(library, parts):
    random.seed(3)
    known = list(parts["ids"])
    some = ["", "a", " ", "  ", "x" * 300, "▁▁ a", " " * 100 + "b", "\n\n\t", "你好世界 日本語", "👍🏽 é è", "<0x0A> <s> </s> <unk>", "aaaa aaa aaaaaaaa", "-----====####", "0" * 50, "word " * 2000]
    some += ["".join(random.choices(known, k=random.randint(1, 6))).replace("▁", " ") for _ in range(3000)]
    some += ["".join(random.choices("ab▁ abnio-=.\n", k=random.randint(1, 40))) for _ in range(1500)]
    encoder, text_of = pieces.Encoder(parts), pieces.decoder(parts)
    encoded = encoder.encode(some)
    want = [library.encode(t) for t in some]
    assert ids(encoded) == want
    assert [text_of(e) for e in encoded] == [library.decode(w) for w in want]
    assert [text_of(e) for e in encoded] == [t.replace("▁", " ") for t in some]


def test_bytes_that_form_no_character(library, parts):
    text_of = pieces.decoder(parts)
    for broken in ([3 + 0xE4, 3 + 0xBD], [3 + 0xFF, 3 + 0x41], [3 + 0xE4, 260, 3 + 0x80], [1, 300, 2]):
        assert text_of(np.array(broken, "<u4").tobytes()) == library.decode(broken)


def test_unigram_models_by_brute_force():
    random.seed(9)
    letters = "▁ab"
    known = ["<unk>", *letters] + ["".join(random.choices(letters[1:], k=n)) for n in (2, 2, 3, 3, 4)] + ["▁a", "▁ba"]
    known = list(dict.fromkeys(known))
    scores = [0.0] + [-random.uniform(1, 9) for _ in known[1:]]
    parts = pieces.describe(known, scores, [False] + [True] * (len(known) - 1), {}, 0, "unigram")
    encoder, score = pieces.Encoder(parts), dict(zip(known, scores))

    def best(text):
        found = (-np.inf, None)
        for cuts in itertools.product((0, 1), repeat=len(text) - 1):
            ends = [k + 1 for k, c in enumerate(cuts) if c] + [len(text)]
            way = [text[a:b] for a, b in zip([0, *ends], ends)]
            if all(p in score for p in way):
                found = max(found, (sum(score[p] for p in way), way))
        return found[0]

    some = ["".join(random.choices("ab ", k=random.randint(1, 9))) for _ in range(300)]
    for text, got in zip(some, ids(encoder.encode(some))):
        assert "".join(known[k] for k in got) == "▁" + text.replace(" ", "▁")
        assert sum(scores[k] for k in got) == pytest.approx(best("▁" + text.replace(" ", "▁")))
    assert ids(encoder.encode(["aéa"]))[0].count(0) == 1


def test_nulls_repeats_and_empty_tables(spark, frame, library):
    rows = [(1, None), (1, None), (2, ""), (None, "a b"), (3, "Wörter")]
    got = pieces.decode(pieces.encode(frame(rows), PATH), PATH).collect()
    assert sorted((repr(r.doc_id), np.frombuffer(r.ids, "<u4").tolist(), r.decoded) for r in got) == sorted((repr(i), library.encode(t or ""), t or "") for i, t in rows)
    assert pieces.encode(frame([]), PATH).count() == 0


def test_a_vocabulary_out_of_order_is_refused():
    with pytest.raises(ValueError, match="own parts"):
        pieces.describe(["<unk>", "a", "b", "ab", "abab"], [0, -1, -2, -9, -3], [False, True, True, True, True], {}, 0, "bpe")
