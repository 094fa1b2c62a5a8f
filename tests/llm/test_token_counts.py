from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallywright.llm import queries, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def count():
    vocabulary = token_counts.Vocabulary(PATH)
    return token_counts.counter(vocabulary, token_counts.whole_tokens(vocabulary))


def test_whole_table_like_the_library(spark, sf, texts, library):
    got = queries.op4_token_counts(spark, sf).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 512)


def test_every_character(count, library):
    for low in range(0, 0x110000, 0x4000):
        some = ["x%cy %c%c1" % (k, k, k) for k in range(low, low + 0x4000) if not 0xD800 <= k < 0xE000]
        assert [count(t) for t in some] == [len(e.ids) for e in library.encode_batch(some, add_special_tokens=False)]


def test_white_space_and_special_strings(count, library):
    random.seed(5)
    parts = ["a", " ", "  ", "\n", " \n", "\t", "b.", "'s", "\xa0", "1", "é", "<|endoftext|>", "!", "\x1d"]
    some = ["".join(random.choices(parts, k=random.randint(1, 14))) for _ in range(5000)]
    some += ["a" * 5000, "=-" * 3000, " " * 900 + "x", "<|endoftext|>" * 3, "\x00"]
    assert [count(t) for t in some] == [len(library.encode(t, add_special_tokens=False).ids) for t in some]


def test_proven_strings_are_one_token(library):
    proven = token_counts.whole_tokens(token_counts.Vocabulary(PATH))
    assert len(proven) > 49_000
    assert all(len(library.encode(p).ids) == 1 for p in random.Random(1).sample(proven, 3000))


def test_nulls_repeats_and_empty_tables(spark, frame):
    rows = [(1, None), (1, None), (2, ""), (None, "a b"), (3, "word " * 600)]
    got = sorted(map(tuple, token_counts.count_tokens(frame(rows), PATH).collect()), key=repr)
    assert got == sorted([(1, 0, 0, False), (1, 0, 0, False), (2, 0, 0, False), (None, 3, 2, False), (3, 3000, 601, True)], key=repr)
    assert token_counts.count_tokens(frame([]), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        token_counts.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
