from __future__ import annotations

import collections
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallywright.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def whole(pieces, length):
    """Ids per document, checked to lie once in gapless sequences of which only the last is short."""
    docs, rows = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        docs[p.doc_id].append((p.start, p.ids))
        rows[p.sequence_id].append((p.offset, p.length))
        assert len(p.ids) == 4 * p.length
    sizes = []
    for number in sorted(rows):
        at = 0
        for offset, n in sorted(rows[number]):
            assert offset == at
            at += n
        sizes.append(at)
    assert sorted(rows) == list(range(len(rows))) and all(n == length for n in sizes[:-1]) and all(n <= length for n in sizes)
    return {d: np.frombuffer(b"".join(i for _, i in sorted(v)), "<u4").tolist() for d, v in docs.items()}


def test_whole_table_round_trip(spark, sf, texts, library):
    pieces = packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), PATH).collect()
    got = whole(pieces, 2048)
    assert got == {d: [*library.encode(t, add_special_tokens=False).ids, 1] for d, t in texts.items()}
    rows = {(r.doc_id, r.start): r for r in queries.op8_packing(spark, sf).collect()}
    assert len(rows) == len(pieces)
    for p in pieces:
        r = rows[p.doc_id, p.start]
        assert (r.length, r.ids_crc32, r.doc_tokens, r.sequence_id, r.offset) == (p.length, zlib.crc32(p.ids), len(got[p.doc_id]), p.sequence_id, p.offset)


def test_ids_of_odd_texts_like_the_library(library):
    encoder = packing.Encoder(PATH)
    encode = packing.encode_with(encoder.ranks, encoder.special, "<u4")
    random.seed(6)
    parts = ["a", " ", "\n", "b.", "'s", "\xa0", "1", "é", "<|endoftext|>", "!", "\x1d", "你", "👍", "ing", "The"]
    some = ["".join(random.choices(parts, k=random.randint(1, 20))) for _ in range(3000)]
    assert [encode(t).tolist() for t in some] == [e.ids for e in library.encode_batch(some, add_special_tokens=False)]


def mixed_documents(spark):
    random.seed(7)
    rows = [(k, "word " * random.randint(1, 60), random.choice("aaaab") if k % 10 else "c") for k in range(3000)]
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, source string, offset int, ids string")


@pytest.mark.parametrize("weights", [None, {"a": 2.0, "b": 1.0, "c": 1.0}])
def test_the_stream_keeps_its_mixture(spark, weights):
    pieces = packing.pack(mixed_documents(spark), PATH, length=256, weights=weights).collect()
    whole(pieces, 256)
    total = collections.Counter()
    for p in pieces:
        total[p.source] += p.length
    share = {s: (weights[s] / 4 if weights else total[s] / sum(total.values())) for s in total}
    ordered = sorted(pieces, key=lambda p: (p.sequence_id, p.offset))
    seen, served = 0, collections.Counter()
    for p in ordered:
        seen += p.length
        served[p.source] += p.length
        if all(served[s] < total[s] - 256 for s in total):  # no queue has run out
            assert all(abs(served[s] - share[s] * seen) < 2 * 256 for s in total)


def test_nulls_repeats_and_empty_tables(spark, library):
    kinds = "doc_id long, text string, source string, length int"
    long = "token " * 3000
    rows = [(1, None, None, 0), (2, "", "", 0), (3, "same", "s", 0), (3, "same", "s", 0), (None, "x", "s", 0), (4, long, "t", 0)]
    pieces = packing.pack(spark.createDataFrame(rows, kinds), PATH, length=64, end_id=9).collect()
    assert sum(p.length for p in pieces) == 1 + 1 + 2 * 2 + 2 + len(library.encode(long).ids) + 1
    by_doc = collections.Counter(p.doc_id for p in pieces if p.start == 0)
    assert by_doc == {1: 1, 2: 1, 3: 2, None: 1, 4: 1}
    assert packing.pack(spark.createDataFrame([], kinds), PATH).count() == 0


def test_sequences_are_the_pieces_in_order(spark, sf):
    pieces = packing.pack(spark.read.parquet(f"{sf}/documents.parquet"), PATH)
    want = collections.defaultdict(bytes)
    for p in sorted(pieces.collect(), key=lambda p: (p.sequence_id, p.offset)):
        want[p.sequence_id] += p.ids
    assert {r.sequence_id: bytes(r.ids) for r in packing.sequences(pieces).collect()} == want


def test_weights_must_cover_all_sources(spark):
    with pytest.raises(ValueError, match="positive weight"):
        packing.pack(mixed_documents(spark), PATH, weights={"a": 1.0}).count()
