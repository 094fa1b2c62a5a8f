from __future__ import annotations

import collections

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tallywright.llm.common import saved
from tests.llm import test_near_dup, test_pii, test_quality, test_substrings
from tests.llm.test_packing import zlib


@pytest.fixture(scope="module")
def steps(spark, sf):
    """The input of each stage and the result of the last."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(saved(stage(spark, frames[-1], sf), name))
    return frames


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stages_and_columns(steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "substring_dedup", "pseudonyms", "packing"]
    assert all(f.schema == steps[0].schema for f in steps[1:5])


def test_quality_stage_by_brute_force(steps):
    before = steps[0].collect()
    kept = test_quality.kept_by_hand([(d.text, d.lang, d.source) for d in before])
    assert rows(steps[1]) == sorted((tuple(d) for d, k in zip(before, kept) if k), key=repr)


def test_near_duplicate_stage_by_brute_force(steps):
    before = steps[1].collect()
    stay = {doc for doc, _, _, kept in test_near_dup.grouped_by_hand([(d.doc_id, d.text) for d in before], 5) if kept}
    assert rows(steps[2]) == sorted((tuple(d) for d in before if d.doc_id in stay), key=repr)


def test_substring_stage_by_brute_force(steps):
    before = steps[2].collect()
    after = {d.doc_id: d for d in steps[3].collect()}
    for d, (words, gone) in zip(before, test_substrings.gone_by_hand([(d.doc_id, d.text) for d in before], 13)):
        new = after[d.doc_id]
        assert new.text.split() == [w for k, w in enumerate(words) if k not in gone] or not new.text.isascii()
        assert new.text == d.text or gone
        assert new.n_chars == len(new.text) and (new.lang, new.source) == (d.lang, d.source)
    assert len(after) == len(before)


def test_pseudonym_stage_changes_private_data_only(steps):
    before, after = ({d.doc_id: d.text for d in f.collect()} for f in steps[3:5])
    assert before.keys() == after.keys()
    for doc, text in before.items():
        assert test_pii.RAW.sub("", text) == test_pii.RAW.sub("", after[doc])
        for a, b in zip(test_pii.RAW.findall(text), test_pii.RAW.findall(after[doc])):
            assert (a == b) == (a.isdigit() and test_pii.luhn(a) != 0)


def test_packing_stage_holds_every_token_once(steps):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = collections.defaultdict(list)
    for p in steps[5].collect():
        pieces[p.doc_id].append(p)
    texts = {d.doc_id: d.text for d in steps[4].collect()}
    assert pieces.keys() == texts.keys()
    for doc, text in texts.items():
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 1], 0
        for p in sorted(pieces[doc], key=lambda p: p.start):
            own = b"".join(k.to_bytes(4, "little") for k in ids[p.start : p.start + p.length])
            assert p.start == at and p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(own)
            at += p.length
        assert at == len(ids)


def test_run_is_the_stages(spark, sf, steps):
    assert rows(corpus_pipeline.run(spark, sf)) == rows(steps[5])


def test_odd_documents(spark):
    long = " ".join(f"word{k}" for k in range(80))
    docs = spark.createDataFrame(
        [(1, None, None, None, None, 0), (2, "", "en", "a", 0, 0), (3, long, None, "a", None, 0), (3, long, None, "a", None, 0), (None, long, "en", None, 5, 0), (4, long + " x", "en", "a", 9, 0), (5, long.upper() + " mail a.b@c.org " + long[::-1], "de", "b", 3, 0)],
        "doc_id long, text string, lang string, source string, n_chars long, kept int",
    )
    for table in (docs, docs.limit(0)):
        found = table
        for name, stage in corpus_pipeline.STAGES:
            found = saved(stage(spark, found, ""), name)
            if name == "near_duplicates" and table is docs:
                assert sorted((d.doc_id for d in found.collect()), key=str) == [3, 5, None]
        assert (found.count() > 0) == (table is docs)
