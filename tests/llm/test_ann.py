from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.llm import ann, queries


def by_hand(rows, k=10):
    """{(query_id, rank): (vec_id, score)} of an exact search."""
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max({len(v) for _, v in good}, key=lambda w: (sum(len(v) == w for _, v in good), -w), default=0)
    good = [(i, v) for i, v in good if len(v) == width]
    out = {}
    points, ids = np.array([v for _, v in good], np.float32).astype(float), np.array([i for i, _ in good])
    for q in {i for i, _ in good if i % 100 == 0}:
        best = {}
        for own in points[ids == q]:
            for i, d in zip(ids.tolist(), np.sqrt(np.square(points - own).sum(1)).tolist()):
                if i != q:
                    best[i] = min(best.get(i, d), d)
        for rank, (d, i) in enumerate(sorted((d, i) for i, d in best.items())[:k], 1):
            out[q, rank] = (i, d)
    return out


def found(df):
    return {(r.query_id, r.rank): (r.vec_id, r.score) for r in df.collect()}


def same(got, want):
    assert got.keys() == want.keys()
    for key, (vec, score) in want.items():
        assert got[key][0] == vec and got[key][1] == pytest.approx(score, abs=1e-12)


def test_recall_on_the_whole_table(spark, sf):
    folder = sf.replace("sf0.001", "sf0.1")
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = found(queries.op1_multi_index(spark, folder)), by_hand(rows)
    assert got.keys() == want.keys()
    pairs = {(q, v) for (q, _), (v, _) in want.items()}
    assert len(pairs & {(q, v) for (q, _), (v, _) in got.items()}) >= 0.9 * len(pairs)
    points = {i: np.array(v, float) for i, v in rows}
    for (q, rank), (v, score) in got.items():
        assert score == pytest.approx(np.sqrt(np.square(points[q] - points[v]).sum()), abs=1e-12)
        assert rank == 1 or got[q, rank - 1][::-1] < (score, v)


def test_short_walks_find_clustered_neighbours(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(60, 16)) * 10
    rows = [(k, (centres[k % 60] + rng.normal(size=16)).tolist()) for k in range(6000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = found(ann.search(df, F.col("vec_id") % 100 == 0, visit=200)), by_hand(rows)
    hits = {(q, v) for (q, _), (v, _) in got.items()} & {(q, v) for (q, _), (v, _) in want.items()}
    assert len(hits) >= 0.95 * len(want)


def test_hot_vectors_ties_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 16)
    monkeypatch.setattr(ann, "CHUNK", 3)
    rng = np.random.default_rng(2)
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(0, 900, 3)] + [(k, rng.integers(-2, 3, 3).astype(float).tolist()) for k in range(1, 900, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    same(found(ann.search(df, F.col("vec_id") % 100 == 0, visit=10**9)), by_hand(rows))


def test_odd_vectors_repeats_and_clashing_columns(spark):
    odd = [None, [], [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [None, 1.0], [1.0, 2.0, 3.0], [1e30, -1e30]]
    rows = [(100 * k, v) for k, v in enumerate(odd)] + [(5, [1.0, 0.0]), (5, [1.0, 0.0]), (1000, [1.0, 0.0]), (1000, [0.0, 2.0]), (None, [1.0, 1.0]), (7, [-0.0, 1.0]), (8, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, "x", 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, query_id string, score double")
    same(found(ann.search(df, F.col("vec_id") % 100 == 0)), by_hand(rows))


def test_few_or_no_rows(spark):
    one = spark.createDataFrame([(100, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert found(ann.search(one, F.col("vec_id") % 100 == 0)) == {(100, 1): (1, 1.0)}
    for none in (one.limit(0), one.where("vec_id = 1"), one.where("vec_id = 100")):
        assert ann.search(none, F.col("vec_id") % 100 == 0).count() == 0


def test_walk_visits_cells_by_summed_distance():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = rng.random(rng.integers(1, 12)).round(1), rng.random(rng.integers(1, 12)).round(1)
        sizes = rng.integers(0, 4, len(a) * len(b))
        cells = ann.walk(a, b, sizes, 10**9)
        assert sorted(cells) == np.flatnonzero(sizes).tolist()
        assert (np.diff((a[:, None] + b).ravel()[cells]) >= -1e-12).all()
        some = ann.walk(a, b, sizes, 5)
        assert cells[: len(some)] == some and (sizes[some].sum() >= 5 or len(some) == len(cells))


def test_blocks_travel_only_to_chunks_that_visit_them(spark, monkeypatch):
    """Clustered vectors, many chunks: few pairs of block and chunk are sent, and nothing is missed."""
    monkeypatch.setattr(ann, "BLOCK", 64)
    monkeypatch.setattr(ann, "CHUNK", 2)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 8)) * 50
    rows = [(k, (centres[k % 20] + rng.normal(size=8)).tolist()) for k in range(2000)]
    seen = []
    to_askers = ann.to_askers
    monkeypatch.setattr(ann, "to_askers", lambda blocks, sent: seen.append((blocks.count(), to_askers(blocks, sent).count(), sent.select("chunk").distinct().count(), sent.select("block", "chunk").distinct().count(), sent.count())) or to_askers(blocks, sent))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = found(ann.search(df, F.col("vec_id") % 100 == 0, visit=200)), by_hand(rows)
    ((entries, dealt, chunks, pairs, visits),) = seen
    assert entries == 2000 and 5 < chunks <= 10 and pairs <= visits
    assert dealt < 0.6 * entries * chunks
    hits = {(q, v) for (q, _), (v, _) in got.items()} & {(q, v) for (q, _), (v, _) in want.items()}
    assert len(hits) >= 0.95 * len(want)
