"""Nearest neighbours by an inverted multi-index.

Vectors are cut into two halves, and each half has its own codebook: a cell of the index is a pair of
centroids, so two small codebooks make a fine grid.  A query walks over the pairs by the sum of its two
squared distances, smallest first, with a heap that holds only the frontier; it stops once the visited
cells hold enough entries, and those entries are ranked again by their true distance.

How many entries are enough is measured: a bounded sample of queries is compared with all vectors,
and the walk must be long enough to reach RECALL of their true neighbours.

Equal vectors are one entry that carries its smallest ids, so a vector shared by a third of all rows
costs as much as any other.  Cells are grouped into blocks of about BLOCK entries (large cells are
spread over several), queries go once to each block that holds visited cells, and a task compares at
most a block with a chunk of queries; a block only travels to the chunks that visit it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywright.llm.common import saved

#: Vectors the codebooks are fitted on and queries the walk is measured on, at most.
FIT_ROWS, MEASURED_QUERIES = 20_000, 64
#: Share of true neighbours that the walk must reach on the measured queries, and entries it visits at least.
RECALL, LEAST_VISITED = 0.97, 1_000
#: Largest codebook of a half; cells hold about this many entries below that.
MOST_CENTROIDS, PER_CELL = 256, 16
#: Entries of a block and queries of a chunk.
BLOCK, CHUNK = 8_192, 2_048


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, with finite components that are not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(vector, lambda x: x != 0)


def codebook(points: np.ndarray, size: int, rounds: int = 12) -> np.ndarray:
    """Centroids by Lloyd's rounds from points spread evenly over the sample."""
    centres = points[np.linspace(0, len(points) - 1, size).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (np.square(centres).sum(1) - 2 * points @ centres.T).argmin(1)


def walk(first: np.ndarray, second: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
    """Cells with entries by the sum of both distances, until they hold ``wanted`` entries."""
    k = len(second)
    one, two = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    a, b = first[one].tolist(), second[two].tolist()
    rows, columns = one.tolist(), two.tolist()
    held, seen, cells = sizes.tolist(), 0, []
    heap, reached = [(a[0] + b[0], 0, 0)], [0] * len(a)  # reached: columns already pushed in each row
    reached[0] = 1
    while heap and seen < wanted:
        _, i, j = heapq.heappop(heap)
        cell = rows[i] * k + columns[j]
        if held[cell]:
            cells.append(cell)
            seen += held[cell]
        if j + 1 < k and reached[i] == j + 1 and (i == 0 or reached[i - 1] > j + 1):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
            reached[i] = j + 2
        if i + 1 < len(a) and reached[i + 1] == j:
            heapq.heappush(heap, (a[i + 1] + b[j], i + 1, j))
            reached[i + 1] = j + 1
    return cells


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def best_entries(queries: np.ndarray, entries: np.ndarray, k: int, allowed: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, entries, true distances) of the k nearest entries and any that tie with the last."""
    norms = np.square(entries).sum(1)
    for at in range(0, len(queries), 256):
        some = queries[at : at + 256]
        rough = norms - 2 * some @ entries.T
        if allowed is not None:
            rough[~allowed[at : at + 256]] = np.inf
        last = np.partition(rough, min(k, rough.shape[1]) - 1, axis=1)[:, min(k, rough.shape[1]) - 1]
        for row in range(len(some)):
            near = np.flatnonzero((rough[row] <= last[row] + 1e-9 * (1 + abs(last[row]))) & np.isfinite(rough[row]))
            yield at + row, near, np.sqrt(np.square(entries[near] - some[row]).sum(1))


def index(vectors: DataFrame, id_column: str, vector_column: str, keep: int) -> tuple[DataFrame, dict]:
    """(entry, cell, vector, ids) of the distinct usable vectors, and what the walk needs.  ``ids`` are
    the ``keep`` smallest of each vector."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"), vector.alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    common = rows.groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").first()
    width = common.width if common else 0
    rows = rows.where(F.size("vector") == width).distinct()
    small = rows.withColumn("at", F.row_number().over(Window.partitionBy("vector").orderBy("id"))).where(F.col("at") <= keep)
    entries = small.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    entries = saved(entries.withColumn("entry", F.monotonically_increasing_id()), "vectors")
    sample = entries.orderBy(F.xxhash64("vector")).limit(FIT_ROWS).select("vector").toArrow()
    n = entries.count()
    half = max(1, width // 2)
    points = _matrix(sample["vector"]) if n else np.zeros((1, max(2, width)))
    size = min(MOST_CENTROIDS, len(points), max(1, int((n / PER_CELL) ** 0.5)))
    books = codebook(points[:, :half], size), codebook(points[:, half:] if points.shape[1] > half else points[:, :half] * 0, size)
    shared = vectors.sparkSession.sparkContext.broadcast((half, *books))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        half, one, two = shared.value
        for batch in batches:
            points = _matrix(batch.column(1))
            if len(points):
                second = nearest(points[:, half:], two) if points.shape[1] > half else np.zeros(len(points), int)
                cells = pa.array(nearest(points[:, :half], one) * len(two) + second, pa.int32())
                yield pa.record_batch([batch.column(0), cells, batch.column(1), batch.column(2)], names=["entry", "cell", "vector", "ids"])

    placed = saved(entries.select("entry", "vector", "ids").mapInArrow(place, "entry long, cell int, vector array<double>, ids array<long>"), "index")
    sizes = np.zeros(size * size, np.int64)
    for row in placed.groupBy("cell").agg(F.count("*").alias("n")).collect():  # at most one row per cell
        sizes[row.cell] = row.n
    return placed, {"half": half, "books": books, "sizes": sizes, "n": n}


def _two(point: np.ndarray, plan: dict) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances of a vector's halves to the centroids."""
    one, two = plan["books"]
    first = np.square(one - point[: plan["half"]]).sum(1)
    rest = point[plan["half"] :]
    return first, np.square(two - rest).sum(1) if len(rest) else np.zeros(len(two))


def _length_of_walk(placed: DataFrame, queries: DataFrame, plan: dict, k: int) -> int:
    """Entries to visit, measured on a bounded sample of queries against all entries."""
    sample = queries.orderBy(F.xxhash64("vector")).limit(MEASURED_QUERIES).select("vector").toArrow()
    if not len(sample):
        return LEAST_VISITED
    points = _matrix(sample["vector"])
    shared = placed.sparkSession.sparkContext.broadcast(points)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = batch.column(0).to_numpy()
            found = [(np.full(len(near), q), d, cells[near]) for q, near, d in best_entries(shared.value, _matrix(batch.column(1)), k)]
            q, d, c = (np.concatenate(x) for x in zip(*found))
            yield pa.record_batch([pa.array(q, pa.int32()), pa.array(d), pa.array(c, pa.int32())], names=["q", "distance", "cell"])

    near = placed.select("cell", "vector").mapInArrow(scan, "q int, distance double, cell int").where("distance > 0")
    best = near.withColumn("at", F.row_number().over(Window.partitionBy("q").orderBy("distance"))).where(F.col("at") <= k)
    needed = []
    for q, cells in best.groupBy("q").agg(F.collect_list("cell")).collect():
        first, second = _two(points[q], plan)
        sums = (first[:, None] + second[None, :]).ravel()
        needed += [int(plan["sizes"][sums <= sums[c] + 1e-12].sum()) for c in cells]
    return max(LEAST_VISITED, int(np.quantile(needed, RECALL, method="higher"))) if needed else LEAST_VISITED


def _blocks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of each cell."""
    first, several, at, filled = np.zeros(len(sizes), np.int32), np.ones(len(sizes), np.int32), 0, 0
    for cell, n in enumerate(sizes.tolist()):
        if n > BLOCK:
            at += filled > 0
            first[cell], several[cell] = at, -(-n // BLOCK)
            at, filled = at + int(several[cell]), 0
            continue
        if filled + n > BLOCK:
            at, filled = at + 1, 0
        first[cell] = at
        filled += n
    return first, several


def to_askers(blocks: DataFrame, sent: DataFrame) -> DataFrame:
    """The entries of each block once for every chunk of queries that visits it, and for no other."""
    asked = sent.select(F.col("block").alias("visited"), F.col("chunk").alias("of")).distinct()
    return blocks.join(asked, F.col("block") == F.col("visited")).select("block", F.col("of").alias("chunk"), "cell", "vector", "ids")


def search(vectors: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding", visit: int | None = None) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the k nearest found of each query row.

    ``is_query`` is a condition on ``id_column``.  Candidates are all rows but those with the query's
    id; the score is the Euclidean distance in double precision, ties go to the smaller id, and with
    fewer than k candidates all are returned.  ``visit`` sets the number of entries a walk visits
    (measured if not given).  Rows whose vector is null, zero, holds null or non-finite components or
    has another length than most, and rows with a null id, take no part.  Repeated rows count once;
    rows that share an id but not the vector are all candidates, and each is a query of that id.
    No rows give no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    placed, plan = index(vectors, id_column, vector_column, k + 1)
    asked = vectors.select(F.col(f"`{id_column}`").cast("long").alias(id_column), F.col(f"`{vector_column}`").cast("array<double>").alias("vector"))
    asked = asked.where(is_query & F.col(id_column).isNotNull() & usable(F.col("vector"))).select(F.col(id_column).alias("query_id"), "vector").distinct()
    known = saved(asked.join(placed.select("entry", "vector"), "vector").select("query_id", "entry"), "asked")
    queries = saved(placed.join(known.select("entry").distinct(), "entry", "left_semi").select("entry", "vector"), "queries")
    wanted = visit or _length_of_walk(placed, queries, plan, k)
    chunks = -(-max(1, queries.count()) // CHUNK)
    first, several = _blocks(plan["sizes"])
    shared = spark.sparkContext.broadcast((plan, first, several, wanted, chunks))

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, first, several, _, _ = shared.value
        for batch in batches:
            cells, entry = batch.column(1).to_numpy(), batch.column(0).to_numpy()
            number = first[cells] + (entry % several[cells]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(number, pa.int32()), *batch.columns[1:]], names=["block", "cell", "vector", "ids"])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, first, several, wanted, chunks = shared.value
        names = ["block", "chunk", "entry", "vector", "cells"]
        for batch in batches:
            for at, (entry, point) in enumerate(zip(batch.column(0).to_pylist(), _matrix(batch.column(1)))):
                cells = np.array(walk(*_two(point, plan), plan["sizes"], wanted), np.int32)
                by_block: dict[int, list[int]] = {}
                for cell in cells.tolist():
                    for b in range(first[cell], first[cell] + several[cell]):
                        by_block.setdefault(b, []).append(cell)
                n = len(by_block)
                same = pa.array([point.tolist()] * n, pa.list_(pa.float64()))
                lists = pa.array(list(by_block.values()), pa.list_(pa.int32()))
                numbers = [pa.array(list(by_block), pa.int32()), pa.array([entry % chunks] * n, pa.int32()), pa.array([entry] * n, pa.int64())]
                yield pa.record_batch([*numbers, same, lists], names=names)

    def compare(entries: pa.Table, asked: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if entries.num_rows and asked.num_rows:
            cells = entries["cell"].to_numpy()
            visited = np.array([np.isin(cells, c) for c in asked["cells"].to_pylist()])
            ids, entry = entries["ids"].to_pylist(), asked["entry"].to_pylist()
            for q, near, distances in best_entries(_matrix(asked["vector"]), _matrix(entries["vector"]), k + 1, visited):
                some = sorted((d, i) for e, d in zip(near.tolist(), distances.tolist()) for i in ids[e])[: k + 1]
                out.extend((entry[q], i, d) for d, i in some)
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64())], names=["entry", "vec_id", "score"])

    sent = saved(queries.mapInArrow(ask, "block int, chunk int, entry long, vector array<double>, cells array<int>"), "walks")
    blocks = placed.select("entry", "cell", "vector", "ids").mapInArrow(block, "block int, cell int, vector array<double>, ids array<long>")
    dealt = to_askers(blocks, sent)
    found = dealt.groupBy("block", "chunk").cogroup(sent.groupBy("block", "chunk")).applyInArrow(compare, "entry long, vec_id long, score double")
    nearest_first = lambda *by: Window.partitionBy(*by).orderBy("score", "vec_id")
    top = found.distinct().withColumn("rank", F.row_number().over(nearest_first("entry"))).where(F.col("rank") <= k + 1).drop("rank")
    own = known.join(top, "entry").where(F.col("vec_id") != F.col("query_id"))
    own = own.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    ranked = own.withColumn("rank", F.row_number().over(nearest_first("query_id"))).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
