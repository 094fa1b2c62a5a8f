"""Near-duplicate documents: SuperMinHash signatures, banding, verification on full sets, groups.

Each element of a set draws one random permutation of the signature's slots and gives the j-th slot
of it the rank j + r with r in [0, 1).  A slot keeps its smallest rank.  Ranks of one element are
spread over all slots, which lowers the variance of the estimate below that of independent hashes,
and once every slot of a set holds a rank below j + 1, later draws cannot change it: large sets
stop after two or three of the draws.

Sets that are equal form a class, which goes on as one.  Classes that agree in a band share a bucket.  A
bucket never emits its pairs: its members are compared with the member that lies most central (most
company over all its buckets).  Confirmed links are grouped.  Members of a bucket that are still apart
afterwards meet by their rarest shingles: with all shingles in one order, rare ones first, two sets
that are similar enough share one of the first few of both (a prefix filter).  So documents of one template
that differ in words of their own never meet.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tallywright.llm.common import binary, mixed, saved, windows, word_codes

#: 32 bands of 4 of 128 slots miss a pair of similarity 0.8 with a probability of 5e-8.
SLOTS, BAND_ROWS = 128, 4
#: Elements a task draws for at a time (each keeps a permutation of SLOTS numbers); longer sets are cut.
DRAWN_AT_ONCE = 100_000
#: Cells in which shingles are counted to tell rare ones (a broadcast of 16 MB at most); shingles that
#: share a cell only stand later in the order than they might.
CELLS = 2**22
#: Cells of a block, in which counts travel.
BLOCK_CELLS = 2**14

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SIGNED = "doc long, n long, key1 long, key2 long, bands array<long>"


def shingle_sets(words: int) -> Callable[[bytes | None], np.ndarray]:
    """The distinct shingles of a text, A-Z lower-cased, as sorted hashes.  Shorter texts are one
    shingle, texts without words none."""
    codes_of = word_codes()

    def shingles(text: bytes | None) -> np.ndarray:
        codes = codes_of(text.translate(_LOWER) if text else None)
        return np.unique(windows(codes, min(words, len(codes)))) if len(codes) else codes

    return shingles


def super_minhash(elements: np.ndarray, owner: np.ndarray, sets: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (sets x slots) of sets whose elements stand one after the other; ``owner`` is the
    set of each element.  All elements draw together; finished sets leave after each draw."""
    best = np.full(sets * slots, np.iinfo(np.uint64).max, np.uint64)
    order = np.tile(np.arange(slots, dtype=np.uint16), (len(elements), 1))
    for j in range(slots):
        if not len(elements):
            break
        draw = mixed(elements + np.uint64((j + 1) * 0x9E3779B97F4A7C15 % 2**64))
        k = j + (mixed(draw ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(slots - j)).astype(np.int64)
        row = np.arange(len(elements))
        slot = order[row, k].astype(np.int64)
        order[row, k] = order[:, j]
        rank = (np.uint64(j) << np.uint64(53)) | (draw >> np.uint64(11))
        np.minimum.at(best, owner * slots + slot, rank)
        open_sets = best.reshape(sets, slots).max(1) >= np.uint64(j + 1) << np.uint64(53)
        left = open_sets[owner]
        if not left.all():
            elements, owner, order = elements[left], owner[left], order[left]
    return best.reshape(sets, slots)


def band_keys(signatures: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    sets, slots = signatures.shape
    parts = signatures.reshape(sets, slots // rows, rows)
    key = np.broadcast_to(np.arange(slots // rows, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(rows):
        key = mixed(key * np.uint64(0xD6E8FEB86659FD93) + parts[:, :, k])
    return key.view(np.int64)


def signatures(elements: np.ndarray, owner: np.ndarray, sets: int, slots: int = SLOTS) -> np.ndarray:
    """:func:`super_minhash` with bounded memory: a slot's smallest rank over the slices of a set."""
    if len(elements) <= 2 * DRAWN_AT_ONCE:
        return super_minhash(elements, owner, sets, slots)
    best = np.full((sets, slots), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(elements), DRAWN_AT_ONCE):
        some = owner[at : at + DRAWN_AT_ONCE]
        first, last = some[0], some[-1] + 1  # owners stand in order
        part = super_minhash(elements[at : at + DRAWN_AT_ONCE], some - first, last - first, slots)
        np.minimum(best[first:last], part, out=best[first:last])
    return best


def set_keys(elements: np.ndarray, owner: np.ndarray, sets: int) -> list[np.ndarray]:
    """Two 64-bit hashes of each set, whatever the order of its elements."""
    keys = []
    for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
        total = np.zeros(sets, np.uint64)
        np.add.at(total, owner, mixed(elements ^ np.uint64(salt)))
        keys.append(total.view(np.int64))
    return keys


def _signed(shingle: int, slots: int, rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets_of, ids, sets, size = shingle_sets(shingle), [], [], 0

        def batch() -> pa.RecordBatch:
            n = np.array([len(s) for s in sets], np.int64)
            elements = np.concatenate(sets)
            owner = np.repeat(np.arange(len(sets)), n)
            keys = band_keys(signatures(elements, owner, len(sets), slots), rows)
            bands = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32), keys.ravel())
            sums = [pa.array(key) for key in set_keys(elements, owner, len(sets))]
            return pa.record_batch([pa.array(ids, pa.int64()), pa.array(n), *sums, bands], names=["doc", "n", "key1", "key2", "bands"])

        for incoming in batches:
            for doc, text in zip(incoming.column(0).to_pylist(), binary(incoming.column(1))):
                found = sets_of(text)
                ids.append(doc)
                sets.append(found)
                size += len(found)
                if size >= DRAWN_AT_ONCE or len(ids) >= 5000:
                    yield batch()
                    ids, sets, size = [], [], 0
        if ids:
            yield batch()

    return run


def _sets(shingle: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets_of = shingle_sets(shingle)

        def batch(found: list[np.ndarray]) -> pa.RecordBatch:
            sizes = [len(x) for x in found]
            elements = np.concatenate(found)
            keys = set_keys(elements, np.repeat(np.arange(len(found)), sizes), len(found))
            lists = pa.ListArray.from_arrays(np.cumsum([0, *sizes]).astype(np.int32), elements.view(np.int64))
            return pa.record_batch([*map(pa.array, keys), lists], names=["key1", "key2", "shingles"])

        for incoming in batches:
            found, size = [], 0
            for text in binary(incoming.column(0)):
                found.append(sets_of(text))
                size += len(found[-1])
                if size >= 10 * DRAWN_AT_ONCE or len(found) >= 500:
                    yield batch(found)
                    found, size = [], 0
            if found:
                yield batch(found)

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) whose full sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    both = pairs.join(one, "a").join(two, "b")
    return both.where(_similar(shared, F.size("sa"), F.size("sb"), percent)).select("a", "b").distinct()


def _similar(shared: Column, one: Column, two: Column, percent: int) -> Column:
    return 100 * shared >= percent * (one + two - shared)


def _pairs(frame: DataFrame, one: str, two: str) -> DataFrame:
    return frame.select(F.least(one, two).alias("a"), F.greatest(one, two).alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) of undirected links (a, b); a component is named by its smallest node.

    Union by smallest label with pointer jumping: each round a node takes the smallest label among
    its neighbours and then that label's own label.  Rounds are written to the shared folder, so a
    lost executor costs one round.
    """
    both = saved(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "edges")
    labels = saved(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        stepped = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("jump"))
        after = stepped.join(target, F.col("label") == F.col("t"), "left")
        new = saved(after.select("node", "old", F.least("label", F.coalesce("jump", "label")).alias("label")), "labels")
        settled = new.where("old <> label").isEmpty()
        labels = new.select("node", "label")
        if settled:
            return labels.select("node", F.col("label").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Two documents are linked if 100 * intersection >= ``percent`` * union of their shingle sets;
    ``component_id`` is the smallest id reachable over links and ``kept`` tells whether it is the
    row's own.  Null and empty texts, and texts without words, have no shingles and are linked with
    nothing.  A row with a null id takes no part: its component is null and it is kept.  Repeated
    rows get equal results.  Rows that share an id but not the text are judged by their text.
    Other columns are not read.
    """
    source = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc"), F.col(f"`{text_column}`").cast("string").alias("text"))
    signed = saved(source.mapInArrow(_signed(shingle, SLOTS, BAND_ROWS), _SIGNED), "signatures")
    equal = signed.where("n > 0 AND doc IS NOT NULL").groupBy("key1", "key2").agg(F.min(F.struct("doc", "n", "bands")).alias("x"))
    classes = saved(equal.select("key1", "key2", "x.*", F.monotonically_increasing_id().alias("node")), "classes")

    keys = classes.select("node", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.count("*").alias("company")).where("company > 1")
    members = saved(keys.join(shared, "key"), "buckets")
    ranked = members.join(members.groupBy("node").agg(F.sum("company").alias("central")), "node")
    pivots = ranked.groupBy("key").agg(F.max(F.struct("central", "node", "n")).alias("p")).select("key", F.col("p.node").alias("pivot"), F.col("p.n").alias("pivot_n"))
    least, most = F.least("n", "pivot_n"), F.greatest("n", "pivot_n")
    first = _pairs(ranked.join(pivots, "key").where(F.col("node") != F.col("pivot")).where(100 * least >= percent * most), "node", "pivot")

    # One set for each class that has company; rows that repeat an id or a text add nothing to it.
    wanted = classes.join(members.select("node").distinct(), "node", "left_semi").select("node", "doc", "key1", "key2")
    texts = source.join(wanted.select("doc").distinct(), "doc", "left_semi").select("text")
    sets = texts.mapInArrow(_sets(shingle), "key1 long, key2 long, shingles array<long>").groupBy("key1", "key2").agg(F.first("shingles").alias("shingles"))
    sets = saved(wanted.select("node", "key1", "key2").join(sets, ["key1", "key2"]).select("node", "shingles"), "sets")
    links = saved(_confirmed(first, sets, percent), "links")
    grouped = components(links)

    more = _apart(members, sets, grouped, percent)
    if not more.isEmpty():
        links2 = saved(_confirmed(more, sets, percent), "links")
        if not links2.isEmpty():
            grouped = components(links.union(links2))

    named = classes.select("key1", "key2", "doc", "node").join(grouped, "node", "left")
    alone = named.where("component IS NULL").select("key1", "key2", F.col("doc").alias("found"))
    together = named.where("component IS NOT NULL")
    smallest = together.groupBy("component").agg(F.min("doc").alias("found"))
    of_class = alone.unionByName(together.join(smallest, "component").select("key1", "key2", "found"))
    component = F.when(F.col("n") > 0, F.coalesce("found", "doc")).otherwise(F.col("doc"))
    out = signed.select("doc", "n", "key1", "key2").join(of_class, ["key1", "key2"], "left")
    out = out.select(F.col("doc").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("doc").isNotNull(), component).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(id_column) == F.col("component_id"), F.lit(True)))


def cell(shingles: np.ndarray, cells: int) -> np.ndarray:
    return (mixed(shingles.view(np.uint64)) % np.uint64(cells)).astype(np.int64)


def counted(sets: DataFrame, cells: int) -> np.ndarray:
    """In how many sets the shingles of a cell occur.  Tasks count in arrays of fixed size and send the
    blocks that they touched; what comes together is as large as one such array."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(cells, np.int32)
        for batch in batches:
            at, n = np.unique(cell(batch.column(0).flatten().to_numpy(), cells), return_counts=True)
            found[at] += n.astype(np.int32)
        for block in np.flatnonzero(found.reshape(-1, BLOCK_CELLS).any(1)):
            blob = found[block * BLOCK_CELLS : (block + 1) * BLOCK_CELLS].tobytes()
            yield pa.record_batch([pa.array([block], pa.int64()), pa.array([blob], pa.binary())], names=["block", "counts"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, total = None, None
        for batch in batches:
            for at, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts = np.frombuffer(blob, np.int32).astype(np.int64)
                if at == block:
                    total += counts
                    continue
                if block is not None:
                    yield sent(block, total)
                block, total = at, counts
        if block is not None:
            yield sent(block, total)

    def sent(block: int, total: np.ndarray) -> pa.RecordBatch:
        blob = np.minimum(total, np.iinfo(np.int32).max).astype(np.int32).tobytes()
        return pa.record_batch([pa.array([block], pa.int64()), pa.array([blob], pa.binary())], names=["block", "counts"])

    kind = "block long, counts binary"
    blocks = sets.select("shingles").mapInArrow(count, kind).repartition("block").sortWithinPartitions("block").mapInArrow(merge, kind)
    whole = np.zeros(cells, np.int32)
    for row in blocks.toLocalIterator():  # bounded by ``cells``
        whole[row.block * BLOCK_CELLS : (row.block + 1) * BLOCK_CELLS] = np.frombuffer(row.counts, np.int32)
    return whole


def _apart(members: DataFrame, sets: DataFrame, grouped: DataFrame, percent: int) -> DataFrame:
    """Pairs of different components that may still be linked, among the members of buckets that hold
    several components.

    With the shingles of both sets in one order, take the first one that they share: whatever they share
    stands at or behind it in both.  So it stands early, within the first (100 - percent) % of the longer
    set and, as the union is no smaller than that set, even earlier in the shorter one.  Sets meet by
    these shingles only, and where what stands behind is enough for a link.
    """
    placed = members.join(grouped, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("key")
    inside = placed.join(several, "key").select("node", "component").distinct()
    open_sets = saved(sets.join(inside, "node").select("node", "component", "shingles"), "open")
    cells = CELLS
    counts = sets.sparkSession.sparkContext.broadcast(counted(open_sets, cells))

    def early(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = counts.value
        for batch in batches:
            nodes, components_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            rows = []
            for k, shingles in enumerate(batch.column(2)):
                values = shingles.values.to_numpy()
                n = len(values)
                kept = n - -(-percent * n // 100) + 1  # the first shared one is among these
                frequency = often[cell(values, cells)]
                order = np.lexsort((values, frequency))[:kept]
                # What only this set has is shared with none.
                order, place = order[frequency[order] > 1], np.flatnonzero(frequency[order] > 1)
                rows.append((np.full(len(order), nodes[k]), np.full(len(order), components_[k]), np.full(len(order), n), place, values[order]))
            if rows:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*rows)]
                yield pa.record_batch(columns, names=["node", "component", "n", "place", "shingle"])

    rows = saved(open_sets.mapInArrow(early, "node long, component long, n long, place long, shingle long"), "early")
    # Shingles with one component only bring nobody together.
    met = rows.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("shingle")
    rows = rows.join(met, "shingle")
    names = ("node", "component", "n", "place")
    shorter = rows.where((100 + percent) * (F.col("n") - F.col("place")) >= 2 * percent * F.col("n"))
    longer = rows.select("shingle", *[F.col(c).alias(f"l_{c}") for c in names])
    behind = F.least(F.col("n") - F.col("place"), F.col("l_n") - F.col("l_place"))
    enough = (100 + percent) * behind >= percent * (F.col("n") + F.col("l_n"))
    ordered = (F.col("n") < F.col("l_n")) | ((F.col("n") == F.col("l_n")) & (F.col("node") < F.col("l_node")))
    near = shorter.join(longer, "shingle").where(ordered & enough & (F.col("component") != F.col("l_component")))
    return saved(_pairs(near, "node", "l_node"), "pairs")


SQL = r"""
    WITH RECURSIVE words AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    shingles AS (
        SELECT DISTINCT doc_id, hash(array_to_string(w[i : i + least(3, len(w) - 1)], ' '), least(4, len(w))) AS s
        FROM words, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS t(i)),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b
        FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id
        JOIN sizes AS x ON x.doc_id = a.doc_id JOIN sizes AS y ON y.doc_id = b.doc_id
        GROUP BY a.doc_id, b.doc_id, x.n, y.n
        HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))),
    reach(doc_id, other) AS (
        SELECT doc_id, doc_id FROM words
        UNION
        SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
    found AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM found LEFT JOIN sizes USING (doc_id)
"""
