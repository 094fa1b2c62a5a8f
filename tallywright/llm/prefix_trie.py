"""A trie of conversation prefixes with counts over subtrees.

A prefix is known by a 128-bit digest: the exclusive or of hashes of its turns, each hashed with its
place.  Digests of all prefixes are running aggregates, so no task needs a whole conversation.

Most prefixes belong to one conversation only.  Tasks count digests in count-min sketches whose cells
stop at two; merged, they are broadcast.  A digest with an estimate of one occurs once, and so do all
longer prefixes of that conversation: such tails are nodes of one member, written where they are.
Only prefixes that may be shared are shuffled for exact grouping.  An estimate never is too low, so the
sketch decides how much is shuffled, not what comes out.

Sums over subtrees take no walk over levels.  A node is owned by its smallest member, and what a
conversation owns is the lower end of its path.  So the subtree of a node consists of all that its
members own, but for what its owner has above it: one grouped sum.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tallywright.llm.common import parts, saved

#: Cells of a sketch row for each prefix, and the most of them: at two bits a cell and two rows the
#: broadcast is at most 32 MB.  Beyond 8 million prefixes the estimates get coarser, not the result.
CELLS_A_PREFIX, MOST_CELLS = 8, 2**26
#: Cells of a block, in which sketches travel.
BLOCK_CELLS = 2**16
#: Rows of a range of running aggregates.
RANGE_ROWS = 1_000_000
#: A key with more than this share of the rows is hot, so there are at most 2,000 hot keys.
HOT_SHARE = 1 / 2000
#: Ids in one piece of a node's list.
PIECE_IDS = 50_000

_HEAD = 8  # crc32 % 9 is at most 8
_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def running(frame: DataFrame, order: list[str], values: dict[str, tuple[str, Column]], rows: int) -> DataFrame:
    """``frame`` with running aggregates over the rows of a conversation ``c``, the row itself included.

    ``values`` maps a name to ("sum" or "bit_xor", the value of a row).  Rows are cut into ranges of the
    sort order; ranges of a conversation are aggregated and put in order first, its rows only within a
    range.  So no task has a whole conversation; a range has one that began before it at most, which
    bounds the broadcast by the number of ranges.
    """
    ranges = parts(frame.sparkSession, rows, RANGE_ROWS)
    cut = saved(frame.repartitionByRange(ranges, "c", *order).withColumn("__range", F.spark_partition_id()), "ranges")
    over = {name: getattr(F, kind)(value) for name, (kind, value) in values.items()}
    totals = cut.groupBy("c", "__range").agg(*[value.alias(name) for name, value in over.items()])
    earlier = Window.partitionBy("c").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    merged = [getattr(F, kind)(name).over(earlier).alias(f"__before_{name}") for name, (kind, _) in values.items()]
    before = totals.select("c", "__range", F.count("*").over(earlier).alias("__earlier"), *merged).where("__earlier > 0").drop("__earlier")
    inside = Window.partitionBy("c", "__range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    within = cut.select("*", *[value.over(inside).alias(f"__{name}") for name, value in over.items()])
    whole = within.join(F.broadcast(before), ["c", "__range"], "left")
    sums = []
    for name, (kind, _) in values.items():
        start = F.coalesce(f"__before_{name}", F.lit(0))
        sums.append((F.col(f"__{name}") + start if kind == "sum" else F.col(f"__{name}").bitwiseXOR(start)).alias(name))
    return whole.select(*frame.columns, *sums)


def attach(many: DataFrame, one: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """Left join of ``many`` to unique rows ``one``, whose column ``size`` (dropped) is the number of
    rows of ``many`` with that key or more.  Hot keys, of which there cannot be more than 1 / HOT_SHARE,
    are broadcast; no other key has more than that share of the rows."""
    most = total * HOT_SHARE
    hot = F.broadcast(one.where(F.col(size) > most).drop(size))
    cold = one.where(F.col(size) <= most).drop(size)
    there = many.join(hot, keys)
    return there.unionByName(many.join(hot.select(*keys), keys, "left_anti").join(cold, keys, "left"))


def rebuilt_turns(turns: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
    """(c, pos, mark, bytes, last) of all turns of the rebuilt conversations, and (c, length) of these.

    ``turns`` has c, turn, mark and bytes.  Conversation c begins with the first h turns of conversation
    c - c % 5, h being crc32(c) % 9, and goes on with its own after the first h.
    """
    own = saved(running(turns, ["turn", "mark"], {"i": ("sum", F.lit(1))}, rows).drop("turn"), "turns")
    head = F.array_sort(F.collect_list(F.when(F.col("i") <= _HEAD, F.struct("i", "mark", "bytes"))))
    convs = own.groupBy("c").agg(F.max("i").alias("n"), head.alias("head"))
    h = (F.crc32(F.col("c").cast("string").cast("binary")) % 9).cast("int")
    bases = convs.select(F.col("c").alias("b"), F.col("head").alias("base"))
    started = convs.select("c", "n", h.alias("h"), (F.col("c") - F.col("c") % 5).alias("b")).join(bases, "b", "left")
    given = F.filter(F.coalesce("base", F.array().cast("array<struct<i: bigint, mark: binary, bytes: bigint>>")), lambda t: t["i"] <= F.col("h"))
    started = started.select("c", "n", "h", given.alias("given"))
    taken = F.size("given").cast("long")
    sized = saved(started.withColumn("length", taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "conversations")

    firsts = sized.select("c", "length", F.explode("given").alias("t")).select("c", F.col("t.i").alias("pos"), "t.mark", "t.bytes", "length")
    rest = own.where(F.col("i") > h)
    rest = attach(rest, sized.where("n > h").select("c", (taken - F.col("h")).alias("shift"), "length", "n"), ["c"], "n", rows)
    rest = rest.select("c", (F.col("i") + F.col("shift")).alias("pos"), "mark", "bytes", "length")
    both = firsts.unionByName(rest).withColumn("last", F.col("pos") == F.col("length")).drop("length")
    return both, sized.select("c", "length")


def prefixes(turns: DataFrame, rows: int) -> DataFrame:
    """Turns with the digest d1, d2 of the prefix that they end, and p1, p2 of the one before."""
    marks = [F.xxhash64(F.lit(salt), "pos", "mark") for salt in (1, 2)]
    found = running(turns, ["pos"], {"d1": ("bit_xor", marks[0]), "d2": ("bit_xor", marks[1])}, rows)
    before = [F.col(d).bitwiseXOR(mark).alias(p) for d, p, mark in zip(("d1", "d2"), ("p1", "p2"), marks)]
    return found.select("c", "pos", "d1", "d2", *before, "bytes", "last")


class Sketch:
    """Count-min sketch of two rows, cells 0, 1 and 2 (two or more)."""

    def __init__(self, width: int, packed: np.ndarray | None = None):
        self.width = width
        self.packed = packed if packed is not None else np.zeros(width // 2, np.uint8)

    @staticmethod
    def places(width: int, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        """Two cells for each digest, one in each row."""
        low = np.uint64(width - 1)
        return np.stack([d1.view(np.uint64) & low, (d2.view(np.uint64) & low) + np.uint64(width)]).astype(np.int64)

    def estimates(self, d1: np.ndarray, d2: np.ndarray) -> np.ndarray:
        at = self.places(self.width, d1, d2)
        return ((self.packed[at >> 2] >> ((at & 3) * 2).astype(np.uint8)) & 3).min(0)


def _pack(cells: np.ndarray) -> np.ndarray:
    four = cells.reshape(-1, 4)
    return four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6


def _unpack(packed: np.ndarray) -> np.ndarray:
    return np.stack([packed >> s & 3 for s in (0, 2, 4, 6)], 1).ravel()


def sketch_width(rows: int, most: int = MOST_CELLS) -> int:
    return min(most, 1 << max(16, (CELLS_A_PREFIX * rows - 1).bit_length()))


def sketched(digests: DataFrame, width: int) -> Sketch:
    """The merged sketch of all digests (d1, d2): tasks send the blocks that they touched, packed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(2 * width, np.uint8)
        for batch in batches:
            at, n = np.unique(Sketch.places(width, *(batch.column(k).to_numpy() for k in range(2))), return_counts=True)
            cells[at] = np.minimum(cells[at] + np.minimum(n, 2), 2)
        for block in np.flatnonzero(cells.reshape(-1, BLOCK_CELLS).any(1)):
            blob = zlib.compress(_pack(cells[block * BLOCK_CELLS : (block + 1) * BLOCK_CELLS]).tobytes(), 1)
            yield pa.record_batch([pa.array([block], pa.int64()), pa.array([blob], pa.binary())], names=["block", "cells"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, cells = -1, None

        def done() -> pa.RecordBatch:
            return pa.record_batch([pa.array([block], pa.int64()), pa.array([_pack(cells).tobytes()], pa.binary())], names=["block", "cells"])

        for batch in batches:
            for at, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                more = _unpack(np.frombuffer(zlib.decompress(blob), np.uint8))
                if at != block:
                    if cells is not None:
                        yield done()
                    block, cells = at, more
                else:
                    cells = np.minimum(cells + more, 2)
        if cells is not None:
            yield done()

    blocks = digests.select("d1", "d2").mapInArrow(count, "block long, cells binary")
    merged = blocks.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block long, cells binary")
    sketch = Sketch(width)
    for row in merged.toLocalIterator():  # the bounded sketch, block by block
        sketch.packed[row.block * BLOCK_CELLS // 4 : (row.block + 1) * BLOCK_CELLS // 4] = np.frombuffer(row.cells, np.uint8)
    return sketch


def _screened(rows: DataFrame, sketch: Sketch) -> DataFrame:
    """Rows with ``single``: their prefix has one member for sure; and ``single_parent``: so has the one before."""
    shared = rows.sparkSession.sparkContext.broadcast((sketch.width, sketch.packed))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Sketch(*shared.value)
        for batch in batches:
            d1, d2, p1, p2 = (batch.column(name).to_numpy() for name in ("d1", "d2", "p1", "p2"))
            first = batch.column("pos").to_numpy() == 1
            above = (known.estimates(p1, p2) == 1) & ~first  # the root is never screened
            single = (known.estimates(d1, d2) == 1) | above
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(single), pa.array(above)], names=[*batch.schema.names, "single", "single_parent"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, single boolean, single_parent boolean")


def id_lists(ends: DataFrame, rows: int) -> DataFrame:
    """(d1, d2, ends_sha256): SHA-256 of a node's ids ``c``, ascending and joined by commas.

    Ids are sorted and written out range by range; what is left for the one task that the chained hash
    needs is to read a node's text piece by piece."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d1, d2, c = (batch.column(k).to_numpy() for k in range(3))
            new = np.ones(len(c), bool)
            new[1:] = (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])
            new[::PIECE_IDS] = True
            cuts = [*np.flatnonzero(new).tolist(), len(c)]
            pieces = [",".join(map(str, c[a:b].tolist())) for a, b in zip(cuts, cuts[1:])]
            at = cuts[:-1]
            yield pa.record_batch([pa.array(d1[at]), pa.array(d2[at]), pa.array(c[at]), pa.array(pieces, pa.string())], names=["d1", "d2", "c", "ids"])

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            out = []
            for d1, d2, ids in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
                if (d1, d2) != node:
                    if node is not None:
                        out.append((*node, state.hexdigest()))
                    node, state = (d1, d2), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if out:
                yield hashed(out)
        if node is not None:
            yield hashed([(*node, state.hexdigest())])

    def hashed(out: list[tuple]) -> pa.RecordBatch:
        d1, d2, text = zip(*out)
        return pa.record_batch([pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(text)], names=["d1", "d2", "ends_sha256"])

    keys = ["d1", "d2", "c"]
    ranges = parts(ends.sparkSession, rows, RANGE_ROWS)
    pieces = ends.select(*keys).repartitionByRange(ranges, *keys).sortWithinPartitions(*keys).mapInArrow(write, "d1 long, d2 long, c long, ids string")
    return pieces.repartition("d1", "d2").sortWithinPartitions(*keys).mapInArrow(chain, "d1 long, d2 long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
    most_cells: int = MOST_CELLS,
) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    Turns stand by ``turn``, null first; equal ones by the MD5 of role and text.  Null roles and texts
    count as empty.  Rows without a conversation id take no part.  Repeated rows are turns of their own.
    Without any conversation there are no nodes, not even the root.  Other columns are not read.
    Two prefixes are taken for one with a probability of 2 to the -128 a pair.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_column, text_column))
    mark = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    given = conversations.select(F.col(f"`{conv_column}`").cast("long").alias("c"), F.col(f"`{turn_column}`").alias("turn"), mark.alias("mark"), F.octet_length(text).cast("long").alias("bytes"))
    turns = saved(given.where("c IS NOT NULL"), "marks")
    rows = turns.count()

    rebuilt, lengths = rebuilt_turns(turns, rows)
    found = saved(prefixes(saved(rebuilt, "rebuilt"), rows), "prefixes")
    total = found.count()
    sketch = sketched(found, sketch_width(total, most_cells))
    screened = saved(_screened(found, sketch), "screened")

    one = F.lit(1).cast("long")
    alone = screened.where("single").select(
        F.col("c").alias("conv_id"),
        F.col("pos").alias("depth"),
        "p1",
        "p2",
        "single_parent",
        one.alias("n_convs"),
        F.when(F.col("last"), 0).otherwise(one).alias("n_children"),
        one.alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("last"), F.sha2(F.col("c").cast("string"), 256)).otherwise(_EMPTY).alias("ends_sha256"),
    )
    tails = alone.where("single_parent").select(F.col("conv_id").alias("parent_conv_id"), *_NODE)
    edges = alone.where("NOT single_parent").select("p1", "p2", *_NODE)

    zero = F.lit(0).cast("long")
    roots = lengths.select("c", zero.alias("pos"), zero.alias("d1"), zero.alias("d2"), zero.alias("p1"), zero.alias("p2"), zero.alias("bytes"), (F.col("length") == 0).alias("last"))
    maybe = screened.where("NOT single").select(*roots.columns).unionByName(roots)
    tops, edge_count = _shared_nodes(saved(maybe, "maybe"), edges, total + rows)
    parents = tops.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent"), F.col("n_children").alias("size"))
    below = tops.where("depth > 0").select("p1", "p2", *_NODE).unionByName(edges)
    placed = attach(below, parents, ["p1", "p2"], "size", edge_count)
    # A parent that is not among the shared nodes belongs to the conversation alone.
    placed = placed.select(F.coalesce("parent", "conv_id").alias("parent_conv_id"), *_NODE)
    root = tops.where("depth = 0").select(F.lit(None).cast("long").alias("parent_conv_id"), *_NODE)
    columns = ["conv_id", "depth", "parent_conv_id", *_NODE[2:]]
    return root.unionByName(placed).unionByName(tails).select(*columns)


def _shared_nodes(maybe: DataFrame, edges: DataFrame, total: int) -> tuple[DataFrame, int]:
    """Nodes of possibly shared prefixes, exactly grouped, with their digests; and the number of
    links from a node to such a parent."""
    node = ["d1", "d2"]
    groups = maybe.groupBy(*node).agg(
        F.min("c").alias("conv_id"),
        F.max("pos").alias("depth"),
        F.min("p1").alias("p1"),
        F.min("p2").alias("p2"),
        F.max("bytes").alias("bytes"),
        F.count("*").alias("n_convs"),
        F.sum(F.col("last").cast("long")).alias("n_ends"),
    )
    groups = saved(groups, "groups")
    owner = groups.select(*node, F.col("conv_id").alias("owner"), "n_convs", "n_ends", F.col("n_convs").alias("size"))
    members = attach(maybe.select("c", "pos", *node, "bytes", "last"), owner, node, "size", total)
    owned = F.col("c") == F.col("owner")
    weight = F.when(owned, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(0)
    leaf = owned & F.col("last") & (F.col("n_ends") == F.col("n_convs"))
    members = members.select("c", "pos", *node, "last", owned.alias("owned"), weight.alias("weight"), leaf.alias("leaf"))
    members = saved(running(members, ["pos"], {"so_far": ("sum", F.col("weight"))}, total), "members")
    # What a conversation owns; one whose last node is not here ends in a leaf of its own.
    whole = members.groupBy("c").agg(
        F.sum("weight").alias("owns"),
        F.when(F.max("last"), F.max("leaf")).otherwise(True).cast("long").alias("leaves"),
        F.count("*").alias("size"),
    )
    known = attach(members, whole, ["c"], "size", total)
    below = F.when(F.col("owned"), F.col("owns") - F.col("so_far") + F.col("weight")).otherwise(F.col("owns"))
    sums = known.groupBy(*node).agg(F.sum("leaves").alias("n_leaves"), F.sum(below).alias("saved_tokens"))
    links = groups.where("depth > 0").select("p1", "p2").unionByName(edges.select("p1", "p2"))
    children = links.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count("*").alias("n_children"))
    ends = id_lists(maybe.where("last"), total)
    nodes = groups.join(sums, node).join(children, node, "left").join(ends, node, "left")
    nodes = nodes.withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long"))).withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY)))
    nodes = saved(nodes.select(*node, "p1", "p2", *_NODE), "nodes")
    return nodes, links.count()


SQL = """
    WITH RECURSIVE turns AS (
        SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
        FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (
        SELECT c, n, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
            lambda a, b: list_reduce([xor(a, b), 1, 2, 3, 4, 5, 6, 7, 8], lambda s, k: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295::BIGINT) % 9 AS h
        FROM (SELECT c, count(*) AS n FROM turns GROUP BY c)),
    started AS (SELECT v.c, h, least(h, coalesce(b.n, 0)) AS taken FROM convs AS v LEFT JOIN (SELECT c, n FROM convs) AS b ON b.c = v.c - v.c % 5),
    rebuilt AS (
        SELECT s.c, i AS pos, role, text FROM started AS s JOIN turns AS t ON t.c = s.c - s.c % 5 AND i <= h
        UNION ALL
        SELECT s.c, i - h + taken, role, text FROM started AS s JOIN turns AS t ON t.c = s.c AND i > h),
    paths AS (
        SELECT convs.c, coalesce(list({'role': role, 'text': text} ORDER BY pos) FILTER (pos IS NOT NULL), []) AS path
        FROM convs LEFT JOIN rebuilt ON rebuilt.c = convs.c GROUP BY convs.c),
    members AS (SELECT c, d, md5(path[1:d]::VARCHAR) AS node, md5(path[1:d - 1]::VARCHAR) AS parent, coalesce(strlen(path[d].text), 0) AS bytes, len(path) = d AS last
        FROM paths, unnest(range(0, len(path) + 1)) AS t(d)),
    nodes AS (
        SELECT node, d, any_value(parent) AS parent, min(c) AS c, count(*) AS n, any_value(bytes) AS bytes, bool_and(last) AS leaf,
            sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends
        FROM members GROUP BY node, d),
    below AS (
        SELECT m.node, m.d, count(*) FILTER (u.leaf) AS leaves, sum((u.n - 1) * u.bytes) AS saved
        FROM nodes AS u JOIN members AS m ON m.c = u.c AND m.d <= u.d GROUP BY m.node, m.d)
    SELECT v.c::BIGINT AS conv_id, v.d::BIGINT AS depth, p.c::BIGINT AS parent_conv_id, v.n::BIGINT AS n_convs,
        (SELECT count(*) FROM nodes AS k WHERE k.parent = v.node AND k.d = v.d + 1)::BIGINT AS n_children,
        b.leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, v.ends AS ends_sha256
    FROM nodes AS v JOIN below AS b ON b.node = v.node AND b.d = v.d
    LEFT JOIN nodes AS p ON p.node = v.parent AND p.d = v.d - 1 AND v.d > 0
"""
