"""Mixture-controlled packing of documents into fixed-length token sequences.

Each source is a queue.  Deficit round-robin gives every queue, in each round, its share of one
window of tokens as credit; a document leaves its queue in the first round in which the credit it
has waited for covers it, and credit left over carries to the next round.  For queues with a
backlog this has a closed form: the document that ends at token ``e`` of its queue leaves in round
``ceil(e / credit) - 1``.  So no task walks the rounds: positions in a queue and positions in the
whole stream are prefix sums in two levels (totals of small ranges, then rows within a range), which
also carries deficits across partitions.  The stream, ordered by round, queue and position, is cut
every ``length`` tokens, so all sequences but the last are full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window, functions as F

from tallywright.llm.common import parts, saved
from tallywright.llm.token_counts import PATTERN, Vocabulary, byte_letters

#: Tokens to a range of the prefix sums.
RANGE_TOKENS = 10e6
#: Bytes of ids a task hands on at once.
SEND_BYTES = 8e6


class Encoder:
    """Ids of byte-level BPE as the ``tokenizers`` library gives them, without added tokens.

    ``tiktoken`` merges any two neighbours that form a vocabulary entry, lowest id first;
    ``tokenizers`` merges listed pairs, in their order.  Both agree for every text if ids follow the
    order of the list and each entry, merged alone by the list, ends as itself: the first step at
    which they could differ would join two pieces of an entry that are not its listed pair, and
    merging that entry alone would stop at the same two pieces.  This is checked here.
    """

    def __init__(self, path: str):
        vocabulary = Vocabulary(path)
        byte = {c: b for b, c in enumerate(byte_letters())}
        listed = [vocabulary.ids[a + b] for a, b in vocabulary.ranks]
        entries = [e for e in vocabulary.ids if e not in vocabulary.special]
        if listed != sorted(listed) or any(vocabulary.merge(e) != [e] for e in entries):
            raise ValueError("ids of this vocabulary do not follow its merges")
        self.ranks = {bytes(byte[c] for c in e): vocabulary.ids[e] for e in entries}
        self.special = vocabulary.special
        self.most = max([*vocabulary.ids.values(), *vocabulary.special.values()])


def encode_with(ranks: dict[bytes, int], special: dict[str, int], width: str) -> Callable[[str], np.ndarray]:
    encoding = tiktoken.Encoding("documents", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    allowed = set(special)
    return lambda text: encoding.encode_to_numpy(text, allowed_special=allowed, disallowed_special=()).astype(width)


def tokenised(docs: DataFrame, path: str, end_id: int, id_column: str, text_column: str, source_column: str) -> tuple[DataFrame, np.dtype]:
    """(row, doc, queue, place, n, ids) of every document, written to the shared folder.  ``place``
    is a hash that fixes the order in a queue; ``ids`` are little-endian and end with ``end_id``; and the type of the ids."""
    encoder = Encoder(path)
    width = np.dtype("<u2" if max(encoder.most, end_id) < 2**16 else "<u4")
    shared = docs.sparkSession.sparkContext.broadcast((encoder.ranks, encoder.special, width.str))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encode_with(*shared.value)
        end = np.array([end_id], width).tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                rows = batch.slice(at, 1000)
                ids = [(encode(t).tobytes() if t else b"") + end for t in rows.column(3).to_pylist()]
                n = np.array([len(x) // width.itemsize for x in ids], np.int64)
                yield pa.record_batch([rows.column(0), rows.column(1), rows.column(2), pa.array(n), pa.array(ids, pa.binary())], names=["doc", "queue", "place", "n", "ids"])

    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    doc = F.col(f"`{id_column}`").cast("long")
    queue = F.coalesce(F.col(f"`{source_column}`").cast("string"), F.lit(""))
    rows = docs.select(doc.alias("doc"), queue.alias("queue"), F.xxhash64(doc, text).alias("place"), text.alias("text"))
    tokens = rows.mapInArrow(run, "doc long, queue string, place long, n long, ids binary")
    return saved(tokens.withColumn("row", F.monotonically_increasing_id()), "tokens", compression="zstd"), width


def _running(frame: DataFrame, group: list[str], at: str, order: list[str]) -> DataFrame:
    """``before``: the sum of ``n`` of all earlier rows of the group, in the order of the range
    ``at`` and then ``order``.  Totals of ranges are summed first, so no task sees a whole group."""
    keys = [*group, at]
    totals = frame.groupBy(*keys).agg(F.sum("n").alias("total"))
    earlier = Window.partitionBy(*group).orderBy(at).rowsBetween(Window.unboundedPreceding, -1) if group else Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*keys, F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("range_start"))
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = frame.withColumn("in_range", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return rows.join(starts, keys).withColumn("before", F.col("range_start") + F.col("in_range")).drop("range_start", "in_range")


def stream_positions(tokens: DataFrame, window: int, weights: Mapping[str, float] | None = None) -> DataFrame:
    """(row, first): where each document begins in the stream of all documents."""
    spark = tokens.sparkSession
    narrow = tokens.select("row", "queue", "place", "n")
    total = narrow.agg(F.sum("n")).first()[0] or 0
    ranges = parts(spark, total, RANGE_TOKENS)
    totals = narrow.groupBy("queue").agg(F.sum("n").alias("queue_total"))
    if weights is None:  # the documents' own mixture
        credit = F.col("queue_total") / F.lit(float(max(total, 1))) * window
    else:
        missing = [r.queue for r in totals.where(~F.col("queue").isin(list(weights))).limit(5).collect()]
        if missing or min(weights.values()) <= 0:
            raise ValueError(f"every source needs a positive weight, not so: {missing}")
        share = F.create_map(*[F.lit(x) for q, w in weights.items() for x in (q, w / sum(weights.values()))])
        credit = share[F.col("queue")] * window
    queued = _running(narrow.withColumn("range", F.pmod("place", F.lit(ranges))), ["queue"], "range", ["place", "row"])
    credits = totals.select("queue", credit.alias("credit"))
    served = queued.join(credits, "queue").withColumn("round", F.ceil((F.col("before") + F.col("n")) / F.col("credit")).cast("long") - 1)
    served = served.select("row", "queue", "n", F.col("before").alias("place"), "round")
    rounds = max(1, int(total / window / ranges))
    placed = _running(served.withColumn("range", F.floor(F.col("round") / rounds).cast("long")), [], "range", ["round", "queue", "place"])
    return placed.select("row", F.col("before").alias("first"))


def pack(
    docs: DataFrame,
    path: str,
    length: int = 2048,
    end_id: int = 1,
    weights: Mapping[str, float] | None = None,
    window: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """Pieces of documents: ``doc_id``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``,
    ``offset``, ``source`` and ``ids`` (binary, little-endian unsigned 32-bit).

    Every id lies in one piece, pieces of a sequence lie without gaps from offset 0, and only the last
    sequence is shorter than ``length``.  ``weights`` are target token shares by source (all sources
    must have one); without them the documents' own shares are kept all along the stream.  ``window`` is
    the number of tokens dealt in a round, a sequence by default.  When a source runs out, the others
    go on at their shares.

    Null and empty texts are one end id.  Null sources are the source ''.  Null ids stay null;
    repeated rows are packed as often as they occur.  No rows give no pieces.  Other columns are not
    read.
    """
    tokens, width = tokenised(docs, path, end_id, id_column, text_column, source_column)
    first = stream_positions(tokens, window or length, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [id_column, "start", "length", "doc_tokens", "sequence_id", "offset", "source", "ids"]
        for batch in batches:
            out: list[tuple] = []
            size = 0
            for doc, queue, n, ids, at in zip(*(batch.column(k).to_pylist() for k in range(5))):
                wide = np.frombuffer(ids, width).astype("<u4")
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    taken = min(length - offset, n - start)
                    out.append((doc, start, taken, n, sequence, offset, queue, wide[start : start + taken].tobytes()))
                    start += taken
                size += 4 * n
                if size > SEND_BYTES:
                    yield _batch(out, names)
                    out, size = [], 0
            if out:
                yield _batch(out, names)

    whole = tokens.select("row", "doc", "queue", "n", "ids").join(first, "row").select("doc", "queue", "n", "ids", "first")
    schema = f"`{id_column}` long, start long, length long, doc_tokens long, sequence_id long, offset long, source string, ids binary"
    return whole.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary()]
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences; a group holds at most one sequence."""
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda acc, piece: F.concat(acc, piece["ids"]))
    return pieces.groupBy("sequence_id").agg(whole.alias("ids"))
