"""Removal of passages that repeat across documents, found through difference-cover anchors.

A passage is a window of ``length`` words.  Positions of a document are taken modulo a period m,
and a perfect difference set D of residues is the cover: for any two positions i, j there is a
shift d < m with (i + d) mod m and (j + d) mod m both in D.  Hashes of ``length - m + 1`` words at
cover positions are therefore enough: two equal windows always share such an anchor at the same
offset.  Anchors seen in one document only are dropped; around the others the match is extended to
whole windows, and each window is given to the smallest document that has it.

Both rounds work alike.  A task packs the hashes of many documents, resolves what repeats among its
own documents at once, and sends each hash at most twice, so a passage in a third of all
documents costs every task a few entries and no reducer gathers its documents.  What a document
has to know travels back to its chunk of documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from tallywright.llm.common import binary, chars, cuts, mixed, packed, parts, runs, unpacked, windows, word_codes

# Periods and their perfect difference sets.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
#: Bytes of text to a chunk of documents, and hashes a task packs before it sends them.
CHUNK_BYTES = 12e6
FLUSH = 1_000_000
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")

_PACKED = "bucket int, known boolean, docs binary, keys binary, keys2 binary"
_MARKS = "chunk int, docs binary, keys binary"


def period(length: int) -> int:
    """The largest period whose anchors are at least as long as itself."""
    return max(m for m in COVERS if 2 * m <= length + 1 or m == 1)


def _prime_from(n: int) -> int:
    """The next prime, so that regular gaps between ids do not pile up in a few chunks."""
    n = max(n, 3) | 1
    while any(n % k == 0 for k in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


def _anchors(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes at cover positions, and the positions."""
    m = period(length)
    found = windows(codes, length - m + 1)
    at = np.flatnonzero(np.isin(np.arange(len(found)) % m, COVERS[m]))
    return found[at], at


def _near(at: np.ndarray, codes: np.ndarray, length: int) -> np.ndarray:
    """Starts of the windows that hold an anchor at one of the positions ``at``."""
    n = len(codes) - length + 1
    m = period(length)
    edge = np.zeros(n + m + 1, np.int64)
    np.add.at(edge, np.clip(at - m + 1, 0, n), 1)
    np.add.at(edge, np.clip(at + 1, 0, n), -1)
    return np.flatnonzero(np.cumsum(edge[:n]) > 0)


def _packed(bucket: np.ndarray, docs: np.ndarray, keys: np.ndarray, keys2: np.ndarray | None = None, known: bool = False) -> pa.RecordBatch:
    """One row per bucket.  What is known is sorted by document, so that its ids compress to nothing."""
    order = np.lexsort((keys, docs, bucket)) if known else np.argsort(bucket, kind="stable")
    docs, keys, keys2 = docs[order], keys[order], None if keys2 is None else keys2[order]
    rows = [(b, packed(docs[s]), packed(keys[s]), b"" if keys2 is None else packed(keys2[s])) for b, s in cuts(bucket[order])]
    buckets, *blobs = list(zip(*rows)) or [(), (), (), ()]
    columns = [pa.array(buckets, pa.int32()), pa.array([known] * len(rows), pa.bool_()), *(pa.array(b, pa.binary()) for b in blobs)]
    return pa.record_batch(columns, names=["bucket", "known", "docs", "keys", "keys2"])


def _by_hash(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (keys % np.uint64(buckets)).astype(np.int32)


def _by_doc(docs: np.ndarray, buckets: int) -> np.ndarray:
    return _by_hash(mixed(docs.view(np.uint64)), buckets)


def _groups(new: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last row of each run, and the run of each row."""
    firsts = np.flatnonzero(new)
    return firsts, np.append(firsts[1:], len(new)) - 1 if len(firsts) else firsts, np.cumsum(new) - 1


def _send_anchors(docs: np.ndarray, keys: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of each hash the smallest and largest document; every document of a hash that has two knows already."""
    order = np.lexsort((docs, keys))
    docs, keys = docs[order], keys[order]
    firsts, lasts, run = _groups(runs(keys))
    several = docs[firsts] != docs[lasts]
    sent = np.concatenate([firsts, lasts[several]])
    yield _packed(_by_hash(keys[sent], buckets), docs[sent], keys[sent])
    known = several[run]
    yield _packed(_by_doc(docs[known], buckets), docs[known], keys[known], known=True)


def _send_windows(docs: np.ndarray, keys: np.ndarray, keys2: np.ndarray, buckets: int) -> Iterator[pa.RecordBatch]:
    """Of each window the smallest document; the larger ones of this task know already."""
    order = np.lexsort((docs, keys2, keys))
    docs, keys, keys2 = docs[order], keys[order], keys2[order]
    firsts, _, run = _groups(runs(keys, keys2))
    yield _packed(_by_hash(keys[firsts], buckets), docs[firsts], keys[firsts], keys2[firsts])
    known = docs > docs[firsts][run]
    yield _packed(_by_doc(docs[known], buckets), docs[known], keys[known], known=True)


def _marks(chunks: int, docs: np.ndarray, keys: np.ndarray) -> pa.Table:
    """What the documents of each chunk have to know, one row per chunk."""
    chunk = np.mod(docs, chunks).astype(np.int32)
    order = np.lexsort((keys, docs, chunk))
    chunk, docs, keys = chunk[order], docs[order], keys[order]
    new = runs(docs, keys)
    chunk, docs, keys = chunk[new], docs[new], keys[new]
    rows = [(c, packed(docs[s]), packed(keys[s])) for c, s in cuts(chunk)]
    numbers, *blobs = list(zip(*rows)) or [(), (), ()]
    return pa.table([pa.array(numbers, pa.int32()), *(pa.array(b, pa.binary()) for b in blobs)], names=["chunk", "docs", "keys"])


def _halves(table: pa.Table) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """(docs, keys, keys2) of what is to be resolved, and of what is known."""
    out = []
    for known in (False, True):
        part = table.filter(pa.compute.equal(table["known"], known))
        out.append((unpacked(part["docs"], np.int64), unpacked(part["keys"], np.uint64), unpacked(part["keys2"], np.uint32)))
    return tuple(out)


class _MarkIndex:
    """The marks of a chunk, looked up by document."""

    def __init__(self, marks: pa.Table):
        docs, keys = unpacked(marks["docs"], np.int64), unpacked(marks["keys"], np.uint64)
        order = np.argsort(docs, kind="stable")
        self._docs, self._keys = docs[order], keys[order]

    def of(self, doc: int | None) -> np.ndarray:
        if doc is None:
            return self._keys[:0]
        return self._keys[np.searchsorted(self._docs, doc) : np.searchsorted(self._docs, doc, "right")]


def remove_repeats(
    docs: DataFrame,
    length: int = 13,
    id_column: str = "doc_id",
    text_column: str = "text",
    layout: str = "words",
    result: str = "repeats",
) -> DataFrame:
    """All rows and columns of ``docs`` with a struct ``result``: ``n_words``, ``n_removed``,
    ``removed`` (runs of removed words as [start, end) word positions) and ``kept``.

    A word goes if a window of ``length`` words covers it whose words also start in a document with
    a smaller id; the smallest document keeps the passage.  Windows are judged on the input.
    ``kept`` joins the kept words by one space (``layout="words"``) or cuts the removed runs out of
    the text and leaves the rest as it was (``layout="text"``, unchanged where nothing goes).

    Null and empty texts have no words and an empty ``kept``.  Rows with a null id neither lose
    words nor take any from others.  Rows that share an id do not repeat each other; repeated rows
    are treated alike.  A column of ``docs`` named like ``result`` is replaced; other names are free,
    except those that begin with ``__``.
    """
    if length < 1 or layout not in ("words", "text"):
        raise ValueError("length must be positive and layout words or text")
    spark = docs.sparkSession
    source = docs.drop(result)
    columns = source.columns
    total = chars(source, text_column)
    buckets, chunks = parts(spark, total, CHUNK_BYTES), _prime_from(parts(spark, total, CHUNK_BYTES))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of, docs_, keys_, size = word_codes(), [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), binary(batch.column(1))):
                codes = codes_of(text)
                if len(codes) < length:
                    continue
                found = np.unique(_anchors(codes, length)[0])
                docs_.append(np.full(len(found), doc, np.int64))
                keys_.append(found)
                size += len(found)
                if size >= FLUSH:
                    yield from _send_anchors(np.concatenate(docs_), np.concatenate(keys_), buckets)
                    docs_, keys_, size = [], [], 0
        if size:
            yield from _send_anchors(np.concatenate(docs_), np.concatenate(keys_), buckets)

    def repeated(table: pa.Table) -> pa.Table:
        (doc, key, _), (known_doc, known_key, _) = _halves(table)
        order = np.lexsort((doc, key))
        doc, key = doc[order], key[order]
        firsts, lasts, run = _groups(runs(key))
        several = (doc[firsts] != doc[lasts])[run]
        return _marks(chunks, np.concatenate([doc[several], known_doc]), np.concatenate([key[several], known_key]))

    def extended(left: pa.Table, marks: pa.Table) -> pa.Table:
        codes_of, index, out = word_codes(), _MarkIndex(marks), []
        docs_, keys_, keys2_, size = [], [], [], 0

        def send():
            if size:
                out.extend(_send_windows(np.concatenate(docs_), np.concatenate(keys_), np.concatenate(keys2_), buckets))

        for doc, text in zip(left["__id"].to_pylist(), binary(left[text_column])):
            own = index.of(doc)
            if not len(own):
                continue
            codes = codes_of(text)
            if len(codes) < length:
                continue
            found, at = _anchors(codes, length)
            starts = _near(at[np.isin(found, own)], codes, length)
            one, two = windows(codes, length)[starts], windows(codes, length, 1)[starts].astype(np.uint32)
            one, first = np.unique(one, return_index=True)
            docs_.append(np.full(len(one), doc, np.int64))
            keys_.append(one)
            keys2_.append(two[first])
            size += len(one)
            if size >= FLUSH:
                send()
                docs_, keys_, keys2_, size = [], [], [], 0
        send()
        return pa.Table.from_batches(out, _SCHEMA)

    def owned(table: pa.Table) -> pa.Table:
        (doc, key, key2), (known_doc, known_key, _) = _halves(table)
        order = np.lexsort((doc, key2, key))
        doc, key, key2 = doc[order], key[order], key2[order]
        firsts, _, run = _groups(runs(key, key2))
        later = doc > doc[firsts][run]
        return _marks(chunks, np.concatenate([doc[later], known_doc]), np.concatenate([key[later], known_key]))

    def cut(left: pa.Table, marks: pa.Table) -> pa.Table:
        codes_of, index = word_codes(), _MarkIndex(marks)
        counts, removed, spans, kept = [], [], [], []
        for doc, text in zip(left["__id"].to_pylist(), binary(left[text_column])):
            words, own = text.split() if text else [], index.of(doc)
            gone = np.zeros(len(words) + 1, bool)
            if len(own) and len(words) >= length:
                starts = np.flatnonzero(np.isin(windows(codes_of(text), length), own))
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, starts, 1)
                np.add.at(edge, starts + length, -1)
                gone = np.cumsum(edge) > 0
            change = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0))
            bounds = change.reshape(-1, 2).tolist()
            counts.append(len(words))
            removed.append(int(gone.sum()))
            spans.append(bounds)
            kept.append(_joined(words, bounds) if layout == "words" else _cut_out(text or b"", bounds))
        fields = [pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary()).cast(pa.string())]
        struct = pa.StructArray.from_arrays(fields, names=["n_words", "n_removed", "removed", "kept"])
        return left.select(columns).append_column(result, struct)

    identity = F.col(f"`{id_column}`").cast("long")
    texts = F.col(f"`{text_column}`").cast("string")
    dealt = source.withColumns({"__id": identity, text_column: texts, "__chunk": F.coalesce(F.pmod(identity, F.lit(chunks)), F.lit(0)).cast("int")})
    by_chunk = dealt.groupBy("__chunk")
    entries = source.select(identity.alias("__id"), texts.alias("__text")).where("__id IS NOT NULL AND __text IS NOT NULL").mapInArrow(anchors, _PACKED)
    anchor_marks = entries.groupBy("bucket").applyInArrow(repeated, _MARKS)
    window_entries = by_chunk.cogroup(anchor_marks.groupBy("chunk")).applyInArrow(extended, _PACKED)
    window_marks = window_entries.groupBy("bucket").applyInArrow(owned, _MARKS)
    found = StructType().add("n_words", LongType()).add("n_removed", LongType()).add("removed", ArrayType(ArrayType(LongType()))).add("kept", StringType())
    schema = StructType(list(dealt.select(columns).schema.fields)).add(result, found)
    return by_chunk.cogroup(window_marks.groupBy("chunk")).applyInArrow(cut, schema)


_SCHEMA = pa.schema([("bucket", pa.int32()), ("known", pa.bool_()), ("docs", pa.binary()), ("keys", pa.binary()), ("keys2", pa.binary())])


def _joined(words: list[bytes], gone: list[list[int]]) -> bytes:
    for start, end in reversed(gone):
        del words[start:end]
    return b" ".join(words)


def _cut_out(text: bytes, gone: list[list[int]]) -> bytes:
    """The text from each kept run to the next removed one."""
    if not gone:
        return text
    starts = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    kept, at = [], 0
    for start, end in gone:
        kept.append(text[at : starts[start]])
        at = starts[end]
    return b"".join([*kept, text[at:]])


SQL = r"""
    WITH words AS (
        SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    starts AS (
        SELECT k, doc_id, i, hash(array_to_string(w[i : i + 12], ' ')) AS h, hash('#' || array_to_string(w[i : i + 12], ' ')) AS h2
        FROM words, unnest(range(1, len(w) - 11)) AS t(i)),
    repeated AS (
        SELECT k, i FROM (SELECT k, i, doc_id, min(doc_id) OVER (PARTITION BY h, h2) AS first_doc FROM starts) WHERE doc_id > first_doc),
    gone AS (
        SELECT DISTINCT k, i + d AS i FROM repeated, range(13) AS t(d)),
    kept AS (
        SELECT k, string_agg(w[i], ' ' ORDER BY i) AS text, count(*) AS n
        FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM words) ANTI JOIN gone USING (k, i) GROUP BY k)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
           sha256(coalesce(text, '')) AS kept_sha256
    FROM words LEFT JOIN kept USING (k)
"""
