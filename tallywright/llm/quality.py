"""Quality rules whose thresholds follow the data of each language and source.

Every document is measured once.  The measures of each (language, source) go into a quantile sketch
with logarithmic bins: a count per bin, of bounded size, with a fixed relative error.  Such sketches
merge by adding counts, so a task sends a few counts however large its sources are, and the result does
not depend on the order of merging.  Each language's sketch has the weight of a few documents of the
sketch of all, and each group's that of its language's, so a group's fences move smoothly from what
is usual elsewhere to what is usual in it as it grows.  Fences around the middle half of the values
come out of the sketches and are joined back to the documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from tallywright.llm.common import binary, runs, saved, windows, word_codes

#: Width of a sketch's bins: values are kept to one percent.  Values below LEAST count as zero.
GAMMA, LEAST = 1.02, 1e-4
#: Each group's sketch holds so many documents' weight of its language's, and that one of all documents'.
BORROWED = 100
#: Weight of a document: sketches are added in whole numbers, in whatever order.
UNIT = 1_000_000
#: A fence lies SPREAD times the middle half's width beyond it, and at least a margin: measures of
#: groups with hardly any spread must not reject ordinary documents.
SPREAD = 3.0
MARGINS = {
    "symbols": (None, 0.1),  # per word
    "dup_lines": (None, 0.4),  # share of lines
    "repeats": (None, 0.4),  # share of words
    "word_length": (2.0, 4.0),
}
#: Measures alike in all languages: their fences are bounded by those of all documents too.
SHARES = ("symbols", "dup_lines", "repeats")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


def counts(text: bytes | None, codes: np.ndarray) -> tuple[int, ...]:
    """COUNTS of a text with the given word codes."""
    if not text:
        return (0,) * len(COUNTS)
    data = np.frombuffer(text, np.uint8)
    in_words = np.count_nonzero(((data & 0xC0) != 0x80) & ~_BLANK[data])
    seen, lines, again = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip(b" \t\n\v\f\r"):
            lines += 1
            again += line in seen
            seen.add(line)
    return len(codes), in_words, int(_SYMBOLS[data].sum()), again, repeated_words(codes), lines


def repeated_words(codes: np.ndarray, length: int = 3) -> int:
    """Words that lie in a window whose words occur twice or more."""
    found = windows(codes, length)
    order = np.argsort(found, kind="stable")
    new = runs(found[order])
    sizes = np.diff(np.append(np.flatnonzero(new), len(found)))
    starts = order[np.repeat(sizes > 1, sizes)]
    edge = np.zeros(len(codes) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + length, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(docs: DataFrame, carry: list[str], text_column: str = "text", result: str = "quality") -> DataFrame:
    """The columns ``carry`` and a struct ``result`` with COUNTS of every row."""
    kept = docs.select(*[F.col(f"`{c}`") for c in carry if c != result], F.col(f"`{text_column}`").cast("string").alias("__text"))
    fields = StructType()
    for name in COUNTS:
        fields.add(name, "long")
    schema = StructType(kept.schema.fields[:-1]).add(result, fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes_of = word_codes()
        for batch in batches:
            rows = [counts(t, codes_of(t)) for t in binary(batch.column(batch.num_columns - 1))]
            columns = [pa.array(c, pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * len(COUNTS)
            struct = pa.StructArray.from_arrays(columns, names=list(COUNTS))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], names=[*batch.schema.names[:-1], result])

    return kept.mapInArrow(run, schema)


def _measures(of: str) -> dict[str, Column]:
    count = lambda name: F.col(f"{of}.{name}").cast("double")
    return {
        "symbols": count("n_symbols") / count("n_words"),
        "dup_lines": count("n_dup_lines") / F.greatest(count("n_lines"), F.lit(1.0)),
        "repeats": count("n_repeat_words") / count("n_words"),
        "word_length": count("word_chars") / count("n_words"),
    }


def _group(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def _base_failed(of: str) -> Column:
    return (F.col(f"{of}.n_words") < 50) | (100 * F.col(f"{of}.n_repeat_words") > 50 * F.col(f"{of}.n_words"))


def sketches(measured: DataFrame, lang_column: str, source_column: str, result: str = "quality") -> DataFrame:
    """(lang, source, measure, bin, n): one sketch per group and measure, over all documents that pass the base."""
    pairs = F.explode(F.create_map(*[x for name, value in _measures(result).items() for x in (F.lit(name), value)])).alias("measure", "value")
    rows = measured.where(~_base_failed(result)).select(_group(lang_column).alias("lang"), _group(source_column).alias("source"), pairs)
    bin_ = F.when(F.col("value") < LEAST, F.floor(F.lit(math.log(LEAST, GAMMA))) - 1).otherwise(F.ceil(F.log("value") / math.log(GAMMA)))
    return rows.groupBy("lang", "source", "measure", bin_.cast("int").alias("bin")).agg(F.count("*").alias("n"))


def _blended(own: DataFrame, wider: DataFrame, level: list[str], wider_level: list[str], borrowed: int) -> DataFrame:
    """The sketches ``own``, each with the weight of ``borrowed`` documents of the wider one it belongs to."""
    whole = Window.partitionBy(*wider_level, "measure")
    share = F.col("n") / F.sum("n").over(whole)
    lent = wider.select(*wider_level, "measure", "bin", F.round(share * (borrowed * UNIT)).cast("long").alias("n"))
    added = own.select(*level, "measure").distinct().join(lent, [*wider_level, "measure"]).select(own.columns)
    return own.unionByName(added).groupBy(*level, "measure", "bin").agg(F.sum("n").alias("n"))


def _quartiles(sketch: DataFrame, level: list[str]) -> DataFrame:
    """Quartiles of sketches of a level."""
    whole = Window.partitionBy(*level, "measure")
    shares = sketch.withColumn("rows", F.sum("n").over(whole)).withColumn("up_to", F.sum("n").over(whole.orderBy("bin")))
    middle = F.when(F.col("bin") < math.log(LEAST, GAMMA), 0.0).otherwise(F.pow(F.lit(GAMMA), F.col("bin")) * 2 / (GAMMA + 1))
    at = lambda quarter: F.min(F.when(4 * F.col("up_to") >= quarter * F.col("rows"), middle))
    return shares.groupBy(*level, "measure").agg(at(1).alias("low"), at(3).alias("high"))


def limits(sketch: DataFrame, borrowed: int = BORROWED) -> DataFrame:
    """(lang, source) with a lower and an upper fence for each measure, where there is one.

    A group's fence is never wider than that of its language and, for SHARES, of all documents: a source
    full of junk does not widen its own.  ``borrowed`` documents' weight comes from the wider sketches.
    """
    merged = lambda level: sketch.groupBy(*level, "measure", "bin").agg((F.sum("n") * UNIT).alias("n"))
    all_ = merged([])
    of_lang = _blended(merged(["lang"]), all_, ["lang"], [], borrowed)
    of_group = _blended(merged(["lang", "source"]), of_lang, ["lang", "source"], ["lang"], borrowed)
    own, lang, every = _quartiles(of_group, ["lang", "source"]), _quartiles(of_lang, ["lang"]), _quartiles(all_, [])
    named = lambda frame, prefix: frame.withColumnsRenamed({c: f"{prefix}_{c}" for c in ("low", "high")})
    joined = own.join(named(lang, "lang"), ["lang", "measure"]).join(named(every, "every"), ["measure"])
    shared = F.col("measure").isin(*SHARES)
    levels = [(F.col("low"), F.col("high")), (F.col("lang_low"), F.col("lang_high")), (F.when(shared, F.col("every_low")), F.when(shared, F.col("every_high")))]
    fences = []
    for name, (below, above) in MARGINS.items():
        mine = F.col("measure") == name
        reach = lambda low, high, margin: F.greatest(SPREAD * (high - low), F.lit(margin))
        if below is not None:
            least = F.greatest(*[F.when(low.isNotNull(), low - reach(low, high, below)) for low, high in levels])
            fences.append(F.max(F.when(mine, least)).alias(f"{name}_least"))
        most = F.least(*[F.when(low.isNotNull(), high + reach(low, high, above)) for low, high in levels])
        fences.append(F.max(F.when(mine, most)).alias(f"{name}_most"))
    return joined.groupBy("lang", "source").agg(*fences)


def judged(measured: DataFrame, limit: DataFrame, lang_column: str, source_column: str, result: str = "quality") -> DataFrame:
    """The rows with ``base_failed`` and ``kept`` added to the struct ``result``."""
    base = _base_failed(result)
    fenced = limit.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), F.struct(*[c for c in limit.columns if c not in ("lang", "source")]).alias("__limits"))
    rows = measured.join(fenced, (_group(lang_column) == F.col("__lang")) & (_group(source_column) == F.col("__source")), "left")
    out = F.lit(False)
    for name, value in _measures(result).items():
        below, _ = MARGINS[name]
        if below is not None:
            out = out | (value < F.col(f"__limits.{name}_least"))
        out = out | (value > F.col(f"__limits.{name}_most"))
    verdict = F.when(base, False).otherwise(~F.coalesce(out, F.lit(False)))
    rows = rows.withColumn(result, F.struct(f"{result}.*", base.alias("base_failed"), verdict.alias("kept")))
    return rows.drop("__lang", "__source", "__limits")


def judge_quality(
    docs: DataFrame,
    carry: list[str] | None = None,
    text_column: str = "text",
    lang_column: str = "lang",
    source_column: str = "source",
    result: str = "quality",
    borrowed: int = BORROWED,
) -> DataFrame:
    """Every row of ``docs`` with its columns ``carry`` (all by default) and a struct ``result`` of
    COUNTS, ``base_failed`` and ``kept``.

    A document fails the base with fewer than 50 words or over half of its words in repeated three-word
    windows; it is also rejected if a measure lies beyond the fences of its language and source.  Null
    and empty texts have no words, so they fail.  Fences of small groups lean on their language's and on
    those of all documents, with the weight of ``borrowed`` documents.  Null languages or sources form the group ''.
    Repeated rows are judged alike.  A column of ``docs`` named like ``result`` is replaced; names that
    begin with ``__`` are not free.
    """
    wanted = [c for c in (carry or docs.columns) if c != result]
    needed = [c for c in dict.fromkeys((lang_column, source_column)) if c not in wanted]
    texts = text_column in wanted  # then they are measured again rather than stored
    measures = saved(measure(docs, [*dict.fromkeys((lang_column, source_column))] if texts else [*wanted, *needed], text_column, result), "measures")
    limit = saved(limits(saved(sketches(measures, lang_column, source_column, result), "sketches"), borrowed), "limits")
    rows = measure(docs, [*wanted, *needed], text_column, result) if texts else measures
    return judged(rows, limit, lang_column, source_column, result).drop(*needed)
