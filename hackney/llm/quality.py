"""Quality rules with thresholds that follow each language and source.

Measures of every whole text go into quantile sketches per language and source, counts by level, which add up over
tasks and over loads and are the same in every run; each group's fences come from its quartiles, shrunk to those of its language where
the group is small, and the documents are joined with them. Fences lie far outside the middle half, so
a group without junk loses next to nothing, and in a group of nothing but junk the fixed rules and the
language's own fences still hold.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hackney.llm.common import SPACES, small, stored, texts_of
from hackney.operators.sketch import quantiles, sketch

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30
MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
_NAMES = [m.split()[0] for m in MEASURES.split(", ")]


def repeated_words(numbers: np.ndarray, window: int = WINDOW) -> int:
    """Words in windows that the text holds twice or more. ``numbers`` tells equal words by equal numbers."""
    many = len(numbers) - window + 1
    if many < 2:
        return 0
    # Numbers for runs of 2, 4, 8 words from those for half the length; the last step joins what overlaps.
    ids, size = numbers, 1
    while size < window:
        step = min(size, window - size)
        pairs = ids[: len(ids) - step] * np.int64(len(numbers) + 1) + ids[step:]
        _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        size += step
    again = np.flatnonzero(counts[ids] > 1)
    if not len(again):
        return 0
    edges = np.zeros(len(numbers) + 1, np.int64)
    edges[again] += 1
    np.subtract.at(edges, again + window, 1)
    return int((np.cumsum(edges) > 0).sum())


def measure(text: bytes) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, lines equal to an earlier one, words in repeated windows."""
    words = text.split()
    number: dict[bytes, int] = {}
    numbers = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    inside = text.translate(None, SPACES)
    # Code points begin with any byte but 10xxxxxx.
    chars = len(inside) if inside.isascii() else int((np.frombuffer(inside, np.int8) >= -64).sum())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = Counter(line for line in text.split(b"\n") if line.strip())
    repeated = repeated_words(numbers) if len(words) > len(number) else 0
    return len(words), chars, symbols, lines.total() - len(lines), repeated


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``lang``, ``source`` and the measures of every document. Null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small(whole):
                found = np.array([measure(t) for t in texts_of(batch)], np.int64).reshape(-1, 5)
                columns = [*batch.columns[:3], *(pa.array(found[:, k].copy()) for k in range(5))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang", "source", *_NAMES])

    rows = docs.select("doc_id", "lang", "source", "text")
    return rows.mapInArrow(run, f"doc_id bigint, lang string, source string, {MEASURES}")


def base_failed() -> Column:
    """The fixed rules: too few words, or too many of them in repeated windows."""
    repeated = 100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    return (F.col("n_words") < FEWEST_WORDS) | repeated


#: Shares are whole millionths in the sketches, whose levels are 0.8 % apart.
MILLIONTHS = 1_000_000
#: Documents whose weight the language has in a group's quartiles.
SHRINK = 100
#: Fences are so many distances between the quartiles away from them.
FENCE = 3.0
#: The smallest distance of a fence from the quartiles, and what is added to it over the square root of
#: the number of words, as shares of short texts vary more.
SLACK = {
    "word_length": (0.7, 4.0),
    "symbol_share": (0.1, 0.3),
    "repeated_share": (0.2, 0.0),
    "dup_line_share": (0.05, 0.0),
}
_QUARTILES = (0.25, 0.5, 0.75)


def shares(rows: DataFrame) -> DataFrame:
    """The measures with what is fenced: shares that do not grow with a text's length."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    return rows.withColumns(
        {
            "word_length": F.col("word_chars") / words,
            "symbol_share": F.col("n_symbols") / words,
            "repeated_share": F.col("n_repeat_words") / words,
            "dup_line_share": F.col("n_dup_lines") / words,
        }
    )


def sketches(rows: DataFrame) -> DataFrame:
    """A sketch of each share per language and source, over the documents with words.

    Sketches of several loads can be put together (``unionByName``) and give the fences of all.
    """
    known = shares(rows.filter("n_words > 0"))
    measures = {name: F.floor(F.col(name) * MILLIONTHS).cast("bigint") for name in SLACK}
    return sketch(known, measures, ["lang", "source"])


def fences(made: DataFrame) -> DataFrame:
    """Per language and source the bounds ``<share>_low`` and ``<share>_high``.

    Quartiles of a group count by the number of its documents, those of its language as much as
    ``SHRINK`` more. A group's fence is never farther from the language's middle than twice the
    language's own fence, so a source full of junk does not make its own rules.
    """

    def quartiles(prefix: str, *keys: str) -> DataFrame:
        found = quantiles(made, {f"q{i}": q for i, q in enumerate(_QUARTILES)}, keys)
        at = lambda name, i: F.max(F.when(F.col("measure") == name, F.col(f"q{i}") / MILLIONTHS))
        columns = [at(name, i).alias(f"{prefix}{name}_{i}") for name in SLACK for i in range(len(_QUARTILES))]
        return found.groupBy(*keys).agg(F.max("many").alias(f"{prefix}many"), *columns)

    groups = quartiles("g_", "lang", "source")
    languages = quartiles("l_", "lang").withColumnRenamed("lang", "__lang")
    both = groups.join(languages, F.col("lang").eqNullSafe(F.col("__lang"))).drop("__lang")
    own = F.col("g_many") / (F.col("g_many") + SHRINK)
    bounds = []
    for name, (least, _) in SLACK.items():
        low, middle, high = (F.col(f"l_{name}_{i}") for i in range(3))
        wide = F.greatest(FENCE * (high - low), F.lit(least))
        g_low, g_high = (own * F.col(f"g_{name}_{i}") + (1 - own) * F.col(f"l_{name}_{i}") for i in (0, 2))
        g_wide = F.greatest(FENCE * (g_high - g_low), F.lit(least))
        bounds.append(F.greatest(g_low - g_wide, middle - 2 * (middle - low + wide)).alias(f"{name}_low"))
        bounds.append(F.least(g_high + g_wide, middle + 2 * (high - middle + wide)).alias(f"{name}_high"))
    return both.select("lang", "source", *bounds)


def judge(rows: DataFrame, bounds: DataFrame) -> DataFrame:
    """``rows`` (measures) with ``base_failed`` and ``kept``: within the fences of its language and source.

    A hot group is a skewed join, which Spark splits where it does not broadcast the few bounds.
    """
    limits = bounds.withColumnsRenamed({"lang": "__lang", "source": "__source"})
    same = F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source"))
    joined = shares(rows).join(limits, same, "left")
    root = F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))

    def outside(name: str) -> Column:
        more = SLACK[name][1] / root
        return (F.col(name) < F.col(f"{name}_low") - more) | (F.col(name) > F.col(f"{name}_high") + more)

    odd = F.coalesce(reduce(or_, map(outside, SLACK)), F.lit(False))
    return joined.select(*rows.columns, base_failed().alias("base_failed"), (~base_failed() & ~odd).alias("kept"))


def filter_quality(docs: DataFrame) -> DataFrame:
    """A row per document: ``doc_id``, ``lang``, ``source``, the measures, ``base_failed`` and ``kept``.

    Two runs give the same rows. Null and empty texts have no words and fail. Null languages and sources are groups like others; rows
    without ``doc_id`` and repeated ones are judged as any other.
    """
    rows = stored(measured(docs), "measures")
    return judge(rows, stored(fences(stored(sketches(rows), "sketches")), "fences"))
