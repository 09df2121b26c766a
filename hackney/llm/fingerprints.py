"""Document fingerprints: one-permutation MinHash in packed low bits, by Spark's own functions.

Each shingle is hashed once. The hash's upper bits name one of ``BINS`` bins and the lower bits are its
value there; a bin keeps its smallest value. An empty bin copies one that is not, which it finds by trying
bins in a random order of its own, the same for all documents (optimal densification): first ``TRIES`` bins by
hashes of its number, then those with a value by the hash of both numbers. Of each bin the ``BITS`` lowest
bits are kept. Bins of different values agree by chance in one of ``2**BITS`` cases, which the likeness
corrects.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SHINGLE = 5
BIN_BITS = 8
BINS = 1 << BIN_BITS
BITS = 4
TRIES = 8
#: Ranges of ``doc_id`` per shuffle partition.
RANGES = 8
WORDS = "[\\x20\\x09-\\x0D]+"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value made once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _hashes(text: Column, shingle: int) -> Column:
    """A hash per shingle of words; fewer words are one shingle, and none have none."""
    words = F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), WORDS, -1)

    def grams(codes: Column) -> Column:
        whole = F.array(F.aggregate(codes, F.lit(42).cast("bigint"), lambda a, c: F.xxhash64(a, c)))
        starts = F.slice(codes, F.lit(1), F.size(codes) - (shingle - 1))
        each = F.transform(starts, lambda c, i: F.xxhash64(c, *(F.get(codes, i + k) for k in range(1, shingle))))
        return F.when(F.size(codes) <= shingle, whole).otherwise(each)

    none = F.array().cast("array<bigint>")
    coded = lambda w: _let(F.transform(w, lambda x: F.xxhash64(x)), grams)
    return _let(words, lambda w: F.when(F.get(w, 0) == "", none).otherwise(coded(w)))


def _bins(hashes: Column) -> Column:
    """The smallest hash of each bin that has one; the bin is the hash's upper bits."""
    number = lambda h: F.shiftright(h, 64 - BIN_BITS)
    return _let(
        F.sort_array(hashes),
        lambda s: F.filter(s, lambda h, i: (i == 0) | (number(h) != number(F.get(s, i - 1)))),
    )


def _packed(least: Column) -> Column:
    """The low bits of all bins, the empty ones filled, sixteen in a BIGINT."""

    number = lambda h: F.shiftright(h, 64 - BIN_BITS).cast("int") + BINS // 2

    def places(full: Column) -> Column:
        """For every bin the place of its value in ``full``, or -1: gaps between the bins that have one."""
        gap = lambda h, i: number(h) - F.when(i == 0, F.lit(-1)).otherwise(number(F.get(full, i - 1))) - 1
        some = F.transform(full, lambda h, i: F.concat(F.array_repeat(F.lit(-1), gap(h, i)), F.array(i)))
        rest = F.array_repeat(F.lit(-1), BINS - 1 - number(F.element_at(full, -1)))
        return F.concat(F.flatten(some), rest)

    def value(full: Column, at: Column, place: Column, b: Column) -> Column:
        def attempt(found: Column, k: Column) -> Column:
            other = F.xxhash64(b, k).bitwiseAND(F.lit(BINS - 1)).cast("int")
            return F.when(found >= 0, found).otherwise(F.get(at, other))

        tried = F.aggregate(F.sequence(F.lit(1), F.lit(TRIES)), F.lit(-1), attempt)
        # After that the bin with the lowest hash; the hash's lowest bits make room for its place.
        order = lambda h, i: F.xxhash64(b, number(h)).bitwiseAND(F.lit(-BINS)).bitwiseOR(i.cast("bigint"))
        lowest = F.array_min(F.transform(full, order)).bitwiseAND(F.lit(BINS - 1)).cast("int")
        filled = _let(tried, lambda t: F.when(t >= 0, t).otherwise(lowest))
        chosen = F.when(place >= 0, place).otherwise(filled)
        return F.get(full, chosen).bitwiseAND(F.lit((1 << BITS) - 1))

    def fill(full: Column) -> Column:
        return _let(places(full), lambda at: F.transform(at, lambda place, b: value(full, at, place, b)))

    def word(values: Column, w: Column) -> Column:
        part = F.slice(values, w * 16 + 1, F.lit(16))
        return F.aggregate(part, F.lit(0).cast("bigint"), lambda a, v: F.shiftleft(a, BITS).bitwiseOR(v))

    words = F.sequence(F.lit(0), F.lit(BINS // 16 - 1))
    none = F.array().cast("array<bigint>")
    packed = _let(_let(least, fill), lambda values: F.transform(words, lambda w: word(values, w)))
    return F.when(F.size(least) == 0, none).otherwise(packed)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """``BINS * BITS`` bits in an array of BIGINT, which is empty if there is no word. Null is as empty."""
    return _let(_bins(_hashes(F.coalesce(text, F.lit("")), shingle)), _packed)


def digits(packed: Column) -> Column:
    """A fingerprint as a string of hexadecimal digits, one per bin."""
    return F.array_join(F.transform(packed, lambda w: F.lower(F.lpad(F.hex(w), 16, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """The estimated share of common shingles (0 to 1): equal bins, less those that agree by chance.

    Without words a text is like another without words (1) and unlike all others (0).
    """

    def differing(x: Column) -> Column:
        """How many of the sixteen bins of a word differ."""
        some = reduce(lambda y, k: y.bitwiseOR(F.shiftrightunsigned(x, k)), range(1, BITS), x)
        return F.bit_count(some.bitwiseAND(F.lit(0x1111111111111111)))

    apart = F.zip_with(a, b, lambda x, y: differing(x.bitwiseXOR(y)))
    same = BINS - F.aggregate(apart, F.lit(0), lambda n, x: n + x)
    chance = 1 / (1 << BITS)
    estimate = F.greatest(F.lit(0.0), (same / BINS - chance) / (1 - chance))
    both = (F.size(a) > 0) & (F.size(b) > 0)
    return F.when(both, estimate).otherwise((F.size(a) == F.size(b)).cast("double"))


def _numbers(values: list[int]) -> Column:
    """A literal array, without a call per number."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _keys_of_partitions(spark: SparkSession, parts: int) -> list[int]:
    """For each of so many partitions a number that Spark's hash puts there."""
    found: dict[int, int] = {}
    tried = 0
    while len(found) < parts:
        more = spark.range(tried, tried + 16 * parts, 1, 1).select("id", F.pmod(F.hash("id"), F.lit(parts)).alias("part"))
        for r in more.groupBy("part").agg(F.min("id").alias("id")).collect():  # a row per partition
            found.setdefault(r["part"], r["id"])
        tried += 16 * parts
    return [found[i] for i in range(parts)]


def with_next(docs: DataFrame, id_column: str, columns: list[str], ranges: int | None = None) -> DataFrame:
    """``docs`` with ``next``, a struct of the id and ``columns`` of the row that follows by descending id, round.

    The ids are cut into ranges of about equal numbers of rows, which are sorted each on its own. The
    first rows of the range below stand in as guests behind the last of a range, so each row finds what
    follows. Only the ranges' bounds and largest ids come to the driver. Rows with equal ids follow each
    other in the order of ``columns``; a row without id has no place: its ``next`` is null, and it is no row's.
    """
    spark, own = docs.sparkSession, F.col(id_column)
    ranges = ranges or RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = docs.filter(own.isNotNull())
    shares = [i / ranges for i in range(1, ranges)]
    bounds = placed.agg(F.percentile_approx(id_column, shares, 20 * ranges).alias("b")).first()["b"] if shares else []
    bounds = sorted(set(bounds or []))
    number = F.lit(0).cast("bigint")
    if bounds:
        # Two short searches instead of a long one: which group of bounds, and where in it.
        group = max(1, round(len(bounds) ** 0.5))
        coarse = F.filter(_numbers(bounds[group - 1 :: group]), lambda b: b <= own)
        skipped = F.size(coarse) * group
        fine = F.filter(F.slice(_numbers(bounds), skipped + 1, F.lit(group)), lambda b: b <= own)
        number = (skipped + F.size(fine)).cast("bigint")
    placed = placed.withColumn("__range", number)
    heads = dict(map(tuple, placed.groupBy("__range").agg(F.max(id_column)).collect()))
    if not heads:
        heads = {0: 0}
    used = sorted(heads)
    # The range above each; the lowest comes after the highest.
    above = dict(zip(used, [*used[1:], used[0]]))
    every = range(used[-1] + 1)
    head = F.get(_numbers([heads.get(r, 0) for r in every]), F.col("__range").cast("int"))
    host = F.get(_numbers([above.get(r, 0) for r in every]), F.col("__range").cast("int"))
    goes = F.array(F.struct(F.col("__range").alias("range"), F.lit(False).alias("guest")))
    guest = F.array(F.struct(host.alias("range"), F.lit(True).alias("guest")))
    rows = placed.withColumn("__goes", F.explode(F.when(own == head, F.concat(goes, guest)).otherwise(goes)))
    rows = rows.withColumns({"__range": F.col("__goes.range"), "__guest": F.col("__goes.guest")}).drop("__goes")
    # Range after range to partition after partition, so that each has as many; a hash of the number would deal unevenly.
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), used[-1] + 1)
    keys = _numbers(_keys_of_partitions(spark, parts))
    rows = rows.withColumn("__part", F.get(keys, (F.col("__range") % parts).cast("int"))).repartition(parts, "__part")
    window = Window.partitionBy("__part", "__range").orderBy("__guest", own.desc(), *columns)
    # Column by column: a struct of them would be made, and shuffled, beside the columns themselves.
    follows = F.struct(*(F.lead(c).over(window).alias(c) for c in (id_column, *columns)))
    rows = rows.withColumn("next", follows).filter("NOT __guest").drop("__guest", "__range", "__part")
    return rows.unionByName(docs.filter(own.isNull()).withColumn("next", F.lit(None).cast(rows.schema["next"].dataType)))


def compare_with_edited(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """Each text, its edited text and the next document, by their fingerprints.

    Returns ``doc_id``, ``n_chars`` (code points), ``text``, ``edited``, ``packed`` and ``edited_packed``
    (fingerprints), ``near_edited`` and ``near_next``. In the edited text the last half (rounded down)
    of the code points is replaced by the first as many, or all, of the next document by descending
    ``doc_id``; after the last comes the first. A null text is empty. A row without ``doc_id`` has an
    empty text as its next; rows with equal ``doc_id`` follow each other by their texts.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("packed", fingerprint(F.col("text"), shingle)), "doc_id", ["text", "packed"])
    size = F.char_length("text")
    half = F.floor(size / 2).cast("int")
    other = F.coalesce("next.text", F.lit(""))
    edited = F.concat(F.substr("text", F.lit(1), size - half), F.substr(other, F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_packed", fingerprint(F.col("edited"), shingle))
    none = F.array().cast("array<bigint>")
    return rows.select(
        "doc_id",
        size.cast("bigint").alias("n_chars"),
        "text", "edited", "packed", "edited_packed",
        likeness(F.col("packed"), F.col("edited_packed")).alias("near_edited"),
        likeness(F.col("packed"), F.coalesce("next.packed", none)).alias("near_next"),
    )
