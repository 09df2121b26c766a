from __future__ import annotations

import math
import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hackney.llm import quality, queries
from tests.conftest import SF_DIR
from tests.llm.helpers import ODD, SCHEMA, documents


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
    )


@settings(max_examples=400, deadline=None)
@given(st.text("ab \n#é\x0b\x1c") | st.text() | st.lists(st.sampled_from("abc"), max_size=60).map(" ".join))
def test_measures(text):
    assert quality.measure(text.encode()) == plain(text)


def test_odd_rows_and_no_rows(spark):
    rows = ODD + [(20, "a b c d e f g h i " * 40)]
    found = quality.filter_quality(documents(spark, rows).withColumn("kept", F.lit(3))).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found)
    assert got == Counter((i, *plain(t)) for i, t in rows)
    assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) for r in found)
    assert not any(r.kept and r.base_failed for r in found)
    assert quality.filter_quality(documents(spark, [])).count() == 0


def test_fences_follow_languages_and_sources(spark):
    rng, rows = random.Random(2), []

    def add(text, lang, source):
        rows.append((len(rows), text, lang, source, len(text)))

    def text(size):
        return " ".join("".join(rng.choices("abcdef", k=size + rng.randrange(-1, 2))) for _ in range(200))

    for _ in range(150):
        add(text(5), "en", "a")
        add(text(12), "zz", "a")
        add(text(5), None, None)
    add(text(12), "en", "a")
    add(text(5), "zz", "a")
    add(text(12), None, None)
    odd = {len(rows) - 3, len(rows) - 2, len(rows) - 1}
    add(text(5), "qq", "alone")
    for _ in range(120):
        add("||| " * 100 + text(5), "en", "junk")
    junk = set(range(len(rows) - 120, len(rows)))
    for _ in range(600):
        add(text(5), "en", "b")
    found = quality.filter_quality(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id for r in found if not r.kept} - {r.doc_id for r in found if r.base_failed} >= odd
    assert {r.doc_id for r in found if r.kept}.isdisjoint(junk)
    assert {r.doc_id for r in found if r.kept} == set(range(len(rows))) - odd - junk


def test_sketches_merge(spark):
    rows = quality.measured(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    whole = quality.fences(quality.sketches(rows))
    halves = [quality.sketches(rows.filter(f"doc_id % 2 = {k}")) for k in (0, 1)]
    merged = quality.fences(halves[0].unionByName(halves[1]))
    key = lambda r: (r.lang, r.source)
    a, b = sorted(whole.collect(), key=key), sorted(merged.collect(), key=key)
    assert a == b


def plain_level(number):
    cut = max(0, number.bit_length() - 8)
    return number >> cut << cut


def plain_quartiles(numbers):
    ranked = sorted(map(plain_level, numbers))
    return [ranked[max(0, math.ceil(len(ranked) * q) - 1)] / 1e6 for q in (0.25, 0.5, 0.75)]


def plain_kept(rows):
    """The verdict on (doc_id, text, lang, source), from the definition of fences."""
    slack = quality.SLACK
    measures, groups, languages = [], {}, {}
    for _, text, lang, source in rows:
        n, chars, symbols, lines, repeated = plain(text)
        m = max(n, 1)
        measures.append((n, dict(zip(slack, (chars / m, symbols / m, repeated / m, lines / m))), repeated))
        if n:
            groups.setdefault((lang, source), []).append(measures[-1][1])
            languages.setdefault(lang, []).append(measures[-1][1])
    out = []
    for (_, _, lang, source), (n, shares, repeated) in zip(rows, measures):
        kept = not (n < 20 or 100 * repeated > 30 * n)
        for name, (least, more) in slack.items() if n else ():
            g, l = ([plain_quartiles([math.floor(x[name] * 1_000_000) for x in some]) for some in (groups[lang, source], languages[lang])])
            own = len(groups[lang, source]) / (len(groups[lang, source]) + 100)
            wide = max(3 * (l[2] - l[0]), least)
            low, high = (own * g[i] + (1 - own) * l[i] for i in (0, 2))
            g_wide = max(3 * (high - low), least)
            low, high = max(low - g_wide, l[1] - 2 * (l[1] - l[0] + wide)), min(high + g_wide, l[1] + 2 * (l[2] - l[1] + wide))
            kept &= low - more / math.sqrt(n) <= shares[name] <= high + more / math.sqrt(n)
        out.append(kept)
    return out


def test_the_whole_query_against_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs]
    want = dict(zip((r[0] for r in rows), plain_kept(rows)))
    runs = [queries.QUERIES["op5_adaptive_quality"](spark, SF_DIR).collect() for _ in range(2)]
    assert {r.doc_id: r.kept for r in runs[0]} == want and 0 < sum(want.values()) < len(want)
    assert sorted(runs[0]) == sorted(runs[1])


def test_two_runs_agree_on_large_groups(spark):
    """Beyond the size at which sampling sketches begin to draw lots, and dealt in another way."""
    rows = spark.range(120_000).selectExpr(
        "id AS doc_id", "'en' AS lang", "'a' AS source", "50 + id % 100 AS n_words", "300 + (id * 7919) % 500 AS word_chars",
        "(id * 31) % 3 AS n_symbols", "id % 2 AS n_dup_lines", "(id * 17) % 15 AS n_repeat_words",
    )
    found = [quality.fences(quality.sketches(x)).collect() for x in (rows, rows.repartition(13, "word_chars"))]
    assert found[0] == found[1]


def test_query_keeps_clean_documents_and_drops_junk(spark):
    sf_dir = "/root/testdata/sf0.1"
    found = queries.QUERIES["op5_adaptive_quality"](spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    rows = found.join(labels, "doc_id").filter("NOT base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")))
    share = dict(rows.collect())
    assert share[1] > 0.99 and share[0] < 0.1


def test_query_measures_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op5_adaptive_quality"](spark, SF_DIR).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found}
    assert got == {r.doc_id: plain(r.text) for r in docs} and len(found) == len(docs)
