from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from hackney.llm import fingerprints as fp
from hackney.llm import queries
from tests.conftest import SF_DIR
from tests.llm.helpers import ODD, documents, edited, prose


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_edits(rows):
    """(doc_id, text, edited, next) for rows with ids that differ."""
    order = sorted(rows, key=lambda r: -r[0])
    out = []
    for k, (i, t) in enumerate(order):
        t, other = t or "", order[(k + 1) % len(order)][1] or ""
        half = len(t) // 2
        out.append((i, t, t[: len(t) - half] + other[:half], other))
    return out


def check(found, rows):
    want = {i: (len(t), hashlib.sha256(e.encode()).hexdigest(), t, e, o) for i, t, e, o in plain_edits(rows)}
    got = {r.doc_id: r for r in found}
    assert len(found) == len(want) and set(got) == set(want)
    errors = []
    for i, (n, sha, t, e, o) in want.items():
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        errors += [r.near_edited - jaccard(t, e), r.near_next - jaccard(t, o)]
    assert sum(map(abs, errors)) / len(errors) < 0.03 and abs(sum(errors)) / len(errors) < 0.01
    assert max(map(abs, errors)) < 0.25
    return got


def test_query_on_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op1_fingerprints"](spark, SF_DIR).collect()
    got = check(found, [(r.doc_id, r.text) for r in docs])
    by_text = {}
    for r in docs:
        assert by_text.setdefault(r.text, got[r.doc_id].fingerprint) == got[r.doc_id].fingerprint
    assert all(len(r.fingerprint) == fp.BINS for r in found)


def test_likeness_is_unbiased(spark):
    rng, pairs = random.Random(4), []
    for n in range(300):
        text = prose(n, rng.choice([8, 40, 120, 600]), 10**6)
        pairs.append((text, edited(text, n, rng.choice([0, 1, 3, 10, 40]))))
    df = spark.createDataFrame(pairs, "a string, b string")
    found = df.select(fp.likeness(fp.fingerprint(F.col("a")), fp.fingerprint(F.col("b"))).alias("near")).collect()
    errors = [r.near - jaccard(a, b) for r, (a, b) in zip(found, pairs)]
    assert abs(sum(errors)) / len(errors) < 0.01 and sum(map(abs, errors)) / len(errors) < 0.035


def plain_fingerprint(hashes, order):
    """Bins and digits, one by one; ``order`` gives the hash of two numbers."""
    least = {}
    for h in hashes:
        b = (h >> 56) + 128
        least[b] = min(h, least.get(b, h))
    digits = ""
    for b in range(256):
        tried = [b, *(order[b, k] & 255 for k in range(1, 9)), *sorted(least, key=lambda n: order[b, n] & -256)]
        digits += f"{least[next(x for x in tried if x in least)] & 15:x}"
    return digits


def test_empty_bins_follow_their_own_order(spark):
    bins = spark.range(256).selectExpr("CAST(id AS INT) AS b")
    pairs = bins.crossJoin(bins.withColumnRenamed("b", "n")).selectExpr("*", "xxhash64(b, n) AS h")
    order = {(r.b, r.n): r.h for r in pairs.collect()}
    texts = spark.createDataFrame([(prose(n, n, 500),) for n in [*range(1, 60, 7), 200, 1500]], "text string")
    rows = texts.select(fp._hashes(F.col("text"), 5).alias("h"), fp.digits(fp.fingerprint(F.col("text"))).alias("d")).collect()
    for r in rows:
        assert r.d == plain_fingerprint(r.h, order)


def test_odd_rows(spark):
    rows = ODD + [(3, "a different text with the same number"), (8, "one two three four five six")]
    df = documents(spark, rows)
    found = fp.compare_with_edited(df).collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter((i, t or "") for i, t in rows)
    at = {(r.doc_id, r.text): r for r in found}
    nobody = at[None, "a text without an identity, of some more words"]
    assert nobody.near_next == 0 and nobody.edited == nobody.text[: len(nobody.text) - len(nobody.text) // 2]
    assert at[None, ""].near_next == 1 and at[None, ""].packed == []
    assert at[1, ""].near_next == 0 and at[2, ""].near_next == 1
    # Rows with equal ids follow each other by their texts.
    same = [r for r in found if r.doc_id == 3]
    assert sorted(r.edited for r in same) == sorted(
        ["a different text wi" + "alpha", "alp" + "al", "alp"]
    )


def test_ranges_do_not_change_what_follows(spark):
    rng = random.Random(1)
    ids = rng.sample(range(10**6), 300) + rng.sample(range(2**60, 2**61), 30) + [-5, -(2**62)]
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id bigint, text string")
    order = sorted(ids, reverse=True)
    want = {i: f"t{order[(k + 1) % len(order)]}" for k, i in enumerate(order)}
    for ranges in (1, 2, 7, 64):
        found = fp.with_next(df, "doc_id", ["text"], ranges).collect()
        assert {r.doc_id: r.next.text for r in found} == want and len(found) == len(ids)


def test_partitions_get_as_many_rows(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    try:
        df = spark.range(0, 52_000, 1, 4).selectExpr("id * 7 AS doc_id", "concat('t', id) AS text")
        found = fp.with_next(df, "doc_id", ["text"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(sizes) == 13 and max(sizes) < 1.2 * sum(sizes) / 13
    # The rows move once.
    assert plan.count("Exchange hashpartitioning") == 1


def test_one_and_no_documents(spark):
    one = fp.compare_with_edited(documents(spark, [(5, "abcdef")])).collect()
    assert [r.edited for r in one] == ["abcabc"] and one[0].near_next == 1
    assert fp.compare_with_edited(documents(spark, [])).count() == 0


def test_plan_has_no_python(spark):
    plan = queries.QUERIES["op1_fingerprints"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
