"""The registered queries of these operators: each over its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hackney.llm import bpe, decontaminate, fingerprints, licenses, lines, lm, packing, quality, secrets, simhash, spelling, toxicity, whitening
from hackney.llm.sql import SQL as SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.compare_with_edited(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.digits(F.col("packed")).alias("fingerprint"),
        fingerprints.digits(F.col("edited_packed")).alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


def op2_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents")).drop("spans")


def op4_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets.find_secrets(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [r.kind for r in secrets.BASE]

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def many(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *(many(kind) for kind in base),
        F.sha2(told(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        told(F.col("spans")).alias("spans"),
    )


def op5_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.filter_quality(_table(spark, sf_dir, "documents")).drop("lang", "source")


def op6_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    placed = packing.placements(_table(spark, sf_dir, "documents"), tokenizer)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_masked_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.fit_and_score(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.dedupe_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kept = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return found.select("doc_id", "n_lines", "n_dropped", kept)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents"), ranks), ranks)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(_table(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def whitened(embeddings: DataFrame) -> DataFrame:
    """A row per vector and component."""
    rows, model = whitening.whiten(embeddings)
    k = 0 if model is None else len(model.values)
    error = whitening.identity_error(rows, model.n, k) if k else 0.0
    shares = F.array(*map(F.lit, model.explained.tolist())) if k else F.array().cast("array<double>")
    every = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return every.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n if model else 0).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(_table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_fingerprints, op2_simhash_components, op3_license_templates, op4_secret_ledger, op5_adaptive_quality, op6_toxic_segments, op7_best_fit_packing, op8_masked_lm, op9_line_dedup, op10_byte_bpe, op11_spelling_variants, op12_decontamination, op13_embedding_whitening)}
