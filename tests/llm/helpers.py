"""Small tables for the operators' tests."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: What every operator must bear: no text, no id, repeated rows, one word, white space alone, very long texts.
ODD = [
    (1, None),
    (2, ""),
    (3, "alpha"),
    (3, "alpha"),
    (4, " \t\n\x0b "),
    (None, "a text without an identity, of some more words"),
    (None, None),
    (5, "naïve Ünïcode – text\nwith “lines” 🙂\n\nand lines"),
    (6, "long " * 60_000),
    (7, "x" * 200_000),
]


def documents(spark, rows):
    """``rows`` of (doc_id, text) as documents, with columns that clash with names used inside."""
    full = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.selectExpr("*", "1 AS fp", "'x' AS fingerprint", "2 AS block", "'y' AS piece", "3 AS hash", "4 AS score")


def prose(seed: int, words: int, vocabulary: int = 3000) -> str:
    rng = random.Random(seed)
    out = [f"w{int(rng.random() ** 2 * vocabulary)}" for _ in range(words)]
    return " ".join(w + ("\n" if rng.random() < 0.05 else "") for w in out)


def edited(text: str, seed: int, times: int) -> str:
    rng, words = random.Random(seed), text.split(" ")
    for _ in range(times):
        words[rng.randrange(len(words))] = f"z{rng.randrange(10**6)}"
    return " ".join(words)
