from __future__ import annotations

import hashlib
import random
import re
import unicodedata
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from hackney.llm import bpe, queries
from tests.conftest import SF_DIR
from tests.llm.helpers import ODD, documents

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={}
)
CODER, DECODER = bpe.Coder(PATH), bpe.Decoder(PATH)
TEXTS = st.text() | st.text("ab 1'strevlmd\n\t\xa0!?é ") | st.text(st.characters(categories=["Zs", "Lu", "Nd", "Po", "Cc"]))


@settings(max_examples=500, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_ids_words_and_decoding(texts):
    for text, (ids, offsets) in zip(texts, CODER.encode([t.encode() for t in texts]), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode_ordinary(text)
        assert DECODER.decode(ids) == text.encode()
        words = regex.findall(public_tokenizers.PATTERN, text)
        if all(unicodedata.category(c) != "Cn" for c in text):  # of those the two libraries here think differently
            assert len(offsets) == len(words)
            raw = offsets.astype("<u4").tobytes()
            assert [DECODER.words(ids, raw, i, i + 1).decode() for i in range(len(words))] == words


@settings(max_examples=150, deadline=None)
@given(st.text("ab 1's\n\xa0é", max_size=80))
def test_windows_do_not_change_words(text):
    before, bpe.WINDOW = bpe.WINDOW, 7
    try:
        ids, offsets = bpe.Coder(PATH).encode([text.encode()])[0]
    finally:
        bpe.WINDOW = before
    plain, places = CODER.encode([text.encode()])[0]
    assert ids == plain and offsets.tolist() == places.tolist()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 20), st.integers(1, 700))
def test_scan_is_the_composition_one_by_one(seed, n):
    _, by_symbol, compose, *_ = bpe._tables()
    functions = by_symbol[np.random.default_rng(seed).integers(0, 16, n)]
    got, now = bpe.scan(functions, compose), 0
    for f, g in zip(functions, got):
        now = compose[now, f]
        assert g == now


@pytest.mark.parametrize("word", [b"x" * 5000, b"abab" * 400, " déjà".encode() * 90, bytes(range(256)) * 3])
def test_long_words(word):
    ids = bpe.merge(word, bpe.read_ranks(PATH))
    assert ids == LIBRARY._core_bpe.encode_single_piece(word)


def digest(text):
    ids = np.array(LIBRARY.encode_ordinary(text or ""), "<u4")
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_odd_rows_and_no_rows(spark):
    rng = random.Random(0)
    rows = ODD + [(50, "".join(rng.choice("ab '\n1é🙂") for _ in range(5000)))]
    found = bpe.decode(bpe.encode(documents(spark, rows), PATH), PATH).collect()
    got = Counter((r.doc_id, bytes(r.ids), bytes(r.bytes)) for r in found)
    want = [(i, np.array(LIBRARY.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    assert got == Counter(want)
    assert bpe.encode(documents(spark, []), PATH).count() == 0


def test_query_over_the_whole_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    found = queries.QUERIES["op10_byte_bpe"](spark, SF_DIR).collect()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found}
    assert got == {r.doc_id: digest(r.text) for r in docs}


def test_no_regular_expression():
    assert not re.search(r"^(import|from) (re|regex)\b", open(bpe.__file__).read(), re.M)
