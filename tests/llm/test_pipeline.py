"""Each stage against a plain version of it, on the input that it gets; and all of them together."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from hackney.llm import simhash, toxicity
from tests.conftest import SF_DIR
from tests.llm import test_lines, test_packing, test_secrets, test_simhash
from tests.llm.helpers import ODD, documents, edited, prose


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def plain_groups(rows):
    prints = sorted({test_simhash.plain_fingerprint(t) for _, t in rows})
    root = dict(zip(prints, test_simhash.plain_components(prints)))
    out: dict[int, list] = {}
    for i, t in rows:
        out.setdefault(root[test_simhash.plain_fingerprint(t)], []).append((i, t))
    return list(out.values())


@pytest.fixture(scope="module")
def stages(spark):
    """Name of each stage: its input and its output."""
    out, docs = {}, spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        made = corpus_pipeline.stored(stage(spark, docs, SF_DIR), name)
        out[name] = (docs, made)
        docs = made
    return out


def test_stages_and_columns(stages):
    assert list(stages) == ["toxicity", "line_dedup", "simhash_near_dedup", "secret_scans", "best_fit_packing"]
    for before, _ in stages.values():
        assert [f.simpleString() for f in before.schema] == [
            "doc_id:bigint", "text:string", "lang:string", "source:string", "n_chars:bigint",
        ]
    for name in ("line_dedup", "secret_scans"):
        assert all(r.n_chars == len(r.text) for r in stages[name][1].collect())


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    before, after = stages["toxicity"]
    model = toxicity.fit(before, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = {r.doc_id for r in toxicity.score(before, model).collect() if r.score < 0.7}
    assert sorted(rows_of(after)) == sorted((i, t) for i, t in rows_of(before) if i in kept)
    assert 0 < before.count() - after.count() < 0.2 * before.count()


def test_repeated_lines_go(stages):
    before, after = stages["line_dedup"]
    want = Counter({(i, kept): n for (i, _, _, kept), n in test_lines.plain(rows_of(before)).items()})
    assert Counter(rows_of(after)) == want


def test_one_of_each_group_stays(stages):
    before, after = stages["simhash_near_dedup"]
    assert sorted(rows_of(after)) == sorted(min(group) for group in plain_groups(rows_of(before)))
    assert after.count() < before.count()


def test_secrets_are_replaced(stages):
    before, after = stages["secret_scans"]
    kept = dict(rows_of(after))
    assert len(kept) == before.count()
    for i, text in rows_of(before):
        spans = test_secrets.plain_base(text)
        assert ("[SECRET]" in kept[i]) >= bool(spans)
        assert not test_secrets.plain_base(kept[i])
        if not spans and "[SECRET]" not in kept[i]:
            assert kept[i] == text


def test_everything_is_packed(stages):
    before, after = stages["best_fit_packing"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    test_packing.check(after.collect(), rows_of(before), library)


def test_keys_that_share_lines_are_redacted(spark):
    keys = [["-----BEGIN PRIVATE KEY-----", *test_secrets.body(n, 5), "-----END PRIVATE KEY-----"] for n in range(3)]
    docs = documents(spark, [(n, prose(n, 50) + "\n" + "\n".join(key) + "\nend") for n, key in enumerate(keys)])
    for stage in (corpus_pipeline.drop_repeated_lines, corpus_pipeline.redact_secrets):
        docs = stage(spark, docs, "")
    left = dict(rows_of(docs))
    assert all("[SECRET]" in left[n] and not any(x in left[n] for x in key[:-2]) for n, key in enumerate(keys))


def test_odd_rows_pass_through(spark):
    rows = ODD + [(60 + n, edited(prose(1, 300), n, 1)) for n in range(5)]
    docs = documents(spark, rows)
    groups = plain_groups(rows)
    kept = rows_of(simhash.one_of_each(docs))
    assert len(kept) == len(groups)
    for group in groups:
        named = [i for i, _ in group if i is not None]
        mine = [i for i, t in kept if (i, t) in group]
        assert mine == [min(named, default=None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id bigint, toxic int")
    for some in (docs, documents(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            if name == "toxicity":
                some = toxicity.score(some, toxicity.fit(some, labels)).select(*corpus_pipeline.COLUMNS)
            else:
                some = stage(spark, some, "")
        assert (some.count() > 0) == (docs is not None and some.count() > 0)


def test_run(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(columns).collect())) == sorted(
        map(tuple, stages["best_fit_packing"][1].select(columns).collect())
    )
