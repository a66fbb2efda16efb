"""The pipeline: every stage against a plain version of its decision on its own input."""

from collections import Counter

import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from lakestar.llm import langid, pii, quality

from . import brute
from .test_tokens import check_packing


@pytest.fixture(scope="module")
def outputs(spark, sf_small):
    docs, out = spark.read.parquet(f"{sf_small}/documents.parquet"), []
    out.append(docs)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_small).checkpoint()
        out.append(docs)
    return out


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_columns_and_order(outputs):
    names = ["language_id", "quality_rules", "simhash_near_dedup", "personal_data", "best_fit_packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    for df in outputs[:-1]:
        assert df.columns == outputs[0].columns and df.dtypes == outputs[0].dtypes


def test_language_stage(spark, outputs):
    before, after = outputs[:2]
    scorer = langid.Scorer(langid.fit(before))
    expected = Counter(tuple(r) for r in before.collect() if (p := scorer.predict(r["text"] or "")) and p[0] != "und" and p[1] >= 0.5)
    assert rows_of(after) == expected and sum(expected.values()) > 0.9 * before.count()


def test_quality_stage(spark, outputs, sf_small):
    before, after = outputs[1:3]
    field = quality.fit(before, spark.read.parquet(f"{sf_small}/labels.parquet"))
    rows = before.collect()
    _, failed, kept, _ = quality.judge(field, [r["text"] or "" for r in rows])
    assert all(f == brute.base_counts(r["text"])[5] for f, r in zip(failed, rows) if len(r["text"] or "") < 20_000)
    assert rows_of(after) == Counter(tuple(r) for r, k in zip(rows, kept) if k)


def test_near_dedup_stage(outputs):
    before, after = outputs[2:4]
    parts = brute.near_dedup([(r["doc_id"], r["text"]) for r in before.collect()])
    stay = {k for k, _, c in parts if k == c}
    assert rows_of(after) == Counter(tuple(r) for r in before.collect() if r["doc_id"] in stay)


def test_personal_data_stage(outputs):
    before, after = outputs[3:5]
    expected = Counter()
    for r in before.collect():
        text = pii.masked(r["text"] or "", pii.find(r["text"] or ""))
        row = r.asDict() | ({"text": text, "n_chars": len(text)} if text != r["text"] else {})
        expected[tuple(row.values())] += 1
    assert rows_of(after) == expected


def test_packing_stage(outputs):
    assert check_packing(outputs[4], outputs[5].collect(), Tokenizer.from_file(P.path("byte_bpe_50k.json"))) > 0


def test_run_equals_the_stages(spark, outputs, sf_small):
    got = Counter(tuple(r)[:5] for r in __spark_entry__.queries()["pipeline"](spark, sf_small).collect())
    assert got == Counter(tuple(r)[:5] for r in outputs[5].collect())


def test_odd_and_empty_documents_pass_through_all_stages(spark, odd, empty, sf_small):
    for df in (odd, empty):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, sf_small).checkpoint()
        assert df.count() >= 0


def test_queries_are_registered():
    names = list(__spark_entry__.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
