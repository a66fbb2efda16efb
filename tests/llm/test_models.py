"""Operators 8 and 9: exact counts against brute force, models by held-out accuracy."""

import itertools
import tracemalloc
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from lakestar.llm import langid, quality

from . import brute

LARGER = "/root/testdata/sf0.01"


def test_base_counts(odd_texts):
    for text in [t for t in odd_texts if t is None or len(t) < 50_000] + ["a b c a b c a", "x y\nx y\n\n \nx y", "a b c d e f a b c"]:
        n, chars, symbols, again, repeats, failed = brute.base_counts(text)
        assert quality.base_counts(text or "") == (n, chars, symbols, again, repeats)
        assert quality.base_failed(n, repeats) == failed


def test_viterbi_is_the_best_path():
    rnd = np.random.default_rng(2)
    field = quality.Field(rnd.standard_normal((quality.SIZE, 2)), rnd.standard_normal((2, 2)), rnd.standard_normal(2))
    docs = [rnd.integers(0, quality.SIZE, (n, quality.ACTIVE)) for n in (1, 7, 3, 0, 5, 7)]
    for doc, labels in zip(docs, quality.viterbi(field, docs)):
        if not len(doc):
            assert len(labels) == 0
            continue
        emit = field.emit[doc].sum(axis=1)

        def score(path):
            return field.start[path[0]] + sum(emit[t, s] for t, s in enumerate(path)) + sum(field.step[a, b] for a, b in zip(path, path[1:]))

        best = max(itertools.product((0, 1), repeat=len(doc)), key=score)
        assert np.isclose(score(best), score(tuple(labels)))


def test_gradient_is_that_of_the_likelihood():
    rnd = np.random.default_rng(6)
    docs = [rnd.integers(0, quality.SIZE, (n, quality.ACTIVE)) for n in (4, 2, 1)]
    label = np.array([0, 1, 1])
    active, lengths = quality._padded(docs)

    def likelihood(field):
        total = 0.0
        for doc, kind in zip(docs, label):
            emit = field.emit[doc].sum(axis=1)
            paths = [field.start[p[0]] + sum(emit[t, s] for t, s in enumerate(p)) + sum(field.step[a, b] for a, b in zip(p, p[1:])) for p in itertools.product((0, 1), repeat=len(doc))]
            own = field.start[kind] + emit[:, kind].sum() + field.step[kind, kind] * (len(doc) - 1)
            total += own - np.logaddexp.reduce(paths)
        return total

    field = quality.Field(0.1 * rnd.standard_normal((quality.SIZE, 2)), rnd.standard_normal((2, 2)), rnd.standard_normal(2))
    emit, step, start = quality._gradient(field, active, lengths, label)
    for part, slope, at in ((0, emit, (int(docs[0][0, 0]), 1)), (1, step, (0, 1)), (1, step, (1, 1)), (2, start, (0,))):
        moved = [w.copy() for w in field]
        moved[part][at] += 1e-6
        assert np.isclose((likelihood(quality.Field(*moved)) - likelihood(field)) / 1e-6, slope[at], atol=1e-4)


def test_documents_decoded_alone_and_together_agree(monkeypatch):
    rnd = np.random.default_rng(9)
    docs = [rnd.integers(0, quality.SIZE, (n, quality.ACTIVE)).astype(np.uint8) for n in (1, 2, 3, 0, *rnd.integers(1, 60, 40))]
    for scale in (0.0, 0.3, 2.0):  # 0: all paths are equal
        field = quality.Field(scale * rnd.standard_normal((quality.SIZE, 2)), scale * rnd.standard_normal((2, 2)), scale * rnd.standard_normal(2))
        found = []
        for few, lines in ((1, 65_536), (10**9, 65_536), (5, 100)):
            monkeypatch.setattr(quality, "FEW", few)
            monkeypatch.setattr(quality, "GROUP_LINES", lines)
            found.append([x.tolist() for x in quality.viterbi(field, docs)])
        assert found[0] == found[1] == found[2]
        assert [len(x) for x in found[0]] == [len(d) for d in docs]
        assert scale or not any(map(sum, found[0]))


def test_a_text_of_very_many_lines(monkeypatch):
    text = "ab\n" * 100_000 + "A line of content, with words.\n" * 1000 + "\n \n" * 50_000
    short = ["one line\nand another"] * 127
    tracemalloc.start()
    try:
        counts, *_ = quality.judge(quality.NEUTRAL, [*short, text])
        assert tracemalloc.get_traced_memory()[1] < 100e6
    finally:
        tracemalloc.stop()
    assert counts[-1] == (106_000, 200_000 + 25_000, 0, 100_998, 106_000)
    whole = quality.judge(quality.NEUTRAL, [text[:5000], "x y\n\nz"])
    monkeypatch.setattr(quality, "RUN_CHARS", 7)
    assert [m.tolist() for m in quality.measures(text[:500])] == [m.tolist() for m in quality._measured(quality.lines_of(text[:500]), set())]
    assert quality.judge(quality.NEUTRAL, [text[:5000], "x y\n\nz"]) == whole


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.read.parquet(f"{LARGER}/documents.parquet"), spark.read.parquet(f"{LARGER}/labels.parquet")


def test_quality_query_counts(odd, labelled, empty, spark):
    docs, labels = labelled
    for df in (odd, docs):
        got = Counter(tuple(r)[:7] for r in quality.judged(df, labels).collect())
        assert got == Counter((r["doc_id"], *brute.base_counts(r["text"])) for r in df.collect())
    none = labels.where("false")
    assert all(r["kept"] is not r["base_failed"] for r in quality.judged(docs, none).collect())  # nothing learned: content
    assert quality.judged(empty, labels).count() == 0
    assert quality.good(odd, labels).columns == odd.columns


def test_quality_held_out():
    rows = duckdb.sql(f"select text, quality from '{LARGER}/labels.parquet' join '{LARGER}/documents.parquet' using (doc_id) where text is not null order by doc_id").fetchall()
    learn, rest = rows[::2], rows[1::2]
    lines = [(quality.measures(t)[0], 1 - q) for t, q in learn if quality.lines_of(t)]
    field = quality.train([m for m, _ in lines], [q for _, q in lines])
    _, failed, kept, _ = quality.judge(field, [t for t, _ in rest])
    judged = [(k, bool(q)) for f, k, (_, q) in zip(failed, kept, rest) if not f]
    assert sum(k == q for k, q in judged) >= 0.97 * len(judged)


def test_language_held_out(spark, labelled):
    docs, _ = labelled
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    got = langid.identified(docs).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(truth.keys())
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)


def test_language_never_learns_from_the_held_out_fold(spark, labelled):
    docs, _ = labelled
    changed = docs.selectExpr("doc_id", "text", "case when crc32(cast(cast(doc_id as string) as binary)) % 4 = 2 then 'zz' else lang end lang")
    assert "zz" not in langid.fit(changed).languages
    assert {r["doc_id"]: r["lang_pred"] for r in langid.identified(changed).collect()} == {r["doc_id"]: r["lang_pred"] for r in langid.identified(docs).collect()}


def test_language_odd_rows(odd, empty):
    got = {(r["doc_id"], r["lang_pred"] == "und") for r in langid.identified(odd).collect()}
    assert got == {(r["doc_id"], not any(c.isalpha() for c in r["text"] or "")) for r in odd.collect()}
    assert langid.identified(empty).count() == 0
    unlabelled = odd.drop("lang").selectExpr("*", "cast(null as string) lang")
    assert {r["lang_pred"] for r in langid.identified(unlabelled).collect()} == {"und"}
    assert langid.with_language(odd).columns == odd.columns


def test_language_backs_off():
    log = lambda *p: np.log(np.array(p))
    model = langid.Model(["a", "b"], [{"known": log(0.9, 0.1)}, {"q": log(0.2, 0.8)}, {"<q": log(0.1, 0.9)}, {}, {"xyzw": log(0.7, 0.3)}], np.log(np.full((5, 2), 0.01)))
    scorer = langid.Scorer(model)
    assert scorer.predict("KNOWN")[0] == "a" and scorer.predict("xyzw")[0] == "a"
    assert scorer.predict("q")[0] == "b" and scorer.predict("12 ²½ !")[0] == "und"


def test_training_sample_is_bounded_in_lines(spark, monkeypatch):
    lengths = [200_000, *([3] * 700), 40_000, 40_000]
    groups = quality.grouped(lengths)
    assert sorted(i for g in groups for i in g) == list(range(len(lengths)))
    assert all(len(g) == 1 or len(g) * max(lengths[i] for i in g) <= quality.GROUP_LINES for g in groups)
    assert max(map(len, groups)) == 256
    docs = spark.createDataFrame([(i, "A line of some words.\n" * (500 if i == 3 else 4)) for i in range(12)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(12)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda docs, kinds: seen.append(sorted(map(len, docs))))
    quality.fit(docs, labels)
    quality.fit(docs, labels, lines=100)
    assert seen == [[4] * 11 + [500], [4] * 11]


def test_language_model_keeps_the_top_entries_of_every_language(spark):
    free = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 4 != 2]
    text = " ".join(["alpha"] * 2500 + ["beta"] * 2400 + ["gamma"] * 2300 + ["delta"] * 4)
    docs = spark.createDataFrame([(free[0], text, "aa"), (free[1], "one two three four", "bb")], "doc_id long, text string, lang string")
    model = langid.fit(docs, entries=2)
    assert model.languages == ["aa", "bb"]
    learned = {lang: {w for w, scores in model.known[0].items() if scores[i] > scores[1 - i]} for i, lang in enumerate(model.languages)}
    assert learned["aa"] == {"alpha", "beta"} and learned["bb"] == {"four", "one"}  # of equal counts the first by name
    many = spark.createDataFrame([(free[i], f"common w{chr(97 + i % 26)}{chr(97 + i // 26)}", f"l{i:03}") for i in range(520)], "doc_id long, text string, lang string")
    assert langid.fit(many).languages == [f"l{i:03}" for i in range(520)]
