import hashlib
import random
import time
import zlib

from lakestar.llm import periodic, queries

from .brute import WORD
from .conftest import SCHEMA, rows_of


def plain_runs(words, shortest=12):
    """All (start, length, period), period by period; a stretch within a found one of a divisor is no run of its own."""
    out = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, 2 * q):
                if not any(q % p == 0 and s <= i and s + n >= j + q for (s, p), n in out.items()):
                    out[i, q] = j + q - i
            i = max(i + 1, j)
    return sorted(((s, n, p) for (s, p), n in out.items()), key=lambda r: (r[0], r[2]))


def plain_collapsed(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def looped(key, words):
    h, n = zlib.crc32(str(key).encode()), len(words)
    if key is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_of_random_texts_equal_brute_force():
    rnd = random.Random(3)
    for _ in range(250):
        texts = []
        for _ in range(rnd.randint(1, 4)):
            words = [rnd.choice(rnd.choice(["ab", "abcd"])) for _ in range(rnd.randint(0, 70))]
            if words and rnd.random() < 0.5:
                a, p = rnd.randrange(len(words)), 1 + rnd.randrange(max(1, len(words) // 4))
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words)
        shortest = rnd.choice([2, 3, 5, 12])
        runs, of, collapsed = periodic.analysed([" ".join(t) for t in texts], shortest)
        for k, words in enumerate(texts):
            want = plain_runs(words, shortest)
            assert [tuple(r) for r in runs[of == k].tolist()] == want
            assert collapsed[k] == plain_collapsed(words, want)


def test_blocks_of_ordered_positions(monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK", 4)
    rnd = random.Random(4)
    for _ in range(30):
        words = [rnd.choice("aaab") for _ in range(300)]
        assert [tuple(r) for r in periodic.analysed([" ".join(words)], 12)[0].tolist()] == plain_runs(words)


def test_slices_of_long_texts(monkeypatch):
    words = ["x", "yy", "zzz"] * 40 + ["é", "ü"] * 9
    whole = periodic.analysed([" \n".join(words)], 12)
    monkeypatch.setattr(periodic, "SLICE", 7)
    cut = periodic.analysed([" \n".join(words)], 12)
    assert whole[0].tolist() == cut[0].tolist() and whole[2] == cut[2]


def test_a_text_of_one_word_repeated_is_fast():
    began = time.time()
    runs, _, collapsed = periodic.analysed(["a " * 300_000], 12)
    assert runs.tolist() == [[0, 300_000, 1]] and collapsed == ["a"]
    assert time.time() - began < 20


def contract_row(key, text):
    words = looped(key, WORD.findall(text or ""))
    runs = plain_runs(words)
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    return (
        key, len(runs), start, length, period, 1000 * length // period if runs else None,
        hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest(),
        hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
    )


def test_query_equals_brute_force(spark, documents, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = {r["doc_id"]: tuple(r) for r in queries.op13_periodic_runs(spark, sf_small).collect()}
    assert len(got) == len(rows)
    found = 0
    for key, text in rows:
        if len((text or "").split()) <= 2500:  # brute force is quadratic
            assert got[key] == contract_row(key, text)
            found += got[key][1] > 0
    assert found > 10


def test_odd_rows(spark, odd, empty, odd_texts):
    got = {r["doc_id"]: r for r in periodic.detected(odd).collect() if r["doc_id"] is not None}
    for k, text in enumerate(odd_texts):
        words = WORD.findall(text or "")
        if len(words) < 5000:
            want = plain_runs(words)
            assert [tuple(r) for r in got[k]["runs"]] == want
            assert got[k]["collapsed"] == plain_collapsed(words, want)
    assert [tuple(r) for r in got[8]["runs"]] == [(0, 60_000, 2)] and got[8]["collapsed"] == "the quick"
    assert periodic.detected(odd).count() == odd.count()
    assert periodic.detected(odd).where("doc_id is null").first()["collapsed"] == "no key"
    assert periodic.detected(empty).collect() == []
    assert periodic.detected(empty).columns == ["doc_id", "runs", "collapsed"]


def test_planted_loops(spark):
    keys = [k for k in range(400) if zlib.crc32(str(k).encode()) % 10 == 0][:12]
    texts = [" ".join(f"w{i}" for i in range(1 + 7 * j)) for j in range(11)] + [" \n\t "]
    rows = [(k, t, *r[2:]) for k, t, r in zip(keys, texts, rows_of(texts))]
    out = {r["doc_id"]: r["text"] for r in queries.with_loops(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k, t in zip(keys, texts):
        assert out[k].split() == looped(k, t.split())
