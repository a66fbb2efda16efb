import random
import re
import zlib
from collections import Counter

import pytest

from lakestar.llm import queries, spelling

from .conftest import SCHEMA, rows_of


def lower(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_groups(rows, shortest=5, least=3, ratio=2, rewrite=None):
    """{word: (n, n_near, form, form_n, root)} by comparing each word with every other."""
    counts = Counter()
    for key, text in rows:
        for word in map(lower, re.findall("[A-Za-zÀ-ÿ]+", text or "")):
            counts[rewrite(key, word) if rewrite and key is not None else word] += 1
    words = {w: n for w, n in counts.items() if len(w) >= shortest and n >= least}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    near, form = {}, {}
    for w, n in words.items():
        found = [x for k in (-1, 0, 1) for x in by_size.get(len(w) + k, ()) if one_edit(w, x)]
        near[w] = len(found)
        best = min(found, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= ratio * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (n, near[w], form[w], words.get(form[w]), root)
    return out


def as_dict(df):
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    out = {r["word"]: tuple(r)[1:] for r in rows}
    assert len(out) == len(rows)
    return out


def misspelt(seed, texts=120):
    rnd = random.Random(seed)
    base = ["house", "straße", "naïve", "aaaaa", "aaaaaa", "abababab", "planet", "planets", "plane", "über÷all", "Ärgern", "ärgern", "z" * 70]

    def typo(w):
        i = rnd.randrange(len(w) + 1)
        c = rnd.choice("absté")
        return rnd.choice([w, w, w, w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])

    return [rnd.choice([" ", "; ", "1"]).join(typo(rnd.choice(base)) for _ in range(rnd.randint(0, 60))) for _ in range(texts)]


@pytest.mark.parametrize("tile", [spelling.TILE, 3])
def test_groups_equal_brute_force(spark, monkeypatch, tile):
    # tiles of three words: cells and hot parts are cut
    monkeypatch.setattr(spelling, "TILE", tile)
    texts = [None, "", *misspelt(1), "chainxyz " * 3 + "chainxyw " * 6 + "chainxqw " * 12]
    got = as_dict(spelling.grouped(spark.createDataFrame(rows_of(texts), SCHEMA)))
    want = plain_groups(enumerate(texts))
    assert got == want
    assert sum(v[2] is not None for v in want.values()) > 20 and any(v[2] is not None and v[4] != v[2] for v in want.values())


def test_short_words_and_thresholds(spark):
    texts = misspelt(2, 60) + ["a b ab ba abc", "a a b ab ab ab abc"]
    got = as_dict(spelling.grouped(spark.createDataFrame(rows_of(texts), SCHEMA), shortest=1, least=1, ratio=3))
    assert got == plain_groups(enumerate(texts), 1, 1, 3)
    with pytest.raises(ValueError):
        spelling.grouped(spark.createDataFrame(rows_of(texts), SCHEMA), ratio=1)


def test_query_equals_brute_force(spark, documents, sf_small):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = as_dict(queries.op12_spelling_groups(spark, sf_small))

    def rewrite(key, word):
        h = zlib.crc32(f"{key}:{word}".encode())
        return word if h % 97 else word[: h % len(word)] + word[h % len(word) + 1 :]

    assert got == plain_groups(rows, rewrite=rewrite)


def test_odd_rows(spark, odd, empty, odd_texts):
    rows = [*enumerate(odd_texts), (10, odd_texts[10]), (None, "no key")]
    assert as_dict(spelling.grouped(odd, rewrite=queries.without_letter)) == plain_groups(rows, rewrite=queries.without_letter)
    assert spelling.grouped(empty).collect() == []
    assert as_dict(spelling.grouped(spark.createDataFrame(rows_of(["tie tied " * 3 + "abcde abcdf " * 3 + "abcdx"] * 3), SCHEMA)))["abcdx"] == (3, 2, "abcde", 9, "abcde")


def test_slices_cut_no_word(monkeypatch):
    text = "Long wörds " + "x" * 50 + " and;more" * 30
    whole = sum(spelling.words_in(text), Counter())
    monkeypatch.setattr(spelling, "SLICE", 5)
    assert sum(spelling.words_in(text), Counter()) == whole


def test_a_task_hands_on_a_full_table(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TABLE", 2)
    texts = misspelt(3, 40)
    got = {r["word"]: r["n"] for r in spelling.vocabulary(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    assert got == {w: v[0] for w, v in plain_groups(enumerate(texts)).items()}


def test_roots_of_a_long_chain(spark):
    chain = [(f"w{i:03}", f"w{i + 1:03}") for i in range(40)]
    got = {r["word"]: r["root"] for r in spelling.rooted(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert got == {w: "w040" for w, _ in chain}
