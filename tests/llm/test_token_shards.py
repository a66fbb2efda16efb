import json
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo
from tokenizers import Tokenizer

from lakestar.llm import queries, repair, token_shards

from .conftest import rows_of, SCHEMA

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    return [[*e.ids, 2] for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# -- the grammar


@pytest.mark.parametrize("seed", range(12))
def test_grammars_give_back_all_ids_and_every_slice(seed):
    rnd = np.random.default_rng(seed)
    vocabulary = [2, 5, 300, 65_530, 65_535, 70_000, 2**31][seed % 7]
    sizes = rnd.integers(0, 200, size=rnd.integers(1, 30))
    ids = np.minimum(rnd.zipf(1.3, size=int(sizes.sum())), vocabulary).astype(np.uint32)
    if seed % 3 == 0:
        ids[len(ids) // 3 :] = np.resize(ids[: 1 + seed], len(ids) - len(ids) // 3)
    starts = np.cumsum(sizes) - sizes
    grammar, symbols, at = repair.compress(ids, starts)
    assert grammar.expand(symbols).tolist() == ids.tolist()
    assert grammar.lengths(symbols).sum() == len(ids)
    ends = np.append(at[1:], len(symbols))
    for k in range(len(sizes)):  # no rule spans two documents
        own = symbols[at[k] : ends[k]]
        assert grammar.expand(own).tolist() == ids[starts[k] : starts[k] + sizes[k]].tolist()
        a, b = sorted(rnd.integers(0, sizes[k] + 1, size=2).tolist())
        assert grammar.expand(own, a, b).tolist() == ids[starts[k] + a : starts[k] + b].tolist()


def test_a_repeated_id_shrinks_to_a_few_symbols():
    ids = np.full(100_000, 7, dtype=np.uint32)
    grammar, symbols, _ = repair.compress(ids, np.array([0]))
    assert len(symbols) < 40 and len(grammar.left) < 40
    assert grammar.expand(symbols, 99_990).tolist() == [7] * 10


def test_rules_are_used_and_pairs_left_are_rare():
    rnd = random.Random(2)
    words = [[rnd.randrange(500) for _ in range(rnd.randint(2, 6))] for _ in range(60)]
    ids = np.array([x for _ in range(4000) for x in rnd.choice(words)], dtype=np.uint32)
    grammar, symbols, _ = repair.compress(ids, np.array([0]))
    used = np.bincount(np.concatenate([symbols, grammar.left, grammar.right]), minlength=grammar.first + len(grammar.left))
    assert (used[grammar.first :] >= 1).all()
    assert len(symbols) < len(ids) / 3
    pairs, counts = np.unique(symbols[:-1].astype(np.int64) << 16 | symbols[1:], return_counts=True)
    repeats = pairs >> 16 == pairs & 0xFFFF  # of a symbol repeated only every other pair can be replaced
    assert counts[~repeats].max(initial=0) < 2 * repair.LEAST


def test_no_ids_and_few_ids():
    for ids in ([], [3], [3, 3], [1, 2, 1, 2]):
        ids = np.array(ids, dtype=np.uint32)
        grammar, symbols, _ = repair.compress(ids, np.zeros(1, dtype=np.int64))
        assert grammar.expand(symbols).tolist() == ids.tolist() and len(grammar.left) == 0


# -- the ids


def test_encoder_equals_the_library(odd_texts, documents, monkeypatch):
    texts = [t or "" for t in odd_texts] + [r["text"] or "" for r in documents.select("text").collect()]
    texts += ["á ́x é\x1cb\x85c d", "İSTANBUL ΣΑΣ ǅ", "x<|startoftext|>y <|endoftext|>", "don't 's 'S I'LL", "  ​ ﻿"]
    texts += ["ÀÉÎ Straße STRASSE ẞ ſs ÿŸ", "(a) a'a' ('s) a's it'S \"don't\" --x-- x^y a_b *bold*", "é, ,é e—, a… 1a a1 ×a÷", "<|a|> <|endoftext|x <|ENDOFTEXT|> a<|endoftext|>."]
    want = [x[:-1] for x in library_ids(texts)]
    encoder = token_shards.Encoder(PATH)
    assert encoder.by_word and encoder.by_core
    assert [x.tolist() for x in encoder.encode(texts)] == want
    monkeypatch.setattr(token_shards, "WORDS", 50)
    monkeypatch.setattr(token_shards, "SLICE", 64)
    assert [encoder.encode([t])[0].tolist() for t in texts] == want
    other = token_shards.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not other.by_word
    assert [x.tolist() for x in other.encode(texts[:30])] == [e.ids for e in Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode_batch(texts[:30], add_special_tokens=False)]


def test_words_of_latin_letters_and_marks_are_never_looked_at_one_by_one(monkeypatch):
    encoder, seen = token_shards.Encoder(PATH), []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda words: seen.extend(words) or learn(words))
    plain = ["(Ab) a.b, C--d!", "ÀÉÎ Straße. ÿ-Ö", "", " \n ", "x" * 500 + ".Y", '"...," [&] Z', "a" * 17 + " " + "A" * 17 + "é"]
    odd = ["don't a1", "a×b é÷", "x<|endoftext|>y <b> a<", "E\u0301. J\u030c ſs Ÿ 'S", "\u0301a,b", "a\x00b", "A\u00a0B.c", "字a.b", "1.5e3", "\ud7ff!"]
    want = [x[:-1] for x in library_ids(plain + odd)]
    assert [x.tolist() for x in encoder.encode(plain)] == want[: len(plain)] and seen == []
    assert [x.tolist() for x in encoder.encode(plain + odd)] == want and b"don't" in seen and b"(Ab)" not in seen
    assert [encoder.encode([t])[0].tolist() for t in odd + plain] == want[len(plain) :] + want[: len(plain)]
    assert encoder.encode([]) == []
    ids, size = encoder.flat(plain)
    closed = token_shards._closed(ids, size, 2)
    assert [np.frombuffer(x.as_buffer(), dtype="<u4").tolist() for x in closed] == [[*x, 2] for x in want[: len(plain)]]


def test_special_strings_that_begin_with_any_byte(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    for k, text in enumerate(["Abc", "été!", ".;x"]):
        spec["added_tokens"].append({"id": 60_000 + k, "content": text, "single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True})
    path = str(tmp_path / "more.json")
    json.dump(spec, open(path, "w", encoding="utf-8"))
    texts = ["xAbcy. abc ABC Abc, A", "cétéa! vété!x Été! é", "a.;x .; ;x .,", "plain words"]
    encoder = token_shards.Encoder(path)
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("seed", range(4))
def test_places_of_pairs_whose_hashes_meet(seed, monkeypatch):
    monkeypatch.setattr(repair, "STEP", [7, 64, 1 << 16, 1000][seed])
    rnd = np.random.default_rng(seed)
    s = rnd.integers(0, 40, size=5000).astype(np.uint32) * 997
    s[1000:1500] = 997 * 3
    key = (s[:-1] << np.uint32(16)) | (s[1:] & np.uint32(0xFFFF))
    # pairs of one slot: the hash keeps the highest 20 bits of the product
    values = np.arange(1 << 22, dtype=np.uint32) * np.uint32(1021)
    slot = (values * np.uint32(2654435761)) >> np.uint32(12)
    order = np.argsort(slot, kind="stable")
    twins = values[order[1:]][slot[order[1:]] == slot[order[:-1]]][:50]
    key = np.concatenate([key, np.repeat(twins, 3)])
    pairs = rnd.permutation(np.unique(np.concatenate([rnd.choice(np.unique(key), 300), twins])))
    at, rank = repair._places(key, pairs)
    ranks = {int(p): i for i, p in enumerate(pairs)}
    found = [(i, ranks[int(k)]) for i, k in enumerate(key) if int(k) in ranks]
    kept = []  # of a symbol repeated, every other pair
    for i, r in found:
        if not (kept and kept[-1][0] == i - 1 and kept[-1][1] == r and kept[-1][2]):
            kept.append((i, r, True))
        else:
            kept.append((i, r, False))
    kept = [(i, r) for i, r, real in kept if real]
    by = dict(kept)
    want = [(i, r) for i, r in kept if not (by.get(i - 1, r) < r or by.get(i + 1, r) < r)]
    assert list(zip(at.tolist(), rank.tolist())) == want


# -- the files


@pytest.mark.parametrize("block", [token_shards.BLOCK_IDS, 100])
def test_shards_of_odd_rows(spark, odd, odd_texts, tmp_path, monkeypatch, block):
    monkeypatch.setattr(token_shards, "BLOCK_IDS", block)
    folder = str(tmp_path / "shards")
    held = token_shards.stored(odd, folder, PATH, end_id=2, ranges=5)
    rows = [(r["key"], r["start"], r["n_tokens"], bytes(r["ids"])) for r in held.collect()]
    rows.sort(key=lambda r: r[1])
    texts = [(None, "no key"), *enumerate(odd_texts), (10, odd_texts[10])]
    texts.sort(key=lambda r: -1 if r[0] is None else r[0])
    start = 0
    for (key, text), ids, row in zip(texts, library_ids([t for _, t in texts]), rows, strict=True):
        assert row == (key, start, len(ids), np.array(ids, dtype="<u4").tobytes())
        start += len(ids)
    # without ids no symbol is read
    assert sorted(map(tuple, held.select("key", "start", "n_tokens").collect()), key=lambda r: r[1]) == [r[:3] for r in rows]
    whole = np.concatenate([np.frombuffer(r[3], dtype="<u4") for r in rows])
    shards, rnd = token_shards.Shards(folder), random.Random(1)
    assert len(shards) == len(whole) == start
    for a, b in [(0, len(whole)), (0, 0), *(sorted((rnd.randrange(start + 1), rnd.randrange(start + 1))) for _ in range(25))]:
        assert shards.ids(a, b).tolist() == whole[a:b].tolist()


def test_pushed_predicates(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_shards, "BLOCK_IDS", 64)
    texts = ["word " * (k % 37) for k in range(300)] + [None] * 3
    rows = rows_of(texts)
    rows[5] = (None, *rows[5][1:])
    folder = str(tmp_path / "shards")
    token_shards.stored(spark.createDataFrame(rows, SCHEMA), folder, PATH, end_id=2, ranges=4)
    held = spark.read.format("token_shards").load(folder)
    want = {r["key"]: (r["start"], r["n_tokens"]) for r in held.collect()}
    for condition in ("key = 70", "key in (3, 299, 900)", "key > 290", "key >= 10 and key < 14", "key <= 2", "key is null", "key = 5", "key > 20 and key in (4, 40)"):
        got = {r["key"]: (r["start"], r["n_tokens"]) for r in held.where(condition).collect()}
        assert got == {k: v for k, v in want.items() if eval_condition(condition, k)}
    reader = token_shards.ShardReader(folder, ["key"])
    assert list(reader.pushFilters([EqualTo(("key",), 299)])) == []
    assert len(reader.partitions()) == 1 < len(token_shards.files_of(folder))


def eval_condition(condition, key):
    if condition == "key is null":
        return key is None
    return key is not None and eval(condition.replace(" = ", " == "), {"key": key})


def test_a_hot_key_is_dealt_over_its_ranges(spark, tmp_path):
    rows = rows_of([f"text {k}" for k in range(400)])
    rows = [(7 if 50 <= k < 300 else r[0], *r[1:]) for k, r in enumerate(rows)]
    folder = str(tmp_path / "shards")
    held = token_shards.stored(spark.createDataFrame(rows, SCHEMA), folder, PATH, end_id=2, ranges=8)
    files = token_shards.files_of(folder)
    assert max(f["docs"] for f in files) < 150
    got = [r["key"] for r in held.orderBy("start").collect()]
    assert got == sorted(r[0] for r in rows)


def test_empty_table_and_damage(spark, empty, tmp_path):
    held = token_shards.stored(empty, str(tmp_path / "none"), PATH, end_id=2)
    assert held.collect() == [] and held.columns == ["key", "start", "n_tokens", "ids"]
    assert len(token_shards.Shards(str(tmp_path / "none"))) == 0
    folder = str(tmp_path / "one")
    token_shards.stored(spark.createDataFrame(rows_of(["some words here"] * 20), SCHEMA), folder, PATH, end_id=2, ranges=1)
    stray = os.path.join(folder, "left-behind.rps")
    with open(stray, "wb") as out:
        out.write(b"of a task that failed")
    held = spark.read.format("token_shards").load(folder)
    assert held.count() == 20
    name = os.path.join(folder, token_shards.files_of(folder)[0]["name"])
    raw = bytearray(open(name, "rb").read())
    raw[60] ^= 255
    open(name, "wb").write(bytes(raw))
    with pytest.raises(Exception, match="damaged"):
        held.select(F.sum(F.length("ids"))).collect()
    assert json.loads(open(os.path.join(folder, next(f for f in os.listdir(folder) if f.startswith(token_shards.MANIFEST)))).read())


def test_query_equals_the_library(spark, documents, sf_small):
    rows = sorted((r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect())
    got = sorted(map(tuple, queries.op11_token_shards(spark, sf_small).collect()))
    start, want = 0, []
    for (key, _), ids in zip(rows, library_ids([t for _, t in rows])):
        want.append((key, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
