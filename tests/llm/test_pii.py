"""Operator 3 against its patterns."""

import hashlib
import random
import re
import time
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lakestar.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def valid(kind, found):
    digits = [int(c) for c in found if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))]
        return 12 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def base(text):
    spans = [(m.start(), m.end(), k) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m.group())]
    return sorted(spans, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


parts = st.sampled_from([*"ab.@+-% 0123456789()é٣", "@a.b", "1.2.3", "255.", "+1", "4532015112830366", 'token = "ab12cd34ef"', "http://u:p4@h.c", "mailto:", "iban: DE89370400440532013000"])


@settings(max_examples=800, deadline=None)
@given(st.lists(parts, max_size=30).map("".join))
def test_base_spans_equal_patterns(text):
    assert [s for s in pii.find(text) if s[2] in pii.BASE_KINDS] == base(text)


def test_long_runs():
    for text in ("0" * 4000 + ".1.2.3", "a" * 50_000 + "@b.c", "+1" + " " * 5000, "1 " * 9000, "@" * 5000, "a@b@c.d@e.f"):
        assert [s for s in pii.find(text) if s[2] in pii.BASE_KINDS] == base(text)


def test_added_kinds():
    text = 'see http://bob:pw1@host.org/x or mailto:x@y.org, IBAN: DE89 3704 0044 0532 0130 00 and token = "51ccd051a92ebcb68"'
    assert {(text[a:b], k) for a, b, k in pii.find(text) if k not in pii.BASE_KINDS} == {
        ("bob:pw1", "address"),
        ("x@y.org", "address"),
        ("DE89 3704 0044 0532 0130 00", "account"),
        ("51ccd051a92ebcb68", "account"),
    }
    assert pii.find("a token of thanks, the account is closed; http://host.org/path") == []


def test_credentials_equal_their_pattern():
    pattern = re.compile(r"[^\s/?#@\"'<>]+:[^\s/?#@\"'<>]+(?=@[A-Za-z0-9\[])")
    rnd = random.Random(4)
    for _ in range(3000):
        rest = "".join(rnd.choice(":::aab@@[/ ?'") for _ in range(rnd.randint(0, 12)))
        m = pattern.match(rest)
        found = [(a, b) for a, b, k in pii.find("x://" + rest) if k == "address"]
        assert found == ([(4, 4 + m.end())] if m else [])


@pytest.mark.parametrize("unit", ["a:", "a@", "http://a:", "mailto:a", "tel:1", "+1 ", "+1(", "1.", "1-", "1 ", "token=", "token: a1", "IBAN: DE89 ", "password=a1b2c3 ", "a.b@c", "x://@", "://", "a:b@["])
def test_every_parser_is_linear(unit):
    for before in ("", "http://", "+1", "token = ", "a@"):
        text = before + unit * (400_000 // len(unit))
        began = time.process_time()
        pii.find(text)
        assert time.process_time() - began < 4, (before, unit)


def test_masking():
    text = "write a.b@c.org or +1 (407) 555-7710 now"
    assert pii.masked(text, pii.find(text)) == "write [EMAIL] or [PHONE] now"
    assert pii.masked("mailto:x@y.org", pii.find("mailto:x@y.org")) == "mailto:[EMAIL]"
    assert pii.masked("clean", []) == "clean"


def test_query(odd, documents, empty):
    for df in (odd, documents):
        got = Counter(tuple(r)[:6] for r in pii.scanned(df).collect())
        expected = Counter()
        for r in df.collect():
            spans = base(r["text"] or "")
            sha = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, b, k in spans).encode()).hexdigest()
            expected[(r["doc_id"], *(sum(s[2] == k for s in spans) for k in PATTERNS), sha)] += 1
        assert got == expected
    assert pii.scanned(empty).count() == 0


def test_redacted_keeps_rows_and_columns(odd, documents, empty):
    assert Counter(map(tuple, pii.redacted(odd).collect())) == Counter(map(tuple, odd.collect()))
    before, after = ({r["doc_id"]: r for r in d.collect()} for d in (documents, pii.redacted(documents)))
    assert before.keys() == after.keys()
    changed = 0
    for k, r in after.items():
        assert not any(s[2] in ("email", "phone", "card", "ip") for s in pii.find(r["text"] or ""))
        if r["text"] != before[k]["text"]:
            changed += 1
            assert r["n_chars"] == len(r["text"])
        else:
            assert r == before[k]
    assert changed == sum(bool(pii.find(r["text"] or "")) for r in before.values()) > 0
    assert pii.redacted(empty).count() == 0
