"""Operator 3: personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs, plus
signs, digits, schemes and identifier cues. Each anchor is expanded by a local
parser that reads only the characters around it, and validated (Luhn, octets,
digit counts, credentials). Kinds:

* base: email, ip, card and phone, exactly the leftmost non-overlapping matches
  of their patterns that pass validation;
* added: ``address``, the part before the host of a URL that holds credentials,
  or the target of a ``mailto:`` or ``tel:`` link; ``account``, the value after
  a cue such as ``token =`` or ``IBAN:`` that looks like an identifier.

Positions are code points, ends exclusive. Defined results: a null or empty
text has no spans; a null key stays null; repeated rows give repeated rows; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from lakestar.llm.common import bounded_batches, keyed_text, texts_of

# fixed values
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "address", "account")
ACCOUNT_CUES = ("account", "acct", "iban", "ssn", "passport", "token", "secret", "password", "passwd", "api_key", "apikey", "access_key", "user_id", "userid")
SCHEMES = ("://", "mailto:", "tel:")

_ORDER = {k: i for i, k in enumerate(KINDS)}
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")
_SCHEME_TAIL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
_USER = re.compile(r"[^\s/?#@\"'<>]*")
_HOST = re.compile(r"@[A-Za-z0-9\[]")
_LINK_TARGET = re.compile(r"[A-Za-z0-9._%+@-]{3,}")
_ASSIGNED = re.compile(r"(?: ?(?:number|no\.?|id))? ?[:=#] ?[\"']?([A-Za-z0-9_\-]*)", re.IGNORECASE)
_GROUPED = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{2,4}){3,8}")

Span = tuple[int, int, str]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def iban(value: str) -> bool:
    packed = value.replace(" ", "")
    moved = packed[4:] + packed[:4]
    return 15 <= len(packed) <= 34 and int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    """Anchor strings with (kind of anchor, length)."""
    found = ahocorasick.Automaton()
    for sign in "@+":
        found.add_word(sign, (sign, 1))
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    for scheme in SCHEMES:
        found.add_word(scheme, ("scheme", len(scheme)))
    for cue in ACCOUNT_CUES:
        for form in (cue, cue.upper(), cue.title(), cue.capitalize()):
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def find(text: str) -> list[Span]:
    """All spans (start, end, kind) by start, then kind in the order of KINDS."""
    spans: list[Span] = []
    done = dict.fromkeys(KINDS, 0)  # where the next match of a kind may start
    digits_end = 0
    for last, (kind, length) in anchors().iter(text):
        at = last - length + 1
        if kind == "digit":
            if at >= digits_end:
                digits_end = _DIGITS.match(text, at).end()
                _digit_run(text, at, digits_end, done, spans)
        elif kind == "@":
            _email(text, at, done, spans)
        elif kind == "+":
            if at >= done["phone"] and (m := _PHONE.match(text, at)):
                done["phone"] = m.end()
                if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                    spans.append((at, m.end(), "phone"))
        elif kind == "scheme":
            _address(text, at, last + 1, done, spans)
        else:
            _account(text, at, last + 1, done, spans)
    spans.sort(key=lambda s: (s[0], _ORDER[s[2]]))
    return spans


def _digit_run(text: str, at: int, end: int, done: dict[str, int], spans: list[Span]) -> None:
    """An address or card number that starts with this run of digits; a shorter start inside the run matches no more."""
    follows = text[end : end + 1]
    if follows == "." and at >= done["ip"] and (m := _IP.match(text, at)):
        done["ip"] = m.end()
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            spans.append((at, m.end(), "ip"))
    if at >= done["card"] and (m := _CARD.match(text, at)):
        done["card"] = m.end()
        number = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(number) <= 19 and luhn(number):
            spans.append((at, m.end(), "card"))


def _email(text: str, at: int, done: dict[str, int], spans: list[Span]) -> None:
    start = at
    while start > done["email"] and text[start - 1] in _LOCAL:
        start -= 1
    if start < at and (m := _DOMAIN.match(text, at + 1)):
        done["email"] = m.end()
        spans.append((start, m.end(), "email"))


def _address(text: str, at: int, after: int, done: dict[str, int], spans: list[Span]) -> None:
    if at < done["address"]:
        return
    if text[at] == ":":
        # a URL with credentials, name:word before an at-sign; the longest usual scheme has a few letters
        if _SCHEME_TAIL.search(text, max(0, at - 12), at):
            end = _USER.match(text, after).end()
            if _HOST.match(text, end) and text.find(":", after + 1, end - 1) >= 0:
                spans.append((after, end, "address"))
                done["address"] = end
    elif not text[at - 1 : at].isalnum() and (m := _LINK_TARGET.match(text, after)) and ("@" in m.group() or any(map(str.isdigit, m.group()))):
        spans.append((after, m.end(), "address"))
        done["address"] = m.end()


def _account(text: str, at: int, after: int, done: dict[str, int], spans: list[Span]) -> None:
    if at < done["account"] or text[at - 1 : at].isalnum() or text[after : after + 1].isalnum():
        return
    m = _ASSIGNED.match(text, after)
    if m is None:
        return
    grouped = _GROUPED.match(text, m.start(1))
    if grouped:
        # the longest tail that passes its check digits
        value = grouped.group()
        while value and not iban(value):
            value = value[:-1].rstrip()
        if value:
            spans.append((m.start(1), m.start(1) + len(value), "account"))
            done["account"] = m.start(1) + len(value)
            return
    if len(m.group(1)) >= 6 and sum(map(str.isdigit, m.group(1))) >= 3:
        spans.append((*m.span(1), "account"))
        done["account"] = m.end(1)


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; overlapping spans become one, named by the first."""
    if not spans:
        return text
    parts, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][1])
        parts += (text[at:start], f"[{kind.upper()}]")
        at, i = end, i + 1
    return "".join((*parts, text[at:]))


def scanned(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every text."""
    counts = [f"n_{k}" for k in BASE_KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find(t) for t in texts_of(batch)]
            base = [[s for s in spans if s[2] in BASE_KINDS] for spans in found]
            columns = [pa.array([sum(s[2] == kind for s in spans) for spans in base], pa.int64()) for kind in BASE_KINDS]
            sha = [hashlib.sha256(joined(spans).encode()).hexdigest() for spans in base]
            yield pa.RecordBatch.from_arrays([batch.column("key"), *columns, pa.array(sha, pa.string()), pa.array([joined(s) for s in found], pa.string())], ["key", *counts, "base_sha256", "spans"])

    bounded_batches(df.sparkSession)
    schema = "key long, " + ", ".join(f"{c} long" for c in counts) + ", base_sha256 string, spans string"
    return keyed_text(df, id_col, text_col).mapInArrow(run, schema).withColumnRenamed("key", id_col)


def redacted(df: DataFrame, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """All rows and columns with personal data masked in the text; the length column follows if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_col).to_pylist()
            new = [t if not t else masked(t, find(t)) for t in texts]
            place = batch.schema.get_field_index(text_col)
            batch = batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))
            if (place := batch.schema.get_field_index(length_col)) >= 0:
                field = batch.schema.field(place)
                sizes = [size if t == u else len(u) for size, t, u in zip(batch.column(place).to_pylist(), texts, new)]
                batch = batch.set_column(place, field, pa.array(sizes, field.type))
            yield batch

    bounded_batches(df.sparkSession)
    return df.mapInArrow(run, df.schema)
