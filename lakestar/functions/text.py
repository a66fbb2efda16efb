"""Text expressions with Python string semantics, as Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters Python's str.strip()/str.split() treat as blanks (str.isspace()).
WHITESPACE_CLASS = (
    "[\\t\\n\\x0B\\f\\r\\x1C-\\x1F \\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)
_STRIP_RE = f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$"
# Most texts need no general rule: printable ASCII without a blank at its ends
# is stripped, and where its letters only begin after a space (or the start),
# ``initcap`` finds the same words.
_STRIPPED_RE = "^[!-~](?:[ -~]*[!-~])?\\z"
_PLAIN_WORDS_RE = "^(?!.*[!-@\\[-`{-~][A-Za-z])[ -~]+\\z"
# tokens: maximal runs of cased characters, and runs of the others; cased as
# Python defines it (Lowercase, Uppercase or Titlecase property, so "º" and
# modifier letters count), not only the Lu/Ll/Lt categories. Matched forward:
# Java's look-behind mis-reads supplementary-plane characters.
_CASED = "\\p{IsLowercase}\\p{IsUppercase}\\p{IsTitlecase}"
_TITLE_TOKENS_RE = f"[{_CASED}]+|[^{_CASED}]+"


def _title_exceptions() -> dict[str, str]:
    """Characters whose title case is not their upper case (e.g. "ß" -> "Ss",
    digraphs, ligatures), derived from Python's Unicode tables."""
    out = {}
    for i in range(0x110000):
        c = chr(i)
        if c.title() != c.upper():
            out[c] = c.title()
    return out


TITLE_EXCEPTIONS = _title_exceptions()
_FIRST_EXCEPTION = min(ord(c) for c in TITLE_EXCEPTIONS)


def _title_first(ch: Column) -> Column:
    # the exception map is only consulted for code points at or above the
    # smallest exception; map lookups scan their keys
    m = F.create_map(*[F.lit(x) for kv in TITLE_EXCEPTIONS.items() for x in kv])
    return F.when(F.ascii(ch) < F.lit(_FIRST_EXCEPTION), F.upper(ch)).otherwise(
        F.coalesce(F.element_at(m, ch), F.upper(ch))
    )


def py_strip(col: Column) -> Column:
    """``str.strip()``: Spark ``trim`` only removes U+0020."""
    return F.when(F.rlike(col, F.lit(_STRIPPED_RE)), col.cast("string")).otherwise(F.regexp_replace(col, _STRIP_RE, ""))


def title_case(col: Column) -> Column:
    """``str.title()``: a character right after an uncased one (or at the
    start) gets its title case, every other character its lower case.
    ``initcap`` only splits on spaces, so ``men's`` would stay ``Men's``
    instead of ``Men'S``.

    Per token the original first character is title-cased; the rest is taken
    from the lower-cased whole token (keeps final-sigma context), after the
    lower case of the first character (which may be longer than one)."""
    tokens = F.regexp_extract_all(col, F.lit(_TITLE_TOKENS_RE), 0)

    def title_token(t: Column) -> Column:
        first = F.substring(t, 1, 1)
        lower = F.lower(t)
        rest = lower.substr(F.length(F.lower(first)) + F.lit(1), F.length(lower))
        return F.concat(_title_first(first), rest)

    plain = F.rlike(col, F.lit(_PLAIN_WORDS_RE))
    return F.when(plain, F.initcap(col)).when(col.isNotNull(), F.concat_ws("", F.transform(tokens, title_token)))


def txn_id(n: Column) -> Column:
    """``f"TXN{n:06d}"``; unlike ``lpad`` it never truncates past 6 digits.
    Numbers that have these digits need no formatter."""
    return F.when(n >= 100_000, F.concat(F.lit("TXN"), n.cast("string"))).otherwise(F.format_string("TXN%06d", n))


def period_label(year: Column, month: Column) -> Column:
    """``str(year) + "-" + str(month).zfill(2)``."""
    return F.format_string("%d-%02d", year, month)


def first_token(col: Column, default: str) -> Column:
    parts = F.split(py_strip(col), f"{WHITESPACE_CLASS}+")
    return F.when(F.length(py_strip(col)) > 0, F.lower(F.element_at(parts, 1))).otherwise(F.lit(default))


def last_token(col: Column, default: str) -> Column:
    parts = F.split(py_strip(col), f"{WHITESPACE_CLASS}+")
    n = F.when(F.length(py_strip(col)) > 0, F.size(parts)).otherwise(F.lit(0))
    return F.when(n > 1, F.lower(F.element_at(parts, -1))).otherwise(F.lit(default))
