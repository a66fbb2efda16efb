"""Property tests: column expressions against Python on generated strings.
Each hypothesis example is a batch of strings evaluated in one Spark job."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakestar.functions import py_strip, stable_key, title_case
from lakestar.functions.guard import FORBIDDEN_KEYWORDS, INTENT_KEYWORDS, guard_reason, intent

SETTINGS = settings(max_examples=int(__import__("os").environ.get("LAKESTAR_EXAMPLES", "4")), deadline=None, suppress_health_check=list(HealthCheck))
WORDS = st.sampled_from(["select", "SELECT", "with", "drop", "DROP", "update", "x", "ß", "é", "_", "1", " ", "\t", "\n",
                         "'", "-", ".", "Category", "customers", "REGION", "trend", "margin", "ǆ", "Ⅻ", "½", "İ",
                         "𨉭", "\U00102e89", "𝟘", "\u0301", "ª"])
TEXT = st.lists(st.one_of(WORDS, st.text(max_size=6)), max_size=12).map("".join)


def _eval(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.o for r in df.select("i", expr(F.col("s")).alias("o")).orderBy("i").collect()]


@SETTINGS
@given(st.lists(TEXT, min_size=40, max_size=80))
def test_strip_property(spark, values):
    assert _eval(spark, values, py_strip) == [v.strip() for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet=st.characters(codec="latin-1"), max_size=20).map(lambda s: s + " mix"), min_size=40, max_size=80))
def test_title_property_latin1(spark, values):
    assert _eval(spark, values, title_case) == [v.title() for v in values]


@SETTINGS
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=127), max_size=24), min_size=60, max_size=120))
def test_title_property_ascii(spark, values):
    assert _eval(spark, values, title_case) == [v.title() for v in values]


@SETTINGS
@given(st.lists(TEXT, min_size=40, max_size=80))
def test_title_property_mixed(spark, values):
    assert _eval(spark, values, title_case) == [v.title() for v in values]


@SETTINGS
@given(st.lists(TEXT, min_size=40, max_size=80), st.integers(min_value=1, max_value=2**31 - 1))
def test_stable_key_property(spark, values, n):
    want = [int(hashlib.md5(v.encode("utf-8")).hexdigest(), 16) % n + 1 for v in values]
    assert _eval(spark, values, lambda c: stable_key(c, n)) == want


KEYWORD = st.sampled_from(FORBIDDEN_KEYWORDS).flatmap(lambda k: st.sampled_from([k, k.lower(), k.title()]))
APART = st.sampled_from([" ", "\n", "(", ")", "'", "-", ".", ";", "\u0301"])
GLUE = st.sampled_from(["a", "Z", "_", "7", "\u00e9", "\U000202ed"])
HARMLESS = st.lists(st.sampled_from(["x", "1", " ", "category", "\u00df", ",", "\n", "*"]), max_size=8).map("".join)


@SETTINGS
@given(st.lists(st.tuples(HARMLESS, APART, KEYWORD, APART, HARMLESS), min_size=40, max_size=80))
def test_a_keyword_of_its_own_is_refused(spark, parts):
    reasons = _eval(spark, ["SELECT " + "".join(p) for p in parts], guard_reason)
    assert all(r is not None and p[2].upper() in r for r, p in zip(reasons, parts))


@SETTINGS
@given(st.lists(st.tuples(HARMLESS, APART, GLUE, KEYWORD, HARMLESS), min_size=40, max_size=80))
def test_a_keyword_glued_to_a_letter_is_not(spark, parts):
    assert all(r is None for r in _eval(spark, ["SELECT " + "".join(p) for p in parts], guard_reason))


@SETTINGS
@given(st.lists(TEXT, min_size=40, max_size=80))
def test_guard_ignores_case_and_outer_blanks(spark, values):
    assert _eval(spark, values, guard_reason) == _eval(spark, [f" \n{v}\t " for v in values], guard_reason)


@SETTINGS
@given(st.lists(st.tuples(HARMLESS, st.sampled_from([w for _, ws in INTENT_KEYWORDS for w in ws])), min_size=40, max_size=80))
def test_router_knows_every_keyword(spark, parts):
    # the harmless part may hold "category", which wins over every other word
    own = {w: name for name, ws in INTENT_KEYWORDS for w in ws}
    want = ["category" if "category" in h else own[w] for h, w in parts]
    assert _eval(spark, [f"{h} {w.upper()}" for h, w in parts], intent) == want
