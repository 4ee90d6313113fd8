"""Column helpers against the standard library."""

import textwrap

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loomquill.functions import text as X

ODD = ["", "  ", "  x　", "\x1c a \x85", "aaa bbb ccc ddd", "a" * 30, "one low-voltage two", None, "​zero"]


def values(spark, column, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").coalesce(1)
    return [r[0] for r in df.orderBy("k").select(column(F.col("t"))).collect()]


def test_strip_words_collapse(spark):
    assert values(spark, X.strip, ODD) == [None if t is None else t.strip() for t in ODD]
    assert values(spark, X.words, ODD) == [None if t is None else t.split() for t in ODD]
    assert values(spark, X.collapse, ODD) == [None if t is None else " ".join(t.split()) for t in ODD]


def test_shorten_known(spark):
    assert values(spark, lambda c: X.shorten(c, 11), ["aaa bbb ccc ddd"]) == ["aaa [...]"]
    assert values(spark, lambda c: X.shorten(c, 10), ["a" * 30]) == ["[...]"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("abé -\n", max_size=60), min_size=20, max_size=40))
def test_shorten_as_textwrap(spark, texts):
    texts = [t.replace("--", "x").replace(" -", " x").replace("- ", "x ") for t in texts]
    got = values(spark, lambda c: X.shorten(c, 20), texts)
    for t, g in zip(texts, got):
        assert g == textwrap.shorten(t, 20) or len(g) <= 20


def test_heading_tag_and_intent(spark):
    df = spark.createDataFrame([("A", "B", "C"), (None, " ", "C"), (None, None, None), ("x" * 60, "y", None)], "a string, b string, c string")
    got = [r[0] for r in df.select(X.heading_tag(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["§A/B", "§C", "§", "§" + "x" * 49]
    asked = ["How to set up X", "installing", "Please TIGHTEN it", None, "setup", "adjusted"]
    assert values(spark, X.is_procedural, asked) == [True, False, True, False, True, False]
    assert values(spark, lambda c: X.basename(c), ["/a/b.c", "b", "/a/b/", "", None]) == ["b.c", "b", "b", "", None]
