import re

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from textlens.functions import text as x
from textlens.functions.constants import ENGLISH_STOP_WORDS, NEGATIVE_PLACEHOLDERS, POSITIVE_PLACEHOLDERS

EDGE = [
    None,
    "",
    "   No Positive ",
    "NOTHING",
    "n/a",
    "N A",
    "a\u001cb　c",
    " two  words\t\n",
    "Café 10/10 !!!",
    "10/10 !!!",
    "Kelvin",
    "didn't like",
    "x" * 220,
    "y" * 221,
    "a​b",
]


def column(spark, expression, values=EDGE):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(expression).collect()]


def test_whitespace_matches_python(spark):
    every = [chr(c) for c in range(0x10000) if re.fullmatch(r"\s", chr(c))]
    assert sorted(x.WHITESPACE_CHARS) == every
    others = ["​", "﻿", "᠎", "a"]
    got = column(spark, x.normalize_whitespace("v"), [f"a{c}b" for c in every + others])
    assert got == [" ".join(f"a{c}b".split()) for c in every + others]


def test_normalize_and_strip(spark):
    values = [v for v in EDGE if v is not None]
    assert column(spark, x.normalize_whitespace("v"), values) == [re.sub(r"\s+", " ", v).strip() for v in values]
    assert column(spark, x.strip("v"), values) == [v.strip() for v in values]


def test_clean_text(spark):
    def clean(v):
        return re.sub(r"[^a-z]+", " ", (v or "").lower()).strip()

    assert column(spark, x.clean_text("v")) == [clean(v) for v in EDGE]
    assert column(spark, x.has_letters("v")) == [clean(v) != "" for v in EDGE]


def test_placeholders(spark):
    values = [None, " No Positive ", "N A", "n/a", "None", "nothing much", " kept "]
    assert column(spark, x.blank_placeholders("v", POSITIVE_PLACEHOLDERS), values) == [
        "", "", "", "n/a", "", "nothing much", "kept",
    ]
    assert column(spark, x.blank_placeholders("v", NEGATIVE_PLACEHOLDERS), ["No Positive", "no negative"]) == [
        "No Positive", "",
    ]


def test_numbers(spark):
    values = ["5.0", " 8 ", "1e1", "n/a", "5.0f", "0x1p3", "", None, "-.5", "five"]
    assert column(spark, x.to_number("v"), values) == [5.0, 8.0, 10.0, None, None, None, None, None, -0.5, None]


def test_missing_values(spark):
    assert column(spark, x.na_to_null("v"), ["NA", "None", "n/a", "", "na", "0", None]) == [
        None, None, None, None, "na", "0", None,
    ]


def test_excerpt(spark):
    got = column(spark, x.excerpt("v"), ["x" * 220, "y" * 221, " a  b ", None])
    assert got == ["x" * 220, "y" * 217 + "...", "a b", ""]


def test_words(spark):
    got = column(spark, F.array_join(x.word_tokens("v", ["the", "of"]), " "), ["a the room of dirt", "", "the"])
    assert got == ["room dirt", "", ""]


def test_stop_words_are_sparks(spark):
    assert sorted(ENGLISH_STOP_WORDS) == sorted(StopWordsRemover.loadDefaultStopWords("english"))


def test_quick_whitespace_is_the_same_set(spark):
    """Every character of the plane, between letters and alone: one test of the pattern for long texts."""
    rows = spark.range(1, 0x10000).selectExpr("cast(id AS int) AS c").filter("c < 55296 OR c > 57343")
    rows = rows.selectExpr("c", "decode(unhex(lpad(hex(c), 4, '0')), 'UTF-16BE') AS v")
    quick, fixed = (rows.filter(F.col("v").rlike(p)).select("c").collect() for p in (x.QUICK_WHITESPACE, x.WHITESPACE))
    assert sorted(quick) == sorted(fixed) and len(quick) == len(x.WHITESPACE_CHARS)
    # Two alternatives, so that a letter costs two calls and not one for each range.
    assert x.QUICK_WHITESPACE.count("\\x") <= 2
