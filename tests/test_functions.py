"""Scalar functions: edge rows (expected values from the original pandas/Python behaviour)."""

import html
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerspark.functions import (
    canonical_type,
    format_movement_date,
    html_unescape,
    int_id,
    join_badges,
    normalize_document,
    normalize_document_loose,
    source_tag,
    strip_non_word,
    text_or_nan,
)


def one(spark, value, fn, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(fn(F.col("x"), df.schema["x"].dataType) if fn in (normalize_document, normalize_document_loose)
                     else fn(F.col("x"))).first()[0]


@pytest.mark.parametrize("value,expected", [
    ("123.456.789-01", "12345678901"),
    ("12.0", "12"),
    (None, ""),
    ("7\n", "7"),
    ("１２３", "１２３"),
    ("12.0\n", "12"),
    ("  ab ", ""),
])
def test_normalize_document(spark, value, expected):
    assert one(spark, value, normalize_document) == expected


def test_normalize_document_loose(spark):
    assert one(spark, "12.0", normalize_document_loose) == "120"
    assert one(spark, None, normalize_document_loose) == ""


def test_normalize_float_key(spark):
    assert one(spark, 12345678901.0, normalize_document, "double") == "12345678901"
    assert one(spark, 12345678901.0, normalize_document_loose, "double") == "123456789010"
    assert one(spark, 12345678901, normalize_document, "bigint") == "12345678901"


def test_strip_non_word(spark):
    assert one(spark, "{ab-ç_1}é", strip_non_word) == "abç_1é"
    assert one(spark, "UID-123", strip_non_word) == "UID123"


def test_canonical_type(spark):
    assert one(spark, " inclusão ", canonical_type) == "INCLUSÃO"
    assert one(spark, "\t exclusao\n", canonical_type) == "EXCLUSAO"
    assert one(spark, None, canonical_type) is None
    for raw in ["\u00a0inclusao\u3000", "\x1cexclusao\u2003", "\u0085 Inclusao \u202f"]:
        assert one(spark, raw, canonical_type) == raw.strip().upper()


@pytest.mark.parametrize("value,expected", [
    ("05/03/2024 14:30", "05/03/2024 14:30"),
    ("13/01/2024 09:05:59", "13/01/2024 09:05"),
    ("2024-03-05 14:30:00", "05/03/2024 14:30"),
    ("5/3/2024", "05/03/2024 00:00"),
    ("01/13/2024", "13/01/2024 00:00"), ("13/13/2024", None), ("\u00a0 1/2/2024 3:04\x1f", "01/02/2024 03:04"),
    ("x", None),
    (None, None),
])
def test_format_movement_date_text(spark, value, expected):
    assert one(spark, value, format_movement_date) == expected


def test_format_movement_date_timestamp(spark):
    df = spark.sql("select timestamp_ntz'2024-03-05 14:30:59' as t")
    assert df.select(format_movement_date(F.col("t"), T.TimestampNTZType())).first()[0] == "05/03/2024 14:30"


def test_int_id_and_text_or_nan(spark):
    assert one(spark, "42", int_id) == "42"
    assert one(spark, "42.0", int_id) == "42"
    assert one(spark, None, int_id) is None
    assert one(spark, None, text_or_nan) == "nan"


def test_badges_and_tag(spark):
    df = spark.createDataFrame([(True, False, " INCLUSAO")], "a boolean, b boolean, t string")
    r = df.select(join_badges(("CNM", F.col("a")), ("SGP", F.col("b"))).alias("l"),
                  source_tag(F.col("t")).alias("s")).first()
    assert r.l == "<span style='color:green'>CNM</span> | <span style='color:red'>SGP</span>"
    assert r.s == "CNM_EXCLUSAO"


EDGE_ENTITIES = [
    "a&amp;b &atilde; &#227; &#xE3;",
    "&amp;lt;",
    "&nosemi", "&ampx", "&notit;", "&#150;", "&#0;", "&#13;", "&#x110000;", "&#xD800;", "&#1;",
    "&#xFFFE;", "&#x1F600;", "&#99999999999999999999;", "&#;", "&#x;", "&", "&&amp", "a&", "&am",
    "&AMP", "&copy=3", "&ampamp;", "&#00065;", "&#X41", "&NewLine;", "&Tab;x", "&apos;", "&quot;",
    "&acE;", "&fjlig;", "&lt", "&LT;", "&gt;&lt;&amp;", "plain text", "", None,
    "&" + "a" * 40 + ";", "&#x0000041;", "&#0000000065;",
]


def test_html_unescape_edges(spark):
    df = spark.createDataFrame([(s,) for s in EDGE_ENTITIES], "x string")
    got = [r[0] for r in df.select(html_unescape("x")).collect()]
    want = [None if s is None else html.unescape(s) for s in EDGE_ENTITIES]
    assert got == want


def test_html_unescape_fuzz(spark):
    rnd = random.Random(7)
    alphabet = list("&#;xX0123456789abcdefAZ lmtgquoampcopy\n\t<>") + ["é", "😀"]
    names = ["amp", "lt", "gt", "copy", "middot", "quot", "not", "notin", "Aacute", "eacute", "nbsp"]
    samples = []
    for _ in range(3000):
        parts = []
        for _ in range(rnd.randint(0, 8)):
            k = rnd.random()
            if k < 0.3:
                parts.append("&" + rnd.choice(names) + rnd.choice(["", ";", "x", ";;"]))
            elif k < 0.45:
                parts.append("&#" + rnd.choice(["", "x", "X"]) + str(rnd.randint(0, 0x11FFFF)) + rnd.choice(["", ";"]))
            else:
                parts.append("".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 6))))
        samples.append("".join(parts))
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    got = [r[0] for r in df.select(html_unescape("x")).collect()]
    bad = [(s, g, html.unescape(s)) for s, g in zip(samples, got) if g != html.unescape(s)]
    assert not bad[:5]


def test_html_unescape_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = pages.select("page_id", "html", html_unescape("html").alias("u")).collect()
    assert all(r.u == html.unescape(r.html) for r in got)
