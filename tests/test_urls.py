from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from portalmeter.functions.urls import decode_plus, normalise_page_path, repair_latin1, spelling_root, with_spellings

LANGUAGES = ("es", "en", "eu", "ca", "gl")


def value_of(spark, function, text):
    return spark.createDataFrame([(text,)], "x string").select(function(F.col("x"))).first()[0]


@pytest.mark.parametrize(
    ("path", "expected"),
    [
        ("/portal.example.org/catalogo/weekly_fuel_prices", "/catalogo/weekly_fuel_prices"),
        ("/catalogo/weekly_fuel_prices", "/catalogo/weekly_fuel_prices"),
        ("/es/catalogo/weekly_fuel_prices", "/catalogo/weekly_fuel_prices"),
        # A first segment with a dot counts as a host, wherever the dot is from.
        ("/a.html", "/"),
        ("/x?v=1.2/y", "/y"),
        ("/.hidden/x", "/.hidden/x"),
        # The final slash goes only together with a language.
        ("/es/catalogo/x/", "/catalogo/x"),
        ("/catalogo/x/", "/catalogo/x/"),
        ("/es/", ""),
        ("/es", "/es"),
        # Several languages go in the order they are offered in, unless a final slash ended the search.
        ("/es/en/catalogo/x", "/catalogo/x"),
        ("/en/es/catalogo/x", "/es/catalogo/x"),
        ("/es/en/catalogo/x/", "/en/catalogo/x"),
        ("/es/es/catalogo/x", "/es/catalogo/x"),
        ("https://host.org/en/catalogo/x", "/catalogo/x"),
        ("https://host.org", "/"),
        ("http://host.org//x", "//x"),
        ("https://localhost/x", "https://localhost/x"),
        ("", ""),
        (None, None),
    ],
)
def test_normalise_page_path(spark, path, expected):
    df = spark.createDataFrame([(path,)], "url string")
    assert rows_of(normalise_page_path(df, "url", LANGUAGES)) == [(expected,)]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("50%+x%zz%41", "50% x%zzA"),
        ("a%2Fb%20c", "a/b c"),
        ("a%C3%B1o", "año"),
        ("100%", "100%"),
        ("%4", "%4"),
        ("", ""),
        (None, None),
    ],
)
def test_decode_plus(spark, text, expected):
    assert value_of(spark, decode_plus, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [("Ã±", "ñ"), ("ñ", None), ("€", None), ("plain", "plain"), ("aÃ±o\n", "año\n"), (None, None)],
)
def test_repair_latin1(spark, text, expected):
    assert value_of(spark, repair_latin1, text) == expected


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("http://f/x", ["http://f/x"]),
        ("http://f/x/", ["http://f/x/", "http://f/x"]),
        ("http://f/a+b", ["http://f/a+b", "http://f/a b"]),
        ("http://f/Ã±/", ["http://f/Ã±/", "http://f/ñ/", "http://f/Ã±", "http://f/ñ"]),
        # Encoded bytes of a text already read in the wrong charset: decoding alone does not give it back.
        ("%C3%83%C2%B1", ["%C3%83%C2%B1", "Ã±", "ñ"]),
        ("http://f/x//", ["http://f/x//", "http://f/x/"]),
        (None, [None]),
    ],
)
def test_spellings(spark, text, expected):
    got = with_spellings(spark.createDataFrame([(text,)], "url string"), "url", "spellings")
    assert got.columns == ["url", "spellings"]
    assert got.first()["spellings"] == expected


ROOTS = [
    "http://f/a b", "http://f/a+b/", "http%3A%2F%2Ff%2Fa%2520b%2F", "x%25%34%31//", "%25%32%35%34%31", "Ã±%C3%B1/", "ñ%C3%B1",
    "http://f/%C3%91/%C3", "http://f/%C3/", "%", "%2", "%2/", "%zz%+", "a%2B%2b", "文件/%E6%96%87", "/", "", "Ã%B1/",
]


@pytest.mark.parametrize("text", ROOTS)
def test_all_spellings_have_one_root(spark, text):
    listed = with_spellings(spark.createDataFrame([(text,)], "x string"), "x", "forms").select(F.explode("forms").alias("form"))
    assert listed.select(spelling_root(F.col("form"))).distinct().count() == 1
    assert listed.select(spelling_root(F.col("form"))).first()[0] == value_of(spark, spelling_root, text)
