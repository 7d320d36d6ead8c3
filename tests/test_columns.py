"""Measures and text parsing, value by value."""

import datetime

import pytest
from pyspark.sql import functions as F

from episeries.functions import measures as m
from episeries.functions import textnum as t
from episeries.functions.domains import decade_bands


def value(spark, column, **inputs):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()])
    return frame.select(column.alias("v")).first()["v"]


C = F.col


@pytest.mark.parametrize("a, b, expected", [
    (0, 0, 0.0), (3, 0, None), (1, 4, 25.0), (0, 4, 0.0), (None, 4, 0.0),
])
def test_safe_percentage(spark, a, b, expected):
    got = value(spark, m.safe_percentage(C("a"), C("b")),
                a=F.lit(a).cast("long"), b=F.lit(b).cast("long"))
    assert got == expected


def test_rates(spark):
    assert value(spark, m.per_population(C("a"), C("b")), a=5, b=200) == 2500.0
    assert value(spark, m.per_population(C("a"), C("b")), a=5, b=0) is None
    assert value(spark, m.inverted_rate(C("a")), a=10.0) == 10000.0
    assert value(spark, m.inverted_rate(C("a")), a=20.0) == 5000.0
    assert value(spark, m.inverted_rate(C("a")), a=F.lit(None).cast("double")) == 10000.0
    assert value(spark, m.share_of_sum(C("a"), C("b")), a=1, b=3) == 25.0
    assert value(spark, m.complement(C("a")), a=30.5) == 69.5
    assert value(spark, m.sample_size(C("a"), C("b")), a=50.0, b=7) == 14
    assert value(spark, m.sample_size(C("a"), C("b")), a=0.0, b=7) is None
    days = m.annualise(C("a"), F.to_date(F.lit("2020-03-15")), F.to_date(F.lit("2020-03-25")))
    assert value(spark, days, a=2) == 73.0


@pytest.mark.parametrize("x, expected", [(0.5, 0), (1.5, 2), (2.5, 2), (-0.5, 0), (3.49, 3)])
def test_round_half_even(spark, x, expected):
    assert value(spark, m.round_to_long(C("a")), a=x) == expected


def test_percent_change(spark):
    assert value(spark, m.percent_change(C("a"), C("b")), a=0, b=9) == 0.0
    assert value(spark, m.percent_change(C("a"), C("b")), a=4, b=5) == 25.0
    null = F.lit(None).cast("long")
    assert value(spark, m.percent_change(C("a"), C("b")), a=null, b=5) is None


@pytest.mark.parametrize("text, expected", [
    ("1.234", 1234), ("12%", 12), ("-", None), ("", None), ("x", None), ("1,5", None), ("-3", -3),
])
def test_locale_long(spark, text, expected):
    assert value(spark, t.locale_long(C("a")), a=text) == expected


@pytest.mark.parametrize("text, expected", [
    ("12,5%", 12.5), ("7", 7.0), ("NaN", None), ("1d", None), ("e", None), ("", None), ("0,08", 0.08),
])
def test_locale_double(spark, text, expected):
    assert value(spark, t.locale_double(C("a")), a=text) == expected


def test_ranges_and_tokens(spark):
    assert tuple(value(spark, t.numeric_range(C("a")), a="(2-5)")) == (2, 5)
    assert tuple(value(spark, t.numeric_range(C("a")), a="-")) == (None, None)
    assert value(spark, t.normalise(C("a")), a=" a  b \n\tc\x1cd ") == "a b c d"
    assert value(spark, t.at(t.tokens(C("a")), -2), a="x y z") == "y"
    assert value(spark, t.at(t.tokens(C("a")), 9), a="x y z") is None
    assert value(spark, t.every_second(t.tokens(C("a")), 1), a="a b c d") == ["b", "d"]
    assert value(spark, t.after_last(C("a"), "--"), a="p--q--r") == "r"
    assert value(spark, t.spaced(C("a")), a="País_Vasco") == "País Vasco"


@pytest.mark.parametrize("text, expected", [
    ("3 de junio de 2021", (2021, 6, 3)), ("3 Junio de 2021", (2021, 6, 3)),
    ("03-06-2021", (2021, 6, 3)), ("31 de febrero de 2021", None), ("ayer", None),
])
def test_spanish_date(spark, text, expected):
    got = value(spark, t.spanish_date(C("a")), a=text)
    assert got == (datetime.date(*expected) if expected else None)


@pytest.mark.parametrize("page", [
    "x Fecha del informe: 3 de junio de 2021 y", "Situación de COVID-19 en España a 03-06-2021.",
    "Informe COVID-2019 nº 47. 3 de junio de 2021", "Informe SARS-CoV-2 nº 12. 3 junio de 2021 z",
    "Informe COVID-19 nº 99. 3 de junio de 2021", "Informe COVID–19 . 3 de junio de 2021",
])
def test_cover_date(spark, page):
    assert value(spark, t.cover_date(C("a")), a=page) == datetime.date(2021, 6, 3)


def test_other_dates(spark):
    day = datetime.date(2021, 7, 14)
    assert value(spark, t.month_name_date(C("a")), a="14JUL2021") == day
    assert value(spark, t.compact_date(C("a")), a="20210714") == day
    assert value(spark, t.pdf_creation_date(C("a")), a="D:20210714093000+02'00'") == day
    assert value(spark, t.iso_date(C("a")), a="14/07/2021") is None


def test_decade_bands():
    bands = decade_bands()
    assert bands["0-1"] == bands["1-4"] == bands["5-9"] == "0-9"
    assert bands["75-79"] == "70-79" and bands["80-84"] == bands["≥90"] == bands["95+"] == "80+"
