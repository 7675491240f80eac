"""Case tables: text and the value it stands for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vidpipe.functions import text, urls, values

def now():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")



VIEWS = {
    "1,234 views": 1234, "1.234 visualizaciones": 1234, "1.2K": 1200, "3,4 mil": 3400000, "2.1M": 2100000, "1B": 10**9, "No views": 0, "sin vistas": 0,
    "1.234.567": None, "1,234,567": 1234567, "1,5": 15, "1.5": 1, "1.234,56": 1234, "1,234.567.8": None, "   ": None, None: None, "abc": None, "12 M": 12000000,
}
DURATIONS = {
    "12:34": 754, "1:02:03": 3723, "0:00": 0, "99:99": 6039, "1:2:3:4": None, "1 hour 2 minutes": 3720, "1 hora, 2 minutos": 3720, "1h2m": 120, "1.5 hours": 18000,
    "0 min": None, "SHORTS": None, None: None, "": None,
}
PUBLISHED = {
    "2 days ago": "2024-01-30", "hace 2 días": "2024-01-30", "Streamed 3 weeks ago": "2024-01-11", "hace 3 meses": None, "hace 1 mes": "2024-01-02", "yesterday": "2024-01-31",
    "ayer": "2024-01-31", "30 seconds ago": None, "Jan 3, 2024": "2024-01-03", "2024-01-03": "2024-01-03", "3 January 2024": "2024-01-03", "Premiered Jan 3, 2024": None, "": None, None: None,
}


def _run(spark, cases, column, kind="string"):
    rows = spark.createDataFrame([(k,) for k in cases], f"x {kind}")
    return {r["x"]: r["y"] for r in rows.select("x", column.alias("y")).collect()}


def test_views(spark):
    assert _run(spark, VIEWS, text.parse_views(F.col("x"))) == VIEWS


def test_views_longest_suffix(spark):
    assert _run(spark, {"3,4 mil": 3400}, text.parse_views(F.col("x"), longest_suffix=True)) == {"3,4 mil": 3400}


def test_durations(spark):
    assert _run(spark, DURATIONS, text.parse_duration(F.col("x"))) == DURATIONS


def test_published(spark):
    expected = {k: dt.datetime.fromisoformat(v) if v else None for k, v in PUBLISHED.items()}
    shown = F.to_timestamp_ntz(F.date_format(text.parse_published(F.col("x"), now()), "yyyy-MM-dd HH:mm:ss"))
    assert _run(spark, PUBLISHED, shown) == expected


def test_plural_months(spark):
    got = _run(spark, ["hace 3 meses"], F.date_format(text.parse_published(F.col("x"), now(), fix_plural_months=True), "yyyy-MM-dd"))
    assert got == {"hace 3 meses": "2023-11-03"}


@pytest.mark.parametrize(("json", "expected"), [("true", None), ("12", 12), ("12.9", 12), ("-1.5", -1), ('" 7 "', 7), ('"7.5"', None), ("null", None), ("[1]", None)])
def test_coerce_int(spark, json, expected):
    assert _run(spark, [json], values.coerce_int(F.parse_json("x"))) == {json: expected}


def test_upload_date(spark):
    row = spark.sql("SELECT '' g, 0L e, 1706659200L r, CAST(NULL AS STRING) n, 10000000000000L far")
    got = row.select(values.upload_date(F.col("g"), F.col("e"), F.col("r")), values.upload_date(F.col("n"), F.col("far"), F.col("r"))).first()
    assert tuple(got) == ("20240131", None)


def test_search_url(spark):
    assert _run(spark, ["a b/c*~+é"], urls.search_url("", F.col("x"))) == {"a b/c*~+é": "a%20b/c%2A~%2B%C3%A9"}


def test_ensure_timestamp(spark):
    got = _run(spark, ["2024-01-02T03:04:05", "2024", "x", None], values.ensure_timestamp(F.col("x")).isNotNull())
    assert got == {"2024-01-02T03:04:05": True, "2024": False, "x": False, None: False}
