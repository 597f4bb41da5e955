"""Calendar, safe casts, URL quoting, surrogate keys."""

from __future__ import annotations

import datetime as dt
import urllib.parse

import pytest
from pyspark.sql import functions as F

from civic_mart.functions import calendar as cal
from civic_mart.functions import casts, keys, text


def _dates():
    out = [dt.date(y, 1, 1) for y in range(2016, 2024)]        # 1 January on every weekday
    out += [dt.date(y, 12, 31) for y in range(2016, 2024)]
    out += [dt.date(2020, 2, 29), dt.date(2024, 2, 29), dt.date(2023, 1, 7), dt.date(2023, 1, 8)]
    return out


def test_sunday_week_weekend_and_names(spark):
    df = spark.createDataFrame([(d,) for d in _dates()], "d date")
    got = df.select("d", cal.sunday_week(F.col("d")).alias("w"), cal.is_weekend(F.col("d")).alias("we"),
                    cal.month_name(F.col("d")).alias("m"), cal.day_name(F.col("d")).alias("a"),
                    cal.date_id(F.col("d")).alias("id")).collect()
    for r in got:
        d = r["d"]
        assert r["w"] == int(d.strftime("%U")) and 0 <= r["w"] <= 53
        assert r["we"] == (1 if d.weekday() >= 5 else 0)
        assert r["m"] == d.strftime("%B") and r["a"] == d.strftime("%A") and r["id"] == d.isoformat()


def test_parse_day_month_year_round_trip(spark):
    df = spark.createDataFrame([(d,) for d in _dates()], "d date")
    got = df.select("d", cal.parse_day_month_year(F.dayofmonth("d"), cal.month_name(F.col("d")), F.year("d")).alias("p"))
    assert all(r["d"] == r["p"] for r in got.collect())


def test_hour_diff_truncates_toward_zero(spark):
    t = lambda s: dt.datetime.fromisoformat(s)
    df = spark.createDataFrame([(t("2024-01-01 10:59:00"), t("2024-01-01 12:58:59")),
                                (t("2024-01-01 12:00:00"), t("2024-01-01 10:01:00")),
                                (t("2024-01-01 12:00:00"), None)], "a timestamp_ntz, b timestamp_ntz")
    assert [r[0] for r in df.select(cal.hour_diff(F.col("a"), F.col("b"))).collect()] == [1, -1, None]


def py_float(s):
    try:
        return float(s)
    except (TypeError, ValueError):
        return None


def py_int(s):
    try:
        return int(s)
    except (TypeError, ValueError):
        return None


BAD = ["abc", "12.0", " 7 ", "1_000", "", None, "-3", "2.5e3", "1__0", "_1", "0012"]


def test_safe_casts_follow_python_parsers(spark):
    df = spark.createDataFrame([(v,) for v in BAD], "s string")
    got = df.select("s", casts.safe_double(F.col("s")).alias("d"), casts.safe_long(F.col("s")).alias("l")).collect()
    for r in got:
        assert r["d"] == py_float(r["s"]), r
        assert r["l"] == py_int(r["s"]), r


def test_strict_timestamp_raises_and_try_variant_is_null(spark):
    df = spark.createDataFrame([("2023-12-01T10:11:12.000",), ("not a date",)], "s string")
    good = df.where(F.col("s") != "not a date")
    assert good.select(casts.ts_iso(F.col("s"))).first()[0] == dt.datetime(2023, 12, 1, 10, 11, 12)
    with pytest.raises(Exception):
        df.select(casts.ts_iso(F.col("s"))).collect()
    assert [r[0] for r in df.select(casts.try_ts_iso(F.col("s"))).collect()][1] is None


def test_us_ampm_timestamp(spark):
    df = spark.createDataFrame([("08/02/2023 03:40:00 PM",), ("01/01/2020 12:05:00 AM",), (None,)], "s string")
    got = [r[0] for r in df.select(casts.ts_us_ampm(F.col("s"))).collect()]
    assert got == [dt.datetime(2023, 8, 2, 15, 40), dt.datetime(2020, 1, 1, 0, 5), None]


QUERIES = ['SELECT COUNT(*) AS `count` WHERE (`created_date` >= "2024-01-01T00:00:00" :: floating_timestamp)',
           "a/b * ~x 'q' +1 ,;=?&@:#[]{}|^%", "caseless_eq(`complaint_type`, \"Rodent\") LIMIT 1000 OFFSET 0", "é ü 中"]


def test_url_quote_matches_urllib(spark):
    df = spark.createDataFrame([(q,) for q in QUERIES], "q string")
    got = [r[0] for r in df.select(text.url_quote(F.col("q"))).collect()]
    assert got == [urllib.parse.quote(q) for q in QUERIES]


def test_surrogate_key_null_safe_and_stable(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a|", "b"), ("a", "|b")], "x string, y string")
    ids = [r[0] for r in df.select(keys.surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert len(set(ids)) == 4
    again = [r[0] for r in df.repartition(3).select(keys.surrogate_key(F.col("x"), F.col("y"))).collect()]
    assert sorted(ids) == sorted(again)


def test_borough_key(spark):
    df = spark.createDataFrame([("Queens",), (None,), ("QUEENS",)], "b string")
    assert [r[0] for r in df.select(text.borough_key(F.col("b"))).collect()] == ["queens", "", "queens"]
