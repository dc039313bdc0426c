"""Scalar expressions on hand-made frames (FIXTURES.md §C)."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens.functions.exprs import (
    age_label, badge, codec_filename, deployment_status, device_activity, gateway_connection,
    hex_lower, non_blank, page_count, parse_long, safe_filename,
)

AS_OF = datetime(2024, 1, 30, 23, 58, 0)


def _ts_frame(spark, deltas):
    rows = [(i, None if d is None else AS_OF - d) for i, d in enumerate(deltas)]
    return spark.createDataFrame(rows, "i int, ts timestamp_ntz")


def test_device_activity_strict_bounds(spark, ctx):
    s = timedelta(seconds=1)
    deltas = [timedelta(hours=24) - s, timedelta(hours=24), timedelta(hours=24) + s,
              timedelta(days=7) - s, timedelta(days=7), timedelta(days=7) + s, None, -timedelta(hours=1)]
    got = [r[0] for r in _ts_frame(spark, deltas).orderBy("i")
           .select(device_activity(F.col("ts"), ctx)).collect()]
    # exactly 24 h old is not Active (strict >), exactly 7 d old is Inactive
    assert got == ["Active", "Recent", "Recent", "Recent", "Inactive", "Inactive", "Never", "Active"]


def test_gateway_connection_strict_bounds(spark, ctx):
    s = timedelta(seconds=1)
    deltas = [timedelta(minutes=5) - s, timedelta(minutes=5), timedelta(hours=1) - s, timedelta(hours=1),
              None]
    got = [r[0] for r in _ts_frame(spark, deltas).orderBy("i")
           .select(gateway_connection(F.col("ts"), ctx)).collect()]
    assert got == ["Online", "Recent", "Recent", "Offline", "Never Seen"]


def test_deployment_status(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, t), (2, t, None), (3, None, None), (4, None, t)],
                               "i int, s timestamp_ntz, c timestamp_ntz")
    got = [r[0] for r in df.orderBy("i").select(deployment_status(F.col("s"), F.col("c"))).collect()]
    assert got == ["Completed", "In Progress", "Pending", "Completed"]


def test_hex_lower(spark):
    df = spark.createDataFrame([(bytearray(b"\x00\xff\xab"),), (None,)], "b binary")
    assert [r[0] for r in df.select(hex_lower(F.col("b"))).collect()] == ["00ffab", None]


def test_codec_file_names_differ(spark):
    long_name = "Très/long name " + "x" * 60
    df = spark.createDataFrame([(1, "Dragino LDS02/v1.2"), (2, long_name), (3, None)], "id long, name string")
    rows = df.orderBy("id").select(codec_filename(F.col("name"), F.col("id")),
                                   safe_filename(F.col("name"), F.col("id"))).collect()
    assert rows[0] == ("Dragino_LDS02_v1.2_1.js", "Dragino_LDS02v12_1.js")
    meta, disk = rows[1]
    assert meta == long_name.replace(" ", "_").replace("/", "_") + "_2.js"
    assert disk == ("Trslong_name_" + "x" * 60)[:50] + "_2.js"
    assert rows[2] == (None, "_3.js")


def test_non_blank(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, "   "), (3, "\t"), (4, "  x ")], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(non_blank(F.col("s"))).collect()]
    # trim removes spaces only: a tab-only text stays non-blank
    assert [bool(x) for x in got] == [False, False, False, True, True]


def test_age_label_and_badge(spark, ctx):
    deltas = [timedelta(seconds=30), timedelta(minutes=2, seconds=59), timedelta(hours=1, minutes=1),
              timedelta(days=2, hours=3), None, -timedelta(minutes=3)]
    df = _ts_frame(spark, deltas).orderBy("i")
    assert [r[0] for r in df.select(age_label(F.col("ts"), ctx)).collect()] == [
        "just now", "2 min ago", "1h ago", "2d ago", "Never", "just now"]
    s = spark.createDataFrame([(x,) for x in ["Online", "Active", "Recent", "Offline", "Inactive",
                                              "Never", "Never Seen", "Other"]], "s string")
    assert [r[0] for r in s.select(badge(F.col("s"))).collect()] == [
        "green", "green", "amber", "red", "red", "gray", "gray", "gray"]


@pytest.mark.parametrize("text,expected", [("12", 12), (" 7 ", 7), ("", None), ("1.5", None),
                                           ("abc", None), ("-3", -3)])
def test_parse_long(spark, text, expected):
    df = spark.createDataFrame([(text,)], "s string")
    assert df.select(parse_long(F.col("s"))).first()[0] == expected


def test_page_count(spark):
    df = spark.createDataFrame([(0,), (100,), (101,)], "n long")
    assert [r[0] for r in df.select(page_count(F.col("n"), 100)).collect()] == [0, 1, 2]
