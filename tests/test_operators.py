from decimal import Decimal

"""Joins, aggregations, paging, search and restriction on small frames."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens.operators.aggs import breakdown, bucket_counts, child_counts, count_when, string_agg
from fleetlens.operators.filters import restrict, search
from fleetlens.operators.joins import lookup, orphans, with_counts
from fleetlens.operators.ordering import page_info, page_rows, sort_export

AS_OF = datetime(2024, 1, 30, 23, 58, 0)


def test_lookup_keeps_row_count(spark):
    fact = spark.createDataFrame([(1, 10), (2, 10), (3, None), (4, 99)], "id int, fk int")
    dim = spark.createDataFrame([(10, "a"), (11, "b")], "id int, name string")
    out = lookup(fact, dim, "fk", "id", {"dim_name": "name"})
    assert out.count() == 4
    assert dict(out.select("id", "dim_name").collect()) == {1: "a", 2: "a", 3: None, 4: None}


def test_orphans_skip_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,)], "id int")
    assert [r.id for r in orphans(child, parent, "fk", "id").collect()] == [3]


def test_with_counts_no_fan_out(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    devices = spark.createDataFrame([(1,), (1,), (1,)], "tid int").groupBy("tid").agg(
        F.count(F.lit(1)).alias("devices"))
    gws = spark.createDataFrame([(1,), (1,)], "tid int").groupBy("tid").agg(F.count(F.lit(1)).alias("gateways"))
    out = {r.id: (r.devices, r.gateways) for r in with_counts(parent, "id", [(devices, "tid"), (gws, "tid")]).collect()}
    assert out == {1: (3, 2), 2: (0, 0)}


def test_bucket_counts_boundary(spark, ctx):
    rows = [(AS_OF - timedelta(minutes=1),), (AS_OF - timedelta(hours=1),), (AS_OF - timedelta(hours=2),), (None,)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    b = bucket_counts(F.col("ts"), ctx)
    r = df.agg(*[v.alias(k) for k, v in b.items()]).first()
    # exactly one hour old counts as recent and as offline; never seen is offline
    assert (r.online, r.recent, r.offline) == (1, 1, 3)


def test_string_agg_null_for_no_values(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "c"), (2, "x"), (3, None)], "u int, name string")
    out = dict(df.groupBy("u").agg(string_agg("name").alias("s")).collect())
    assert out == {1: "a, b, c", 2: "x", 3: None}


def test_count_when_ignores_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "b boolean")
    assert df.agg(count_when(F.col("b") == F.lit(False))).first()[0] == 1


def test_breakdown_and_child_counts(spark):
    df = spark.createDataFrame([("A",), ("A",), (None,)], "s string")
    assert dict(breakdown(df, "s").collect()) == {"A": 2, "Unknown": 1}
    parent = spark.createDataFrame([(1, "p1"), (2, "p2")], "id int, name string")
    child = spark.createDataFrame([(1,), (1,)], "pid int")
    got = {r.id: r.n for r in child_counts(parent, "id", child, "pid", "n").collect()}
    assert got == {1: 2, 2: 0}


def test_sort_nulls_like_the_source_database(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id int, k string")
    assert [r.id for r in sort_export(df, ["k"]).collect()] == [3, 1, 2]
    assert [r.id for r in sort_export(df, [("k", "desc")]).collect()] == [2, 1, 3]


@pytest.mark.parametrize("total,page,limit,expected", [
    (0, 1, 100, (0, None, None)),
    (200, 2, 100, (2, None, 1)),
    (250, 3, 100, (3, None, 2)),
    (250, 1, 100, (3, 2, None)),
    (250, 9, 100, (3, None, 8)),
    (250, 0, 100, (3, 2, None)),       # page 0 -> default page 1
    (250, "x", 0, (3, 2, None)),       # unparsable / 0 -> defaults
    (250, "2abc", "100.7", (3, 3, 1)),  # leading integer, as parseInt
])
def test_page_info(total, page, limit, expected):
    info = page_info(total, page, limit)
    assert (info.total_pages, info.next_page, info.previous_page) == expected


def test_page_rejects_negative():
    with pytest.raises(ValueError):
        page_info(10, -1, 5)


def test_page_rows(spark):
    df = spark.range(0, 23).withColumnRenamed("id", "k")
    assert [r.k for r in page_rows(df, ["k"], 3, 10).collect()] == [20, 21, 22]
    assert page_rows(df, ["k"], 4, 10).count() == 0
    assert [r.k for r in page_rows(df, ["k"], 1, 5).collect()] == [0, 1, 2, 3, 4]


def test_search_literal_case_insensitive(spark):
    rows = [("Dev-%1", "aa", None), ("dev_2", "bb", "App.X"), ("other", "cc", "app")]
    df = spark.createDataFrame(rows, "device_name string, device_eui string, application_name string")
    cols = ("device_name", "device_eui", "application_name")
    assert search(df, "%", cols, ["device_name"])[0] == 1      # % is literal, not a wildcard
    assert search(df, "_", cols, ["device_name"])[0] == 1
    assert search(df, "APP.", cols, ["device_name"])[0] == 1   # . literal, case-insensitive
    assert search(df, "", cols, ["device_name"])[0] == 3       # empty query matches all
    assert search(None and df or df, None, cols, ["device_name"])[0] == 3


def test_search_cap_counts_before_limit(spark):
    df = spark.range(0, 250).select(F.concat(F.lit("dev-"), F.lpad(F.col("id").cast("string"), 3, "0"))
                                    .alias("device_name"), F.lit("e").alias("device_eui"),
                                    F.lit(None).cast("string").alias("application_name"))
    total, rows = search(df, "dev", ("device_name", "device_eui", "application_name"), ["device_name"])
    assert total == 250 and rows.count() == 100
    assert rows.first().device_name == "dev-000"


def test_restrict_masks_keys(spark):
    df = spark.createDataFrame([("k1", None, "x")], "app_key string, network_key string, device_name string")
    r = restrict(df, "viewer").first()
    assert (r.app_key, r.network_key, r.device_name) == ("***", None, "x")
    assert restrict(df, "admin").first().app_key == "k1"
    assert "app_key" not in restrict(df, "viewer", mode="drop").columns


def test_by_id(spark):
    from fleetlens.operators.filters import by_id
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    assert [r.v for r in by_id(df, "id", 2).collect()] == ["b"]
    assert by_id(df, "id", "not-a-number").count() == 0      # malformed id matches nothing


def test_avg_round_half_up_and_empty(spark):
    from fleetlens.operators.aggs import avg_round
    df = spark.createDataFrame([(1, 0.125), (1, None), (2, None)], "g int, b double")
    out = dict(df.groupBy("g").agg(avg_round(F.sum("b"), F.count("b")).alias("a")).collect())
    assert out == {1: 0.13, 2: None}


def test_page_after_keyset(spark):
    from fleetlens.operators.ordering import page_after, sort_export
    rows = [("a", 1), ("a", 2), ("a", 3), ("b", 4), (None, 5), (None, 6), ("", 7)]
    df = spark.createDataFrame(rows, "k string, id int")
    for keys in (["k", "id"], [("k", "desc"), "id"], [("k", "desc"), ("id", "desc")]):
        seen, after = [], None
        while page := page_after(df, keys, after, 2).collect():
            seen += page
            after = page[-1].asDict()
        whole = [tuple(r) for r in sort_export(df, keys).collect()]
        assert [tuple(r) for r in seen] == whole and len(seen) == len(rows)  # ties and NULL keys once each


def test_sum_columns_parses_text(spark):
    from fleetlens.operators.aggs import sum_columns
    df = spark.createDataFrame([("3", 2), ("x", 5), (None, None)], "a string, b int")
    r = sum_columns(df, {"total_a": "a", "total_b": "b"}).first()
    assert (r.total_a, r.total_b) == (3, 7)      # malformed text counts as nothing


def test_average_is_rounded_once(spark):
    from fleetlens.operators.aggs import avg_round
    df = spark.createDataFrame([(Decimal("468999.91"), 200000), (Decimal("-468999.91"), 200000), (Decimal("0.01"), 2),
                                (Decimal("5"), 0), (None, 3)], "total decimal(12,2), n long")
    got = [r[0] for r in df.select(avg_round(F.col("total"), F.col("n"))).collect()]
    assert got == [2.34, -2.34, 0.01, None, None]  # 2.34499955 is not 2.345 first


def test_content_hash_keeps_values_apart(spark):
    from fleetlens.operators.setops import diff
    old = spark.createDataFrame([(1, "a\u0001Vb", "c")], "id int, x string, y string")
    new = spark.createDataFrame([(1, "a", "b\u0001Vc")], "id int, x string, y string")
    assert diff(old, new, ["id"]).first().change == "changed"
