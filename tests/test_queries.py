"""Every registered query against its DuckDB oracle on the smallest tables,
plus invariants of the export registry."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


ORACLE = se.oracle_sql()


@pytest.mark.parametrize("name", sorted(se.queries()))
def test_query_matches_oracle(spark, con, name):
    df = se.queries()[name](spark, SF)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert len(rows) > 0
        return
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _rows(cols, rows) == _rows(ocols, orows)


def test_entry(spark):
    df = se.entry(spark)
    assert df.count() == 25 and "total_devices" in df.columns


def test_every_library_query_has_an_oracle():
    from fleetlens.catalog import query_registry
    assert set(query_registry()) <= set(ORACLE)


def test_summary_totals_equal_children(spark):
    from fleetlens.catalog import open_fleet
    from fleetlens.context import DEFAULT_CONTEXT
    from fleetlens.plans.exports import EXPORTS
    t = open_fleet(spark, SF)
    ds = EXPORTS["device_summary"].build(t, DEFAULT_CONTEXT)
    total = ds.agg({"total_devices": "sum"}).first()[0]
    # devices whose application has a tenant
    devices = t["device"].join(t["application"].filter("tenant_id IS NOT NULL"),
                               t["device"]["application_id"] == t["application"]["id"]).count()
    assert total == devices
    codecs_meta = EXPORTS["payload_codecs_metadata"].build(t, DEFAULT_CONTEXT).count()
    codec_files = EXPORTS["codec_scripts"].build(t, DEFAULT_CONTEXT).count()
    assert codecs_meta == codec_files == EXPORTS["codec_count"].build(t, DEFAULT_CONTEXT).first()[0]
