"""Property tests: the Spark operators against plain-Python statements of the
read API's behaviour, on random small inputs."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fleetlens.operators.filters import search
from fleetlens.operators.ordering import page_info, page_rows
from fleetlens.operators.setops import diff, upsert

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
TEXT = st.text(alphabet="aAbB%_. 1", max_size=5)
ROWS = st.lists(st.tuples(st.one_of(st.none(), TEXT), st.one_of(st.none(), TEXT), st.one_of(st.none(), TEXT)),
                min_size=0, max_size=12)


@SETTINGS
@given(rows=ROWS, q=st.one_of(st.none(), TEXT), cap=st.integers(min_value=1, max_value=5))
def test_search_matches_includes(spark, rows, q, cap):
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "id int, device_name string, device_eui string, application_name string")
    total, hits = search(df, q, ("device_name", "device_eui", "application_name"), ["device_name", "id"], cap)
    needle = (q or "").lower()
    expected = [r for r in data if any(v is not None and needle in v.lower() for v in r[1:])]
    assert total == len(expected)
    expected.sort(key=lambda r: (r[1] is None, r[1] or "", r[0]))
    assert [r.id for r in hits.collect()] == [r[0] for r in expected[:cap]]


@SETTINGS
@given(n=st.integers(min_value=0, max_value=30), page=st.integers(min_value=0, max_value=8),
       limit=st.integers(min_value=0, max_value=7))
def test_page_matches_slicing(spark, n, page, limit):
    df = spark.range(n).withColumnRenamed("id", "k")
    info = page_info(n, page, limit)
    p, size = info.page, info.limit
    expected = list(range(n))[(p - 1) * size: p * size]
    assert [r.k for r in page_rows(df, ["k"], page, limit).collect()] == expected
    assert (info.next_page is not None) == (p * size < n)
    assert (info.previous_page is not None) == ((p - 1) * size > 0)


KEYED = st.dictionaries(st.integers(min_value=0, max_value=9), st.one_of(st.none(), st.sampled_from("xyz")),
                        max_size=8)


@SETTINGS
@given(cur=KEYED, inc=KEYED)
def test_upsert_and_diff_invariants(spark, cur, inc):
    schema = "k int, v string"
    c = spark.createDataFrame(list(cur.items()), schema)
    i = spark.createDataFrame(list(inc.items()), schema)
    merged = {r.k: r.v for r in upsert(c, i, ["k"]).collect()}
    assert merged == {**cur, **inc}                          # insert or update, never delete
    assert {r.k: r.v for r in upsert(upsert(c, i, ["k"]), i, ["k"]).collect()} == merged
    kinds = {r.k: r.change for r in diff(c, i, ["k"]).collect()}
    for k in set(cur) | set(inc):
        if k not in cur:
            assert kinds[k] == "added"
        elif k not in inc:
            assert kinds[k] == "removed"
        else:
            assert kinds[k] == ("unchanged" if cur[k] == inc[k] else "changed")
