"""The walk numbers all pages in one sort, whatever their number."""

import random

from fleetlens.plans.views import page_walk


def test_page_walk_numbers_every_device_in_one_plan(spark, ctx):
    r = random.Random(4)
    rows = [(r.choice(["same", "same", "a", "b", "zz", None]), bytes([i // 256, i % 256])) for i in range(700)] + [("a", None)]
    df = spark.createDataFrame(rows, "name string, dev_eui binary").repartition(7)
    df = df.selectExpr("*", "'app' AS application_id")
    for limit in (7, 64, 1000):
        out = page_walk({"device": df}, ctx, limit)
        assert out._jdf.queryExecution().optimizedPlan().toString().count("Union") == 0
        order = sorted(((n, e.hex() if e is not None else None) for n, e in rows),
                       key=lambda x: (x[0] is None, x[0] or "", x[1] is None, x[1] or ""))
        want = [(e, n, k // limit + 1) for k, (n, e) in enumerate(order)]
        assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, want))
    assert page_walk({"device": df.limit(0)}, ctx, 7).count() == 0
