"""Fleet inventory analytics on Spark.

Reads the tables of one or more LoRaWAN network servers as DataFrames,
denormalises them into named exports, summarises them per tenant and serves
the read-side queries (search, paging, breakdowns, KPIs) on top of them.

Typical use::

    from fleetlens import RunContext, open_fleet, EXPORTS, VIEWS, refresh
    tables = open_fleet(spark, "/data/driver-tables")          # or load_tables / load_jdbc_tables
    ctx = RunContext(as_of=datetime(2024, 1, 30, 23, 58))
    EXPORTS["device_summary"].build(tables, ctx).show()
    refresh(spark, tables, ctx, root="/shared/exports")        # write, publish, retain
"""

from fleetlens.catalog import open_fleet, query_registry
from fleetlens.context import RunContext
from fleetlens.plans.exports import EXPORTS, RUN_EXPORTS
from fleetlens.plans.views import VIEWS
from fleetlens.sinks.snapshot import refresh, run_exports
from fleetlens.sources.tables import load_jdbc_tables, load_tables

__all__ = ["RunContext", "open_fleet", "query_registry", "EXPORTS", "RUN_EXPORTS", "VIEWS", "refresh",
           "run_exports", "load_tables", "load_jdbc_tables"]
