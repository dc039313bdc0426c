"""Registry of every query the package offers, as ``(spark, sf_dir) -> DataFrame``.

Each callable loads the driver tables of ``sf_dir`` lazily, maps them onto
the fleet schema and returns the query's DataFrame. Exports are returned
without running; searches, pages and the queries over written files run the
jobs that cut or write their rows first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fleetlens.context import DEFAULT_CONTEXT, RunContext
from fleetlens.plans.exports import EXPORTS
from fleetlens.session import apply_session_defaults, ensure_checkpoint_dir
from fleetlens.sources.fixtures import fleet_tables
from fleetlens.sources.tables import load_tables

QueryFn = Callable[[SparkSession, str], DataFrame]


_OPEN: dict = {}


def open_fleet(spark: SparkSession, sf_dir: str):
    """Fleet tables over ``sf_dir``; the same lazy handles are reused for the
    whole session, so queries that build on a written run share it."""
    apply_session_defaults(spark)
    ensure_checkpoint_dir(spark)
    try:
        app = spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext
        app = id(spark)
    key = (app, sf_dir.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = fleet_tables(load_tables(spark, sf_dir))
    return _OPEN[key]


def _export_query(name: str, ctx: RunContext) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return EXPORTS[name].build(open_fleet(spark, sf_dir), ctx)
    run.__name__ = f"export_{name}"
    return run


def query_registry(ctx: RunContext = DEFAULT_CONTEXT) -> dict[str, QueryFn]:
    reg: dict[str, QueryFn] = {name: _export_query(name, ctx) for name in EXPORTS}
    from fleetlens.plans.views import view_registry
    reg.update(view_registry(ctx))
    return reg
