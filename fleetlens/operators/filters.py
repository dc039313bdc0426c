"""Filters and predicates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.functions.exprs import age_label, badge
from fleetlens.context import RunContext


def pending_only(df: DataFrame, col: str = "is_pending") -> DataFrame:
    """boolean equality filter; NULL rows are dropped."""
    return df.filter(F.col(col) == F.lit(True))


def by_id(df: DataFrame, col: str, value) -> DataFrame:
    """key lookup; a malformed id simply matches nothing."""
    dtype = dict(df.dtypes)[col]
    return df.filter(F.col(col) == F.lit(str(value)).try_cast(dtype))


def search_predicate(q: str | None, cols: Sequence[str]) -> Column:
    """case-insensitive literal substring over several columns; a NULL
    column never matches; an empty or missing query matches any row with at
    least one non-NULL column."""
    needle = (q or "").lower()
    pred = None
    for c in cols:
        p = F.coalesce(F.lower(F.col(c)).contains(F.lit(needle)), F.lit(False))
        pred = p if pred is None else pred | p
    return pred


def search(df: DataFrame, q: str | None, cols: Sequence[str], order: Sequence[str],
           cap: int = 100) -> tuple[int, DataFrame]:
    """(number of matches before the cap, first ``cap`` matches in
    ``order``). The rows are a top-k (no global sort); the total is one
    aggregate."""
    matches = df.filter(search_predicate(q, cols))
    total = matches.count()
    rows = matches.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(cap)
    return total, rows


def filter_status(df: DataFrame, col: str, value: str) -> DataFrame:
    """rows with a given status."""
    return df.filter(F.col(col) == F.lit(value))


def device_filter(df: DataFrame, active_only: bool = False, tenant: str | None = None,
                  application: str | None = None) -> DataFrame:
    """the device page's optional filters, combined with AND. Active
    means not disabled."""
    out = df
    if active_only:
        out = out.filter(F.col("is_disabled") == F.lit(False))
    if tenant is not None:
        out = out.filter(F.col("tenant_name") == F.lit(tenant))
    if application is not None:
        out = out.filter(F.col("application_name") == F.lit(application))
    return out


def active_servers(df: DataFrame) -> DataFrame:
    """F12."""
    return df.filter(F.col("status") == F.lit("Active"))


def low_battery(df: DataFrame, below: float = 20, col: str = "battery_level") -> DataFrame:
    """battery strictly below the threshold; unknown battery excluded."""
    return df.filter(F.col(col) < F.lit(below))


# Columns only an admin may read (portal security notes).
SENSITIVE_COLUMNS = ("app_key", "network_key", "network_session_key", "application_session_key",
                     "configuration_json")
MASK = "***"


def restrict(df: DataFrame, role: str, mode: str = "mask") -> DataFrame:
    """role-based column restriction. Admins see everything; any other
    role gets the sensitive columns masked (or dropped with ``mode='drop'``).
    NULL stays NULL so "no key" is still visible."""
    if role == "admin":
        return df
    present = [c for c in SENSITIVE_COLUMNS if c in df.columns]
    if mode == "drop":
        return df.drop(*present)
    return df.withColumns({c: F.when(F.col(c).isNotNull(), F.lit(MASK)) for c in present})


def gateway_map(gateways: DataFrame, ctx: RunContext) -> DataFrame:
    """Located gateways with status, age label and badge."""
    located = gateways.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return located.select(
        "gateway_eui", "gateway_name", "latitude", "longitude", "connection_status",
        age_label(F.col("last_seen_at"), ctx).alias("last_seen_label"),
        badge(F.col("connection_status")).alias("badge"),
    )
