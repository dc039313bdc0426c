"""Scalar column expressions.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlens.context import RunContext

__all__ = [
    "DEVICE_ACTIVITY", "GATEWAY_CONNECTION", "DEPLOYMENT_STATES", "recency_status", "device_activity",
    "gateway_connection", "deployment_status", "hex_lower", "codec_filename",
    "safe_filename", "non_blank", "age_label", "badge", "parse_long",
    "page_count", "text", "seen_within", "sync_status_columns",
]

# The status ladders of the exports (seconds, label), the label
# for a NULL time and the label when no step matches.
DEVICE_ACTIVITY = ([(24 * 3600, "Active"), (7 * 24 * 3600, "Recent")], "Never", "Inactive")
GATEWAY_CONNECTION = ([(5 * 60, "Online"), (3600, "Recent")], "Never Seen", "Offline")


def text(c) -> Column:
    """Cast to text."""
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def seen_within(ts: Column, ctx: RunContext, seconds: int) -> Column:
    """``ts > as_of - seconds`` (strict, NULL stays unknown)."""
    return ts > ctx.ago(seconds)


def recency_status(ts: Column, ctx: RunContext, steps: Sequence[tuple[int, str]],
                   null_label: str, else_label: str) -> Column:
    """First step whose window contains ``ts`` (strict ``>``), then the
    NULL label, then the fallback. A NULL comparison falls through, so the
    NULL arm is reached exactly when no step matched."""
    expr = None
    for seconds, label in steps:
        cond = seen_within(ts, ctx, seconds)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    expr = expr.when(ts.isNull(), null_label) if expr is not None else F.when(ts.isNull(), null_label)
    return expr.otherwise(else_label)


def device_activity(ts: Column, ctx: RunContext) -> Column:
    steps, never, other = DEVICE_ACTIVITY
    return recency_status(ts, ctx, steps, never, other)


def gateway_connection(ts: Column, ctx: RunContext) -> Column:
    steps, never, other = GATEWAY_CONNECTION
    return recency_status(ts, ctx, steps, never, other)


# Deployment states (completed, started, neither).
DEPLOYMENT_STATES = ("Completed", "In Progress", "Pending")


def deployment_status(started: Column, completed: Column) -> Column:
    """Completed wins over started."""
    done, running, waiting = DEPLOYMENT_STATES
    return (F.when(completed.isNotNull(), done)
             .when(started.isNotNull(), running)
             .otherwise(waiting))


def hex_lower(c: Column) -> Column:
    """C4: lower-case hex of a binary value (Spark's ``hex`` is upper-case)."""
    return F.lower(F.hex(c))


def codec_filename(name: Column, profile_id: Column) -> Column:
    """C7, metadata form: spaces and slashes become ``_``; NULL-propagating."""
    cleaned = F.replace(F.replace(name, F.lit(" "), F.lit("_")), F.lit("/"), F.lit("_"))
    return F.concat(cleaned, F.lit("_"), text(profile_id), F.lit(".js"))


def safe_filename(name: Column, profile_id: Column) -> Column:
    """C8, disk form: spaces become ``_``, keep ASCII letters, digits, ``_``
    and ``-``, then the first 50 characters, then ``_<id>.js``."""
    kept = F.regexp_replace(F.translate(F.coalesce(name, F.lit("")), " ", "_"), "[^A-Za-z0-9_-]", "")
    return F.concat(F.substring(kept, 1, 50), F.lit("_"), text(profile_id), F.lit(".js"))


def non_blank(c: Column) -> Column:
    """not NULL, not empty and not only spaces. ``trim`` removes spaces
    only, so text of tabs or newlines stays non-blank."""
    return c.isNotNull() & (c != "") & (F.length(F.trim(c)) > 0)


def age_label(ts: Column, ctx: RunContext) -> Column:
    """C14: relative age such as ``2 min ago``, ``1h ago``, ``2d ago``;
    NULL -> ``Never``; a time after ``as_of`` -> ``just now``."""
    secs = F.timestamp_diff("SECOND", ts, ctx.now())  # whole seconds elapsed
    return (F.when(ts.isNull(), "Never")
             .when(secs < 60, "just now")
             .when(secs < 3600, F.concat(F.floor(secs / 60).cast("string"), F.lit(" min ago")))
             .when(secs < 86400, F.concat(F.floor(secs / 3600).cast("string"), F.lit("h ago")))
             .otherwise(F.concat(F.floor(secs / 86400).cast("string"), F.lit("d ago"))))


# Status -> colour group of the portal's badges.
BADGE_COLOURS = {
    "Online": "green", "Active": "green",
    "Recent": "amber",
    "Offline": "red", "Inactive": "red",
    "Never": "gray", "Never Seen": "gray",
}


def badge(status: Column) -> Column:
    """Colour group of a status; unknown statuses are gray."""
    expr = None
    for label, colour in BADGE_COLOURS.items():
        expr = F.when(status == label, colour) if expr is None else expr.when(status == label, colour)
    return expr.otherwise("gray")


def parse_long(c: Column) -> Column:
    """Numeric parse of a string field; malformed -> NULL."""
    return F.trim(c).try_cast("bigint")


def page_count(total: Column, limit: int) -> Column:
    """C17: ``ceil(total / limit)``."""
    return F.ceil(total / F.lit(limit)).cast("bigint")


def sync_status_columns(export_ts: Column, ctx: RunContext, every_minutes: int = 15) -> dict[str, Column]:
    """Age of the last export in minutes, next due time and a healthy
    flag (the last export is not older than two periods)."""
    age = F.timestamp_diff("SECOND", export_ts, ctx.now()) / 60.0
    return {
        "minutes_since_export": F.floor(age).cast("bigint"),
        "next_export_due": F.timestamp_add("MINUTE", F.lit(every_minutes), export_ts),
        "healthy": F.coalesce(age <= 2 * every_minutes, F.lit(False)),
    }
