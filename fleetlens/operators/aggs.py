"""Aggregations.

Aggregates are written so Spark can combine them map-side (count, sum, min,
max); a hot group key then costs one partial row per task, not a hot task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.context import RunContext


def count_when(pred: Column) -> Column:
    """A2: rows where ``pred`` is true; NULL and false add 0."""
    return F.count(F.when(pred, F.lit(1)))


def safe_avg(total: Column, n: Column) -> Column:
    """sum / count, NULL for an empty group (no division error under ANSI)."""
    return F.when(n > 0, total / n)


def round2(x: Column) -> Column:
    """ROUND(x, 2) on a decimal, half away from zero, returned as double."""
    return F.round(x.cast("decimal(38,16)"), 2).cast("double")


def avg_round(total: Column, n: Column) -> Column:
    """A3: ROUND(AVG(x), 2) from a sum and a count of non-NULL values (the
    two partial aggregates Spark combines map-side); NULL for no values. The
    quotient is never rounded to an intermediate scale: hundredths are counted
    by an integer division of 200 * |sum| + n by 2 * n, which is half away
    from zero."""
    exact = total.cast("decimal(28,8)")
    cents = F.call_function("div", F.abs(exact) * 200 + n, n * 2)
    return F.when(n > 0, F.signum(exact) * cents / 100)


def string_agg(col: str, sep: str = ", ") -> Column:
    """Ordered string aggregate; zero non-NULL values give NULL."""
    return F.expr(f"listagg(`{col}`, '{sep}') WITHIN GROUP (ORDER BY `{col}`)")


def bucket_counts(ts: Column, ctx: RunContext, online_secs: int = 300,
                  recent_secs: int = 3600) -> dict[str, Column]:
    """A5: online / recent / offline counts. As in the reference, a time
    exactly ``recent_secs`` old counts as both recent and offline, and
    never-seen rows count as offline."""
    return {
        "online": count_when(ts > ctx.ago(online_secs)),
        "recent": count_when(ts.between(ctx.ago(recent_secs), ctx.ago(online_secs))),
        "offline": count_when((ts <= ctx.ago(recent_secs)) | ts.isNull()),
    }


def breakdown(df: DataFrame, col: str, default: str = "Unknown", name: str = "status") -> DataFrame:
    """Value histogram with a label for missing values."""
    return (df.groupBy(F.coalesce(F.col(col), F.lit(default)).alias(name))
              .agg(F.count(F.lit(1)).alias("count")))


def child_counts(parent: DataFrame, pk: str, child: DataFrame, fk: str,
                 out: str = "child_count", keep: Sequence[str] = ()) -> DataFrame:
    """Children per parent including 0. The child side is reduced to one
    row per key before it meets the parent."""
    per_key = child.groupBy(F.col(fk).alias("__ck")).agg(F.count(F.lit(1)).alias(out))
    cols = [pk, *keep] if keep else parent.columns
    p = parent.select(*cols)
    return (p.join(per_key, p[pk] == per_key["__ck"], "left").drop("__ck")
             .withColumn(out, F.coalesce(F.col(out), F.lit(0).cast("bigint"))))


def sum_columns(df: DataFrame, cols: Mapping[str, str]) -> DataFrame:
    """One-row sums of (string or numeric) summary columns."""
    return df.agg(*[F.sum(F.col(c).cast("string").try_cast("bigint")).alias(o) for o, c in cols.items()])


def by_server(df: DataFrame, server_col: str = "source_server") -> DataFrame:
    """Rows per source server."""
    return df.groupBy(server_col).agg(F.count(F.lit(1)).alias("row_count"))
