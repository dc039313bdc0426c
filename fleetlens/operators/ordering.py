"""Sorts, paging and limits."""

from __future__ import annotations

import math
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _keys(keys: Sequence[str | tuple[str, str]]) -> list[Column]:
    out = []
    for k in keys:
        name, direction = (k, "asc") if isinstance(k, str) else k
        out.append(F.col(name).desc_nulls_first() if direction == "desc" else F.col(name).asc_nulls_last())
    return out


def sort_export(df: DataFrame, keys: Sequence[str | tuple[str, str]]) -> DataFrame:
    """L1/L2: ascending NULLs last, descending NULLs first."""
    return df.orderBy(*_keys(keys))


@dataclass(frozen=True)
class PageInfo:
    total: int
    page: int
    limit: int
    total_pages: int
    next_page: int | None
    previous_page: int | None


DEFAULT_PAGE = 1
DEFAULT_LIMIT = 100


_LEADING_INT = re.compile(r"\s*([+-]?\d+)")


def _parse_positive(value, default: int) -> int:
    """``parseInt(x) || default``: the leading integer of the text counts
    (``"2abc"`` is 2, ``"3.7"`` is 3); missing, unparsable and 0 give the
    default; a negative value is refused."""
    if value is None:
        return default
    m = _LEADING_INT.match(str(value))
    if not m:
        return default
    n = int(m.group(1))
    if n == 0:
        return default
    if n < 0:
        raise ValueError(f"page and limit must be positive, got {value!r}")
    return n


def page_rows(df: DataFrame, keys: Sequence[str | tuple[str, str]], page=1, limit=100) -> DataFrame:
    """L3 rows: the ``page``-th slice of ``limit`` rows in key order. Spark
    plans sort + offset + limit as one top-k (TakeOrderedAndProject), so no
    global sort runs. The last key should be unique for a stable order."""
    p = _parse_positive(page, DEFAULT_PAGE)
    n = _parse_positive(limit, DEFAULT_LIMIT)
    ordered = df.orderBy(*_keys(keys))
    return ordered.offset((p - 1) * n).limit(n) if p > 1 else ordered.limit(n)


def rows_after(keys: Sequence[str | tuple[str, str]], after: Mapping) -> Column:
    """Rows that sort behind ``after`` (key column -> value): some key is
    behind and all keys before it are equal. Ascending keys have NULLs last,
    descending ones NULLs first, as in :func:`sort_export`."""
    out, equal = F.lit(False), F.lit(True)
    for k in keys:
        name, direction = (k, "asc") if isinstance(k, str) else k
        c, v = F.col(name), after[name]
        if direction == "desc":
            behind = c.isNotNull() if v is None else F.coalesce(c < F.lit(v), F.lit(False))
        else:
            behind = F.lit(False) if v is None else c.isNull() | (c > F.lit(v))
        out = out | (equal & behind)
        equal = equal & c.eqNullSafe(F.lit(v))
    return out


def page_after(df: DataFrame, keys: Sequence[str | tuple[str, str]], after: Mapping | None = None,
               limit: int = 100) -> DataFrame:
    """Keyset variant of L3 for deep pages: the ``limit`` rows behind the last
    row seen (``after``: its key columns). The keys must end with a unique
    one; ties and NULL keys are then read exactly once. The top-k stays
    ``limit`` rows however deep the page is."""
    out = df if after is None else df.filter(rows_after(keys, after))
    return out.orderBy(*_keys(keys)).limit(limit)


def page_numbers(df: DataFrame, keys: Sequence[str | tuple[str, str]], limit: int = 100) -> DataFrame:
    """Every row with the number ``page`` of its page. The rows are dealt by
    key range and sorted once, written with their place within the partition,
    and the counts of the partitions before give the place in the whole. The
    keys must end with a unique one."""
    by = _keys(keys)
    at = F.monotonically_increasing_id()  # partition in the high bits, place in the low 33
    placed = (df.repartitionByRange(*by).sortWithinPartitions(*by)
              .withColumn("__part", F.shiftright(at, 33))
              .withColumn("__place", at.bitwiseAND(F.lit((1 << 33) - 1))).checkpoint())
    counts = placed.groupBy("__part").agg(F.count("*").alias("__rows"))
    # one row per partition from here on, so a window over all of them is small
    before = F.sum("__rows").over(Window.orderBy("__part")) - F.col("__rows")
    first = counts.select("__part", before.alias("__before"))
    return (placed.join(first, "__part")
            .withColumn("page", (F.floor((F.col("__before") + F.col("__place")) / limit) + 1).cast("int"))
            .drop("__part", "__place", "__before"))


def page_info(total: int, page=1, limit=100) -> PageInfo:
    """L3 metadata, as the read API reports it."""
    p = _parse_positive(page, DEFAULT_PAGE)
    n = _parse_positive(limit, DEFAULT_LIMIT)
    start, end = (p - 1) * n, p * n
    return PageInfo(total, p, n, math.ceil(total / n), p + 1 if end < total else None,
                    p - 1 if start > 0 else None)


def page(df: DataFrame, keys, page=1, limit=100) -> tuple[PageInfo, DataFrame]:
    """L3: metadata (one count) and the rows of the page."""
    return page_info(df.count(), page, limit), page_rows(df, keys, page, limit)


def top_tenants(device_summary: DataFrame, n: int | None = None) -> DataFrame:
    """Tenants ranked by device count, descending, name as tie-break."""
    ranked = device_summary.select(
        "tenant_name", "tenant_id", F.col("total_devices").cast("string").try_cast("bigint").alias("total_devices"))
    ranked = ranked.orderBy(F.col("total_devices").desc_nulls_last(), F.col("tenant_name").asc_nulls_last(),
                            F.col("tenant_id").asc_nulls_last())
    return ranked.limit(n) if n else ranked


def preview(df: DataFrame, keys: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` rows in key order (a top-k)."""
    return df.orderBy(*_keys(keys)).limit(n)
