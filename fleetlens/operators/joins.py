"""Joins.

Every lookup is a plain equi-join; Spark picks the physical strategy. With
AQE on, a dimension whose measured size is under
``spark.sql.adaptive.autoBroadcastJoinThreshold`` is broadcast at run time,
otherwise both sides are shuffled and a hot foreign key on the preserved
(left) side is split by the skew-join rule. No dimension is broadcast by hint
here, because none has a size bound that holds for every fleet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KEY = "__lookup_key"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lookup(fact: DataFrame, dim: DataFrame, fk: str | Column, pk: str,
           columns: Mapping[str, str | Column], how: str = "left") -> DataFrame:
    """N:1 lookup. ``columns`` maps output name -> dimension column.
    With a unique ``pk`` the row count of ``fact`` is unchanged."""
    d = dim.select(F.col(pk).alias(_KEY), *[_as_col(c).alias(out) for out, c in columns.items()])
    cond = (fact[fk] if isinstance(fk, str) else fk) == d[_KEY]
    return fact.join(d, cond, how).drop(_KEY)


def lookup_chain(fact: DataFrame, hops: Sequence[tuple]) -> DataFrame:
    """Several lookups in a row; each hop is ``(dim, fk, pk, columns)``.
    A later hop may use a column brought in by an earlier one, so an orphan
    at the first hop leaves every later column NULL."""
    out = fact
    for dim, fk, pk, columns in hops:
        out = lookup(out, dim, fk, pk, columns)
    return out


def application_dim(application: DataFrame, tenant: DataFrame,
                    app_cols: Mapping[str, str | Column] | None = None,
                    tenant_cols: Mapping[str, str | Column] | None = None) -> DataFrame:
    """Application joined to its tenant once, so a fact table needs a single
    join (one shuffle at most) to reach both."""
    app_cols = dict(app_cols or {"application_name": "name"})
    tenant_cols = dict(tenant_cols or {"tenant_name": "name"})
    a = application.select(F.col("id").alias("app_id"), F.col("tenant_id").alias("app_tenant_id"),
                           *[_as_col(c).alias(o) for o, c in app_cols.items()])
    return lookup(a, tenant, "app_tenant_id", "id", tenant_cols)


def bridge(link: DataFrame, left_dim: DataFrame, left_fk: str, left_pk: str,
           left_cols: Mapping[str, str | Column], right_dim: DataFrame, right_fk: str,
           right_pk: str, right_cols: Mapping[str, str | Column]) -> DataFrame:
    """M:N bridge with both ends looked up (two left joins)."""
    return lookup(lookup(link, left_dim, left_fk, left_pk, left_cols),
                  right_dim, right_fk, right_pk, right_cols)


def role_join(fact: DataFrame, dim: DataFrame, roles: Sequence[tuple[str, str, Mapping]]) -> DataFrame:
    """The same dimension joined once per role, ``(fk, pk, columns)``."""
    out = fact
    for fk, pk, columns in roles:
        out = lookup(out, dim, fk, pk, columns)
    return out


def with_counts(parent: DataFrame, pk: str, counts: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Left join pre-aggregated count frames ``(agg, key)`` and turn the
    missing counts into 0. Each child type is aggregated on its own, so two
    child types never multiply each other."""
    out = parent
    value_cols: list[str] = []
    for agg, key in counts:
        cols = [c for c in agg.columns if c != key]
        value_cols += cols
        out = lookup(out, agg, pk, key, {c: c for c in cols})
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("bigint")) for c in value_cols})


def semi(df: DataFrame, other: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows of ``df`` with at least one match (EXISTS)."""
    o = other.select(F.col(pk).alias(_KEY))
    return df.join(o, df[fk] == o[_KEY], "left_semi")


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    p = parent.select(F.col(pk).alias(_KEY))
    return child.filter(F.col(fk).isNotNull()).join(p, F.col(fk) == p[_KEY], "left_anti")
