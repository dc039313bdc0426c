"""One reading plan for roots of different schema versions.

Each root's schema is mapped onto a common one: a column known under several names is
found under the first one a root has, a column a root lacks is NULL, and types meet in
the narrowest type that holds every value of both. Types that have no such type
(text and number, 64-bit integers and doubles, zoned and local timestamps) are a conflict,
which names the column, the types and the roots that have them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


class SchemaConflict(ValueError):
    """Types of one column that no common type holds."""


def meet(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds every value of both exactly, or None."""
    if a == b:
        return a
    for x, y in ((a, b), (b, a)):
        if isinstance(x, T.NullType):
            return y
        if isinstance(x, INTEGERS) and isinstance(y, INTEGERS):
            return max(a, b, key=lambda t: DIGITS[type(t)])
        if isinstance(x, INTEGERS) and isinstance(y, T.DecimalType):
            return _decimal(max(y.precision - y.scale, DIGITS[type(x)]), y.scale)
        if isinstance(x, (T.ByteType, T.ShortType)) and isinstance(y, T.FloatType):
            return y
        if isinstance(x, (T.ByteType, T.ShortType, T.IntegerType, T.FloatType)) and isinstance(y, T.DoubleType):
            return y
        if isinstance(x, T.IntegerType) and isinstance(y, T.FloatType):
            return T.DoubleType()
        if isinstance(x, T.DateType) and isinstance(y, T.TimestampNTZType):
            return y
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        return _decimal(max(a.precision - a.scale, b.precision - b.scale), max(a.scale, b.scale))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        item = meet(a.elementType, b.elementType)
        return item and T.ArrayType(item)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        names = [f.name for f in a] + [f.name for f in b if f.name not in a.names]
        fields = []
        for n in names:
            both = [s[n].dataType for s in (a, b) if n in s.names]
            t = reduce(lambda x, y: x and meet(x, y), both)
            if t is None:
                return None
            fields.append(T.StructField(n, t))
        return T.StructType(fields)
    return None


def _decimal(whole: int, scale: int) -> T.DecimalType | None:
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else None


@dataclass(frozen=True)
class ReadingPlan:
    """The common schema and, per root, the column each of its columns comes from."""
    schema: T.StructType
    sources: dict[str, dict[str, str | None]]

    def project(self, root: str, df: DataFrame) -> DataFrame:
        """Rows of a root in the common schema."""
        return df.select(*[self._column(root, f) for f in self.schema])

    def _column(self, root: str, f: T.StructField) -> Column:
        name = self.sources[root][f.name]
        return (F.lit(None) if name is None else F.col(f"`{name}`")).cast(f.dataType).alias(f.name)

    def describe(self) -> list[tuple[str, str, str, str | None]]:
        """``(column, type, root, its name there)``, for a report."""
        return [(f.name, f.dataType.simpleString(), r, names[f.name]) for f in self.schema for r, names in self.sources.items()]


def reconcile(schemas: Mapping[str, T.StructType], renames: Mapping[str, Sequence[str]] | None = None) -> ReadingPlan:
    """The plan for these roots. ``renames``: column -> the names older versions give it.
    Names match whatever their case; columns come in the order in which roots have them."""
    older = {o.lower(): new for new, names in (renames or {}).items() for o in names}
    columns: dict[str, str] = {}
    found: dict[str, dict[str, T.StructField]] = {r: {} for r in schemas}
    for root, schema in schemas.items():
        by_age = sorted(schema, key=lambda f: f.name.lower() in older)  # a column under its own name goes first
        for f in by_age:
            name = older.get(f.name.lower(), f.name)
            columns.setdefault(name.lower(), name)
            found[root].setdefault(name.lower(), f)
    fields, conflicts = [], []
    for low, name in columns.items():
        types = {r: f[low].dataType for r, f in found.items() if low in f}
        t = reduce(lambda a, b: a and meet(a, b), types.values())
        if t is None:
            conflicts.append(f"{name}: " + ", ".join(f"{x.simpleString()} in {r}" for r, x in types.items()))
        else:
            fields.append(T.StructField(name, T.StringType() if isinstance(t, T.NullType) else t))
    if conflicts:
        raise SchemaConflict("no common type for " + "; ".join(conflicts))
    return ReadingPlan(T.StructType(fields), {r: {f.name: (found[r][f.name.lower()].name if f.name.lower() in found[r] else None)
                                                  for f in fields} for r in schemas})


def read_servers(spark: SparkSession, roots: Mapping[str, str], renames: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """The same export below several roots (name -> path) as one frame."""
    frames = {r: spark.read.parquet(p) for r, p in roots.items()}
    plan = reconcile({r: df.schema for r, df in frames.items()}, renames)
    return reduce(DataFrame.unionByName, [plan.project(r, df) for r, df in frames.items()])
