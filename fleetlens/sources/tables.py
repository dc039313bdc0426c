"""Table scans.

The driver ships one parquet file per table; a production deployment reads
the network server's database over JDBC instead. Both produce plain lazy
DataFrames, so column pruning and filter pushdown reach the scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


class LazyTables(Mapping):
    """Name -> DataFrame, each built on first use and then reused, so one run
    plans every table once and unused tables are never touched."""

    def __init__(self, builders: Mapping[str, callable]):
        self._builders = dict(builders)
        self._cache: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            if name not in self._builders:
                raise KeyError(name)
            self._cache[name] = self._builders[name]()
        return self._cache[name]

    def __contains__(self, name) -> bool:
        return name in self._builders

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Does the storage have this path (any Hadoop file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_tables(spark: SparkSession, root: str,
                names: Iterable[str] = DRIVER_TABLES) -> LazyTables:
    """Parquet tables ``<root>/<name>.parquet`` as lazy DataFrames. Storage is
    asked once for each; a table it does not have is not in the mapping."""
    root = root.rstrip("/")
    names = [n for n in names if path_exists(spark, f"{root}/{n}.parquet")]

    def reader(n):
        return lambda: spark.read.parquet(f"{root}/{n}.parquet")

    return LazyTables({n: reader(n) for n in names})


def load_jdbc_tables(spark: SparkSession, url: str, tables: Mapping[str, dict],
                     properties: dict | None = None, present: Iterable[str] | None = None) -> LazyTables:
    """JDBC tables, each with optional ``partitionColumn/lowerBound/
    upperBound/numPartitions`` so a large table is read by many tasks.
    ``present`` are the tables the database has (see :func:`jdbc_tables`);
    others are not in the mapping."""
    props = dict(properties or {})
    if present is not None:
        known = set(present)
        tables = {n: o for n, o in tables.items() if n in known}

    def reader(name, opts):
        def build():
            r = spark.read.format("jdbc").option("url", url).option("dbtable", opts.get("dbtable", name))
            for k, v in {**props, **opts}.items():
                if k != "dbtable":
                    r = r.option(k, v)
            return r.load()
        return build

    return LazyTables({n: reader(n, o) for n, o in tables.items()})


#: Column by which a large table is read in parallel: a timestamp that every
#: row has and that spreads evenly over the life of the fleet.
JDBC_SPLIT = {"device": "created_at", "device_keys": "created_at", "gateway": "created_at", "application": "created_at",
              "device_profile": "created_at", "device_queue_item": "created_at", "multicast_group_device": "created_at",
              "relay_device": "created_at", "fuota_deployment": "created_at"}


def jdbc_tables(spark: SparkSession, url: str, schema: str = "public", properties: dict | None = None) -> list[str]:
    """Names of the tables of a database schema, from its catalog."""
    query = f"(SELECT table_name FROM information_schema.tables WHERE table_schema = '{schema}') AS t"
    r = spark.read.format("jdbc").option("url", url).option("dbtable", query)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return [row[0] for row in r.load().collect()]


def jdbc_options(names: Iterable[str], partitions: int, since: str, until: str) -> dict[str, dict]:
    """Read options per table: large tables in ``partitions`` ranges of their
    split column between two timestamps (rows outside fall into the first and
    last range, none is left out), small ones with one connection."""
    out = {}
    for n in names:
        out[n] = {"dbtable": f'"{n}"'}
        if partitions > 1 and n in JDBC_SPLIT:
            out[n] |= {"partitionColumn": JDBC_SPLIT[n], "lowerBound": since, "upperBound": until,
                       "numPartitions": str(partitions)}
    return out
