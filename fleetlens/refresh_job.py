"""The scheduled refresh as a command (the 15-minute cron job of the
reference, re-expressed as one Spark application).

    spark-submit fleetlens/refresh_job.py --source /data/fleet --root /shared/exports \\
        --server-name lns-eu --keep 10

``--source`` is a folder of parquet tables named after the source tables
(tenant, application, device, ...). With ``--driver-tables`` the folder
holds the driver's TPC-H-like tables and the fixture mapping is applied.
``--jdbc-url`` reads the tables from the network server's database instead;
they are then staged once per run (one consistent view, one read each).
Binary keys and UUIDs are expected as the database returns them.
Tables the source does not have are left out (the export concerned is
empty, with its columns and types). The server registry comes from
``--server-name``; it is no table. Each server publishes under a folder of its
own below ``--root``, which must be shared storage; without it the session's
``spark.checkpoint.dir`` is used. Large tables are read over JDBC in
``--jdbc-partitions`` ranges of their creation time.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.sql import SparkSession

from fleetlens.context import RunContext
from fleetlens.session import apply_session_defaults, ensure_checkpoint_dir
from fleetlens.sinks.snapshot import RUN_SOURCES, refresh
from fleetlens.sources.fixtures import fleet_tables
from fleetlens.sources.tables import jdbc_options, jdbc_tables, load_jdbc_tables, load_tables


def server_root(base: str, server_name: str) -> str:
    """Folder of one server: two servers on the same minute never share a run."""
    return f"{base.rstrip('/')}/server={quote(server_name, safe='')}"


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--source")
    ap.add_argument("--root")
    ap.add_argument("--driver-tables", action="store_true")
    ap.add_argument("--server-name", default="lns-demo")
    ap.add_argument("--server-url", default="https://lns.example.org")
    ap.add_argument("--as-of", help="reference time YYYY-mm-ddTHH:MM:SS (default: now, UTC)")
    ap.add_argument("--keep", type=int, default=10)
    ap.add_argument("--parallelism", type=int, default=4)
    ap.add_argument("--stage", action="store_true",
                    help="copy the source tables once per run first (for JDBC sources)")
    ap.add_argument("--unsorted", action="store_true",
                    help="skip the file-order sort of each export (readers sort with a top-k)")
    ap.add_argument("--jdbc-url", help="read the source tables over JDBC instead of --source files")
    ap.add_argument("--buckets", type=int, default=0,
                    help="with staging: bucket the device-keyed tables on the EUI (co-located joins)")
    ap.add_argument("--jdbc-schema", default="public")
    ap.add_argument("--jdbc-partitions", type=int, default=16)
    ap.add_argument("--jdbc-since", default="2016-01-01 00:00:00", help="start of the first range")
    ap.add_argument("--formats", default="parquet,csv,json")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("fleetlens-refresh").getOrCreate()
    apply_session_defaults(spark, cluster=True)
    base = args.root or f"{ensure_checkpoint_dir(spark).rstrip('/')}/fleetlens-exports"
    root = server_root(base, args.server_name)
    as_of = (datetime.fromisoformat(args.as_of) if args.as_of
             else datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0))
    if args.jdbc_url:
        options = jdbc_options(RUN_SOURCES, args.jdbc_partitions, args.jdbc_since, as_of.strftime("%Y-%m-%d %H:%M:%S"))
        tables = load_jdbc_tables(spark, args.jdbc_url, options,
                                  present=jdbc_tables(spark, args.jdbc_url, args.jdbc_schema))
    elif args.driver_tables:
        tables = fleet_tables(load_tables(spark, args.source))
    else:
        tables = load_tables(spark, args.source, names=RUN_SOURCES)
    ctx = RunContext(as_of=as_of, server_name=args.server_name, server_url=args.server_url,
                     timestamp_type=dict(tables["device"].dtypes)["last_seen_at"])
    res = refresh(spark, tables, ctx, root, keep=args.keep, parallelism=args.parallelism,
                  formats=tuple(args.formats.split(",")),
                  stage=args.stage or bool(args.jdbc_url), sort_on_write=not args.unsorted,
                  buckets=args.buckets)
    res.status.show(100, truncate=False)
    return 0 if res.published else 1


if __name__ == "__main__":
    raise SystemExit(main())
