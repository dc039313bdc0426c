"""Search index over the devices of a run (F9, V6): bits of trigrams.

    archive_index/search/snapshot=<run_id>/postings   field, gram, number, block, bits
    archive_index/search/snapshot=<run_id>/grams      field, gram, n: the dictionary
    archive_index/search/snapshot=<run_id>/files      number, file: the files in their order

The lower-case EUI and device name are cut into all their three-character grams
(a shorter value is a gram itself); an application name, which any number of devices
may share, is one entry as a whole. A file of the run's device export is cut into blocks
of ``BLOCK`` rows, and a posting is a block in which a gram occurs, with a bit for each of
its rows. So neighbours that share a gram are one entry from the task that reads them
onwards, no list is built, and a gram that every device has is many rows, dealt over many
tasks. Both tables are sorted by field and gram, so a lookup opens the row groups and pages
of its grams.

A needle of three characters and more goes by its rarest grams, intersected, and the
rows they leave are read and tested for the needle. A shorter needle is looked up in
the dictionary: every gram that contains it has its devices, no row is read. The
device export lies in the order of the search result, so the first places are the
first results, and only the files that hold them are read for the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.operators.filters import search, search_predicate
from fleetlens.session import PACKED
from fleetlens.sources.tables import path_exists

EXPORT = "devices"
GRAM_FIELDS = ("device_eui", "device_name")
VALUE_FIELD = "application_name"
FIELDS = (*GRAM_FIELDS, VALUE_FIELD)
CODES = sorted(FIELDS)  # a field's place here stands for it until it is written
GRAM = 3
BLOCK = 64  # the bits of a bigint
MAX_GRAMS = 3
#: Small row groups: a lookup reads few bytes of a large index.
OPTIONS = {"parquet.block.size": str(8 << 20), "parquet.page.row.count.limit": "1000", **PACKED}


def index_path(root: str, run_id: str) -> str:
    return f"{root.rstrip('/')}/archive_index/search/snapshot={run_id}"


def has_index(spark: SparkSession, root: str, run_id: str) -> bool:
    return path_exists(spark, f"{index_path(root, run_id)}/grams/_SUCCESS")


def cuts(value: Column) -> Column:
    """Into how many grams a text is cut; one shorter than a gram is a gram."""
    return F.when(value.isNotNull(), F.greatest(F.length(value) - (GRAM - 1), F.lit(1))).otherwise(0)


def entries(rows: DataFrame) -> DataFrame:
    """A row per gram of a lower-case field and place: the field's code, the gram and the other
    columns. A gram that a value holds twice comes twice."""
    ends, end = [], F.lit(0)
    for i, c in enumerate(GRAM_FIELDS):
        rows = rows.withColumn(f"__end{i}", end + cuts(F.col(c)))
        end = F.col(f"__end{i}")
        ends.append(end)
    rows = rows.withColumn("__end", end + F.when(F.col(VALUE_FIELD).isNotNull(), 1).otherwise(0)).filter("__end > 0")
    rows = rows.withColumn("__i", F.explode(F.sequence(F.lit(1), F.col("__end"))))
    gram, code, before = None, None, F.lit(0)
    for c, end in zip(GRAM_FIELDS, ends):
        here, cut = F.col("__i") <= end, F.substring(F.col(c), F.col("__i") - before, F.lit(GRAM))
        gram = F.when(here, cut) if gram is None else gram.when(here, cut)
        code = F.when(here, _code(c)) if code is None else code.when(here, _code(c))
        before = end
    kept = [c for c in rows.columns if c not in FIELDS and not c.startswith("__")]
    return rows.select(code.otherwise(_code(VALUE_FIELD)).alias("code"), gram.otherwise(F.col(VALUE_FIELD)).alias("gram"), *kept)


def _code(field: str) -> Column:
    return F.lit(CODES.index(field)).cast("tinyint")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), place)


def _places(bits: Column) -> Column:
    """The places of a block whose bits are set, in order."""
    return F.filter(F.sequence(F.lit(0), F.lit(BLOCK - 1)), lambda i: bits.bitwiseAND(_bit(i)) != 0)


def write_index(spark: SparkSession, root: str, run_id: str) -> None:
    """Index the written device export of a run."""
    from fleetlens.sinks.snapshot import snapshot_path

    path = index_path(root, run_id)
    df = spark.read.parquet(snapshot_path(root, EXPORT, run_id))
    names = sorted(f.rsplit("/", 1)[1] for f in df.inputFiles())
    files = spark.createDataFrame(list(enumerate(names)), "number int, file string")
    files.coalesce(1).write.mode("overwrite").parquet(f"{path}/files")
    rows = df.select(*[F.lower(c).alias(c) for c in FIELDS], F.col("_metadata.file_name").alias("file"),
                     F.col("_metadata.row_index").alias("at"))
    rows = rows.join(F.broadcast(files), "file").select(*FIELDS, "number", F.floor(F.col("at") / BLOCK).cast("int").alias("block"),
                                                        _bit((F.col("at") % BLOCK).cast("int")).alias("bit"))
    by = ["code", "gram", "number", "block"]
    blocks = entries(rows).groupBy(*by).agg(F.bit_or("bit").alias("bits"))
    field = F.element_at(F.array(*[F.lit(c) for c in CODES]), F.col("code") + 1)
    (blocks.repartitionByRange(*by).sortWithinPartitions(*by).select(field.alias("field"), *by[1:], "bits")
     .write.mode("overwrite").options(**OPTIONS).parquet(f"{path}/postings"))
    sizes = _postings(spark, path).groupBy("field", "gram").agg(F.sum(F.bit_count("bits")).alias("n"))
    sizes.orderBy("field", "gram").write.mode("overwrite").options(**OPTIONS).parquet(f"{path}/grams")


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/postings")


def _rows_of(spark: SparkSession, root: str, run_id: str, numbers: list[int]) -> DataFrame:
    """Rows of these files with their ``number``, ``block`` and ``place``."""
    from fleetlens.sinks.snapshot import snapshot_path

    known = spark.read.parquet(f"{index_path(root, run_id)}/files").filter(F.col("number").isin(numbers)).collect()
    files = spark.createDataFrame(known, "number int, file string")
    base, at = snapshot_path(root, EXPORT, run_id), F.col("_metadata.row_index")
    rows = spark.read.parquet(*[f"{base}/{r['file']}" for r in known])
    rows = rows.select("*", F.col("_metadata.file_name").alias("file"), F.floor(at / BLOCK).cast("int").alias("block"),
                       (at % BLOCK).cast("int").alias("place"))
    return rows.join(F.broadcast(files), "file").drop("file")


def _long_needle(spark: SparkSession, root: str, run_id: str, needle: str) -> DataFrame | None:
    """``number, block, bits`` of devices whose EUI or name holds the needle."""
    path = index_path(root, run_id)
    wanted = sorted({needle[i:i + GRAM] for i in range(len(needle) - GRAM + 1)})
    sizes = spark.read.parquet(f"{path}/grams").filter(F.col("field").isin(*GRAM_FIELDS) & F.col("gram").isin(wanted))
    known: dict[str, dict[str, int]] = {}
    for r in sizes.collect():  # at most two rows per gram of the needle
        known.setdefault(r["field"], {})[r["gram"]] = r["n"]
    found = None
    for field, by_gram in sorted(known.items()):
        if len(by_gram) < len(wanted):
            continue  # a gram that no value of this field has
        rarest = sorted(wanted, key=lambda g: (by_gram[g], g))[:MAX_GRAMS]
        lists = _postings(spark, path).filter((F.col("field") == field) & F.col("gram").isin(rarest))
        both = (lists.groupBy("number", "block").agg(F.count(F.lit(1)).alias("n"), F.bit_and("bits").alias("bits"))
                .filter((F.col("n") == len(rarest)) & (F.col("bits") != 0)).drop("n"))
        found = both if found is None else found.unionByName(both)
    if found is None or len(needle) == GRAM:
        return found  # a needle of one gram needs no test
    found = found.groupBy("number", "block").agg(F.bit_or("bits").alias("bits")).checkpoint()
    numbers = [r[0] for r in found.select("number").distinct().collect()]  # of the export's files
    if not numbers:
        return found
    rows = _rows_of(spark, root, run_id, numbers).filter(search_predicate(needle, GRAM_FIELDS))
    tested = rows.select("number", "block", _bit(F.col("place")).alias("bit"))
    return (tested.join(found, ["number", "block"]).filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)
            .select("number", "block", F.col("bit").alias("bits")))


def matches(spark: SparkSession, root: str, run_id: str, needle: str) -> DataFrame:
    """``number, block, bits`` of every device that matches a lower-case needle of at
    least one character; a block and a device may be named more than once."""
    path = index_path(root, run_id)
    fields = FIELDS if len(needle) < GRAM else (VALUE_FIELD,)
    hits = (spark.read.parquet(f"{path}/grams").filter(F.col("field").isin(*fields) & F.col("gram").contains(needle))
            .select("field", "gram"))
    out = (_postings(spark, path).filter(F.col("field").isin(*fields)).join(hits, ["field", "gram"], "left_semi")
           .select("number", "block", "bits"))
    if len(needle) >= GRAM:
        grams_ = _long_needle(spark, root, run_id, needle)
        out = out if grams_ is None else out.unionByName(grams_)
    return out


def search_run(spark: SparkSession, root: str, run_id: str, q: str | None, cap: int = 100) -> tuple[int, DataFrame]:
    """F9/L4 over the index: (number of matches, the first ``cap`` rows in file order).
    An empty query, which matches every device, and a run without an index are
    answered by a scan."""
    from fleetlens.sinks.snapshot import read_snapshot

    needle = (q or "").lower()
    if not needle or not has_index(spark, root, run_id):
        return search(read_snapshot(spark, root, EXPORT, run_id), q, FIELDS, ["device_name", "device_eui"], cap)
    found = matches(spark, root, run_id, needle)
    # the bits of a block, combined map-side: devices named twice count once
    bits = found.groupBy("number", "block").agg(F.bit_or("bits").alias("bits")).checkpoint()
    total = bits.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0))).first()[0]
    if not total or cap <= 0:
        return total, spark.createDataFrame([], read_snapshot(spark, root, EXPORT, run_id).schema)
    lowest = bits.orderBy("number", "block").limit(cap)  # hold ``cap`` devices, as no block is empty
    first = (lowest.select("number", "block", F.explode(_places(F.col("bits"))).alias("place"))
             .orderBy("number", "block", "place").limit(cap).checkpoint())
    numbers = [r[0] for r in first.select("number").distinct().collect()]  # at most ``cap``
    rows = _rows_of(spark, root, run_id, numbers)
    names = [c for c in rows.columns if c not in first.columns]
    out = rows.join(F.broadcast(first), ["number", "block", "place"], "left_semi")  # ``first`` has at most ``cap`` rows
    return total, out.orderBy("number", "block", "place").select(*names)
