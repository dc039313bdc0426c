"""Exact deduplication over a sharded cuckoo-filter index.

Each document is reduced to the SHA-256 of its normalised text (A-Z lowered,
UTF-8). Every input partition first collapses its own copies, so a group of
copies reaches the index with at most one row per task, however large it is.
The partial rows are dealt by digest to index shards. A shard is a cuckoo
filter of 16-bit fingerprints over a content store: a lookup asks the filter's
two candidate buckets, and only a hit is verified against the digests kept for
the bucket, so a false positive never merges two texts. A full filter doubles
and is refilled from the stored keys.

Defined results: a null text counts as empty, and all empty texts are one
group; a null ``doc_id`` is smaller than every number; of repeated rows with
the same id and text exactly one is kept; an empty table gives no rows; other
columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.common import load, numbered, shuffle_partitions, staged

SLOTS = 4
MAX_KICKS = 200


class CuckooIndex:
    """Cuckoo filter over live digests, with the keys stored per bucket.

    ``content[b]`` holds ``digest -> value`` of every live key whose first
    bucket is ``b``; the fingerprint itself may sit in either of its buckets.
    """

    def __init__(self, buckets: int = 1024):
        self.buckets = 1 << max(1, (buckets - 1).bit_length())
        self._clear()

    def _clear(self) -> None:
        self.mask = self.buckets - 1
        self.table = array("H", bytes(2 * SLOTS * self.buckets))
        self.content: dict[int, dict[bytes, object]] = {}
        self.size = 0

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        fp = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & self.mask
        return fp, first, self._other(first, fp)

    def _other(self, bucket: int, fp: int) -> int:
        return bucket ^ ((fp * 0x5BD1E995) & self.mask)

    def _holds(self, bucket: int, fp: int) -> bool:
        at = bucket * SLOTS
        return fp in self.table[at:at + SLOTS]

    def _put(self, bucket: int, fp: int) -> bool:
        at = bucket * SLOTS
        for i in range(at, at + SLOTS):
            if not self.table[i]:
                self.table[i] = fp
                return True
        return False

    def _kick(self, bucket: int, fp: int) -> bool:
        for n in range(MAX_KICKS):
            at = bucket * SLOTS + n % SLOTS
            fp, self.table[at] = self.table[at], fp
            bucket = self._other(bucket, fp)
            if self._put(bucket, fp):
                return True
        return False

    def get(self, digest: bytes):
        """The value of a live digest, or None; only filter hits are verified."""
        fp, first, second = self._place(digest)
        if self._holds(first, fp) or self._holds(second, fp):
            return self.content.get(first, {}).get(digest)
        return None

    def insert(self, digest: bytes, value) -> None:
        """Add a digest that is not live yet."""
        fp, first, second = self._place(digest)
        self.content.setdefault(first, {})[digest] = value
        self.size += 1
        if not (self._put(first, fp) or self._put(second, fp) or self._kick(second, fp)):
            self._resize()

    def replace(self, digest: bytes, value) -> None:
        """New value of a live digest; its fingerprint stays where it is."""
        _, first, _ = self._place(digest)
        self.content[first][digest] = value

    def delete(self, digest: bytes) -> bool:
        """Remove a live digest and one copy of its fingerprint."""
        if self.get(digest) is None:
            return False
        fp, first, second = self._place(digest)
        bucket = self.content[first]
        del bucket[digest]
        if not bucket:
            del self.content[first]
        for at in (first * SLOTS, second * SLOTS):
            for i in range(at, at + SLOTS):
                if self.table[i] == fp:
                    self.table[i] = 0
                    self.size -= 1
                    return True
        raise AssertionError("a live digest lost its fingerprint")

    def _resize(self) -> None:
        """Double the filter and refill it from the stored keys."""
        live = list(self.items())
        self.buckets *= 2
        self._clear()
        for digest, value in live:
            self.insert(digest, value)

    def items(self) -> Iterator[tuple[bytes, object]]:
        for bucket in self.content.values():
            yield from bucket.items()


_DIGESTS = "doc_id long, row long, digest binary"
_GROUPS = "digest binary, keep_id long, keep_row long, group_size long"


def _digest_batches(batches):
    for b in batches:
        digests = [hashlib.sha256((t or b"").lower()).digest()  # bytes.lower() is A-Z only
                   for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), b.column("row"), pa.array(digests, pa.binary())],
            ["doc_id", "row", "digest"])


def text_digests(docs: DataFrame, row: str | None = None) -> DataFrame:
    """``doc_id, row, digest`` of every row, written once. ``row`` tells repeated
    rows apart: the column of that name, or else the row's position in this scan,
    which names it in the result only and not in another scan of ``docs``."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         (F.col(row) if row else F.monotonically_increasing_id()).alias("row"),
                         F.col("text").cast("binary").alias("text"))
    return staged(narrow.mapInArrow(_digest_batches, _DIGESTS), "digests")


def _merge_batches(batches):
    """Fold rows ``(digest, keep_id, keep_row, group_size)`` into one per digest."""
    index = CuckooIndex()
    for b in batches:
        for digest, keep, row, n in zip(*(b.column(c).to_pylist() for c in
                                          ("digest", "keep_id", "keep_row", "group_size"))):
            live = index.get(digest)
            if live is None:
                index.insert(digest, (keep, row, n))
            else:
                kept = max(live[:2], (keep, row), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
                index.replace(digest, (*kept, live[2] + n))
    out = [(d, *v) for d, v in index.items()]
    for at in range(0, len(out), 20_000):
        cols = list(zip(*out[at:at + 20_000]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.binary()), *(pa.array(c, pa.int64()) for c in cols[1:])],
            ["digest", "keep_id", "keep_row", "group_size"])


def group_index(digests: DataFrame, shards: int | None = None) -> DataFrame:
    """One row per distinct digest: the copy that stays and the group's size.

    Copies are folded inside each input partition before they are dealt, so a
    shard reads at most one row per digest and task.
    """
    n = shards or shuffle_partitions(digests.sparkSession)
    single = digests.select("digest", F.col("doc_id").alias("keep_id"),
                            F.col("row").alias("keep_row"), F.lit(1).cast("long").alias("group_size"))
    partial = single.mapInArrow(_merge_batches, _GROUPS)
    return partial.repartition(n, "digest").mapInArrow(_merge_batches, _GROUPS)


def exact_groups(docs: DataFrame, row: str | None = None) -> DataFrame:
    """One row per input row: its group's keeper and size, and whether it stays."""
    digests = text_digests(docs, row)
    groups = group_index(digests)
    # the docs side of a hot digest is split by AQE's skew join; the other side has one row per key
    return digests.join(groups, "digest").select(
        "doc_id", "keep_id", "group_size",
        (F.col("row") == F.col("keep_row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"), "row")


def drop_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. Other rows go,
    each because an equal text with a larger ``doc_id`` (or a later repeat of
    the row) stays. The decision and the rows come from one numbered copy."""
    rows = numbered(docs)
    keep = exact_groups(rows, "__row").filter("kept").select(F.col("row").alias("__row"))
    return rows.join(keep, "__row", "left_semi").drop("__row")


def _apply_changes(batches):
    index = CuckooIndex()
    for b in batches:
        for digest, delta in zip(b.column("digest").to_pylist(), b.column("n").to_pylist()):
            n = (index.get(digest) or 0) + delta
            if index.get(digest) is None:
                if n:
                    index.insert(digest, n)
            elif n:
                index.replace(digest, n)
            else:
                index.delete(digest)
    out = [(d, n) for d, n in index.items() if n > 0]
    yield pa.RecordBatch.from_arrays([pa.array([d for d, _ in out], pa.binary()),
                                      pa.array([n for _, n in out], pa.int64())], ["digest", "n"])


def update_index(live: DataFrame, changes: DataFrame, shards: int | None = None) -> DataFrame:
    """Live digests after inserts and deletes.

    ``live`` and ``changes`` have ``digest`` and ``n`` (rows added, negative:
    removed). Changes are summed per digest before they meet the index, so a
    digest that is changed a billion times costs one row per task. A digest
    whose count falls to zero or below is deleted from the filter.
    """
    n = shards or shuffle_partitions(live.sparkSession)
    net = changes.groupBy("digest").agg(F.sum("n").cast("long").alias("n"))
    both = live.select("digest", F.col("n").cast("long").alias("n")).unionByName(net)
    return both.repartition(n, "digest").mapInArrow(_apply_changes, "digest binary, n long")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(load(spark, sf_dir, "documents")).drop("row")


#: ASCII letters only, as the operator does; DuckDB's lower() would fold more.
ORACLE = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''),
             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
           FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""
