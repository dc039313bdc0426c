"""Token ids in directly addressable codes.

An id is cut into 8-bit chunks, lowest first. Level 0 of a file holds the first
chunk of every id, level 1 the second chunk of those ids that need one, and so
on; ids below 256 take one byte. A continuation bitmap per level says which
ids go on, and a rank directory (ones before every 512th bit) turns a position
of one level into its position in the next, so token ``i`` is read from one
byte per level without decoding any block, and a run of tokens from one slice
per level.

File layout, little-endian: magic ``FLDAC1`` padded to 8 bytes; int64 levels,
documents, tokens; int64 chunks of each level; int64 doc ids; uint8 null flags
of the doc ids; int64 first token of each document and the total; then of each
level its chunks, its bitmap (8 bits a byte, lowest first, padded to 64 bytes)
and its uint32 rank directory; the last level has no bitmap.

Writing: documents are range-partitioned and sorted by ``doc_id`` (null first,
equal ids by a hash of the text), each task encodes its run and writes files of
at most ``SHARD_TOKENS`` tokens (or one document) under names of its own
attempt, in the shared folder. A manifest written by Spark names the files of
the attempts that counted, so a lost executor leaves an unused file at most.

Defined results: a null text is empty and has the end id alone; repeated rows
are separate documents; an empty table gives no files and no rows; other
columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import load, shuffle_partitions, staged
from fleetlens.llm.tokens import encoder
from fleetlens.session import scratch_path

MAGIC = b"FLDAC1\0\0"
BLOCK = 512
SHARD_TOKENS = 4_000_000
END_ID = 0


def _pad(n: int) -> int:
    return -(-n // BLOCK) * BLOCK // 8


def encode_dac(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One file's bytes."""
    levels, rest = [], np.asarray(ids, dtype=np.uint32)
    while True:
        chunk, more = (rest & 0xFF).astype(np.uint8), rest >= 256
        levels.append((chunk, more))
        rest = rest[more] >> 8
        if not len(rest):
            break
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype("<i8")
    out = [MAGIC, np.array([len(levels), len(doc_ids), len(ids)], "<i8").tobytes(),
           np.array([len(c) for c, _ in levels], "<i8").tobytes(),
           np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
           np.array([d is None for d in doc_ids], np.uint8).tobytes(), starts.tobytes()]
    for i, (chunk, more) in enumerate(levels):
        out.append(chunk.tobytes())
        if i + 1 < len(levels):
            bits = np.packbits(more, bitorder="little").tobytes()
            out.append(bits.ljust(_pad(len(chunk)), b"\0"))
            ones = np.add.reduceat(more, np.arange(0, len(more), BLOCK)) if len(more) else np.zeros(0)
            out.append((np.cumsum(ones) - ones).astype("<u4").tobytes())
    return b"".join(out)


class DacReader:
    """Reads one file through ``read_at(n_bytes, offset)``; only the header and
    the bytes asked for are fetched."""

    def __init__(self, read_at):
        self.read_at = read_at
        if read_at(8, 0) != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        n_levels, self.n_docs, self.n_tokens = map(int, self._array("<i8", 3, 8))
        counts = list(map(int, self._array("<i8", n_levels, 32)))
        self.docs_at = 32 + 8 * n_levels
        self.nulls_at = self.docs_at + 8 * self.n_docs
        self.starts_at = self.nulls_at + self.n_docs
        at = self.starts_at + 8 * (self.n_docs + 1)
        self.levels = []
        for i, n in enumerate(counts):
            bits, rank = at + n, at + n + _pad(n)
            self.levels.append((at, bits, rank, i + 1 == n_levels))
            at = rank + 4 * -(-n // BLOCK)

    def _array(self, kind: str, n: int, at: int) -> np.ndarray:
        return np.frombuffer(self.read_at(n * np.dtype(kind).itemsize, at), kind) if n else np.zeros(0, kind)

    def _rank(self, level, i: int) -> int:
        """Ones before bit ``i``, from one directory entry and part of a block."""
        _, bits, rank, _ = level
        block = i // BLOCK
        if i % BLOCK == 0:
            if i == 0:
                return 0
            block -= 1  # the entry after the last block does not exist
        inside = self._array("u1", BLOCK // 8, bits + block * BLOCK // 8)
        ones = np.unpackbits(inside, bitorder="little")[: i - block * BLOCK]
        return int(self._array("<u4", 1, rank + 4 * block)[0]) + int(ones.sum())

    def token(self, i: int) -> int:
        value = 0
        for n, level in enumerate(self.levels):
            at, bits, _, last = level
            value |= self.read_at(1, at + i)[0] << 8 * n
            if last or not self.read_at(1, bits + i // 8)[0] >> i % 8 & 1:
                return value
            i = self._rank(level, i)
        return value

    def tokens(self, first: int, end: int) -> np.ndarray:
        """Ids ``first`` to ``end``: one slice of every level."""
        out = np.zeros(end - first, "<u4")
        where = np.arange(end - first)
        a, b = first, end
        for n, level in enumerate(self.levels):
            at, bits, _, last = level
            out[where] |= self._array("u1", b - a, at + a).astype("<u4") << np.uint32(8 * n)
            if last or a == b:
                return out
            packed = self._array("u1", (b + 7) // 8 - a // 8, bits + a // 8)
            more = np.unpackbits(packed, bitorder="little")[a % 8: a % 8 + b - a].astype(bool)
            where = where[more]
            a = self._rank(level, a)
            b = a + len(where)
        return out

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        ids = self._array("<i8", self.n_docs, self.docs_at)
        nulls = self._array("u1", self.n_docs, self.nulls_at)
        return [None if z else int(d) for d, z in zip(ids, nulls)], self._array("<i8", self.n_docs + 1, self.starts_at)


def open_dac(path: str) -> DacReader:
    """Reader of a file in the shared folder, by random access."""
    from pyarrow import fs

    store, name = fs.FileSystem.from_uri(path)
    f = store.open_input_file(name)
    return DacReader(lambda n, at: f.read_at(n, at))


def _writer(folder: str, vocabulary: str):
    def write(batches):
        from pyarrow import fs
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = encoder(vocabulary, "byte")
        end = np.array([END_ID], "<u4").tobytes()
        store, base = fs.FileSystem.from_uri(folder)
        docs, lengths, ids, held, seq = [], [], [], 0, 0

        def flush():
            store.create_dir(base, recursive=True)
            name = f"part-{part:06d}-{seq:05d}-{uuid.uuid4().hex}.dac"
            with store.open_output_stream(f"{base}/{name}") as f:
                f.write(encode_dac(docs, np.array(lengths), np.frombuffer(b"".join(ids), "<u4")))
            return pa.RecordBatch.from_pylist([{"part": part, "seq": seq, "path": f"{folder}/{name}",
                                                "n_docs": len(docs), "n_ids": held}])
        for b in batches:
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                got = enc.encode(text or "") + end
                if docs and held + len(got) // 4 > SHARD_TOKENS:
                    yield flush()
                    docs, lengths, ids, held, seq = [], [], [], 0, seq + 1
                docs.append(d)
                lengths.append(len(got) // 4)
                ids.append(got)
                held += len(got) // 4
        if docs:
            yield flush()
    return write


_MANIFEST = "part long, seq long, path string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, partitions: int | None = None) -> DataFrame:
    """Write the corpus and return its manifest: ``part, seq`` (the order of
    the files), ``path``, ``n_docs``, ``n_ids`` and ``start`` (ids before it)."""
    spark = docs.sparkSession
    n = partitions or shuffle_partitions(spark)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.xxhash64("text").alias("tie"))
    ordered = narrow.repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    manifest = staged(ordered.select("doc_id", "text").mapInArrow(_writer(folder, vocabulary), _MANIFEST), "dac-manifest")
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read_documents(batches):
    for b in batches:
        for path, start in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
            reader = open_dac(path)
            docs, starts = reader.documents()
            crcs = [zlib.crc32(reader.tokens(int(a), int(z)).tobytes()) for a, z in zip(starts[:-1], starts[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(starts[:-1] + start, pa.int64()),
                 pa.array(np.diff(starts), pa.int64()), pa.array(crcs, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_documents(manifest: DataFrame) -> DataFrame:
    """Every document of the files, read back: a task per file."""
    files = manifest.select("path", "start", "part", "seq")
    return (files.repartition(max(1, shuffle_partitions(manifest.sparkSession)), "part", "seq").select("path", "start")
            .mapInArrow(_read_documents, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    folder = scratch_path(spark, "dac")
    manifest = write_token_files(load(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_documents(manifest)
