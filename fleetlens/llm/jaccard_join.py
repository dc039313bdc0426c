"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct five-word shingles. A
pair links when ``100 |A & B| >= 75 |A | B|``, which bounds the symmetric
difference by ``(|A| + |B|) / 7``.

*Sketch.* Shingles are dealt to ``m`` segments by hash; a segment of the sketch
is the XOR (the bitwise parity) of its shingles' hashes. A shingle in one set
only changes one segment, so the segments in which two sketches differ are at
most the symmetric difference ``D``.

*Size bands.* Band ``c`` holds sizes ``2^c`` to ``2^(c+1) - 1`` and has a fixed
``m``. A pair meets in the band of its larger set: a set is sketched in its own
band and, if a set 4/3 its size would lie there, in the next.

*Pigeonhole.* If a set has more than ``D`` non-empty segments, a partner shares
one of them; at most ``D`` of a set's segments are not shared with a given
partner. So, in any common order, each partner's first ``D + 1`` segments hold
a shared one. The order is by frequency: a set with more than ``D`` segments
that nobody else has cannot have a partner, and passages that very many
documents share come last and are rarely needed. Sets whose shingles crowd into
too few segments are also sketched with 2, 4, ... times as many, until they
have more than ``D``; both sides of a pair then meet at the level at which the
first of them passes.

*Verify.* Documents with equal sets are one (copies in one batch at once, the
others by set hash). Each document is first compared with the smallest member
of its segments' groups, so a large group of near copies costs one comparison
per document; links are contracted to components. Members of different
components in a group are then held against each other by a sketch of single
bits, 4 to 8 per shingle: its Hamming distance bounds the symmetric difference
from below and rules out nearly all pairs that do not link, inside the task.
First each document's nearest partner left is verified, then every pair left
between components. Large groups are dealt in blocks of ``BLOCK`` members. No
link between different components is missed.

Sketch segments travel as packed arrays between batches of documents and hash
shards, both of bounded size. Defined results: null or wordless text has an
empty set, links with nothing and is its own component; repeated rows link; a
component's id is its smallest non-null ``doc_id``; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import load, numbered, shuffle_partitions, staged
from fleetlens.llm.components import components
from fleetlens.llm.shingles import mix, shingle_set
from fleetlens.session import scratch_path

BATCH_DOCS = 4_096
BATCH_SHINGLES = 500_000
#: Members of a segment's group that one task compares with as many others.
BLOCK = 1024
#: Bits of the filter that tells which documents' sets are made again (8 MB).
FILTER_BITS = 26
#: Segments per band: so many times the largest symmetric difference.
SPREAD = 1.25
_U64 = np.uint64


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """The link condition on two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= 75 * (len(a) + len(b) - both)


def largest_difference(n: int, band: int) -> int:
    """Most elements in one set only, for a set of ``n`` and a linked partner
    when the larger of the two lies in ``band``."""
    return (n + min(4 * n // 3, (2 << band) - 1)) // 7


def sketch(hashes: np.ndarray, band: int, level: int) -> np.ndarray:
    """Keys of the non-empty segments of a sorted set's sketch."""
    m = int(SPREAD * (2 * ((2 << band) - 1) // 7) + 1) << level
    segment = ((hashes >> _U64(32)) * _U64(m)) >> _U64(32)  # by the high bits, so sorted
    first = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    parity = np.bitwise_xor.reduceat(mix(hashes), first)
    place = segment[first] * _U64(0x9E3779B97F4A7C15) + _U64((band << 8) + level + 1)
    return mix(parity ^ mix(place))


def sketches(hashes: np.ndarray):
    """``(keys, D)`` of every band and level a set is sketched at."""
    n = len(hashes)
    band = n.bit_length() - 1
    for c in (band, band + 1):
        if c > band and 4 * n // 3 < 1 << c:
            return
        most, level = largest_difference(n, c), 0
        while True:
            keys = sketch(hashes, c, level)
            yield keys, most, c
            if len(keys) > most or level >= 24:
                break
            level += 1


def _batches_of_documents(batches):
    """Lists of ``(doc_id, text)`` of bounded size."""
    held, size = [], 0
    for b in batches:
        for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            held.append((d, t))
            size += len(t or "") // 6
            if len(held) >= BATCH_DOCS or size >= BATCH_SHINGLES:
                yield held
                held, size = [], 0
    if held:
        yield held


_SKETCHED = "kind int, batch long, shard int, ref long, doc_id long, n long, h1 long, h2 long, data binary"
_NAMES = [c.split()[0] for c in _SKETCHED.split(", ")]
_KINDS = [pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.binary()]
DOC, SET, KEYS, UNITS = range(4)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[]] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS)], _NAMES)


def _sketcher(shards: int):
    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for seq, docs in enumerate(_batches_of_documents(batches)):
            batch = (part << 20) + seq
            rows, known, keys, unit_keys, units = [], {}, [], [], []
            for i, (doc_id, text) in enumerate(docs):
                hashes = shingle_set(text)
                ref = None
                if len(hashes):
                    digest = xxhash.xxh128_digest(hashes.tobytes())
                    ref = known.get(digest)
                    if ref is None:
                        ref = known[digest] = (batch << 15) + len(known)
                        h1, h2 = np.frombuffer(digest, "<i8").tolist()
                        rows.append((SET, batch, None, ref, doc_id, len(hashes), h1, h2, None))
                        for k, most, c in sketches(hashes):
                            keys.append(k)
                            unit_keys.append(len(k))
                            units.append((ref & 0x7FFF, most, c))
                rows.append((DOC, batch, None, ref, doc_id, len(hashes), None, None, None))
                if len(rows) >= 10_000:
                    yield _rows(rows)
                    rows = []
            if keys:
                every = np.concatenate(keys)
                unit = np.repeat(np.arange(len(units), dtype=np.int64), unit_keys)
                shard = ((every >> _U64(48)) * _U64(shards)) >> _U64(16)
                order = np.argsort(shard.astype(np.uint16), kind="stable")
                every, unit = every[order], unit[order]
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                for s in range(shards):
                    a, z = cut[s], cut[s + 1]
                    if a < z:
                        rows.append((KEYS, batch, s, None, None, int(z - a), None, None, _pack(every[a:z], unit[a:z])))
                meta = np.array([(u, m, k, c) for (u, m, c), k in zip(units, unit_keys)], "<i4")
                rows.append((UNITS, batch, None, None, None, len(units), None, None, meta.tobytes()))
            yield _rows(rows)
    return run


def _pack(keys: np.ndarray, unit: np.ndarray) -> bytes:
    """The lower 5 bytes of keys (a shard has one range of the upper ones; two keys that
    this makes equal are one more candidate), units as steps of two bytes."""
    step = np.diff(unit, prepend=0)
    assert not len(step) or step.max() < 1 << 16, "a batch has fewer than 65536 sketches"
    return step.astype("<u2").tobytes() + keys.astype("<u4").tobytes() + (keys >> _U64(32)).astype("u1").tobytes()


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(data) // 7
    unit = np.cumsum(np.frombuffer(data, "<u2", n).astype(np.int64))
    low = np.frombuffer(data, "<u4", n, 2 * n).astype(_U64)
    return low | np.frombuffer(data, "u1", n, 6 * n).astype(_U64) << _U64(32), unit


def _shared_keys(key, table):
    """Of one shard: to every batch its keys that occur more than once, and how often."""
    batch = table.column("batch").to_pylist()
    parts = [_unpack(d) for d in table.column("data").to_pylist()]
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    count = np.diff(np.append(first, len(ranked)))
    often = np.empty(len(keys), np.int64)
    often[order] = np.repeat(count, count)
    out, at = [], 0
    shard = _U64(key[0].as_py())
    for b, (k, unit) in zip(batch, parts):
        many = often[at: at + len(k)] > 1
        if many.any():
            full = k[many] | shard << _U64(48)
            out.append((b, full.tobytes() + unit[many].astype("<u4").tobytes() + often[at: at + len(k)][many].astype("<u4").tobytes()))
        at += len(k)
    return pa.table({"batch": pa.array([b for b, _ in out], pa.int64()), "data": pa.array([d for _, d in out], pa.binary())})


def _prefixes(key, left, right):
    """Of one batch: the shared keys among the first ``D + 1`` of every set that can have a partner."""
    none = pa.table({c: pa.array([], k) for c, k in (("key", pa.int64()), ("ref", pa.int64()), ("band", pa.int32()))})
    if not left.num_rows or not right.num_rows:
        return none
    batch = key[0].as_py()
    meta = np.frombuffer(left.column("data")[0].as_py(), "<i4").reshape(-1, 4).astype(np.int64)
    keys, units, often = [], [], []
    for d in right.column("data").to_pylist():
        n = len(d) // 16
        keys.append(np.frombuffer(d, "<u8", n))
        units.append(np.frombuffer(d, "<u4", n, 8 * n))
        often.append(np.frombuffer(d, "<u4", n, 12 * n))
    keys, units, often = np.concatenate(keys), np.concatenate(units).astype(np.int64), np.concatenate(often)
    shared = np.bincount(units, minlength=len(meta))
    room = meta[:, 1] + 1 - (meta[:, 2] - shared)  # of the first D + 1, those after the unshared ones
    alive = room[units] > 0
    keys, units, often = keys[alive], units[alive], often[alive]
    order = np.lexsort((keys, often, units))
    keys, units = keys[order], units[order]
    first = np.searchsorted(units, units, side="left")
    keep = np.arange(len(units)) - first < room[units]
    return pa.table({"key": pa.array(keys[keep].view(np.int64), pa.int64()),
                     "ref": pa.array((batch << 15) + meta[units[keep], 0], pa.int64()),
                     "band": pa.array(meta[units[keep], 3], pa.int32())})


def parity_bits(hashes: np.ndarray, band: int) -> np.ndarray:
    """The sketch of single bits, two to four per element, as 64-bit words."""
    width = max(6, band + 2)
    at = mix(hashes ^ _U64(0x2545F4914F6CDD1D)) >> _U64(64 - width)
    return np.packbits(np.bincount(at.astype(np.int64), minlength=1 << width).astype(np.uint8) & 1).view("<u8")


def _bit_sketches(batches):
    for b in batches:
        rows = []
        for ref, data in zip(b.column("ref").to_pylist(), b.column("hashes").to_pylist()):
            hashes = np.frombuffer(data, "<u8")
            n = len(hashes)
            band = n.bit_length() - 1
            for c in (band, band + 1):
                if c == band or 4 * n // 3 >= 1 << c:
                    rows.append((ref, c, n, parity_bits(hashes, c).tobytes()))
        cols = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                                         ["ref", "band", "n", "bits"])


def _candidates_of(rows: list[tuple], nearest: bool) -> tuple[set[tuple[int, int]], bool]:
    """Pairs of one group, or of two blocks of it, that the bits do not rule
    out; only the nearest of each member if ``nearest``. Also whether others are left."""
    if len({r[2] for r in rows}) < 2:
        return set(), False
    ref, side, root, n = (np.array([r[i] for r in rows], dtype=np.int64) for i in range(4))
    bits = np.frombuffer(b"".join(r[4] for r in rows), "<u8").reshape(len(rows), -1)
    out, left = set(), False
    for i in range(len(rows)):
        j = np.flatnonzero((root != root[i]) & ((side == 2) | (side != side[i]))
                           & (np.minimum(n, n[i]) * 100 >= 75 * np.maximum(n, n[i])))
        if not nearest:
            j = j[ref[j] > ref[i]]
        if len(j):
            apart = np.bitwise_count(bits[j] ^ bits[i]).sum(axis=1, dtype=np.int64)
            fits = apart <= (n[j] + n[i]) // 7
            if fits.any():
                found = ref[j[fits]]
                if nearest:
                    left = left or len(found) > 1
                    found = found[[np.lexsort((found, apart[fits]))[0]]]
                out.update((min(int(ref[i]), int(x)), max(int(ref[i]), int(x))) for x in found)
    return out, left


def _compare_groups(nearest: bool):
    """Rows come sorted by ``key, lo, hi``; a group may go on in the next batch. A row
    is a pair, or the key alone of a group that has pairs left for the next round."""
    def run(batches):
        held: list[tuple] = []
        last = None

        def found():
            pairs, left = _candidates_of(held, nearest)
            return [(u, v, None) for u, v in pairs] + ([(None, None, last[0])] if left else [])

        def emit(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["u", "v", "key"])
        for b in batches:
            rows = []
            for key, lo, hi, block, ref, root, n, bits in zip(*(b.column(c).to_pylist() for c in (
                    "key", "lo", "hi", "block", "ref", "root", "n", "bits"))):
                if (key, lo, hi) != last:
                    rows += found()
                    held, last = [], (key, lo, hi)
                # members of one block meet each other, members of two blocks only the other block
                held.append((ref, 2 if lo == hi else int(block == hi), root, n, bits))
            yield emit(rows)
        yield emit(found())
    return run


def _open_pairs(stars: DataFrame, roots: DataFrame, bits: DataFrame, nearest: bool) -> DataFrame:
    """Pairs ``u, v`` of different components in a group that the bits leave open, and
    the ``key`` of every group that has more of them than were returned."""
    named = _with_root(stars.select("key", "ref", "band", "size"), roots)
    mixed = named.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).filter("a <> b").select("key")
    rows = named.join(mixed, "key").join(bits, ["ref", "band"])
    blocks = F.ceil(F.col("size") / BLOCK)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("ref"), blocks)).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    rows = rows.withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    dealt = (rows.select("key", "lo", "hi", "block", "ref", "root", "n", "bits")
             .repartition(shuffle_partitions(stars.sparkSession), "key", "lo", "hi").sortWithinPartitions("key", "lo", "hi"))
    return dealt.mapInArrow(_compare_groups(nearest), "u long, v long, key long")


def _id_place(doc_id: np.ndarray) -> np.ndarray:
    return (mix(doc_id.astype("<i8").view("<u8") ^ _U64(0x9E3779B97F4A7C15)) >> _U64(64 - FILTER_BITS)).astype(np.int64)


def _id_words(batches):
    """The set bits of an id filter: 64-bit words and their places."""
    for b in batches:
        ids = b.column("doc_id").drop_null().to_numpy()
        place = np.unique(_id_place(ids))
        word, at = np.unique(place >> 6, return_index=True)
        bits = np.bitwise_or.reduceat(_U64(1) << (place & 63).astype(_U64), at) if len(place) else np.zeros(0, _U64)
        yield pa.RecordBatch.from_arrays([pa.array(word, pa.int64()), pa.array(bits.view(np.int64), pa.int64())], ["word", "bits"])


def _id_filter(wanted: DataFrame) -> np.ndarray:
    """A filter of the ids of ``wanted``, ``2^FILTER_BITS`` bits whatever their number. It
    lets all of them through, and of the others the share of the bits that are set."""
    words = wanted.select("doc_id").mapInArrow(_id_words, "word long, bits long")
    out = np.zeros(1 << (FILTER_BITS - 6), _U64)
    for r in words.groupBy("word").agg(F.bit_or("bits").alias("bits")).collect():  # at most 2^(FILTER_BITS - 6) rows
        out[r["word"]] = np.int64(r["bits"]).view(_U64)
    return out


def _sets_of(ids):
    """Sets of the documents that the filter ``ids`` (a broadcast) lets through, and of those without an id."""
    def run(batches):
        known, seen = ids.value, set()  # sets of this task: repeated rows add nothing
        for b in batches:
            doc = b.column("doc_id")
            place = _id_place(doc.fill_null(0).to_numpy(zero_copy_only=False))
            through = (known[place >> 6] >> (place & 63).astype(_U64) & _U64(1)).astype(bool)
            through |= doc.is_null().to_numpy(zero_copy_only=False)
            h1, h2, sets = [], [], []
            for t in b.column("text").filter(pa.array(through)).to_pylist():
                s = shingle_set(t)
                digest = xxhash.xxh128_digest(s.tobytes())
                if len(s) and digest not in seen:
                    seen.add(digest)
                    one, two = np.frombuffer(digest, "<i8").tolist()
                    h1.append(one)
                    h2.append(two)
                    sets.append(s.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(sets, pa.binary())],
                                             ["h1", "h2", "hashes"])
    return run


def _verify_batches(batches):
    for b in batches:
        yes = [linked(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"))
               for x, y in zip(b.column("left").to_pylist(), b.column("right").to_pylist())]
        t = pa.RecordBatch.from_arrays([b.column("u"), b.column("v")], ["u", "v"])
        yield t.filter(pa.array(yes, pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame, name: str) -> DataFrame:
    """The pairs ``(u, v)`` that link."""
    left = sets.select(F.col("ref").alias("u"), F.col("hashes").alias("left"))
    right = sets.select(F.col("ref").alias("v"), F.col("hashes").alias("right"))
    both = pairs.join(right.hint("merge"), "v").join(left.hint("merge"), "u").select("u", "v", "left", "right")
    return staged(both.mapInArrow(_verify_batches, "u long, v long"), name)


def _first_of_each(batches):
    """Of rows sorted by ``ref``, the first of each."""
    last = None
    for b in batches:
        ref = b.column("ref").to_numpy()
        new = np.ones(len(ref), bool)
        new[1:] = ref[1:] != ref[:-1]
        if len(ref):
            new[0] = ref[0] != last
            last = ref[-1]
        yield b.filter(pa.array(new))


def _kept_by_ref(sets: DataFrame) -> tuple[DataFrame, str]:
    """One set per ``ref`` as a table bucketed and sorted by it in the shared folder:
    each round of verification then moves its pairs to the sets, not all sets
    to the pairs. Also the table's name, to be dropped afterwards."""
    spark = sets.sparkSession
    n, name = shuffle_partitions(spark), f"fleetlens_sets_{uuid.uuid4().hex}"
    (sets.repartition(n, "ref").sortWithinPartitions("ref").mapInArrow(_first_of_each, sets.schema).write.bucketBy(n, "ref").sortBy("ref")
     .option("path", scratch_path(spark, "jaccard-sets-by-ref")).format("parquet").saveAsTable(name))
    return spark.table(name), name


def _with_root(rows: DataFrame, roots: DataFrame) -> DataFrame:
    return (rows.join(roots.withColumnRenamed("node", "ref"), "ref", "left")
            .withColumn("root", F.coalesce("root", "ref")))


def _links(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """``node, root`` of the components of the sets that share a bucket."""
    # groups with the same members (told by two 64-bit parities of their hashes) give the same pairs: one stays
    members = [F.bit_xor(F.xxhash64("ref", F.lit(i))).alias(f"m{i}") for i in (1, 2)]
    groups = (buckets.groupBy("key").agg(F.min("ref").alias("low"), F.count("*").alias("size"), *members).filter("size > 1")
              .groupBy("low", "size", "m1", "m2").agg(F.min("key").alias("key")).select("key", "low", "size"))
    stars = staged(buckets.join(groups, "key"), "jaccard-buckets")
    bits = staged(sets.mapInArrow(_bit_sketches, "ref long, band int, n long, bits binary"), "jaccard-bits")
    done = staged(stars.filter("ref > low").groupBy("ref").agg(F.min("low").alias("u"))
                  .select("u", F.col("ref").alias("v")), "jaccard-pairs")
    links = _verified(done, sets, "jaccard-links")
    roots = components(links)
    for nearest in (True, False):
        found = staged(_open_pairs(stars, roots, bits, nearest), "jaccard-open")
        # groups in which the bits left no further pair are not dealt again
        stars = stars.join(found.filter("key IS NOT NULL").select("key").distinct(), "key", "left_semi")
        pairs = found.filter("u IS NOT NULL").select("u", "v").distinct()
        pairs = staged(pairs.join(done, ["u", "v"], "left_anti"), "jaccard-pairs")
        links = links.unionByName(_verified(pairs, sets, "jaccard-links"))
        done = done.unionByName(pairs)
        roots = components(links)
    return roots


def jaccard_components(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document."""
    spark = docs.sparkSession
    n_shards = min(shards or 4 * shuffle_partitions(spark), 60_000)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = staged(narrow.mapInArrow(_sketcher(n_shards), _SKETCHED), "jaccard-sketches")
    every = made.filter(F.col("kind") == DOC).select("ref", "doc_id", F.col("n").alias("n_shingles"))
    distinct = made.filter(F.col("kind") == SET).select("ref", "doc_id", "h1", "h2")
    same = Window.partitionBy("h1", "h2")  # at most one row per batch and set
    canon = staged(distinct.withColumn("same", F.min("ref").over(same)), "jaccard-sets")

    shared = (made.filter(F.col("kind") == KEYS).select("shard", "batch", "data")
              .groupBy("shard").applyInArrow(_shared_keys, "batch long, data binary"))
    units = made.filter(F.col("kind") == UNITS).select("batch", "data")
    prefixes = (units.groupBy("batch").cogroup(shared.groupBy("batch"))
                .applyInArrow(_prefixes, "key long, ref long, band int"))
    only = canon.filter("ref = same").select("ref")
    buckets = staged(prefixes.join(only, "ref", "left_semi"), "jaccard-prefixes")

    # the sets that share a bucket, made again from their texts
    busy = buckets.join(buckets.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1"), "key", "left_semi")
    wanted = staged(canon.join(busy.select("ref").distinct(), "ref", "left_semi").select("ref", "doc_id", "h1", "h2"), "jaccard-wanted")
    ids = spark.sparkContext.broadcast(_id_filter(wanted))  # 2^FILTER_BITS bits: texts of other documents are not moved
    again = narrow.mapInArrow(_sets_of(ids), "h1 long, h2 long, hashes binary")
    sets, table = _kept_by_ref(again.join(wanted.select("ref", "h1", "h2"), ["h1", "h2"]).select("ref", "hashes"))
    try:
        roots = _links(buckets, sets)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # the catalog entry; nothing reads the files any more
    canon = canon.select("ref", F.col("same").alias("set_ref"))
    rooted = (canon.join(roots.withColumnRenamed("node", "set_ref"), "set_ref", "left")
              .select("ref", F.coalesce("root", "set_ref").alias("root")))
    placed = staged(every.join(rooted, "ref", "left"), "jaccard-placed")
    ids = placed.filter(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return placed.join(ids, "root", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: of every component one row, that of the smallest
    ``doc_id`` (null last; of equal ids the first row of a numbered copy). Rows
    without words stay. The decision and the rows come from that copy, so rows that
    share an id, or have none, are told apart."""
    rows = numbered(docs)
    found = jaccard_components(rows.select(F.col("__row").alias("doc_id"), "text")).filter("n_shingles > 0")
    ids = rows.select(F.col("__row").alias("row"), F.col("doc_id").cast("long").alias("id"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))["row"].alias("__keep")
    groups = found.filter("doc_id <> component_id").select(F.col("component_id").alias("group")).distinct()
    members = found.join(groups, found["component_id"] == groups["group"]).select(F.col("doc_id").alias("row"), "group")
    keep = members.join(ids, "row").groupBy("group").agg(first)
    gone = members.join(keep, "group").filter("row <> __keep").select(F.col("row").alias("__row"))
    return rows.join(gone, "__row", "left_anti").drop("__row")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(load(spark, sf_dir, "documents"))
