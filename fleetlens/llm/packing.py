"""Best-fit packing by the configuration linear program.

Documents are tokenised, ended with id 0 and cut into pieces of at most
``CAPACITY`` ids; only longer documents are cut. What the plan needs is the
histogram of piece lengths, at most ``CAPACITY`` numbers whatever the corpus:

* the configuration program (how many sequences of each filling) is solved by
  multiplicative weights: each round prices a best filling by an unbounded
  knapsack over the weights of the lengths that are not covered yet (and the next best
  that also fill a sequence), uses it in as many whole sequences as the scarcest of its
  lengths allows, and lowers the weights of what it covers, until every piece is covered. A round uses up a length or nearly,
  so there are at most a few rounds per length, whatever the corpus;
* rounding: near the end a filling may ask for more pieces of a length than are left.
  It is cut to these and topped up with the longest pieces that fit (best fit).

At sf0.1 95% of the sequences are fillings as priced, the others are topped up.

The plan is a list of (filling, number of sequences). A piece finds its place
from its length and its rank among the pieces of that length: the rank within
its task plus the counts of earlier tasks. So nothing but the histogram comes
to the driver and no length, however common, is ranked in one task.

Defined results: a null text is empty and packs its end id; repeated rows are
separate documents (with the same piece numbers); an empty table gives no
rows; texts of any length are cut into pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import load, staged
from fleetlens.llm.tokens import encoder

CAPACITY = 2048
STEP = 0.1
#: Fillings taken from one pricing.
FILLINGS = 4
END_ID = 0

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"


def _cutter(vocabulary: str, capacity: int):
    def cut(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        enc = encoder(vocabulary, "word")
        end = np.array([END_ID], "<u4").tobytes()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        step = 4 * capacity
        for b in batches:
            rows = []
            for d, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                ids = enc.encode(text or "") + end
                for k, at in enumerate(range(0, len(ids), step)):
                    one = ids[at:at + step]
                    n = len(one) // 4
                    rows.append((d, k, at // 4, n, zlib.crc32(one), part, int(seen[n])))
                    seen[n] += 1
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"]
            cols = list(zip(*rows)) or [[]] * len(names)
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
    return cut


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents, written once. ``nth`` counts the pieces of a
    length within the task ``part`` that made them."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return staged(narrow.mapInArrow(_cutter(vocabulary, capacity), _PIECES), "pieces")


def best_fillings(lengths: np.ndarray, value: np.ndarray, capacity: int, many: int = 1) -> list[np.ndarray]:
    """Counts per length of a filling of largest value (unbounded knapsack), and of the
    next best ones that differ in a first piece."""
    of = np.full(capacity + 1, -np.inf)
    of[lengths] = value
    best, pick = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    for w in range(1, capacity + 1):
        total = best[w - 1::-1] + of[1:w + 1]  # a piece of n and the best filling of w - n
        n = int(total.argmax())
        if total[n] > best[w - 1]:
            best[w], pick[w] = total[n], n + 1
        else:  # one place stays empty
            best[w] = best[w - 1]
    firsts = [int(pick[capacity])]
    if many > 1 and firsts[0]:
        ranked = np.argsort(-total, kind="stable")[:many] + 1
        firsts += [int(n) for n in ranked if n != firsts[0] and np.isfinite(total[n - 1])][:many - 1]
    out = []
    for n in firsts:
        counts, w = np.zeros(len(lengths), dtype=np.int64), capacity
        while w > 0:
            n = int(pick[w]) if w < capacity else n
            if n:
                counts[np.searchsorted(lengths, n)] += 1
            w -= max(n, 1)
        out.append(counts)
    return out


def topped_up(counts: np.ndarray, left: np.ndarray, lengths: np.ndarray, capacity: int) -> np.ndarray:
    """``counts`` within the pieces that are left, and the longest that fit in the room this gives."""
    out = np.minimum(counts, left)
    room = capacity - int((out * lengths).sum())
    for i in np.flatnonzero(left)[::-1]:
        more = min(room // int(lengths[i]), int(left[i] - out[i]))
        if more > 0:
            out[i] += more
            room -= more * int(lengths[i])
    return out


def priced_fillings(lengths: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int, bool]]:
    """Fillings, their numbers of sequences and whether they are as priced, that cover
    the demand exactly, by multiplicative weights."""
    left, share = demand.copy(), lengths / capacity
    weight = share * (1 + share / 2)  # at first by size, long pieces before the short ones that fill gaps
    out = []
    while left.any():
        live = np.flatnonzero(left)
        for k, found in enumerate(best_fillings(lengths[live], weight[live], capacity, FILLINGS)):
            counts = np.zeros(len(lengths), dtype=np.int64)
            counts[live] = found
            whole = bool((counts <= left).all())
            if k and (not whole or (counts * lengths).sum() < capacity):
                continue  # the next round prices anew
            if not whole:
                counts = topped_up(counts, left, lengths, capacity)
            used = counts > 0
            times = int((left[used] // counts[used]).min())
            left[used] -= times * counts[used]
            weight[used] *= np.exp(-STEP * times * counts[used] / demand[used])
            out.append((counts, times, whole))
    return out


def plan_fillings(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """``[({length: count}, sequences), ...]`` that use every piece exactly once."""
    every = {n: c for n, c in histogram.items() if c}
    whole = [({capacity: 1}, every.pop(capacity))] if capacity in every else []
    lengths = np.array(sorted(every), dtype=np.int64)
    demand = np.array([every[int(n)] for n in lengths], dtype=np.int64)
    return whole + [({int(n): int(c) for n, c in zip(lengths[counts > 0], counts[counts > 0])}, times)
                    for counts, times, _ in priced_fillings(lengths, demand, capacity)]


def _placer(plan: list[tuple[dict[int, int], int]]):
    """Arrow function that gives pieces their sequence and offset by rank."""
    used: dict[int, int] = {}
    keys, per, base, offset = [], [], [], []
    sequence = 0
    for counts, times in plan:
        at = 0
        for n, c in counts.items():
            keys.append((n << 44) + used.get(n, 0))
            per.append(c)
            base.append(sequence)
            offset.append(at)
            used[n] = used.get(n, 0) + c * times
            at += c * n
        sequence += times
    order = np.argsort(np.array(keys, dtype=np.int64))
    keys, per, base, offset = (np.array(x, dtype=np.int64)[order] for x in (keys, per, base, offset))

    def place(batches):
        for b in batches:
            length = b.column("length").to_numpy()
            rank = b.column("rank").to_numpy()
            i = np.searchsorted(keys, (length << 44) + rank, side="right") - 1
            r = (length << 44) + rank - keys[i]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
                + [pa.array(base[i] + r // per[i]), pa.array(offset[i] + r % per[i] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])
    return place


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with the sequence and the offset it is packed at."""
    cut = pieces(docs, vocabulary, capacity)
    per_task = staged(cut.groupBy("length", "part").agg(F.count("*").alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = per_task.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = (cut.join(first, ["length", "part"])
              .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank")))
    return ranked.mapInArrow(_placer(plan_fillings(histogram, capacity)),
                             "doc_id long, piece int, start long, length long, ids_crc32 long, "
                             "sequence_id long, offset long")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
