"""Substring dedup by relative Lempel-Ziv parsing against content-dealt reference blocks.

A window is ``WINDOW`` consecutive words. The text of all documents is the
reference; it lies in blocks, and every document is parsed against every block that
can hold one of its windows:

* **Dealing.** The seed of a window is the least hash of its ``SEED``-word grams.
  Windows that are equal have equal seeds, so a window is looked for in the block of
  its seed only; seeds of a single text need no block. A piece is a run of windows of one
  seed, sent as its words. A seed of more than ``HOT`` texts deals its windows one by
  one, by their words, so no block holds an unbounded group. Equal pieces are folded in the task
  that cuts them: all but the one of the smallest id are factors as a whole.
* **Parsing.** A block indexes the windows of its pieces in the order of ids, and each
  piece is factored greedily, from left to right: a factor starts at a window that
  an earlier document has and goes on while the reference goes on with the same words.
  Where it ends, the window across the boundary is looked up anew. Factors are compared
  with the reference word by word; their words are the duplicate spans.
* **Texts.** Of equal texts only the smallest id is parsed. The words of a document's spans go.

Defined results: a null text is empty; a document of fewer than 50 words keeps them
all; a null id is neither smaller nor larger than another, its words stay and it is no
reference; rows that share an id do not remove each other's words; repeated rows have
equal results; texts are read whole at any length, in pieces of at most ``RUN`` windows;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.caches import worker_cache
from fleetlens.llm.common import load, shuffle_partitions, staged, stored
from fleetlens.llm.shingles import WordCache, mix

WINDOW = 50
SEED = 20
HOT = 4096
RUN = 512
CHUNK_WORDS = 400_000
FOLD_BYTES = 24_000_000
BLOCK_BYTES = 12_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_NOTHING = hashlib.sha256(b"").hexdigest()


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive numbers of ``h``: a difference of running sums
    of ``h[i] * base^i``, brought back by ``base^-i``."""
    powers = np.cumprod(np.full(len(h), _BASE))
    sums = np.cumsum(h * powers)
    out = sums[n - 1:].copy()
    out[1:] -= sums[:-n]
    return mix(out * np.cumprod(np.full(len(out), _BASE_INVERSE)))


def window_seeds(h: np.ndarray) -> np.ndarray:
    """Seed of every window of the words ``h``: the least of its gram hashes."""
    least, span, wanted = grams(h, SEED), 1, WINDOW - SEED + 1
    while 2 * span <= wanted:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = wanted - span
    return np.minimum(least[:-rest], least[rest:]) if rest else least


def word_list(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes: split at space and 0x09-0x0D alone


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(worker_cache("words", WordCache).__getitem__, words), np.uint64, len(words))


def _seed_rows(counts: list[int], texts: list[int], h: np.ndarray) -> pa.RecordBatch:
    """``seed, text`` at every change of seed in documents laid end to end."""
    ends = np.cumsum(counts)
    doc = np.repeat(np.arange(len(counts)), counts)[: len(h) - WINDOW + 1]
    whole = np.arange(len(doc)) + WINDOW <= ends[doc]
    seed, doc = window_seeds(h)[whole], doc[whole]
    new = np.ones(len(seed), bool)
    new[1:] = (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])
    return pa.RecordBatch.from_arrays(
        [pa.array(seed[new].view(np.int64)), pa.array(np.array(texts, np.int64)[doc[new]])], ["seed", "text"])


def _text_seeds(batches):
    seen = set()  # texts of this task: copies add nothing
    counts, texts, held, total = [], [], [], 0
    for b in batches:
        for name, digest, text in zip(*(b.column(c).to_pylist() for c in ("name", "digest", "text"))):
            if digest in seen:
                continue
            seen.add(digest)
            words = word_list(text)
            if len(words) < WINDOW:
                continue
            counts.append(len(words))
            texts.append(name)
            held.append(_hashes(words))
            total += len(words)
            if total >= CHUNK_WORDS:
                yield _seed_rows(counts, texts, np.concatenate(held))
                counts, texts, held, total = [], [], [], 0
    if counts:
        yield _seed_rows(counts, texts, np.concatenate(held))


def shared_seeds(docs: DataFrame) -> DataFrame:
    """``name, seeds, hot`` of texts: their seeds that other texts have too, and those
    of more than ``HOT`` texts. ``docs`` holds ``text``, its ``digest`` and ``name``, a hash of that."""
    pairs = stored(docs.mapInArrow(_text_seeds, "seed long, text long"), "seeds")
    census = (pairs.groupBy("seed").agg(F.count("*").alias("n"), F.min("text").alias("a"), F.max("text").alias("z"))
              .filter("a < z").select("seed", (F.col("n") > HOT).alias("is_hot")))
    return pairs.join(census, "seed").groupBy(F.col("text").alias("name")).agg(
        F.collect_set(F.when(~F.col("is_hot"), F.col("seed"))).alias("seeds"),
        F.collect_set(F.when(F.col("is_hot"), F.col("seed"))).alias("hot"))


_SORTED = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
                     ("kept_sha256", pa.string()), ("text", pa.string()), ("seeds", pa.list_(pa.int64())),
                     ("hot", pa.list_(pa.int64()))])
_SORTED_SQL = ("doc_id long, digest binary, n_words long, n_removed long, kept_sha256 string, text string, "
               "seeds array<long>, hot array<long>")


def _settle(batches):
    """Settle the documents that need no parsing; keep the texts of the others."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            words = word_list(r["text"])
            n, text, removed = len(words), None, 0
            if r["doc_id"] is not None and n >= WINDOW:
                if r["doc_id"] > r["first_id"]:
                    removed = n
                elif r["seeds"] or r["hot"]:
                    text = r["text"]
            out.append({"doc_id": r["doc_id"], "digest": r["digest"], "n_words": n, "n_removed": removed,
                        "kept_sha256": _NOTHING if removed else None if text else hashlib.sha256(b" ".join(words)).hexdigest(),
                        "text": text, "seeds": r["seeds"] if text else None, "hot": r["hot"] if text else None})
            if len(out) == 500:
                yield pa.RecordBatch.from_pylist(out, _SORTED)
                out = []
        yield pa.RecordBatch.from_pylist(out, _SORTED)


def _cuts(seed: np.ndarray, wanted: np.ndarray, single: np.ndarray):
    """``(first window, number of windows, alone)`` of the pieces of a document."""
    new = np.ones(len(seed), bool)
    new[1:] = seed[1:] != seed[:-1]
    starts = np.flatnonzero(new)
    for a, z in zip(starts, np.append(starts[1:], len(seed))):
        if single[a]:
            yield from ((i, 1, True) for i in range(a, z))
        elif wanted[a]:
            yield from ((i, min(RUN, z - i), False) for i in range(a, z, RUN))


_PIECES = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("digest", pa.binary()), ("start", pa.int32()),
                     ("n", pa.int32()), ("words", pa.binary())])
_PIECES_SQL = "key long, doc_id long, digest binary, start int, n int, words binary"


def _pieces(batches):
    """Pieces of documents; of equal ones in this task the smallest id's goes on, the
    others are returned without words: they are factors as a whole."""
    held, size, out = {}, 0, []
    for b in batches:
        for doc, digest, text, seeds, hot in zip(*(b.column(c).to_pylist() for c in
                                                   ("doc_id", "digest", "text", "seeds", "hot"))):
            words = word_list(text)
            seed = window_seeds(_hashes(words)).view(np.int64)
            single = np.isin(seed, np.array(hot, np.int64))
            for at, n, alone in _cuts(seed, np.isin(seed, np.array(seeds, np.int64)), single):
                piece = b" ".join(words[at:at + n + WINDOW - 1])
                key = xxhash.xxh64_intdigest(piece) - (1 << 63) if alone else int(seed[at])
                row, other = (key, doc, digest, int(at), int(n) + WINDOW - 1), held.get((key, piece))
                if other is None:
                    held[key, piece] = row
                    size += len(piece) + 200
                elif other[1] == doc:
                    if other != row:  # the same words again in this document
                        out.append((*row, piece))
                else:
                    low, high = sorted((row, other), key=lambda x: x[1])
                    held[key, piece] = low
                    out.append((*high, None))
            if size > FOLD_BYTES:
                out += [(*row, piece) for (_, piece), row in held.items()]
                held, size = {}, 0
            while len(out) >= 5000:
                yield _rows(out[:5000])
                out = out[5000:]
    out += [(*row, piece) for (_, piece), row in held.items()]
    for i in range(0, len(out), 5000):
        yield _rows(out[i:i + 5000])


def _rows(out: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PIECES)], schema=_PIECES)


def earlier(words: np.ndarray, offsets: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the pieces that a smaller document has: their places in ``words`` and those of their
    first occurrence. ``words`` are numbers of words, piece ``p`` lies from ``offsets[p]``
    to ``offsets[p + 1]``, the pieces ascend by ``docs``."""
    lengths = np.diff(offsets)
    piece = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(words))
    at = place[place + WINDOW <= offsets[piece + 1]]
    print_ = grams(mix(words.astype(np.uint64) + np.uint64(1)), WINDOW)[at]
    order = np.argsort(print_, kind="stable")
    sorted_ = print_[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    first = np.empty(len(order), np.int64)
    first[order] = at[order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]]
    wrong = ~_same(words, at, first)
    if wrong.any():  # different windows of one print: told apart by their words
        for value in np.unique(print_[wrong]):
            seen: dict[bytes, int] = {}
            for i in np.flatnonzero(print_ == value):
                first[i] = seen.setdefault(words[at[i]:at[i] + WINDOW].tobytes(), int(at[i]))
    mine = docs[piece[first]] < docs[piece[at]]
    return at[mine], first[mine]


def _same(words: np.ndarray, at: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Are the windows at ``at`` and ``first`` equal word by word. A window that follows
    its neighbour in both places is compared by its last word, one at a boundary whole."""
    follows = np.zeros(len(at), bool)
    follows[1:] = (at[1:] == at[:-1] + 1) & (first[1:] == first[:-1] + 1)
    same = words[at + WINDOW - 1] == words[first + WINDOW - 1]
    heads = np.flatnonzero(~follows & (at != first))
    for i in range(0, len(heads), 20_000):
        some, span = heads[i:i + 20_000], np.arange(WINDOW)
        same[some] = (words[at[some][:, None] + span] == words[first[some][:, None] + span]).all(axis=1)
    broken = np.flatnonzero(~same)
    for i in broken:  # what follows a false window leans on it
        while i + 1 < len(at) and follows[i + 1]:
            i += 1
            same[i] = False
    return same


def factors(words: np.ndarray, offsets: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length in words of the factors of all pieces, from left to right."""
    at, first = earlier(words, offsets, docs)
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (first[1:] != first[:-1] + 1)
    starts = np.flatnonzero(head)
    runs = np.diff(np.append(starts, len(at)))
    return at[starts], runs + WINDOW - 1


def _parse(batches):
    """Factors of the pieces of one block."""
    rows = [c for b in batches for c in zip(*(b.column(c).to_pylist() for c in ("doc_id", "digest", "start", "words")))]
    if not rows:
        return
    rows.sort(key=lambda r: r[0])
    number: dict[bytes, int] = {}
    held = [np.array([number.setdefault(w, len(number)) for w in r[3].split()], np.int32) for r in rows]
    offsets = np.concatenate([[0], np.cumsum([len(h) for h in held])])
    start, length = factors(np.concatenate(held), offsets, np.array([r[0] for r in rows]))
    piece = np.searchsorted(offsets, start, "right") - 1
    for i in range(0, len(start), 20_000):
        p = piece[i:i + 20_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows[j][0] for j in p], pa.int64()), pa.array([rows[j][1] for j in p], pa.binary()),
             pa.array(start[i:i + 20_000] - offsets[p] + np.array([rows[j][2] for j in p]), pa.int32()),
             pa.array(length[i:i + 20_000], pa.int32())], ["doc_id", "digest", "start", "n"])


def _remove(batches):
    """Documents without the words of their spans."""
    for b in batches:
        out = []
        for r in b.to_pylist():
            words = word_list(r["text"])
            edge = np.zeros(len(words) + 1, np.int64)
            for s in r["spans"] or ():
                edge[s["start"]] += 1
                edge[s["start"] + s["n"]] -= 1
            keep = np.cumsum(edge[:-1]) == 0
            kept = [w for w, k in zip(words, keep) if k]
            out.append({"doc_id": r["doc_id"], "n_words": len(words), "n_removed": len(words) - len(kept),
                        "kept_sha256": hashlib.sha256(b" ".join(kept)).hexdigest()})
        yield pa.RecordBatch.from_pylist(out, pa.schema(
            [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())]))


def duplicate_spans(parsed: DataFrame) -> DataFrame:
    """``doc_id, digest, start, n``: the factors of documents, in words."""
    pieces = stored(parsed.mapInArrow(_pieces, _PIECES_SQL), "pieces")
    size = pieces.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(shuffle_partitions(parsed.sparkSession), -(-size // BLOCK_BYTES))
    found = (pieces.filter("words IS NOT NULL").repartition(blocks, "key")
             .mapInArrow(_parse, "doc_id long, digest binary, start int, n int"))
    return found.unionByName(pieces.filter("words IS NULL").select("doc_id", "digest", "start", "n"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row of ``docs``."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    d = d.withColumn("digest", F.unhex(F.md5("text")))
    d = d.withColumn("name", F.xxhash64("digest"))
    seeds = shared_seeds(d.filter("doc_id IS NOT NULL").select("name", "digest", "text"))
    first = d.groupBy("digest", "name").agg(F.min("doc_id").alias("first_id"))
    known = first.join(seeds, "name", "left").drop("name")
    settled = stored(d.drop("name").join(known, "digest").mapInArrow(_settle, _SORTED_SQL), "settled")
    parsed = settled.filter("text IS NOT NULL")
    spans = (duplicate_spans(parsed.select("doc_id", "digest", "text", "seeds", "hot"))
             .groupBy("doc_id", "digest").agg(F.collect_list(F.struct("start", "n")).alias("spans")))
    cut = (parsed.select("doc_id", "digest", "text").join(spans, ["doc_id", "digest"], "left")
           .mapInArrow(_remove, "doc_id long, n_words long, n_removed long, kept_sha256 string"))
    return settled.filter("text IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256").unionByName(cut)


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(load(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
v AS (
  SELECT r, doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
  FROM d, unnest(range(1, len(w) - 48)) AS x(i) WHERE len(w) >= 50),
f AS (SELECT h, min(doc_id) AS first FROM v GROUP BY h),
g AS (SELECT r, i, max(CASE WHEN first < doc_id THEN 1 ELSE 0 END) AS again FROM v JOIN f USING (h) GROUP BY r, i),
e AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
m AS (
  SELECT e.r, e.i, word, coalesce(max(again) OVER (PARTITION BY e.r ORDER BY e.i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
  FROM e LEFT JOIN g ON e.r = g.r AND e.i = g.i)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN (
  SELECT r, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM m GROUP BY r) USING (r)
"""
