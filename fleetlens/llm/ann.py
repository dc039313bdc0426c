"""Approximate nearest neighbours by multi-index hashing.

Nearness is the inner product. Vectors are scaled by the largest norm and given
one more component that makes all norms 1 (queries get 0 there), so a larger
inner product is a smaller angle. Binary codes of ``BITS`` bits are the signs
of learned rotations (PCA, then iterative quantisation, from as many starts as
the bits need), fitted on at most ``FIT_ROWS`` vectors, the smallest by a hash
of their id. On the same sample the Hamming radius is learned that holds
``RADIUS_SHARE`` of the true neighbours.

Codes are split into ``m = BITS / SUB`` substrings. Within a block of at most
about ``BLOCK_ROWS`` vectors each substring has an index from its value to its
rows. With ``r = m q + a``, a code within ``r`` bits of a query is within ``q``
bits in one of the first ``a + 1`` substrings or within ``q - 1`` in one of the
others (pigeonhole), so probing all values that near in every index retrieves
every code in the radius; these are reranked by the exact product of the
original vectors. A query that finds fewer
than ``k`` in the radius is searched again with a radius of all bits, which is
exact.

Queries (a stated set) meet candidates block by block; every block pair is one
bounded task that returns at most ``k`` rows a query.

Defined results: null, empty, zero vectors, vectors with null or non-finite
components, vectors of another length than most, and rows without id take no
part; rows that repeat an id are one vector (the smallest by components); ties
in score go to the smaller id; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import load, staged

BITS = 128
SUB = 8
FIT_ROWS = 10_000
RADIUS_SHARE = 0.97
BLOCK_ROWS = 16_384
QUERY_ROWS = 512


def usable(vectors: DataFrame, is_query: Column) -> DataFrame:
    """``vec_id, v`` (array of doubles), ``asked`` of the vectors that take part."""
    v = F.col("embedding").cast("array<double>")
    ok = F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    one = vectors.filter(ok & finite & some).select(
        F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), is_query.alias("asked"))
    return one.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asked").alias("asked"))


class Codes:
    """Learned codes: ``mean``, ``basis`` (columns are bits), largest norm and radius."""

    def __init__(self, sample: np.ndarray, top_norm: float, k: int, seed: int = 7):
        self.top_norm = top_norm
        x = self._lift(sample)
        self.mean = x.mean(axis=0)
        z = x - self.mean
        _, axes = np.linalg.eigh(z.T @ z)
        axes = axes[:, ::-1][:, :BITS]
        y, rng, bases, n = z @ axes, np.random.default_rng(seed), [], 0
        while n < BITS:
            turn = np.linalg.qr(rng.normal(size=(axes.shape[1],) * 2))[0]
            for _ in range(25):  # iterative quantisation
                u, _, vt = np.linalg.svd(np.sign(y @ turn).T @ y)
                turn = (u @ vt).T
            bases.append(axes @ turn)
            n += turn.shape[1]
        self.basis = np.concatenate(bases, axis=1)[:, :BITS]
        self.radius = self._learn_radius(sample, k)

    def _lift(self, x: np.ndarray) -> np.ndarray:
        x = x / self.top_norm
        return np.concatenate([x, np.sqrt(np.maximum(1 - (x * x).sum(axis=1, keepdims=True), 0))], axis=1)

    def _bits(self, lifted: np.ndarray) -> np.ndarray:
        on = (lifted - self.mean) @ self.basis > 0
        return np.packbits(on, axis=1, bitorder="little")

    def of_candidates(self, x: np.ndarray) -> np.ndarray:
        return self._bits(self._lift(x))

    def of_queries(self, q: np.ndarray) -> np.ndarray:
        q = q / np.linalg.norm(q, axis=1, keepdims=True)
        return self._bits(np.concatenate([q, np.zeros((len(q), 1))], axis=1))

    def _learn_radius(self, sample: np.ndarray, k: int) -> int:
        probe = sample[: min(len(sample), 400)]
        near = min(k, len(sample) - 1)
        if near < 1:
            return BITS
        score = probe @ sample.T
        score[np.arange(len(probe)), np.arange(len(probe))] = -np.inf
        top = np.argpartition(-score, near - 1, axis=1)[:, :near]
        far = np.bitwise_count(self.of_queries(probe)[:, None, :] ^ self.of_candidates(sample)[top]).sum(axis=2)
        return min(BITS, int(np.ceil(np.quantile(far, RADIUS_SHARE))))


class SubstringIndex:
    """Rows of a block by the value of each substring of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.words = codes.view("<u8")
        self.rows = [np.argsort(codes[:, j], kind="stable").astype(np.int32) for j in range(codes.shape[1])]
        self.starts = [np.searchsorted(codes[rows, j], np.arange((1 << SUB) + 1)).astype(np.int32)
                       for j, rows in enumerate(self.rows)]
        self.near = np.argsort(np.bitwise_count(np.arange(1 << SUB, dtype=np.uint8)), kind="stable").astype(np.uint8)

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows within ``radius`` bits of ``code``."""
        m = self.codes.shape[1]
        found = np.zeros(len(self.codes), dtype=bool)
        for j in range(m):
            bits = min(SUB, radius // m) - (j > radius % m)
            values = self.near[: sum(math.comb(SUB, i) for i in range(bits + 1))] ^ code[j]
            first = self.starts[j][values]
            count = self.starts[j][values.astype(np.int32) + 1] - first
            at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
            found[self.rows[j][at]] = True
        rows = np.flatnonzero(found)
        near = np.bitwise_count(self.words[rows] ^ code.view("<u8")).sum(axis=1)
        return rows[near <= radius]


_FOUND = "query_id long, vec_id long, score double"
_RESULT = "query_id long, rank int, vec_id long, score double"


def _search_block(codes: Codes, k: int, radius: int):
    def search(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(queries) and len(block):
            x, ids = np.stack(block["v"].to_numpy()), block["vec_id"].to_numpy()
            q, qids = np.stack(queries["qv"].to_numpy()), queries["qid"].to_numpy()
            index = SubstringIndex(codes.of_candidates(x))
            for vec, qid, code in zip(q, qids, codes.of_queries(q)):
                rows = index.within(code, radius)
                rows = rows[ids[rows] != qid]
                if len(rows) > k:
                    rough = x[rows] @ vec
                    rows = rows[rough >= np.partition(rough, -k)[-k] - 1e-9 * codes.top_norm ** 2]
                score = (x[rows] * vec).sum(axis=1)  # the same sum wherever a row stands, so ties are ties
                best = np.lexsort((ids[rows], -score))[:k]
                out["query_id"].append(np.full(len(best), qid))
                out["vec_id"].append(ids[rows][best])
                out["score"].append(score[best])
        return pd.DataFrame({c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"})
    return search


def _search(queries: DataFrame, vectors: DataFrame, codes: Codes, k: int, radius: int,
            n_queries: int, n_vectors: int) -> DataFrame:
    """Nearest found of every query, merged over the blocks."""
    qb, vb = -(-n_queries // QUERY_ROWS), -(-n_vectors // BLOCK_ROWS)
    q = (queries.withColumn("qb", F.pmod(F.xxhash64("qid"), F.lit(qb)))
         .withColumn("vb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(vb - 1).cast("long")))))
    v = (vectors.withColumn("vb", F.pmod(F.xxhash64("vec_id"), F.lit(vb)))
         .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(qb - 1).cast("long")))))
    found = (q.groupBy("qb", "vb").cogroup(v.groupBy("qb", "vb"))
             .applyInPandas(_search_block(codes, k, radius), _FOUND))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` nearest found of every
    query, a row for which ``is_query`` holds; its own id is no candidate."""
    spark = vectors.sparkSession
    every = staged(usable(vectors, is_query).withColumn("dim", F.size("v")), "ann-vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    kinds = every.groupBy("dim").agg(F.count("*").alias("n"), F.max(norm).alias("top"),
                                     F.sum(F.col("asked").cast("long")).alias("asked")).collect()
    if not kinds:
        return spark.createDataFrame([], _RESULT)
    most = max(kinds, key=lambda r: (r["n"], -r["dim"]))
    every = every.filter(F.col("dim") == most["dim"])
    sample = np.array([r["v"] for r in every.orderBy(F.xxhash64("vec_id"), "vec_id").limit(FIT_ROWS).select("v").collect()])
    codes = Codes(sample, most["top"] * (1 + 1e-12), k)
    asked = every.filter("asked").select(F.col("vec_id").alias("qid"), F.col("v").alias("qv"))
    if not most["asked"]:
        return spark.createDataFrame([], _RESULT)
    every = every.select("vec_id", "v")
    found = staged(_search(asked, every, codes, k, codes.radius, most["asked"], most["n"]), "ann-found")
    full = found.filter(F.col("rank") == min(k, most["n"] - 1)).select("query_id")
    n_rest = most["asked"] - full.count()
    if n_rest:  # searched again with every bit allowed
        rest = asked.join(full, F.col("qid") == F.col("query_id"), "left_anti")
        again = _search(rest, every, codes, k, BITS, n_rest, most["n"])
        found = found.join(full, "query_id", "left_semi").unionByName(again)
    return found.select("query_id", "rank", "vec_id", "score")


def op3_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
