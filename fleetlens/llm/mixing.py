"""Mixing sources to target weights by Sainte-Lague apportionment.

Sources, in code-point order with null last, have the weights 5, 2, 1,
repeating, and share 150% of all words; a target stops at twice its source's
words and the excess is shared again by weight (water filling, solved in one
pass over the sources sorted by the level at which they fill up).

The mix is dealt as equal blocks of ``BLOCK_WORDS`` words. The highest
quotients ``target / (2 k + 1)`` win the blocks, and every shard of
``SHARD_BLOCKS`` consecutive wins gets its integer quota per source. Seats are
counted in closed form near each shard boundary and only the few quotients
around the boundary are ranked, so no row per block is ever made.

Blocks are then selected by seed: a source's documents form a ring in the
order of a seeded hash, and its blocks are taken one after another from a
seeded start, going round again if the target is larger than the source. So
documents are taken whole but for the two at the ends of the run. A position
on the ring is a running sum; it is taken within (source, hash bucket) and the
buckets' sums are added, so a source with a third of all rows is split over
the hash buckets.

Only DataFrame expressions are used. Defined results: a null or empty text has
size 0, takes 0 words; a source without words has target 0; null is a source
of its own; an empty table gives no rows; repeated rows are separate documents;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import WORD, load, numbered, staged

BLOCK_WORDS = 16
SHARD_BLOCKS = 1 << 18
SEED = "mix-1"
#: Weights by rank of the source, repeating; the share of all words; the cap.
WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2


def sized(docs: DataFrame) -> DataFrame:
    """One narrow row per document: source, words and its seeded place."""
    key = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("src"),
        F.col("source").isNull().alias("no_src"),
        F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        key.alias("key"), (F.col("__row") if "__row" in docs.columns else F.lit(None).cast("long")).alias("row"))


def source_targets(rows: DataFrame) -> DataFrame:
    """One row per source: words, rank, weight and target."""
    per = rows.groupBy("src", "no_src").agg(F.sum("size").alias("source_size"))
    # one row per source from here on, so a window over all of them is small
    per = per.withColumn("rank", F.row_number().over(Window.orderBy("no_src", "src")))
    weights = F.array(*map(F.lit, WEIGHTS))
    per = per.withColumn("weight", F.element_at(weights, ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int")))
    per = per.withColumn("level", CAP * F.col("source_size") / F.col("weight"))
    by = Window.orderBy("level", "rank")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    per = (per.withColumn("total", F.sum("source_size").over(everything))
           .withColumn("full", F.coalesce(F.sum(CAP * F.col("source_size")).over(before), F.lit(0)))
           .withColumn("lam", (SHARE * F.col("total") - F.col("full")) / F.sum("weight").over(after))
           .withColumn("at", F.row_number().over(by)))
    free = F.when(F.col("level") > F.col("lam"), F.struct("at", "lam"))
    per = per.withColumn("lam", F.min(free).over(everything)["lam"])
    target = F.least((CAP * F.col("source_size")).cast("double"),
                     F.coalesce(F.col("weight") * F.col("lam"), F.lit(float("inf"))))
    return per.select("src", "no_src", "rank", "source_size", target.alias("target"))


def shard_quotas(targets: DataFrame) -> DataFrame:
    """Blocks of every source in every shard: ``src, no_src, shard, quota``.

    Up to time ``tau`` a source with target ``t`` wins ``floor((tau t + 1)/2)``
    blocks. Starting half a block per source before a boundary, all counts
    together miss it by at most one block per source; the missing ones go to
    the highest next quotients.
    """
    everything = Window.partitionBy()
    t = (targets.withColumn("all", F.sum("target").over(everything))
         .withColumn("n_src", F.count("*").over(everything))
         .withColumn("blocks", F.floor(F.col("all") / BLOCK_WORDS)))
    last = F.greatest(F.ceil(F.col("blocks") / SHARD_BLOCKS), F.lit(1))
    t = t.withColumn("shard", F.explode(F.sequence(F.lit(1).cast("long"), last)))
    house = F.least(F.col("shard") * SHARD_BLOCKS, F.col("blocks"))
    tau = F.when(F.col("all") > 0, F.greatest(2 * (house - F.col("n_src") / 2) / F.col("all"), F.lit(0.0))).otherwise(0.0)
    of_shard = Window.partitionBy("shard")
    t = (t.withColumn("house", house)
         .withColumn("won", F.floor((tau * F.col("target") + 1) / 2))
         .withColumn("won", F.when(F.col("target") > 0, F.col("won")).otherwise(F.lit(0).cast("long")))
         .withColumn("missing", F.col("house") - F.sum("won").over(of_shard)))
    more = F.when(F.col("target") > 0, F.ceil((F.col("missing") + F.col("n_src")) * F.col("target") / F.col("all")) + 1).otherwise(0)
    nxt = t.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), more.cast("long"))))
    quotient = F.col("target") / (2 * (F.col("won") + F.col("k")) + 1)
    order = Window.partitionBy("shard").orderBy(quotient.desc(), "rank", "k")
    nxt = nxt.withColumn("place", F.row_number().over(order))
    cum = nxt.groupBy("src", "no_src", "shard").agg(
        F.first("won").alias("won"),
        F.sum((F.col("place") <= F.col("missing")).cast("long")).alias("extra"),
        F.first("source_size").alias("source_size"))
    # a source at its cap gives a block back that would take it past twice its words
    cum = cum.withColumn("cum", F.least(F.col("won") + F.col("extra"),
                                        F.floor(CAP * F.col("source_size") / BLOCK_WORDS)))
    prev = F.lag("cum", 1, 0).over(Window.partitionBy("src", "no_src").orderBy("shard"))
    return cum.select("src", "no_src", "shard", (F.col("cum") - prev).alias("quota"))


def ring_positions(rows: DataFrame) -> DataFrame:
    """``pos``: words of the source before the document in the seeded order."""
    rows = rows.withColumn("bucket", F.substring("key", 1, 3))
    part = rows.groupBy("src", "no_src", "bucket").agg(F.sum("size").alias("words"))
    by = Window.partitionBy("src", "no_src").orderBy("bucket")
    start = part.select("src", "no_src", "bucket", (F.sum("words").over(by) - F.col("words")).alias("start"))
    inside = Window.partitionBy("src", "no_src", "bucket").orderBy("key", "doc_id", "size", "row")
    placed = rows.withColumn("inside", F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size"))
    return (placed.join(start, ["src", "no_src", "bucket"])
            .withColumn("pos", F.col("start") + F.col("inside")))


def _offset():
    """Seeded start of a source's run on its ring of words."""
    text = F.concat(F.lit(SEED + ":"), F.col("src"), F.col("no_src").cast("string"))
    number = F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")
    return F.when(F.col("source_size") > 0, F.pmod(number, F.col("source_size"))).otherwise(0).cast("long")


def _whole_run():
    """Words a source gives: its blocks, and of its last block the part that its target
    reaches into, never more than twice its words."""
    blocks = F.col("blocks") * BLOCK_WORDS
    near = F.floor(F.col("target") + 0.5)
    part = F.least(F.greatest(near - blocks, F.lit(-BLOCK_WORDS)), F.lit(BLOCK_WORDS))
    return F.least(F.greatest(blocks + part, F.lit(0)), CAP * F.col("source_size")).cast("long")


def mix(docs: DataFrame) -> DataFrame:
    """One row per document with the words the mix takes of it."""
    rows = staged(sized(docs), "mix-sizes")
    targets = staged(source_targets(rows), "mix-targets")
    won = shard_quotas(targets).groupBy("src", "no_src").agg(F.sum("quota").alias("blocks"))
    plan = (targets.join(won, ["src", "no_src"])
            .withColumn("run", _whole_run())
            .withColumn("offset", _offset())
            .withColumn("rounds", F.when(F.col("source_size") > 0, F.floor(F.col("run") / F.col("source_size"))).otherwise(0).cast("long"))
            .withColumn("rest", F.col("run") - F.col("rounds") * F.col("source_size")))
    d = ring_positions(rows).join(plan, ["src", "no_src"])
    lo, hi = F.col("pos"), F.col("pos") + F.col("size")
    end = F.col("offset") + F.col("rest")

    def overlap(a, b):
        return F.greatest(F.least(hi, b) - F.greatest(lo, a), F.lit(0))
    arc = (overlap(F.col("offset"), F.least(end, F.col("source_size")))
           + overlap(F.lit(0), F.greatest(end - F.col("source_size"), F.lit(0))))
    inside = (((lo >= F.col("offset")) & (lo < end)) | (lo < end - F.col("source_size"))).cast("long")
    return d.select("doc_id", "size", "source_size", "target",
                    (F.col("rounds") * F.col("size") + arc).cast("long").alias("taken"),
                    "key", "src", "no_src", "row",
                    (F.col("rounds") + inside).alias("times"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix: each document as often as its first word is taken
    (0, 1 or 2 times), whole, with all its columns. Rows are told apart by their
    number in a copy that is written once, not by their ids."""
    rows = numbered(docs)
    times = mix(rows).filter("times > 0").select(F.col("row").alias("__row"), F.col("times").cast("int").alias("__times"))
    copies = rows.join(times, "__row").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__times"))))
    return copies.select(*docs.columns)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(load(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


#: The words a source gives lie within half a word of its target: the block quotas miss a
#: target by less than a block, and the last block is taken in part.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('SEED:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM documents),
p AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY encode(source) NULLS LAST) AS rank
  FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(rank - 1) % 3 + 1] AS weight FROM p),
l AS (SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS level FROM w),
f AS (
  SELECT *, row_number() OVER o AS nth, (1.5 * sum(source_size) OVER ()
              - coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lam
  FROM l WINDOW o AS (ORDER BY level, rank)),
t AS (
  SELECT *, least(CAST(2 * source_size AS DOUBLE),
                  coalesce(weight * (SELECT arg_min(lam, nth) FROM f WHERE level > lam), CAST('inf' AS DOUBLE))) AS target FROM f),
r AS (
  SELECT source, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS run,
         CASE WHEN source_size > 0 THEN CAST('0x' || left(md5('SEED:' || coalesce(source, '') || CAST(source IS NULL AS VARCHAR)), 12) AS BIGINT)
              % source_size ELSE 0 END AS start FROM t),
q AS (
  SELECT d.doc_id, d.size, r.*, CASE WHEN source_size > 0 THEN run // source_size ELSE 0 END AS rounds,
         CASE WHEN source_size > 0 THEN start + run % source_size ELSE 0 END AS stop,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, d.size ROWS UNBOUNDED PRECEDING) - d.size AS pos
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(rounds * size + greatest(least(pos + size, stop, source_size) - greatest(pos, start), 0)
            + greatest(least(pos + size, greatest(stop - source_size, 0)) - pos, 0) AS BIGINT) AS taken
FROM q
""".replace("SEED", SEED)
