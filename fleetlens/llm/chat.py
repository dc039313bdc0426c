"""Chat formatting by multi-party perspective rotation.

A dialogue is rendered once for every participant: that speaker's turns become
the assistant's, the other speakers are users named by their role, system turns
stay system turns. The mask lists the stretches to learn from, the assistant's
contents with their end marker, as code points ``start:end`` (end exclusive).

A rendering is written in parts of ``WINDOW`` turns, cut by position in the
dialogue, so no row is larger than that. A participant is a speaker of the whole
dialogue and gets every part, also those it is silent in. The parts of a
perspective, ordered by ``block`` (null last), then ``part``, join to the whole
rendering; the mask counts from the start of its part. Parts are numbered by
``block``; a part of unnumbered turns alone (they come last) has a null block
and is numbered by ``part``.

A position is a rank within (dialogue, stretch of turn numbers) plus the counts
of the stretches before, so a long dialogue is not ranked in one task.

Only DataFrame expressions are used. Defined results: turns are ordered by
number (null last), then role, then text; a null role speaks as "unknown"; a
null text is empty; repeated rows are separate turns; the two characters
``<|`` in names and texts are written ``< |`` so that a text cannot close its
own turn; a dialogue of system turns alone has no participant and gives no row;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetlens.llm.common import load

WINDOW = 64
SYSTEM = "system"
START, END = "<|im_start|>", "<|im_end|>"


def _plain(c):
    return F.replace(c, F.lit("<|"), F.lit("< |"))


def windows(turns: DataFrame, size: int = WINDOW) -> DataFrame:
    """One row per part of a dialogue: ``conv_id, block, part, turns`` in order,
    and ``speakers``, the participants of the whole dialogue."""
    t = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _plain(F.coalesce(F.col("role").cast("string"), F.lit("unknown"))).alias("speaker"),
        _plain(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    # keys without nulls: the rank and the join below need one exchange of the texts
    t = t.select(F.coalesce("conv_id", F.lit(0)).alias("conv"), F.col("conv_id").isNull().alias("no_conv"),
                 F.coalesce(F.floor(F.col("turn") / size), F.lit(0)).alias("stretch"),
                 F.col("turn").isNull().alias("no_turn"), "turn", "speaker", "text")
    dialogue, stretch = ["conv", "no_conv"], ["conv", "no_conv", "stretch", "no_turn"]
    people = t.filter(F.col("speaker") != SYSTEM).groupBy(dialogue).agg(F.collect_set("speaker").alias("speakers"))
    counts = t.groupBy(stretch).agg(F.count("*").alias("rows"))
    by = Window.partitionBy(dialogue).orderBy("no_turn", "stretch")
    counts = counts.withColumn("before", F.sum("rows").over(by) - F.col("rows")).drop("rows").join(people, dialogue)
    order = Window.partitionBy(stretch).orderBy("turn", "speaker", "text")
    t = (t.withColumn("n", F.row_number().over(order)).join(counts, stretch)
         .withColumn("n", F.col("before") + F.col("n")).withColumn("nth", F.floor((F.col("n") - 1) / size)))
    one = t.groupBy(*dialogue, "nth").agg(
        F.count("turn").alias("numbered"), F.max(F.when(F.col("no_turn"), F.col("before"))).alias("earlier"),
        F.max(F.when((F.col("n") - 1) % size == 0, F.col("speakers"))).alias("speakers"),  # once per part
        F.sort_array(F.collect_list(F.struct("n", "speaker", "text"))).alias("turns"))
    last = F.col("numbered") == 0  # unnumbered turns alone: ``earlier`` counts the numbered ones
    return one.select(
        F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), F.when(~last, F.col("nth")).alias("block"),
        F.when(last, F.col("nth") - F.ceil(F.col("earlier") / size)).otherwise(F.lit(0)).cast("long").alias("part"),
        "turns", "speakers")


def rotate(turns: DataFrame, size: int = WINDOW) -> DataFrame:
    """``conv_id, block, part, perspective, n_turns, rendered, mask``: every part for every participant."""
    w = windows(turns, size).withColumn("perspective", F.explode("speakers"))

    def head(x):
        name = (F.when(x["speaker"] == SYSTEM, F.lit("system"))
                .when(x["speaker"] == F.col("perspective"), F.lit("assistant"))
                .otherwise(F.concat(F.lit("user name="), x["speaker"])))
        return F.concat(F.lit(START), name, F.lit("\n"))

    w = w.withColumn("segments", F.transform("turns", lambda x: F.struct(
        head(x).alias("head"), F.concat(x["text"], F.lit(END)).alias("body"),
        (x["speaker"] == F.col("perspective")).alias("mine"))))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("mask"))

    def step(acc, s):
        start = acc["at"] + F.length(s["head"])
        end = start + F.length(s["body"])
        span = F.array(F.concat(start.cast("string"), F.lit(":"), end.cast("string")))
        return F.struct((end + 1).alias("at"),
                        F.when(s["mine"], F.concat(acc["mask"], span)).otherwise(acc["mask"]).alias("mask"))
    mask = F.aggregate("segments", first, step)["mask"]
    text = F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "")
    return w.select("conv_id", "block", "part", "perspective", F.size("turns").cast("long").alias("n_turns"),
                    text.alias("rendered"), F.array_join(mask, ",").alias("mask"))


def op9_chat_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(load(spark, sf_dir, "conversations"))


#: Whole dialogues, cut by position: every participant of the dialogue gets every part.
ORACLE = f"""
WITH t AS (
  SELECT conv_id, turn, replace(coalesce(role, 'unknown'), '<|', '< |') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, speaker, body) AS rn,
         count(turn) OVER (PARTITION BY conv_id) AS earlier FROM t),
c AS (SELECT *, (rn - 1) // {WINDOW} AS nth FROM n),
w AS (
  SELECT *, CASE WHEN count(turn) OVER (PARTITION BY conv_id, nth) > 0 THEN nth END AS block,
         CASE WHEN count(turn) OVER (PARTITION BY conv_id, nth) > 0 THEN 0
              ELSE nth - CAST(ceil(earlier / {WINDOW}) AS BIGINT) END AS part FROM c),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{SYSTEM}'),
s AS (
  SELECT w.conv_id, w.block, w.part, perspective, rn, speaker = perspective AS mine,
         '{START}' || CASE WHEN speaker = '{SYSTEM}' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                           ELSE 'user name=' || speaker END || chr(10) AS head,
         body || '{END}' AS body
  FROM p JOIN w ON p.conv_id IS NOT DISTINCT FROM w.conv_id),
o AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 1) OVER (
              PARTITION BY conv_id, block, part, perspective ORDER BY rn
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS a FROM s)
SELECT conv_id, block, part, perspective, count(*) AS n_turns,
       string_agg(head || body || chr(10), '' ORDER BY rn) AS rendered,
       coalesce(string_agg(CASE WHEN mine THEN CAST(a AS VARCHAR) || ':' || CAST(a + length(body) AS VARCHAR) END,
                           ',' ORDER BY rn), '') AS mask
FROM o GROUP BY conv_id, block, part, perspective
"""
