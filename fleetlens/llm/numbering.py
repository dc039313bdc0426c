"""Places of rows within their groups, by one range sort."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from fleetlens.llm.common import shuffle_partitions, staged


def _ranks(group: str):
    def run(batches):
        from pyspark import TaskContext

        part, last, held = TaskContext.get().partitionId(), None, 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            key = b.column(group)
            new = np.ones(n, bool)
            new[1:] = pc.not_equal(key.slice(1), key.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[0] = key[0].as_py() != last
            at = np.arange(n)
            start = np.maximum.accumulate(np.where(new, at, -1))
            rank = np.where(start < 0, held + at, at - start)
            last, held = key[n - 1].as_py(), int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, part)), pa.array(rank)], [*b.schema.names, "__part", "__rank"])
    return run


def positions(df: DataFrame, group: str, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``pos``, the place of each row (from 0) within ``group`` by ``order``.

    Rows are range-partitioned by group and order, so a group of any size is dealt
    over many tasks; rows equal in all of them are dealt by their place in the scan.
    A task numbers its rows from 0; only the first group of a partition can have
    begun before it, so the corrections are at most one row per partition.
    ``group`` must not be null.
    """
    n = partitions or shuffle_partitions(df.sparkSession)
    tie = df.withColumn("__tie", F.monotonically_increasing_id())
    by = [F.col(group).asc(), *order, F.col("__tie")]
    run = tie.repartitionByRange(n, *by).sortWithinPartitions(*by).drop("__tie")
    schema = StructType(list(run.schema.fields)).add("__part", LongType()).add("__rank", LongType())
    ranked = staged(run.mapInArrow(_ranks(group), schema), name)
    seen = ranked.groupBy(group, "__part").agg(F.count("*").alias("rows"))
    before = (F.sum("rows").over(Window.partitionBy(group).orderBy("__part")) - F.col("rows"))
    shift = seen.withColumn("__before", before).filter("__before > 0").select(group, "__part", "__before")
    return (ranked.join(F.broadcast(shift), [group, "__part"], "left")
            .withColumn("pos", F.col("__rank") + F.coalesce("__before", F.lit(0)))
            .drop("__part", "__rank", "__before"))
