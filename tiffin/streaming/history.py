"""Type-2 history kept by a stream of changes that may come late.

The changes of every batch are kept, in folders by bucket of their key. A batch rebuilds the versions of the keys it has changes for, from all their changes
so far, and writes them as that key's newest state: a late change opens a closed version again and splits it. Keys without a change in the batch
are not touched, and only the buckets that have touched keys are read. The rebuild is ``scd2``, which spreads a key with many changes over tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tiffin.operators.cdc import scd2
from tiffin.operators.windows import join_beside
from tiffin.session import durable
from tiffin.streaming import folders
from tiffin.streaming.streams import finish


def newest_versions(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of each key the rows that the last batch with changes of it wrote."""
    last = rows.groupBy(*keys).agg(F.max("batch_id").alias("_last"))
    return join_beside(rows, last, keys).where(F.col("batch_id") == F.col("_last")).drop("_last")


def semi_join(rows: DataFrame, some: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in ``some``; NULL is a key, too."""
    return rows.join(some.select(*[F.col(k).alias(f"__{k}") for k in keys]), [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], "left_semi")


def keep_versions(
    changes: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    seq: str,
    track: Sequence[str],
    delete_when: Column,
    exclude: Sequence[str] = (),
    start: str = "__START_AT",
    end: str = "__END_AT",
    buckets: int = 32,
    settle_every: int | None = 10,
) -> StreamingQuery:
    """Keep the versions of ``scd2`` over a stream of changes in any order, until the present input is used up.

    ``versions`` reads the result. A batch that runs again overwrites what it wrote. Every ``settle_every`` batches the folders become one.
    """
    log, states = f"{path}/changes", f"{path}/versions"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
        rows = durable(batch.withColumn("_bucket", bucket), "changes")
        if rows.isEmpty():
            return
        touched = rows.select(*keys).distinct()
        rows.write.mode("overwrite").partitionBy("_bucket").parquet(folders.batch_folder(log, batch_id))
        earlier = folders.written(spark, log, before=batch_id)
        if earlier is not None:
            some = [r._bucket for r in rows.select("_bucket").distinct().collect()]  # no more than there are buckets
            rows = semi_join(earlier.where(F.col("_bucket").isin(some)), touched, keys).select(*rows.columns).unionByName(rows)
        rebuilt = scd2(rows.drop("_bucket"), keys, seq, track, delete_when, exclude, start, end)
        # A key whose changes make no version is written too, so that its earlier versions go.
        join_beside(touched, rebuilt, keys, "left").write.mode("overwrite").parquet(folders.batch_folder(states, batch_id))
        folders.settle_now_and_then(spark, log, batch_id, settle_every, lambda r: r.repartition(buckets, "_bucket", F.xxhash64(*keys, seq) % 4), ["_bucket"])
        folders.settle_now_and_then(spark, states, batch_id, settle_every, lambda r: newest_versions(r, keys))

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return finish(writer.trigger(availableNow=True).start())


def versions(spark: SparkSession, path: str, keys: Sequence[str], start: str = "__START_AT") -> DataFrame | None:
    """The history that ``keep_versions`` has written so far; None before its first change."""
    rows = folders.written(spark, f"{path}/versions")
    return None if rows is None else newest_versions(rows, keys).where(F.col(start).isNotNull()).drop("batch_id")
