"""Structured Streaming jobs over files: joins, windows, sinks, current state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tiffin.operators.joins import interval_join
from tiffin.operators.windows import join_beside
from tiffin.streaming import folders


def stream_interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: tuple[str, str],
    times: tuple[str, str],
    seconds: int,
    delay: str = "10 minutes",
    how: str = "inner",
    parts: int = 1,
) -> DataFrame:
    """``interval_join`` of two streams.

    Watermarks on both sides and the time bound let Spark drop old state; the time buckets spread the state of a hot key, ``parts`` times as fine as the interval.
    With ``how="left"`` a row without match comes out once the watermark has passed its interval.
    """
    return interval_join(left.withWatermark(times[0], delay), right.withWatermark(times[1], delay), keys, times, seconds, how, parts)


def windowed(
    df: DataFrame, time: str, length: str, measures: dict[str, Column], keys: Sequence[str] = (), slide: str | None = None
) -> DataFrame:
    """Measures per tumbling or sliding event-time window and key. The same on a batch and on a watermarked stream."""
    span = F.window(time, length, slide) if slide else F.window(time, length)
    return (
        df.groupBy(*keys, span.alias("_window"))
        .agg(*[c.alias(n) for n, c in measures.items()])
        .select(*keys, F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *measures)
    )


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for an ``availableNow`` run and raise what it raised."""
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
    return query


PARTS_PER_CORE, MOST_PARTS = 4, 96
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"


def state_parts(spark: SparkSession) -> int:
    """Parts of a stream's state: the shuffle partitions, at most four per core and ``MOST_PARTS``.

    A task of a stateful step reports a figure for every part and store of the state, so what the driver gets grows with the square of the parts,
    and each part is a store with files of its own. State lies on disk and rows pass through it one by one: more data needs larger parts, not more.
    """
    return min(int(spark.conf.get(SHUFFLE_PARTITIONS)), PARTS_PER_CORE * spark.sparkContext.defaultParallelism, MOST_PARTS)


def run_available(writer: DataStreamWriter, spark: SparkSession) -> StreamingQuery:
    """Run until the present input is used up, with ``state_parts``. A checkpoint keeps the number it was begun with."""
    before = spark.conf.get(SHUFFLE_PARTITIONS)
    spark.conf.set(SHUFFLE_PARTITIONS, str(state_parts(spark)))
    try:
        query = writer.trigger(availableNow=True).start()  # works on a copy of the session's settings
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)
    return finish(query)


def append_files(df: DataFrame, path: str, checkpoint: str, file_format: str = "parquet") -> StreamingQuery:
    """Append a stream to a folder until the present input is used up. A second run with the same checkpoint goes on."""
    writer = df.writeStream.format(file_format).option("path", path).option("checkpointLocation", checkpoint)
    return run_available(writer.outputMode("append"), df.sparkSession)


def update_files(df: DataFrame, path: str, checkpoint: str, keys: Sequence[str] = (), settle_every: int | None = None) -> StreamingQuery:
    """Write the changed groups of a running aggregate, one folder per batch.

    A repeated batch overwrites its own folder, so a restart adds nothing twice. With ``settle_every`` the folders become one of the newest row per group
    (``keys``) after so many batches, inside the stream. ``latest_groups`` reads the result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(folders.batch_folder(path, batch_id))
        folders.settle_now_and_then(batch.sparkSession, path, batch_id, settle_every, lambda rows: newest_groups(rows, keys))

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_available(writer.outputMode("update"), df.sparkSession)


def newest_groups(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row of each group from the last batch that changed it: a batch has one row per group."""
    last = rows.groupBy(*keys).agg(F.max("batch_id").alias("_last"))
    return join_beside(rows, last, keys).where(F.col("batch_id") == F.col("_last")).drop("_last")


def latest_groups(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The newest row of each group from ``update_files``."""
    return newest_groups(folders.written(spark, path), keys).drop("batch_id")


def newest_change(rows: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """The winning change per key: highest ``seq``, then a delete, then the greater values in the order of their columns."""
    rest = [c for c in rows.columns if c not in keys]
    order = F.struct(seq, "_gone", *[c for c in rest if c != "_gone"])
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return newest.select(*keys, "_row.*")


def merge_state(
    changes: DataFrame, path: str, checkpoint: str, keys: Sequence[str], seq: str, delete_when: Column, settle_every: int | None = 10
) -> StreamingQuery:
    """Current state per key from a stream of changes in any order.

    Every batch writes only its own winning change per key, as one folder that a repeated batch overwrites; the reader
    settles the folders, and so does the stream itself after every ``settle_every`` batches. Deletes stay as tombstones, so that a late older change
    does not revive a key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_gone", F.coalesce(delete_when, F.lit(False)))
        newest_change(rows, keys, seq).write.mode("overwrite").parquet(folders.batch_folder(path, batch_id))
        fold = lambda r: newest_change(r.drop("batch_id"), keys, seq).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        folders.settle_now_and_then(batch.sparkSession, path, batch_id, settle_every, fold)

    writer = changes.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return finish(writer.trigger(availableNow=True).start())


def current_state(spark: SparkSession, path: str, keys: Sequence[str], seq: str) -> DataFrame:
    """Living keys over all batches."""
    rows = newest_change(folders.written(spark, path).drop("batch_id"), keys, seq)
    return rows.filter(~F.col("_gone")).drop("_gone")
