"""Folders written by the batches of a stream, and settling them while the stream runs.

Each batch overwrites a folder of its own, so a batch that runs again adds nothing twice. Every few batches the folders are settled into one
generation; it counts from the moment its ``_SUCCESS`` file is there, which is the last thing its job writes. A run that is killed before that leaves the
folders as they were. What a generation replaces is deleted one generation later, so that readers in between keep their files.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

SETTLED = "_settled"  # hidden from readers of the folder above


def batch_folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def generation_folder(path: str, upto: int) -> str:
    return f"{path}/{SETTLED}/upto={upto}"


def numbered_folders(spark: SparkSession, path: str, name: str, finished: bool = False) -> list[int]:
    """Numbers of the folders ``name=<number>``, ascending; only those of finished jobs if wanted."""
    top = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(top):
        return []
    found = [s.getPath() for s in files.listStatus(top) if s.isDirectory()]
    if finished:
        found = [p for p in found if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in found if p.getName().startswith(f"{name}="))


def delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """All rows that count, with ``batch_id``: the newest generation and the batches after it; only batches before a given one if wanted.

    None if there is nothing yet.
    """
    newest = [g for g in numbered_folders(spark, f"{path}/{SETTLED}", "upto", finished=True) if before is None or g < before][-1:]
    batches = [b for b in numbered_folders(spark, path, "batch_id", finished=True) if b > (newest or [-1])[0] and (before is None or b < before)]
    parts = []
    if newest:
        parts.append(spark.read.parquet(generation_folder(path, newest[0])))
    if batches:
        parts.append(spark.read.option("basePath", path).parquet(*[batch_folder(path, b) for b in batches]).withColumn("batch_id", F.col("batch_id").cast("bigint")))
    if not parts:
        return None
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def settle(spark: SparkSession, path: str, upto: int, fold: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()) -> None:
    """Settle all batches up to one into a generation. ``fold`` takes and gives rows with ``batch_id``."""
    earlier = numbered_folders(spark, f"{path}/{SETTLED}", "upto", finished=True)
    if earlier and earlier[-1] >= upto:
        return
    rows = written(spark, path, before=upto + 1)
    if rows is None:
        return
    fold(rows).write.mode("overwrite").partitionBy(*partition_by).parquet(generation_folder(path, upto))
    for old in earlier[:-1]:
        delete(spark, generation_folder(path, old))
    for batch in numbered_folders(spark, path, "batch_id"):
        if earlier and batch <= earlier[-1]:
            delete(spark, batch_folder(path, batch))


def settle_now_and_then(spark: SparkSession, path: str, batch_id: int, every: int | None, fold: Callable[[DataFrame], DataFrame], partition_by: Sequence[str] = ()) -> None:
    """Settle after every so many batches; never without a number."""
    if every and (batch_id + 1) % every == 0:
        settle(spark, path, batch_id, fold, partition_by)
