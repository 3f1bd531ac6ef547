"""Writing files and tables: layout, size, modes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F


ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
PARALLEL = "spark.sql.adaptive.coalescePartitions.parallelismFirst"
LEAST = "spark.sql.adaptive.coalescePartitions.minPartitionSize"


def write_sized(df: DataFrame, path: str, size: int = 128 << 20, file_format: str = "parquet") -> list[int]:
    """Write files of about ``size`` bytes and give back their sizes.

    The rows are dealt out anew and adaptive execution forms the parts from the bytes that it sees in the shuffle, so nothing is counted or guessed
    beforehand. Columnar files are smaller than the shuffled rows; ``size`` is what a file stays below, give or take a part's rounding.
    """
    spark = df.sparkSession
    wanted = {ADVISORY: str(size), PARALLEL: "false", LEAST: str(min(size, 1 << 20))}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.hint("rebalance").write.format(file_format).save(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    return written_sizes(spark, path)


def written_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of each data file of a folder, from its listing."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)
    return [f.getLen() for f in found if not f.getPath().getName().startswith(("_", "."))]


def spread_for_write(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition value together in few tasks, a very large value split over several.

    ``repartition(column)`` would put a hot value in one task; the rebalance hint lets the adaptive plan split it.
    """
    return df.hint("rebalance", *partition_by)


def write_table(
    df: DataFrame,
    path: str,
    file_format: str = "parquet",
    mode: str = "errorifexists",
    compression: str | None = None,
    partition_by: Sequence[str] = (),
    files: int | None = None,
    max_records: int | None = None,
    **options: str,
) -> str:
    """Write a folder. ``files`` sets the number of tasks that write, ``max_records`` the rows per file.

    With both, ``max_records`` decides how many files a large table gives, and ``files`` is the least number of tasks: every core writes its share, one file
    after the other, instead of a few tasks writing all of them.
    """
    rows = df
    if partition_by:
        rows = spread_for_write(rows, partition_by)
    elif files:
        rows = rows.repartition(max(files, df.sparkSession.sparkContext.defaultParallelism) if max_records else files)
    writer = rows.write.format(file_format).mode(mode).options(**options)
    if file_format == "csv" and "header" not in options:
        writer = writer.option("header", "true")
    if compression:
        writer = writer.option("compression", compression)
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str], file_format: str = "parquet") -> str:
    """Replace only the partitions that occur in ``df``."""
    spread_for_write(df, partition_by).write.format(file_format).mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy(*partition_by).save(path)
    return path


def overwrite_directory(spark: SparkSession, view: str, path: str, file_format: str = "parquet") -> str:
    """SQL form: ``INSERT OVERWRITE DIRECTORY``."""
    spark.sql(f"INSERT OVERWRITE DIRECTORY '{path}' USING {file_format} SELECT * FROM {view}")
    return path


def save_table(
    df: DataFrame, name: str, path: str | None = None, file_format: str = "parquet", mode: str = "overwrite",
    partition_by: Sequence[str] = (),
) -> str:
    """Managed table, or an external one when a path is given."""
    rows = spread_for_write(df, partition_by) if partition_by else df
    writer = rows.write.format(file_format).mode(mode)
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return name


def save_bucketed(df: DataFrame, name: str, path: str, buckets: int, keys: Sequence[str], mode: str = "overwrite") -> str:
    """Bucketed and sorted table. Two tables with the same buckets join on the keys without a shuffle.

    Rows of a key come together first, so that a task writes few buckets; a key that holds a large share of the rows is split over several tasks
    and files of its bucket. Its join is still one bucket's: use ``salted_join`` there.
    """
    df.hint("rebalance", buckets, *[F.col(k) for k in keys]).write.mode(mode).option("path", path).bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return name


def analyze(spark: SparkSession, table: str, columns: Sequence[str] = ()) -> None:
    """Table statistics, and column statistics for the cost-based join order."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
    if columns:
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")
