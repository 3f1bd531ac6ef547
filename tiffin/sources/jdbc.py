"""Relational tables over JDBC: split reads, batched writes, staged refresh."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession


def as_table(table_or_query: str) -> str:
    """A query becomes a derived table."""
    text = table_or_query.strip()
    return f"({text}) q" if text.lower().startswith(("select ", "with ")) else text


def read_jdbc(
    spark: SparkSession,
    url: str,
    table_or_query: str,
    properties: dict[str, str] | None = None,
    column: str | None = None,
    bounds: tuple[int, int] | None = None,
    parts: int | None = None,
    partition_predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Table or query, whole, split by ranges of a numeric column, or one partition per predicate.

    Bounds that are not given come from one MIN/MAX query. The predicates must cover the rows wanted without overlap:
    they are partitions, a row that meets two of them comes twice.
    """
    table, properties = as_table(table_or_query), properties or {}
    if partition_predicates:
        return spark.read.jdbc(url, table, predicates=list(partition_predicates), properties=properties)
    if column is None:
        return spark.read.jdbc(url, table, properties=properties)
    if bounds is None:
        limits = spark.read.jdbc(
            url, f"(SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}) b", properties=properties
        ).first()
        bounds = (int(limits[0] or 0), int(limits[1] or 0))
    return spark.read.jdbc(
        url, table, column=column, lowerBound=bounds[0], upperBound=bounds[1] + 1,
        numPartitions=parts or spark.sparkContext.defaultParallelism, properties=properties,
    )


def write_jdbc(
    df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 10_000, parts: int | None = None,
    properties: dict[str, str] | None = None, truncate: bool = False,
) -> None:
    """Batched inserts. ``parts`` limits the connections; ``truncate`` keeps the table definition on overwrite."""
    rows = df.coalesce(parts) if parts else df
    settings = {"batchsize": str(batch), **({"truncate": "true"} if truncate else {}), **(properties or {})}
    rows.write.jdbc(url, table, mode=mode, properties=settings)


def schema_diff(df: DataFrame, existing: Sequence[str]) -> tuple[list[str], list[str]]:
    """Columns of ``df`` the target lacks, and target columns ``df`` lacks; names compare without case."""
    have = {c.lower() for c in existing}
    mine = {c.lower() for c in df.columns}
    return [c for c in df.columns if c.lower() not in have], [c for c in existing if c.lower() not in mine]


def write_checked(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, **options) -> list[str]:
    """Append columns both sides know; returns the columns the target does not have yet."""
    existing = df.sparkSession.read.jdbc(url, f"(SELECT * FROM {table} WHERE 1 = 0) e", properties=properties or {}).columns
    new, _ = schema_diff(df, existing)
    write_jdbc(df.drop(*new), url, table, properties=properties, **options)
    return new


def staged_refresh(
    df: DataFrame,
    url: str,
    table: str,
    run_sql: Callable[[Sequence[str]], None],
    properties: dict[str, str] | None = None,
    parts: int | None = None,
) -> int:
    """Load a staging table, compare its row count, then let ``run_sql`` swap the names in one transaction.

    ``run_sql`` gets the statements; how a client runs them in a transaction belongs to the database at hand.
    """
    staging, old = f"{table}_staging", f"{table}_old"
    write_jdbc(df, url, staging, mode="overwrite", parts=parts, properties=properties)
    expected = df.count()
    loaded = df.sparkSession.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {staging}) c", properties=properties or {}).first()[0]
    if loaded != expected:
        raise ValueError(f"{loaded} rows in {staging}, expected {expected}")
    run_sql([
        f"DROP TABLE IF EXISTS {old}",
        f"ALTER TABLE IF EXISTS {table} RENAME TO {old}",
        f"ALTER TABLE {staging} RENAME TO {table}",
        f"DROP TABLE IF EXISTS {old}",
    ])
    return expected
