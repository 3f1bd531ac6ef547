"""Reading files: batch, SQL, streams, hinted and rescued schemas, lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    file_format: str = "parquet",
    schema: str | T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """One path, a glob or a list of paths. Without ``schema`` row formats are read once more to infer it."""
    reader = spark.read.format(file_format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    elif file_format == "csv":
        reader = reader.options(**{"header": "true", "inferSchema": "true", **options})
    return reader.load(path if isinstance(path, str) else list(path))


def hinted_schema(inferred: T.StructType, hints: str | T.StructType) -> T.StructType:
    """Inferred schema with some columns pinned to a type; pinned columns the sample lacks are added."""
    pinned = T.StructType.fromDDL(hints) if isinstance(hints, str) else hints
    types = {f.name: f.dataType for f in pinned.fields}
    fields = [T.StructField(f.name, types.get(f.name, f.dataType)) for f in inferred.fields]
    known = {f.name for f in inferred.fields}
    return T.StructType(fields + [f for f in pinned.fields if f.name not in known])


def read_hinted(
    spark: SparkSession, path: str, hints: str, file_format: str = "json", sampling: float = 1.0, **options: str
) -> DataFrame:
    """Infer the schema, from a share of the rows if wanted, and pin the hinted columns."""
    sample = spark.read.format(file_format).options(samplingRatio=str(sampling), **options).load(path).schema
    return read_table(spark, path, file_format, hinted_schema(sample, hints), **options)


def rescue_columns(lines: DataFrame, schema: str | T.StructType, text: str = "value", out: str = "rescued") -> DataFrame:
    """Parse JSON text by a schema and keep unknown fields as a JSON map, broken lines as ``{"_corrupt": line}``."""
    target = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    known = [f.name for f in target.fields]
    fields = F.from_json(text, "MAP<STRING,STRING>")
    unknown = F.map_filter(fields, lambda name, _: ~name.isin(known))
    rescued = F.when(fields.isNull(), F.to_json(F.create_map(F.lit("_corrupt"), F.col(text)))).when(
        F.size(unknown) > 0, F.to_json(unknown)
    )
    rest = [c for c in lines.columns if c != text]
    return lines.select(*rest, F.from_json(text, target).alias("_row"), rescued.alias(out)).select(*rest, "_row.*", out)


def add_lineage(df: DataFrame, at: Column | None = None) -> DataFrame:
    """Raw columns untouched, plus when and from which file each row came."""
    return df.select(
        "*",
        (at if at is not None else F.current_timestamp()).alias("ingestion_timestamp"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def file_view(spark: SparkSession, name: str, file_format: str, path: str, ddl: str | None = None) -> None:
    """Temporary SQL view over files."""
    columns = f"({ddl})" if ddl else ""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} {columns} USING {file_format} OPTIONS (path '{path}')")


def stream_files(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    file_format: str = "parquet",
    pattern: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream. The schema is always explicit, so a restart sees the same columns."""
    reader = spark.readStream.format(file_format).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
