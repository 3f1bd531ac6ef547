"""From raw documents to encoded training texts: classify, drop near duplicates, cut repeated passages, drop benchmark leaks, encode.

Every stage takes and gives the columns of documents; only the last one adds the encoding and what it decodes to.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiffin.llm import bpe, classifier, decontaminate, near_dup, substring_dedup, text

ORACLE_SQL = None  # learned and encoded by methods that SQL does not have; tests/llm compares with plain Python
THRESHOLD = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being good is the threshold or more. Labels of the held-out fold are not learned."""
    labels = spark.read.schema("doc_id BIGINT, quality INT").parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    score = text.new_name(docs, stem="score")
    model = classifier.fit(docs, labels, ~classifier.held_out())
    return classifier.score(docs, model, score).where(F.col(score) >= THRESHOLD).drop(score)


def one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates; documents without an id all stay.

    Of rows equal in id and text one stays, the first by their other columns; rows of one id with different texts stay all. Only rows whose id comes twice are
    shuffled for that.
    """
    verdicts = near_dup.near_duplicates(docs)
    kept = verdicts.where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    several = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    left = docs.join(kept, "doc_id", "left_semi")
    # The limit of one row per text comes before the shuffle, so copies of one row do not meet.
    place = text.new_name(docs, stem="place")
    first = Window.partitionBy("doc_id", F.xxhash64("text"), F.sha2(F.coalesce("text", F.lit("")), 256)).orderBy(*(c for c in docs.columns if c not in ("doc_id", "text")))
    once = left.join(several, "doc_id", "left_semi").withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).drop(place)
    rest = left.join(several, "doc_id", "left_anti")
    return rest.select(docs.columns).unionAll(once.select(docs.columns)).unionAll(docs.where("doc_id IS NULL"))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that an earlier one has; a text that loses nothing stays as it was."""
    cut = substring_dedup.without_repeats(docs)
    shorter = cut.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        shorter = shorter.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return shorter.select(docs.columns)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    benchmark = spark.read.schema("item_id BIGINT, text STRING").parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontaminate.clean(docs, benchmark)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their ids (text with commas), the number of ids, and digests of the ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    both = bpe.decode(bpe.encode(docs, path), path)
    return both.withColumns({
        "n_tokens": F.when(F.col("ids") == "", F.lit(0)).otherwise(F.length("ids") - F.length(F.replace("ids", F.lit(","), F.lit(""))) + 1).cast("bigint"),
        "ids_sha256": F.sha2("ids", 256), "decoded_sha256": F.sha2("decoded", 256),
    }).drop("decoded")


STAGES = [
    ("quality_classifier", good_quality),
    ("near_duplicates", one_of_a_kind),
    ("substring_dedup", without_repeats),
    ("decontamination", without_leaks),
    ("byte_bpe", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; each stage's rows are written before the next one reads them."""
    docs = spark.read.schema("doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT").parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = text.durable(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
