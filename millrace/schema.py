"""The corpus record and its adapters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STRINGS = "id source_id source_url license_id category category_hint primary_category title text language source_name source_path relative_path verified_license_id section_title content_sha256 corpus_version extraction_policy"
_LISTS = "related_concepts candidate_concepts section_headings category_evidence"
_DOUBLES = "category_confidence quality_score architecture_relevance_score code_ratio source_priority"

CORPUS = T.StructType(
    [T.StructField(n, T.StringType()) for n in _STRINGS.split()]
    + [T.StructField(n, T.ArrayType(T.StringType())) for n in _LISTS.split()]
    + [T.StructField(n, T.DoubleType()) for n in _DOUBLES.split()]
    + [T.StructField("schema_version", T.IntegerType()), T.StructField("token_count", T.LongType()), T.StructField("metadata", T.MapType(T.StringType(), T.StringType()))]
)


def deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of the corpus table; `ord` is the order of delivery."""
    return spark.read.parquet(f"{sf_dir}/corpus_document.parquet")


def current(docs: DataFrame) -> DataFrame:
    """The latest delivery of every id."""
    latest = Window.partitionBy("id").orderBy(F.col("ord").desc())
    return docs.withColumn("_n", F.row_number().over(latest)).filter("_n = 1").drop("_n")


def problems(docs: DataFrame) -> DataFrame:
    """The rows with `problems`: why a row is no valid record (blank text, missing or untrimmed source or category)."""
    bad = lambda c: F.when(F.coalesce(F.trim(c), F.lit("")) == "", f"blank_{c}").when(F.trim(c) != F.col(c), f"untrimmed_{c}")
    blank = F.when(F.coalesce(F.regexp_replace("text", r"\s+", ""), F.lit("")) == "", "blank_text")
    return docs.withColumn("problems", F.array_compact(F.array(blank, bad("source_id"), bad("category"))))
