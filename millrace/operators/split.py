"""Deterministic splits by hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.hashing import score32, score64


def two_way(docs: DataFrame, train: float = 0.98, seed: int = 42) -> DataFrame:
    """The rows with `split`: validation if the id's score is below 1 - train.

    A single document trains. If one side would be empty, the document of lowest score validates or that of highest
    score trains. Bounds are one-row aggregates, so no row is moved.
    """
    scored = docs.withColumn("_score", score32(F.col("id"), seed))
    low = F.col("_score") < 1.0 - train
    ends = scored.agg(
        F.count("*").alias("n"), F.count_if(low).alias("below"), F.min(F.struct("_score", "id")).alias("lo"), F.max(F.struct("_score", "id")).alias("hi")
    )
    out = scored.crossJoin(F.broadcast(ends))  # one row
    choice = (
        F.when(F.col("n") == 1, "train")
        .when(F.col("below") == 0, F.when(F.col("id") == F.col("lo.id"), "validation").otherwise("train"))
        .when(F.col("below") == F.col("n"), F.when(F.col("id") == F.col("hi.id"), "train").otherwise("validation"))
        .otherwise(F.when(low, "validation").otherwise("train"))
    )
    return out.withColumn("split", choice).drop("_score", "n", "below", "lo", "hi")


def three_way(key: Column, train: float = 0.90, validation: float = 0.05, heldout: float = 0.05, seed: int = 42) -> Column:
    """Split of a group key; rows of one group always share it. The ratios must not be negative and sum to 1."""
    if min(train, validation, heldout) < 0 or abs(train + validation + heldout - 1.0) > 1e-9:
        raise ValueError("split ratios must not be negative and must sum to 1")
    s = score64(key, seed)
    return F.when(s < train, "train").when(s < train + validation, "validation").otherwise("heldout")


def group_key(docs: DataFrame) -> Column:
    """Provenance group of a document, else its id."""
    g = F.col("metadata")["provenance_group_id"]
    return F.coalesce(F.when(g != "", g), F.col("id"))
