"""Exact duplicates, contamination and leakage between sets of texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import PIECE, dedup_key, let, normalized
from millrace.runtime import attach, lookup, materialize


def exact_duplicates(docs: DataFrame, order: Sequence[Column], id_column: str = "id") -> DataFrame:
    """The rows with `dedup_key`, `canonical` (the id kept for their text) and `kept`; the first in `order` is kept.

    The first row of a text is an aggregate of keys, ids and order columns, combined before the shuffle; only texts that
    stand in several rows are stored. The rows, which carry the texts, are not moved if those are few; else a text that a
    third of all rows share is joined apart from the others (`runtime.attach`). Rows without text share one key of
    their own. `order` must end in a column that tells the rows of a text apart, else all equal first ones are kept.
    """
    return mark_duplicates(docs.withColumn("dedup_key", dedup_key(F.col("text"))), order, id_column)


def mark_duplicates(keyed: DataFrame, order: Sequence[Column], id_column: str = "id") -> DataFrame:
    """`exact_duplicates` of rows that have their `dedup_key` already."""
    keyed = keyed.withColumn("dedup_key", F.coalesce("dedup_key", F.lit("")))
    rank = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
    slim = keyed.select("dedup_key", F.struct(rank.alias("rank"), F.col(id_column).alias("canonical")).alias("first"))
    several = slim.groupBy("dedup_key").agg(F.min("first").alias("first"), F.count("*").alias("_n")).filter("_n > 1")
    out = attach(keyed, materialize(several, "repeated_texts"), "dedup_key", "_n", F.to_json(F.struct(rank, F.col(id_column))))
    out = out.withColumn("kept", F.col("_n").isNull() | (rank == F.col("first.rank")))
    return out.withColumn("canonical", F.when(F.col("_n").isNull(), F.col(id_column)).otherwise(F.col("first.canonical"))).drop("first", "_n")


def ngrams(text: Column, n: int = 4) -> Column:
    """Distinct runs of n words in lower case; the whole text if it is shorter; none for a blank one."""
    def runs(w: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - (n - 1))), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) == 0, F.array().cast("array<string>")).when(F.size(w) < n, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(each))

    return let(F.regexp_extract_all(F.lower(text), F.lit(PIECE), F.lit(0)), runs)


def contamination(docs: DataFrame, samples: DataFrame, threshold: float = 0.50, n: int = 4) -> DataFrame:
    """Pairs (doc_id, sample_id) whose sets of n-word runs overlap, with Jaccard similarity of at least `threshold`,
    and `containment`, the share of the sample's runs that the document has.

    docs(doc_id, text), samples(sample_id, text). The runs of both sides are joined, never the texts with each other. The
    samples' runs are stored and, up to a checked number, broadcast, so a document's runs that no sample has go no
    further; beyond it a run that very many documents have is dealt over several tasks.
    """
    test = samples.select("sample_id", ngrams(F.col("text"), n).alias("runs")).select("sample_id", F.size("runs").alias("nb"), F.explode("runs").alias("run"))
    have = docs.select("doc_id", ngrams(F.col("text"), n).alias("runs")).select("doc_id", F.size("runs").alias("na"), F.explode("runs").alias("run"))
    shared = lookup(have, materialize(test, "test_runs"), ["run"]).groupBy("doc_id", "sample_id", "na", "nb").agg(F.count("*").alias("both"))
    jaccard = F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))
    out = shared.select("doc_id", "sample_id", F.round(jaccard, 4).alias("jaccard"), F.round(F.col("both") / F.col("nb"), 4).alias("containment"), jaccard.alias("_j"))
    return out.filter(F.col("_j") >= threshold).drop("_j")


def leakage(docs: DataFrame, split: str = "split") -> DataFrame:
    """One row: ids and normalized texts that stand in more than one split."""
    ids = docs.groupBy("id").agg(F.count_distinct(split).alias("n")).filter("n > 1").agg(F.count("*").alias("id_overlap"))
    texts = docs.groupBy(F.sha2(normalized(F.col("text")), 256).alias("t")).agg(F.count_distinct(split).alias("n")).filter("n > 1").agg(F.count("*").alias("text_overlap"))
    return ids.crossJoin(texts)  # one row each


def shared_hashes(docs: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Content hashes that stand in all of the named sources, wherever else they stand, with the tokens saved by keeping
    one of the named sources' documents."""
    own = docs.filter(F.col("source_id").isin(*sources))
    g = own.groupBy("content_sha256").agg(F.collect_set("source_id").alias("s"), F.count("*").alias("documents"), F.sum("tokens").alias("t"), F.max("tokens").alias("one"))
    return g.filter(F.size("s") == len(set(sources))).select("content_sha256", "documents", (F.col("t") - F.col("one")).alias("tokens_saved"))


def shared_clusters(docs: DataFrame, near: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Clusters of near duplicates whose documents come from all of the named sources and from no others, with the tokens
    of the documents that were removed. docs(id, source_id, tokens), near(id, cluster, kept)."""
    g = near.join(docs.select("id", "source_id", "tokens"), "id").groupBy("cluster").agg(
        F.collect_set(F.when(F.col("source_id").isin(*sources), F.col("source_id"))).alias("s"), F.max((~F.coalesce(F.col("source_id").isin(*sources), F.lit(False))).cast("int")).alias("other"),
        F.count("*").alias("documents"), F.coalesce(F.sum(F.when(~F.col("kept"), F.col("tokens"))), F.lit(0)).alias("tokens_saved"),
    )
    return g.filter((F.size("s") == len(set(sources))) & (F.col("other") == 0)).select("cluster", "documents", "tokens_saved")
