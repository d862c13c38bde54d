"""Corpus analytics: statistics, distributions, concentration, coverage, capacity and audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import vocabulary as V
from millrace.functions.text import PIECE, WS


def corpus_stats(docs: DataFrame, rejected: DataFrame | None = None, duplicates: DataFrame | None = None) -> DataFrame:
    """Per source: accepted documents, characters, words, their averages, and rejected and duplicate documents."""
    text = F.coalesce(F.col("text"), F.lit(""))
    stats = docs.groupBy("source_id").agg(
        F.count("*").alias("documents"), F.sum(F.length(text)).alias("characters"), F.sum(F.regexp_count(text, F.lit(PIECE))).cast("long").alias("words"),
    )
    for name, frame in (("rejected", rejected), ("duplicates", duplicates)):
        if frame is not None:
            stats = stats.join(frame.groupBy("source_id").agg(F.count("*").alias(name)), "source_id", "full")
    stats = stats.fillna(0)
    return stats.withColumn("avg_characters", F.round(F.coalesce(F.col("characters") / F.nullif("documents", F.lit(0)), F.lit(0.0)), 2)).withColumn(
        "avg_words", F.round(F.coalesce(F.col("words") / F.nullif("documents", F.lit(0)), F.lit(0.0)), 2)
    )


def token_distribution(docs: DataFrame, dimensions: Sequence[str] = ("source_id", "category", "license_id")) -> DataFrame:
    """Documents, tokens and share of all tokens per value of each dimension, in one pass of grouping sets."""
    filled = docs.select(*[F.coalesce(F.col(d).cast("string"), F.lit("(none)")).alias(d) for d in dimensions], "tokens")
    sets = filled.groupingSets([[d] for d in dimensions], *dimensions)
    out = sets.agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    name = F.coalesce(*[F.when(F.col(d).isNotNull(), d) for d in dimensions])
    share = F.col("tokens") / F.greatest(F.lit(1), F.sum("tokens").over(Window.partitionBy("dimension")))
    out = out.select(name.alias("dimension"), F.coalesce(*dimensions).alias("value"), "documents", "tokens")
    return out.withColumn("share", F.round(share, 4))


def concentration(docs: DataFrame, floors: Mapping[str, float] | None = None) -> DataFrame:
    """One row: shares of the largest and the five largest sources, the largest category and organization, the
    Herfindahl index of the sources, and warnings. docs(source_id, category, organization, tokens)."""
    totals = token_totals(docs)
    total = F.sum(F.when(F.col("dimension") == "source_id", F.col("tokens")))
    place = F.row_number().over(Window.partitionBy("dimension").orderBy(F.col("tokens").desc(), "value"))
    ranked = totals.withColumn("place", place)
    top = lambda d, k: F.sum(F.when((F.col("dimension") == d) & (F.col("place") <= k), F.col("tokens")))
    categories = [F.sum(F.when((F.col("dimension") == "category") & (F.col("value") == c), F.col("tokens"))).alias(f"floor_{i}") for i, c in enumerate(floors or {})]
    row = ranked.agg(
        F.coalesce(total, F.lit(0)).alias("total_tokens"), top("source_id", 1).alias("s1"), top("source_id", 5).alias("s5"), top("category", 1).alias("c1"),
        top("organization", 1).alias("o1"), F.sum(F.when(F.col("dimension") == "source_id", F.pow(F.col("tokens"), 2.0))).alias("sq"), *categories,
    )
    part = lambda c: F.when(F.col("total_tokens") > 0, F.col(c) / F.col("total_tokens")).otherwise(0.0)
    low = [F.when(F.coalesce(F.col(f"floor_{i}"), F.lit(0)) / F.col("total_tokens") < v, f"low_category:{c}") for i, (c, v) in enumerate((floors or {}).items())]
    warnings = F.when(F.col("total_tokens") == 0, F.array(F.lit("no_tokens"))).otherwise(
        F.array_compact(F.array(F.when(part("s1") > 0.35, "source_dominance"), F.when(part("c1") > 0.45, "category_dominance"), *low))
    )
    hhi = F.when(F.col("total_tokens") > 0, F.col("sq") / F.pow(F.col("total_tokens"), 2.0)).otherwise(0.0)
    return row.select(
        "total_tokens", F.round(part("s1"), 4).alias("top_1_source_share"), F.round(part("s5"), 4).alias("top_5_source_share"),
        F.round(part("c1"), 4).alias("top_category_share"), F.round(part("o1"), 4).alias("top_organization_share"), F.round(hhi, 4).alias("hhi_source_index"),
        warnings.alias("warnings"),
    )


def token_totals(docs: DataFrame) -> DataFrame:
    """(dimension, value, tokens) over source, category and organization."""
    dims = ["source_id", "category", "organization"]
    filled = docs.select(*[F.coalesce(d, F.lit("(none)")).alias(d) for d in dims], "tokens")
    out = filled.groupingSets([[d] for d in dims], *dims).agg(F.sum("tokens").alias("tokens"))
    return out.select(F.coalesce(*[F.when(F.col(d).isNotNull(), d) for d in dims]).alias("dimension"), F.coalesce(*dims).alias("value"), "tokens")


def cap_status(docs: DataFrame, caps: Mapping[str, float], tolerance: float = 0.001) -> DataFrame:
    """Per dimension: its cap, the largest share, and whether the cap holds within the tolerance."""
    totals = token_totals(docs)
    largest = totals.groupBy("dimension").agg(F.max("tokens").alias("top"), F.sum("tokens").alias("total"))
    cap = F.create_map(*[x for k, v in caps.items() for x in (F.lit(k), F.lit(float(v)))])
    out = largest.withColumn("cap", cap[F.col("dimension")]).withColumn("share", F.when(F.col("total") > 0, F.col("top") / F.col("total")).otherwise(0.0))
    return out.select("dimension", "cap", F.round("share", 6).alias("actual_share"), ((F.col("total") > 0) & (F.col("share") <= F.col("cap") + tolerance)).alias("satisfied"))


def organization() -> Column:
    """Owner of the repository in the metadata, else the source."""
    return F.coalesce(F.col("metadata")["repository_owner"], F.col("source_id"))


def exact_mean(score: Column, digits: int = 4) -> Column:
    """Mean of scores of so many digits, rounded half up to as many; computed in integers, so that neither the order of
    addition nor binary fractions can change it."""
    total, n = F.sum(F.round(score * 10.0**digits).cast("long")), F.count(score)
    return F.floor(F.try_divide(2 * total + n, 2 * n)) / 10.0**digits


def source_quality(scored: DataFrame) -> DataFrame:
    """Per source: mean document score, share of documents in the high bucket, and the source's own bucket."""
    out = scored.groupBy("source_id").agg(exact_mean(F.col("score")).alias("m"), F.avg((F.col("bucket") == "high").cast("double")).alias("h"), F.count("*").alias("documents"))
    bucket = F.when(F.col("m") >= 0.70, "high").when(F.col("m") >= 0.45, "medium").otherwise("low")
    return out.select("source_id", F.col("m").alias("score"), F.round("h", 4).alias("high_ratio"), bucket.alias("bucket"), "documents")


def _unit() -> Column:
    return F.struct(F.coalesce("source_id", F.lit("")).alias("s"), F.coalesce("relative_path", "id").alias("d"))


def category_coverage(docs: DataFrame) -> DataFrame:
    """Per category: tokens, distinct sources, distinct documents and training units."""
    c = F.coalesce("primary_category", "category", F.lit("(none)"))
    return docs.groupBy(c.alias("primary_category")).agg(
        F.sum(F.coalesce("tokens", F.lit(0))).alias("tokens"), F.count_distinct("source_id").alias("sources"), F.count_distinct(_unit()).alias("documents"), F.count("*").alias("training_units"),
    )


def concept_coverage(docs: DataFrame, vocabulary: Sequence[str] = tuple(sorted(V.CONCEPT_PHRASES)), tokens: int = 1000, sources: int = 2, documents: int = 2, dominant: float = 0.70) -> DataFrame:
    """Per concept of the vocabulary, found or not: tokens, sources, documents, units, the dominant source with its
    share, and what is lacking."""
    spread = docs.select(F.explode("related_concepts").alias("concept"), "source_id", "relative_path", "id", F.coalesce("tokens", F.lit(0)).alias("tokens"))
    per_source = spread.groupBy("concept", "source_id").agg(F.sum("tokens").alias("t"), F.count("*").alias("units"))
    units = spread.groupBy("concept").agg(F.count_distinct(_unit()).alias("documents"))
    by = per_source.groupBy("concept").agg(
        F.sum("t").alias("tokens"), F.count("source_id").alias("sources"), F.sum("units").alias("training_units"), F.max("t").alias("top"),
        F.max_by("source_id", F.struct("t", F.col("units"), F.xxhash64("source_id"))).alias("any_top"),
        F.min(F.struct((-F.col("t")).alias("t"), F.col("source_id").alias("s"))).alias("first_top"),
    )
    every = docs.sparkSession.createDataFrame([(c,) for c in vocabulary], "concept string")
    out = every.join(by.join(units, "concept"), "concept", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    share = F.round(zero("top") / F.greatest(F.lit(1), zero("tokens")), 4)
    lacking = F.array_compact(
        F.array(
            F.when(zero("tokens") < tokens, "LOW_TOKENS"), F.when(zero("sources") < sources, "LOW_SOURCE_DIVERSITY"),
            F.when(zero("documents") < documents, "LOW_DOCUMENT_DIVERSITY"), F.when(share > dominant, "HIGH_SOURCE_CONCENTRATION"),
        )
    )
    status = F.when(zero("training_units") == 0, F.array(F.lit("NO_COVERAGE"))).when(F.size(lacking) == 0, F.array(F.lit("healthy"))).otherwise(lacking)
    return out.select(
        "concept", zero("tokens").alias("tokens"), zero("sources").alias("sources"), zero("documents").alias("documents"), zero("training_units").alias("training_units"),
        share.alias("dominant_source_share"), F.col("first_top.s").alias("dominant_source"), status.alias("status"),
    )


def concept_matrix(docs: DataFrame) -> DataFrame:
    """Tokens per concept and source."""
    spread = docs.select(F.explode("related_concepts").alias("concept"), "source_id", F.coalesce("tokens", F.lit(0)).alias("tokens"))
    return spread.groupBy("concept", "source_id").agg(F.sum("tokens").alias("tokens"))


def candidate_report(docs: DataFrame, samples: int = 3) -> DataFrame:
    """Per candidate concept: occurrences, tokens, distinct sources and documents, and the ids of the first documents.

    The samples are the smallest ids, kept by a bounded aggregate rather than by collecting all."""
    spread = docs.select(F.explode("candidate_concepts").alias("candidate"), "source_id", "relative_path", "id", F.coalesce("tokens", F.lit(0)).alias("tokens"))
    ranked = spread.withColumn("n", F.row_number().over(Window.partitionBy("candidate", F.pmod(F.xxhash64("id"), F.lit(64))).orderBy("id"))).filter(F.col("n") <= samples)
    some = ranked.groupBy("candidate").agg(F.slice(F.array_sort(F.collect_set("id")), 1, samples).alias("sample_ids"))
    totals = spread.groupBy("candidate").agg(
        F.count("*").alias("count"), F.sum("tokens").alias("tokens"), F.count_distinct("source_id").alias("sources"), F.count_distinct(_unit()).alias("documents")
    )
    return totals.join(some, "candidate")


def reasons_by_source(rejected: DataFrame) -> DataFrame:
    """(source_id, reason, documents) of rejected documents with an array of reasons."""
    return rejected.select("source_id", F.explode("reasons").alias("reason")).groupBy("source_id", "reason").agg(F.count("*").alias("documents"))


def rarity(docs: DataFrame) -> DataFrame:
    """Distinct sources per concept."""
    return docs.select(F.explode("related_concepts").alias("concept"), "source_id").groupBy("concept").agg(F.count_distinct("source_id").alias("sources"))


def document_rarity(docs: DataFrame) -> DataFrame:
    """(id, rarity) of the documents that have concepts: the distinct sources of their rarest one."""
    spread = docs.select("id", F.explode("related_concepts").alias("concept")).join(F.broadcast(rarity(docs)), "concept")  # one row per concept of the vocabulary
    return spread.groupBy("id").agg(F.min("sources").alias("rarity"))


def capacity(docs: DataFrame, sources: DataFrame, targets: Mapping[str, float], target_tokens: int) -> DataFrame:
    """Per target category: wanted and available tokens, the deficit and its cause.

    docs(source_id, primary_category, tokens) are the eligible ones, sources(id, category) the configured ones.
    """
    have = docs.groupBy(F.col("primary_category").alias("category")).agg(F.sum("tokens").alias("available"))
    contributors = sources.groupBy("category").agg(F.count("*").alias("contributing_sources"))
    wanted = docs.sparkSession.createDataFrame([(c, float(s), int(target_tokens * s)) for c, s in targets.items()], "category string, target_share double, target_tokens long")
    out = wanted.join(have, "category", "left").join(contributors, "category", "left").fillna(0, ["available", "contributing_sources"])
    deficit = F.greatest(F.lit(0), F.col("target_tokens") - F.col("available"))
    cause = (
        F.when(F.col("contributing_sources") == 0, "no_source_configured")
        .when(F.col("available") == 0, "quality_rejection_or_insufficient_raw_content")
        .when(F.col("available") < F.col("target_tokens"), "insufficient_eligible_content_or_source_cap")
        .otherwise("available")
    )
    return out.select(
        "category", "target_share", "target_tokens", F.col("available").alias("available_tokens"), deficit.alias("deficit_tokens"),
        F.round(deficit / F.greatest(F.lit(1), F.col("target_tokens")), 4).alias("deficit_share"), "contributing_sources", cause.alias("cause"),
    )


def capped_sources(docs: DataFrame, sources: DataFrame, target_tokens: int) -> DataFrame:
    """Per configured source: eligible documents and tokens, and the tokens under its cap (or the whole target)."""
    have = docs.groupBy("source_id").agg(F.count("*").alias("eligible_documents"), F.sum("tokens").alias("eligible_tokens"))
    cap = F.coalesce(F.nullif("source_token_cap", F.lit(0)), F.lit(target_tokens))
    out = sources.select(F.col("id").alias("source_id"), cap.alias("cap")).join(have, "source_id", "left").fillna(0, ["eligible_documents", "eligible_tokens"])
    return out.withColumn("capped_tokens", F.least("cap", "eligible_tokens"))


def source_audit(sources: DataFrame, raw: DataFrame, ledger: DataFrame, kept: DataFrame) -> DataFrame:
    """Per configured source: documents found, rejected and kept, tokens kept, and the reason if nothing was found."""
    found = raw.groupBy("source_id").agg(F.count("*").alias("discovered"))
    lost = ledger.filter("decision <> 'kept'").groupBy("source_id").agg(F.count("*").alias("rejected"))
    held = kept.groupBy("source_id").agg(F.count("*").alias("curated"), F.sum("tokens").alias("final_tokens"))
    out = sources.select(F.col("id").alias("source_id"), "enabled", "category").join(found, "source_id", "left").join(lost, "source_id", "left").join(held, "source_id", "left")
    out = out.fillna(0, ["discovered", "rejected", "curated", "final_tokens"])
    return out.withColumn("reason_if_zero", F.when(~F.coalesce("enabled", F.lit(False)), "disabled").when(F.col("discovered") == 0, "no_documents"))


def license_audit(docs: DataFrame) -> DataFrame:
    """Documents per license and how many of them lack a verified one. docs(license_id, metadata)."""
    verified = F.col("metadata")["verified_license_id"]
    name = F.coalesce(F.nullif(verified, F.lit("")), F.nullif("license_id", F.lit("")), F.lit("unverified"))
    missing = F.coalesce(F.nullif(verified, F.lit("")), F.lit("")) == ""
    return docs.groupBy(name.alias("license")).agg(F.count("*").alias("documents"), F.count_if(missing | F.col("license_id").isNull()).alias("unverified"))


def set_hash(hashes: DataFrame, prefix: str = "", most: int = 4096) -> DataFrame:
    """One row: `fingerprint` of hashes(h), SHA-256 values in hexadecimal, independent of order and partitions.

    Up to `most` rows it is the hash of the prefix and all values in sorted order. A larger set is first hashed in the
    same way within ranges of the values, 4,096 times as many at every further level, so that no task gathers more than
    about `most` of them; the ranges' hashes are then joined level by level. Repeated values count.
    """
    n = hashes.count()
    level = 0
    while n > most * 4096**level:
        level += 1
    rows = hashes.select("h", F.col("h").alias("h0"))
    for depth in range(level, 0, -1):
        joined = F.transform(F.array_sort(F.collect_list(F.struct("h0", "h"))), lambda x: x["h"])
        rows = rows.groupBy(F.substring("h0", 1, 3 * depth).alias("h0")).agg(F.sha2(F.array_join(joined, ""), 256).alias("h")).select("h", "h0")
    joined = F.transform(F.array_sort(F.collect_list(F.struct("h0", "h"))), lambda x: x["h"])
    return rows.agg(F.sha2(F.concat(F.lit(prefix), F.array_join(joined, "")), 256).alias("fingerprint"))


def fingerprint(docs: DataFrame, prefix: str = "") -> DataFrame:
    """One row: `set_hash` over (id, content hash, license) of all documents."""
    leaf = F.sha2(F.concat_ws("\x00", "id", F.sha2("text", 256), F.coalesce("license_id", F.lit(""))), 256)
    return set_hash(docs.select(leaf.alias("h")), prefix)


def corpus_hash(docs: DataFrame) -> DataFrame:
    """One row: `set_hash` of the content hashes of all documents; null texts count as empty."""
    return set_hash(docs.select(F.sha2(F.coalesce("text", F.lit("")), 256).alias("h")))


def review_sample(docs: DataFrame, categories: Sequence[str], per_category: int = 5) -> DataFrame:
    """The documents of lowest id hash in every category. Kept per salt first, so a category that holds a third of all
    documents is not sorted in one task."""
    keyed = docs.filter(F.col("category").isin(*categories)).withColumn("h", F.sha2("id", 256)).select("category", "id", "h", F.substring("h", 60, 2).alias("salt"))
    pre = keyed.withColumn("n", F.row_number().over(Window.partitionBy("category", "salt").orderBy("h", "id"))).filter(F.col("n") <= per_category)
    last = Window.partitionBy("category").orderBy("h", "id")
    return pre.withColumn("place", F.row_number().over(last)).filter(F.col("place") <= per_category).select("category", "id", "place")


def license_concerns(status: Column) -> Column:
    """Concerns that follow from the status of a license review."""
    out = F.array(F.lit(V.LICENSE_CONCERN_OTHERWISE))
    for k, v in V.LICENSE_CONCERNS.items():
        out = F.when(status == k, F.array(*[F.lit(x) for x in v]).cast("array<string>")).otherwise(out)
    return out


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("WS",)]
