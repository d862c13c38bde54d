"""End-to-end pipelines: build, curate and freeze, each with a ledger of decisions."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions import scoring, semantic
from millrace.functions import text as tx
from millrace.operators import analytics, balance, dedup, sections, split
from millrace.operators.neardup import NearDuplicates
from millrace.runtime import materialize
from millrace.schema import problems


def _ledger(docs: DataFrame, decision: str, reason=None) -> DataFrame:
    return docs.select("id", "source_id", F.lit(decision).alias("decision"), (F.lit(None) if reason is None else reason).cast("string").alias("reason"))


@dataclass
class Result:
    """Kept documents and the ledger, one row per decision."""

    documents: DataFrame
    ledger: DataFrame
    frames: dict[str, DataFrame] = field(default_factory=dict)


def build(raw: DataFrame, train: float = 0.98, seed: int = 42, order=None) -> Result:
    """Clean, remove exact duplicates, gate and split. Rows whose text is blank after cleaning go to quarantine.

    Input is any number of deliveries with `ord`; only the kept row of a text is gated, since duplicates come first.
    One table is stored: the cleaned rows with their problems, their gate reasons and the key of their text, so that
    everything after it reads only the columns it needs, and texts only where they are asked for.
    """
    cleaned = raw.withColumn("text", tx.clean(F.col("text")))
    reasons = scoring.gate_reasons(F.col("text"), F.col("language"), F.col("source_id"))
    checked = problems(cleaned).withColumn("reasons", reasons)
    checked = materialize(checked.withColumn("dedup_key", tx.dedup_key(F.col("text"))), "cleaned")
    bad = checked.filter(F.size("problems") > 0)
    good = checked.filter(F.size("problems") == 0).drop("problems")
    marked = dedup.mark_duplicates(good, order or [F.col("ord")])
    kept = marked.filter("kept").drop("kept", "canonical", "dedup_key")
    passed = split.two_way(kept.filter(F.size("reasons") == 0).drop("reasons"), train, seed)
    rejected = kept.filter(F.size("reasons") > 0)
    duplicates = marked.filter(~F.col("kept"))
    ledger = _ledger(bad, "quarantined", F.array_join("problems", ";"))
    ledger = ledger.unionByName(_ledger(duplicates, "exact_duplicate", F.col("canonical")))
    ledger = ledger.unionByName(_ledger(rejected, "rejected_quality", F.array_join("reasons", ";")))
    ledger = ledger.unionByName(_ledger(passed, "kept", F.col("split")))
    return Result(passed, ledger, {"rejected": rejected, "duplicates": duplicates})


@dataclass(frozen=True)
class CurationSettings:
    min_score: float = 0.45
    max_code: float = 0.70
    caps: Mapping[str, float] = field(default_factory=lambda: dict(balance.CAPS))
    train: float = 0.95
    seed: int = 42
    near: NearDuplicates = NearDuplicates()


def curate(docs: DataFrame, settings: CurationSettings = CurationSettings()) -> Result:  # noqa: B008
    """Second pass over documents with unique ids: fixtures, boilerplate, relevance, quality, code, near duplicates,
    concentration and a split that keeps every cluster of near duplicates together.

    The cheap gates are columns of one projection; the first failing one is the document's reason.
    """
    fixture = (F.col("source_id") == "test_fixtures_local") | (F.coalesce(F.col("metadata")["is_test_fixture"], F.lit("")).isin("true", "True", "1"))
    text, blocks, _ = tx.strip_boilerplate(F.col("text"))
    d = docs.withColumn("fixture", fixture).withColumn("text", text)
    d = d.withColumn("_r", scoring.domain_relevance(F.coalesce("relative_path", "id"), F.col("title"), F.col("text")))
    d = d.withColumn("_q", scoring.quality(F.col("text"), low=settings.min_score)).withColumn("_c", scoring.code_share(F.col("text"), settings.max_code))
    decision = (
        F.when(F.col("fixture"), "fixture_excluded")
        .when(~F.col("_r.relevant"), "rejected_domain_relevance")
        .when(F.col("_q.bucket") == "low", "rejected_quality")
        .when(F.col("_c.dominated"), "rejected_code")
    )
    slim = d.select(
        "id", "source_id", "category", "license_id", "text", analytics.organization().alias("organization"), F.col("_q.score").alias("score"), F.col("_q.bucket").alias("bucket"),
        F.col("_c.total_tokens").alias("tokens"), F.col("_r.category").alias("why"), decision.alias("decision"),
    )
    slim = materialize(slim, "curation")
    passing = slim.filter("decision is null")
    near = materialize(settings.near.run(passing.select("id", "text", "score")), "near_duplicates")
    canonical = passing.join(near.filter("kept").select("id"), "id", "left_semi")
    balanced = materialize(balance.balance(canonical, settings.caps).select("id", "source_id", "category", "organization", "license_id", "tokens", "score", "bucket", "kept"), "balanced")
    kept = balanced.filter("kept").join(near.select("id", "cluster"), "id")
    score = split.score64(F.col("id"), settings.seed)
    kept = kept.withColumn("split", F.when(score < settings.train, "train").otherwise("validation"))
    ledger = _ledger(slim.filter("decision is not null"), "", F.col("why")).drop("decision").join(slim.select("id", "decision").filter("decision is not null"), "id").select("id", "source_id", "decision", "reason")
    removed = near.filter(~F.col("kept")).join(passing.select("id", "source_id"), "id")
    ledger = ledger.unionByName(_ledger(removed, "near_duplicate", F.col("canonical")))
    ledger = ledger.unionByName(_ledger(balanced.filter(~F.col("kept")), "balanced_out")).unionByName(_ledger(kept, "kept", F.col("split")))
    return Result(kept, ledger, {"scored": slim, "near": near})


@dataclass(frozen=True)
class FreezeSettings:
    target_tokens: int = 200_000
    targets: Mapping[str, float] = field(default_factory=dict)
    section_tokens: int = 2400
    min_relevance: float = 0.40
    max_links: float = 0.22
    max_code: float = 0.55
    max_source_share: float = 0.30
    tolerance: float = 0.02
    category_tolerance: float = 0.05
    seed: int = 42
    near: NearDuplicates = NearDuplicates()
    #: Refuse a selection that cannot reach or does not keep its limits, instead of only reporting that.
    strict: bool = False


def gate_sections(parts: DataFrame, settings: FreezeSettings) -> DataFrame:
    """Sections with their scores and `reasons`: all of the four gates that they fail."""
    t = F.col("text")
    d = parts.withColumn("_d", scoring.domain_relevance(F.coalesce("relative_path", "id"), F.col("section_title"), t))
    d = d.withColumn("_r", scoring.reasoning_relevance(t, min_score=settings.min_relevance, max_links=settings.max_links)).withColumn("_q", scoring.quality(t))
    d = d.withColumn("_c", scoring.code_share(t, settings.max_code))
    reasons = F.array_compact(
        F.array(
            F.when(~F.col("_d.relevant"), "domain_relevance"), F.when(~F.col("_r.passed"), "architecture_relevance_or_link_ratio"),
            F.when(F.col("_q.bucket") == "low", "quality_score"), F.when(F.col("_c.dominated"), "code_ratio"),
        )
    )
    return d.select(
        *parts.columns, F.col("_q.score").alias("quality_score"), F.col("_r.score").alias("relevance_score"), F.col("_c.code_ratio").alias("code_ratio"),
        F.col("_c.total_tokens").alias("tokens"), reasons.alias("reasons"),
    )


def freeze(docs: DataFrame, sources: DataFrame, settings: FreezeSettings) -> Result:
    """Third pass: sections, gates, merging of neighbours, ranked exact and near duplicates, budgeted selection and a
    three-way split by provenance group. docs needs unique ids; sources(id, source_priority, source_token_cap). What speaks
    against the target before and after the selection is in the frames `preflight` and `violations`; with `strict` it is
    an error."""
    headed = docs.withColumn("text", tx.structural_headings(tx.strip_boilerplate(tx.clean(F.col("text")))[0]))
    base = headed.select(F.col("id").alias("parent_id"), "source_id", "relative_path", F.coalesce("category_hint", "category").alias("category_hint"), split.group_key(headed).alias("group_id"))
    parts = sections.sectionize(headed.select("id", "title", "text"), settings.section_tokens).join(base, "parent_id")
    gated = materialize(gate_sections(parts, settings), "gated_sections")
    passed = gated.filter(F.size("reasons") == 0)
    merged = sections.merge_sections(passed.select("id", "source_id", F.col("parent_id").alias("relative_path"), "section_index", "text", "category_hint"), settings.section_tokens)
    best = passed.select("id", "group_id", "quality_score", "relevance_score")
    prio = sources.select(F.col("id").alias("source_id"), F.coalesce("source_priority", F.lit(0.0)).alias("priority")).dropDuplicates(["source_id"])
    ranked = merged.join(best, "id").join(prio, "source_id", "left")
    ranked = ranked.withColumn("tokens", scoring.python_tokens(F.col("text"))).withColumn("content_sha256", tx.content_hash(F.col("text")))
    ranked = materialize(ranked.withColumn("score", F.col("quality_score") + F.col("relevance_score") + F.coalesce("priority", F.lit(0.0)) / 100), "ranked_sections")
    exact = dedup.exact_duplicates(ranked, [-F.col("score"), F.col("id")])
    unique = materialize(exact.filter("kept").drop("kept", "canonical", "dedup_key"), "unique_sections")
    near = materialize(settings.near.run(unique.select("id", "text", "score")), "near_duplicates")
    eligible = unique.join(near.filter("kept").select("id"), "id", "left_semi").withColumnRenamed("primary_category", "category")
    pool = materialize(eligible.join(analytics.document_rarity(eligible), "id", "left").withColumn("rarity", F.coalesce("rarity", F.lit(10_000))), "eligible")
    preflight = materialize(balance.preflight_violations(pool, sources, settings.targets, settings.target_tokens, settings.tolerance, settings.category_tolerance), "preflight")
    _refuse(preflight, settings)
    chosen = materialize(balance.select_budget(pool, settings.targets, settings.target_tokens, sources, settings.max_source_share, settings.section_tokens, settings.tolerance), "chosen")
    violations = balance.selection_violations(chosen.filter("decision = 'selected'"), settings.targets, settings.target_tokens, settings.tolerance, settings.max_source_share, settings.category_tolerance)
    violations = materialize(violations, "violations")
    _refuse(violations, settings)
    selected = chosen.filter("decision = 'selected'").withColumn("split", split.three_way(F.col("group_id"), seed=settings.seed))
    ledger = _ledger(gated.filter(F.size("reasons") > 0), "rejected", F.array_join("reasons", ";")).unionByName(_ledger(exact.filter(~F.col("kept")), "exact_duplicate", F.col("canonical")))
    ledger = ledger.unionByName(_ledger(near.filter(~F.col("kept")).join(unique.select("id", "source_id"), "id"), "near_duplicate", F.col("canonical")))
    ledger = ledger.unionByName(_ledger(chosen.filter("decision <> 'selected'"), "balanced_out", F.col("decision"))).unionByName(_ledger(selected, "kept", F.col("split")))
    return Result(selected, ledger, {"gated": gated, "eligible": pool, "near": near, "parts": parts, "preflight": preflight, "violations": violations})


def _refuse(violations: DataFrame, settings: FreezeSettings) -> None:
    if settings.strict and (broken := violations.limit(20).collect()):  # at most twenty are named
        raise ValueError("freeze refused: " + ", ".join(f"{r['rule']} {r['value']}" for r in broken))


def capacity_funnel(result: Result, raw: DataFrame) -> DataFrame:
    """Documents, sections, passing sections and units after grouping and duplicates, in one row per stage."""
    stages = [("documents", raw), ("sections", result.frames["gated"]), ("passing_sections", result.frames["gated"].filter(F.size("reasons") == 0)), ("units_after_dedup", result.frames["eligible"]), ("selected", result.documents)]
    out = None
    for i, (name, df) in enumerate(stages):
        row = df.agg(F.count("*").alias("units")).select(F.lit(i).alias("place"), F.lit(name).alias("stage"), "units")
        out = row if out is None else out.unionByName(row)
    return out


def manifest(result: Result) -> DataFrame:
    """One row: documents, tokens, tokens per split, sources and categories and the fingerprint of the kept documents' ids."""
    kept = result.documents
    by = {s: F.coalesce(F.sum(F.when(F.col("split") == s, F.col("tokens"))), F.lit(0)).alias(f"{s}_tokens") for s in ("train", "validation", "heldout")}
    totals = kept.agg(F.count("*").alias("documents"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.count_distinct("source_id").alias("sources"), F.count_distinct("category").alias("categories"), *by.values())
    return totals.crossJoin(analytics.fingerprint(kept.select("id", F.col("id").alias("text"), F.lit("").alias("license_id"))))  # one row each


def benchmark_overlap(docs: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: distinct normalized texts of docs(text) that stand anywhere inside a text of samples(text, passages), and
    distinct sample texts of which a passage stands anywhere inside a document.

    The samples, a few hundred test items, are sent to every task as one row. A passage of six words or more is looked
    up by its second to fifth word, which are whole words in every document that holds it; shorter ones are searched for.
    """
    texts = materialize(docs.select(tx.normalized(F.col("text")).alias("text")).filter("text <> ''").distinct(), "normalized")
    tests = samples.select(tx.normalized(F.col("text")).alias("t"), "passages").filter("t <> ''")
    content = tests.select("t").distinct().agg(F.array_join(F.collect_list("t"), "\n").alias("content"), F.max(F.length("t")).alias("longest"))
    within = texts.join(F.broadcast(content), (F.length("text") <= F.col("longest")) & F.contains("content", "text"), "left_semi")
    parts = tests.select("t", F.explode("passages").alias("p")).select("t", tx.normalized(F.col("p")).alias("p")).filter("p <> ''").distinct()
    parts = parts.withColumn("w", F.split("p", " ")).select("t", "p", F.when(F.size("w") >= 6, F.array_join(F.slice("w", 2, 4), " ")).otherwise(F.col("p")).alias("anchor"), (F.size("w") < 6).alias("short"))
    parts = materialize(parts, "passages")
    one = parts.agg(F.collect_set(F.when(~F.col("short"), F.col("anchor"))).alias("anchors"), F.collect_set(F.when(F.col("short"), F.col("anchor"))).alias("shorts"))
    runs = tx.let(F.split("text", " "), lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - 3)), lambda i: F.array_join(F.slice(w, i, 4), " ")))
    found = F.array_union(F.array_intersect(runs, "anchors"), F.filter("shorts", lambda x: F.contains(F.col("text"), x)))
    held = texts.crossJoin(F.broadcast(one)).select("text", F.explode(found).alias("anchor")).join(parts, "anchor").filter(F.contains("text", "p"))
    return within.agg(F.count("*").alias("benchmark_documents")).crossJoin(held.agg(F.count_distinct("t").alias("benchmark_samples")))  # one row each


def readiness(docs: DataFrame, samples: DataFrame) -> DataFrame:
    """One row of blockers of a split corpus: overlap between splits, invalid records, documents inside test texts; and
    `benchmark_samples`, the test items of which a passage stands inside a document.

    docs(id, text, source_id, category, language, source_url, license_id, split[, metadata]), samples(text, passages). A
    record without a license is valid if its metadata name a verified one.
    """
    leak = dedup.leakage(docs)
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit("")) == ""
    named = F.lower(F.col("source_id")).contains("benchmark") | F.lower(F.coalesce("source_url", F.lit(""))).contains("benchmark")
    verified = F.coalesce(F.trim(F.col("metadata")["verified_license_id"]), F.lit("")) != "" if "metadata" in docs.columns else F.lit(False)
    unlicensed = blank("license_id") & ~verified
    invalid = docs.agg(F.count_if(blank("id") | blank("text") | blank("source_id") | blank("category") | blank("language") | blank("source_url") | unlicensed | F.coalesce(named, F.lit(False))).alias("invalid_records"))
    row = leak.crossJoin(invalid).crossJoin(benchmark_overlap(docs, samples))  # one row each
    blockers = F.array_compact(F.array(F.when((F.col("id_overlap") > 0) | (F.col("text_overlap") > 0), "split_overlap"), F.when(F.col("invalid_records") > 0, "invalid_records"), F.when(F.col("benchmark_documents") > 0, "benchmark_contamination")))
    return row.withColumn("blockers", blockers)


def diagnostics(sources: DataFrame, checked: DataFrame | None = None) -> DataFrame:
    """Status and classification of every configured source: sources(id, category, enabled, license_id).

    checked(source_id, valid) holds the license checks of the repositories that are at hand; an enabled source that
    failed its check counts as disabled, one that was not checked as active.
    """
    nc = F.coalesce("license_id", F.lit("")).contains("NC")
    rows = sources.withColumn("_valid", F.lit(None).cast("boolean")) if checked is None else sources.join(checked.select(F.col("source_id").alias("id"), F.col("valid").alias("_valid")), "id", "left")
    on, failed = F.coalesce("enabled", F.lit(False)), F.coalesce(~F.col("_valid"), F.lit(False))
    status = F.when(on & failed, "disabled_unclear_license").when(on, "active").when(nc, "disabled_license_restriction").otherwise("disabled_user_config")
    kind = F.when(on & failed, "license_verification_failed").when(on, "verified_active").when(nc, "license_non_commercial_restriction").otherwise("disabled_user_config")
    return rows.select(F.col("id").alias("source_id"), "category", status.alias("status"), kind.alias("classification"), (on & ~failed).alias("active"))
