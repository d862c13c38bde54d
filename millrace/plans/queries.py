"""Named queries of the corpus operators over whole tables. `sql.py` holds the same in SQL where it can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import hashing, scoring, semantic
from millrace.functions import text as tx
from millrace.functions import vocabulary as V
from millrace.operators import analytics, balance, dedup, evaluation, sections, sequence, split
from millrace.operators.components import merge_components
from millrace.operators.neardup import REFERENCE, NearDuplicates
from millrace.plans import pipelines
from millrace.plans.sql import SQL
from millrace.runtime import materialize, table
from millrace.schema import current, problems
from millrace.sources import files, paths

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _rows(spark, sf) -> DataFrame:
    return table(spark, sf, "corpus_document")


def _docs(spark, sf) -> DataFrame:
    """Current documents with their tokens, which are counted first, so that texts are moved only for queries that read them."""
    return current(_rows(spark, sf).withColumn("tokens", scoring.python_tokens(F.col("text"))))


def _sources(spark, sf) -> DataFrame:
    return table(spark, sf, "source_config")


def _samples(spark, sf) -> DataFrame:
    return table(spark, sf, "benchmark_sample")


# --- pipelines -------------------------------------------------------------------------------------------------------


@query
def build_stats(spark, sf):
    r = pipelines.build(_rows(spark, sf), train=0.98)
    return analytics.corpus_stats(r.documents, r.frames["rejected"], r.frames["duplicates"])


@query
def build_ledger(spark, sf):
    return pipelines.build(_rows(spark, sf)).ledger.groupBy("decision").agg(F.count("*").alias("entries"))


@query
def curate_ledger(spark, sf):
    return pipelines.curate(current(_rows(spark, sf))).ledger


@query
def freeze_ledger(spark, sf):
    docs = current(_rows(spark, sf))
    targets = {c: 0.1 for c in V.CATEGORIES}
    return pipelines.freeze(docs, _sources(spark, sf), pipelines.FreezeSettings(target_tokens=200_000, targets=targets, section_tokens=120)).ledger


# --- text ------------------------------------------------------------------------------------------------------------


@query
def c1_clean(spark, sf):
    dirty = F.concat(F.lit("\ufeff \r\n"), F.col("text"), F.lit(" \t\r\n\r\n\r\n\r\né\x07end \r"))
    return _rows(spark, sf).select("ord", F.md5(tx.clean(dirty)).alias("clean_md5"))


@query
def c3_boilerplate(spark, sf):
    text, blocks, saved = tx.strip_boilerplate(F.col("text"))
    return _rows(spark, sf).select("ord", F.md5(text).alias("text_md5"), blocks.cast("long").alias("blocks"), saved.cast("long").alias("characters"))


@query
def c4_structural_headings(spark, sf):
    return _rows(spark, sf).select("ord", F.md5(tx.structural_headings(F.col("text"))).alias("text_md5"))


@query
def c5_drop_sections(spark, sf):
    return _rows(spark, sf).select("ord", F.md5(tx.drop_sections(F.col("text"), ["Context", "Open questions", "Scope"])).alias("text_md5"))


@query
def c6_sectionize(spark, sf):
    return sections.sectionize(_docs(spark, sf).select("id", "title", "text"), limit=120).select("id", "parent_id", "section_index", "section_title", F.md5("text").alias("text_md5"))


@query
def c7_section_hint(spark, sf):
    rules = {"Decision": "adr_decision_reasoning", "broker": "messaging_event_driven", "cost": "system_design"}
    return _rows(spark, sf).select("ord", sections.section_hint(F.coalesce("section_title", "title"), rules).alias("hint"))


@query
def c8_chunks(spark, sf):
    c = sections.chunk(_docs(spark, sf).select("id", "text"), target=100)
    return c.select("chunk_id", "id", "chunk_index", "total_chunks", "tokens", F.md5("text").alias("text_md5"))


@query
def c9_text_scalars(spark, sf):
    t = F.col("text")
    return _rows(spark, sf).select("ord", F.md5(tx.normalized(t)).alias("normalized_md5"), tx.excerpt(t).alias("excerpt"), tx.content_hash(t).alias("content_sha256"), tx.dedup_key(t).alias("dedup_key"))


@query
def c11_prompt(spark, sf):
    return _samples(spark, sf).select("item_id", evaluation.prompt(F.col("scenario"), F.col("facts"), F.col("question")).alias("prompt"))


# --- sources ---------------------------------------------------------------------------------------------------------


@query
def s9_html_prose(spark, sf):
    return _rows(spark, sf).select("ord", F.md5(files.html_to_text(F.col("text"))).alias("text_md5"))


@query
def s11_content_type(spark, sf):
    p = F.col("relative_path")
    return _rows(spark, sf).select("ord", paths.content_type(p).alias("content_type"), paths.suffix(p).alias("suffix"), paths.stem(p).alias("stem"))


@query
def s12_path_rules(spark, sf):
    p = F.col("relative_path")
    inside = paths.allowed(p, ["adr/**", "guides/*.md", "**/*broker*.md"], ["**/*cost*", "*.txt"])
    return _rows(spark, sf).select("ord", inside.alias("allowed"), paths.allowed(p).alias("allowed_by_default"), paths.benchmark_path(p).alias("benchmark"))


@query
def s13_scoped_license(spark, sf):
    rules = [{"include_patterns": ["adr/*"], "license_id": "CC-BY-4.0"}, {"include_patterns": ["*"], "exclude_patterns": ["*broker*"], "license_id": "MIT", "training_enabled": False}]
    lic = paths.scoped_license(F.col("relative_path"), rules)
    return _rows(spark, sf).select("ord", lic["license_id"].alias("license_id"), lic["training_enabled"].alias("training_enabled"))


@query
def s14_title(spark, sf):
    return _rows(spark, sf).select("ord", tx.title(F.col("text"), F.lit("some_file-name")).alias("title"))


@query
def s20_source_inventory(spark, sf):
    """The rows stand for files of their length."""
    return files.volume(_rows(spark, sf).select("source_id", F.octet_length("text").alias("length")))


@query
def s20_inventory_of_allowed(spark, sf):
    p = F.col("relative_path")
    rows = _rows(spark, sf).filter(paths.allowed(p))
    return files.volume(rows.select("source_id", F.octet_length("text").alias("length")))


# --- gates -----------------------------------------------------------------------------------------------------------


@query
def f1_quality_gate(spark, sf):
    r = scoring.gate_reasons(F.col("text"), F.col("language"), F.col("source_id"), chars=300, least_words=60, symbols=0.05)
    return _rows(spark, sf).select("ord", F.array_join(r, ";").alias("reasons"))


@query
def f2_accepted(spark, sf):
    r = scoring.gate_reasons(F.col("text"), F.col("language"), F.col("source_id"))
    return _rows(spark, sf).select((F.size(r) == 0).alias("accepted")).groupBy("accepted").agg(F.count("*").alias("documents"))


@query
def f3_domain_relevance(spark, sf):
    r = scoring.domain_relevance(F.coalesce("relative_path", "id"), F.col("title"), F.col("text"))
    return _rows(spark, sf).select("ord", r["relevant"].alias("relevant"), r["category"].alias("category"))


@query
def f4_reasoning_relevance(spark, sf):
    r = scoring.reasoning_relevance(F.col("text"))
    return _rows(spark, sf).select("ord", *[r[c].alias(c) for c in ("score", "passed", "link_ratio", "prose_density", "signals")])


@query
def f5_fixtures(spark, sf):
    return _rows(spark, sf).filter((F.col("source_id") == "test_fixtures_local") | (F.coalesce(F.col("metadata")["is_test_fixture"], F.lit("")) != "")).select("ord")


@query
def f7_code_share(spark, sf):
    r = scoring.code_share(F.col("text"), most=0.2)
    return _rows(spark, sf).select("ord", *[r[c].alias(c) for c in ("total_tokens", "code_tokens", "prose_tokens", "code_ratio", "dominated")])


@query
def f8_combined_gate(spark, sf):
    parts = _docs(spark, sf).select("id", "source_id", "relative_path", F.col("title").alias("section_title"), "text")
    g = pipelines.gate_sections(parts, pipelines.FreezeSettings())
    return g.select("id", "quality_score", "relevance_score", "code_ratio", "tokens", F.array_join("reasons", ";").alias("reasons"))


@query
def f9_enabled_sources(spark, sf):
    own = _sources(spark, sf).filter("enabled").select(F.col("id").alias("source_id"))
    return _rows(spark, sf).join(own, "source_id", "left_semi").select("ord")


@query
def f10_license_of(spark, sf):
    d = _rows(spark, sf).select("ord", F.concat_ws("\n", F.lit("Released under"), "license_id", F.when(F.col("ord") % 3 == 0, "Creative Commons Attribution 4.0"), F.when(F.col("ord") % 5 == 0, "the MIT License"), "title").alias("t"))
    return d.select("ord", scoring.license_of(F.col("t")).alias("license"))


@query
def f13_invalid_records(spark, sf):
    p = problems(_rows(spark, sf).withColumn("source_id", F.when(F.col("ord") % 7 == 0, F.concat(F.lit(" "), "source_id")).otherwise(F.col("source_id"))))
    return p.filter(F.size("problems") > 0).select("ord", F.array_join("problems", ";").alias("problems"))


@query
def f14_sample_problems(spark, sf):
    s = _samples(spark, sf).withColumn("id", F.when(F.col("item_id") % 10 == 0, "arch-eval-0001").otherwise(F.col("id"))).withColumn("question", F.when(F.col("item_id") % 9 == 0, " ?").otherwise(F.col("question")))
    return evaluation.sample_problems(s).select("item_id", F.array_join("problems", ";").alias("problems"))


@query
def f17_batch_problems(spark, sf):
    """Sequences of which some are made bad: too short labels, a token out of range, no label at all."""
    n = F.col("sequence")
    bad = _stream(spark, sf).withColumn("labels", F.when(n % 7 == 1, F.slice("labels", 1, 5)).when(n % 7 == 3, F.transform("labels", lambda t: F.lit(-100).cast("bigint"))).otherwise(F.col("labels")))
    bad = bad.withColumn("input_ids", F.when(n % 7 == 2, F.transform("input_ids", lambda t: t - 100_001)).otherwise(F.col("input_ids")))
    return sequence.batch_problems(bad, 100_000)


# --- scalar functions ------------------------------------------------------------------------------------------------


@query
def x1_quality(spark, sf):
    q = scoring.quality(F.col("text"))
    return _rows(spark, sf).select("ord", q["score"].alias("score"), q["bucket"].alias("bucket"), F.array_join(q["reasons"], ";").alias("reasons"), q["technical"].alias("technical"), q["prose"].alias("prose"))


@query
def x2_token_count(spark, sf):
    return _rows(spark, sf).select("ord", scoring.python_tokens(F.col("text")).alias("tokens"))


@query
def x3_token_ids(spark, sf):
    return _rows(spark, sf).select("ord", F.md5(F.array_join(hashing.token_ids(tx.words(F.col("text"))).cast("array<string>"), ",")).alias("ids_md5"))


@query
def x6_shingles(spark, sf):
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    s = hashing.shingles(w, 5, 100)
    return _rows(spark, sf).select("ord", F.size(s).alias("shingles"), F.md5(F.array_join(F.array_sort(s), "|")).alias("shingles_md5"))


@query
def x8_signatures(spark, sf):
    """Of the reference's parameters, as in the SQL."""
    s = REFERENCE.signatures(_docs(spark, sf).select("id", "text"))
    return s.select("id", F.md5(F.array_join("signature", ",")).alias("signature_md5"))


@query
def x11_hash_scores(spark, sf):
    return _rows(spark, sf).select("ord", hashing.score32(F.col("id")).alias("score32"), hashing.score64(F.col("id")).alias("score64"))


@query
def x13_normalize_concept(spark, sf):
    none = lambda c: F.coalesce(c, F.array().cast("array<string>"))
    c = _rows(spark, sf).select(F.explode(F.concat(none("related_concepts"), none("candidate_concepts"), F.array("category", "title"))).alias("label")).filter("label is not null").distinct()
    return c.select("label", semantic.normalize_concept(F.col("label")).alias("concept"))


@query
def x15_concepts(spark, sf):
    t = F.col("text")
    return _rows(spark, sf).select("ord", F.array_join(semantic.concepts(t), ",").alias("concepts"), F.array_join(semantic.candidates(t), ",").alias("candidates"))


@query
def x16_classify(spark, sf):
    found = _rows(spark, sf).withColumn("found", semantic.concepts(F.col("text")))
    c = semantic.classify(F.col("text"), F.col("found"), F.col("category_hint"))
    return found.select("ord", c["category"].alias("primary_category"), c["confidence"].alias("confidence"))


def _responses(spark, sf) -> DataFrame:
    """Every page that has a category as the response to one of the samples of that category, which are dealt out by the
    page's number."""
    samples = _samples(spark, sf).select("item_id", "category", "difficulty", "scenario", "question", "facts")
    place = F.row_number().over(Window.partitionBy("category").orderBy("item_id")) - 1
    dealt = samples.withColumn("place", place).withColumn("of", F.count("*").over(Window.partitionBy("category")))
    sizes = F.broadcast(dealt.select("category", "of").distinct())  # one row per category of the benchmark
    pages = table(spark, sf, "documents").select("doc_id", "category", F.col("text").alias("response")).join(sizes, "category").withColumn("place", F.pmod("doc_id", "of"))
    return pages.drop("of").join(F.broadcast(dealt.drop("of")), ["category", "place"]).drop("place")  # the benchmark's samples, some hundred rows


def _evaluated(spark, sf) -> DataFrame:
    """Scores of the responses; a sample without facts lacks information."""
    missing = F.col("facts").isNull()
    r = evaluation.rubric(F.col("response"), F.col("facts"), missing)
    acknowledged = r["clarification_awareness"] == 0.9
    return _responses(spark, sf).select("doc_id", "item_id", "category", "difficulty", *[c.alias(k) for k, c in r.items()], missing.alias("missing_info"), acknowledged.alias("acknowledged"))


@query
def x18_rubric(spark, sf):
    return _evaluated(spark, sf).drop("missing_info", "acknowledged")


@query
def x19_repetition(spark, sf):
    return table(spark, sf, "documents").select("doc_id", evaluation.repeats(F.col("text")).alias("repeats"))


def _echo_pairs(spark, sf) -> DataFrame:
    """The responses with their prompts; every third one repeats its prompt at the end."""
    prompt = F.concat_ws(" ", "scenario", "question")
    echo = F.when(F.col("doc_id") % 3 == 0, prompt)
    score = evaluation.rubric(F.col("response"), F.col("facts"))["overall"]
    scored = _responses(spark, sf).withColumn("score", score)
    return scored.select("doc_id", prompt.alias("prompt"), F.concat_ws(" ", "response", echo).alias("response"), "score")


@query
def x20_prompt_echo(spark, sf):
    return _echo_pairs(spark, sf).select("doc_id", evaluation.echoes(F.col("response"), F.col("prompt")).alias("echo"))


@query
def x21_organization(spark, sf):
    return _rows(spark, sf).select("ord", analytics.organization().alias("organization"))


@query
def x23_license_concerns(spark, sf):
    return _sources(spark, sf).select("id", F.array_join(analytics.license_concerns(F.col("license_review_status")), ";").alias("concerns"))


# --- duplicates ------------------------------------------------------------------------------------------------------


@query
def d1_exact_duplicates(spark, sf):
    return dedup.exact_duplicates(_rows(spark, sf).select("ord", "id", "text"), [F.col("ord")]).select("ord", "canonical", "kept")


@query
def d2_ranked_duplicates(spark, sf):
    d = _rows(spark, sf).select("ord", "id", "text", F.coalesce("quality_score", F.lit(0.0)).alias("score"))
    return dedup.exact_duplicates(d, [-F.col("score"), F.col("id"), F.col("ord")]).select("ord", "canonical", "kept")


@query
def d4_near_pairs(spark, sf):
    """Of the reference's parameters, as in the SQL; `d8_near_duplicates` compares whole texts."""
    n = REFERENCE
    s = materialize(n.signatures(_docs(spark, sf).select("id", "text")), "signatures")
    first = s.groupBy("signature").agg(F.min("id").alias("id")).select("id", "signature")
    return n.edges(n.candidates(n.buckets(first)), first)


@query
def d8_near_duplicates(spark, sf):
    return NearDuplicates().run(materialize(_docs(spark, sf).select("id", "text", F.col("quality_score").alias("score")), "documents"))


def _concept_links(docs) -> DataFrame:
    """Links of a document's source with every one of its concepts under its license."""
    each = docs.select("source_id", "license_id", F.explode("related_concepts").alias("concept"))
    return each.select(F.concat(F.lit("s:"), "source_id").alias("u"), F.concat(F.lit("c:"), "concept", F.lit("/"), "license_id").alias("v"))


@query
def d6_components(spark, sf):
    return merge_components(None, _concept_links(_docs(spark, sf)).filter("v is not null"))


@query
def d9_contamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    s = _samples(spark, sf).select(F.col("item_id").alias("sample_id"), F.concat_ws(" ", "scenario", "question").alias("text"))
    return dedup.contamination(docs, s, threshold=0.05)


@query
def d11_leakage(spark, sf):
    return dedup.leakage(_rows(spark, sf).select("id", "text", split.three_way(F.col("ord").cast("string")).alias("split")))


#: The sources that are compared.
EDITIONS = ["beacon_design_wiki", "mesh_proposals"]
CRAWLS = ["early", "late"]


@query
def d12_cross_source(spark, sf):
    """Section titles that both sources have, as in the SQL; `d12_cross_editions` compares the texts."""
    d = _docs(spark, sf).select("source_id", "tokens", F.md5("section_title").alias("content_sha256"))
    return dedup.shared_hashes(d, EDITIONS)


@query
def d12_cross_editions(spark, sf):
    """Whole texts that two crawls, before and from June on, both hold, and clusters of near duplicates that span the two."""
    edition = F.when(F.col("crawled_at") < F.lit("2025-06-01").cast("timestamp"), "early").otherwise("late")
    d = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), edition.alias("source_id"), "text", scoring.python_tokens(F.col("text")).alias("tokens"), F.lit(0.0).alias("score"))
    same = dedup.shared_hashes(d.withColumn("content_sha256", tx.content_hash(F.col("text"))), CRAWLS)
    near = dedup.shared_clusters(d, NearDuplicates().run(materialize(d.select("id", "text", "score"), "editions")), CRAWLS)
    kind = lambda f, name, key: f.select(F.lit(name).alias("kind"), F.col(key).alias("key"), "documents", "tokens_saved")
    return kind(same, "text", "content_sha256").unionByName(kind(near, "cluster", "cluster"))


# --- aggregates ------------------------------------------------------------------------------------------------------


@query
def a3_token_distribution(spark, sf):
    return analytics.token_distribution(_docs(spark, sf))


@query
def a5_token_totals(spark, sf):
    return analytics.token_totals(_docs(spark, sf).withColumn("organization", analytics.organization()))


@query
def a6_concentration(spark, sf):
    d = _docs(spark, sf).withColumn("organization", analytics.organization())
    return analytics.concentration(d, {"ai_agent_architecture": 0.1, "system_design": 0.01}).withColumn("warnings", F.array_join("warnings", ";"))


@query
def a7_cap_status(spark, sf):
    return analytics.cap_status(_docs(spark, sf).withColumn("organization", analytics.organization()), {"source_id": 0.05, "category": 0.4, "organization": 0.4})


@query
def a8_source_quality(spark, sf):
    q = scoring.quality(F.col("text"))
    return analytics.source_quality(_docs(spark, sf).select("source_id", q["score"].alias("score"), q["bucket"].alias("bucket")))


@query
def a9_length_percentiles(spark, sf):
    return sequence.length_percentiles(_docs(spark, sf).select("tokens"))


@query
def a10_context_fit(spark, sf):
    return sequence.context_fit(_docs(spark, sf).select("tokens"), (128, 256, 512, 1024, 2048, 4096))


@query
def a11_category_coverage(spark, sf):
    return analytics.category_coverage(_docs(spark, sf))


@query
def a12_concept_coverage(spark, sf):
    return analytics.concept_coverage(_docs(spark, sf), tokens=10_000, sources=30, dominant=0.1).withColumn("status", F.array_join("status", ";"))


@query
def a13_concept_matrix(spark, sf):
    return analytics.concept_matrix(_docs(spark, sf))


@query
def a14_candidates(spark, sf):
    return analytics.candidate_report(_docs(spark, sf)).withColumn("sample_ids", F.array_join("sample_ids", ","))


@query
def a15_capacity(spark, sf):
    return analytics.capacity(_docs(spark, sf), _sources(spark, sf), {c: 0.1 for c in [*V.CATEGORIES[:9], "robotics"]}, 2_000_000)


@query
def a15_capped_sources(spark, sf):
    return analytics.capped_sources(_docs(spark, sf), _sources(spark, sf), 5_000)


@query
def a16_rejection_reasons(spark, sf):
    r = scoring.gate_reasons(F.col("text"), F.col("language"), F.col("source_id"), chars=300, least_words=60, symbols=0.05)
    return analytics.reasons_by_source(_rows(spark, sf).select("source_id", r.alias("reasons")))


@query
def a17_rarity(spark, sf):
    return analytics.rarity(_docs(spark, sf))


@query
def a19_source_audit(spark, sf):
    rows = _rows(spark, sf)
    marked = dedup.exact_duplicates(rows, [F.col("ord")]).withColumn("decision", F.when(F.col("kept"), "kept").otherwise("exact_duplicate"))
    kept = marked.filter("kept").withColumn("tokens", scoring.python_tokens(F.col("text")))
    return analytics.source_audit(_sources(spark, sf), rows, marked, kept)


@query
def a20_license_audit(spark, sf):
    return analytics.license_audit(_docs(spark, sf))


@query
def a21_diagnostics(spark, sf):
    return pipelines.diagnostics(_sources(spark, sf))


@query
def a22_sample_distribution(spark, sf):
    s = _samples(spark, sf)
    by = lambda c: s.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("samples")).select(F.lit(c).alias("dimension"), "value", "samples")
    return by("category").unionByName(by("difficulty"))


@query
def a23_benchmark_scores(spark, sf):
    e = _evaluated(spark, sf)
    scores = F.create_map(*[x for d in evaluation.DIMENSIONS for x in (F.lit(d), F.col(d))])
    dims = e.select(F.explode(scores).alias("value", "score")).groupBy("value").agg(analytics.exact_mean(F.col("score")).alias("mean")).select(F.lit("dimension").alias("by"), "value", "mean")
    by = lambda c: e.groupBy(F.col(c).alias("value")).agg(analytics.exact_mean(F.col("overall")).alias("mean")).select(F.lit(c).alias("by"), "value", "mean")
    rates = e.agg(analytics.exact_mean(F.col("overall")).alias("overall"), F.round(F.avg((F.col("claims") > 0).cast("double")), 4).alias("claim_rate"), F.round(F.avg((F.col("revisits") > 0).cast("double")), 4).alias("revisit_rate"))
    total = rates.select(F.lit("all").alias("by"), F.explode(F.create_map(F.lit("overall"), F.col("overall"), F.lit("claim_rate"), F.col("claim_rate"), F.lit("revisit_rate"), F.col("revisit_rate"))).alias("value", "mean"))
    return by("category").unionByName(by("difficulty")).unionByName(dims).unionByName(total)


@query
def a23_failure_modes(spark, sf):
    return evaluation.failure_modes(_evaluated(spark, sf), ["doc_id", "item_id"]).withColumn("reasons", F.array_join("reasons", ";"))


@query
def w8_worst_responses(spark, sf):
    return evaluation.worst(_evaluated(spark, sf).select("doc_id", "item_id", "overall"), ["doc_id", "item_id"])


@query
def j4_review_export(spark, sf):
    e = _evaluated(spark, sf).select("doc_id", "item_id", "overall", "claims")
    outputs = table(spark, sf, "documents").select("doc_id", F.md5("text").alias("response_md5"))
    scored = e.join(_samples(spark, sf).select("item_id", "question", "difficulty"), "item_id")
    return evaluation.review_export(scored.select("doc_id", "item_id", "question", "difficulty"), outputs, e.select("doc_id", "overall", "claims"), "doc_id")


@query
def j6_incomplete_runs(spark, sf):
    """Every sample needs a response and a score; scores of easy samples are held back."""
    e = _evaluated(spark, sf)
    return evaluation.incomplete(_samples(spark, sf), e, e.filter("difficulty <> 'easy'"), "item_id").withColumn("missing", F.array_join("missing", ";"))


def _metrics(e: DataFrame) -> DataFrame:
    names = [*evaluation.DIMENSIONS, "overall"]
    row = e.agg(*[analytics.exact_mean(F.col(n)).alias(n) for n in names])
    return row.select(F.explode(F.create_map(*[x for n in names for x in (F.lit(n), F.col(n))])).alias("metric", "value"))


@query
def o11_comparison(spark, sf):
    """Responses to hard samples against those to easy ones."""
    e = _evaluated(spark, sf)
    return evaluation.comparison(_metrics(e.filter("difficulty = 'easy'")), _metrics(e.filter("difficulty = 'hard'")))


@query
def a24_behaviour(spark, sf):
    return evaluation.behaviour(_echo_pairs(spark, sf))


@query
def a25_regressions(spark, sf):
    base = _echo_pairs(spark, sf)
    worse = base.withColumn("response", F.concat_ws(" ", "prompt", "prompt")).withColumn("score", F.lit(0.3))
    return evaluation.regressions(evaluation.behaviour(base), evaluation.behaviour(worse)).withColumn("failures", F.array_join("failures", ";"))


@query
def a26_fingerprint(spark, sf):
    return analytics.fingerprint(_docs(spark, sf), "curated")


@query
def a27_corpus_hash(spark, sf):
    return analytics.corpus_hash(_docs(spark, sf))


@query
def a29_manifest(spark, sf):
    d = _docs(spark, sf)
    return pipelines.manifest(pipelines.Result(d.withColumn("split", split.three_way(split.group_key(d))), d))


@query
def f15_preflight(spark, sf):
    targets = {c: 0.1 for c in [*V.CATEGORIES[:9], "robotics"]}
    return balance.preflight_violations(_docs(spark, sf), _sources(spark, sf), targets, 600_000)


@query
def f16_violations(spark, sf):
    d = _docs(spark, sf).withColumn("content_sha256", tx.dedup_key(F.col("text")))
    return balance.selection_violations(d, {c: 0.1 for c in V.CATEGORIES}, 200_000, max_source_share=0.05)


@query
def x17_annotation(spark, sf):
    a = semantic.annotate(_rows(spark, sf).select("ord", "text", "category_hint"))
    return a.select("ord", F.array_join("related_concepts", ",").alias("related_concepts"), F.array_join("candidate_concepts", ",").alias("candidate_concepts"), "primary_category", "category_confidence")


@query
def a28_packing_statistics(spark, sf):
    return sequence.packing_statistics(_stream(spark, sf))


def _readiness(spark, sf) -> DataFrame:
    d = _rows(spark, sf).select("id", "text", "source_id", "category", "language", "source_url", "license_id", "metadata", split.three_way(F.col("ord").cast("string")).alias("split"))
    whole = F.concat_ws(" ", "scenario", "question", F.array_join("facts", " "), F.array_join("expected_considerations", " "))
    s = _samples(spark, sf).select(whole.alias("text"), F.array("scenario", "question").alias("passages"))
    return pipelines.readiness(d, s).withColumn("blockers", F.array_join("blockers", ";"))


@query
def a30_readiness(spark, sf):
    """The columns of the SQL; `a30_readiness_reverse` has the reverse metric too."""
    return _readiness(spark, sf).drop("benchmark_samples")


@query
def a30_readiness_reverse(spark, sf):
    return _readiness(spark, sf)


# --- order, selection, splits ----------------------------------------------------------------------------------------


@query
def w3_review_sample(spark, sf):
    return analytics.review_sample(_docs(spark, sf), V.CATEGORIES)


@query
def w4_audit_sample(spark, sf):
    return sequence.stratified_head(_samples(spark, sf), "difficulty", "item_id", {"easy": 5, "medium": 10, "hard": 10}).select("item_id", "difficulty")


@query
def w5_merge_sections(spark, sf):
    d = _docs(spark, sf)
    parts = sections.sectionize(d.select("id", "title", "text"), limit=60).join(d.select(F.col("id").alias("parent_id"), "source_id", F.coalesce("category_hint", "category").alias("category_hint")), "parent_id")
    m = sections.merge_sections(parts.withColumnRenamed("parent_id", "relative_path"), limit=200)
    return m.select("id", "relative_path", "primary_category", F.array_join("related_concepts", ",").alias("concepts"), F.array_join("section_ids", ",").alias("section_ids"), F.md5("text").alias("text_md5"))


@query
def w6_select_budget(spark, sf):
    docs = _docs(spark, sf)
    rare = analytics.document_rarity(docs)
    d = docs.join(rare, "id", "left").withColumn("rarity", F.coalesce("rarity", F.lit(10_000))).withColumn("score", F.coalesce("quality_score", F.lit(0.0)))
    return balance.select_budget(d.select("id", "source_id", "category", "tokens", "rarity", "score"), {c: 0.1 for c in V.CATEGORIES}, 200_000, _sources(spark, sf)).select("id", "decision")


@query
def w7_balance(spark, sf):
    d = _docs(spark, sf).select("id", "source_id", "category", analytics.organization().alias("organization"), "tokens", F.col("quality_score").alias("score"))
    return balance.balance(d, {"source_id": 0.04, "category": 0.2, "organization": 0.04}).select("id", "kept")


def _stream(spark, sf) -> DataFrame:
    return sequence.pack_stream(_docs(spark, sf).select("id", "text"), 2048)


@query
def w10_pack_stream(spark, sf):
    return _stream(spark, sf).select("sequence", F.md5(F.array_join("input_ids", ",")).alias("ids_md5"), F.size(F.filter("labels", lambda x: x == -100)).alias("padding"))


@query
def split_two_way(spark, sf):
    return split.two_way(_docs(spark, sf).select("id"), 0.9)


@query
def split_three_way(spark, sf):
    d = _docs(spark, sf)
    return d.select("id", split.three_way(split.group_key(d)).alias("split"))


@query
def split_clusters(spark, sf):
    near = NearDuplicates().run(materialize(_docs(spark, sf).select("id", "text", F.col("quality_score").alias("score")), "documents"))
    return near.select("id", "cluster", F.when(hashing.score64(F.col("cluster")) < 0.95, "train").otherwise("validation").alias("split"))


@query
def u2_set_operations(spark, sf):
    d = _rows(spark, sf)
    a, b = d.filter("ord % 2 = 0").select("source_id").distinct(), d.filter("ord % 3 = 0").select("source_id").distinct()
    tag = lambda f, name: f.select(F.lit(name).alias("operation"), "source_id")
    return tag(a.intersect(b), "intersect").unionByName(tag(a.exceptAll(b), "except")).unionByName(tag(a.union(b).distinct(), "union"))


@query
def j1_policy_join(spark, sf):
    s = _sources(spark, sf).select(F.col("id").alias("source_id"), "source_priority", "release_eligible").withColumnRenamed("source_priority", "priority")
    return _docs(spark, sf).select("id", "source_id", F.coalesce("quality_score", F.lit(0.0)).alias("quality"), "tokens").join(s, "source_id", "left")


__all__ = ["QUERIES", "SQL"]
