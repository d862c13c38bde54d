import random

import pytest
from pyspark.sql import functions as F

from millrace import runtime
from millrace.operators import analytics, balance, dedup, evaluation, sections, sequence, split
from millrace.operators.components import merge_components
from millrace.operators.neardup import NearDuplicates
from millrace.plans import pipelines, queries
from millrace.runtime import lookup, numbered, running_totals


def test_running_totals_over_a_hot_group(spark):
    rng = random.Random(5)
    rows = [(("hot" if i % 3 else f"k{i % 7}"), i, rng.randint(0, 9)) for i in range(400)]
    d = spark.createDataFrame(rows, "k string, i long, v long").repartition(7)
    got = {r.i: r.t for r in running_totals(d, ["k"], [F.col("i")], {"t": F.col("v")}).collect()}
    sums: dict[str, int] = {}
    for k, i, v in rows:
        sums[k] = sums.get(k, 0) + v
        assert got[i] == sums[k]


def test_exact_duplicates(spark):
    rows = [(1, "a", "x  y"), (2, "b", "x y"), (3, "c", "X y"), (4, "d", None), (5, "e", None), (6, "f", "x\ny ")]
    got = {r.ord: (r.canonical, r.kept) for r in dedup.exact_duplicates(spark.createDataFrame(rows, "ord long, id string, text string"), [F.col("ord")]).collect()}
    assert got == {1: ("a", True), 2: ("a", False), 3: ("c", True), 4: ("d", True), 5: ("d", False), 6: ("a", False)}


def test_components_of_chains_stars_and_strangers(spark):
    links = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)] + [("hub", f"s{i}") for i in range(50)] + [("x", "x"), (None, "y"), ("z", None)]
    got = {r.node: r.component for r in merge_components(None, spark.createDataFrame(links, "u string, v string")).collect()}
    assert {got[f"n{i:03d}"] for i in range(61)} == {"n000"} and {got[f"s{i}"] for i in range(50)} == {"hub"}
    assert got["x"] == "x" and got["y"] == "y" and got["z"] == "z"


def test_near_duplicates(spark):
    base = " ".join(f"word{i}" for i in range(200))
    near = base.replace("word100", "other")
    rows = [("a", base, 0.1), ("b", base, 0.9), ("c", near, 0.5), ("d", "quite another text about boats and nets and the tide", None), ("e", "", None), ("f", None, None)]
    for block in (1, 256):
        got = {r.id: r for r in NearDuplicates(block=block).run(spark.createDataFrame(rows, "id string, text string, score double")).collect()}
        assert {got[i].cluster for i in "abc"} == {"a"} and {got[i].canonical for i in "abc"} == {"b"} and got["d"].kept and got["d"].similarity is None
        assert got["b"].kept and not got["a"].kept and got["e"].cluster == got["f"].cluster


def test_near_duplicates_of_long_texts(spark):
    base = " ".join(f"word{i}" for i in range(3000))
    rows = [("a", base, 0.1), ("b", "first " + base, 0.9), ("c", " ".join(f"other{i}" for i in range(3000)), 0.5)]
    got = {r.id: r.cluster for r in NearDuplicates().run(spark.createDataFrame(rows, "id string, text string, score double")).collect()}
    assert got == {"a": "a", "b": "a", "c": "c"}


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for g in range(12):
        base = [f"w{g}_{i}" for i in range(120)]
        rows.append((f"g{g:02d}a", " ".join(base)))
        for v in range(4):  # each changed word takes five runs of 116: similarities about 0.73 to 0.96
            words = list(base)
            for i in rng.sample(range(5, 115), v % 3 + 1):
                words[i] = f"x{g}_{v}_{i}"
            rows.append((f"g{g:02d}v{v}", " ".join(words)))
    n = NearDuplicates()
    docs = spark.createDataFrame(rows, "id string, text string")
    got = {(r.id1, r.id2): r.similarity for r in n.verified(n.candidates(n.buckets(n.signatures(docs))), docs).collect()}
    runs = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in rows}
    want = {(a, b): len(runs[a] & runs[b]) / len(runs[a] | runs[b]) for a in runs for b in runs if a < b}
    want = {k: v for k, v in want.items() if v >= 0.8}
    assert got == pytest.approx(want) and any(v < 0.85 for v in want.values())
    kept = NearDuplicates().run(docs.withColumn("score", F.lit(0.5)))
    assert {r.cluster for r in kept.collect()} <= {f"g{g:02d}a" for g in range(12)} | {i for i, _ in rows if not any(i in k for k in want)}


def test_texts_and_clusters_of_two_sources(spark):
    sources = ["one", "two"]
    rows = [("a", "one", "x", 5), ("b", "two", "x", 4), ("c", "three", "x", 9), ("d", "one", "y", 1), ("e", "one", "y", 1)]
    d = spark.createDataFrame(rows, "id string, source_id string, content_sha256 string, tokens long")
    assert [tuple(r) for r in dedup.shared_hashes(d, sources).collect()] == [("x", 2, 4)]
    near = spark.createDataFrame([("a", "a", True), ("b", "a", False), ("c", "c", True), ("d", "c", False), ("e", "e", True)], "id string, cluster string, kept boolean")
    assert [tuple(r) for r in dedup.shared_clusters(d, near, sources).collect()] == [("a", 2, 4)]
    assert dedup.shared_clusters(d, near.withColumn("cluster", F.lit("a")), sources).count() == 0


def test_links_of_all_concepts(spark):
    d = spark.createDataFrame([("s1", "MIT", ["a", "b"]), ("s2", "MIT", ["c", "b"]), ("s3", None, ["a"]), ("s4", "MIT", None)], "source_id string, license_id string, related_concepts array<string>")
    got = {r.node: r.component for r in merge_components(None, queries._concept_links(d).filter("v is not null")).collect()}
    assert set(got) == {"s:s1", "s:s2", "c:a/MIT", "c:b/MIT", "c:c/MIT"} and len(set(got.values())) == 1


def test_readiness_finds_parts_of_samples(spark):
    samples = [("One team runs a shop on two servers. Which store fits the orders?", ["One team runs a shop on two servers.", "Which store fits the orders?"]), ("Quite another item. Why so?", ["Quite another item.", "Why so?"]), (" ", None)]
    texts = ["runs a shop\non TWO servers", "Which store fits the orders?", "servers. Which", "a page about boats", "He asked: (Which store fits the orders?) and left", "hm, why so?", None, " "]
    docs = spark.createDataFrame([(str(i), t, "s", "c", "en", "u", "l", "train") for i, t in enumerate(texts)], "id string, text string, source_id string, category string, language string, source_url string, license_id string, split string")
    items = spark.createDataFrame(samples, "text string, passages array<string>")
    row = pipelines.readiness(docs, items).first()
    assert row.benchmark_documents == 3 and row.benchmark_samples == 2 and "benchmark_contamination" in row.blockers
    row = pipelines.readiness(docs.filter("id = '3'"), items).first()
    assert (row.benchmark_documents, row.benchmark_samples, row.blockers) == (0, 0, [])
    assert pipelines.readiness(docs, items.limit(0)).first().benchmark_documents == 0


def test_contamination_equals_brute_force(spark):
    docs = [(1, "a b c d e f g"), (2, "q r"), (3, None), (4, ""), (5, "a b c d x y z")]
    samples = [(1, "a b c d e f g h"), (2, "q r")]
    got = {(r.doc_id, r.sample_id): r.jaccard for r in dedup.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(samples, "sample_id long, text string"), 0.1).collect()}

    def grams(t):
        w = (t or "").lower().split()
        return {" ".join(w)} - {""} if len(w) < 4 else {" ".join(w[i : i + 4]) for i in range(len(w) - 3)}

    want = {(i, j): len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for i, a in docs for j, b in samples if grams(a) & grams(b)}
    assert got == pytest.approx({k: round(v, 4) for k, v in want.items() if v >= 0.1})


def test_splits(spark):
    ids = [f"doc-{i}" for i in range(20)]
    a = {r.id: r.split for r in split.two_way(spark.createDataFrame([(i,) for i in ids], "id string"), 0.8).collect()}
    b = {r.id: r.split for r in split.two_way(spark.createDataFrame([(i,) for i in reversed(ids)], "id string").repartition(3), 0.8).collect()}
    assert a == b and len(a) == 20
    assert [r.split for r in split.two_way(spark.createDataFrame([("x",)], "id string")).collect()] == ["train"]
    assert split.two_way(spark.createDataFrame([], "id string")).count() == 0
    two = [r.split for r in split.two_way(spark.createDataFrame([("x",), ("y",)], "id string"), 0.999).collect()]
    assert sorted(two) == ["train", "validation"]
    with pytest.raises(ValueError):
        split.three_way(F.col("id"), 0.5, 0.1, 0.1)
    g = spark.createDataFrame([("a", {"provenance_group_id": "g"}), ("b", {"provenance_group_id": "g"}), ("c", None)], "id string, metadata map<string,string>")
    s = {r.id: r.split for r in g.select("id", split.three_way(split.group_key(g), seed=3).alias("split")).collect()}
    assert s["a"] == s["b"] and len(s) == 3


def test_lengths(spark):
    d = spark.createDataFrame([(c,) for c in range(100, 1001, 100)], "tokens long")
    r = sequence.length_percentiles(d).first()
    assert (r.min_tokens, r.max_tokens, r.median, r.mean_tokens) == (100, 1000, 500, 550.0)
    r = sequence.context_fit(spark.createDataFrame([(c,) for c in (500, 1000, 1500, 2500, 3000)], "tokens long"), [2048]).first()
    assert (r.fitting_pct, r.splitting_pct, r.sequences) == (60.0, 40.0, 7)


def test_packed_stream_keeps_every_token(spark):
    docs = spark.createDataFrame([("b", "one two three"), ("a", "four " * 70), ("c", ""), ("d", None)], "id string, text string")
    rows = sequence.pack_stream(docs, 32).orderBy("sequence").collect()
    stream = [t for r in rows for t, m in zip(r.input_ids, r.attention_mask, strict=True) if m]
    assert len(stream) == 70 + 1 + 3 + 1 and stream[70] == 0 and all(len(r.input_ids) == 32 for r in rows)
    assert [x for r in rows for x in r.labels][len(stream) :] == [-100] * (32 * len(rows) - len(stream))
    assert sequence.packing_statistics(sequence.pack_stream(docs, 32)).first().packed_tokens == 75
    assert sequence.pack_stream(docs.limit(0), 32).count() == 0
    assert sequence.batch_problems(sequence.pack_stream(docs, 32), 5).count() > 0


def test_sections_and_chunks(spark):
    text = "# One\n\n" + "a " * 40 + "\n\n" + "b " * 40 + "\n\n## Two\n\n" + "c " * 10
    d = spark.createDataFrame([("x", "T", text), ("y", "U", "short"), ("z", None, "")], "id string, title string, text string")
    got = sections.sectionize(d, limit=60).orderBy("parent_id", "section_index").collect()
    assert [(r.parent_id, r.section_title) for r in got] == [("x", "One"), ("x", "One"), ("x", "Two"), ("y", "U"), ("z", None)]
    assert got[3].id == "y" and len({r.id for r in got}) == 5
    c = sections.chunk(d, target=60).filter("id = 'x'").orderBy("chunk_index").collect()
    assert [r.chunk_id for r in c] == [f"x_chunk_{i:03d}" for i in range(1, len(c) + 1)] and "".join("".join(r.text.split()) for r in c) == "".join(text.split())


def test_merging_of_neighbours(spark):
    rows = [("one", 0, "consensus now"), ("two", 1, "consensus then"), ("far", 5, "consensus late"), ("odd", 6, "no subject")]
    d = spark.createDataFrame([(i, "s", "f.md", n, t, "system_design") for i, n, t in rows], "id string, source_id string, relative_path string, section_index int, text string, category_hint string")
    got = {r.id: r.section_ids for r in sections.merge_sections(d, 20).collect()}
    assert got["one"] == ["one", "two"] and got["far"] == ["far"]
    assert all(len(r.section_ids) == 1 for r in sections.merge_sections(d, 2).collect())


def test_a_document_is_counted_once_and_not_for_every_section(spark):
    d = spark.createDataFrame([("d", "t", "\n\n".join(f"# h{i}\n\n" + "word " * 40 for i in range(20)))], "id string, title string, text string")
    parts = sections.sectionize(d, 60)
    above = parts._jdf.queryExecution().optimizedPlan().toString().split("Generate posexplode")[0]
    assert "regexp_extract_all" not in above and parts.count() == 20


def test_sections_are_marked_once(spark):
    d = spark.createDataFrame([("a", "s", "f", 0, "consensus now", "x"), ("b", "s", "f", 1, "consensus then", "x")], "id string, source_id string, relative_path string, section_index int, text string, category_hint string")
    plan = sections.merge_sections(d, 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" not in plan and "LogicalRDD" not in plan  # the sections' own plan is not in there twice


def test_balance_lowers_concentration(spark):
    rows = [(f"a{i}", "s1", "c", "o", 100, 0.5 + 0.04 * i) for i in range(10)] + [(f"b{i}", f"t{i}", f"k{i}", f"p{i}", 100, 0.8) for i in range(4)]
    d = spark.createDataFrame(rows, "id string, source_id string, category string, organization string, tokens long, score double")
    caps = {"source_id": 0.5, "category": 0.5, "organization": 0.5}
    out = balance.balance(d, caps)
    kept = out.filter("kept")
    assert all(r.satisfied for r in analytics.cap_status(kept, caps).collect())
    removed = {r.id for r in out.filter("not kept").collect()}
    assert removed == set(balance.balance_exact(rows, caps)) == {f"a{i}" for i in range(6)}
    assert balance.balance(d.limit(0)).count() == 0
    one = analytics.concentration(spark.createDataFrame(rows[:2], d.schema)).first()
    assert (one.total_tokens, one.top_1_source_share, one.hhi_source_index) == (200, 1.0, 1.0)


def test_selection_respects_limits(spark):
    rows = [(f"d{i:03d}", f"s{i % 4}", "a" if i % 2 else "b", 100, i % 5, 0.5) for i in range(200)] + [("n", None, "a", None, 1, None), ("u", "s1", "other", 50, 0, 1.0)]
    d = spark.createDataFrame(rows, "id string, source_id string, category string, tokens long, rarity int, score double")
    got = balance.select_budget(d, {"a": 0.5, "b": 0.5}, 4000, max_source_share=0.4, slack=100)
    by = {r["category"]: r["t"] for r in got.filter("decision = 'selected'").groupBy("category").agg(F.sum("tokens").alias("t")).collect()}
    src = [r["t"] for r in got.filter("decision = 'selected'").groupBy("source_id").agg(F.sum("tokens").alias("t")).collect()]
    assert got.count() == len(rows) and max(src) <= 1600 and all(t <= 2040 for t in by.values()) and sum(by.values()) > 3000
    rules = {r.rule for r in balance.selection_violations(spark.createDataFrame([("x", "s", "a", 10, "h"), ("x", "s", "a", 10, "h")], "id string, source_id string, category string, tokens long, content_sha256 string"), {"a": 1.0}, 1000).collect()}
    assert rules == {"token_tolerance", "source_share", "duplicate_id", "duplicate_content"}


def test_coverage(spark):
    rows = [("a", "one", "f", 100, ["consensus"]), ("b", "one", "g", 100, ["consensus"]), ("c", "two", "h", 50, ["consensus"]), ("d", "two", "i", None, [])]
    d = spark.createDataFrame(rows, "id string, source_id string, relative_path string, tokens long, related_concepts array<string>").withColumn("primary_category", F.lit(None).cast("string")).withColumn("category", F.lit("x"))
    got = {r.concept: r for r in analytics.concept_coverage(d, tokens=10, dominant=0.6).collect()}
    assert len(got) == 34 and got["consensus"].status == ["HIGH_SOURCE_CONCENTRATION"] and got["saga"].status == ["NO_COVERAGE"]
    assert (got["consensus"].sources, got["consensus"].documents, got["consensus"].dominant_source) == (2, 3, "one")


def test_fingerprint_ignores_order(spark):
    rows = [(str(i), f"t{i}", None) for i in range(50)]
    d = spark.createDataFrame(rows, "id string, text string, license_id string")
    a, b = analytics.fingerprint(d).first()[0], analytics.fingerprint(d.orderBy(F.desc("id")).repartition(5)).first()[0]
    assert a == b != analytics.fingerprint(d.limit(49)).first()[0]


def test_rubric_and_behaviour(spark):
    claims = "Microservices are always required and NoSQL is always faster than SQL."
    r = evaluation.rubric(F.col("t"), F.col("f"))
    row = spark.createDataFrame([(claims, ["a pipeline of orders"]), ("", None)], "t string, f array<string>").select(*[c.alias(k) for k, c in r.items()]).collect()
    assert row[0].claims == 2 and row[0].unsupported_claim_avoidance == 0.0 and row[1].overall is not None
    prompt = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
    d = spark.createDataFrame([(prompt * 1, prompt, 0.8), ("short answer", prompt, 0.8), (None, prompt, 0.8)], "response string, prompt string, score double")
    assert [x[0] for x in d.select(evaluation.echoes(F.col("response"), F.col("prompt"))).collect()] == [True, False, False]
    assert [x[0] for x in d.select(evaluation.repeats(F.concat_ws(" ", "response", "response"))).collect()][0]
    good, bad = evaluation.behaviour(d.limit(0)), evaluation.behaviour(d)
    assert good.first().total == 0 and not evaluation.regressions(bad, bad).first().passed


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_without_broadcast(spark, how):
    rows = spark.createDataFrame([(("hot" if i % 3 else f"k{i % 7}") if i % 10 else None, i) for i in range(200)], "k string, i int")
    side = spark.createDataFrame([("hot", 1), ("k3", 2), ("none", 3)], "k string, v int")
    want = sorted(map(str, rows.join(side, "k", how).collect()))
    assert sorted(map(str, lookup(rows, side, ["k"], how, most=0).collect())) == sorted(map(str, lookup(rows, side, ["k"], how).collect())) == want
    assert lookup(rows.limit(0), side, ["k"], how, most=0).count() == 0


def test_numbered_rows(spark):
    d = spark.createDataFrame([("a", 5), ("b", 0), ("c", None), ("d", 1)], "k string, n int")
    got = sorted((r.k, r.i) for r in numbered(d, F.col("n"), "i", block=2).collect())
    assert got == [("a", i) for i in range(1, 6)] + [("d", 1)]


def test_exact_duplicates_of_a_hot_text(spark, monkeypatch):
    """A third of the rows share one text; the rows are joined by a shuffle, the hot text apart from the others."""
    rows = [(i, f"d{i:03d}", "same  text" if i % 3 == 0 else None if i % 50 == 1 else f"t{i // 4}", {"k": "v"}) for i in range(150)]
    d = spark.createDataFrame(rows, "ord long, id string, text string, metadata map<string,string>")
    plain = sorted((r.ord, r.canonical, r.kept) for r in dedup.exact_duplicates(d, [F.col("ord")]).collect())
    monkeypatch.setattr(runtime, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(runtime.attach, "__defaults__", (10,))
    spread = dedup.exact_duplicates(d, [F.col("ord")])
    assert sorted((r.ord, r.canonical, r.kept) for r in spread.collect()) == plain and len(plain) == 150
    assert set(spread.columns) == {*d.columns, "dedup_key", "kept", "canonical"}
    assert dedup.exact_duplicates(d.limit(0), [F.col("ord")]).count() == 0


def test_hash_of_a_large_set(spark):
    d = spark.range(500).select(F.sha2(F.col("id").cast("string"), 256).alias("h"))
    a = analytics.set_hash(d, most=50).first()[0]
    assert a == analytics.set_hash(d.repartition(7), most=50).first()[0] != analytics.set_hash(d.limit(499), most=50).first()[0]
    plain = analytics.set_hash(d, "x").first()[0]
    import hashlib

    assert plain == hashlib.sha256(("x" + "".join(sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(500)))).encode()).hexdigest()
    assert analytics.set_hash(d.limit(0)).first()[0] == hashlib.sha256(b"").hexdigest()
    docs = spark.createDataFrame([("a", "x", None), ("b", None, "MIT")], "id string, text string, license_id string")
    assert len(analytics.corpus_hash(docs).first()[0]) == 64


def test_stratified_head_of_a_hot_stratum(spark):
    d = spark.createDataFrame([(i, "easy" if i % 5 else "hard") for i in range(300)] + [(None, "easy"), (7, None)], "i int, level string")
    got = sorted((r.level, r.i) for r in sequence.stratified_head(d.filter("i is not null"), "level", "i", {"easy": 4, "hard": 2, "none": 3}).collect())
    assert got == [("easy", 1), ("easy", 2), ("easy", 3), ("easy", 4), ("hard", 0), ("hard", 5)]


def test_failures_completeness_and_comparison(spark):
    dims = {d: 0.9 for d in evaluation.DIMENSIONS}
    rows = [("good", 0.9, 0, False, False, dims), ("claims", 0.9, 2, None, None, dims), ("weak", 0.3, 0, True, False, {**dims, "tradeoff_quality": 0.1}), ("low", 0.4, 0, True, True, dims)]
    flat = [(i, o, c, m, a, *[ds[d] for d in evaluation.DIMENSIONS]) for i, o, c, m, a, ds in rows]
    e = spark.createDataFrame(flat, "id string, overall double, claims int, missing_info boolean, acknowledged boolean, " + ", ".join(f"{d} double" for d in evaluation.DIMENSIONS))
    got = {r.id: r.reasons for r in evaluation.failure_modes(e, ["id"]).collect()}
    assert got == {"claims": ["unsupported_claims"], "weak": ["weak_tradeoffs", "missed_information"], "low": ["low_score"]}
    assert [r.id for r in evaluation.worst(e, ["id"], 2).collect()] == ["weak", "low"]
    keys = lambda *k: spark.createDataFrame([(x,) for x in k], "id string")
    assert {r.id: r.missing for r in evaluation.incomplete(keys("a", "b", "b"), keys("a", "b"), keys("a", "c"), "id").collect()} == {"b": ["score"], "c": ["prompt", "output"]}
    assert evaluation.incomplete(keys("a"), keys("a"), keys("a"), "id").count() == 0
    review = evaluation.review_export(spark.createDataFrame([("good", "q")], "id string, question string"), spark.createDataFrame([("good", "r"), ("x", "r")], "id string, response string"), e.select("id", "overall"), "id").collect()
    assert [(r.id, r.question, r.response, r.audited) for r in review] == [("good", "q", "r", False)]
    m = lambda **k: spark.createDataFrame(list(k.items()), "metric string, value double")
    assert {r.metric: r.delta for r in evaluation.comparison(m(a=0.5, b=0.1), m(a=0.75)).collect()} == {"a": 0.25, "b": None}


def test_preflight_and_strict_freeze(spark):
    docs = spark.createDataFrame([("s1", "a", 100), ("s2", "a", 300), ("s9", "b", 50)], "source_id string, category string, tokens long")
    sources = spark.createDataFrame([("s1", 50), ("s2", None)], "id string, source_token_cap long")
    bad = {(r.rule, r.value) for r in balance.preflight_violations(docs, sources, {"a": 0.5, "b": 0.5}, 400).collect()}
    assert bad == {("eligible_tokens", "350"), ("category_floor", "b")}
    assert balance.preflight_violations(docs, sources, {"a": 0.5}, 300).count() == 0
    assert {r.rule for r in balance.preflight_violations(docs.limit(0), sources.limit(0), {"a": 1.0}, 10).collect()} == {"source_caps", "eligible_tokens", "category_floor"}
    with pytest.raises(ValueError, match="freeze refused: eligible_tokens"):
        pipelines._refuse(spark.createDataFrame([("eligible_tokens", "1")], "rule string, value string"), pipelines.FreezeSettings(strict=True))


def test_balance_tells_whether_it_is_satisfied(spark):
    rows = [(f"a{i}", "s1", "c", "o", 100, 0.5) for i in range(4)]
    d = spark.createDataFrame(rows, "id string, source_id string, category string, organization string, tokens long, score double")
    assert {r.satisfied for r in balance.balance(d, {"source_id": 0.5, "category": 1.0, "organization": 1.0}).collect()} == {False}
    assert {r.satisfied for r in balance.balance(d, {"source_id": 1.0, "category": 1.0, "organization": 1.0}).collect()} == {True}


def test_sections_without_a_path_stay_alone(spark):
    d = spark.createDataFrame([(i, "s", None, n, "consensus here", "system_design") for n, i in enumerate("abc")], "id string, source_id string, relative_path string, section_index int, text string, category_hint string")
    assert sorted(r.section_ids for r in sections.merge_sections(d, 100).collect()) == [["a"], ["b"], ["c"]]


def test_verified_license_makes_a_record_valid(spark):
    rows = [("1", "one text", "s", "c", "en", "u", None, "train", {"verified_license_id": "MIT"}), ("2", "two text", "s", "c", "en", "u", None, "train", None)]
    docs = spark.createDataFrame(rows, "id string, text string, source_id string, category string, language string, source_url string, license_id string, split string, metadata map<string,string>")
    items = spark.createDataFrame([], "text string, passages array<string>")
    assert pipelines.readiness(docs, items).first().invalid_records == 1


def test_training_checks(spark):
    from pathlib import Path

    from millrace.functions import checks

    rows = [(1.0, 1.0), (float("nan"), 1.0), (1.0, float("inf")), (1.0, 99.0), (None, 1.0)]
    got = [r[0] for r in spark.createDataFrame(rows, "l double, g double").select(checks.step_problem(F.col("l"), F.col("g"), 10.0)).collect()]
    assert got == [None, "loss", "gradient_norm", "gradient_norm", "loss"]
    assert checks.config_hash({"a": Path("x/y"), "b": (1, 2)}) == checks.config_hash({"b": [1, 2], "a": "x/y"}) != checks.config_hash({"a": "x"})


def test_diagnostics_of_checked_sources(spark):
    s = spark.createDataFrame([("a", "c", True, "MIT"), ("b", "c", True, "MIT"), ("d", "c", False, "CC-BY-NC"), ("e", "c", None, None)], "id string, category string, enabled boolean, license_id string")
    got = {r.source_id: r.status for r in pipelines.diagnostics(s, spark.createDataFrame([("b", False), ("a", True)], "source_id string, valid boolean")).collect()}
    assert got == {"a": "active", "b": "disabled_unclear_license", "d": "disabled_license_restriction", "e": "disabled_user_config"}
