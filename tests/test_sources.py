import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.plans import pipelines
from millrace.sources import files, paths
from millrace.streaming import ingest


def test_path_rules(spark):
    p = [("docs/a/b.md",), ("node_modules/x.md",), ("data/benchmark/q.md",), ("x.bin",), ("README",), ("docs/c.HTML",)]
    d = spark.createDataFrame(p, "p string")
    assert [r[0] for r in d.select(paths.allowed(F.col("p"), ["docs/**/*.md"], ["node_modules/**"])).collect()] == [True, False, False, False, False, False]
    assert [r[0] for r in d.select(paths.allowed(F.col("p"))).collect()] == [True, True, False, False, False, False]
    assert [r[0] for r in d.select(paths.content_type(F.col("p"))).collect()] == ["markdown"] * 3 + [None, None, "html"]
    assert paths.sparse_folders(["docs/*.md", "src/**"]) == ["docs", "src"] and paths.sparse_folders(["*.adoc", "docs/x"]) == []


def test_html_prose():
    page = "<html><head><meta charset=x></head><nav><br>Menu</nav><h1>Retries</h1><p>Wait <b>longer</b>.</p><script>var x</script><ul><li>once</li></ul><pre>a  b</pre></html>"
    out = files.html_prose(page)
    assert "# Retries" in out and "- once" in out and "Menu" not in out and "var x" not in out and "```\na b\n```" in out


def test_directory_and_file(spark, tmp_path):
    (tmp_path / "code").mkdir()
    (tmp_path / "essay.markdown").write_text("# An essay\n\nText with ümlaut")
    (tmp_path / "code" / "demo.md").write_text("demo")
    (tmp_path / "blank.md").write_text("  \n")
    (tmp_path / "bad.txt").write_bytes(b"bad \xff byte")
    (tmp_path / "LICENSE").write_text("MIT License")
    rules = ({"include_patterns": ["*.markdown"], "license_id": "CC-BY-3.0"}, {"include_patterns": ["code/**"], "license_id": "MIT", "training_enabled": False})
    got = files.read_directory(spark, files.Source("s", path=str(tmp_path), license_rules=rules)).collect()
    assert [(r.relative_path, r.title, r.license_id) for r in got] == [("essay.markdown", "An essay", "CC-BY-3.0")]
    got = files.read_sources(spark, [files.Source("s", path=str(tmp_path)), files.Source("off", path=str(tmp_path), enabled=False)])
    assert sorted(r.relative_path for r in got.collect()) == ["bad.txt", "code/demo.md", "essay.markdown"]
    one = files.read_file(spark, files.Source("s", type="local_file", path=str(tmp_path / "essay.markdown"))).first()
    assert one.title == "An essay" and len(one.id) == 16
    assert files.inventory(spark, [files.Source("s", path=str(tmp_path)), files.Source("none", path=str(tmp_path / "no"))]).filter("source_id = 's'").first().files == 4
    assert files.verify_license(spark, str(tmp_path), "MIT")["valid"] and files.verify_license(spark, str(tmp_path), "CC-BY-4.0")["error"] == "mismatch"
    assert files.verify_license(spark, str(tmp_path / "code"), "MIT")["error"] == "no_license_file"
    with pytest.raises(ValueError):
        files.read_source(spark, files.Source("s", type="ftp", path="x"))


def test_records(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("text", T.StringType())])
    path = tmp_path / "a.jsonl"
    path.write_text('{"id": "1", "text": "ü"}\n\n{"id": "2"\n[1]\n')
    good, bad = files.read_records_lenient(spark, str(path), schema)
    assert [r.id for r in good.collect()] == ["1"] and bad.count() == 2
    with pytest.raises(Exception):
        files.read_records(spark, str(path), schema).collect()
    assert [r.record["id"] for r in files.read_objects(spark, str(path)).filter("record['id'] is not null").collect()] == ["1"]
    rows = spark.createDataFrame([("1", "ü"), ("2", None)], schema)
    files.publish({"train": rows, "empty": rows.limit(0)}, str(tmp_path / "out"), {"n": 2})
    assert json.loads((tmp_path / "out" / "manifest.json").read_text()) == {"n": 2} and spark.read.schema(schema).json(str(tmp_path / "out" / "train.jsonl")).count() == 2
    files.publish({"train": rows.limit(1)}, str(tmp_path / "out"))
    assert spark.read.schema(schema).json(str(tmp_path / "out" / "train.jsonl")).count() == 1 and not (tmp_path / "out.staging").exists()


def test_repositories_need_the_license_they_declare(spark, tmp_path):
    (tmp_path / "docs").mkdir()
    (tmp_path / ".git").mkdir()
    (tmp_path / ".git" / "HEAD").write_text("ref: refs/heads/main\n")
    (tmp_path / ".git" / "packed-refs").write_text("# packed\nabc123 refs/heads/main\n")
    (tmp_path / "docs" / "a.md").write_text("# Title\n\ntext")
    (tmp_path / "LICENSE").write_text("MIT License")
    git = lambda **k: files.Source("g", type="git_repository", path=str(tmp_path), url="https://github.com/o/r.git", include_patterns=("docs/**",), **k)
    row = files.read_source(spark, git(license_id="MIT")).first()
    assert row.source_url == "https://github.com/o/r/blob/abc123/docs/a.md" and row.license_id == "MIT" and len(row.id) == 16
    assert row.id != files.read_directory(spark, git(license_id="MIT")).first().id
    assert files.read_source(spark, git(license_id="CC-BY-4.0")).count() == 0 and files.read_source(spark, git()).count() == 0
    (tmp_path / "LICENSE").unlink()
    assert files.read_source(spark, git(license_id="MIT")).count() == 0
    assert files.commit_of(str(tmp_path / "docs")) == "unknown"


def test_fetched_pages(spark, tmp_path):
    rows = [("http://a/x", "<h1>T</h1><p>x</p>"), ("http://b", "<p>other</p>"), ("http://a/y", "<nav>n</nav>")]
    spark.createDataFrame(rows, "url string, html string").write.parquet(str(tmp_path / "pages"))
    source = files.Source("h", type="http_documentation", path=str(tmp_path / "pages"), url="http://a", license_id="MIT")
    assert [r.source_url for r in files.read_source(spark, source).collect()] == ["http://a/x"]
    both = files.read_sources(spark, [source, files.Source("d", path=str(tmp_path), include_patterns=("*.md",))])
    assert both.count() == 1
    with pytest.raises(ValueError):
        files.read_source(spark, files.Source("h", type="http_documentation"))


def test_single_html_file(spark, tmp_path):
    (tmp_path / "a.htm").write_text("<nav>n</nav><h1>T</h1>")
    (tmp_path / "b.txt").write_text("<h1>U</h1>")
    assert files.read_file(spark, files.Source("s", path=str(tmp_path / "a.htm"))).first().text.strip() == "# T"
    assert files.read_file(spark, files.Source("s", path=str(tmp_path / "b.txt"), parser="html")).first().text.strip() == "# U"


def test_dry_run(spark, tmp_path):
    for i in range(12):
        (tmp_path / f"f{i:02d}.md").write_text("x")
    got = {r.source_id: r for r in files.dry_run(spark, [files.Source("a", path=str(tmp_path)), files.Source("off", path=str(tmp_path), enabled=False), files.Source("gone", path=str(tmp_path / "no"))]).collect()}
    assert got["a"].candidates == 12 and got["a"].candidate_files == [f"f{i:02d}.md" for i in range(10)]
    assert got["off"].candidates == got["gone"].candidates == 0 and list(got["off"].candidate_files) == []


def test_published_artifacts_are_verified_and_recovered(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a")], "id string, text string")
    path = str(tmp_path / "art")
    files.publish({"train": rows}, path, {"n": 1})
    files.verify_artifact(spark, path)
    (tmp_path / "art" / "extra.txt").write_text("x")
    with pytest.raises(ValueError, match="extra.txt"):
        files.verify_artifact(spark, path)
    (tmp_path / "art").rename(tmp_path / "art.previous")  # a job that died between the two renames
    assert files.recover(spark, path) and (tmp_path / "art" / "manifest.json").exists() and not files.recover(spark, path)
    files.publish({"train": rows}, path)
    files.verify_artifact(spark, path)
    assert not (tmp_path / "art.previous").exists() and not (tmp_path / "art" / "extra.txt").exists()


def test_packed_sequences_and_reports(spark, tmp_path):
    from millrace.operators import sequence

    docs = spark.createDataFrame([("b", "one two three"), ("a", "four " * 70)], "id string, text string")
    files.write_packed(sequence.pack_stream(docs, 32), str(tmp_path / "packed"))
    back = files.read_packed(spark, str(tmp_path / "packed"))
    assert sequence.packing_statistics(back).first().packed_tokens == 75
    assert json.loads((tmp_path / "packed" / "manifest.json").read_text())["statistics"]["sequences"] == 3
    files.write_packed(sequence.pack_stream(docs.limit(0), 32), str(tmp_path / "none"))
    with pytest.raises(ValueError):
        files.read_packed(spark, str(tmp_path / "none"))
    files.write_report({"Docs": docs, "None": docs.limit(0)}, str(tmp_path / "r.md"), most=1)
    text = (tmp_path / "r.md").read_text()
    assert "## Docs" in text and "2 rows in all" in text and "| id | text |" in text


def test_manifest(tmp_path):
    pytest.importorskip("yaml")
    path = tmp_path / "m.yaml"
    path.write_text("sources:\n- id: a\n  category: x\n  include_patterns: ['*.md']\n- id: b\n  category_hint: y\n  enabled: false\n")
    a, b = files.load_manifest(str(path))
    assert (a.name, a.category, a.include_patterns, b.category, b.enabled) == ("a", "x", ("*.md",), "y", False)
    path.write_text("{}")
    assert files.load_manifest(str(path)) == []


def test_pages_need_a_license(spark):
    pages = spark.createDataFrame([("http://a", "<h1>T</h1><p>x</p>"), ("http://b", "<nav>n</nav>"), ("http://c", None)], "url string, html string")
    assert files.read_pages(pages, files.Source("s", license_id="MIT")).count() == 1 and files.read_pages(pages, files.Source("s")).count() == 0


def test_stream_drops_repeated_texts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = [{"id": str(i), "source_id": "s", "text": "same" if i % 2 else f"t{i}", "ingested_at": "2025-01-01T00:00:00"} for i in range(6)]
    (tmp_path / "in" / "a.json").write_text("\n".join(map(json.dumps, rows)))
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "source_id", "text")] + [T.StructField("ingested_at", T.TimestampType())])
    stream = ingest.drop_repeated(ingest.read_records_stream(spark, str(tmp_path / "in"), schema))
    q = stream.writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert spark.table("kept").count() == 4
    done = spark.createDataFrame([("a",)], "fingerprint string")
    assert [r[0] for r in ingest.pending(spark.createDataFrame([("a",), ("b",)], "fingerprint string"), done).collect()] == ["b"]


def test_build_accounts_for_every_row(spark):
    text = "A long enough sentence about queues and stores that passes every gate of the build pipeline without any doubt at all. "
    rows = [(1, "a", "s", "c", text * 2, "en", None), (2, "b", "s", "c", text * 2 + " ", "en", None), (3, "c", "s", "c", "short", "en", None), (4, "d", "t", "c", " \n", "en", None), (5, "e", "t", "c", None, None, None), (6, "f", "t", "c", text * 3, "en", None)]
    raw = spark.createDataFrame(rows, "ord long, id string, source_id string, category string, text string, language string, metadata map<string,string>")
    r = pipelines.build(raw)
    got = {x.id: x.decision for x in r.ledger.collect()}
    assert got == {"a": "kept", "b": "exact_duplicate", "c": "rejected_quality", "d": "quarantined", "e": "quarantined", "f": "kept"}
    assert pipelines.build(raw.limit(0)).ledger.count() == 0


def test_curate_and_freeze_account_for_every_document(spark, sf):
    from millrace.functions import vocabulary as V
    from millrace.schema import current, deliveries

    docs = current(deliveries(spark, sf)).limit(60)
    r = pipelines.curate(docs)
    assert sorted(x.id for x in r.ledger.select("id").collect()) == sorted(x.id for x in docs.select("id").collect())
    f = pipelines.freeze(docs, spark.read.parquet(f"{sf}/source_config.parquet"), pipelines.FreezeSettings(target_tokens=5000, targets={c: 0.1 for c in V.CATEGORIES}, section_tokens=200))
    assert f.ledger.filter("decision = 'kept'").count() == f.documents.count() and pipelines.manifest(f).count() == 1
    assert pipelines.capacity_funnel(f, docs).count() == 5
