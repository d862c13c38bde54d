import hashlib
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from millrace.functions import hashing, scoring, semantic
from millrace.functions import text as tx

CASES = [
    "Line 1\r\nLine 2   \r\n\r\n\r\n\r\nLine 3 \t ",
    "étude",
    "Hello\x00 World!\x07\x0bKeep\tTab and\nNewline",
    "Raw text with trailing space   \r\n\r\n\r\nand CRLF.",
    "",
    "   \n\t ",
    "　wide spaces ",
    "x" * 50_000 + " " + "一" * 20_000,
]


def clean_in_python(t: str) -> str:
    t = unicodedata.normalize("NFC", t).replace("\r\n", "\n").replace("\r", "\n")
    t = "".join(c for c in t if c in "\n\t" or (ord(c) >= 32 and ord(c) != 127))
    t = "\n".join(line.rstrip(" \t") for line in t.split("\n"))
    return re.sub(r"\n{3,}", "\n\n", t).strip()


def test_clean_matches_brute_force(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "i int, t string")
    got = {r.i: r.c for r in rows.select("i", tx.clean(F.col("t")).alias("c")).collect()}
    assert got == {i: clean_in_python(t) for i, t in enumerate(CASES)}


def test_clean_of_null_is_empty(spark):
    assert spark.sql("select cast(null as string) t").select(tx.clean(F.col("t"))).first()[0] == ""


def test_boilerplate_is_cut_only_if_found(spark):
    rows = [(1, "[![Build](a.svg)](b)\n<!-- note -->\nBody  "), (2, "Body  ")]
    text, blocks, saved = tx.strip_boilerplate(F.col("t"))
    got = spark.createDataFrame(rows, "i int, t string").select("i", text.alias("t"), blocks.alias("b"), saved.alias("s")).orderBy("i").collect()
    assert (got[0].t, got[0].b) == ("Body", 2) and got[0].s > 0
    assert (got[1].t, got[1].b, got[1].s) == ("Body  ", 0, 0)


def test_structural_headings_and_sections(spark):
    t = "Title\n=====\n\nText\n\n## Scope\nmore\n\n## Context\nlast"
    d = spark.createDataFrame([(t,)], "t string")
    assert d.select(tx.structural_headings(F.col("t"))).first()[0].startswith("# Title\nText")
    assert "".join(d.select(tx.sections(F.col("t"))).first()[0]) == t
    assert "Scope" not in d.select(tx.drop_sections(F.col("t"), ["scope"])).first()[0]
    assert d.select(tx.drop_sections(F.col("t"), ["title", "==", "scope", "context"])).first()[0] == t


def test_gate_reasons(spark):
    cap = "The CAP theorem states that a distributed store cannot be consistent, available and partition tolerant at once."
    rows = [(1, cap, "en", "s"), (2, "Too short text.", "en", "s"), (3, "### !!! $$$ " * 30, "en", "s"), (4, cap, None, "  "), (5, None, "en", "s")]
    r = scoring.gate_reasons(F.col("t"), F.col("l"), F.col("s"), chars=50, least_words=10, symbols=0.30)
    got = {x.i: x.r for x in spark.createDataFrame(rows, "i int, t string, l string, s string").select("i", r.alias("r")).collect()}
    assert got[1] == [] and got[2] == ["short_chars", "short_words"] and "symbols" in got[3] and got[4] == ["language", "provenance"]


def test_token_counts(spark):
    rows = [("",), ("  ",), ("one",), ("a b c d e f g h i j",), (None,)]
    got = [r[0] for r in spark.createDataFrame(rows, "t string").select(scoring.python_tokens(F.col("t"))).collect()]
    assert got == [0, 0, 1, 13, 0]


@pytest.mark.parametrize("seed", [3, 42])
def test_scores_equal_python(spark, seed):
    ids = ["a", "doc-1", "ü"]
    got = spark.createDataFrame([(i,) for i in ids], "id string").select(hashing.score32(F.col("id"), seed), hashing.score64(F.col("id"), seed)).collect()
    for i, row in zip(ids, got, strict=True):
        h = hashlib.sha256(f"{seed}:{i}".encode())
        assert row[0] == int(h.hexdigest()[:8], 16) / 0xFFFFFFFF and row[1] == int.from_bytes(h.digest()[:8], "big") / 2**64


def test_concepts_and_categories(spark):
    rows = [("Raft uses consensus, quorum, and leader election.",), ("Lease-based leadership relies on anti-entropy.",), ("nothing here",)]
    d = spark.createDataFrame(rows, "t string").withColumn("c", semantic.concepts(F.col("t")))
    got = d.select("c", semantic.candidates(F.col("t")).alias("n"), semantic.classify(F.col("t"), F.col("c"), F.lit("system_design")).alias("k")).collect()
    assert got[0].c == ["consensus", "leader-election", "quorum"] and got[0].k.category == "distributed_systems"
    assert got[1].n == ["anti-entropy", "lease-based-leadership"]
    assert (got[2].k.category, got[2].k.confidence) == ("system_design", 1.0)
    names = spark.createDataFrame([("fault tolerance",), ("fault_tolerance",), ("Fault-Tolerance",), ("lease-based leadership",)], "t string")
    assert [r[0] for r in names.select(semantic.normalize_concept(F.col("t"))).collect()] == ["fault-tolerance"] * 3 + [None]


def test_quality_and_relevance_edges(spark):
    rows = [("$$$ !!! 123",), ("",), ("\n".join(f"- [tool {i}](https://example.test/{i})" for i in range(30)),)]
    d = spark.createDataFrame(rows, "t string")
    q = [r[0] for r in d.select(scoring.quality(F.col("t"))).collect()]
    assert q[0].bucket == "low" and q[0].reasons == ["Empty or non-text document"] and q[1].score == 0
    r = d.select(scoring.reasoning_relevance(F.col("t"))).collect()[2][0]
    assert not r.passed and r.link_ratio > 0.2
    assert d.select(scoring.domain_relevance(F.lit("x"), F.lit(None).cast("string"), F.col("t"))).collect()[2][0].category == "generated_index"
    assert d.select(scoring.domain_relevance(F.lit("docs/CONTRIBUTING.md"), F.lit("t"), F.col("t"))).first()[0].category == "project_metadata"


def test_license_rules(spark):
    rows = ["MIT License\n", "Apache License\nVersion 2.0", "Creative Commons Attribution 4.0", "Creative Commons Attribution-ShareAlike 4.0", "MIT No Attribution", "none"]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in rows], "t string").select(scoring.license_of(F.col("t"))).collect()]
    assert got == ["MIT", "Apache-2.0", "CC-BY-4.0", "CC-BY-SA-4.0", "MIT-0", None]
