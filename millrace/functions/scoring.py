"""Document scores as columns; every vocabulary, weight and threshold is a parameter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import vocabulary as V
from millrace.functions.text import CODE_BLOCK, HEADING, PIECE, WS, code_text, let, lines, strip, words

#: Weights of the quality score's parts: technical words, trade-off words, prose, headings, balance of code and prose.
QUALITY_WEIGHTS = (0.25, 0.25, 0.20, 0.15, 0.15)


def python_tokens(text: Column) -> Column:
    """Token count over all white space that Python knows: blank 0, else max(1, floor(1.3 * words))."""
    n = F.regexp_count(text, F.lit(PIECE))
    return F.when(n > 0, F.greatest(F.lit(1), F.floor(n * F.lit(1.3)))).otherwise(0).cast("long")


def _share(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.greatest(F.lit(1), whole)


def quality(
    text: Column,
    tech: Sequence[str] = tuple(V.TECH_WORDS),
    tradeoff: Sequence[str] = tuple(V.TRADEOFF_WORDS),
    weights: Sequence[float] = QUALITY_WEIGHTS,
    low: float = 0.45,
    high: float = 0.70,
) -> Column:
    """Struct of quality score (0..1, four digits), bucket, reasons and the parts. A text without words scores 0."""
    found = F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: w.rlike("^[a-z]+$"))
    hits = lambda ws, vocabulary: F.size(F.filter(ws, lambda w: w.isin(*[x for x in vocabulary if x.isalpha()])))
    counts = let(found, lambda ws: F.struct(F.size(ws).alias("n"), hits(ws, tech).alias("tech"), hits(ws, tradeoff).alias("trade")))
    code_chars = F.aggregate(F.regexp_extract_all(text, F.lit(CODE_BLOCK), F.lit(0)), F.lit(0), lambda a, b: a + F.length(b))
    raw = F.struct(
        counts.alias("c"),
        _share(F.length(text) - F.length(F.regexp_replace(text, rf"[\p{{L}}{WS}]+", "")), F.length(text)).alias("prose"),
        F.least(F.lit(1.0), F.regexp_count(text, F.lit(f"(?md)^{HEADING}")).cast("double") / 3.0).alias("heading"),
        F.when(text.contains("```") | text.contains("[source"), _share(code_chars, F.length(text))).otherwise(0.0).alias("code"),
    )

    def rate(x: Column) -> Column:
        n = x["c"]["n"]
        technical = F.least(F.lit(1.0), x["c"]["tech"].cast("double") / n * 15.0)
        trade = F.least(F.lit(1.0), x["c"]["trade"].cast("double") / n * 30.0)
        balance = 1.0 - F.least(F.lit(1.0), x["code"] * 1.2)
        parts = dict(zip(("technical", "tradeoff", "prose", "heading", "balance"), (technical, trade, x["prose"], x["heading"], balance), strict=True))
        total = technical * weights[0]
        for p, w in zip(list(parts.values())[1:], weights[1:], strict=True):
            total = total + p * w
        score = F.when(n == 0, 0.0).otherwise(F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)), 4))
        return F.struct(score.alias("score"), n.alias("n"), x["code"].alias("code"), *[F.when(n > 0, p).alias(k) for k, p in parts.items()])

    def judge(x: Column) -> Column:
        bucket = F.when(x["n"] == 0, "low").when(x["score"] >= high, "high").when(x["score"] >= low, "medium").otherwise("low")
        told = F.array_compact(
            F.array(
                F.when(x["technical"] >= 0.5, "high technical vocabulary density"),
                F.when(x["tradeoff"] >= 0.3, "contains architecture trade-off language"),
                F.when(x["prose"] >= 0.8, "substantial technical prose"),
                F.when(x["heading"] >= 0.3, "structured heading organization"),
                F.when(x["code"] > 0.6, "high code block ratio"),
            )
        )
        poor = F.array(F.lit("low technical prose density"))
        reasons = F.when(x["n"] == 0, F.array(F.lit("Empty or non-text document"))).when((bucket == "low") & (F.size(told) == 0), poor).otherwise(told)
        names = ("technical", "tradeoff", "prose", "heading", "balance")
        return F.struct(x["score"].alias("score"), bucket.alias("bucket"), reasons.alias("reasons"), *[F.round(x[k], 4).alias(k) for k in names])

    return let(let(raw, rate), judge)


def domain_relevance(path: Column, title: Column, text: Column) -> Column:
    """Struct (relevant, category): project metadata by path or title, generated link indexes, bare install notes."""
    path, title = F.lower(F.coalesce(path, F.lit(""))), F.lower(F.coalesce(title, F.lit("")))
    listed = lambda every: F.size(F.filter(every, lambda x: x.startswith("- [") | x.startswith("* [") | x.startswith("1. [")))
    metadata = path.rlike("|".join(V.METADATA_PATHS)) | title.rlike("|".join(V.METADATA_TITLES))
    dump = let(lines(text), lambda every: (F.size(every) > 10) & (listed(every).cast("double") / F.size(every) > 0.85))
    command = text.contains("apt-get") | text.contains("brew install") | text.contains("docker run")
    install = (title.startswith("installation") | title.contains("how to install")) & (F.size(words(text)) < 200) & command
    category = F.when(metadata, "project_metadata").when(dump, "generated_index").when(install, "installation_only")
    return let(category, lambda c: F.struct(c.isNull().alias("relevant"), c.alias("category")))


def occurrences(text: Column, phrases: Sequence[str]) -> Column:
    """Non-overlapping occurrences of every phrase, added up."""
    total = F.lit(0)
    for p in phrases:
        total = total + F.when(text.contains(p), (F.length(text) - F.length(F.replace(text, F.lit(p), F.lit("")))) / len(p)).otherwise(0)
    return total.cast("long")


def reasoning_relevance(
    text: Column, signals: Sequence[str] = tuple(V.REASONING_SIGNALS), min_score: float = 0.40, max_links: float = 0.22, heading_labels: bool = False
) -> Column:
    """Struct of the reasoning score, whether it passes, the link ratio, the prose density and the number of signals.

    Labels of a decision record count on lines of their own; with `heading_labels` also in headings.
    """
    def measure(x: Column) -> Column:
        low, every = x["low"], x["every"]
        rows = F.size(every)
        n = F.greatest(F.lit(1), F.regexp_count(low, F.lit(r"(?<![\p{L}\p{N}_])[a-z](?:[a-z-]*[a-z])?(?![\p{L}\p{N}_])")))
        labels = F.lit(0)
        for label in V.RECORD_LABELS:
            own = f"(?imd)^{label}[{WS}]*$" + (rf"|^#{{1,6}}[{WS}]+{label}(?![\p{{L}}\p{{N}}_])" if heading_labels else "")
            labels = labels + (low.contains(label) & text.rlike(own)).cast("int")
        marks = F.size(F.filter(every, lambda x: x.rlike(f"^(?:#{{1,6}}[{WS}]|={{1,6}}[{WS}])")))
        links = F.when(text.contains("http") | text.contains("]("), F.regexp_count(text, F.lit(r"https?://|\[[^\]]+\]\([^)]*\)"))).otherwise(0)
        return F.struct(
            n.alias("n"), rows.alias("rows"), occurrences(low, signals).alias("hits"), F.regexp_count(text, F.lit(f"[.!?](?:[{WS}]|\\z)")).alias("ends"),
            marks.alias("heads"), labels.alias("labels"), links.alias("links"), F.size(F.filter(every, lambda x: x.startswith("```"))).alias("codes"),
        )

    def rate(x: Column) -> Column:
        most = lambda c: F.least(F.lit(1.0), c)
        rows = F.greatest(F.lit(1), x["rows"])
        signal = most(x["hits"] / F.greatest(F.lit(2.0), x["n"] / F.lit(85.0)))
        prose = most(x["ends"] / F.greatest(F.lit(1.0), x["rows"] * F.lit(0.35)))
        link_ratio = x["links"] / rows
        score = 0.38 * signal + 0.25 * prose + 0.18 * most(x["heads"] / F.lit(3.0)) + 0.19 * most(x["labels"] / F.lit(3.0))
        score = score - (0.25 * most(link_ratio / max(max_links, 0.001)) + 0.20 * most(x["codes"] / rows))
        return F.struct(F.round(F.greatest(F.lit(0.0), most(score)), 4).alias("score"), link_ratio.alias("links"), prose.alias("prose"), x["hits"].alias("hits"))

    def judge(x: Column) -> Column:
        passed = (x["score"] >= min_score) & (x["links"] <= max_links)
        return F.struct(
            x["score"].alias("score"), passed.alias("passed"), F.round(x["links"], 4).alias("link_ratio"), F.round(x["prose"], 4).alias("prose_density"), x["hits"].alias("signals")
        )

    return let(let(let(F.struct(F.lower(text).alias("low"), lines(text).alias("every")), measure), rate), judge)


def code_share(text: Column, most: float = 0.70) -> Column:
    """Struct of total, code and prose tokens, the code ratio, and whether code dominates a text of over 200 tokens."""
    marked = text.contains("```") | text.contains("[source")
    both = F.struct(python_tokens(text).alias("total"), F.when(marked, python_tokens(code_text(text))).otherwise(F.lit(0).cast("long")).alias("code"))

    def judge(x: Column) -> Column:
        ratio = x["code"] / F.greatest(F.lit(1), x["total"])
        return F.struct(
            x["total"].alias("total_tokens"), x["code"].alias("code_tokens"), F.greatest(F.lit(0), x["total"] - x["code"]).cast("long").alias("prose_tokens"),
            F.round(ratio, 4).alias("code_ratio"), ((ratio > most) & (x["total"] > 200)).alias("dominated"),
        )

    return let(both, judge)


def gate_reasons(text: Column, lang: Column, source: Column, chars: int = 80, least_words: int = 15, languages: Sequence[str] = ("en",), symbols: float = 0.40) -> Column:
    """Why the quality gate rejects a document; empty if it passes. A null language or source is rejected."""
    def judge(t: Column, dense: Column) -> Column:
        solid = F.length(dense)
        share = F.length(F.regexp_replace(dense, r"[\p{L}\p{N}_]+", "")) / solid
        return F.array_compact(
            F.array(
                F.when(F.length(t) < chars, "short_chars"),
                F.when(F.regexp_count(t, F.lit(PIECE)) < least_words, "short_words"),
                F.when(~F.coalesce(lang.isin(*languages), F.lit(False)), "language"),
                F.when(strip(F.coalesce(source, F.lit(""))) == "", "provenance"),
                F.when((solid > 0) & (share > symbols), "symbols"),
            )
        )

    dense = F.regexp_replace(text, f"[{WS}]+", "")
    return let(F.struct(strip(text).alias("t"), dense.alias("dense")), lambda x: judge(x["t"], x["dense"]))


def license_of(text: Column) -> Column:
    """License identifier that a license text names, by ordered rules; null if none applies (fixed values)."""
    low = F.lower(text)
    has = lambda *p: F.greatest(*[low.contains(x) for x in p]) if len(p) > 1 else low.contains(p[0])
    cc = has("creative commons", "cc-", "attribution")
    own = F.upper(strip(text))
    return (
        F.when(own.contains("MIT OR CC0") | own.contains("CC0 OR MIT"), "MIT")
        .when(has("mit no attribution", "mit-0"), "MIT-0")
        .when(has("apache license") & has("version 2.0", "v2.0"), "Apache-2.0")
        .when(cc & has("noncommercial", "by-nc", "nc-sa"), "CC-BY-NC-SA-4.0")
        .when(cc & has("attribution-sharealike 4.0", "by-sa/4.0", "by-sa 4.0", "cc-by-sa-4.0"), "CC-BY-SA-4.0")
        .when(cc & has("attribution 4.0", "by/4.0", "by 4.0", "cc-by-4.0"), "CC-BY-4.0")
        .when(cc & has("attribution 3.0", "by/3.0", "by 3.0"), "CC-BY-3.0")
        .when(cc & has("public domain", "cc0"), "CC0-1.0")
        .when(has("mit license", "permission is hereby granted, free of charge") | (own == "MIT"), "MIT")
        .when(has("bsd 3-clause") | (has("redistribution and use in source") & has("neither the name")), "BSD-3-Clause")
        .when(has("bsd 2-clause"), "BSD-2-Clause")
        .when(has("mozilla public license") & has("2.0"), "MPL-2.0")
    )
