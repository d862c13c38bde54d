"""Concepts and categories of a text, by phrase rules, as columns."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import vocabulary as V
from millrace.functions.text import let

CONCEPTS = sorted(V.CONCEPT_PHRASES)


def phrase_pattern(phrase: str) -> str:
    """Pattern that finds a phrase in lower-case text, its words joined by any separators."""
    parts = [re.escape(w) for w in re.split(r"[-_\s]+", phrase.lower()) if w]
    return r"(?<![a-z0-9])" + r"[-_\s]+".join(parts) + r"(?![a-z0-9])"


def forms(concept: str, phrases: Mapping[str, Sequence[str]] = V.CONCEPT_PHRASES) -> list[str]:
    return [concept, *phrases.get(concept, ())]


def normalize_concept(value: Column, phrases: Mapping[str, Sequence[str]] = V.CONCEPT_PHRASES) -> Column:
    """The concept that a label spells, or null."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(value), "[^a-z0-9]+", "-"), "^-|-$", "")
    table = {re.sub("[^a-z0-9]+", "-", f).strip("-"): c for c in sorted(phrases) for f in forms(c, phrases)}
    return F.create_map(*[F.lit(x) for kv in table.items() for x in kv])[slug]


def _names(low: Column, phrase: str) -> Column:
    """Whether the text has the phrase; the costly pattern is tried only if the phrase's longest word occurs at all."""
    longest = max(re.split(r"[-_\s]+", phrase), key=len)
    return low.contains(longest) & low.rlike(phrase_pattern(phrase))


def concepts(text: Column, phrases: Mapping[str, Sequence[str]] = V.CONCEPT_PHRASES) -> Column:
    """Sorted concepts that the text names."""

    def found(low: Column) -> Column:
        tests = []
        for c in sorted(phrases):
            hit = _names(low, c)
            for p in phrases[c]:
                hit = hit | _names(low, p)
            tests.append(F.when(hit, c))
        return F.array_compact(F.array(*tests))

    return let(F.lower(text), found)


def candidates(text: Column) -> Column:
    """Sorted phrases worth a concept of their own."""
    low = F.lower(text)
    found = {slug: p for p, slug in V.CANDIDATE_PHRASES.items()}
    return F.array_compact(F.array(*[F.when(low.rlike(rf"(?<![\p{{L}}\p{{N}}_])(?:{found[s].replace(' ', '[ ]')})(?![\p{{L}}\p{{N}}_])"), s) for s in sorted(found)]))


def classify(text: Column, found: Column, hint: Column, signals: Mapping[str, Sequence[str]] = V.CATEGORY_CONCEPTS) -> Column:
    """Struct (category, confidence): 3 for every concept that speaks for it, 1 if its label stands in the text, half
    for the hint; ties go to the first name; without any signal `software_architecture` at 0."""
    low = F.lower(text)
    hint = F.coalesce(F.create_map(*[F.lit(x) for kv in V.HINT_CATEGORIES.items() for x in kv])[F.coalesce(hint, F.lit(""))], hint, F.lit(""))
    scores = []
    for c in V.CATEGORIES:
        own = F.size(F.array_intersect(found, F.array(*[F.lit(x) for x in signals[c]]))) * 3.0 if c in signals else F.lit(0.0)
        scores.append(F.struct((-(own + low.contains(c.replace("_", " ")).cast("double") + (hint == c).cast("double") * 0.5)).alias("minus"), F.lit(c).alias("name")))

    def pick(ordered: Column) -> Column:
        total = F.aggregate(ordered, F.lit(0.0), lambda a, x: a - x["minus"])
        none = F.struct(F.lit("software_architecture").alias("category"), F.lit(0.0).alias("confidence"))
        best = F.struct(ordered[0]["name"].alias("category"), F.round(-ordered[0]["minus"] / total, 3).alias("confidence"))
        return F.when(total == 0, none).otherwise(best)

    return let(F.array_sort(F.array(*scores)), pick)


def annotate(docs: DataFrame) -> DataFrame:
    """docs(text, category_hint, ...) with related_concepts, candidate_concepts, primary_category and
    category_confidence. A null text names nothing, and its hint alone decides."""
    text = F.coalesce("text", F.lit(""))
    found = docs.withColumn("related_concepts", concepts(text)).withColumn("candidate_concepts", candidates(text))
    best = classify(text, F.col("related_concepts"), F.col("category_hint"))
    return found.withColumn("_best", best).withColumn("primary_category", F.col("_best.category")).withColumn("category_confidence", F.col("_best.confidence")).drop("_best")
