"""Benchmark samples, response rubric, behaviour flags and their aggregates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import vocabulary as V
from millrace.functions.text import let, strip, words

DIMENSIONS = [
    "driver_identification", "nfr_coverage", "architecture_choice_quality", "tradeoff_quality", "alternative_analysis", "risk_identification",
    "reliability_reasoning", "scalability_reasoning", "operational_complexity_awareness", "cost_awareness", "unsupported_claim_avoidance", "revisit_conditions",
    "clarification_awareness", "reasoning_completeness",
]


def prompt(scenario: Column, facts: Column, question: Column) -> Column:
    """Prompt of a sample: scenario, facts and question, nothing of the rubric."""
    block = F.concat(F.lit("\nKey Scenario Facts & Constraints:\n"), F.array_join(F.transform(facts, lambda f: F.concat(F.lit("- "), f)), "\n"))
    listed = F.when(F.coalesce(F.size(facts), F.lit(0)) > 0, block).otherwise("")
    return F.concat(F.lit("System Architecture Scenario:\n"), strip(scenario), F.lit("\n"), listed, F.lit("\n\nQuestion:\n"), strip(question))


def sample_problems(samples: DataFrame, categories: bool = True) -> DataFrame:
    """(item_id, problems) of benchmark samples that break a rule."""
    again = F.count("*").over(Window.partitionBy("id")) > 1
    blank = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    problems = F.array_compact(
        F.array(
            F.when(blank("id"), "missing_id").when(again, "duplicate_id"), F.when(blank("category"), "missing_category"),
            F.when(~F.coalesce(F.col("difficulty").isin("easy", "medium", "hard"), F.lit(False)), "difficulty"),
            F.when(F.length(strip(F.coalesce("scenario", F.lit("")))) < 20, "short_scenario"), F.when(F.length(strip(F.coalesce("question", F.lit("")))) < 5, "short_question"),
        )
    )
    return samples.select("item_id", problems.alias("problems")).filter(F.size("problems") > 0)


def _hits(low: Column, terms: list[str]) -> Column:
    out = F.lit(0)
    for t in terms:
        out = out + low.contains(t).cast("int")
    return out


def rubric(response: Column, facts: Column, missing_info: Column | None = None) -> dict[str, Column]:
    """Scores of a response by dimension, and their mean as `overall`."""
    low = F.lower(response)
    stated = lambda f: F.exists(words(F.lower(f)), lambda w: (F.length(w) > 4) & low.contains(w))
    n = F.greatest(F.lit(1), F.coalesce(F.size(facts), F.lit(0)))
    found = F.coalesce(F.size(F.filter(facts, stated)), F.lit(0))
    out = {"driver_identification": F.round(F.greatest(F.lit(0), found) / n, 2)}
    for name, terms in V.RUBRIC.items():
        hits = _hits(low, terms)
        if name in V.RUBRIC_FULL:
            out[name] = F.round(F.least(F.lit(1.0), hits / float(V.RUBRIC_FULL[name])), 2)
        elif name == "clarification_awareness":
            out[name] = F.when(hits > 0, 0.9).when(F.lit(False) if missing_info is None else missing_info, 0.4).otherwise(0.7)
        else:
            out[name] = F.when(hits > 0, 0.8).otherwise(0.2)
    claims = F.lit(0)
    for p in V.ABSOLUTE_CLAIMS:
        claims = claims + low.rlike(p).cast("int")
    out["unsupported_claim_avoidance"] = F.greatest(F.lit(0.0), 1.0 - claims * 0.5)
    out["reasoning_completeness"] = F.round(F.least(F.lit(1.0), F.size(words(low)) / 250.0), 2)
    total = out[DIMENSIONS[0]]
    for d in DIMENSIONS[1:]:
        total = total + out[d]
    return {**{d: out[d] for d in DIMENSIONS}, "overall": F.round(total / len(DIMENSIONS), 4), "claims": claims, "revisits": _hits(low, V.RUBRIC["revisit_conditions"])}


def plain_words(text: Column) -> Column:
    """Runs of ASCII letters and digits in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def repeats(text: Column, span: int = 8, least: int = 16) -> Column:
    """Whether a text of at least `least` words has a run of `span` words twice."""
    def twice(w: Column) -> Column:
        runs = word_runs(w, span)
        return F.when(F.size(w) < least, False).otherwise(let(runs, lambda r: F.size(r) > F.size(F.array_distinct(r))))

    return let(plain_words(text), twice)


def word_runs(w: Column, span: int) -> Column:
    """Runs of `span` consecutive words, in order."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(w) - (span - 1))), lambda i: F.array_join(F.slice(w, i, span), " "))


def _longest_run(a: list[str], b: list[str]) -> int:
    codes: dict[str, int] = {}
    x = np.array([codes.setdefault(w, len(codes)) for w in a])
    y = np.array([codes.setdefault(w, len(codes)) for w in b])
    best, run = 0, np.zeros(len(y) + 1, dtype=np.int64)
    for w in x:
        run[1:] = np.where(y == w, run[:-1] + 1, 0)
        best = max(best, int(run.max()))
    return best


def echoes(response: Column, source: Column, run: int = 12, share: float = 0.35, least: int = 16) -> Column:
    """Whether the response copies at least `run` consecutive words of its prompt that make `share` of it.

    Only pairs that share a run of that length at all reach the dynamic program."""

    @F.pandas_udf("boolean")
    def copied(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for answers, prompts in batches:
            out = []
            for p, q in zip(answers, prompts, strict=True):
                if p is None or q is None or len(p) < least or len(q) < run:
                    out.append(False)
                    continue
                p, q = list(p), list(q)
                known = {tuple(q[i : i + run]) for i in range(len(q) - run + 1)}
                possible = any(tuple(p[i : i + run]) in known for i in range(len(p) - run + 1))
                out.append(possible and _longest_run(p, q) / len(p) >= share)
            yield pd.Series(out, dtype="bool")

    return copied(plain_words(response), plain_words(source))


def behaviour(rows: DataFrame) -> DataFrame:
    """One row of rates over rows(response, prompt, score): repetition, echo, failure (either, or under 12 words)."""
    marked = rows.select(repeats(F.col("response")).alias("r"), echoes(F.col("response"), F.col("prompt")).alias("e"), F.size(plain_words(F.col("response"))).alias("n"), "score")
    rate = lambda c: F.round(F.avg(c.cast("double")), 6)
    return marked.agg(
        F.count("*").alias("total"), rate(F.col("r")).alias("repetition_rate"), rate(F.col("e")).alias("echo_rate"),
        rate(F.col("r") | F.col("e") | (F.col("n") < 12)).alias("failure_rate"), F.round(F.avg("score"), 6).alias("mean_score"),
    )


def regressions(base: DataFrame, candidate: DataFrame, rate: float = 0.05, drop: float = 0.10) -> DataFrame:
    """One row: whether the candidate passes against the base, and the failures. Both inputs are one-row summaries."""
    names = ["repetition_rate", "echo_rate", "failure_rate"]
    b = base.select(*[F.col(n).alias(f"b_{n}") for n in [*names, "mean_score"]])
    both = b.crossJoin(candidate.select(*[F.col(n).alias(f"c_{n}") for n in [*names, "mean_score"]]))  # one row each
    tests = []
    for n in names:
        tests += [F.when(F.col(f"b_{n}") > rate, f"base_unhealthy:{n}"), F.when(F.col(f"c_{n}") > F.col(f"b_{n}") + rate, f"regressed:{n}")]
    tests.append(F.when(F.col("c_mean_score") < F.col("b_mean_score") - drop, "regressed:mean_score"))
    return both.select(F.array_compact(F.array(*tests)).alias("failures")).select((F.size("failures") == 0).alias("passed"), "failures")


#: Dimensions whose score under this is a failure of its own, with the name of the failure.
WEAK, WEAK_BELOW = {"tradeoff_quality": "weak_tradeoffs", "reliability_reasoning": "missing_reliability", "revisit_conditions": "no_revisit_conditions"}, 0.4


def failure_modes(evaluated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, overall, reasons) of evaluated responses that failed: unsupported claims, a weak dimension, missing
    information that was not asked for, or a low overall score without any of these.

    evaluated(keys, overall, claims, missing_info, acknowledged, <dimensions>); null flags count as false.
    """
    missed = F.coalesce("missing_info", F.lit(False)) & ~F.coalesce("acknowledged", F.lit(False))
    tests = [F.when(F.col("claims") > 0, "unsupported_claims"), *[F.when(F.col(d) < WEAK_BELOW, name) for d, name in WEAK.items()], F.when(missed, "missed_information")]
    found = F.array_compact(F.array(*tests))
    rows = evaluated.select(*keys, "overall", found.alias("reasons")).filter((F.size("reasons") > 0) | (F.col("overall") < 0.5))
    return rows.withColumn("reasons", F.when(F.size("reasons") == 0, F.array(F.lit("low_score"))).otherwise(F.col("reasons")))


def incomplete(prompts: DataFrame, outputs: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """(key, missing) of the keys that are not in all three tables; empty for a complete run."""
    names = ("prompt", "output", "score")
    out = None
    for name, df in zip(names, (prompts, outputs, scores), strict=True):
        have = df.select(key).distinct().withColumn(name, F.lit(True))
        out = have if out is None else out.join(have, key, "full")
    missing = F.array_compact(F.array(*[F.when(F.col(n).isNull(), n) for n in names]))
    return out.select(key, missing.alias("missing")).filter(F.size("missing") > 0)


def review_export(samples: DataFrame, outputs: DataFrame, scores: DataFrame, key: str) -> DataFrame:
    """Rows for human review: a sample with its output and its scores, inner joins on the key; a sample or score without
    the others is left out. Empty review fields are added."""
    joined = scores.join(samples, key).join(outputs, key)
    return joined.withColumn("audited", F.lit(False)).withColumn("notes", F.lit("")).withColumn("score_override", F.lit(None).cast("double"))


def comparison(base: DataFrame, candidate: DataFrame) -> DataFrame:
    """(metric, base, candidate, delta) of two runs' summaries metrics(metric, value); a metric of one run only has a null
    on the other side."""
    out = base.select("metric", F.col("value").alias("base")).join(candidate.select("metric", F.col("value").alias("candidate")), "metric", "full")
    return out.withColumn("delta", F.round(F.col("candidate") - F.col("base"), 4))


def worst(evaluated: DataFrame, keys: Sequence[str], n: int = 20) -> DataFrame:
    """The n responses of lowest overall score, ties by the keys."""
    return evaluated.orderBy("overall", *keys).limit(n)
