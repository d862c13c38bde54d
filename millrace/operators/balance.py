"""Constrained reduction and selection: concentration caps and budgeted selection."""

from __future__ import annotations

from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.analytics import capped_sources, token_totals
from millrace.runtime import materialize, release, running_totals

CAPS = {"source_id": 0.30, "category": 0.40, "organization": 0.40}
#: Removals that do not lower the excess by more than this do not count.
EPSILON = 1e-12


def balance(docs: DataFrame, caps: Mapping[str, float] = CAPS, tolerance: float = 0.001) -> DataFrame:
    """docs(id, source_id, category, organization, tokens, score) with `kept`, and `satisfied`, the same in every row: caps
    on the share of tokens that one source, category or organization may hold among the kept documents.

    Each round looks at one dimension, the one with the largest excess over its cap. The groups over the cap are fewer
    than 1/cap, so their totals fit the driver whatever the corpus; from them follows how many tokens each must lose
    so that all of them are at the cap of what remains. The worst documents of such a group go first (lowest score,
    then most tokens, then id), found by a running total that never gathers a group. Every round removes documents, and the rounds end when all caps hold
    within the tolerance, or when only a cap that no removal can reach is left: `satisfied` tells which.
    Null keys form a group of their own; null tokens count 0 and null scores as lowest.
    """
    slim = docs.select(
        "id", *[F.coalesce(F.col(d), F.lit("(none)")).alias(d) for d in CAPS], F.coalesce("tokens", F.lit(0)).cast("long").alias("tokens"), F.coalesce("score", F.lit(0.0)).alias("score")
    )
    kept = materialize(slim, "balance")
    settled = False
    while True:
        whole = kept.agg(F.sum("tokens")).first()[0] or 0
        if not whole:
            break
        limit = F.create_map(*[x for d, cap in caps.items() for x in (F.lit(d), F.lit(float(cap)))])[F.col("dimension")]
        over = token_totals(kept).filter(F.col("tokens") > limit * F.lit(whole)).collect()  # fewer than 1 / cap rows for each cap
        excess = {d: sum(r["tokens"] / whole - cap for r in over if r["dimension"] == d) for d, cap in caps.items()}
        dimension = max(excess, key=lambda d: excess[d])
        if excess[dimension] <= tolerance:
            settled = True
            break
        groups = [r for r in over if r["dimension"] == dimension]
        cap, k = caps[dimension], len(groups)
        rest = whole - sum(g["tokens"] for g in groups)
        if not rest:
            break  # all that is left is over the cap, whatever is removed
        level = cap * rest / (1 - cap * k) if cap * k < 1 else 0.0
        levels = kept.sparkSession.createDataFrame([(g["value"], float(max(0.0, g["tokens"] - level))) for g in groups], f"{dimension} string, lose double")
        inside = kept.join(F.broadcast(levels), dimension)  # as many rows as groups
        ranked = running_totals(inside, [dimension], [F.col("score"), -F.col("tokens"), F.col("id")], {"upto": F.col("tokens")}, "removal")
        gone = ranked.filter((F.col("upto") - F.col("tokens") < F.col("lose")) & (F.col("tokens") > 0)).select("id")
        smaller = materialize(kept.join(gone, "id", "left_anti"), "balance")
        if smaller.isEmpty():
            break
        release(kept, ranked)
        kept = smaller
    out = docs.join(kept.select("id", F.lit(True).alias("kept")), "id", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))
    return out.withColumn("satisfied", F.lit(settled))


def balance_exact(rows: Sequence[tuple[str, str, str, str, int, float]], caps: Mapping[str, float] = CAPS, tolerance: float = 0.001) -> list[str]:
    """Ids removed one at a time, in order, on a small list of (id, source, category, organization, tokens, score).

    The single-document rule for corpora that fit the driver, and the yardstick of `balance`: among the documents, in
    order of id, whose removal lowers the total excess, the first is the candidate; a later one replaces it only if it
    lowers the excess further and is worse in (score, -tokens, id).
    """
    names = list(caps)
    kept = sorted(rows)
    totals = [Counter() for _ in names]
    for r in kept:
        for i in range(len(names)):
            totals[i][r[1 + i]] += r[4]
    total, removed = sum(r[4] for r in kept), []

    def excess(minus: tuple | None = None) -> float:
        whole = total - (minus[4] if minus else 0)
        if whole <= 0:
            return float("inf")
        out = 0.0
        for i, name in enumerate(names):
            for value, t in totals[i].items():
                t -= minus[4] if minus and minus[1 + i] == value else 0
                out += max(0.0, t / whole - caps[name])
        return out

    while kept and (now := excess()) > tolerance:
        best, lowest = None, now
        for r in kept:
            e = excess(r)
            if e + EPSILON >= lowest:
                continue
            if best is None or (r[5], -r[4], r[0]) < (best[5], -best[4], best[0]):
                best, lowest = r, e
        if best is None:
            break
        kept.remove(best)
        removed.append(best[0])
        total -= best[4]
        for i in range(len(names)):
            totals[i][best[1 + i]] -= best[4]
    return removed


def select_budget(
    docs: DataFrame,
    targets: Mapping[str, float],
    target_tokens: int,
    source_caps: DataFrame | None = None,
    max_source_share: float = 0.30,
    slack: int = 2400,
    tolerance: float = 0.02,
) -> DataFrame:
    """docs(id, source_id, category, tokens, rarity, score) with `decision`: selected, source_cap, category_target or
    not_selected.

    Every category has a budget of its share of the target. In a category the documents come by rarity (fewest sources
    of their rarest concept), then by score, then by id. A document is out if its source, taken over all categories in
    that order, has used up its cap, or if the category has used up its budget and the slack; the rest is cut where
    the whole target and its tolerance are reached, categories in proportion. All three limits are running totals, so
    the selection is one pass of sorted ranges per limit instead of a loop over documents.
    Documents of categories without a target, and those without tokens, are not selected.
    """
    share = F.create_map(*[x for k, v in targets.items() for x in (F.lit(k), F.lit(float(v)))])
    order = [F.col("rarity"), -F.col("score"), F.col("id")]
    slim = docs.select("id", F.coalesce("source_id", F.lit("")).alias("source_id"), "category", F.coalesce("tokens", F.lit(0)).alias("tokens"), "rarity", F.coalesce("score", F.lit(0.0)).alias("score"))
    wanted = slim.filter(F.col("category").isin(*targets) & (F.col("tokens") > 0))
    limit = F.lit(int(target_tokens * max_source_share))
    if source_caps is not None:
        caps = source_caps.select(F.col("id").alias("source_id"), "source_token_cap").dropDuplicates(["source_id"])
        wanted = wanted.join(caps, "source_id", "left").withColumn("limit", F.least(limit, F.coalesce(F.nullif("source_token_cap", F.lit(0)), F.lit(target_tokens))))
    else:
        wanted = wanted.withColumn("limit", limit)
    by_source = running_totals(wanted, ["source_id"], order, {"used": F.col("tokens")}, "source_caps")
    judged = by_source.withColumn("decision", F.when(F.col("used") > F.col("limit"), "source_cap"))
    budget = F.floor(F.lit(target_tokens) * share[F.col("category")])
    left = materialize(judged, "judged")
    by_category = running_totals(left.filter("decision is null"), ["category"], order, {"filled": F.col("tokens")}, "budgets")
    top = F.least(budget + slack, F.floor(budget * (1 + tolerance)))
    chosen = by_category.withColumn("decision", F.when(F.col("filled") > top, "category_target").otherwise("selected"))
    verdicts = left.filter("decision is not null").select("id", "decision").unionByName(chosen.select("id", "decision"))
    return docs.join(verdicts, "id", "left").withColumn("decision", F.coalesce("decision", F.lit("not_selected")))


def preflight_violations(docs: DataFrame, sources: DataFrame, targets: Mapping[str, float], target_tokens: int, tolerance: float = 0.02, category_tolerance: float = 0.05) -> DataFrame:
    """(rule, value) of every reason why no selection from docs(source_id, category, tokens) can reach the target: source
    caps that add up to less, capped supply under the lower bound of the tolerance, a category with less than its share
    less the tolerance. Sources are those of sources(id, source_token_cap)."""
    caps = capped_sources(docs, sources, target_tokens).agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("cap"), F.coalesce(F.sum("capped_tokens"), F.lit(0)).alias("reach"))
    short = F.array_compact(F.array(F.when(F.col("cap") < target_tokens, F.struct(F.lit("source_caps").alias("rule"), F.col("cap").alias("v"))), F.when(F.col("reach") < int(target_tokens * (1 - tolerance)), F.struct(F.lit("eligible_tokens").alias("rule"), F.col("reach").alias("v")))))
    out = caps.select(F.explode(short).alias("x")).select("x.rule", F.col("x.v").cast("string").alias("value"))
    floors = docs.sparkSession.createDataFrame([(k, int(target_tokens * max(0.0, v - category_tolerance))) for k, v in targets.items()], "category string, least long")
    have = floors.join(docs.groupBy("category").agg(F.sum("tokens").alias("t")), "category", "left")
    return out.unionByName(have.filter(F.coalesce("t", F.lit(0)) < F.col("least")).select(F.lit("category_floor").alias("rule"), F.col("category").alias("value")))


def selection_violations(selected: DataFrame, targets: Mapping[str, float], target_tokens: int, tolerance: float = 0.02, max_source_share: float = 0.30, category_tolerance: float = 0.05) -> DataFrame:
    """(rule, value) of every invariant that a final selection breaks: token tolerance, source share, category share,
    repeated ids and repeated contents. selected(id, source_id, category, tokens, content_sha256)."""
    total = selected.agg(F.coalesce(F.sum("tokens"), F.lit(0)).alias("total"))
    bound = total.filter((F.col("total") < int(target_tokens * (1 - tolerance))) | (F.col("total") > int(target_tokens * (1 + tolerance))))
    out = bound.select(F.lit("token_tolerance").alias("rule"), F.col("total").cast("string").alias("value"))
    whole = F.broadcast(total)  # one row
    per = selected.groupBy("source_id").agg(F.sum("tokens").alias("t")).crossJoin(whole)
    out = out.unionByName(per.filter(F.round(F.col("t") / F.col("total"), 4) > max_source_share + 0.0001).select(F.lit("source_share").alias("rule"), F.col("source_id").alias("value")))
    wanted = selected.sparkSession.createDataFrame([(k, float(v)) for k, v in targets.items()], "category string, target double")
    cat = wanted.join(selected.groupBy("category").agg(F.sum("tokens").alias("t")), "category", "left").crossJoin(whole)
    off = F.abs(F.coalesce(F.round(F.col("t") / F.greatest(F.lit(1), F.col("total")), 4), F.lit(0.0)) - F.col("target")) > category_tolerance
    out = out.unionByName(cat.filter(off).select(F.lit("category_share").alias("rule"), F.col("category").alias("value")))
    for rule, key in (("duplicate_id", "id"), ("duplicate_content", "content_sha256")):
        again = selected.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1")
        out = out.unionByName(again.select(F.lit(rule).alias("rule"), F.col(key).alias("value")))
    return out
