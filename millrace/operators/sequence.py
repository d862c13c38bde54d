"""Lengths of documents and the packing of one token stream into fixed sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import token_ids
from millrace.functions.text import PIECE, words
from millrace.runtime import rank_within, running_totals

QUANTILES = {"p10": 0.10, "p25": 0.25, "median": 0.50, "p75": 0.75, "p90": 0.90, "p95": 0.95, "p99": 0.99}


def length_percentiles(lengths: DataFrame) -> DataFrame:
    """One row of percentiles of lengths(tokens): the value at the lower index floor(p * (n - 1)) in sorted order.

    Values are counted first, so only the distinct lengths are put in order.
    """
    counts = lengths.groupBy("tokens").agg(F.count("*").alias("n"))
    upto = counts.withColumn("all", F.lit(0)).transform(lambda d: running_totals(d, ["all"], [F.col("tokens")], {"upto": F.col("n")}, "lengths"))
    total = counts.agg(F.sum("n").alias("total"), F.sum(F.col("n") * F.col("tokens")).alias("sum"))
    at = upto.crossJoin(F.broadcast(total))  # one row
    pick = [F.min(F.when(F.col("upto") > F.floor(F.lit(p) * (F.col("total") - 1)), F.col("tokens"))).alias(k) for k, p in QUANTILES.items()]
    return at.agg(F.min("tokens").alias("min_tokens"), *pick, F.max("tokens").alias("max_tokens"), F.round(F.max("sum") / F.max("total"), 2).alias("mean_tokens"))


def context_fit(lengths: DataFrame, contexts: Sequence[int] = (512, 1024, 2048, 4096)) -> DataFrame:
    """Per context length: share of documents that fit, sequences if each document is cut alone, and their filling."""
    each = lengths.select("tokens", F.explode(F.array(*[F.lit(c) for c in contexts])).alias("context_length"))
    agg = each.groupBy("context_length").agg(
        F.round(F.avg((F.col("tokens") <= F.col("context_length")).cast("double")) * 100, 2).alias("fitting_pct"),
        F.round(F.avg((F.col("tokens") > F.col("context_length")).cast("double")) * 100, 2).alias("splitting_pct"),
        F.sum(F.ceil(F.col("tokens") / F.col("context_length"))).alias("sequences"),
        F.sum("tokens").alias("tokens"),
    )
    return agg.withColumn("filling_pct", F.round(F.coalesce(F.try_divide("tokens", F.col("sequences") * F.col("context_length")) * 100, F.lit(0.0)), 2)).drop("tokens")


def pack_stream(docs: DataFrame, length: int = 2048, eos: int = 0, pad: int | None = None) -> DataFrame:
    """Sequences of the stream of all documents in order of id: (sequence, input_ids, labels, attention_mask).

    docs(id, text) needs unique ids. Every document that has tokens is followed by an end mark; the stream is cut every
    `length` tokens and the last sequence is padded, with labels of -100. Sizes are put in order first, by id alone; a
    document's place is the running sum of the sizes before it. Then its tokens are made and cut at the borders of the
    sequences that it overlaps, so texts are moved once, to their place, and tokens once, to their sequence, in a few slices per
    document and never one by one. Null and blank texts give nothing.
    """
    if length <= 0:
        raise ValueError("the sequence length must be positive")
    sizes = docs.select("id", (F.regexp_count("text", F.lit(PIECE)) + 1).cast("long").alias("size")).filter("size > 1").withColumn("all", F.lit(0))
    placed = running_totals(sizes, ["all"], [F.col("id")], {"end": F.col("size")}, "stream").select("id", (F.col("end") - F.col("size")).alias("begin"), "end")
    ids = F.concat(token_ids(words(F.col("text"))), F.array(F.lit(eos).cast("bigint")))
    tokens = docs.select("id", "text").join(placed, "id").select(ids.alias("ids"), "begin", "end")
    cut = tokens.select("ids", "begin", F.explode(F.sequence(F.floor(F.col("begin") / length), F.floor((F.col("end") - 1) / length))).alias("sequence"))
    lo = F.greatest(F.col("begin"), F.col("sequence") * length)
    hi = F.least(F.col("begin") + F.size("ids"), (F.col("sequence") + 1) * length)
    part = cut.select("sequence", lo.alias("at"), F.slice("ids", (lo - F.col("begin") + 1).cast("int"), (hi - lo).cast("int")).alias("ids"))
    rows = part.groupBy("sequence").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    body = rows.select("sequence", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("body"))
    fill = lambda v: F.array_repeat(F.lit(v).cast("bigint"), length - F.size("body"))
    ones = F.array_repeat(F.lit(1).cast("bigint"), F.size("body"))
    return body.select(
        "sequence",
        F.concat("body", fill(eos if pad is None else pad)).alias("input_ids"),
        F.concat("body", fill(-100)).alias("labels"),
        F.concat(ones, fill(0)).alias("attention_mask"),
    )


def packing_statistics(sequences: DataFrame) -> DataFrame:
    """One row of totals of packed sequences."""
    used = F.aggregate("attention_mask", F.lit(0).cast("bigint"), lambda a, x: a + x)
    out = sequences.agg(F.coalesce(F.sum(used), F.lit(0)).alias("packed_tokens"), F.coalesce(F.sum(F.size("input_ids") - used), F.lit(0)).alias("padding_tokens"), F.count("*").alias("sequences"))
    space = F.col("packed_tokens") + F.col("padding_tokens")
    return out.withColumn("efficiency", F.when(space > 0, F.round(F.col("packed_tokens") / space, 6)).otherwise(0.0))


def batch_problems(sequences: DataFrame, vocabulary: int) -> DataFrame:
    """The sequences that cannot be trained on, with `problem`."""
    problem = (
        F.when((F.size("input_ids") <= 0) | (F.size("input_ids") != F.size("labels")), "length")
        .when(F.exists("input_ids", lambda t: (t < 0) | (t >= vocabulary)), "token_range")
        .when(F.forall("labels", lambda t: t == -100), "no_labels")
    )
    return sequences.select("sequence", problem.alias("problem")).filter("problem is not null")


def stratified_head(rows: DataFrame, by: str, order: str, sizes: dict[str, int], salts: int = 64) -> DataFrame:
    """The first rows of every stratum in order, as many as `sizes` says; equal ones in any order. A stratum is cut down
    in `salts` parts first, so that one which holds a third of all rows is not sorted in one task."""
    wanted = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])[F.col(by)]
    chosen = rows.filter(F.col(by).isin(*sizes)).withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(salts)))
    for keys in ([by, "_salt"], [by]):
        w = Window.partitionBy(*keys).orderBy(order)
        chosen = chosen.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= wanted).drop("_n")
    return chosen.drop("_salt")


__all__ = ["batch_problems", "context_fit", "length_percentiles", "pack_stream", "packing_statistics", "rank_within", "stratified_head"]
