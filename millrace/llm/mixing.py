"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import hex_number
from millrace.functions.keys import squeezed
from millrace.functions.tokens import token_count
from millrace.runtime import lookup, materialize, rank_within


def sized_pages(documents: DataFrame) -> DataFrame:
    """Pages as (doc_id, source, tokens), stored; a page without a source counts for the total only."""
    return materialize(documents.select("doc_id", squeezed(F.col("source")).alias("source"), token_count(F.col("text")).alias("tokens")), "pages")


def mixture_plan(pages: DataFrame, weights: DataFrame) -> DataFrame:
    """Every row of `weights` with the tokens its source should give, its supply, and the expected copies of a page.

    The copies are `wanted / supply`, at most `max_repeats`. `most_copies` is what the source can give at all: each of
    its pages that has tokens, `max_repeats` times. Null weights, fractions and repeats count as 0. A source without
    pages has a supply of 0.
    """
    supply = pages.groupBy("source").agg(F.sum("tokens").alias("supply"), F.count_if(F.col("tokens") > 0).alias("filled"))
    total = supply.agg(F.coalesce(F.sum("supply"), F.lit(0)).alias("total"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = weights.withColumn("source", squeezed(F.col("source_key"))).crossJoin(F.broadcast(total))  # total is one row
    rows = rows.join(supply.filter("source is not null"), "source", "left").withColumn("supply", zero("supply"))
    wanted = zero("target_weight") * zero("budget_fraction") * F.col("total")
    copies = F.when(F.col("supply") > 0, F.least(F.col("wanted") / F.col("supply"), zero("max_repeats").cast("double"))).otherwise(0.0)
    out = rows.withColumn("wanted", wanted).withColumn("copies_each", copies).withColumn("most_copies", zero("filled") * zero("max_repeats"))
    return out.select("mixture_id", "source_key", "source", "target_weight", "wanted", "supply", "copies_each", "most_copies")


def _uniform(*parts, digits: int = 15):
    """A number from the hash of the parts, the same wherever it is computed."""
    return hex_number(F.concat_ws(":", *[p.cast("string") for p in parts]), 1, digits).cast("long")


def mix(pages: DataFrame, plan: DataFrame, seed: int = 42) -> DataFrame:
    """(mixture_id, source_key, doc_id, tokens, copies) of every page that a mixture uses.

    The pages of a source are put in order of size, their expected copies are summed up along it, one random offset
    per mixture and source is added, and a page is used once for every integer that its stretch of the sum crosses.
    A page's copies thus differ from the expectation by less than one, sizes are represented evenly, and the source's
    total comes close to the wanted tokens. The order of a source is shared by all mixtures, so one distributed
    running sum serves them all; a source with a third of all pages is spread over many partitions.
    """
    used = lookup(pages, plan.filter("copies_each > 0").select("source").distinct(), ["source"], "left_semi")
    ranked = rank_within(used, ["source"], [F.col("tokens"), _uniform(F.lit(seed), F.col("doc_id")), F.col("doc_id")], "place")
    offset = _uniform(F.lit(seed), F.col("mixture_id"), F.col("source"), digits=5) / float(1 << 20)
    goals = plan.filter("copies_each > 0").select("mixture_id", "source_key", "source", "copies_each", offset.alias("offset"))
    drawn = lookup(ranked, goals, ["source"])
    at = lambda place: F.floor(F.col("copies_each") * place + F.col("offset"))
    drawn = drawn.withColumn("copies", at(F.col("place")) - at(F.col("place") - 1)).filter("copies > 0")
    return drawn.select("mixture_id", "source_key", "doc_id", "tokens", "copies")


def mixture_report(drawn: DataFrame, plan: DataFrame) -> DataFrame:
    """Per mixture and source: pages, tokens and share reached beside the target, and whether the source fell short.

    `short` is judged by what was drawn: every page with tokens as often as it may be, and still fewer tokens than
    wanted.
    """
    got = drawn.groupBy("mixture_id", "source_key").agg(
        F.count("*").alias("pages"), F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.sum(F.when(F.col("tokens") > 0, F.col("copies"))).alias("copies")
    )
    out = plan.join(got, ["mixture_id", "source_key"], "left").fillna(0, ["pages", "tokens", "copies"])
    share = F.coalesce(F.try_divide("tokens", F.sum("tokens").over(Window.partitionBy("mixture_id"))), F.lit(0.0))
    short = (F.col("copies") >= F.col("most_copies")) & (F.col("tokens") < F.col("wanted"))
    return out.select("mixture_id", "source_key", "target_weight", F.round(share, 6).alias("actual_share"), "pages", "tokens", "wanted", short.alias("short"))
