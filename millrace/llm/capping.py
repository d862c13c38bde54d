"""Capping records per dominant contributor by distributed suitor b-matching."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.keys import linking_key, squeezed
from millrace.runtime import lookup, materialize, rank_within, release


def current_rows(rows: DataFrame, *cols: str | Column) -> DataFrame:
    """The row with the largest `ord` of each `id`, reduced to `cols`. Rows without an id are no documents and are
    left out; a null `ord` is older than any other. Deliveries of one id are combined before the shuffle."""
    latest = F.max_by(F.struct(*cols), F.coalesce(F.col("ord"), F.lit(-(2**63))))
    return rows.filter(F.col("id").isNotNull()).groupBy("id").agg(latest.alias("_row")).select("id", "_row.*")


def suitor_caps(edges: DataFrame, capacities: DataFrame, order: Sequence[Column], record: str = "record") -> DataFrame:
    """Decide which records stay when every contributor may keep at most its capacity.

    `edges(record, contributor, <columns of order>)` lists each record's contributors, `capacities(contributor,
    capacity)` the limits; edges to contributors without a limit are always accepted. `order` ranks proposals from
    best to worst and must be unique per record and the same for all its contributors.

    Each round every undecided record proposes to all its contributors, which rank the proposals and hold the best
    ones that fit. A record held by all of them stays and uses up a place at each; a record that proposes to a
    contributor without places left is displaced, which withdraws its other proposals and lets weaker ones move up.
    The rounds end when all records are decided; the result equals visiting the records in `order` and keeping each
    one whose contributors all have room. With one contributor per record a single round decides everything.

    The records decided in a round are stored; what else a round stored is deleted in the next. A contributor that a
    third of all records name is ranked over many partitions and looked up by salted joins.

    Returns (record, kept) for every record in `edges`. An empty input gives an empty result; repeated edges count
    once; a null contributor or capacity imposes no limit; a capacity of 0 or less keeps nothing.
    """
    limits = capacities.filter(F.col("contributor").isNotNull() & F.col("capacity").isNotNull())
    limits = materialize(limits.groupBy("contributor").agg(F.min("capacity").cast("long").alias("room")), "limits")
    everyone = materialize(edges.dropDuplicates([record, "contributor"]), "proposals")
    undecided = lookup(everyone, limits.select("contributor"), ["contributor"], "left_semi")
    decided: list[DataFrame] = []
    room, spent = limits, []
    while True:
        wanted = undecided.groupBy("contributor").agg(F.count("*").alias("wanted"))
        room = materialize(room.join(wanted, "contributor").select("contributor", "room", "wanted"), "room")
        spent.append(room)
        tight = room.filter("wanted > room").select("contributor", "room")
        if tight.isEmpty():
            decided.append(undecided.select(record, F.lit(True).alias("kept")).distinct())
            break
        contested = rank_within(lookup(undecided, tight, ["contributor"]), ["contributor"], order, "_rank")
        loose = lookup(undecided, room.filter("wanted <= room").select("contributor"), ["contributor"], "left_semi")
        held = contested.select(record, "contributor", (F.col("_rank") <= F.col("room")).alias("held")).unionByName(
            loose.select(record, "contributor", F.lit(True).alias("held"))
        )
        verdict = held.groupBy(record).agg(F.min("held").alias("held_by_all"), F.collect_set("contributor").alias("_at"))
        verdict = materialize(verdict, "verdicts")
        release(contested)
        used = verdict.filter("held_by_all").select(F.explode("_at").alias("contributor")).groupBy("contributor").agg(F.count("*").alias("used"))
        room = materialize(room.join(used, "contributor", "left").select("contributor", (F.col("room") - F.coalesce("used", F.lit(0))).alias("room")), "room")
        full = room.filter("room <= 0").select("contributor")
        turned = lookup(verdict.filter(~F.col("held_by_all")).select(record, F.explode("_at").alias("contributor")), full, ["contributor"], "left_semi")
        step = verdict.filter("held_by_all").select(record, F.lit(True).alias("kept")).unionByName(turned.select(record).distinct().select(record, F.lit(False).alias("kept")))
        step = materialize(step, "decided")
        decided.append(step)
        left = materialize(undecided.join(step, record, "left_anti"), "undecided")
        release(verdict, *spent, undecided)
        undecided, spent = left, [room]
        if undecided.isEmpty():
            break
    out = decided[0]
    for more in decided[1:]:
        out = out.unionByName(more)
    limited = lookup(everyone, limits.select("contributor"), ["contributor"], "left_semi").select(record).distinct()
    unlimited = everyone.select(record).distinct().join(limited, record, "left_anti")
    return out.unionByName(unlimited.select(record, F.lit(True).alias("kept")))


def quality_order() -> list[Column]:
    """Best score first; a score that is null, NaN or outside 0..1 comes after all others; equal ones by id."""
    valid = F.col("quality_score").between(0.0, 1.0)
    return [F.coalesce(F.when(valid, -F.col("quality_score")), F.lit(2.0)).alias("_worst"), F.col("id")]


def source_capacities(sources: DataFrame, documents: int) -> DataFrame:
    """`floor(document_cap_permille * documents / 1000)` for every source that has a cap; negative caps count as 0."""
    return (
        sources.filter(F.col("document_cap_permille").isNotNull())
        .select(
            squeezed(F.col("id")).alias("contributor"),
            F.floor(F.greatest(F.col("document_cap_permille").cast("long"), F.lit(0)) * F.lit(documents) / 1000).alias("capacity"),
        )
        .filter(F.col("contributor").isNotNull())
    )


def cap_documents(rows: DataFrame, sources: DataFrame, author_permille: int | None = None) -> DataFrame:
    """Current documents with `kept`, each capped source keeping its best by quality.

    With `author_permille` the document's author is a second contributor, whose capacity is that share of all
    documents. Documents without a source or author are not limited by it.
    """
    author = F.col("metadata")["author"]
    docs = materialize(
        current_rows(rows, F.col("source_id"), F.col("quality_score"), author.alias("author")).select("id", squeezed(F.col("source_id")).alias("source"), "quality_score", "author"),
        "documents",
    )
    n = docs.count()
    caps = source_capacities(sources, n)
    edges = docs.select("id", F.col("source").alias("contributor"), "quality_score").filter("contributor is not null")
    if author_permille is not None:
        who = linking_key(F.col("author"))
        by_author = docs.select("id", F.concat(F.lit("author:"), who).alias("contributor"), "quality_score").filter("contributor is not null")
        caps = caps.unionByName(by_author.select("contributor").distinct().withColumn("capacity", F.lit(author_permille * n // 1000)))
        edges = edges.unionByName(by_author)
    else:
        edges = lookup(edges, caps.select("contributor"), ["contributor"], "left_semi")
    worst, tie = quality_order()
    verdicts = suitor_caps(edges.withColumn("_worst", worst).drop("quality_score"), caps, [F.col("_worst"), tie], record="id")
    return docs.join(verdicts, "id", "left").withColumn("kept", F.coalesce("kept", F.lit(True)))
