"""A sample whose token shares follow category targets, from mergeable per-category reservoirs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.hashing import hex_number
from millrace.functions.keys import squeezed
from millrace.functions.tokens import token_count
from millrace.llm.capping import current_rows
from millrace.runtime import lookup, materialize, running_totals

#: A reservoir holds so many times the tokens that its part of the documents should give to the sample.
SLACK = 1.25
#: A reservoir is trimmed when it has taken in so many documents.
TRIM = 65_536


def prioritized(rows: DataFrame, targets: DataFrame, seed: int = 42) -> DataFrame:
    """Current documents of the targets' categories as (id, category, tokens, priority, share, least).

    The priority is a hash of the id and the seed, so every document has the same one wherever and whenever it is
    read. Labels match a category in any spelling; documents without one are left out. `share` is the largest part of
    all tokens, `least` the largest number of documents that any target set wants of the category.
    """
    counted = rows.select("id", "ord", squeezed(F.col("primary_category")).alias("label"), token_count(F.col("text")).alias("tokens"))
    docs = current_rows(counted, "label", "tokens")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    names = targets.withColumn("label", squeezed(F.col("category"))).filter("label is not null").groupBy("label").agg(
        F.min("category").alias("category"), F.max(zero("target_share") * zero("sample_fraction")).alias("share"), F.max(zero("min_documents")).cast("long").alias("least")
    )
    docs = lookup(docs, names, ["label"]).withColumn("priority", hex_number(F.concat_ws(":", F.lit(str(seed)), "id"), 1, 15).cast("long"))
    return docs.select("id", "category", "tokens", "priority", "share", "least")


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The reservoirs of one part of the documents: the kept ones, then one row per category with what was seen and the
    lowest priority that was dropped."""
    schema = pa.schema([("category", pa.string()), ("id", pa.string()), ("tokens", pa.int64()), ("priority", pa.int64()), ("documents", pa.int64()), ("floor", pa.int64())])
    held: dict[str, list] = {}  # category -> [priorities, tokens, ids]
    seen: dict[str, list] = {}  # category -> [documents, tokens, floor, share, least, taken in since the last trim]
    total = 0

    def trim(c: str) -> None:
        s = seen[c]
        rank, tokens, ids = (np.concatenate(x) for x in held[c])
        order = np.lexsort((ids.astype(str), rank))
        rank, tokens, ids = rank[order], tokens[order], ids[order]
        before = np.cumsum(tokens) - tokens
        keep = int(max(np.searchsorted(before, SLACK * s[3] * total, side="left"), s[4]))
        if keep < len(rank):
            s[2] = int(rank[keep]) if s[2] is None else min(s[2], int(rank[keep]))
        held[c], s[5] = [[rank[:keep]], [tokens[:keep]], [ids[:keep]]], 0

    for batch in batches:
        categories = np.array(batch.column("category").to_pylist(), dtype=object)
        ids = np.array(batch.column("id").to_pylist(), dtype=object)
        tokens, rank, share, least = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("tokens", "priority", "share", "least"))
        total += int(tokens.sum())
        for c in set(categories):
            at = np.flatnonzero(categories == c)
            s = seen.setdefault(c, [0, 0, None, float(share[at[0]]), int(least[at[0]]), 0])
            own = held.setdefault(c, [[], [], []])
            for kept, new in zip(own, (rank, tokens, ids), strict=True):
                kept.append(new[at])
            s[0], s[1], s[5] = s[0] + len(at), s[1] + int(tokens[at].sum()), s[5] + len(at)
            if s[5] > TRIM:
                trim(c)
    for c, s in seen.items():
        trim(c)
        rank, tokens, ids = (x[0] for x in held[c])
        none = pa.nulls(len(rank), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([c] * len(rank), pa.string()), pa.array(ids, pa.string()), pa.array(tokens, pa.int64()), pa.array(rank, pa.int64()), none, none], schema=schema)
        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((c, None, s[1], None, s[0], s[2]), schema, strict=True)], schema=schema)


def reservoirs(docs: DataFrame) -> DataFrame:
    """Stored reservoirs of docs (see `prioritized`), one per category and part of the documents, filled in one pass.

    A reservoir keeps the documents of lowest priority: at least `least` of them, and up to `SLACK` times the tokens
    that `share` of what its part has seen comes to. The parts are those of the hash of the id, so each is a uniform
    sample. Rows with an id are kept documents; a row without one tells how many documents and tokens a part has seen
    of a category and the `floor`, the lowest priority it dropped. Two reservoirs merge by pooling their documents
    below the lower floor, and any uniform trim of the merged one is a cut by priority.
    """
    return materialize(docs.mapInArrow(_fill, "category string, id string, tokens long, priority long, documents long, floor long"), "reservoirs")


def quotas(stored: DataFrame, targets: DataFrame) -> DataFrame:
    """Each target with its wanted tokens, the supply of its category and the feasible quota, by the final counts.

    A category with fewer tokens than wanted gives all it has. Targets of a category without documents have a supply
    of 0; null shares, fractions and minimums count as 0.
    """
    supply = stored.filter("id is null").groupBy("category").agg(F.sum("documents").alias("supply_documents"), F.sum("tokens").alias("supply_tokens"))
    total = supply.agg(F.coalesce(F.sum("supply_tokens"), F.lit(0)).alias("total"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    out = targets.crossJoin(F.broadcast(total)).join(supply, "category", "left")  # total is one row
    want = zero(F.col("target_share")) * zero(F.col("sample_fraction")) * F.col("total")
    out = out.select(
        "target_set",
        "category",
        zero(F.col("target_share")).alias("target_share"),
        zero(F.col("min_documents")).alias("min_documents"),
        want.alias("wanted_tokens"),
        zero(F.col("supply_documents")).alias("supply_documents"),
        zero(F.col("supply_tokens")).alias("supply_tokens"),
    )
    return out.withColumn("quota", F.least(F.col("wanted_tokens"), F.col("supply_tokens")))


def draw(docs: DataFrame, stored: DataFrame, plan: DataFrame) -> DataFrame:
    """Documents of every target set: (target_set, category, id, tokens), from the reservoirs trimmed to the quotas.

    In the order of priority a document belongs to the sample while the tokens up to and including it stay within the
    quota, or while fewer than the minimum of documents came before it. Below the lowest floor of a category the
    reservoirs hold every document. Where a quota reaches beyond that, which the slack makes rare, the documents from
    the floor on are read again from `docs`, so the sample is exact however the parts have turned out.
    """
    floors = stored.filter("id is null").groupBy("category").agg(F.min("floor").alias("floor"))
    pool = lookup(stored.filter("id is not null").select("category", "id", "tokens", "priority"), floors, ["category"])
    pool = pool.filter("floor is null or priority < floor").drop("floor")
    have = pool.groupBy("category").agg(F.sum("tokens").alias("t"), F.count("*").alias("d"))
    most = plan.groupBy("category").agg(F.max("quota").alias("q"), F.max("min_documents").alias("m"))
    short = floors.filter("floor is not null").join(have, "category", "left").join(most, "category").filter("coalesce(t, 0) <= q or coalesce(d, 0) < m").select("category", "floor")
    short = materialize(short, "incomplete")
    if not short.isEmpty():
        rest = lookup(docs.select("category", "id", "tokens", "priority"), short, ["category"])
        pool = pool.unionByName(rest.filter("priority >= floor").drop("floor"))
    ranked = running_totals(pool, ["category"], [F.col("priority"), F.col("id")], {"nd": F.lit(1).cast("long"), "nt": F.col("tokens")}, "pool")
    goals = plan.select("target_set", "category", "quota", "min_documents")
    return lookup(ranked, goals, ["category"]).filter("nt <= quota or nd <= min_documents").select("target_set", "category", "id", "tokens")


def sample_plan(rows: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The documents (not stored), their stored reservoirs and the plan of quotas."""
    docs = prioritized(rows, targets)
    stored = reservoirs(docs)
    return docs, stored, quotas(stored, targets)


def sample_report(sample: DataFrame, plan: DataFrame) -> DataFrame:
    """Per target: what was wanted and what the sample holds, with its actual share of the set's tokens;
    0 for an empty sample. `met` is false if all documents of the category were drawn and still the tokens wanted or
    the minimum of documents are not reached: such a category is exhausted."""
    got = sample.groupBy("target_set", "category").agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    out = plan.join(got, ["target_set", "category"], "left").fillna(0, ["documents", "tokens"])
    share = F.coalesce(F.try_divide("tokens", F.sum("tokens").over(Window.partitionBy("target_set"))), F.lit(0.0))
    exhausted = F.col("documents") >= F.col("supply_documents")
    missed = (F.col("tokens") < F.col("wanted_tokens")) | (F.col("documents") < F.col("min_documents"))
    return out.select("target_set", "category", "target_share", F.round(share, 6).alias("actual_share"), "documents", "tokens", (~(exhausted & missed)).alias("met"))
