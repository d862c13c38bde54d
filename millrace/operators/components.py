"""Connected components by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.runtime import materialize, release


def merge_components(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """Component of every node after adding links(u, v) to known(node, component).

    A component is named by its smallest node. Links are first reduced to distinct pairs of current components. Then,
    until none is left, every component points to its smallest neighbour if that is smaller, chains of pointers are
    shortened by jumping (each pointer is replaced by its pointer's pointer), and the links are rewritten in terms of
    the new components. A hub with many links is never gathered: its smallest neighbour is an aggregate combined
    before the shuffle. Null nodes link nothing; a link of a node to itself only makes it known.
    """
    nodes = links.select(F.col("u").alias("node")).unionByName(links.select(F.col("v").alias("node"))).filter("node is not null").distinct()
    state = nodes.select("node", F.col("node").alias("component"))
    if known is not None:
        fresh = nodes.join(known.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
        state = known.select("node", "component").unionByName(fresh)
    state = materialize(state, "components")

    def ends(edges: DataFrame, to: DataFrame, key: str, value: str) -> DataFrame:
        a = to.select(F.col(key).alias("u"), F.col(value).alias("cu"))
        b = to.select(F.col(key).alias("v"), F.col(value).alias("cv"))
        both = edges.join(a, "u").join(b, "v").filter("cu <> cv")
        return both.select(F.least("cu", "cv").alias("u"), F.greatest("cu", "cv").alias("v")).distinct()

    pairs = links.filter("u is not null and v is not null and u <> v").select("u", "v").distinct()
    edges = materialize(ends(pairs, state, "node", "component"), "links")
    while not edges.isEmpty():
        near = edges.select(F.col("u").alias("node"), F.col("v").alias("other")).unionByName(edges.select(F.col("v").alias("node"), F.col("u").alias("other")))
        jump = materialize(near.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("to")), "pointers")
        while True:
            ahead = jump.select(F.col("node").alias("to"), F.col("to").alias("next"))
            longer = materialize(jump.join(ahead, "to").select("node", F.col("next").alias("to"), (F.col("next") != F.col("to")).alias("moved")), "pointers")
            release(jump)
            jump = longer
            if jump.filter("moved").isEmpty():
                break
        renamed = jump.select(F.col("node").alias("component"), "to")
        new_state = materialize(state.join(renamed, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "components")
        new_edges = materialize(ends(edges, jump, "node", "to"), "links")
        release(state, edges, jump)
        state, edges = new_state, new_edges
    release(edges)
    return state
