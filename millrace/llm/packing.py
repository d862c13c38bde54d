"""Filling fixed-capacity sequences with whole documents by bulk-synchronous best fit."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import BROADCAST_ROWS, lookup, materialize, numbered, rank_within, release

#: Kinds of rows of the state: a placed piece, a waiting piece, a sequence with its gap, and a run's last sequence.
PLACED, ITEM, GAP, LAST = 0, 1, 2, 3
#: The upper class of sizes are those above this part of the largest waiting piece.
CLASS = 2
#: When the largest waiting piece is at most this fraction of the capacity, all sizes are placed in one round.
FINE = 16
#: Columns of the state; `size` is the gap of a sequence, `bin` the sequence of a placed piece.
COLUMNS = ["run_id", "id", "piece", "pieces", "capacity", "size", "kind", "bin"]


def divide(items: DataFrame) -> DataFrame:
    """Items(run_id, id, tokens, capacity) as pieces(run_id, id, capacity, piece, pieces, size).

    Only an item larger than its capacity is divided: into full pieces and a remainder. An item of size 0 is one
    empty piece. Items without a run, or of a run without a positive capacity, cannot be placed and are left out.
    """
    usable = items.filter("run_id is not null and capacity > 0").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.col("capacity"))).cast("long")
    cut = numbered(usable.withColumn("pieces", pieces), F.col("pieces"), "piece")
    size = F.least(F.col("capacity"), F.col("tokens") - (F.col("piece") - 1) * F.col("capacity")).cast("long")
    return cut.select("run_id", "id", "capacity", "piece", "pieces", size.alias("size"))


def _match_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brackets of one sorted range: matched items with their `bin`, and what stays open, with its `level`.

    A slot meets the last item before it that is still open. Slots that meet none come first in the open rest of a
    run, at the levels 0, -1, ..., and the items that no slot meets follow, at rising levels.
    """
    names = ["run_id", "part", "level", "kind", "id", "piece", "pieces", "capacity", "size", "bin"]
    out: list[tuple] = []
    open_items: list[tuple] = []
    current, part, closes = None, None, 0
    schema = None

    def leave() -> None:
        nonlocal closes
        out.extend((current, part, 1 - closes + i, ITEM, *item, None) for i, item in enumerate(open_items))
        open_items.clear()
        closes = 0

    def flush() -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) if out else [()] * len(names)
        done = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)
        out.clear()
        return done

    for batch in batches:
        if schema is None:
            of = lambda n: batch.schema.field(n).type  # noqa: E731, B023
            kinds = [of("run_id"), pa.int32(), pa.int64(), pa.int32(), of("id"), pa.int64(), pa.int64(), of("capacity"), pa.int64(), pa.int64()]
            schema = pa.schema(list(zip(names, kinds, strict=True)))
        cols = (batch.column(n).to_pylist() for n in ("run_id", "part", "kind", "id", "piece", "pieces", "capacity", "size", "bin"))
        for run, p, kind, i, piece, pieces, capacity, size, bin_ in zip(*cols, strict=True):
            if run != current:
                leave()
                current, part = run, p
            if kind == ITEM:
                open_items.append((i, piece, pieces, capacity, size))
            elif open_items:
                out.append((run, p, None, ITEM, *open_items.pop(), bin_))
            else:
                out.append((run, p, -closes, GAP, None, None, None, capacity, size, bin_))
                closes += 1
        yield flush()
    leave()
    if out:
        yield flush()


def sweep(items: DataFrame, slots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Match items(`COLUMNS`) to slots(run_id, capacity, bin, room), each slot with at most one item that fits.

    Items and slots are range-sorted together by run and size, an item before a slot of its size. Along this order an
    item opens a bracket and a slot closes one, so each slot meets the largest item that fits and that no smaller
    slot has taken; equal items and slots go by id, piece and sequence. Every range is swept on its own first. What
    stays open of a range are slots, then items; its net depth is carried to the later ranges of the run by a prefix
    sum, and the open rest is matched by its global depth, at which every range has at most one slot and one item. So
    the result is that of one sweep over the whole run, whatever the ranges, and no group is larger than twice their
    number. Returns the items with `bin`, null for those that met no slot, and the stored table they are read from.
    """
    line = items.select(*COLUMNS).unionByName(slots.select("run_id", "capacity", F.col("room").alias("size"), F.lit(GAP).alias("kind"), "bin"), allowMissingColumns=True)
    order = ["run_id", "size", "kind", "id", "piece", "bin"]
    line = line.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    types = {f.name: f.dataType.simpleString() for f in items.schema}
    shape = f"run_id {types['run_id']}, part int, level long, kind int, id string, piece long, pieces long, capacity {types['capacity']}, size long, bin long"
    swept = materialize(line.mapInArrow(_match_range, shape), "sweep")
    rest = swept.filter("level is not null")
    net = rest.groupBy("run_id", "part").agg(F.sum(F.when(F.col("kind") == ITEM, 1).otherwise(-1)).alias("net"))
    before = Window.partitionBy("run_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = net.select("run_id", "part", F.coalesce(F.sum("net").over(before), F.lit(0)).alias("base"))
    rest = rest.join(base, ["run_id", "part"]).withColumn("depth", F.col("level") + F.col("base"))
    along = Window.partitionBy("run_id", "depth").orderBy("part", F.col("kind").desc())
    rest = rest.withColumn("bin", F.when(F.col("kind") == ITEM, F.when(F.lead("kind").over(along) == GAP, F.lead("bin").over(along))))
    return rest.filter(F.col("kind") == ITEM).select(*COLUMNS).unionByName(swept.filter("level is null").select(*COLUMNS)), swept


def pack(items: DataFrame) -> DataFrame:
    """Place items(run_id, id, tokens, capacity) into sequences: (run_id, bin, id, piece, pieces, size, capacity).

    Full pieces get a sequence each. For the others each run opens as many sequences as their tokens need at least and
    gives its largest pieces one each. Then rounds follow: the pieces in the upper class of the sizes still waiting are
    range-sorted with the slots that the gaps offer them, each takes the tightest slot it meets (see `sweep`), and the
    gaps are updated. Where less than half of them meet one, the rest opens as many new sequences as its tokens need. The size classes
    shrink from round to round and the matching does not depend on the ranges of the sort, so the number of rounds
    depends on the capacity, not on the number of documents or partitions. All runs move in step; a run that holds a
    third of all documents spreads over the partitions of the sort. Two stored tables a round carry the state.

    Empty pieces, and items with null tokens, go to sequence 1 of their run. Repeated (run_id, id) rows must be merged
    by the caller; ties are broken by id and piece. An empty table gives an empty result.
    """
    pieces = materialize(divide(items), "pieces")
    solid = pieces.filter("size > 0")
    partial = F.when(F.col("size") < F.col("capacity"), F.col("size"))
    runs = solid.groupBy("run_id").agg(F.count_if(F.col("size") == F.col("capacity")).alias("full"), F.ceil(F.coalesce(F.sum(partial), F.lit(0)) / F.max("capacity")).cast("long").alias("open"), F.max("capacity").alias("capacity"))
    runs = materialize(runs.withColumn("first", F.col("full") + F.col("open")), "runs")
    few = runs.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS

    def by_run(rows: DataFrame, side: DataFrame, how: str = "inner") -> DataFrame:
        return rows.join(F.broadcast(side), "run_id", how) if few else lookup(rows, side, ["run_id"], how, 0)

    ranked = rank_within(solid, ["run_id"], [-F.col("size"), F.col("id"), F.col("piece")])
    top = by_run(ranked, runs.drop("capacity"))
    early = F.col("rank") <= F.col("first")
    start = top.select(*COLUMNS[:-2], F.when(early, PLACED).otherwise(ITEM).alias("kind"), F.when(early, F.col("rank")).alias("bin"))
    bins = top.filter("rank > full and rank <= first").select("run_id", "capacity", (F.col("capacity") - F.col("size")).alias("size"), F.lit(GAP).alias("kind"), F.col("rank").alias("bin"))
    last = runs.select("run_id", "capacity", F.lit(LAST).alias("kind"), F.col("first").alias("bin"))
    union = lambda *frames: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames).select(*COLUMNS)
    state = materialize(union(start, bins, last), "packing")
    release(ranked)
    placed = [pieces.filter("size = 0").withColumn("bin", F.lit(1).cast("long")), state.filter(F.col("kind") == PLACED)]
    while not (waiting := state.filter(F.col("kind") == ITEM)).isEmpty():
        head = waiting.groupBy("run_id").agg(F.max("size").alias("top"))
        now = by_run(state.filter(F.col("kind").isin(ITEM, GAP)), head, "left").withColumn("active", (F.col("kind") == ITEM) & ((CLASS * F.col("size") > F.col("top")) | (FINE * F.col("top") <= F.col("capacity"))))
        n = F.greatest(F.lit(1), F.floor(F.col("size") / F.col("top"))).cast("int")
        slots = now.filter((F.col("kind") == GAP) & F.col("top").isNotNull()).select("run_id", "capacity", "bin", F.explode(F.array_repeat(F.floor(F.col("size") / n).cast("long"), n)).alias("room"))
        met, swept = sweep(now.filter("active"), slots)
        # a run in which less than half of them found a slot opens sequences for the rest; other runs look again first
        left = F.ceil(F.sum(F.when(F.col("bin").isNull(), F.col("size"))) / F.max("capacity"))
        need = met.groupBy("run_id").agg(F.when(2 * F.count("bin") < F.count("*"), left).otherwise(0).cast("long").alias("more"))
        ends = by_run(state.filter(F.col("kind") == LAST), need, "left").withColumn("more", F.coalesce("more", F.lit(0)))
        fresh = numbered(ends, F.col("more"), "i").select("run_id", "capacity", F.col("capacity").cast("long").alias("size"), F.lit(GAP).alias("kind"), (F.col("bin") + F.col("i")).alias("bin"))
        change = state.filter(F.col("kind") == GAP).select("run_id", "bin", "capacity", "size").unionByName(met.filter("bin is not null").select("run_id", "bin", "capacity", (-F.col("size")).alias("size")))
        gaps = change.groupBy("run_id", "bin").agg(F.max("capacity").alias("capacity"), F.sum("size").alias("size")).filter("size > 0").withColumn("kind", F.lit(GAP))
        settled = met.withColumn("kind", F.when(F.col("bin").isNotNull(), PLACED).otherwise(ITEM))
        ends = ends.select("run_id", "capacity", "kind", (F.col("bin") + F.col("more")).alias("bin"))
        state = materialize(union(settled, now.filter((F.col("kind") == ITEM) & ~F.col("active")), gaps, fresh, ends), "packing")
        release(swept)
        placed.append(state.filter(F.col("kind") == PLACED))
    release(runs)
    out = [p.select("run_id", "bin", "id", "piece", "pieces", "size", "capacity") for p in placed]
    return reduce(DataFrame.unionByName, out)


def packing_report(packed: DataFrame) -> DataFrame:
    """Per run: sequences, packed and padding tokens, documents, divided documents and the share of space used."""
    bins = packed.groupBy("run_id", "bin").agg(F.sum("size").alias("used"), F.max("capacity").alias("capacity"))
    a = bins.filter("used > 0").groupBy("run_id").agg(F.count("*").alias("sequences"), F.sum("used").alias("packed_tokens"), F.sum(F.col("capacity") - F.col("used")).alias("padding_tokens"))
    b = packed.filter("piece = 1").groupBy("run_id").agg(F.count("*").alias("documents"), F.count_if(F.col("pieces") > 1).alias("divided_documents"))
    space = F.col("packed_tokens") + F.col("padding_tokens")
    return a.join(b, "run_id").withColumn("efficiency", F.round(F.col("packed_tokens") / space, 6))


def packing_checks(packed: DataFrame) -> DataFrame:
    """Per run, from the placements alone: documents, tokens placed, documents that lie in several sequences, sequences
    over the capacity, documents divided although they fit, pieces placed more than once, and whether fewer than two
    sequences in a hundred (or one in all) are more than the tokens need at least."""
    bins = packed.groupBy("run_id", "bin").agg(F.sum("size").alias("used"), F.max("capacity").alias("capacity"))
    a = bins.groupBy("run_id").agg(F.count_if(F.col("used") > F.col("capacity")).alias("overfull_sequences"), F.count_if(F.col("used") > 0).alias("n"), F.sum("used").alias("tokens"), F.max("capacity").alias("capacity"))
    docs = packed.groupBy("run_id", "id").agg(F.sum("size").alias("size"), F.max("capacity").alias("capacity"), (F.min("bin") < F.max("bin")).alias("divided"), (F.count("*") != F.max("pieces")).alias("odd"))
    b = docs.groupBy("run_id").agg(
        F.count("*").alias("documents"), F.count_if("divided").alias("divided_documents"), F.count_if(F.col("divided") & (F.col("size") <= F.col("capacity"))).alias("divided_below_capacity"), F.count_if("odd").alias("wrong_pieces")
    )
    tight = F.col("n") <= F.greatest(F.floor(1.02 * F.ceil(F.col("tokens") / F.col("capacity"))), F.ceil(F.col("tokens") / F.col("capacity")) + 1)
    return b.join(a, "run_id").select("run_id", "documents", "tokens", "divided_documents", "overfull_sequences", "divided_below_capacity", "wrong_pieces", tight.alias("tight"))
