"""Sections and chunks of documents, and the merging of neighbouring sections."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.scoring import python_tokens
from millrace.functions.semantic import classify, concepts
from millrace.functions.text import HEADING, PIECE, WS, content_hash, sections, strip
from millrace.runtime import materialize


def _pack(paragraphs: Column, cost, limit: int, joined: bool) -> Column:
    """Fold paragraphs into chunks of at most `limit` tokens, in order; a paragraph over the limit stays whole.

    With `joined` a chunk costs what its joined text costs (words add up before the factor is applied), else its
    paragraphs' tokens add up.
    """
    tokens = lambda n: F.when(n > 0, F.greatest(F.lit(1), F.floor(n * F.lit(1.3)))).otherwise(0).cast("long")
    start = F.struct(F.array().cast("array<string>").alias("done"), F.array().cast("array<string>").alias("open"), F.lit(0).cast("long").alias("load"))

    def step(state: Column, x: Column) -> Column:
        p, own = x["p"], x["cost"]
        load = state["load"] + own
        over = (F.size(state["open"]) > 0) & ((tokens(load) if joined else load) > limit)
        return F.when(
            over,
            F.struct(F.concat(state["done"], F.array(F.array_join(state["open"], "\n\n"))).alias("done"), F.array(p).alias("open"), own.alias("load")),
        ).otherwise(F.struct(state["done"].alias("done"), F.concat(state["open"], F.array(p)).alias("open"), load.alias("load")))

    end = lambda s: F.when(F.size(s["open"]) > 0, F.concat(s["done"], F.array(F.array_join(s["open"], "\n\n")))).otherwise(s["done"])
    costs = F.transform(paragraphs, lambda p: F.struct(p.alias("p"), cost(p).cast("long").alias("cost")))  # once a paragraph
    return F.aggregate(costs, start, step, end)


def sectionize(docs: DataFrame, limit: int = 2400) -> DataFrame:
    """docs(id, title, text) as sections(id, parent_id, section_index, section_title, text).

    A text within the limit is one section. A longer one is split in front of headings, each part is filled from its
    paragraphs up to the limit, and a part without a heading of its own belongs to the last one. The id of a section
    is a hash of its parent, place and text; a whole document keeps its own. Blank texts give one section as well.
    """
    whole = python_tokens(F.col("text")) <= limit
    first = lambda part: F.regexp_extract(part, r"\A[^\n]*", 0)
    heading = lambda part: F.when(first(part).rlike(f"^{HEADING}"), strip(F.regexp_replace(first(part), f"^{HEADING}", "")))
    words = lambda p: F.regexp_count(p, F.lit(PIECE)).cast("long")
    kept = F.filter(F.transform(sections(F.col("text")), strip), lambda p: p != "")
    chunks = lambda p: _pack(F.split(p, "\n{2,}"), words, limit, joined=True)
    parts = F.flatten(F.transform(kept, lambda p: F.transform(chunks(p), lambda c: F.struct(heading(p).alias("title"), c.alias("text"), F.lit(False).alias("whole")))))
    one = F.array(F.struct(F.col("title"), F.col("text"), F.lit(True).alias("whole")))
    # `whole` travels in the parts: beside the generator it would be counted again in the document's text for every section
    rows = docs.select(F.col("id").alias("parent_id"), F.posexplode(F.when(whole, one).otherwise(parts)).alias("section_index", "part"))
    carried = F.last("part.title", ignorenulls=True).over(Window.partitionBy("parent_id").orderBy("section_index"))
    digest = F.substring(content_hash(F.concat_ws(":", "parent_id", F.col("section_index").cast("string"), "part.text")), 1, 16)
    return rows.select(
        F.when(F.col("part.whole"), F.col("parent_id")).otherwise(digest).alias("id"),
        "parent_id",
        "section_index",
        F.when(F.col("part.whole"), F.col("part.title")).otherwise(carried).alias("section_title"),
        F.col("part.text").alias("text"),
    )


def chunk(docs: DataFrame, target: int = 2048) -> DataFrame:
    """docs(id, text) as chunks(chunk_id, id, chunk_index, total_chunks, text, tokens): a text within the target is one
    chunk, a longer one is filled from its paragraphs by their added tokens."""
    paragraphs = F.filter(F.transform(F.split("text", "\n\n"), strip), lambda p: p != "")
    many = _pack(paragraphs, python_tokens, target, joined=False)
    rows = docs.select("id", F.when(python_tokens(F.col("text")) <= target, F.array("text")).otherwise(many).alias("parts"))
    rows = rows.select("id", F.size("parts").alias("total_chunks"), F.posexplode("parts").alias("i", "text"))
    return rows.select(
        F.format_string("%s_chunk_%03d", F.col("id"), F.col("i") + 1).alias("chunk_id"), "id", (F.col("i") + 1).alias("chunk_index"), "total_chunks", "text", python_tokens(F.col("text")).alias("tokens")
    )


def section_hint(title: Column, rules: dict[str, str]) -> Column:
    """Category of the first rule whose pattern stands in the title; null if none does."""
    low = F.lower(F.coalesce(title, F.lit("")))
    out = F.lit(None).cast("string")
    for pattern, category in reversed(rules.items()):
        out = F.when(low.contains(pattern.lower()), category).otherwise(out)
    return out


def merge_sections(parts: DataFrame, limit: int = 2400) -> DataFrame:
    """Join neighbouring related sections of one file: parts(id, source_id, relative_path, section_index, text,
    category_hint) as (id, source_id, relative_path, text, primary_category, related_concepts, section_ids).

    Sections are related if they share a concept, or have the same category and at least one of them a concept. A run
    grows while the next section follows directly, is related to the run so far and fits the limit; the run is
    classified again at the end. A section without a path belongs to no file and stays alone. The fold streams over the sorted sections with the state of one run, so no file is
    ever gathered; concepts and categories of the sections come from columns and only they reach Python.
    """
    text = F.col("text")
    marked = parts.withColumn("related_concepts", concepts(text)).withColumn("file", F.sha2(F.concat_ws("\x00", "source_id", F.coalesce("relative_path", F.concat(F.lit("\x00"), "id"))), 256))
    marked = marked.withColumn("primary_category", classify(text, F.col("related_concepts"), F.col("category_hint"))["category"])
    marked = materialize(marked.withColumn("words", F.regexp_count(text, F.lit(PIECE))), "marked_sections")  # read for the runs and for their texts

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        run: dict = {"file": None}
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                mine = set(row["related_concepts"])
                n = row["words"]
                if run["file"] == row["file"] and row["section_index"] == run["end"] + 1:
                    related = bool(run["concepts"] & mine) or (run["category"] == row["primary_category"] and bool(run["concepts"] or mine))
                    n = run["words"] + row["words"]
                    if related and (max(1, int(n * 1.3)) if n else 0) <= limit:
                        run["concepts"] |= mine
                        run["words"], run["end"], run["place"] = n, row["section_index"], run["place"] + 1
                        out.append((run["id"], row["id"], run["place"]))
                        continue
                run = {"file": row["file"], "id": row["id"], "concepts": mine, "category": row["primary_category"], "words": row["words"], "end": row["section_index"], "place": 0}
                out.append((row["id"], row["id"], 0))
            yield pd.DataFrame(out, columns=["run", "id", "place"])

    slim = marked.select("file", "id", "section_index", "related_concepts", "primary_category", "words")
    ordered = slim.repartition("file").sortWithinPartitions("file", "section_index", "id")
    runs = ordered.mapInPandas(fold, "run string, id string, place long")
    joined = marked.join(runs, "id").groupBy("run").agg(
        F.first("source_id").alias("source_id"),
        F.first("relative_path").alias("relative_path"),
        F.min_by("category_hint", "place").alias("hint"),
        F.array_sort(F.collect_list(F.struct("place", "id", "text"))).alias("parts"),
    )
    whole = F.array_join(F.transform("parts", lambda p: p["text"]), "\n\n")
    out = joined.select(F.col("run").alias("id"), "source_id", "relative_path", whole.alias("text"), "hint", F.transform("parts", lambda p: p["id"]).alias("section_ids"))
    out = out.withColumn("related_concepts", concepts(F.col("text")))
    return out.withColumn("primary_category", classify(F.col("text"), F.col("related_concepts"), F.col("hint"))["category"]).drop("hint")
