"""Evaluation texts leaking into training text: a positional inverted index searched from the rarest words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import lookup, materialize

#: Characters that show nothing and separate nothing: soft hyphen, zero-width characters, direction marks,
#: invisible operators, byte order mark, variation selectors (fixed values).
INVISIBLE = r"[\u00ad\u034f\u061c\u180e\u200b-\u200f\u202a-\u202e\u2060-\u2064\u2066-\u206f\ufe00-\ufe0f\ufeff]"

#: Consecutive words that make a leak.
WINDOW = 12

#: Rare words of a passage, beyond those that may be missing, of which a page must have as many to be looked at closer.
SURE = 3


def words(text: Column) -> Column:
    """Runs of letters and digits in lower case, invisible characters removed; empty for null."""
    plain = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), INVISIBLE, ""))
    return F.filter(F.split(plain, r"[^\p{L}\p{N}]+"), lambda w: w != "")


def test_terms(items: DataFrame, fields: list[str]) -> DataFrame:
    """(item_id, field, place, term) of every word of the test passages."""
    parts = [items.select("item_id", F.lit(f).alias("field"), F.posexplode(words(F.col(f))).alias("place", "term")) for f in fields]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.filter("item_id is not null")


def build_index(documents: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Stored postings (term, doc_id, place) of all words of all pages, or of those in terms(term).

    The index is partitioned by pages: every task writes the postings of its own pages, so no text is shuffled. The
    full index is sorted by term inside its files, so that a search skips the blocks without its words. Words that
    occur in no test passage can never be part of a leak, so a search for one stated set of passages may store the
    postings of their words only.
    """
    postings = documents.select("doc_id", F.posexplode(words(F.col("text"))).alias("place", "term")).select("term", "doc_id", "place")
    if terms is None:
        return materialize(postings.sortWithinPartitions("term", "doc_id", "place"), "index")
    return materialize(lookup(postings, materialize(terms.select("term").distinct(), "terms"), ["term"], "left_semi"), "postings")


def leaks(index: DataFrame, passages: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, item_id, field, first_word, words) of every maximal run of at least `window` consecutive words of a
    passage that stands in a page.

    For every window of a passage the two words rarest in the index are looked up. The postings of the rarest, moved
    back by the word's place in the passage, give the alignments of page and passage that can hold the window at all;
    they are intersected with the moved postings of the second rarest. The few alignments left are compared word by
    word with the postings of all their passage's words, and runs of consecutive hits are measured. Windows with a
    word that the index lacks cannot occur and are dropped first. Repeated pages and passages are all reported;
    passages shorter than the window give nothing.
    """
    frequency = index.groupBy("term").agg(F.count("*").alias("n"))
    terms = materialize(passages.join(frequency, "term", "left"), "passages")
    ahead = Window.partitionBy("item_id", "field").orderBy("place").rowsBetween(Window.currentRow, window - 1)
    rare = F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "place", "term")).over(ahead))
    windows = terms.select("item_id", "field", rare.alias("rare")).filter((F.size("rare") == window) & (F.col("rare")[0]["n"] > 0))
    keys = windows.select("item_id", "field", *[F.col("rare")[i][c].alias(f"{c}{i + 1}") for i in (0, 1) for c in ("place", "term")]).distinct()
    keys = materialize(keys, "anchors")
    moved = lambda i: keys.select("item_id", "field", F.col(f"term{i}").alias("term"), *[f"place{j}" for j in (1, 2)], *(["term2"] if i == 1 else []))
    first = lookup(index, moved(1).select("term", "item_id", "field", "place1", "place2", "term2"), ["term"])
    first = first.select("doc_id", "item_id", "field", (F.col("place") - F.col("place1")).alias("start"), "term2", "place2")
    near = lookup(index, keys.select(F.col("term2").alias("term")).distinct(), ["term"], "left_semi")
    second = near.select("doc_id", F.col("term").alias("term2"), F.col("place").alias("at"))
    both = first.withColumn("at", F.col("start") + F.col("place2")).join(second, ["doc_id", "term2", "at"], "left_semi")
    aligned = materialize(both.select("doc_id", "item_id", "field", "start").distinct(), "alignments")
    expected = lookup(aligned, terms.select("item_id", "field", "place", "term"), ["item_id", "field"])
    expected = expected.select("doc_id", "item_id", "field", "start", "term", F.col("place").alias("word"), (F.col("start") + F.col("place")).alias("place"))
    at_hand = index.join(aligned.select("doc_id").distinct(), "doc_id", "left_semi")
    hits = expected.join(at_hand, ["doc_id", "term", "place"], "left_semi")
    along = Window.partitionBy("doc_id", "item_id", "field", "start").orderBy("word")
    hits = hits.withColumn("run", F.col("word") - F.row_number().over(along))
    runs = hits.groupBy("doc_id", "item_id", "field", "start", "run").agg(F.min("place").alias("first_word"), F.count("*").alias("words"))
    return runs.filter(F.col("words") >= window).select("doc_id", "item_id", "field", "first_word", "words")


def proximity(index: DataFrame, passages: DataFrame, span: int = 40, share: float = 0.9) -> DataFrame:
    """(doc_id, item_id, field, words) of pages that hold at least `share` of a passage's distinct words, in any order,
    within so many consecutive words as twice the passage's length, or twice `span` if that is more; `words` is the
    most of them that one such stretch holds.

    The search is exact. Of the passage's rarest words, `SURE` more than may be missing less one are looked up; every
    page with `share` of all words has at least `SURE` of them (or all that are needed, if fewer), and only pages that
    do are compared with the other words. Of pages with enough of the words anywhere, the places are swept: an
    occurrence counts in the stretches that begin after the word's previous occurrence and reach this one, so that
    every stretch of the page is judged by its distinct words.
    """
    frequency = index.groupBy("term").agg(F.count("*").alias("n"))
    distinct = passages.select("item_id", "field", "term").distinct().join(frequency, "term", "left").fillna(0, ["n"])
    per = Window.partitionBy("item_id", "field")
    distinct = distinct.withColumn("rank", F.row_number().over(per.orderBy("n", "term"))).withColumn("all", F.count("*").over(per))
    wide = passages.groupBy("item_id", "field").agg(F.greatest(F.lit(2 * span), 2 * (F.max("place") + 1)).alias("wide"))
    need = F.ceil(F.round(F.col("all") * share, 6)).cast("int")  # 0.9 * 10 words is 9, not a little more
    distinct = distinct.withColumn("need", need).withColumn("sure", F.least(F.lit(SURE), F.col("need")))
    distinct = materialize(distinct.join(wide, ["item_id", "field"]), "proximity_terms")
    present = distinct.filter("n > 0")
    anchors = present.filter(F.col("rank") <= F.col("all") - F.col("need") + F.col("sure")).select("item_id", "field", "term", "sure")
    had = lookup(index.select("doc_id", "term"), anchors.select("term").distinct(), ["term"], "left_semi").distinct()
    pages = lookup(had, anchors, ["term"]).groupBy("doc_id", "item_id", "field").agg(F.count("*").alias("found"), F.max("sure").alias("sure"))
    pages = materialize(pages.filter("found >= sure").select("doc_id", "item_id", "field"), "proximity_candidates")
    own = index.join(pages.select("doc_id").distinct(), "doc_id", "left_semi")
    want = lookup(pages, present.select("item_id", "field", "term", "need"), ["item_id", "field"])
    enough = want.join(own.select("doc_id", "term").distinct(), ["doc_id", "term"]).groupBy("doc_id", "item_id", "field").agg(F.count("*").alias("words"), F.first("need").alias("need"))
    enough = materialize(enough.filter(F.col("words") >= F.col("need")).select("doc_id", "item_id", "field"), "proximity_pages")
    hits = lookup(enough, present.select("item_id", "field", "term", "need", "wide"), ["item_id", "field"]).join(own, ["doc_id", "term"])
    last = F.lag("place").over(Window.partitionBy("doc_id", "item_id", "field", "term").orderBy("place"))
    begin = F.greatest(last + 1, F.col("place") - F.col("wide") + 1)
    steps = hits.withColumn("begin", begin).select("doc_id", "item_id", "field", "need", "place", "begin")
    event = F.explode(F.array(F.struct(F.col("begin").alias("at"), F.lit(1).alias("step")), F.struct((F.col("place") + 1).alias("at"), F.lit(-1).alias("step"))))
    events = steps.select("doc_id", "item_id", "field", "need", event.alias("e")).select("doc_id", "item_id", "field", "need", "e.at", "e.step")
    along = Window.partitionBy("doc_id", "item_id", "field").orderBy("at")
    found = events.withColumn("words", F.sum("step").over(along)).filter(F.col("words") >= F.col("need"))
    return found.groupBy("doc_id", "item_id", "field").agg(F.max("words").alias("words"))
