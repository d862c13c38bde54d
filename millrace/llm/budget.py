"""Exact token totals per document and per slice, under the project's counter or a public tokenizer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.keys import clean_key
from millrace.functions.tokens import tokens_of_words, word_count
from millrace.runtime import materialize

#: Texts above this many characters are cut into chunks of about this size. Half a dozen of usual documents, so that the
#: work of a chunk is like that of a document, and one text, however long, is counted by many workers.
CHUNK_CHARS = 8_192

#: Where a text may be cut so that the parts' counts add up to the whole's, as a pattern for one chunk: after the
#: given number of characters the white space and then the word are finished, so every cut lies between the last
#: character of a word and the white space behind it. The word counter never joins pieces over its four separators.
#: The byte-level BPE splits text by a pattern none of whose alternatives holds white space behind other characters
#: and whose only lookahead stands behind white space, so no token and no lookahead crosses such a cut.
CUTS = {"words": r"(?s).{1,%d}[ \t\n\r]*[^ \t\n\r]*", "byte_bpe_50k": r"(?s).{1,%d}[\s\p{Z}\x1c-\x1f\x85]*[^\s\p{Z}\x1c-\x1f\x85]*"}


def chunks(text: Column, tokenizer: str, size: int) -> Column:
    """The text as an array of independently countable chunks, in order."""
    return F.regexp_extract_all(text, F.lit(CUTS[tokenizer] % size), F.lit(0))


def _counted(rows: DataFrame, tokenizer: str, vocabulary_dir: str, most: int | None = None) -> DataFrame:
    """The rows with `units`, the counted pieces of `text`, in place of it. With `most`, a text of more characters is not
    counted but passed on as `rest`, with null `units`."""
    long = F.lit(False) if most is None else F.length("text") > most
    rest = [] if most is None else [F.when(long, F.col("text")).alias("rest")]
    other = [c for c in rows.columns if c != "text"]
    if tokenizer == "words":
        return rows.select(*other, *rest, F.when(~long, word_count(F.col("text"))).alias("units"))
    vocabulary = f"{vocabulary_dir}/{tokenizer}.tiktoken"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in batches:
            units = pa.array([None if t is None else len(encode(t)) for t in batch.column("text").to_pylist()], pa.int64())
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), units], [*names, "units"])

    ready = rows.select(*other, *rest, F.when(~long, F.col("text")).alias("text"))
    return ready.mapInArrow(run, T.StructType([*ready.drop("text").schema.fields, T.StructField("units", T.LongType())]))


def document_tokens(
    rows: DataFrame, keep: tuple[str, ...] = (), tokenizer: str = "words", vocabulary_dir: str = "/opt/tokenizers", chunk_chars: int = CHUNK_CHARS
) -> DataFrame:
    """`ord`, the columns `keep` and `tokens` of every row, repeated deliveries included.

    One scan counts the texts of at most `chunk_chars` characters where they are read and stores the counts, together
    with the text of the longer ones. Those are cut at boundaries that the tokenizer provably never crosses, and the
    chunks are salted over the workers by row and chunk number, so one huge text never holds up a task; the exact chunk
    counts are summed per row. A null or blank text has 0 tokens; repeated and null `ord` values are allowed, since a row
    is known by the number it gets when stored. `vocabulary_dir` must be a folder that every worker has.
    """
    slim = rows.select("ord", *keep, F.coalesce(F.col("text"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("_row"))
    stored = materialize(_counted(slim, tokenizer, vocabulary_dir, chunk_chars), "counted")
    short = stored.filter("rest is null").drop("rest", "_row")
    pieces = stored.filter("rest is not null").select("_row", "ord", *keep, F.posexplode(chunks(F.col("rest"), tokenizer, chunk_chars)).alias("_chunk", "text"))
    pieces = _counted(pieces.repartition("_row", "_chunk"), tokenizer, vocabulary_dir)
    first = [F.first(c).alias(c) for c in ("ord", *keep)]
    long = pieces.groupBy("_row").agg(*first, F.sum("units").alias("units")).drop("_row")
    tokens = tokens_of_words(F.col("units")) if tokenizer == "words" else F.col("units")
    return short.unionByName(long).withColumn("tokens", tokens).drop("units")


#: Language codes by their first two or three letters (fixed values).
LANGUAGES = {"eng": "en", "deu": "de", "ger": "de", "spa": "es", "fra": "fr", "fre": "fr"}


def language(code: Column) -> Column:
    """Two-letter language of a code in any spelling; `und` if there is none."""
    head = F.regexp_extract(F.lower(F.trim(code)), r"^([a-z]{2,3})(?:[^a-z].*)?$", 1)
    out = head
    for long, short in LANGUAGES.items():
        out = F.when(head == long, short).otherwise(out)
    return F.when(F.coalesce(out, F.lit("")) == "", "und").otherwise(out)


def token_budget(rows: DataFrame, tokenizer: str = "words", **options) -> DataFrame:
    """Rows and tokens per source, language and category, and their total, in one pass of grouping sets.

    `slice` names the grouping; keys are in clean form, missing ones `(none)`. Rows of a hot slice are added up
    before the shuffle.
    """
    counted = document_tokens(rows, ("source_id", "language", "category"), tokenizer, **options)
    facts = counted.select(
        F.coalesce(clean_key(F.col("source_id")), F.lit("(none)")).alias("source"),
        language(F.col("language")).alias("language"),
        F.coalesce(clean_key(F.col("category")), F.lit("(none)")).alias("category"),
        "tokens",
    )
    sets = facts.groupingSets([["source"], ["language"], ["category"], []], "source", "language", "category")
    out = sets.agg(F.count("*").alias("rows"), F.sum("tokens").alias("tokens"), F.grouping_id().alias("g"))
    names = F.when(F.col("g") == 3, "source").when(F.col("g") == 5, "language").when(F.col("g") == 6, "category").otherwise("total")
    return out.select(
        names.alias("slice"), F.coalesce("source", "language", "category", F.lit("(all)")).alias("key"), "rows", F.coalesce("tokens", F.lit(0)).alias("tokens")
    )
