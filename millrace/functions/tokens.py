"""The project's own token counter as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters that separate words: space, tab, LF and CR.
SPACE = " \t\n\r"


def word_count(text: Column) -> Column:
    """Number of longest pieces free of space, tab, LF and CR; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t\n\r]+")), F.lit(0)).cast("long")


def tokens_of_words(words: Column) -> Column:
    """`max(1, floor(1.3 * words))`, or 0 for no words; in double precision."""
    return F.when(words <= 0, F.lit(0)).otherwise(F.greatest(F.lit(1), F.floor(words * F.lit(1.3)))).cast("long")


def token_count(text: Column) -> Column:
    """Tokens of a text; 0 for a null or blank one."""
    return tokens_of_words(word_count(text))
