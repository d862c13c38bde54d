"""Keys typed by many hands: spellings that differ only in case and in non-alphanumeric characters are one key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stand-ins for "nobody known", in squeezed form. A key spelled so links nothing.
NOBODY = ("na", "none", "null", "unknown", "anonymous", "nobody", "nan", "tbd", "undefined", "unspecified", "notavailable", "noauthor", "noname")


def squeezed(key: Column) -> Column:
    """The letters and digits of a key in lower case; null for a null or blank key."""
    s = F.lower(F.regexp_replace(key, r"[^\p{L}\p{N}]+", ""))
    return F.when(s != "", s)


def clean_key(key: Column) -> Column:
    """Lower case, words joined by `_`; null for a null or blank key."""
    s = F.regexp_replace(F.lower(F.regexp_replace(key, r"[^\p{L}\p{N}]+", "_")), r"^_+|_+$", "")
    return F.when(s != "", s)


def linking_key(key: Column) -> Column:
    """Squeezed key, or null if it names nobody."""
    s = squeezed(key)
    return F.when(~s.isin(*NOBODY), s)
