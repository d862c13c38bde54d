"""Text projections and scalar text functions as columns.

Null text gives null unless stated otherwise; white space is what Python counts as such (`WS`).
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the body of a character class.
WS = r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: The same characters as a string.
WS_CHARS = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: A piece free of white space; runs of plain ASCII are recognized without looking at the whole class.
PIECE = rf"[!-~]+[^{WS}]*|[^{WS}]+"
#: Characters that end a line.
BREAKS = r"\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029"
LINE_END = rf"\r\n|[{BREAKS}]"
#: A heading mark of Markdown or AsciiDoc at the start of a line.
HEADING = r"(?:#{1,6}[" + WS + r"]+|={1,6}[" + WS + r"]+)"
#: Fenced code of Markdown or AsciiDoc.
CODE_BLOCK = r"(?s)```.*?```|\[source[^\]]*\][" + WS + r"]*----.*?----"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, however often the function mentions it, also inside its lambdas."""
    return F.transform(F.array(value), use)[0]


def strip(c: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(c, F.lit(WS_CHARS))


def words(c: Column) -> Column:
    """Pieces free of white space; empty for a blank text."""
    return F.regexp_extract_all(c, F.lit(PIECE), F.lit(0))


def lines(c: Column) -> Column:
    """Stripped lines that are not blank."""
    return F.filter(F.transform(F.split(c, LINE_END), strip), lambda x: x != "")


def unicode_normalize(c: Column, form: str = "NFC") -> Column:
    """Unicode normalization; only texts outside ASCII leave the JVM."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: t if t is None else unicodedata.normalize(form, t))

    plain = c.rlike(r"\A\p{ASCII}*\z")
    return F.when(plain, c).otherwise(run(F.when(~plain, c)))


def clean(c: Column, form: str = "NFC", newlines: int = 2) -> Column:
    """Normalize Unicode and line ends, drop control characters except tab and newline, strip line ends, collapse more
    than `newlines` line breaks, strip the text. Null gives an empty text."""
    t = unicode_normalize(F.coalesce(c, F.lit("")), form)
    t = F.regexp_replace(t, "\r\n?", "\n")
    t = F.regexp_replace(t, r"[\x00-\x08\x0b-\x1f\x7f]", "")
    t = F.regexp_replace(t, r"[ \t]+(?=\n|\z)", "")
    if newlines > 0:
        t = F.regexp_replace(t, "\n{%d,}" % (newlines + 1), "\n" * newlines)
    return strip(t)


#: Boilerplate blocks: badge links, front matter with a title, comments.
BOILERPLATE = (
    rf"\[!\[[^\n]*?\]\([^\n]*?\)]\([^\n]*?\)[{WS}]*",
    rf"(?md)^---[{WS}]*\ntitle:[\s\S]*?\n---[{WS}]*\n",
    rf"<!--[\s\S]*?-->[{WS}]*",
)


def strip_boilerplate(c: Column) -> tuple[Column, Column, Column]:
    """Text without boilerplate blocks, the number of blocks and of characters removed; unchanged if nothing of either
    was removed."""
    text, blocks = c, F.lit(0)
    for pattern in BOILERPLATE:
        blocks = blocks + F.regexp_count(text, F.lit(pattern))
        text = F.regexp_replace(text, pattern, "")
    text = strip(text)
    saved = F.length(c) - F.length(text)
    changed = (blocks > 0) & (saved > 0)
    return F.when(changed, text).otherwise(c), F.when(changed, blocks).otherwise(0), F.when(changed, saved).otherwise(0)


def structural_headings(c: Column) -> Column:
    """Underlined titles become `# title` lines."""
    inner = f"[{WS}&&[^\\n]]*"
    return F.regexp_replace(c, rf"(?md)^(?=[^\n]){inner}([^\n]*?){inner}\n[=\-`:'\"~^_*+#<>]{{3,}}[{WS}]*$", "# $1")


def sections(c: Column) -> Column:
    """The text split in front of every heading line; the parts joined give the text."""
    return F.filter(F.split(c, f"(?md)(?=^{HEADING})"), lambda p: p != "")


def drop_sections(c: Column, patterns: list[str]) -> Column:
    """Without the parts whose first line contains one of the patterns; unchanged if nothing would be left."""
    if not patterns:
        return c
    low = [p.lower() for p in patterns]

    def kept(part: Column) -> Column:
        first = F.lower(F.regexp_extract(part, rf"\A[^{BREAKS}]*", 0))
        bad = F.lit(False)
        for p in low:
            bad = bad | first.contains(p)
        return ~bad

    text = strip(F.array_join(F.filter(sections(c), kept), ""))
    return F.when(text != "", text).otherwise(c)


def title(c: Column, stem: Column) -> Column:
    """First `# ` or `= ` line of the text, else the file stem in title case."""
    first = F.regexp_extract(c, rf"(?md)^[{WS}&&[^\n]]*[#=] ([^\n]*)$", 1)
    return F.when(first != "", strip(first)).otherwise(F.initcap(F.regexp_replace(stem, "[_-]", " ")))


def normalized(c: Column) -> Column:
    """Lower case, white space collapsed to single blanks."""
    return strip(F.regexp_replace(F.lower(c), f"[{WS}]+", " "))


def excerpt(c: Column, chars: int = 300) -> Column:
    """White space collapsed, first characters."""
    return F.substring(strip(F.regexp_replace(c, f"[{WS}]+", " ")), 1, chars)


def content_hash(c: Column) -> Column:
    return F.sha2(c, 256)


def dedup_key(c: Column) -> Column:
    """Hash of the text with white space collapsed; case counts."""
    return F.sha2(strip(F.regexp_replace(c, f"[{WS}]+", " ")), 256)


def code_text(c: Column) -> Column:
    """Code blocks joined by newlines."""
    return F.array_join(F.regexp_extract_all(c, F.lit(CODE_BLOCK), F.lit(0)), "\n")
