"""Path rules: include and exclude patterns, content types, excluded folders."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions import vocabulary as V

#: Suffixes read when a source has no include patterns (fixed values).
DEFAULT_SUFFIXES = ("md", "markdown", "txt", "adoc", "rst")


def glob_regex(pattern: str, within: bool = False) -> str:
    """Java pattern of a shell pattern, anchored at both ends; its `*` crosses folders. With `within` the pattern may
    begin at any folder and `*` stays inside one."""
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        close = pattern.find("]", i + 2)
        if c == "*":
            out += "[^/]*" if within else ".*"
        elif c == "?":
            out += "[^/]" if within else "."
        elif c == "[" and close > 0:
            body = pattern[i + 1 : close]
            out += "[" + ("^" + body[1:] if body[0] == "!" else body).replace("\\", "\\\\") + "]"
            i = close
        else:
            out += re.escape(c)
        i += 1
    return (r"(?s)(?:\A|/)" if within else r"(?s)\A") + re.sub(r"(?:\.\*){2,}", ".*", out) + r"\z"


def forms(pattern: str) -> list[str]:
    """The pattern with its simplified form, in which `**` may stand for no folder."""
    return [pattern, pattern.replace("**/", "*").replace("/**", "*")] if "**" in pattern else [pattern]


def allowed(path: Column, include: Sequence[str] | None = None, exclude: Sequence[str] | None = None) -> Column:
    """Whether a relative path is read: excluded patterns and benchmark folders never; else if a pattern includes the
    path or its file name, or, without include patterns, if the suffix is a text suffix."""
    name = F.substring_index(path, "/", -1)
    hit = lambda p: path.rlike(glob_regex(p)) | name.rlike(glob_regex(p)) | path.rlike(glob_regex(p, within=True))
    out = benchmark_path(path)
    for p in exclude or ():
        out = out | hit(p)
    if include:
        inside = F.lit(False)
        for p in include:
            inside = inside | hit(p)
            for q in forms(p)[1:]:
                inside = inside | path.rlike(glob_regex(q))
    else:
        inside = suffix(path).isin(*DEFAULT_SUFFIXES)
    return ~out & inside


def suffix(path: Column) -> Column:
    """Lower-case suffix of the file name without the dot; empty if there is none."""
    return F.lower(F.regexp_extract(F.substring_index(path, "/", -1), r"(?<=[^.])\.([^.]+)$", 1))


def content_type(path: Column) -> Column:
    """Kind of a document by its suffix, or null."""
    return F.create_map(*[F.lit(x) for kv in V.CONTENT_TYPES.items() for x in kv])[suffix(path)]


def benchmark_path(path: Column) -> Column:
    """Whether a path lies in a benchmark folder, which is never read."""
    return F.lower(F.replace(path, F.lit("\\"), F.lit("/"))).contains("benchmark/")


def stem(path: Column) -> Column:
    """File name without its suffix."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"(?<=[^.])\.[^.]+$", "")


def sparse_folders(include: Sequence[str] | None) -> list[str]:
    """Top folders that hold all included paths; none if a pattern lies at the root."""
    if not include or any("/" not in p for p in include):
        return []
    return sorted({p.split("/")[0] for p in include if p.split("/")[0] and "*" not in p.split("/")[0]})


def scoped_license(path: Column, rules: Sequence[dict]) -> Column:
    """Struct (license_id, training_enabled) of the first rule that covers a path; without one training is off."""
    field = lambda license_id, on: F.struct(F.lit(license_id).cast("string").alias("license_id"), F.lit(on).alias("training_enabled"))
    out = field(None, False)
    for r in reversed(rules):
        covers = allowed(path, r.get("include_patterns"), r.get("exclude_patterns"))
        out = F.when(covers, field(r.get("license_id"), bool(r.get("training_enabled", True)))).otherwise(out)
    return out
