"""Keyword-stuffed and link-list pages: a hidden Markov model labels lines, pages are judged by non-prose words."""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATES = ("prose", "link_list", "tag_list", "menu")

#: Short words that sentences cannot do without, in the four languages of the pages (fixed values).
FUNCTION_WORDS = frozenset(
    "the a an of and or that which who it its is are was were be been has have had do does did not no but if when while because so than then they their this "
    "these those there as at by from in into on to until would could should can may must we you he she his her our any each every both only more one "
    "der die das den dem des ein eine einen einem einer und oder dass ist sind war wird werden hat haben nicht aber wenn weil auch auf aus bei bis durch im in "
    "mit nach sich so sobald um vom von vor wie wir zu zum zur seine ihre ohne ob nur was "
    "le la les l d un une des du et ou que qui est sont il elle ils ne pas plus mais si car dans par pour sur avec sans ce cette ces ses leurs au aux nous en à "
    "el los las una unos del y o que es son se no pero si porque para con sin su sus lo al de como cuando otro hasta aunque".split()
)
#: Words that join a keyword to its qualifier as readily as the parts of a sentence, so they prove nothing.
NEUTRAL = frozenset({"for", "with", "near", "in", "de", "pour", "para", "für"})

LINKED = re.compile(r"!?\[[^\]\n]*\]\([^)\s]*\)|\[\[[^\]\n]*\]\]|<a\b[^>]*>.*?</a>|\S*(?:://|www\.)\S*", re.I)
SEPARATORS = (",", ";", "|", ">", "»", "•", "·", "#", " - ", " – ", " — ")
TRAILS = (" > ", " » ", " › ", " → ", " | ")
PRICE = re.compile(r"\d[.,]\d\d(?![\d.])")
TERMINALS = (". ", "! ", "? ", ": ", ".[")
ENDS = (".", "!", "?", ":")
CLOSERS = ")\"'`*_]”’»<"
OPENERS = re.compile(r"\s*(?:(?P<fence>```|~~~)|\\begin\{(?P<env>\w+\*?)\}|(?P<wiki>\{\|)|(?P<pre><pre\b(?!.*</pre>))|(?P<math>\$\$\s*$))")
STRUCTURE = re.compile(
    r"\s*(?:\|.*\||\|-|[!|]\s.*(?:\|\||!!)|\\[A-Za-z]+|#{1,6}\s|={2,}\s*\S.*=|[-=~*_]{3,}\s*$|\{\{|<!--|!\[|\[\^|\[\w+\]:|</?(?:h\d|table|ul|li|p|tr|div|details|summary|img|pre)\b)"
)
CODE_ENDS = ("{", "}", ";", "):", ");", "()")

#: Upper bounds of each feature's cells; a value beyond the last is in one more cell.
CUTS = {
    "linked": (0.0, 0.35),
    "function": (0.0, 0.1, 0.22),
    "variety": (0.0, 0.4, 0.6, 0.8),
    "separators": (0.0, 0.12, 0.3),
    "trail": (0.0,),
    "terminal": (0.0, 0.02, 0.15),
    "product": (0.0, 0.06),
    "length": (2.0, 8.0),
    "structure": (0.0, 1.0),
}


def line_features(page: str) -> tuple[list[int], np.ndarray]:
    """Words and feature values (in the order of `CUTS`) of every line that is not blank."""
    counts: list[int] = []
    rows: list[tuple[float, ...]] = []
    until = None
    last: dict[str, int] = {}  # where the closing marks of blocks stand for the last time
    end = -1
    for line in page.split("\n"):
        end += len(line) + 1
        tokens = line.split()
        n = len(tokens)
        if not n:
            continue
        counts.append(n)
        if until is not None:
            if until in line:
                until = None
            rows.append(INSIDE)
            continue
        if (o := OPENERS.match(line)) and (n < 40 or o["fence"]):
            until = o["fence"] or (o["env"] and f"\\end{{{o['env']}}}") or (o["wiki"] and "|}") or (o["pre"] and "</pre>") or "$$"
            if o["env"] in ("document", "itemize", "enumerate", "abstract", "quote"):
                until = None
                rows.append(INSIDE)
                continue
            if until not in last:
                last[until] = page.rfind(until)
            if last[until] >= end:
                rows.append(INSIDE)
                continue
            until = None  # a block that is never closed is none, and its line one like any other
        linked, rest = 0, line
        if "://" in line or "[[" in line or "www." in line or "href=" in line:
            linked = sum(len(m.split()) for m in LINKED.findall(line))
            rest = LINKED.sub(" ", line)
        words = rest.lower().split()
        k = len(words)
        known = set(words)
        bare = line.rstrip().rstrip(CLOSERS)
        terminal = sum(map(line.count, TERMINALS)) + bare.endswith(ENDS)
        rows.append(
            (
                linked / n,
                len((known & FUNCTION_WORDS) - NEUTRAL) / min(k or 1, 30),
                len(set(zip(words, words[1:], strict=False))) / (k - 1) if k >= 10 else 0.0,
                sum(map(line.count, SEPARATORS)) / n,
                sum(map(line.count, TRAILS)) if tokens[0][0] != "|" else 0,
                terminal / n,
                (len(PRICE.findall(line)) + line.count(" #")) / n,
                n,
                1.0 if STRUCTURE.match(line) or line.rstrip().endswith(CODE_ENDS) and n < 12 else 0.0,
            )
        )
    return counts, np.array(rows, dtype=float).reshape(len(rows), len(CUTS))


#: Features of a line inside a code block, formula or table.
INSIDE = (0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 5.0, 2.0)


def cells(values: np.ndarray) -> np.ndarray:
    """Feature values as cell numbers."""
    return np.stack([np.searchsorted(np.array(cut), values[:, i], side="left") for i, cut in enumerate(CUTS.values())], axis=1)


class Model(NamedTuple):
    """Log-probabilities: of the first state, of the next state, and of each feature's cells by state."""

    start: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]


def fit(pages: Iterable[list[tuple[str, str]]], smoothing: float = 0.3) -> Model:
    """Model from labelled pages, each a list of (state, lines), by smoothed counts."""
    k = len(STATES)
    start, step = np.full(k, smoothing), np.full((k, k), smoothing)
    emit = [np.full((k, len(cut) + 1), smoothing) for cut in CUTS.values()]
    for page in pages:
        before = None
        for label, lines in page:
            s = STATES.index(label)
            for row in cells(line_features(lines)[1]):
                if before is None:
                    start[s] += 1
                else:
                    step[before, s] += 1
                for i, c in enumerate(row):
                    emit[i][s, c] += 1
                before = s
    log = lambda a: np.log(a / a.sum(axis=-1, keepdims=True))
    return Model(log(start), log(step), [log(e) for e in emit])


def decode(model: Model, score: np.ndarray) -> np.ndarray:
    """Most probable states (Viterbi) of score[page, line, state]."""
    pages, lines, k = score.shape
    best = model.start + score[:, 0]
    back = np.zeros((pages, lines, k), dtype=np.int8)
    for t in range(1, lines):
        ways = best[:, :, None] + model.step[None]
        back[:, t] = ways.argmax(axis=1)
        best = ways.max(axis=1) + score[:, t]
    state = np.zeros((pages, lines), dtype=np.int8)
    state[:, -1] = best.argmax(axis=1)
    for t in range(lines - 1, 0, -1):
        state[:, t - 1] = np.take_along_axis(back[:, t], state[:, t, None].astype(np.intp), axis=1)[:, 0]
    return state


def word_shares(model: Model, pages: list[str]) -> np.ndarray:
    """Words of each page by state: an array [page, state]."""
    out = np.zeros((len(pages), len(STATES)), dtype=np.int64)
    for i, (words, states) in enumerate(page_states(model, pages)):
        out[i] = np.bincount(states, weights=words, minlength=len(STATES))
    return out


def page_states(model: Model, pages: list[str]) -> list[tuple[list[int], np.ndarray]]:
    """Words and state of every line of each page that is not blank. Lines are scored together, and pages of as many
    lines are decoded together."""
    feats = [line_features(p) for p in pages]
    sizes = np.array([len(c) for c, _ in feats], dtype=np.int64)
    out = [(c, np.zeros(0, dtype=np.int8)) for c, _ in feats]
    if not sizes.sum():
        return out
    all_cells = cells(np.concatenate([f for _, f in feats]))
    scores = sum(e[:, all_cells[:, i]].T for i, e in enumerate(model.emit))
    begin = np.concatenate([[0], np.cumsum(sizes)])
    for n in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == n)
        rows = begin[at][:, None] + np.arange(n)
        for i, states in zip(at, decode(model, scores[rows]), strict=True):
            out[i] = (feats[i][0], states)
    return out


@lru_cache(maxsize=1)
def default_model() -> Model:
    from millrace.llm.labelled_pages import LINE_PAGES

    return fit(LINE_PAGES)


RESULT = T.StructType([T.StructField(f"{s}_words", T.LongType()) for s in STATES])


def label_pages(rows: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """The rows without their text, with the words that stand in prose, link lists, tag lists and menus, and
    `spam`: whether more than half of the words stand outside prose.

    Every line of every page is labelled by the most probable path of a hidden Markov model, whose tables come from
    labelled pages written for it; so a short line is judged by its neighbours as well. Tables, code, formulas,
    headings and glossaries count as prose. A null or blank text has no words and is no spam.
    """
    model = model or default_model()

    @F.pandas_udf(RESULT)
    def shares(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(word_shares(model, ["" if t is None else t for t in texts]), columns=RESULT.names)

    out = rows.withColumn("_w", shares(F.col(text))).select(*[c for c in rows.columns if c != text], "_w.*")
    other = F.col("link_list_words") + F.col("tag_list_words") + F.col("menu_words")
    return out.withColumn("spam", other > F.col("prose_words"))


LINES = T.ArrayType(T.StructType([T.StructField("line", T.IntegerType()), T.StructField("label", T.StringType()), T.StructField("words", T.LongType())]))


def label_lines(rows: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """The rows without their text, one for every line that is not blank: `line`, its number among those, `label` and
    `words`. A null or blank text has no lines."""
    model = model or default_model()

    @F.pandas_udf(LINES)
    def lines(texts: pd.Series) -> pd.Series:
        pages = page_states(model, ["" if t is None else t for t in texts])
        return pd.Series([[{"line": i, "label": STATES[s], "words": w} for i, (w, s) in enumerate(zip(words, states, strict=True))] for words, states in pages])

    out = rows.withColumn("_l", lines(F.col(text))).select(*[c for c in rows.columns if c != text], F.explode("_l").alias("_l"))
    return out.select(*[c for c in rows.columns if c != text], "_l.*")
