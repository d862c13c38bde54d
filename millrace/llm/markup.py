"""Markup residue to clean text: one scan for constructs, then the maximum-scoring stretch of words and tags."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterable
from functools import lru_cache
from html.entities import html5
from typing import NamedTuple

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements of HTML (fixed values), by what their tags do to the text.
DROPPED = "script style template svg iframe canvas noscript"
BOILERPLATE = "nav footer header aside head title form button menu select"
HEADINGS = "h1 h2 h3 h4 h5 h6"
BLOCKS = "address article blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul"
INLINE = (
    "a abbr acronym area audio b base bdi bdo big cite code col colgroup data datalist del dfn em embed font i img input ins kbd label link map mark meta meter "
    "object optgroup option output param picture progress q rp rt ruby s samp small source span strike strong sub sup textarea time track tt u var video wbr"
)
TAGS = {t: c for c, names in (("drop", DROPPED), ("boiler", BOILERPLATE), ("heading", HEADINGS), ("block", BLOCKS), ("inline", INLINE)) for t in names.split()}
#: Elements whose names also serve as type parameters; glued to a word they need a closing tag.
SHORT_TAGS = {"a", "b", "i", "p", "q", "s", "u"}
#: Environments whose content stands for itself, and those that hold a formula (fixed values).
VERBATIM = "verbatim|Verbatim|lstlisting|minted|comment"
FORMULA = "equation|align|gather|multline|eqnarray|displaymath|math|alignat|flalign"
#: What the text of a TeX command's argument becomes (fixed values).
TEX_HEADINGS = {"part": 1, "chapter": 1, "title": 1, "section": 2, "subsection": 3, "subsubsection": 4, "paragraph": 4, "subparagraph": 5}
TEX_SILENT = {"documentclass", "usepackage", "label", "ref", "cite", "citep", "citet", "pageref", "eqref", "bibliography", "bibliographystyle", "newcommand", "renewcommand", "includegraphics", "maketitle", "tableofcontents", "input", "include", "vspace", "hspace", "centering", "noindent", "hline", "setlength", "pagestyle", "index"}

HTML, MARKDOWN, WIKI, LATEX = KINDS = ("html", "markdown", "wiki", "latex")

#: One alternative per construct. Protected blocks come first, so that nothing inside them is looked at.
CONSTRUCTS = {
    "comment": r"<!--.*?(?:-->|\Z)",
    "doctype": r"<!(?:DOCTYPE|doctype)\b[^>]*>|<\?xml\b[^>]*\?>|<!\[CDATA\[",
    "dropped": r"<(?P<dn>(?i:script|style|template|svg|iframe|canvas|noscript))\b[^>]*>.*?</(?i:(?P=dn))\s*>",
    "pre": r"<(?P<pn>(?i:pre))\b[^>]*>(?P<pre_body>.*?)</(?i:pre)\s*>",
    "code": r"<(?P<cn>(?i:code|kbd|samp|tt))\b[^>]*>(?P<code_body>.*?)</(?i:(?P=cn))\s*>",
    "raw": r"<(?P<rn>nowiki|syntaxhighlight|math)\b[^>]*>(?P<raw_body>.*?)</(?P=rn)\s*>",
    "fence": r"^[ ]{0,3}(?P<fm>`{3,}|~{3,})[^\n`]*\n(?P<fence_body>.*?)(?:^[ ]{0,3}(?P=fm)[`~]*[ \t]*$|\Z)",
    "verbatim": r"\\begin\{(?P<vn>" + VERBATIM + r")\*?\}(?:\[[^\]\n]*\])?(?P<verbatim_body>.*?)\\end\{(?P=vn)\*?\}|\\verb\*?(?P<vd>[|!+])(?P<verb_body>[^\n]*?)(?P=vd)",
    "span": r"(?<!`)(?P<sm>`+)(?!`)(?P<span_body>[^\n]+?)(?<!`)(?P=sm)(?!`)",
    "path": r"(?<=\b[A-Za-z]:)\\[^\s]*|(?<!\S)\\\\[A-Za-z0-9][\w.$-]*\\[^\s]*",
    "display": r"\$\$(?P<dd>[^$]+?)\$\$|\\\[(?P<db>.+?)\\\]|\\\((?P<dp>.+?)\\\)|\\begin\{(?P<en>(?:" + FORMULA + r")\*?)\}(?P<eb>.*?)\\end\{(?P=en)\}",
    "dollar": r"(?<![\\$\w])\$(?P<formula>(?![\s{$])[^$\n]*?[^\s$\\])\$(?![\d$])",
    "tabular": r"\\begin\{(?P<tab>tabular[x*]?|array)\}(?P<tab_body>.*?)\\end\{(?P=tab)\}",
    "texenv": r"\\(?P<be>begin|end)\{(?P<env>[^{}\n]*)\}(?:\[[^\]\n]*\]|\{[^{}\n]*\})*",
    "texcmd": r"~?\\(?P<cmd>[A-Za-z]{2,})\*?(?:\[[^\]\n]*\])?(?P<args>(?:\{(?:[^{}]|\{(?:[^{}]|\{[^{}]*\})*\})*\})*)",
    "texrow": r"\\\\(?=\s|$)",
    "tag": r"<(?P<close>/?)(?P<tname>[A-Za-z][A-Za-z0-9]*)(?P<attrs>(?:\s[^<>]*)?)/?>",
    "entity": r"&(?:(?P<ename>[A-Za-z][A-Za-z0-9]{1,31})|#\d{1,7}|#[xX][0-9A-Fa-f]{1,6});",
    "wikitable": r"^\{\|.*?(?:^\|\}|\Z)",
    "template": r"\{\{(?P<tpl>[^{}]*)\}\}",
    "wikilink": r"\[\[(?P<wl>[^\[\]\n]+)\]\]",
    "quotes": r"(?<!')(?P<qm>'{5}|'{3}|'{2})(?=[^\s'])(?P<quoted>[^\n]*?[^\s'])(?P=qm)(?!')",
    "wikihead": r"^(?P<wm>={2,6})[ \t]*(?P<whead>[^=\s](?:[^\n]*?[^=\s])?)[ \t]*(?P=wm)[ \t]*$",
    "switch": r"(?<!\w)__(?:NO|FORCE)?TOC__|(?<!\w)__NOEDITSECTION__|^#REDIRECT\b",
    "image": r"(?<!\w)!\[(?P<alt>[^\]\n]*)\](?:\((?P<isrc>[^()\n]*)\)|\[[^\]\n]*\])",
    "link": r"(?<!\w)\[(?P<label>[^\[\]\n]+)\]\((?P<href>[^()\s]*(?:\([^()\s]*\)[^()\s]*)*)(?:\s+\"[^\"\n]*\")?\)",
    "footnote": r"\[\^[^\]\s]+\](?P<fdef>:?)",
    "reflink": r"(?<![\w\]])\[(?P<rlabel>[^\[\]\n]+)\]\[(?P<ref>[^\[\]\n]*)\]",
    "refdef": r"^[ ]{0,3}\[[^\^\[\]\n][^\[\]\n]*\]:[ \t]*\S+[^\n]*$",
    "extlink": r"\[(?:https?|ftp)://[^\s\[\]]+(?P<xlabel>[ \t][^\[\]\n]*)?\]",
    "autolink": r"<(?P<auto>(?:https?|ftp|mailto):[^<>\s]+)>",
    "task": r"^[ \t]*(?:[-*+]|\d+[.)])[ \t]+\[[ xX]\](?=\s)",
    "atx": r"^[ ]{0,3}(?P<am>#{1,6})[ \t]+(?=\S)",
    "rule": r"^[ ]{0,3}(?:(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})$",
    "delimiter": r"^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*(?:\|[ \t]*:?-{3,}:?[ \t]*)+\|?[ \t]*$|^[ \t]*\|[ \t]*:?-{3,}:?[ \t]*\|[ \t]*$",
    "underline": r"(?<=\S\n)(?P<um>=+|-{2,})[ \t]*$",
    "quote": r"^[ ]{0,3}(?:>[ ]?)+(?=[^\s\d=<>])",
    "strong": r"(?<![\w*])(?P<bm>\*{1,3})(?=[^\s*])(?P<bold>[^*\n]*[^\s*])(?P=bm)(?![\w*])|(?<=\w)(?P<bm2>\*\*)(?=[^\s*])(?P<bold2>[^*\n]*[^\s*])\*\*(?!\*)",
    "under": r"(?<![\w])(?P<um2>_{1,3})(?=[^\s_])(?P<ital>[^_\n]*[^\s_])(?P=um2)(?![\w])",
    "strike": r"(?<!~)~~(?=[^\s~])(?P<struck>[^~\n]*[^\s~])~~(?!~)",
}
#: Where a construct can begin: at one of these characters, or at a line of which one is the first mark.
STARTS = re.compile(r"[<`~\\$&{\['=_!#>*|]|^[ \t]*(?:[-+:=]|\d+[.)][ \t]+\[)", re.M)
#: A text without any of these holds no construct.
TRIGGER = r"[<>`\\$&{}\[\]*_#|~]|''|==|\n[=-]"
SCANNER = re.compile("|".join(f"(?P<{k}>{v})" for k, v in CONSTRUCTS.items()), re.M | re.S)
KIND_OF = dict.fromkeys(("comment", "doctype", "dropped", "pre", "code", "tag", "entity"), HTML)
KIND_OF |= dict.fromkeys(("fence", "span", "image", "link", "footnote", "reflink", "refdef", "autolink", "task", "atx", "rule", "delimiter", "underline", "quote", "strong", "under", "strike"), MARKDOWN)
KIND_OF |= dict.fromkeys(("raw", "wikitable", "template", "wikilink", "quotes", "wikihead", "switch", "extlink"), WIKI)
KIND_OF |= dict.fromkeys(("verbatim", "display", "dollar", "tabular", "texenv", "texcmd", "texrow"), LATEX)
NAMED = {n[:-1] for n in html5 if n.endswith(";")}
DUNDER = re.compile(r"(?:init|main|name|call|str|repr|file|all|doc|dict|new|del|len|iter|next|enter|exit|slots|class|module|version|getitem|setitem|eq|hash)\Z")
MATH = re.compile(r"[\\^_{}=<>+]|[A-Za-z](?:\([\w, ]+\))?\Z|\d*[A-Za-z]\Z")


#: Words that stand in links or in boilerplate elements.
NEGATIVE_WORDS = ("link_word", "boiler_word")
#: Marks that open a heading, list entry, table or quotation.
OPENING = ("heading", "atx", "wikihead", "li", "table", "tr", "th", "td", "quote", "task")
#: Added to every count of the labelled pages.
SMOOTHING = 0.2


class Piece(NamedTuple):
    """A stretch of the page: what it becomes, how many words that has, the class of its tag if it is one, and the kind of
    markup it was."""

    text: str
    words: int
    tag: str
    kind: str = ""


def pieces(page: str) -> list[Piece]:
    """The page as words and tags in order.

    The scan visits every character once. Protected blocks (code, inline code, verbatim, scripts, comments) are single
    constructs, so their content is neither counted nor converted.
    """
    out: list[Piece] = []
    inside = 0  # depth of boilerplate elements
    linked = 0
    at = 0
    closings: dict[str, int] = {}  # where an element is closed for the last time
    lower = None

    def words(s: str, tag: str = "") -> None:
        if s:
            out.append(Piece(s, len(s.split()), tag or ("boiler_word" if inside else "link_word" if linked else "")))

    look = 0
    while c := STARTS.search(page, look):
        m = SCANNER.match(page, c.start())
        if m is None or m.end() == m.start():
            look = c.start() + 1
            continue
        name = m.lastgroup
        # nested groups end before the construct's own group, so lastgroup is the construct
        start, end = m.span()
        g = m.group
        kind = KIND_OF.get(name)
        text, tag = "", name
        keep = None  # what an accepted construct leaves behind
        if name == "path":
            kind = None
            keep = m.group()
        elif name == "tag":
            t = g("tname").lower()
            cls = TAGS.get(t)
            glued = start and (page[start - 1].isalnum() or page[start - 1] == "_")
            if cls is not None and glued and not g("close") and (t in SHORT_TAGS or g("tname")[0].isupper() and not g("tname").isupper()):
                if t not in closings:
                    lower = page.lower() if lower is None else lower
                    closings[t] = lower.rfind(f"</{t}>")
                if closings[t] < end:
                    cls = None
            if cls is None or ("," in g("attrs") and "=" not in g("attrs")):
                words(page[at : start + 1])
                at = look = start + 1
                continue
            words(page[at:start])
            if cls == "boiler":
                inside = max(0, inside + (-1 if g("close") else 1))
                out.append(Piece("\n\n", 0, "boiler", HTML))
            elif cls == "heading":
                out.append(Piece("\n\n" if g("close") else "\n\n" + "#" * int(t[1]) + " ", 0, "heading", HTML))
            elif t == "a":
                linked = max(0, linked + (-1 if g("close") else 1))
                out.append(Piece("", 0, "a", HTML))
            else:
                opens = {"li": "\n- ", "td": " | ", "th": " | ", "tr": "\n", "br": "\n", "summary": "\n\n", "dd": "\n", "dt": "\n"}
                closes = {"tr": " |", "li": "", "td": "", "th": "", "dd": "", "dt": ""}
                rest = "\n\n" if cls == "block" else ""
                out.append(Piece((closes if g("close") else opens).get(t, rest), 0, t if t in ("li", "p", "ul", "ol", "table", "td", "th", "tr", "div", "span") else cls, HTML))
            at = look = end
            continue
        elif name == "entity":
            if g("ename") and g("ename") not in NAMED:
                keep, kind = m.group(), None
            else:
                keep = html.unescape(m.group())
        elif name in ("comment", "doctype", "dropped", "switch", "rule", "delimiter", "refdef", "template"):
            pass
        elif name in ("pre", "fence"):
            body = g("pre_body") if name == "pre" else g("fence_body")
            if name == "pre":
                body = html.unescape(re.sub(r"</?(?i:code|span|b|i|em|strong)\b[^<>]*>", "", body))
            words(page[at:start])
            out.append(Piece("\n\n```\n" + body.strip("\n") + "\n```\n\n", len(body.split()), "block_code", kind))
            at = look = end
            continue
        elif name in ("code", "span", "raw"):
            body = g(f"{name}_body")
            keep = html.unescape(body) if name == "code" else body.strip() if name == "span" else body
        elif name == "verbatim":
            body = g("verbatim_body")
            keep = g("verb_body") if body is None else "\n\n```\n" + body.strip("\n") + "\n```\n\n"
        elif name == "display":
            body = next(x for x in (g("dd"), g("db"), g("dp"), g("eb")) if x is not None)
            keep = f"${body.strip()}$" if g("dp") is not None else f"\n\n$${body.strip()}$$\n\n"
        elif name == "dollar":
            body = g("formula")
            if not MATH.search(body) or body[0].isdigit() and not re.search(r"[\\^_={}]|[A-Za-z]\Z", body):
                words(page[at : start + 1])
                at = look = start + 1
                continue
            keep = f"${body}$"
        elif name == "tabular":
            rows = [r for r in re.split(r"\\\\", re.sub(r"\A(?:\[[^\]]*\]|\{[^{}]*\})*|\\hline", "", g("tab_body"))) if r.strip()]
            keep = "\n\n" + "\n".join("| " + " | ".join(c.strip() for c in r.split("&")) + " |" for r in rows) + "\n\n"
        elif name == "texenv":
            keep = "\n\n"
        elif name == "texcmd":
            cmd = g("cmd")
            arg = re.search(r"\{(.*)\}\Z", g("args") or "", re.S)
            inner = arg.group(1) if arg else ""
            if cmd in TEX_HEADINGS:
                keep = "\n\n" + "#" * TEX_HEADINGS[cmd] + " " + _plain_tex(inner) + "\n\n"
            elif cmd == "item":
                keep = "\n-"
            elif cmd == "footnote":
                keep = f" ({_plain_tex(inner)})"
            elif cmd not in TEX_SILENT:
                keep = _plain_tex(inner) if inner else m.group()
        elif name == "texrow":
            keep = "\n"
        elif name == "wikitable":
            keep = _wiki_table(m.group())
        elif name == "wikilink":
            target = g("wl")
            keep = "" if re.match(r"(?i)(?:file|image|category|datei|bild|kategorie|fichier|catégorie|archivo|categoría)\s*:", target) else target.rpartition("|")[2]
        elif name == "quotes":
            keep = g("quoted")
        elif name == "wikihead":
            keep = "\n\n" + "#" * len(g("wm")) + " " + g("whead") + "\n\n"
        elif name == "image":
            keep = g("alt")
        elif name == "link":
            keep = g("label")
        elif name == "footnote":
            keep = ""
        elif name == "reflink":
            if g("rlabel").isdigit() and (g("ref") or "0").isdigit():
                words(page[at : start + 1])
                at = look = start + 1
                continue
            keep = g("rlabel")
        elif name == "extlink":
            keep = (g("xlabel") or "").strip()
        elif name == "autolink":
            keep = g("auto")
        elif name == "task":
            keep = m.group()[: m.group().index("[")].rstrip()
        elif name == "atx":
            keep = g("am") + " "
        elif name == "underline":
            keep = ""
            last = out[-1] if out and at == start else None
            words(page[at:start])
            last = out.pop() if out else last
            if last is not None:
                head, _, title = last.text.rstrip("\n").rpartition("\n")
                level = "# " if g("um")[0] == "=" else "## "
                out.append(last._replace(text=(head + "\n" if head or "\n" in last.text[: len(last.text) - len(title) - 1] else "") + level + title + "\n"))
            out.append(Piece("", 0, "underline", MARKDOWN))
            at = look = end
            continue
        elif name == "quote":
            keep = ""
        elif name == "strong":
            keep = g("bold") if g("bold") is not None else g("bold2")
        elif name == "under":
            if DUNDER.match(g("ital")) and g("um2") == "__":
                keep, kind = m.group(), None
            else:
                keep = g("ital")
        elif name == "strike":
            keep = g("struck")
        words(page[at:start])
        if kind is None:
            words(keep)
        else:
            body = keep or ""
            out.append(Piece("", 0, name, kind))
            if name in ("strong", "under", "strike", "quotes") and re.search(r"[`\[<$\\*_~'&{]", body):
                inner = pieces(body)
                out.extend(Piece("", 0, name, k) for k in sorted({p.kind for p in inner} - {""}))
                body = "".join(p.text for p in inner)
            words(body, {"link": "link_word", "reflink": "link_word", "extlink": "link_word", "image": "link_word"}.get(name, ""))
        at = look = end
    words(page[at:])
    return out


def _plain_tex(s: str) -> str:
    s = re.sub(r"\\(?:emph|text[a-z]{2,3}|textbf|textit|mbox)\{([^{}]*)\}", r"\1", s)
    return re.sub(r"\s+", " ", s.replace("{", "").replace("}", "")).strip()


def _wiki_table(block: str) -> str:
    rows: list[list[str]] = [[]]
    for line in block.split("\n")[1:]:
        line = line.strip()
        if line.startswith(("|-", "|}")):
            rows.append([])
        elif line.startswith(("|", "!")):
            rows[-1] += [c.rpartition("|")[2].strip() if "=" in c else c.strip() for c in re.split(r"\|\||!!", line[1:])]
    return "\n\n" + "\n".join("| " + " | ".join(r) + " |" for r in rows if r) + "\n\n"


class Weights(NamedTuple):
    """Score of a word and of each class of tag; learned by `fit_weights`."""

    word: float
    tags: dict[str, float]
    other: float


def fit_weights(labelled: Iterable[tuple[str, str]]) -> Weights:
    """Weights from labelled pages (boilerplate or content, markup): log-odds of standing in content.

    A class is scored by how much more often, per piece, it stands in content than outside, with additive smoothing,
    in units of the plain word's log-odds. A plain word thus scores 1; every tag class and the words of links and of
    boilerplate elements score their log-odds if negative, and else a small negative number, which only keeps a region
    from growing over markup that adds no words.
    """
    n = {"content": Counter(), "boilerplate": Counter()}
    for label, markup in labelled:
        for p in pieces(markup):
            if p.words:
                n[label][p.tag] += p.words
            elif p.tag:
                n[label][p.tag] += 1
    total = {k: sum(c.values()) for k, c in n.items()}
    odds = lambda t: math.log((n["content"][t] + SMOOTHING) / total["content"]) - math.log((n["boilerplate"][t] + SMOOTHING) / total["boilerplate"])
    scale = max(odds(""), 0.1)
    classes = (set(n["content"]) | set(n["boilerplate"])) - {""}
    return Weights(1.0, {t: min(-0.02, max(-6.0, odds(t) / scale)) for t in classes}, -0.1)


def content_region(parts: list[Piece], weights: Weights, kinds: set[str] | None = None) -> tuple[int, int]:
    """Half-open range of the pieces of maximum total score, found in one linear scan; the longest if several are
    equal. A page without a positive piece is kept whole. The scan adds the kinds of markup of all pieces that it scores
    to `kinds`."""
    best, best_range, score, begin = 0.0, (0, len(parts)), 0.0, 0
    for i, p in enumerate(parts):
        if p.kind and kinds is not None:
            kinds.add(p.kind)
        if p.tag in NEGATIVE_WORDS:
            score += p.words * max(-1.0, weights.tags.get(p.tag, weights.other))
        elif p.words:
            score += p.words * weights.word
        elif p.tag:
            score += weights.tags.get(p.tag, weights.other)
        if score < 0:
            score, begin = 0.0, i + 1
        elif score > best or score == best and best and i + 1 - begin > best_range[1] - best_range[0]:
            best, best_range = score, (begin, i + 1)
    return best_range


TRAILING = re.compile(r"[ \t]+(?=\n)")
BREAKS = re.compile(r"\n{3,}")


@lru_cache(maxsize=1)
def default_weights() -> Weights:
    from millrace.llm.labelled_pages import MARKUP_PAGES

    return fit_weights(MARKUP_PAGES)


def region_text(parts: list[Piece], a: int, b: int) -> str:
    """Text of the range, grown to whole lines, so that a sentence which ends in a link keeps its end, and with the mark in
    front of its first words. Boilerplate elements and their words stay outside."""
    while a and not parts[a - 1].words and parts[a - 1].tag in OPENING:
        a -= 1
    head, tail = [], []
    if a < len(parts) and not parts[a].text.startswith("\n"):
        for p in reversed(parts[:a]):
            if p.tag in ("boiler", "boiler_word"):
                break
            head.append(p.text.rpartition("\n")[2])
            if "\n" in p.text:
                break
    if b and not parts[b - 1].text.endswith("\n"):
        for p in parts[b:]:
            if p.tag in ("boiler", "boiler_word"):
                break
            tail.append(p.text.partition("\n")[0])
            if "\n" in p.text:
                break
    return "".join([*reversed(head), *(p.text for p in parts[a:b]), *tail])


def clean_page(page: str | None, weights: Weights | None = None) -> tuple[str | None, list[str]]:
    """Clean text and sorted kinds of markup of one page. Null stays null; a text without markup stays as it is."""
    if page is None:
        return None, []
    parts = pieces(page)
    found: set[str] = set()
    a, b = content_region(parts, weights or default_weights(), found)
    if not found:
        return page, []
    text = region_text(parts, a, b)
    return BREAKS.sub("\n\n", TRAILING.sub("", text)).strip(), sorted(found)


RESULT = T.StructType([T.StructField("clean_text", T.StringType()), T.StructField("kinds", T.ArrayType(T.StringType()))])


def clean_markup(rows: DataFrame, text: str = "text", weights: Weights | None = None) -> DataFrame:
    """The rows with `clean_text` and `kinds`, the kinds of markup their text held.

    Headings, lists, code blocks, tables and formulas stay, in one plain form. Of a text with markup the contiguous
    region of maximum score is kept: words score positive and tags negative, with weights learned from labelled pages,
    and a linear scan finds it. Texts without any of the characters that markup needs never leave the JVM; the others
    are converted in Arrow batches, whole. Null gives null and no kinds, a blank text stays as it is.
    """
    weights = weights or default_weights()

    @F.pandas_udf(RESULT)
    def convert(texts: pd.Series) -> pd.DataFrame:
        done = [(None, None) if t is None else clean_page(t, weights) for t in texts]
        return pd.DataFrame({"clean_text": [d[0] for d in done], "kinds": [d[1] for d in done]})

    marked = F.col(text).rlike(TRIGGER)
    out = rows.withColumn("_marked", marked).withColumn("_done", convert(F.when(F.col("_marked"), F.col(text))))
    none = F.array().cast("array<string>")
    return out.select(
        *rows.columns,
        F.when(F.col("_marked"), F.col("_done.clean_text")).otherwise(F.col(text)).alias("clean_text"),
        F.when(F.col("_marked"), F.col("_done.kinds")).otherwise(none).alias("kinds"),
    )
