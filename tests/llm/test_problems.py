"""The pN operators against brute force on small tables with nulls, ties, repeated rows and hot groups."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import budget, capping, grouped_split, leaks, markup, mixing, packing, sampling, stuffing

DOCS = "ord long, id string, source_id string, quality_score double, metadata map<string,string>, text string, primary_category string, language string, category string"


def doc(ord_, id_, source="s", q=0.5, author=None, text="word " * 10, cat="cat_a", lang="en", category="c"):
    return (ord_, id_, source, q, None if author is None else {"author": author}, text, cat, lang, category)


# --- 1 ---


@pytest.mark.parametrize(
    ("text", "kinds"),
    [
        ("plain text with C# and 5 * 3 and a < b, snake_case and [3] for R&D", []),
        ("<p>Hello</p>", ["html"]), ("List<T> of Map<String, Order>", []), ("a &amp; b", ["html"]), ("x<br/>y", ["html"]), ("<!-- c -->", ["html"]), ("and so on &c.; done", []),
        ("# Title\ntext", ["markdown"]), ("Title\n=====\ntext", ["markdown"]), ("a `**b**` c", ["markdown"]), ("see [x](http://y)", ["markdown"]), ("- item\n* item\n1. item", []),
        ("- [ ] task", ["markdown"]), ("```\n<b>x</b> $a_b$\n```", ["markdown"]), ("2 * 3 * 60", []), ("__init__ and _private", []), ("~~gone~~", ["markdown"]),
        ("== Head ==", ["wiki"]), ("a == b", []), ("[[Page|label]]", ["wiki"]), ("'''bold'''", ["wiki"]), ("{{Stub}}", ["wiki"]), ("{| class=x\n|-\n| a || b\n|}", ["wiki"]), ("/v1/{tenant}/x", []),
        ("[https://x.example label]", ["wiki"]), ("https://x.example/a_b_c", []),
        ("with $t_{i+1}$ now", ["latex"]), ("costs $96 and $12 each", []), ("\\section{One}", ["latex"]), ("under C:\\temp\\new\\beta here", []), ("\\( x \\)", ["latex"]),
        ("\\begin{verbatim}\n<b>&amp;</b>\n\\end{verbatim}", ["latex"]), ("<pre>**x** &lt;</pre>", ["html"]), ("<h1>x</h1> and **y**", ["html", "markdown"]),
        ("", []), ("   ", []), ("# open ```\nnever closed", ["markdown"]),
    ],
)
def test_kinds_of_markup(text, kinds):
    assert markup.clean_page(text)[1] == kinds


def test_clean_text_keeps_structure():
    page = "<html><head><title>T</title></head><body><nav><a href='/'>Home</a></nav><h1>Head</h1><p>Some words that are read by people.</p><ul><li>one entry</li></ul><table><tr><td>a</td><td>b</td></tr></table><pre><code>x = 1</code></pre><p>\\( a^2 \\) and more words here.</p><footer>Copyright notice</footer></body></html>"
    out = markup.clean_page(page)[0]
    assert "Home" not in out and "Copyright" not in out and "# Head" in out and "- one entry" in out and "```\nx = 1\n```" in out and "| a | b |" in out and "$a^2$" in out
    tex = markup.clean_page("\\section{A}\n\nText of some length here.\n\\begin{itemize}\n\\item one\n\\end{itemize}\n\\begin{tabular}{l}\na & b \\\\\n\\end{tabular}")[0]
    assert "## A" in tex and "- one" in tex and "| a | b |" in tex
    assert "# Title" in markup.clean_page("Title\n===\n\nbody text follows here")[0]


def test_region_is_the_best_contiguous_one():
    rng = random.Random(3)
    w = markup.Weights(1.0, {"t": -2.0, "link_word": -1.0}, -0.1)
    for _ in range(200):
        parts = [markup.Piece("x", rng.randint(0, 3), rng.choice(["", "t", "link_word"])) for _ in range(rng.randint(1, 9))]
        value = lambda p: -1.0 * p.words if p.tag == "link_word" else p.words * 1.0 if p.words else (w.tags[p.tag] if p.tag else 0.0)
        a, b = markup.content_region(parts, w)
        best = max([sum(map(value, parts[i:j])) for i in range(len(parts)) for j in range(i + 1, len(parts) + 1)] + [0.0])
        if best > 0:
            assert sum(map(value, parts[a:b])) == pytest.approx(best)


#: Whole pages: (page, text that a reader wants). The rest is navigation, lists of links and notices.
WHOLE_PAGES = [
    (
        "<html><body><div class='top'><a href='/'>Start</a> <a href='/shop'>Shop</a> <a href='/help'>Help</a></div><h1>Building a kiln</h1><p>A small kiln can be built in a week from old bricks and clay.</p><ul><li>Dry the bricks first.</li><li>Leave a gap for the smoke.</li></ul><pre><code>heat = 900</code></pre><p>The heat follows \\( q = m c \\) as before.</p><div><a href='/a'>Older</a> <a href='/b'>Newer</a> <a href='/c'>Archive</a></div></body></html>",
        "# Building a kiln A small kiln can be built in a week from old bricks and clay. - Dry the bricks first. - Leave a gap for the smoke. ``` heat = 900 ``` The heat follows $q = m c$ as before.",
    ),
    (
        "[Home](/) [Blog](/blog) [Tags](/tags) [Feed](/feed)\n\n# Grafting apples\n\nCut the twig in **winter** and keep it cold until the sap rises. See [the long guide](/guide).\n\n1. Split the stock.\n2. Push in the twig.\n\n```\nwax 20\n```\n\n[Previous](/p) [Next](/n) [Top](#top) [Contact](/c)",
        "# Grafting apples Cut the twig in winter and keep it cold until the sap rises. See the long guide. 1. Split the stock. 2. Push in the twig. ``` wax 20 ```",
    ),
    (
        "<nav><a href='/'>News</a><a href='/s'>Sport</a></nav><article><h2>Low water</h2><p>The river has not been so low since the dam was built, and the ferries stay at the bank.</p><table><tr><td>May</td><td>12</td></tr></table></article><footer>All rights reserved. Imprint</footer>",
        "## Low water The river has not been so low since the dam was built, and the ferries stay at the bank. | May | 12 |",
    ),
    (
        "== Course ==\n\nThe stream rises in the [[Hill country|hills]] and ends in a lake that has no outlet.\n\n* Fish are rare.\n\n=== Use ===\n\nThree mills stood here.\n\n[[Category:Streams]]\n[[Category:Lakes]]\n{{Stub}}",
        "## Course The stream rises in the hills and ends in a lake that has no outlet. * Fish are rare. ### Use Three mills stood here.",
    ),
    (
        "\\documentclass{article}\n\\begin{document}\n\\section{Ropes}\n\nA rope of hemp holds $T = 3 d^2$ at least, which every rigger knows.\n\\begin{itemize}\n\\item Wet rope is weaker.\n\\end{itemize}\n\\bibliography{refs}\n\\end{document}",
        "## Ropes A rope of hemp holds $T = 3 d^2$ at least, which every rigger knows. - Wet rope is weaker.",
    ),
    (
        "<div><a href='/1'>One</a><a href='/2'>Two</a><a href='/3'>Three</a><a href='/4'>Four</a></div><p>Good rope matters more to the keeper than paint, said <a href='/x'>the old harbour master.</a></p>",
        "Good rope matters more to the keeper than paint, said the old harbour master.",
    ),
]


def _overlap(got, want):
    from collections import Counter

    a, b = Counter(got.split()), Counter(want.split())
    return sum((a & b).values()), sum(a.values()), sum(b.values())


def test_region_of_whole_pages(capsys):
    """Words of planted pages: what is kept must be wanted and what is wanted kept, more so than without the region."""
    score = {}
    for name, clean in (("region", lambda t: markup.clean_page(t)[0]), ("whole", lambda t: "".join(p.text for p in markup.pieces(t)))):
        parts = [_overlap(clean(page), want) for page, want in WHOLE_PAGES]
        both, got, wanted = (sum(x) for x in zip(*parts, strict=True))
        score[name] = (both / got, both / wanted)
    with capsys.disabled():
        print(f"\nmarkup regions, words kept that are wanted / wanted words kept: {score}")
    assert score["region"][0] > 0.9 and score["region"][1] > 0.95 and score["region"][0] > score["whole"][0]


def test_scan_of_many_glued_tags_is_linear():
    import time

    page = "x<b y" * 200 + " a<b> word" * 40_000
    start = time.time()
    assert markup.clean_page(page)[0] is not None and time.time() - start < 20


def test_markup_frame(spark):
    rows = spark.createDataFrame([(1, "**x** y"), (2, None), (3, ""), (4, "x" * 200_000 + " <b>y</b>")], "ord long, text string")
    got = {r.ord: r for r in markup.clean_markup(rows).collect()}
    assert got[1].clean_text == "x y" and got[2].clean_text is None and list(got[2].kinds) == [] and got[3].clean_text == "" and got[4].kinds == ["html"]


# --- 2 ---


def greedy(edges, caps, order):
    room, kept = dict(caps), set()
    for r in order:
        at = [c for c in edges[r] if c in room]
        if all(room[c] > 0 for c in at):
            kept.add(r)
            for c in at:
                room[c] -= 1
    return kept


def test_suitor_caps_equal_greedy(spark):
    rng = random.Random(1)
    edges = {f"r{i:03d}": {rng.choice(["hot", "a", "b"]), rng.choice(["x", "y", "z", "free"])} for i in range(120)}
    caps = {"hot": 15, "a": 9, "b": 0, "x": 10, "y": 7, "z": 100}
    rank = {r: rng.randint(0, 5) for r in edges}
    rows = spark.createDataFrame([(r, c, rank[r]) for r, cs in edges.items() for c in cs] * 2, "record string, contributor string, w int")
    got = capping.suitor_caps(rows, spark.createDataFrame(list(caps.items()), "contributor string, capacity long"), [F.col("w"), F.col("record")])
    assert {r.record for r in got.filter("kept").collect()} == greedy(edges, caps, sorted(edges, key=lambda r: (rank[r], r)))
    assert got.count() == len(edges)
    assert capping.suitor_caps(rows.limit(0), spark.createDataFrame([], "contributor string, capacity long"), [F.col("w"), F.col("record")]).count() == 0


def test_capping_of_documents(spark):
    rows = [doc(i, f"d{i}", "Big Source" if i % 2 else "big_source", q) for i, q in enumerate([0.9, None, 0.9, 7.0, float("nan"), 0.1, -1.0, 0.5])]
    rows += [doc(99, "d0", "other", 0.0), doc(100, None), doc(101, "free", None)]
    sources = spark.createDataFrame([("big_source", 300), ("other", None), (None, 5)], "id string, document_cap_permille int")
    got = capping.cap_documents(spark.createDataFrame(rows, DOCS), sources)
    assert sorted(r.id for r in got.filter("kept and source = 'bigsource'").collect()) == ["d2", "d7"]  # floor(0.3 * 9) = 2
    assert got.count() == 9


# --- 3 ---


def test_chunked_counts_are_exact(spark):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["a", "bb", " ", "  ", "\n", "\t", " ", "é", ".", "x1"]) for _ in range(rng.randint(0, 300))) for _ in range(60)] + [None, "", "  "]
    rows = [doc(i, str(i), text=t) for i, t in enumerate(texts)] + [doc(0, "0", text=texts[0])] * 2
    d = spark.createDataFrame(rows, DOCS)
    for tokenizer in ("words", "byte_bpe_50k"):
        whole = sorted((r.ord, r.tokens) for r in budget.document_tokens(d, (), tokenizer).collect())
        cut = sorted((r.ord, r.tokens) for r in budget.document_tokens(d, (), tokenizer, chunk_chars=7).collect())
        assert whole == cut and len(cut) == len(rows)
    want = {i: max(1, int(1.3 * len(re.findall(r"[^ \t\n\r]+", t)))) if re.search(r"[^ \t\n\r]", t or "") else 0 for i, t in enumerate(texts)}
    assert dict((r.ord, r.tokens) for r in budget.document_tokens(d).collect()) == want


def test_budget_slices(spark):
    rows = [doc(1, "a", "My Source", text="one two", lang="en-US"), doc(2, "b", "my_source", text="", lang="deu"), doc(3, "c", None, text="x", lang=None, category=None)]
    got = {(r.slice, r.key): (r.rows, r.tokens) for r in budget.token_budget(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[("source", "my_source")] == (2, 2) and got[("source", "(none)")] == (1, 1) and got[("language", "en")] == (1, 2) and got[("language", "und")] == (1, 1)
    assert got[("total", "(all)")] == (3, 3) and got[("category", "(none)")] == (1, 1)


# --- 4 ---


def test_packing(spark):
    rng = random.Random(4)
    items = [(1, f"d{i}", rng.choice([3, 17, 40, 64, 99, 100, 101, 250, 0]), 100) for i in range(150)] + [(2, "only", 5, 100), (3, "huge", 1000, 100), (None, "n", 5, 100), (4, "bad", 5, 0)]
    d = spark.createDataFrame(items, "run_id long, id string, tokens long, capacity long")
    rows = packing.pack(d).collect()
    bins: dict = {}
    for r in rows:
        bins[(r.run_id, r.bin)] = bins.get((r.run_id, r.bin), 0) + r["size"]
    assert all(v <= 100 for v in bins.values())
    total: dict = {}
    for r in rows:
        total[(r.run_id, r.id)] = total.get((r.run_id, r.id), 0) + r["size"]
    assert total == {(a, b): t for a, b, t, c in items if a is not None and c > 0}
    assert {r.id for r in rows if r.pieces > 1} == {b for a, b, t, c in items if a and c and t > c} and len({(r.run_id, r.id, r.piece) for r in rows}) == len(rows)
    gaps: list[int] = []
    for t in sorted((t % 100 if t > 100 else t for a, _, t, _ in items if a == 1), reverse=True):
        if 0 < t < 100:
            fits = [g for g in gaps if g >= t]
            if fits:
                gaps.remove(min(fits))
            gaps.append((min(fits) if fits else 100) - t)
    full = sum(t // 100 for a, _, t, _ in items if a == 1)
    assert sum(1 for (a, _), v in bins.items() if a == 1 and v) <= 1.03 * (len(gaps) + full) + 1  # best fit decreasing
    assert packing.packing_report(packing.pack(d)).filter("run_id = 3").first().sequences == 10
    assert packing.pack(d.limit(0)).count() == 0


def test_packing_does_not_depend_on_partitions(spark):
    rng = random.Random(9)
    d = spark.createDataFrame([(i % 2, f"d{i}", rng.randint(20, 619), 2048) for i in range(800)] + [(5, "x", None, 10)], "run_id long, id string, tokens long, capacity long")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        results = []
        for n in (1, 16):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            packed = packing.pack(d)
            results.append(sorted((r.run_id, r.id, r.piece, r.bin) for r in packed.collect()))
        assert results[0] == results[1]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    checks = {r.run_id: r for r in packing.packing_checks(packed).collect()}
    assert all(r.overfull_sequences == r.divided_below_capacity == r.wrong_pieces == 0 and r.tight for r in checks.values()) and checks[5].tokens == 0
    assert packing.packing_report(packed).agg(F.min("efficiency")).first()[0] > 0.98


# --- 5 ---

SOURCES = "id string, repository_owner string"


def test_groups_equal_union_find(spark):
    rng = random.Random(6)
    sources = [(f"src_{i}", rng.choice(["Own A", "own-a", "own b", None, "n/a", f"solo{i}"])) for i in range(25)]
    rows = [doc(i, f"d{i}", rng.choice([s for s, _ in sources] + [None, "unknown"]), author=rng.choice([f"au {i % 40}", "N/A", None, "", "-"])) for i in range(80)]
    key = lambda x: None if x is None or (s := re.sub(r"[^a-z0-9]", "", x.lower())) in ("", "na", "unknown") else s
    parent: dict = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    owner = {key(s): key(o) for s, o in sources}
    for r in rows:
        s, a = key(r[2]), key((r[4] or {}).get("author"))
        nodes = [("d", r[1])] + ([("s", s)] if s else []) + ([("a", a)] if a else []) + ([("o", owner[s])] if s and owner.get(s) else [])
        for n in nodes:
            parent[find(n)] = find(nodes[0])
    groups: dict = {}
    for r in rows:
        groups.setdefault(find(("d", r[1])), []).append(r)
    want = {}
    for g in groups.values():
        names = {r[2] for r in g if key(r[2])}
        if len(names) >= 2:
            want |= {r[1]: min(names) for r in g}
    docs, src = spark.createDataFrame(rows, DOCS), spark.createDataFrame(sources, SOURCES)
    nodes = grouped_split.document_nodes(docs, src)
    grouped = grouped_split.ComponentTable().update(nodes, src, with_splits=False)
    assert {r.id: r.group_id for r in grouped_split.cross_source_groups(grouped).collect()} == want


def test_splits_persist_and_conflicts_are_quarantined(spark, tmp_path):
    sources = spark.createDataFrame([(f"s{i}", None) for i in range(60)], SOURCES)
    rows = [doc(i, f"d{i}", f"s{i % 60}") for i in range(240)]
    table = grouped_split.ComponentTable()
    first = {r.id: r.split for r in table.update(grouped_split.document_nodes(spark.createDataFrame(rows, DOCS), sources), sources).collect()}
    by: dict = {}
    for i, s in first.items():
        by.setdefault(rows[int(i[1:])][2], set()).add(s)
    counts = {k: sum(1 for s in first.values() if s == k) for k in grouped_split.SHARES}
    assert all(len(v) == 1 for v in by.values()) and 4 <= counts["validation"] <= 20 and 4 <= counts["heldout"] <= 20
    table.save(str(tmp_path / "state"))
    (tmp_path / "state" / "version-2").mkdir()  # a job that died while writing
    train = next(s for s, v in by.items() if v == {"train"})
    held = next(s for s, v in by.items() if v == {"heldout"})
    more = rows + [doc(300, "x1", train, author="bridge"), doc(301, "x2", held, author="bridge"), doc(302, "new", None, author="fresh one")]
    table = grouped_split.ComponentTable.load(spark, str(tmp_path / "state"))
    second = {r.id: r.split for r in table.update(grouped_split.document_nodes(spark.createDataFrame(more, DOCS), sources), sources).collect()}
    assert second["x1"] == second["x2"] == "quarantine" and second["new"] in grouped_split.SHARES
    assert all(second[i] == s for i, s in first.items() if rows[int(i[1:])][2] not in (train, held))


def test_new_components_fill_the_split_that_lacks(spark):
    sizes = [("old_t", 1700), ("old_v", 100)] + [(f"new{i:02d}", 10) for i in range(20)]
    earlier = spark.createDataFrame([("old_t", "train"), ("old_v", "validation")], "component string, split string")
    got = grouped_split.assign_splits(spark.createDataFrame(sizes, "component string, documents long"), earlier)
    by = {r["split"]: r["n"] for r in got.groupBy("split").agg(F.sum("documents").alias("n")).collect()}
    assert by == {"train": 1800, "validation": 100, "heldout": 100} and got.count() == len(sizes)


def test_the_deal_samples_no_keys_into_the_driver(spark, monkeypatch):
    rng = random.Random(5)
    sizes = {f"c{i}": rng.choice([1, 1, 2, 3, 40]) for i in range(600)}
    want, left = dict.fromkeys(sizes, "train"), sorted(sizes, key=lambda c: hashlib.sha256(c.encode()).hexdigest())
    room = 0.05 * sum(sizes.values())
    for split in ("heldout", "validation"):
        upto = 0
        for c in [c for c in left if sizes[c] <= room]:
            upto += sizes[c]
            if upto - sizes[c] / 2 < room:
                want[c] = split
        left = [c for c in left if want[c] == "train"]
    rows = spark.createDataFrame(list(sizes.items()), "component string, documents long")
    earlier = spark.createDataFrame([], "component string, split string")
    monkeypatch.setattr(type(rows), "repartitionByRange", lambda *_: pytest.fail("ranges are found by sampling keys into the driver"))
    got = {r.component: r.split for r in grouped_split.assign_splits(rows, earlier).collect()}
    assert got == want and set(got.values()) == set(grouped_split.SHARES)


def test_components_are_neither_copied_nor_broadcast(spark, monkeypatch):
    """Documents find their component and split over a join whose larger side is sent once, also those of a hot anchor."""
    sources = spark.createDataFrame([(f"s{i}", f"owner{i // 3}") for i in range(30)], SOURCES)
    rows = [doc(i, f"d{i}", "s0" if i % 3 else f"s{i % 30}", author=f"a{i % 7}" if i % 11 == 0 else None) for i in range(300)]
    nodes = grouped_split.document_nodes(spark.createDataFrame(rows, DOCS), sources)
    want = {tuple(r) for r in grouped_split.ComponentTable().update(nodes, sources).collect()}
    groups = {tuple(r) for r in grouped_split.cross_source_groups(grouped_split.ComponentTable().update(nodes, sources, with_splits=False)).collect()}
    monkeypatch.setattr(grouped_split, "BROADCAST", 0, raising=False)
    attach = grouped_split.attach
    monkeypatch.setattr(grouped_split, "attach", lambda *a, **k: attach(*a, **(k | {"hot": 50})))
    monkeypatch.setattr(grouped_split, "lookup", lambda *_: pytest.fail("a side is repeated for every row"))
    assert {tuple(r) for r in grouped_split.ComponentTable().update(nodes, sources).collect()} == want and len(want) == 300
    grouped = grouped_split.ComponentTable().update(nodes, sources, with_splits=False)
    assert {tuple(r) for r in grouped_split.cross_source_groups(grouped).collect()} == groups and groups


# --- 6 ---


def test_sample_follows_targets(spark):
    rows = [doc(i, f"d{i}", cat=["Cat A", "cat_b", "CAT-C"][i % 10 % 3], text="w " * (10 + i % 7)) for i in range(600)] + [doc(1000, "none", cat=None), doc(1001, "odd", cat="misc"), doc(1002, "d1", cat="cat_b")]
    targets = [(1, "cat_a", 0.2, 0.3, 0), (1, "cat_b", 0.5, 0.3, 0), (1, "cat_c", 0.3, 0.3, 0), (2, "cat_a", 0.9, 0.9, 5), (2, "cat_b", 0.0, 0.9, 7), (2, "cat_d", 0.1, 0.9, 1), (3, "cat_a", None, None, None)]
    t = spark.createDataFrame(targets, "target_set long, category string, target_share double, sample_fraction double, min_documents long")
    docs, summary, plan = sampling.sample_plan(spark.createDataFrame(rows, DOCS), t)
    report = {(r.target_set, r.category): r for r in sampling.sample_report(sampling.draw(docs, summary, plan), plan).collect()}
    assert summary.filter("id is not null").count() <= 603
    assert [report[(1, c)].actual_share for c in ("cat_a", "cat_b", "cat_c")] == pytest.approx([0.2, 0.5, 0.3], abs=0.02) and report[(1, "cat_b")].met
    assert not report[(2, "cat_a")].met and not report[(2, "cat_d")].met and report[(2, "cat_b")].documents == 7 and report[(3, "cat_a")].documents == 0
    again = sampling.draw(docs, summary, plan)
    assert again.count() == again.distinct().count() == sampling.draw(docs, summary, plan).intersect(again).count()
    docs, stored, plan = sampling.sample_plan(spark.createDataFrame([], DOCS), t)
    empty = sampling.sample_report(sampling.draw(docs, stored, plan), plan)
    assert empty.filter("not met and target_set = 1").count() == 0 and empty.filter("documents > 0").count() == 0


def test_reservoirs_are_bounded_and_the_sample_exact(spark, monkeypatch):
    """Trimmed reservoirs hold a part of the documents; with too little slack the rest is read again."""
    rows = [doc(i, f"d{i}", cat="cat_a" if i % 3 else "cat_b", text="w " * (3 + i % 9)) for i in range(900)]
    t = spark.createDataFrame([(1, "cat_a", 0.5, 0.2, 0), (1, "cat_b", 0.5, 0.2, 3)], "target_set long, category string, target_share double, sample_fraction double, min_documents long")
    want = None
    for slack in (100.0, 1.25, 0.5):
        monkeypatch.setattr(sampling, "SLACK", slack)
        kept = []
        docs = sampling.prioritized(spark.createDataFrame(rows, DOCS), t)
        share = slack

        def fill(batches, share=share):
            sampling.SLACK = share
            yield from sampling._fill(batches)

        stored = sampling.materialize(docs.mapInArrow(fill, "category string, id string, tokens long, priority long, documents long, floor long"), "reservoirs")
        plan = sampling.quotas(stored, t)
        got = sorted(tuple(r) for r in sampling.draw(docs, stored, plan).collect())
        kept = stored.filter("id is not null").count()
        assert want in (None, got) and (kept == 900) == (slack == 100.0)
        want = got
    assert len(want) > 100


# --- 7 ---


def test_leaks_equal_brute_force(spark):
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(60)] + ["the", "of", "a"] * 8
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([5, 12, 30]))), None if i == 3 else " ".join(rng.choice(vocab) for _ in range(14))) for i in range(12)]
    pages = []
    for d in range(60):
        words = [rng.choice(vocab) for _ in range(rng.randint(0, 60))]
        if d % 3 == 0:
            src = items[rng.randrange(12)][1].split()
            at, n = rng.randrange(max(1, len(src) - 10)), rng.choice([11, 12, 20])
            words[5:5] = [("**" + w.upper() + "**," if rng.random() < 0.3 else w[:1] + "​" + w[1:]) for w in src[at : at + n]]
        pages.append((d, "\n".join([" ".join(words[:20]), " ".join(words[20:])])))
    pages += [(100, None), (101, ""), (102, pages[0][1])]
    tok = lambda t: re.findall(r"[^\W_]+", (t or "").replace("​", "").lower())
    grams = lambda w: {tuple(w[i : i + 12]) for i in range(len(w) - 11)}
    want = {(d, i) for d, t in pages for i, a, b in items if grams(tok(t)) & (grams(tok(a)) | grams(tok(b)))}
    passages = leaks.test_terms(spark.createDataFrame(items, "item_id long, scenario string, question string"), ["scenario", "question"])
    docs = spark.createDataFrame(pages, "doc_id long, text string")
    for index in (leaks.build_index(docs, passages), leaks.build_index(docs)):
        got = {(r.doc_id, r.item_id) for r in leaks.leaks(index, passages).collect()}
        assert got == want and want
    assert leaks.leaks(leaks.build_index(docs.limit(0)), passages).count() == 0


def test_proximity(spark):
    items = spark.createDataFrame([(1, "red blue green white black")], "item_id long, scenario string")
    docs = spark.createDataFrame([(1, "black white x green blue red"), (2, "red blue"), (3, "red " + "x " * 200 + "blue green white black")], "doc_id long, text string")
    p = leaks.test_terms(items, ["scenario"])
    assert [r.doc_id for r in leaks.proximity(leaks.build_index(docs, p), p).collect()] == [1]


def test_proximity_of_long_passages_at_every_offset(spark):
    passage = " ".join(f"p{i}" for i in range(91))
    items = spark.createDataFrame([(1, passage)], "item_id long, scenario string")
    far = [f"p{i}" for i in range(91)]
    rows = [(o, " ".join(["x"] * o + [passage, "y y y"])) for o in range(80)] + [(900, " ".join(w + " z z z" for w in far)), (901, "p1 " * 500)]
    p = leaks.test_terms(items, ["scenario"])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.words for r in leaks.proximity(leaks.build_index(docs, p), p).collect()}
    assert got == {o: 91 for o in range(80)}


def test_proximity_without_the_rarest_words(spark):
    words = [f"p{i}" for i in range(20)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id long, scenario string")
    others = [(i, " ".join(words[2:])) for i in range(2, 6)]
    docs = spark.createDataFrame([(1, "p0 p1"), *others, (9, " ".join(words[3:]))], "doc_id long, text string")
    p = leaks.test_terms(items, ["scenario"])
    assert {r.doc_id for r in leaks.proximity(leaks.build_index(docs, p), p).collect()} == {2, 3, 4, 5}


# --- 8 ---


def test_mixture(spark):
    rows = [(i, "w " * (5 + i % 11), "Src A" if i % 3 else "src-b") for i in range(300)] + [(900, "x", None), (901, None, "src_a"), (902, "", " ")]
    pages = mixing.sized_pages(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    w = spark.createDataFrame([(1, "src_a", 0.5, 0.5, 3), (1, "src_b", 0.5, 0.5, 3), (2, "src_b", 1.0, 2.0, 2), (2, "gone", 0.1, 0.1, 4), (3, "src_a", None, None, None)], "mixture_id long, source_key string, target_weight double, budget_fraction double, max_repeats long")
    plan = mixing.mixture_plan(pages, w)
    drawn = mixing.mix(pages, plan)
    rep = {(r.mixture_id, r.source_key): r for r in mixing.mixture_report(drawn, plan).collect()}
    for k in (("src_a", 1), ("src_b", 1)):
        r = rep[(k[1], k[0])]
        assert abs(r.tokens - r.wanted) < 0.03 * r.wanted and not r.short
    assert rep[(2, "src_b")].short and not rep[(3, "src_a")].short and rep[(2, "gone")].short and rep[(3, "src_a")].tokens == 0
    assert drawn.filter("mixture_id = 2 and source_key = 'src_b'").agg(F.max("copies")).first()[0] == 2
    each = {r.copies for r in drawn.filter("mixture_id = 1 and source_key = 'src_b'").select("copies").distinct().collect()}
    assert max(each) - min(each) <= 1


# --- 9 ---

PROSE = "The harbour was closed for a week because the wall had to be repaired. Nobody knew how long it would take, so the boats were moved to the other side of the bay."
SPAM = "ropes, cheap ropes, buy ropes, best ropes, ropes online, ropes, cheap nets, ropes, buy nets, nets, ropes near me, ropes, nets, buy ropes, cheap ropes, ropes"


@pytest.mark.parametrize(
    ("text", "spam"),
    [
        (PROSE, False), (SPAM, True), (PROSE + "\n\n" + SPAM[:60], False), ("The wall is old.\n\n" + SPAM + "\n" + SPAM, True), ("", False), (None, False),
        ("\n".join(f"- [Page {i}](https://x.example/{i})" for i in range(30)), True), ("\n".join(f"- [Page {i}](https://x.example/{i}) {PROSE}" for i in range(5)), False),
        ("\n".join(["Home > Blog > Next > Page 2 https://x.example/a/2"] * 12), True), ("| a | b |\n|---|---|\n" + "\n".join(f"| part {i} | {i} |" for i in range(20)) + "\n\n" + PROSE, False),
        ("```\n" + "\n".join(f"x{i} = call({i});" for i in range(20)) + "\n```", False), ("\n\n".join(f"Term {i}: the part of a boat that is under the water." for i in range(12)), False),
    ],
)
def test_pages(text, spam):
    w = stuffing.word_shares(stuffing.default_model(), ["" if text is None else text])[0]
    assert (w[1:].sum() > w[0]) == spam


@pytest.mark.parametrize("mark", ["```", "$$", "{|", "<pre>", "\\begin{verbatim}"])
def test_a_block_that_is_never_closed_hides_nothing(mark):
    lines = "\n".join(["ropes, cheap ropes, buy ropes, best ropes, ropes online, cheap nets, buy nets"] * 30)
    w = stuffing.word_shares(stuffing.default_model(), [mark + "\n" + lines])[0]
    assert w[1:].sum() > w[0]


def test_line_labels(spark):
    rows = spark.createDataFrame([(1, PROSE + "\n\n" + SPAM), (2, None), (3, "")], "doc_id long, text string")
    got = [(r.doc_id, r.line, r.label) for r in stuffing.label_lines(rows).orderBy("doc_id", "line").collect()]
    assert got == [(1, 0, "prose"), (1, 1, "tag_list")]


#: Pages written after the model was fitted and never used for it: (spam, text).
HELD_OUT = [
    (False, "How the ferry came to Lund\n\nFor years nobody wanted to pay for a ferry. Then the bridge fell, and within a month the council had bought one from the next valley.\n\n- It carries six carts.\n- It does not run when there is ice.\n\nThe old ferryman still tells the story to anyone who asks."),
    (False, "| part | wear | change |\n|---|---|---|\n| chain | high | yearly |\n| hub | low | never |\n| rim | medium | after a crash |\n\nA rim that is bent should be replaced, because it cannot be made round again."),
    (False, "Glossary of weaving\n\nWarp: the threads that run along the cloth and are held by the loom.\n\nWeft: the thread that is carried across by the shuttle.\n\nHeddle: the loop that lifts a thread of the warp."),
    (False, "```sh\ncd build\nmake all\n./run --fast\n```\n\nIf the build fails, look at the log first. Most errors come from a missing header."),
    (False, "Q: Can clay be dried in the sun?\n\nA: It can, but it will crack if it dries too fast. Cover it with a wet cloth.\n\nQ: How hot must the kiln be?\n\nA: That depends on the glaze that was chosen."),
    (False, "## Links worth reading\n\n- [On salt](https://salt.example/a) tells how salt was carried over the pass before the road was built.\n- [On sugar](https://sugar.example/b) explains why the beet won over the cane in the north.\n- [On tea](https://tea.example/c) is a short history of a drink that nobody wanted at first."),
    (False, "Die Mühle am Bach\n\nDer Müller hat das Rad im Winter ausgebaut, weil das Eis es sonst zerstört hätte. Im Frühjahr wird es wieder eingesetzt."),
    (False, "El molino viejo\n\nNadie sabe quién construyó el molino, pero todos recuerdan el ruido que hacía cuando el río venía crecido."),
    (True, "cheap bikes, bikes for sale, buy bikes, used bikes, bikes near me, best bikes, city bikes, bikes, kids bikes, bikes online, bike shop, bikes cheap\n" * 6),
    (True, "\n".join(f"- [Offer {i}](https://offers.example/{i})" for i in range(40))),
    (True, "Home | Shop | Cart | Account | Help | Contact | Imprint\n" * 10 + "\nWe sell shoes."),
    (True, "#shoes #boots #sandals #sneakers #sale #leather #vegan #summer #winter #kids\n" * 8),
    (True, "\n".join(f"Leather boots model {i} 49.99 in stock #{i}" for i in range(30))),
    (True, "gartenmöbel günstig, gartenmöbel kaufen, gartenmöbel online, gartenmöbel holz, gartenmöbel set, gartenmöbel angebot, gartenmöbel shop\n" * 6),
    (True, "Our shop is small. It was opened last year.\n\n" + "lamps, cheap lamps, buy lamps, best lamps, lamps online, desk lamps, floor lamps, lamps sale\n" * 8),
    (True, "\n".join(f"https://list.example/page/{i}" for i in range(60))),
]


def test_held_out_pages(capsys):
    got = [bool((w := stuffing.word_shares(stuffing.default_model(), [t])[0])[1:].sum() > w[0]) for _, t in HELD_OUT]
    right = sum(g == s for g, (s, _) in zip(got, HELD_OUT, strict=True))
    with capsys.disabled():
        print(f"\nheld-out pages judged rightly: {right} of {len(HELD_OUT)}; wrong: {[i for i, (g, (s, _)) in enumerate(zip(got, HELD_OUT, strict=True)) if g != s]}")
    assert right >= 0.85 * len(HELD_OUT)


def test_viterbi_equals_brute_force():
    import itertools

    import numpy as np

    rng = np.random.default_rng(0)
    model = stuffing.Model(rng.normal(size=4), rng.normal(size=(4, 4)), [])
    score = rng.normal(size=(5, 4, 4))
    got = stuffing.decode(model, score)
    for p in range(5):
        value = lambda s: model.start[s[0]] + sum(score[p, i, s[i]] for i in range(4)) + sum(model.step[a, b] for a, b in itertools.pairwise(s))
        assert value(tuple(got[p])) == pytest.approx(max(map(value, itertools.product(range(4), repeat=4))))


def test_held_out_lines():
    """Every fifth labelled page is left out of the fit; most of its words must get their label."""
    from millrace.llm.labelled_pages import LINE_PAGES

    right = total = 0
    for k in range(5):
        model = stuffing.fit([p for i, p in enumerate(LINE_PAGES) if i % 5 != k])
        for page in [p for i, p in enumerate(LINE_PAGES) if i % 5 == k]:
            text = "\n".join(t for _, t in page)
            shares = stuffing.word_shares(model, [text])[0]
            want = sum(len(t.split()) for s, t in page if s == "prose")
            total += len(text.split())
            right += len(text.split()) - abs(int(shares[0]) - want)
    assert right / total > 0.88
