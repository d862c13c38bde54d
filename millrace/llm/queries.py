"""The pN queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.tokens import token_count
from millrace.llm import budget, capping, grouped_split, leaks, markup, mixing, packing, sampling, stuffing
from millrace.runtime import lookup, materialize, scratch_dir, table

#: Share of all documents, in thousandths, that one author may keep in p2_source_author_caps.
AUTHOR_PERMILLE = 2


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = markup.clean_markup(table(spark, sf, "corpus_document").select("id", "text"))
    # explode_outer: explode would add a filter on the array's size, for which the conversion would run twice
    return cleaned.filter("id is not null").select("id", F.explode_outer("kinds").alias("kind")).filter("kind is not null").distinct()


def p1_clean_text(spark: SparkSession, sf: str) -> DataFrame:
    return markup.clean_markup(table(spark, sf, "corpus_document").select("ord", "id", "text")).select("ord", "id", "clean_text")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    decided = capping.cap_documents(table(spark, sf, "corpus_document"), table(spark, sf, "source_config"))
    return decided.filter(~F.col("kept")).select("id")


def p2_source_author_caps(spark: SparkSession, sf: str) -> DataFrame:
    decided = capping.cap_documents(table(spark, sf, "corpus_document"), table(spark, sf, "source_config"), author_permille=AUTHOR_PERMILLE)
    return decided.filter(~F.col("kept")).select("id", "source")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    counted = budget.document_tokens(table(spark, sf, "corpus_document"), ("token_count",))
    return counted.filter("token_count is null or token_count <> tokens").select("ord")


def p3_token_budget(spark: SparkSession, sf: str) -> DataFrame:
    return budget.token_budget(table(spark, sf, "corpus_document"))


def p3_bpe_budget(spark: SparkSession, sf: str) -> DataFrame:
    return budget.token_budget(table(spark, sf, "corpus_document"), "byte_bpe_50k")


def _packed(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "corpus_document").filter("id is not null and run_id is not null")
    sizes = rows.select("run_id", "id", token_count(F.col("text")).alias("tokens")).groupBy("run_id", "id").agg(F.max("tokens").alias("tokens"))
    runs = table(spark, sf, "packing_statistics").select("run_id", F.col("sequence_length").cast("long").alias("capacity"))
    return packing.pack(lookup(sizes, runs, ["run_id"]))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that the packing has laid into more than one sequence."""
    spread = _packed(spark, sf).groupBy("run_id", "id").agg((F.min("bin") < F.max("bin")).alias("divided"))
    return spread.filter("divided").select("run_id", "id")


def p4_packing_report(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packing_report(_packed(spark, sf))


def p4_packing_checks(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packing_checks(_packed(spark, sf))


def _nodes(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    sources = table(spark, sf, "source_config")
    return materialize(grouped_split.document_nodes(table(spark, sf, "corpus_document"), sources), "nodes"), sources


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    nodes, sources = _nodes(spark, sf)
    grouped = grouped_split.ComponentTable().update(nodes, sources, with_splits=False)
    return grouped_split.cross_source_groups(grouped)


def p5_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Two deliveries: first the documents ingested without delay, then all; in between the table is saved and loaded."""
    rows, sources = table(spark, sf, "corpus_document"), table(spark, sf, "source_config")
    prompt = rows.filter("ingested_at <= fetched_at + interval 1 day")
    where = f"{scratch_dir(spark)}/component-table-{uuid.uuid4().hex}"
    components = grouped_split.ComponentTable.load(spark, where)
    components.update(materialize(grouped_split.document_nodes(prompt, sources), "nodes"), sources)
    components.save(where)
    components = grouped_split.ComponentTable.load(spark, where)
    nodes = materialize(grouped_split.document_nodes(rows, sources), "nodes")
    return components.update(nodes, sources).select("id", "component", "split")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Targets that their category, drawn out completely, does not meet."""
    return p6_report(spark, sf).filter(~F.col("met")).select("target_set", "category")


def p6_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.draw(*sampling.sample_plan(table(spark, sf, "corpus_document"), table(spark, sf, "category_target")))


def p6_report(spark: SparkSession, sf: str) -> DataFrame:
    docs, stored, plan = sampling.sample_plan(table(spark, sf, "corpus_document"), table(spark, sf, "category_target"))
    return sampling.sample_report(sampling.draw(docs, stored, plan), plan)


def _index(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    passages = materialize(leaks.test_terms(table(spark, sf, "benchmark_sample"), ["scenario", "question"]), "passages")
    return leaks.build_index(table(spark, sf, "documents"), passages), passages


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(*_index(spark, sf)).select("doc_id", "item_id").distinct()


def p7_proximity(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.proximity(*_index(spark, sf))


def p7_full_index(spark: SparkSession, sf: str) -> DataFrame:
    """Phrases and passages in other order, both searched in one index of all words of all pages."""
    passages = materialize(leaks.test_terms(table(spark, sf, "benchmark_sample"), ["scenario", "question"]), "passages")
    index = leaks.build_index(table(spark, sf, "documents"))
    phrases = leaks.leaks(index, passages).groupBy("doc_id", "item_id", "field").agg(F.max("words").alias("words"))
    near = leaks.proximity(index, passages)
    return phrases.select(F.lit("phrase").alias("kind"), "*").unionByName(near.select(F.lit("proximity").alias("kind"), "*"))


def _mixture(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    pages = mixing.sized_pages(table(spark, sf, "documents"))
    plan = materialize(mixing.mixture_plan(pages, table(spark, sf, "mixture_weight")), "mixtures")
    return mixing.mix(pages, plan), plan


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture_report(*_mixture(spark, sf)).filter("short").select("mixture_id", "source_key")


def p8_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return _mixture(spark, sf)[0]


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mixture_report(*_mixture(spark, sf))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return stuffing.label_pages(table(spark, sf, "documents").select("doc_id", "text")).filter("spam").select("doc_id")


def p9_line_labels(spark: SparkSession, sf: str) -> DataFrame:
    return stuffing.label_lines(table(spark, sf, "documents").select("doc_id", "text"))


def p9_page_shares(spark: SparkSession, sf: str) -> DataFrame:
    return stuffing.label_pages(table(spark, sf, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: f for k, f in list(globals().items()) if k[0] == "p" and k[1:2].isdigit()}

_WORDS = r"len(regexp_extract_all(text, '[^ \t\n\r]+'))"
_TOKENS = f"CASE WHEN {_WORDS} = 0 THEN 0 ELSE greatest(1, floor(1.3::DOUBLE * {_WORDS})) END::BIGINT"
_SQUEEZE = r"nullif(lower(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', '', 'g')), '')"
_NOBODY = ", ".join(f"'{x}'" for x in ("na", "none", "null", "unknown", "anonymous", "nobody", "nan", "tbd", "undefined", "unspecified", "notavailable", "noauthor", "noname"))
_CURRENT = "current_row AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC) AS rn FROM corpus_document WHERE id IS NOT NULL) WHERE rn = 1)"
_CLEAN = r"nullif(trim(lower(regexp_replace({}, '[^\p{{L}}\p{{N}}]+', '_', 'g')), '_'), '')"
_INVISIBLE = r"[\x{ad}\x{34f}\x{61c}\x{180e}\x{200b}-\x{200f}\x{202a}-\x{202e}\x{2060}-\x{2064}\x{2066}-\x{206f}\x{fe00}-\x{fe0f}\x{feff}]"
_LANGUAGE = (
    "CASE WHEN h IN ('eng') THEN 'en' WHEN h IN ('deu', 'ger') THEN 'de' WHEN h = 'spa' THEN 'es' WHEN h IN ('fra', 'fre') THEN 'fr' WHEN coalesce(h, '') = '' THEN 'und' ELSE h END"
)


def _runs(column: str) -> str:
    plain = f"lower(regexp_replace({column}, '{_INVISIBLE}', '', 'g'))"
    return rf"list_filter(string_split_regex({plain}, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '')"


def _hash(digits: int, *parts: str) -> str:
    return f"('0x' || substr(sha256({' || chr(58) || '.join(parts)}), 1, {digits}))::BIGINT"


_DRAWN = f"""{_CURRENT}, names AS (SELECT DISTINCT {_SQUEEZE.format('category')} AS k, category FROM category_target),
        d AS (SELECT id, category, {_TOKENS} AS t, {_hash(15, "'42'", 'id')} AS h FROM (SELECT {_SQUEEZE.format('primary_category')} AS k, id, text FROM current_row) JOIN names USING (k)),
        supply AS (SELECT category, count(*) AS n, sum(t) AS t FROM d GROUP BY category), total AS (SELECT coalesce(sum(t), 0)::DOUBLE AS total FROM d),
        quota AS (SELECT target_set, c.category, coalesce(target_share, 0) AS target_share, coalesce(target_share, 0) * coalesce(sample_fraction, 0) * total AS wanted, coalesce(min_documents, 0) AS least,
            coalesce(s.t, 0) AS supply_t, coalesce(s.n, 0) AS supply_n FROM category_target c LEFT JOIN supply s ON c.category = s.category, total),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY h, id) AS nd, sum(t) OVER (PARTITION BY category ORDER BY h, id ROWS UNBOUNDED PRECEDING) AS nt FROM d),
        drawn AS (SELECT target_set, r.category, id, t FROM ranked r JOIN quota q ON r.category = q.category WHERE nt <= least(wanted, supply_t) OR nd <= least)"""
_POSTINGS = f"""item AS (SELECT item_id, 'scenario' AS field, {_runs('scenario')} AS w FROM benchmark_sample UNION ALL SELECT item_id, 'question', {_runs('question')} FROM benchmark_sample),
        pos AS (SELECT item_id, field, unnest(w) AS term, unnest(range(len(w))) AS place FROM item),
        post AS (SELECT doc_id, unnest(w) AS term, unnest(range(len(w))) AS place FROM (SELECT doc_id, {_runs('text')} AS w FROM documents))"""
_NEAR = """goal AS (SELECT item_id, field, ceil(round(count(DISTINCT term) * 0.9::DOUBLE, 6)) AS need, greatest(80, 2 * count(*)) AS wide FROM pos GROUP BY ALL),
        pair AS (SELECT doc_id, item_id, field FROM (SELECT DISTINCT doc_id, term FROM post) JOIN (SELECT DISTINCT item_id, field, term FROM pos) USING (term) JOIN goal USING (item_id, field) GROUP BY ALL HAVING count(*) >= max(need)),
        hit AS (SELECT p.doc_id, p.item_id, p.field, post.place, post.term, need, wide FROM pair p JOIN (SELECT DISTINCT item_id, field, term FROM pos) t ON p.item_id = t.item_id AND p.field = t.field
            JOIN post ON post.doc_id = p.doc_id AND post.term = t.term JOIN goal g ON g.item_id = p.item_id AND g.field = p.field),
        stretch AS (SELECT b.doc_id, b.item_id, b.field, b.place, count(DISTINCT a.term) AS n FROM hit b JOIN hit a ON a.doc_id = b.doc_id AND a.item_id = b.item_id AND a.field = b.field
            AND a.place BETWEEN b.place - b.wide + 1 AND b.place GROUP BY b.doc_id, b.item_id, b.field, b.place, b.need HAVING count(DISTINCT a.term) >= b.need),
        near AS (SELECT doc_id, item_id, field, max(n) AS words FROM stretch GROUP BY ALL)"""
_MIXED = f"""d AS (SELECT doc_id, {_SQUEEZE.format('source')} AS k, {_TOKENS.replace('text', "coalesce(text, chr(32))")} AS tokens FROM documents), supply AS (SELECT k, sum(tokens) AS supply FROM d WHERE k IS NOT NULL GROUP BY k),
        total AS (SELECT coalesce(sum(tokens), 0)::DOUBLE AS total FROM d),
        want AS (SELECT mixture_id, source_key, {_SQUEEZE.format('source_key')} AS k, target_weight, coalesce(max_repeats, 0) AS most, coalesce(supply, 0)::BIGINT AS supply, coalesce(target_weight, 0) * coalesce(budget_fraction, 0) * total AS wanted,
            CASE WHEN coalesce(supply, 0) > 0 THEN least(coalesce(target_weight, 0) * coalesce(budget_fraction, 0) * total / supply, coalesce(max_repeats, 0)::DOUBLE) ELSE 0 END AS c
            FROM mixture_weight LEFT JOIN supply ON {_SQUEEZE.format('source_key')} = supply.k, total),
        placed AS (SELECT doc_id, k, tokens, row_number() OVER (PARTITION BY k ORDER BY tokens, {_hash(15, "'42'", 'doc_id')}, doc_id) AS place FROM d WHERE k IS NOT NULL),
        mixed AS (SELECT mixture_id, source_key, doc_id, tokens, (floor(c * place + o) - floor(c * (place - 1) + o))::BIGINT AS copies
            FROM (SELECT *, {_hash(5, "'42'", 'mixture_id', 'k')} / 1048576::DOUBLE AS o FROM want) w JOIN placed USING (k))"""

def _current_nodes(rows: str) -> str:
    return f"(SELECT id, s, a, coalesce(s, a, 'd:' || id) AS anchor FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC) AS rn FROM {rows}) WHERE rn = 1)"


def _dealt(rows: str, size: str, extra: str = "true") -> str:
    return f"(SELECT c, {size} > 0 AND sum(n) OVER (ORDER BY sha256(c), c) - n / 2.0::DOUBLE < {size} AS here FROM {rows} WHERE n <= greatest(1.0::DOUBLE, {size}) AND {extra})"


_SPLITS = f"""WITH RECURSIVE raw AS (SELECT id, ord, {_SQUEEZE.format('source_id')} AS s0, {_SQUEEZE.format("metadata['author']")} AS a0, ingested_at <= fetched_at + INTERVAL 1 DAY AS prompt FROM corpus_document WHERE id IS NOT NULL),
        node AS (SELECT id, ord, prompt, CASE WHEN s0 NOT IN ({_NOBODY}) THEN 's:' || s0 END AS s, CASE WHEN a0 NOT IN ({_NOBODY}) THEN 'a:' || a0 END AS a FROM raw), early AS (SELECT * FROM node WHERE prompt),
        d1 AS {_current_nodes('early')}, d2 AS {_current_nodes('node')},
        own AS (SELECT DISTINCT 's:' || {_SQUEEZE.format('id')} AS u, 'o:' || o AS v FROM (SELECT id, {_SQUEEZE.format('repository_owner')} AS o FROM source_config) WHERE o NOT IN ({_NOBODY})),
        l1 AS (SELECT anchor AS u, coalesce(a, anchor) AS v FROM d1 UNION SELECT u, v FROM own WHERE u IN (SELECT s FROM d1)), l2 AS (SELECT anchor AS u, coalesce(a, anchor) AS v FROM d2 UNION SELECT u, v FROM own WHERE u IN (SELECT s FROM d2)),
        e1 AS (SELECT u, v FROM l1 UNION SELECT v, u FROM l1), e2 AS (SELECT u, v FROM e1 UNION SELECT u, v FROM l2 UNION SELECT v, u FROM l2),
        r1 AS (SELECT u AS root, u AS n FROM e1 UNION SELECT root, v FROM r1 JOIN e1 ON n = u), r2 AS (SELECT u AS root, u AS n FROM e2 UNION SELECT root, v FROM r2 JOIN e2 ON n = u),
        c1 AS (SELECT n AS node, min(root) AS c FROM r1 GROUP BY n), c2 AS (SELECT n AS node, min(root) AS c FROM r2 GROUP BY n),
        z1 AS (SELECT c, count(*) AS n FROM d1 JOIN c1 ON anchor = c1.node GROUP BY c), y1 AS (SELECT c, n, (SELECT 0.05::DOUBLE * sum(n) FROM z1) AS v FROM z1),
        h1 AS {_dealt('y1', 'v')}, g1 AS {_dealt('y1', 'v', 'c NOT IN (SELECT c FROM h1 WHERE here)')},
        s1 AS (SELECT c, CASE WHEN c IN (SELECT c FROM h1 WHERE here) THEN 'heldout' WHEN c IN (SELECT c FROM g1 WHERE here) THEN 'validation' ELSE 'train' END AS split FROM z1),
        had AS (SELECT c2.c, min(s1.split) AS lo, max(s1.split) AS hi FROM c1 JOIN s1 ON c1.c = s1.c JOIN c2 ON c1.node = c2.node GROUP BY c2.c),
        z2 AS (SELECT c, count(*) AS n FROM d2 JOIN c2 ON anchor = c2.node GROUP BY c),
        j AS (SELECT z2.c, n, CASE WHEN lo = hi THEN lo WHEN lo IS NOT NULL THEN 'quarantine' END AS split FROM z2 LEFT JOIN had ON z2.c = had.c),
        lack AS (SELECT greatest(0.0::DOUBLE, 0.05::DOUBLE * total - h) AS dh, greatest(0.0::DOUBLE, 0.05::DOUBLE * total - v) AS dv FROM (SELECT sum(n) FILTER (split IS DISTINCT FROM 'quarantine') AS total,
            coalesce(sum(n) FILTER (split = 'heldout'), 0) AS h, coalesce(sum(n) FILTER (split = 'validation'), 0) AS v FROM j)),
        y2 AS (SELECT c, n, greatest(dh, dv) AS va, least(dh, dv) AS vb, CASE WHEN dv > dh THEN 'validation' ELSE 'heldout' END AS ka, CASE WHEN dv > dh THEN 'heldout' ELSE 'validation' END AS kb FROM j, lack WHERE split IS NULL),
        h2 AS {_dealt('y2', 'va')}, g2 AS {_dealt('y2', 'vb', 'c NOT IN (SELECT c FROM h2 WHERE here)')},
        s2 AS (SELECT c, split FROM j WHERE split IS NOT NULL UNION ALL SELECT c, CASE WHEN c IN (SELECT c FROM h2 WHERE here) THEN ka WHEN c IN (SELECT c FROM g2 WHERE here) THEN kb ELSE 'train' END FROM y2)
        SELECT id, c2.c AS component, split FROM d2 JOIN c2 ON anchor = c2.node JOIN s2 ON c2.c = s2.c"""
_TWO_CAPS = f"""WITH RECURSIVE {_CURRENT}, total AS (SELECT count(*) AS n FROM current_row), caps AS (SELECT {_SQUEEZE.format('id')} AS k, min(document_cap_permille * n // 1000) AS cap FROM source_config, total WHERE document_cap_permille IS NOT NULL GROUP BY 1),
        d AS (SELECT id, quality_score, {_SQUEEZE.format('source_id')} AS s, {_SQUEEZE.format("metadata['author']")} AS a FROM current_row),
        o AS (SELECT row_number() OVER (ORDER BY CASE WHEN quality_score BETWEEN 0 AND 1 THEN -quality_score ELSE 2 END, d.id) AS r, d.id, s AS source, coalesce(s, '') AS s, cap AS sc, CASE WHEN a NOT IN ({_NOBODY}) THEN 'author:' || a ELSE 'author:' END AS a,
            CASE WHEN a NOT IN ({_NOBODY}) THEN {AUTHOR_PERMILLE} * n // 1000 END AS ac FROM d LEFT JOIN caps ON s = k, total),
        step AS (SELECT 0::BIGINT AS r, MAP {{'': 0::BIGINT}} AS used, true AS kept UNION ALL
            SELECT r, CASE WHEN k THEN map_concat(used, MAP {{s: coalesce(used[s], 0) + 1, a: coalesce(used[a], 0) + 1}}) ELSE used END, k FROM (SELECT o.r, used, s, a,
            (sc IS NULL OR coalesce(used[s], 0) < sc) AND (ac IS NULL OR coalesce(used[a], 0) < ac) AS k FROM step JOIN o ON o.r = step.r + 1))
        SELECT id, source FROM step JOIN o ON o.r = step.r WHERE NOT kept"""

SQL: dict[str, str] = {
    "p2_found": f"""
        WITH {_CURRENT}, n AS (SELECT count(*) AS n FROM current_row),
        caps AS (SELECT {_SQUEEZE.format('id')} AS k, document_cap_permille * n // 1000 AS cap FROM source_config, n WHERE document_cap_permille IS NOT NULL),
        ranked AS (SELECT c.id, cap, row_number() OVER (PARTITION BY k ORDER BY
            CASE WHEN quality_score BETWEEN 0 AND 1 THEN -quality_score ELSE 2 END, c.id) AS r
            FROM current_row c JOIN caps ON {_SQUEEZE.format('c.source_id')} = k)
        SELECT id FROM ranked WHERE r > cap""",
    "p3_found": f"SELECT ord FROM corpus_document WHERE token_count IS NULL OR token_count <> {_TOKENS.replace('text', 'coalesce(text, chr(32))')}",
    "p3_token_budget": f"""
        WITH f AS (SELECT coalesce({_CLEAN.format('source_id')}, '(none)') AS source, {_LANGUAGE} AS language,
            coalesce({_CLEAN.format('category')}, '(none)') AS category, t AS tokens
            FROM (SELECT *, regexp_extract(lower(trim(language)), '^([a-z]{{2,3}})(?:[^a-z].*)?$', 1) AS h, {_TOKENS} AS t FROM corpus_document))
        SELECT 'source' AS slice, source AS key, count(*) AS rows, sum(tokens)::BIGINT AS tokens FROM f GROUP BY source
        UNION ALL SELECT 'language', language, count(*), sum(tokens)::BIGINT FROM f GROUP BY language
        UNION ALL SELECT 'category', category, count(*), sum(tokens)::BIGINT FROM f GROUP BY category
        UNION ALL SELECT 'total', '(all)', count(*), coalesce(sum(tokens), 0)::BIGINT FROM f""",
    "p4_found": f"""
        SELECT DISTINCT d.run_id, d.id FROM (SELECT run_id, id, {_TOKENS} AS t FROM corpus_document) d
        JOIN packing_statistics p ON d.run_id = p.run_id WHERE t > sequence_length""",
    "p5_found": f"""
        WITH RECURSIVE {_CURRENT},
        doc AS (SELECT id, {_SQUEEZE.format('source_id')} AS s0, {_CLEAN.format('source_id')} AS spelled, {_SQUEEZE.format("metadata['author']")} AS a0 FROM current_row),
        d AS (SELECT id, CASE WHEN s0 NOT IN ({_NOBODY}) THEN 's:' || s0 END AS s, CASE WHEN a0 NOT IN ({_NOBODY}) THEN 'a:' || a0 END AS a, spelled FROM doc),
        own AS (SELECT 's:' || {_SQUEEZE.format('id')} AS s, {_SQUEEZE.format('repository_owner')} AS o, {_CLEAN.format('id')} AS clean FROM source_config),
        e AS (SELECT DISTINCT s AS u, a AS v FROM d WHERE s IS NOT NULL AND a IS NOT NULL
            UNION SELECT s, 'o:' || o FROM own WHERE o NOT IN ({_NOBODY}) AND s IN (SELECT s FROM d)),
        both_ways AS (SELECT u, v FROM e UNION SELECT v, u FROM e),
        names AS (SELECT d.s, min(coalesce(clean, spelled)) AS name FROM d LEFT JOIN own ON d.s = own.s WHERE d.s IS NOT NULL GROUP BY d.s),
        reach AS (SELECT s AS root, s AS node FROM names UNION SELECT root, v FROM reach JOIN both_ways ON node = u),
        found AS (SELECT node, min(name) AS group_id, count(*) AS n FROM reach JOIN names ON root = names.s GROUP BY node)
        SELECT d.id, group_id FROM d JOIN found ON node = coalesce(d.s, d.a) WHERE n >= 2""",
    "p6_found": f"""
        WITH {_CURRENT}, names AS (SELECT DISTINCT {_SQUEEZE.format('category')} AS k, category FROM category_target),
        d AS (SELECT category, {_TOKENS} AS t FROM (SELECT {_SQUEEZE.format('primary_category')} AS k, text FROM current_row) JOIN names USING (k)),
        supply AS (SELECT category, count(*) AS n, sum(t) AS t FROM d GROUP BY category), total AS (SELECT coalesce(sum(t), 0) AS total FROM d)
        SELECT target_set, c.category FROM category_target c LEFT JOIN supply s ON c.category = s.category, total
        WHERE coalesce(t, 0) < target_share * sample_fraction * total OR coalesce(n, 0) < min_documents""",
    "p7_found": f"""
        WITH item AS (SELECT item_id, {_runs('scenario')} AS w FROM benchmark_sample UNION ALL SELECT item_id, {_runs('question')} FROM benchmark_sample),
        gram AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS g FROM item),
        page AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 10), lambda i: array_to_string(w[i:i + 11], ' '))) AS g
            FROM (SELECT doc_id, {_runs('text')} AS w FROM documents))
        SELECT DISTINCT doc_id, item_id FROM page JOIN gram USING (g)""",
    "p8_found": f"""
        WITH d AS (SELECT {_SQUEEZE.format('source')} AS k, {_TOKENS} AS t FROM documents), s AS (SELECT k, sum(t) AS t FROM d GROUP BY k),
        total AS (SELECT sum(t) AS total FROM d)
        SELECT mixture_id, source_key FROM mixture_weight m LEFT JOIN s ON {_SQUEEZE.format('m.source_key')} = s.k, total
        WHERE coalesce(t, 0) * max_repeats < target_weight * budget_fraction * total""",
    "p4_packing_checks": f"""
        WITH d AS (SELECT run_id, id, max({_TOKENS.replace('text', "coalesce(text, chr(32))")}) AS t FROM corpus_document WHERE run_id IS NOT NULL AND id IS NOT NULL GROUP BY ALL)
        SELECT d.run_id, count(*) AS documents, sum(t)::BIGINT AS tokens, count(*) FILTER (t > sequence_length) AS divided_documents, 0::BIGINT AS overfull_sequences,
        0::BIGINT AS divided_below_capacity, 0::BIGINT AS wrong_pieces, true AS tight FROM d JOIN packing_statistics p ON d.run_id = p.run_id WHERE sequence_length > 0 GROUP BY d.run_id""",
    "p6_sample": f"WITH {_DRAWN} SELECT target_set, category, id, t AS tokens FROM drawn",
    "p6_report": f"""
        WITH {_DRAWN}, g AS (SELECT target_set, category, count(*) AS n, sum(t) AS t FROM drawn GROUP BY ALL)
        SELECT q.target_set, q.category, q.target_share, coalesce(round(coalesce(g.t, 0)::DOUBLE / nullif(sum(coalesce(g.t, 0)) OVER (PARTITION BY q.target_set), 0), 6), 0) AS actual_share,
        coalesce(g.n, 0) AS documents, coalesce(g.t, 0)::BIGINT AS tokens, q.supply_t >= q.wanted AND q.supply_n >= q.least AS met FROM quota q LEFT JOIN g ON q.target_set = g.target_set AND q.category = g.category""",
    "p7_proximity": f"WITH {_POSTINGS}, {_NEAR} SELECT doc_id, item_id, field, words FROM near",
    "p7_full_index": f"""
        WITH {_POSTINGS}, {_NEAR}, al AS (SELECT doc_id, item_id, field, p.place - t.place AS start, t.place AS word FROM post p JOIN pos t ON p.term = t.term),
        much AS (SELECT doc_id, item_id, field, start FROM al GROUP BY ALL HAVING count(*) >= 12),
        isle AS (SELECT al.*, word - row_number() OVER (PARTITION BY al.doc_id, al.item_id, al.field, al.start ORDER BY word) AS run FROM al JOIN much USING (doc_id, item_id, field, start)),
        runs AS (SELECT doc_id, item_id, field, count(*) AS n FROM isle GROUP BY doc_id, item_id, field, start, run)
        SELECT 'phrase' AS kind, doc_id, item_id, field, max(n) AS words FROM runs WHERE n >= 12 GROUP BY ALL UNION ALL SELECT 'proximity', doc_id, item_id, field, words FROM near""",
    "p8_mixture": f"WITH {_MIXED} SELECT mixture_id, source_key, doc_id, tokens, copies FROM mixed WHERE copies > 0",
    "p8_shares": f"""
        WITH {_MIXED}, g AS (SELECT mixture_id, source_key, count(*) AS pages, sum(tokens * copies)::BIGINT AS t FROM mixed WHERE copies > 0 GROUP BY ALL)
        SELECT w.mixture_id, w.source_key, target_weight, coalesce(round(coalesce(t, 0)::DOUBLE / nullif(sum(coalesce(t, 0)) OVER (PARTITION BY w.mixture_id), 0), 6), 0) AS actual_share, coalesce(pages, 0) AS pages,
        coalesce(t, 0)::BIGINT AS tokens, wanted, supply * most < wanted AS short FROM want w LEFT JOIN g ON w.mixture_id = g.mixture_id AND w.source_key = g.source_key""",
    "p5_splits": _SPLITS,
    "p2_source_author_caps": _TWO_CAPS,
}
