"""SQL of the named queries, for an independent engine on the same tables.

Words, phrases and patterns come from the same fixed values; everything else is written anew.
"""

from __future__ import annotations

import re

from millrace.functions import vocabulary as V
from millrace.functions.hashing import coefficients
from millrace.operators.evaluation import DIMENSIONS

W = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BREAK = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
WORD = r"\p{L}\p{N}_"
CURRENT = "docs AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ord DESC) AS rn FROM corpus_document) WHERE rn = 1)"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def arr(items) -> str:
    return "[" + ", ".join(q(x) for x in items) + "]"


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^[{W}]+|[{W}]+$', '', 'g')"


def words(c: str) -> str:
    return f"regexp_extract_all({c}, '[^{W}]+')"


def count(c: str, pattern: str) -> str:
    return f"len(regexp_extract_all({c}, {q(pattern)}))"


def tokens(c: str) -> str:
    return f"(CASE WHEN len({words(c)}) > 0 THEN greatest(1, floor(len({words(c)}) * 1.3::DOUBLE)) ELSE 0 END)::BIGINT"


def lines(c: str) -> str:
    return f"list_filter(list_transform(regexp_split_to_array({c}, '\\r\\n|[{BREAK}]'), lambda x: {strip('x')}), lambda x: x <> '')"


def hexnum(c: str, start: int, digits: int) -> str:
    return f"('0x' || substr(sha256({c}), {start}, {digits}))::UBIGINT"


def score64(c: str) -> str:
    return f"({hexnum(c, 1, 16)}::DOUBLE / 18446744073709551616::DOUBLE)"


def three_way(c: str) -> str:
    s = score64(f"'42:' || {c}")
    return f"CASE WHEN {s} < 0.9::DOUBLE THEN 'train' WHEN {s} < 0.9::DOUBLE + 0.05::DOUBLE THEN 'validation' ELSE 'heldout' END"


def squeeze(c: str) -> str:
    return strip(f"regexp_replace({c}, '[{W}]+', ' ', 'g')")


HEADING = f"(?:#{{1,6}}[{W}]+|={{1,6}}[{W}]+)"
CODE = rf"(?s)```.*?```|\[source[^\]]*\][{W}]*----.*?----"
TOK_DOCS = f"WITH {CURRENT}, d AS (SELECT *, {tokens('text')} AS tokens, coalesce(metadata['repository_owner'], source_id) AS organization FROM docs)"


def code_chars(c: str) -> str:
    return f"list_sum(list_transform(regexp_extract_all({c}, {q(CODE)}), lambda x: length(x)))"


QUALITY = f"""
    q0 AS (SELECT *, list_filter(regexp_extract_all(lower(text), '[{WORD}]+'), lambda w: regexp_matches(w, '^[a-z]+$')) AS ws,
        coalesce({code_chars('text')}, 0)::DOUBLE / greatest(1, length(text)) AS code,
        {count('text', rf'[\p{{L}}{W}]')}::DOUBLE / greatest(1, length(text)) AS prose,
        least(1.0::DOUBLE, {count('text', f'(?m)^{HEADING}')}::DOUBLE / 3.0::DOUBLE) AS heading FROM {{base}}),
    q1 AS (SELECT *, len(ws) AS n,
        least(1.0::DOUBLE, len(list_filter(ws, lambda w: list_contains({arr(V.TECH_WORDS)}, w)))::DOUBLE / len(ws) * 15.0::DOUBLE) AS tech,
        least(1.0::DOUBLE, len(list_filter(ws, lambda w: list_contains({arr(V.TRADEOFF_WORDS)}, w)))::DOUBLE / len(ws) * 30.0::DOUBLE) AS trade,
        1.0::DOUBLE - least(1.0::DOUBLE, code * 1.2::DOUBLE) AS balance FROM q0),
    q2 AS (SELECT *, CASE WHEN n = 0 THEN 0.0::DOUBLE ELSE round(least(1.0::DOUBLE, greatest(0.0::DOUBLE,
        tech * 0.25::DOUBLE + trade * 0.25::DOUBLE + prose * 0.2::DOUBLE + heading * 0.15::DOUBLE + balance * 0.15::DOUBLE)), 4) END AS q_score FROM q1),
    q3 AS (SELECT *, CASE WHEN n = 0 THEN 'low' WHEN q_score >= 0.7::DOUBLE THEN 'high' WHEN q_score >= 0.45::DOUBLE THEN 'medium' ELSE 'low' END AS bucket,
        list_filter([CASE WHEN tech >= 0.5 THEN 'high technical vocabulary density' END, CASE WHEN trade >= 0.3::DOUBLE THEN 'contains architecture trade-off language' END,
        CASE WHEN prose >= 0.8::DOUBLE THEN 'substantial technical prose' END, CASE WHEN heading >= 0.3::DOUBLE THEN 'structured heading organization' END,
        CASE WHEN code > 0.6::DOUBLE THEN 'high code block ratio' END], lambda x: x IS NOT NULL) AS told FROM q2)"""

FLAGS = f"list_transform(regexp_extract_all(lower(text), '[{WORD}-]+'), lambda x: array_to_string(list_transform(list_filter(string_split(x, '-'), lambda w: w <> ''), lambda w: CASE WHEN regexp_matches(w, '^[a-z]+$') THEN 'p' ELSE 'x' END), ''))"


def occurrences(c: str, phrases) -> str:
    return "(" + " + ".join(f"(length({c}) - length(replace({c}, {q(p)}, ''))) // {len(p)}" for p in phrases) + ")"


RELEVANCE = f"""
    r0 AS (SELECT *, {lines('text')} AS ls, lower(text) AS low,
        greatest(1, coalesce(list_sum(list_transform({FLAGS}, lambda f: len(regexp_extract_all(f, 'p+')))), 0)) AS wn FROM {{base}}),
    r1 AS (SELECT *, len(ls) AS rows_, {occurrences('low', V.REASONING_SIGNALS)} AS hits, {count('text', f'[.!?](?:[{W}]|$)')} AS ends,
        len(list_filter(ls, lambda x: regexp_matches(x, '^(?:#{{1,6}}[{W}]|={{1,6}}[{W}])'))) AS heads,
        {' + '.join(f"regexp_matches(text, '(?im)^{x}[{W}]*$')::INT" for x in V.RECORD_LABELS)} AS labels,
        {count('text', r'https?://|[[][^]]+[]][(][^)]*[)]')} AS links, len(list_filter(ls, lambda x: x LIKE '```%')) AS codes FROM r0),
    r2 AS (SELECT *, least(1.0::DOUBLE, hits::DOUBLE / greatest(2.0::DOUBLE, wn::DOUBLE / 85.0::DOUBLE)) AS signal,
        least(1.0::DOUBLE, ends::DOUBLE / greatest(1.0::DOUBLE, rows_ * 0.35::DOUBLE)) AS r_prose, least(1.0::DOUBLE, heads::DOUBLE / 3.0::DOUBLE) AS structure,
        least(1.0::DOUBLE, labels::DOUBLE / 3.0::DOUBLE) AS record, links::DOUBLE / greatest(1, rows_) AS link_ratio_, least(1.0::DOUBLE, codes::DOUBLE / greatest(1, rows_)) AS code_pen FROM r1),
    r3 AS (SELECT *, round(greatest(0.0::DOUBLE, least(1.0::DOUBLE, 0.38::DOUBLE * signal + 0.25::DOUBLE * r_prose + 0.18::DOUBLE * structure + 0.19::DOUBLE * record
        - (0.25::DOUBLE * least(1.0::DOUBLE, link_ratio_ / 0.22::DOUBLE) + 0.2::DOUBLE * code_pen))), 4) AS r_score FROM r2)"""

DOMAIN = f"""CASE WHEN regexp_matches(lower(coalesce(relative_path, id)), {q('|'.join(V.METADATA_PATHS))}) OR regexp_matches(lower(coalesce(title, '')), {q('|'.join(V.METADATA_TITLES))}) THEN 'project_metadata'
    WHEN len({lines('text')}) > 10 AND len(list_filter({lines('text')}, lambda x: starts_with(x, '- [') OR starts_with(x, '* [') OR starts_with(x, '1. [')))::DOUBLE / len({lines('text')}) > 0.85::DOUBLE THEN 'generated_index'
    WHEN (starts_with(lower(coalesce(title, '')), 'installation') OR contains(lower(coalesce(title, '')), 'how to install')) AND len({words('text')}) < 200
        AND (contains(text, 'apt-get') OR contains(text, 'brew install') OR contains(text, 'docker run')) THEN 'installation_only' END"""


def gate(chars: int, least: int, symbols: float) -> str:
    solid = count(strip("text"), f"[^{W}]")
    return f"""list_filter([CASE WHEN length({strip('text')}) < {chars} THEN 'short_chars' END, CASE WHEN len({words('text')}) < {least} THEN 'short_words' END,
        CASE WHEN NOT coalesce(language IN ('en'), false) THEN 'language' END, CASE WHEN {strip("coalesce(source_id, '')")} = '' THEN 'provenance' END,
        CASE WHEN {solid} > 0 AND ({solid} - {count(strip('text'), f'[{WORD}]')})::DOUBLE / {solid} > {symbols}::DOUBLE THEN 'symbols' END], lambda x: x IS NOT NULL)"""


def phrase(p: str) -> str:
    parts = [re.escape(w) for w in re.split(r"[-_\s]+", p) if w]
    return "(?:^|[^a-z0-9])" + r"[-_\s]+".join(parts) + "(?:[^a-z0-9]|$)"


def concepts(low: str) -> str:
    items = [f"CASE WHEN {' OR '.join(f'regexp_matches({low}, {q(phrase(f))})' for f in [c, *V.CONCEPT_PHRASES[c]])} THEN {q(c)} END" for c in sorted(V.CONCEPT_PHRASES)]
    return f"list_filter([{', '.join(items)}], lambda x: x IS NOT NULL)"


def classify(found: str, low: str, hint: str) -> tuple[str, str]:
    h = "CASE " + " ".join(f"WHEN {hint} = {q(a)} THEN {q(b)}" for a, b in V.HINT_CATEGORIES.items()) + f" ELSE coalesce({hint}, '') END"
    each = []
    for c in V.CATEGORIES:
        own = f"len(list_intersect({found}, {arr(V.CATEGORY_CONCEPTS[c])})) * 3.0" if c in V.CATEGORY_CONCEPTS else "0.0"
        each.append(f"{{'m': -({own} + contains({low}, {q(c.replace('_', ' '))})::INT + ({h} = {q(c)})::INT * 0.5)::DOUBLE, 'name': {q(c)}}}")
    return f"list_sort([{', '.join(each)}])", "list_sum(list_transform(s, lambda x: -x.m))"


def rubric_sql(low: str, missing: str = "false") -> dict[str, str]:
    hits = lambda terms: "(" + " + ".join(f"contains({low}, {q(t)})::INT" for t in terms) + ")"
    out = {
        "driver_identification": f"round(coalesce(len(list_filter(facts, lambda f: len(list_filter({words('lower(f)')}, lambda w: length(w) > 4 AND contains({low}, w))) > 0)), 0)::DOUBLE / greatest(1, coalesce(len(facts), 0)), 2)"
    }
    for name, terms in V.RUBRIC.items():
        if name in V.RUBRIC_FULL:
            out[name] = f"round(least(1.0::DOUBLE, {hits(terms)}::DOUBLE / {V.RUBRIC_FULL[name]}), 2)"
        elif name == "clarification_awareness":
            out[name] = f"CASE WHEN {hits(terms)} > 0 THEN 0.9::DOUBLE WHEN {missing} THEN 0.4::DOUBLE ELSE 0.7::DOUBLE END"
        else:
            out[name] = f"CASE WHEN {hits(terms)} > 0 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END"
    claims = "(" + " + ".join(f"regexp_matches({low}, {q(p)})::INT" for p in V.ABSOLUTE_CLAIMS) + ")"
    out["unsupported_claim_avoidance"] = f"greatest(0.0::DOUBLE, 1.0::DOUBLE - {claims} * 0.5::DOUBLE)"
    out["reasoning_completeness"] = f"round(least(1.0::DOUBLE, len({words(low)})::DOUBLE / 250.0::DOUBLE), 2)"
    return {**{d: out[d] for d in DIMENSIONS}, "claims": claims, "revisits": hits(V.RUBRIC["revisit_conditions"])}


_R, _R_PLAIN = rubric_sql("low", "facts IS NULL"), rubric_sql("low")
DEALT = """dealt AS (SELECT *, row_number() OVER (PARTITION BY category ORDER BY item_id) - 1 AS place, count(*) OVER (PARTITION BY category) AS n_of FROM benchmark_sample),
    s AS (SELECT doc_id, b.item_id, b.category, b.difficulty, b.scenario, b.question, b.facts, d.text AS response, lower(d.text) AS low FROM documents d JOIN dealt b ON d.category = b.category AND d.doc_id % n_of = place)"""
EVALUATED = f"""{DEALT},
    e0 AS (SELECT doc_id, item_id, category, difficulty, facts IS NULL AS missing_info, {', '.join(f'{v} AS {k}' for k, v in _R.items())} FROM s),
    e AS (SELECT *, round(({' + '.join(DIMENSIONS)}) / {len(DIMENSIONS)}, 4) AS overall FROM e0)"""


def exact_mean(c: str, where: str = "true") -> str:
    return f"((2 * sum(round({c} * 10000)::BIGINT) FILTER ({where}) + count(*) FILTER ({where})) // (2 * count(*) FILTER ({where})))::DOUBLE / 10000"


PLAIN_WORDS = "regexp_extract_all(lower({}), '[a-z0-9]+')"
ECHO = f"""{DEALT}, pr AS (SELECT doc_id, scenario || ' ' || question AS prompt, response || CASE WHEN doc_id % 3 = 0 THEN ' ' || scenario || ' ' || question ELSE '' END AS response,
    round(({' + '.join(_R_PLAIN[d] for d in DIMENSIONS)}) / {len(DIMENSIONS)}, 4) AS score FROM s)"""


def judged(rows: str, name: str) -> str:
    """Repetition and echo of rows(doc_id, prompt, response, score) as a chain of named tables."""
    return f"""{name}_w AS (SELECT doc_id, score, {PLAIN_WORDS.format('response')} AS w, {PLAIN_WORDS.format('prompt')} AS q FROM {rows}),
    {name}_p AS (SELECT doc_id, unnest(w) AS t, unnest(range(len(w))) AS i FROM {name}_w), {name}_q AS (SELECT doc_id, unnest(q) AS t, unnest(range(len(q))) AS j FROM {name}_w),
    {name}_d AS (SELECT p.doc_id, i - j AS d, i - row_number() OVER (PARTITION BY p.doc_id, i - j ORDER BY i) AS isle FROM {name}_p p JOIN {name}_q q ON p.doc_id = q.doc_id AND p.t = q.t),
    {name}_m AS (SELECT doc_id, max(n) AS m FROM (SELECT doc_id, d, isle, count(*) AS n FROM {name}_d GROUP BY ALL) GROUP BY doc_id),
    {name}_r AS (SELECT doc_id, w, q, score, list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) AS runs FROM {name}_w),
    {name} AS (SELECT r.doc_id, score, len(w) AS n, len(w) >= 16 AND len(runs) > len(list_distinct(runs)) AS repeats, coalesce(len(w) >= 16 AND len(q) >= 12 AND m >= 12 AND m::DOUBLE / len(w) >= 0.35::DOUBLE, false) AS echo
        FROM {name}_r r LEFT JOIN {name}_m m ON r.doc_id = m.doc_id),
    {name}_s AS (SELECT count(*) AS total, round(avg(repeats::INT), 6) AS repetition_rate, round(avg(echo::INT), 6) AS echo_rate, round(avg((repeats OR echo OR n < 12)::INT), 6) AS failure_rate, round(avg(score), 6) AS mean_score FROM {name})"""


def ngrams(c: str, n: int = 4) -> str:
    w = words(f"lower({c})")
    return f"CASE WHEN len({w}) = 0 THEN [] WHEN len({w}) < {n} THEN [array_to_string({w}, ' ')] ELSE list_distinct(list_transform(range(1, len({w}) - {n - 2}), lambda i: array_to_string(({w})[i:i + {n - 1}], ' '))) END"


def shingles(most: int) -> str:
    runs = lambda step: f"list_distinct(list_transform(range(1, len(w) - 3, {step}), lambda i: array_to_string(w[i:i + 4], ' ')))"
    return f"CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] WHEN len(w) > {most + 5} THEN {runs(f'greatest(1, (len(w) - 4) // {most})')} ELSE {runs('1')} END"


_A, _B = coefficients()
SIGNATURE = f"""w AS (SELECT id, source_id, regexp_extract_all(lower(text), '[{WORD}]+') AS w FROM docs),
    h AS (SELECT id, list_transform({shingles(512)}, lambda s: (('0x' || substr(sha256(s), 9, 8))::UBIGINT & 2147483647)::BIGINT) AS h FROM w),
    coef AS (SELECT {list(_A)} AS a, {list(_B)} AS b),
    sig AS (SELECT id, CASE WHEN len(h) = 0 THEN list_transform(range(128), lambda i: 0::BIGINT)
        ELSE list_transform(range(1, 129), lambda i: list_min(list_transform(h, lambda x: (a[i]::BIGINT * x + b[i]::BIGINT) % 2147483647))) END AS sig FROM h, coef)"""

TOTALS = """SELECT 'source_id' AS dimension, coalesce(source_id, '(none)') AS value, sum(tokens)::BIGINT AS tokens FROM d GROUP BY 2
    UNION ALL SELECT 'category', coalesce(category, '(none)'), sum(tokens)::BIGINT FROM d GROUP BY 2
    UNION ALL SELECT 'organization', coalesce(organization, '(none)'), sum(tokens)::BIGINT FROM d GROUP BY 2"""


def distribution(dim: str) -> str:
    return f"SELECT '{dim}' AS dimension, coalesce({dim}, '(none)') AS value, count(*) AS documents, sum(tokens)::BIGINT AS tokens, round(sum(tokens)::DOUBLE / greatest(1, (SELECT sum(tokens) FROM d)), 4) AS share FROM d GROUP BY 2"


UNIT = "struct_pack(s := coalesce(source_id, ''), d := coalesce(relative_path, id))"
STEM = r"regexp_replace(regexp_replace(relative_path, '^.*/', ''), '([^.])\.[^.]+$', '\1')"
SUFFIX = r"lower(regexp_extract(regexp_replace(relative_path, '^.*/', ''), '[^.]\.([^.]+)$', 1))"
BENCH = "contains(lower(replace(relative_path, '\\', '/')), 'benchmark/')"
NAME = "regexp_replace(relative_path, '^.*/', '')"


def has(*p: str) -> str:
    return "(" + " OR ".join(f"contains(low, {q(x)})" for x in p) + ")"


CC = has("creative commons", "cc-", "attribution")
BOILER = [rf"\[!\[[^\n]*?\]\([^\n]*?\)]\([^\n]*?\)[{W}]*", rf"(?m)^---[{W}]*\ntitle:(?s:.*?)\n---[{W}]*\n", rf"<!--(?s:.*?)-->[{W}]*"]
_b1 = f"regexp_replace(text, {q(BOILER[0])}, '', 'g')"
_b2 = f"regexp_replace({_b1}, {q(BOILER[1])}, '', 'g')"
_b3 = strip(f"regexp_replace({_b2}, {q(BOILER[2])}, '', 'g')")
_nb = f"{count('text', BOILER[0])} + {count(_b1, BOILER[1])} + {count(_b2, BOILER[2])}"
BASE_CLEAN = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize({}), '\r\n?', chr(10), 'g'), '[\x00-\x08\x0b-\x1f\x7f]', '', 'g'), '(?m)[ \t]+$', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
_dirty = "chr(65279) || ' ' || chr(13) || chr(10) || text || ' ' || chr(9) || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10) || chr(13) || chr(10) || 'e' || chr(769) || chr(7) || 'end ' || chr(13)"
_clean = strip(
    rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace(nfc_normalize({_dirty}), '\r\n?', chr(10), 'g'), '[\x00-\x08\x0b-\x1f\x7f]', '', 'g'), '(?m)[ \t]+$', '', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')"
)
_parts = f"list_filter(string_split(regexp_replace(text, '(?m)^({HEADING})', chr(1) || '\\1', 'g'), chr(1)), lambda p: p <> '')"
_first = f"lower(regexp_extract(p, '^[^{BREAK}]*'))"
_dropped = strip(f"array_to_string(list_filter({_parts}, lambda p: NOT (contains({_first}, 'context') OR contains({_first}, 'open questions') OR contains({_first}, 'scope'))), '')")
_hint = "lower(coalesce(section_title, title, ''))"
_tc = "list_transform"

BUILT = f"""c AS (SELECT ord, source_id, category, language, {strip(BASE_CLEAN.format("coalesce(text, '')"))} AS text FROM corpus_document),
    p AS (SELECT *, text = '' OR coalesce(trim(source_id), '') = '' OR trim(source_id) <> source_id OR coalesce(trim(category), '') = '' OR trim(category) <> category AS bad FROM c),
    g AS (SELECT *, row_number() OVER (PARTITION BY {squeeze('text')} ORDER BY ord) = 1 AS kept, len({gate(80, 15, 0.4)}) = 0 AS ok FROM p WHERE NOT bad)"""
KEY42 = "('42:' || cluster)"
STREAM = f"""n AS (SELECT id, {words('text')} AS w FROM docs), m AS (SELECT id, w, len(w) + 1 AS size FROM n WHERE len(w) > 0),
    total AS (SELECT coalesce(sum(size), 0)::BIGINT AS t, coalesce(ceil(sum(size) / 2048.0), 0)::BIGINT AS sequences FROM m)"""
PAR = "chr(10) || chr(10)"
NORMAL = lambda c: strip(f"regexp_replace(lower({c}), '[{W}]+', ' ', 'g')")
_SLUGS = {re.sub("[^a-z0-9]+", "-", f).strip("-"): c for c in sorted(V.CONCEPT_PHRASES) for f in [c, *V.CONCEPT_PHRASES[c]]}
_SAMPLE = "concat_ws(' ', scenario, question, array_to_string(facts, ' '), array_to_string(expected_considerations, ' '))"
READY = f"""s AS (SELECT *, {NORMAL('text')} AS t, {three_way('ord::VARCHAR')} AS split FROM corpus_document),
    b AS (SELECT {NORMAL(_SAMPLE)} AS t, {NORMAL('scenario')} AS p1, {NORMAL('question')} AS p2 FROM benchmark_sample),
    r AS (SELECT (SELECT count(*) FROM (SELECT id FROM s GROUP BY id HAVING count(DISTINCT split) > 1)) AS id_overlap, (SELECT count(*) FROM (SELECT t FROM s GROUP BY t HAVING count(DISTINCT split) > 1)) AS text_overlap,
    (SELECT count(*) FROM s WHERE {' OR '.join(f"coalesce(trim({c}), '') = ''" for c in ('id', 'text', 'source_id', 'category', 'language', 'source_url'))} OR coalesce(trim(license_id), '') = '' AND coalesce(trim(metadata['verified_license_id']), '') = ''
        OR contains(lower(source_id), 'benchmark') OR contains(lower(coalesce(source_url, '')), 'benchmark')) AS invalid_records,
    (SELECT count(*) FROM (SELECT DISTINCT t FROM s WHERE t <> '') x WHERE EXISTS (SELECT 1 FROM b WHERE contains(b.t, x.t))) AS benchmark_documents,
    (SELECT count(DISTINCT b.t) FROM b WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT t FROM s) x WHERE p1 <> '' AND contains(x.t, p1) OR p2 <> '' AND contains(x.t, p2))) AS benchmark_samples),
    v AS (SELECT *, concat_ws(';', CASE WHEN id_overlap > 0 OR text_overlap > 0 THEN 'split_overlap' END, CASE WHEN invalid_records > 0 THEN 'invalid_records' END, CASE WHEN benchmark_documents > 0 THEN 'benchmark_contamination' END) AS blockers FROM r)"""
def near_sql(docs: str) -> str:
    return f"""WITH RECURSIVE {docs}, w AS (SELECT id, source_id, coalesce(quality_score, 0) AS score, length(text) AS len_, regexp_extract_all(lower(coalesce(text, '')), '[{WORD}]+') AS w FROM docs),
    h AS (SELECT id, score, len_, list_sort(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS h FROM w),
    k AS (SELECT id, score, len_, h, min(id) OVER (PARTITION BY h) AS head FROM h),
    u AS (SELECT id, len(h) AS n, unnest(h) AS s FROM k WHERE id = head),
    j AS (SELECT a.id AS id1, b.id AS id2, a.n AS n1, b.n AS n2, count(*) AS c FROM u a JOIN u b ON a.s = b.s AND a.id < b.id AND least(a.n, b.n) >= greatest(a.n, b.n) * 0.8::DOUBLE - 1e-6 GROUP BY ALL),
    e AS (SELECT id1, id2, c::DOUBLE / (n1 + n2 - c) AS sim FROM j WHERE c::DOUBLE / (n1 + n2 - c) >= 0.8::DOUBLE),
    two AS (SELECT id1 AS x, id2 AS y FROM e UNION SELECT id2, id1 FROM e), reach AS (SELECT id AS root, id AS node FROM k WHERE id = head UNION SELECT root, y FROM reach JOIN two ON node = x),
    part AS (SELECT node, min(root) AS cluster FROM reach GROUP BY node),
    m AS (SELECT id, head, score, len_, cluster FROM k JOIN part ON head = node),
    best AS (SELECT cluster, first(id ORDER BY -score, -len_, id) AS best_id, first(head ORDER BY -score, -len_, id) AS best_head FROM m GROUP BY cluster),
    own AS (SELECT m.id, m.cluster, best_id, CASE WHEN head = best_head THEN 1.0 ELSE coalesce(sim, 0.8) END::DOUBLE AS own FROM m JOIN best USING (cluster)
        LEFT JOIN e ON id1 = least(head, best_head) AND id2 = greatest(head, best_head)),
    mean AS (SELECT cluster, round(avg(own), 4) AS similarity FROM own WHERE id <> best_id GROUP BY cluster),
    near AS (SELECT id, own.cluster, best_id AS canonical, id = best_id AS kept, similarity FROM own LEFT JOIN mean ON own.cluster = mean.cluster)"""


NEAR = near_sql(CURRENT)
BY_CRAWL = "docs AS (SELECT doc_id::VARCHAR AS id, CASE WHEN crawled_at < TIMESTAMP '2025-06-01' THEN 'early' ELSE 'late' END AS source_id, text, 0.0::DOUBLE AS quality_score FROM documents)"

SQL: dict[str, str] = {
    "c1_clean": f"SELECT ord, md5({_clean}) AS clean_md5 FROM corpus_document",
    "c3_boilerplate": f"""WITH b AS (SELECT ord, text, {_b3} AS t, {_nb} AS n FROM corpus_document)
        SELECT ord, md5(CASE WHEN n > 0 AND length(text) > length(t) THEN t ELSE text END) AS text_md5, CASE WHEN n > 0 AND length(text) > length(t) THEN n ELSE 0 END::BIGINT AS blocks,
        CASE WHEN n > 0 AND length(text) > length(t) THEN length(text) - length(t) ELSE 0 END::BIGINT AS characters FROM b""",
    "c4_structural_headings": f"""SELECT ord, md5(regexp_replace(text, '(?m)^[\\t\\x0b-\\r\\x1c-\\x20\\x{{85}}\\x{{a0}}]*([^\\n]+?)[\\t\\x0b-\\r\\x1c-\\x20\\x{{85}}\\x{{a0}}]*\\n[=\\-`:''"~^_*+#<>]{{3,}}[{W}]*$', '# \\1', 'g')) AS text_md5 FROM corpus_document""",
    "c5_drop_sections": f"SELECT ord, md5(CASE WHEN {_dropped} <> '' THEN {_dropped} ELSE text END) AS text_md5 FROM corpus_document",
    "c7_section_hint": f"""SELECT ord, CASE WHEN contains({_hint}, 'decision') THEN 'adr_decision_reasoning' WHEN contains({_hint}, 'broker') THEN 'messaging_event_driven'
        WHEN contains({_hint}, 'cost') THEN 'system_design' END AS hint FROM corpus_document""",
    "c9_text_scalars": f"""SELECT ord, md5({strip(f"regexp_replace(lower(text), '[{W}]+', ' ', 'g')")}) AS normalized_md5, substr({squeeze('text')}, 1, 300) AS excerpt, sha256(text) AS content_sha256,
        sha256({squeeze('text')}) AS dedup_key FROM corpus_document""",
    "c11_prompt": f"""SELECT item_id, 'System Architecture Scenario:' || chr(10) || {strip('scenario')} || chr(10) || CASE WHEN coalesce(len(facts), 0) > 0
        THEN chr(10) || 'Key Scenario Facts & Constraints:' || chr(10) || array_to_string(list_transform(facts, lambda f: '- ' || f), chr(10)) ELSE '' END
        || chr(10) || chr(10) || 'Question:' || chr(10) || {strip('question')} AS prompt FROM benchmark_sample""",
    "s11_content_type": f"""SELECT ord, CASE {SUFFIX} {' '.join(f"WHEN '{a}' THEN '{b}'" for a, b in V.CONTENT_TYPES.items())} END AS content_type, {SUFFIX} AS suffix, {STEM} AS stem FROM corpus_document""",
    "s12_path_rules": f"""SELECT ord, NOT ({BENCH} OR regexp_matches(relative_path, '/.*cost') OR ends_with(relative_path, '.txt')) AND (starts_with(relative_path, 'adr') OR regexp_matches(relative_path, '(^|/)adr/[^/]*$')
        OR regexp_matches(relative_path, '^guides/.*\\.md$') OR regexp_matches(relative_path, '(^|/)guides/[^/]*\\.md$') OR regexp_matches(relative_path, 'broker.*\\.md$')) AS allowed,
        NOT {BENCH} AND {SUFFIX} IN ('md', 'markdown', 'txt', 'adoc', 'rst') AS allowed_by_default, {BENCH} AS benchmark FROM corpus_document""",
    "s13_scoped_license": f"""WITH a AS (SELECT ord, {BENCH} AS b, relative_path, starts_with(relative_path, 'adr/') OR regexp_matches(relative_path, '(^|/)adr/[^/]*$') AS adr FROM corpus_document)
        SELECT ord, CASE WHEN NOT b AND adr THEN 'CC-BY-4.0' WHEN NOT b AND NOT contains(relative_path, 'broker') THEN 'MIT' END AS license_id, NOT b AND adr AS training_enabled FROM a""",
    "s14_title": f"""WITH t AS (SELECT ord, regexp_extract(text, '(?m)^[\\t\\x0b-\\r\\x1c-\\x20\\x{{85}}\\x{{a0}}]*[#=] ([^\\n]*)$', 1) AS t FROM corpus_document)
        SELECT ord, CASE WHEN t <> '' THEN {strip('t')} ELSE 'Some File Name' END AS title FROM t""",
    "s20_source_inventory": "SELECT source_id, count(*) AS files, sum(strlen(text))::BIGINT AS bytes, (sum(strlen(text)) // 4)::BIGINT AS estimated_tokens FROM corpus_document GROUP BY source_id",
    "f1_quality_gate": f"SELECT ord, array_to_string({gate(300, 60, 0.05)}, ';') AS reasons FROM corpus_document",
    "f2_accepted": f"SELECT len({gate(80, 15, 0.4)}) = 0 AS accepted, count(*) AS documents FROM corpus_document GROUP BY 1",
    "f3_domain_relevance": f"WITH r AS (SELECT ord, {DOMAIN} AS category FROM corpus_document) SELECT ord, category IS NULL AS relevant, category FROM r",
    "f4_reasoning_relevance": f"""WITH {RELEVANCE.replace('{base}', 'corpus_document')} SELECT ord, r_score AS score, r_score >= 0.4::DOUBLE AND link_ratio_ <= 0.22::DOUBLE AS passed,
        round(link_ratio_, 4) AS link_ratio, round(r_prose, 4) AS prose_density, hits::BIGINT AS signals FROM r3""",
    "f5_fixtures": "SELECT ord FROM corpus_document WHERE source_id = 'test_fixtures_local' OR coalesce(metadata['is_test_fixture'], '') <> ''",
    "f7_code_share": f"""WITH c AS (SELECT ord, {tokens('text')} AS total_tokens, {tokens(f"array_to_string(regexp_extract_all(text, {q(CODE)}), chr(10))")} AS code_tokens FROM corpus_document)
        SELECT ord, total_tokens, code_tokens, greatest(0, total_tokens - code_tokens) AS prose_tokens, round(code_tokens::DOUBLE / greatest(1, total_tokens), 4) AS code_ratio,
        code_tokens::DOUBLE / greatest(1, total_tokens) > 0.2::DOUBLE AND total_tokens > 200 AS dominated FROM c""",
    "f8_combined_gate": f"""WITH {CURRENT}, {RELEVANCE.replace('{base}', 'docs')}, {QUALITY.replace('{base}', 'r3')},
        g AS (SELECT *, {tokens('text')} AS tokens, {tokens(f"array_to_string(regexp_extract_all(text, {q(CODE)}), chr(10))")} AS ct, {DOMAIN} AS dom FROM q3)
        SELECT id, q_score AS quality_score, r_score AS relevance_score, round(ct::DOUBLE / greatest(1, tokens), 4) AS code_ratio, tokens, array_to_string(list_filter([
        CASE WHEN dom IS NOT NULL THEN 'domain_relevance' END, CASE WHEN NOT (r_score >= 0.4::DOUBLE AND link_ratio_ <= 0.22::DOUBLE) THEN 'architecture_relevance_or_link_ratio' END,
        CASE WHEN bucket = 'low' THEN 'quality_score' END, CASE WHEN ct::DOUBLE / greatest(1, tokens) > 0.55::DOUBLE AND tokens > 200 THEN 'code_ratio' END], lambda x: x IS NOT NULL), ';') AS reasons FROM g""",
    "f9_enabled_sources": "SELECT ord FROM corpus_document WHERE source_id IN (SELECT id FROM source_config WHERE enabled)",
    "f10_license_of": f"""WITH t AS (SELECT ord, concat_ws(chr(10), 'Released under', license_id, CASE WHEN ord % 3 = 0 THEN 'Creative Commons Attribution 4.0' END, CASE WHEN ord % 5 = 0 THEN 'the MIT License' END, title) AS t FROM corpus_document),
        l AS (SELECT ord, lower(t) AS low, upper({strip('t')}) AS own FROM t)
        SELECT ord, CASE WHEN contains(own, 'MIT OR CC0') OR contains(own, 'CC0 OR MIT') THEN 'MIT' WHEN {has('mit no attribution', 'mit-0')} THEN 'MIT-0'
        WHEN {has('apache license')} AND {has('version 2.0', 'v2.0')} THEN 'Apache-2.0' WHEN {CC} AND {has('noncommercial', 'by-nc', 'nc-sa')} THEN 'CC-BY-NC-SA-4.0'
        WHEN {CC} AND {has('attribution-sharealike 4.0', 'by-sa/4.0', 'by-sa 4.0', 'cc-by-sa-4.0')} THEN 'CC-BY-SA-4.0' WHEN {CC} AND {has('attribution 4.0', 'by/4.0', 'by 4.0', 'cc-by-4.0')} THEN 'CC-BY-4.0'
        WHEN {CC} AND {has('attribution 3.0', 'by/3.0', 'by 3.0')} THEN 'CC-BY-3.0' WHEN {CC} AND {has('public domain', 'cc0')} THEN 'CC0-1.0'
        WHEN {has('mit license', 'permission is hereby granted, free of charge')} OR own = 'MIT' THEN 'MIT' WHEN {has('bsd 3-clause')} OR ({has('redistribution and use in source')} AND {has('neither the name')}) THEN 'BSD-3-Clause'
        WHEN {has('bsd 2-clause')} THEN 'BSD-2-Clause' WHEN {has('mozilla public license')} AND {has('2.0')} THEN 'MPL-2.0' END AS license FROM l""",
    "f13_invalid_records": """WITH r AS (SELECT ord, text, category, CASE WHEN ord % 7 = 0 THEN ' ' || source_id ELSE source_id END AS source_id FROM corpus_document),
        p AS (SELECT ord, list_filter([CASE WHEN coalesce(regexp_replace(text, '\\s+', '', 'g'), '') = '' THEN 'blank_text' END,
        CASE WHEN coalesce(trim(source_id), '') = '' THEN 'blank_source_id' WHEN trim(source_id) <> source_id THEN 'untrimmed_source_id' END,
        CASE WHEN coalesce(trim(category), '') = '' THEN 'blank_category' WHEN trim(category) <> category THEN 'untrimmed_category' END], lambda x: x IS NOT NULL) AS p FROM r)
        SELECT ord, array_to_string(p, ';') AS problems FROM p WHERE len(p) > 0""",
    "f14_sample_problems": f"""WITH s AS (SELECT item_id, category, difficulty, scenario, CASE WHEN item_id % 10 = 0 THEN 'arch-eval-0001' ELSE id END AS id, CASE WHEN item_id % 9 = 0 THEN ' ?' ELSE question END AS question FROM benchmark_sample),
        p AS (SELECT item_id, list_filter([CASE WHEN coalesce(id, '') = '' THEN 'missing_id' WHEN count(*) OVER (PARTITION BY id) > 1 THEN 'duplicate_id' END, CASE WHEN coalesce(category, '') = '' THEN 'missing_category' END,
        CASE WHEN NOT coalesce(difficulty IN ('easy', 'medium', 'hard'), false) THEN 'difficulty' END, CASE WHEN length({strip("coalesce(scenario, '')")}) < 20 THEN 'short_scenario' END,
        CASE WHEN length({strip("coalesce(question, '')")}) < 5 THEN 'short_question' END], lambda x: x IS NOT NULL) AS p FROM s) SELECT item_id, array_to_string(p, ';') AS problems FROM p WHERE len(p) > 0""",
    "x1_quality": f"""WITH {QUALITY.replace('{base}', 'corpus_document')} SELECT ord, q_score AS score, bucket, array_to_string(CASE WHEN n = 0 THEN ['Empty or non-text document']
        WHEN bucket = 'low' AND len(told) = 0 THEN ['low technical prose density'] ELSE told END, ';') AS reasons, CASE WHEN n > 0 THEN round(tech, 4) END AS technical, CASE WHEN n > 0 THEN round(prose, 4) END AS prose FROM q3""",
    "x2_token_count": f"SELECT ord, {tokens('text')} AS tokens FROM corpus_document",
    "x3_token_ids": f"SELECT ord, md5(array_to_string(list_transform({words('text')}, lambda w: ({hexnum('w', 1, 8)} % 100000)::VARCHAR), ',')) AS ids_md5 FROM corpus_document",
    "x6_shingles": f"""WITH w AS (SELECT ord, regexp_extract_all(lower(text), '[{WORD}]+') AS w FROM corpus_document), s AS (SELECT ord, {shingles(100)} AS s FROM w)
        SELECT ord, len(s)::INT AS shingles, md5(array_to_string(list_sort(s), '|')) AS shingles_md5 FROM s""",
    "x8_signatures": f"WITH {CURRENT}, {SIGNATURE} SELECT id, md5(array_to_string(sig, ',')) AS signature_md5 FROM sig",
    "x11_hash_scores": f"SELECT ord, {hexnum('''('42:' || id)''', 1, 8)}::DOUBLE / 4294967295::DOUBLE AS score32, {score64('''('42:' || id)''')} AS score64 FROM corpus_document",
    "x15_concepts": f"""SELECT ord, array_to_string({concepts('lower(text)')}, ',') AS concepts, array_to_string(list_filter([{', '.join(
        f"CASE WHEN regexp_matches(lower(text), '(?:^|[^{WORD}]){p}(?:[^{WORD}]|$)') THEN '{s}' END" for s, p in sorted((s, p) for p, s in V.CANDIDATE_PHRASES.items()))}], lambda x: x IS NOT NULL), ',') AS candidates FROM corpus_document""",
    "x16_classify": f"""WITH c AS (SELECT ord, lower(text) AS low, {concepts('lower(text)')} AS found, category_hint FROM corpus_document),
        s AS (SELECT ord, {classify('found', 'low', 'category_hint')[0]} AS s FROM c), t AS (SELECT ord, s, {classify('found', 'low', 'category_hint')[1]} AS total FROM s)
        SELECT ord, CASE WHEN total = 0 THEN 'software_architecture' ELSE s[1].name END AS primary_category, CASE WHEN total = 0 THEN 0.0 ELSE round(-s[1].m / total, 3) END::DOUBLE AS confidence FROM t""",
    "x19_repetition": """WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents),
        s AS (SELECT doc_id, len(w) AS n, list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i + 7], ' ')) AS s FROM w)
        SELECT doc_id, n >= 16 AND len(s) > len(list_distinct(s)) AS repeats FROM s""",
    "x21_organization": "SELECT ord, coalesce(metadata['repository_owner'], source_id) AS organization FROM corpus_document",
    "x23_license_concerns": f"SELECT id, CASE license_review_status {' '.join(f'WHEN {q(k)} THEN {q(chr(59).join(v))}' for k, v in V.LICENSE_CONCERNS.items())} ELSE {q(V.LICENSE_CONCERN_OTHERWISE)} END AS concerns FROM source_config",
    "d1_exact_duplicates": f"""WITH k AS (SELECT ord, id, {squeeze('text')} AS k FROM corpus_document)
        SELECT ord, first_value(id) OVER (PARTITION BY k ORDER BY ord) AS canonical, row_number() OVER (PARTITION BY k ORDER BY ord) = 1 AS kept FROM k""",
    "d2_ranked_duplicates": f"""WITH k AS (SELECT ord, id, {squeeze('text')} AS k, -coalesce(quality_score, 0) AS s FROM corpus_document)
        SELECT ord, first_value(id) OVER (PARTITION BY k ORDER BY s, id, ord) AS canonical, row_number() OVER (PARTITION BY k ORDER BY s, id, ord) = 1 AS kept FROM k""",
    "d4_near_pairs": f"""WITH {CURRENT}, {SIGNATURE}, f AS (SELECT min(id) AS id, sig FROM sig GROUP BY sig),
        b AS (SELECT id, i AS band, sig[i * 8 + 1:i * 8 + 8] AS key FROM f, range(16) t(i)),
        p AS (SELECT DISTINCT x.id AS id1, y.id AS id2 FROM b x JOIN b y ON x.band = y.band AND x.key = y.key AND x.id < y.id),
        s AS (SELECT id1, id2, len(list_filter(list_zip(x.sig, y.sig), lambda z: z[1] = z[2]))::DOUBLE / 128 AS similarity FROM p JOIN f x ON x.id = id1 JOIN f y ON y.id = id2)
        SELECT * FROM s WHERE similarity >= 0.85::DOUBLE""",
    "d9_contamination": f"""WITH a AS (SELECT doc_id, {ngrams('text')} AS g FROM documents), b AS (SELECT item_id AS sample_id, {ngrams("(scenario || ' ' || question)")} AS g FROM benchmark_sample),
        ua AS (SELECT doc_id, len(g) AS na, unnest(g) AS g FROM a), ub AS (SELECT sample_id, len(g) AS nb, unnest(g) AS g FROM b),
        c AS (SELECT doc_id, sample_id, na, nb, count(*) AS n FROM ua JOIN ub USING (g) GROUP BY ALL)
        SELECT doc_id, sample_id, round(n::DOUBLE / (na + nb - n), 4) AS jaccard, round(n::DOUBLE / nb, 4) AS containment FROM c WHERE n::DOUBLE / (na + nb - n) >= 0.05::DOUBLE""",
    "d11_leakage": f"""WITH s AS (SELECT id, {strip(f"regexp_replace(lower(text), '[{W}]+', ' ', 'g')")} AS t, {three_way('ord::VARCHAR')} AS split FROM corpus_document)
        SELECT (SELECT count(*) FROM (SELECT id FROM s GROUP BY id HAVING count(DISTINCT split) > 1)) AS id_overlap, (SELECT count(*) FROM (SELECT t FROM s GROUP BY t HAVING count(DISTINCT split) > 1)) AS text_overlap""",
    "d12_cross_source": f"""{TOK_DOCS}, g AS (SELECT md5(section_title) AS content_sha256, count(*) AS documents, count(DISTINCT source_id) AS s, sum(tokens) AS t, max(tokens) AS o FROM d
        WHERE source_id IN ('beacon_design_wiki', 'mesh_proposals') GROUP BY 1) SELECT content_sha256, documents, (t - o)::BIGINT AS tokens_saved FROM g WHERE s = 2""",
    "a3_token_distribution": f"{TOK_DOCS} {distribution('source_id')} UNION ALL {distribution('category')} UNION ALL {distribution('license_id')}",
    "a5_token_totals": f"{TOK_DOCS} {TOTALS}",
    "a6_concentration": f"""{TOK_DOCS}, t AS ({TOTALS}), n AS (SELECT sum(tokens)::DOUBLE AS n FROM d), r AS (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY tokens DESC, value) AS p FROM t),
        x AS (SELECT n, sum(tokens) FILTER (dimension = 'source_id' AND p = 1) / n AS s1, sum(tokens) FILTER (dimension = 'source_id' AND p <= 5) / n AS s5, sum(tokens) FILTER (dimension = 'category' AND p = 1) / n AS c1,
        sum(tokens) FILTER (dimension = 'organization' AND p = 1) / n AS o1, sum(tokens::DOUBLE * tokens) FILTER (dimension = 'source_id') / (n * n) AS h,
        coalesce(sum(tokens) FILTER (dimension = 'category' AND value = 'ai_agent_architecture'), 0) / n AS f1, coalesce(sum(tokens) FILTER (dimension = 'category' AND value = 'system_design'), 0) / n AS f2 FROM r, n GROUP BY n)
        SELECT n::BIGINT AS total_tokens, round(s1, 4) AS top_1_source_share, round(s5, 4) AS top_5_source_share, round(c1, 4) AS top_category_share, round(o1, 4) AS top_organization_share, round(h, 4) AS hhi_source_index,
        concat_ws(';', CASE WHEN s1 > 0.35 THEN 'source_dominance' END, CASE WHEN c1 > 0.45 THEN 'category_dominance' END, CASE WHEN f1 < 0.1 THEN 'low_category:ai_agent_architecture' END, CASE WHEN f2 < 0.01 THEN 'low_category:system_design' END) AS warnings FROM x""",
    "a7_cap_status": f"""{TOK_DOCS}, t AS ({TOTALS}), g AS (SELECT dimension, max(tokens)::DOUBLE / sum(tokens) AS s FROM t GROUP BY dimension), c AS (SELECT *, CASE dimension WHEN 'source_id' THEN 0.05::DOUBLE ELSE 0.4::DOUBLE END AS cap FROM g)
        SELECT dimension, cap, round(s, 6) AS actual_share, s <= cap + 0.001::DOUBLE AS satisfied FROM c""",
    "a8_source_quality": f"""WITH {CURRENT}, {QUALITY.replace('{base}', 'docs')}, g AS (SELECT source_id, ((2 * sum(round(q_score * 10000)::BIGINT) + count(*)) // (2 * count(*)))::DOUBLE / 10000 AS m, avg((bucket = 'high')::INT) AS h, count(*) AS documents FROM q3 GROUP BY source_id)
        SELECT source_id, m AS score, round(h, 4) AS high_ratio, CASE WHEN m >= 0.7::DOUBLE THEN 'high' WHEN m >= 0.45::DOUBLE THEN 'medium' ELSE 'low' END AS bucket, documents FROM g""",
    "a9_length_percentiles": f"""{TOK_DOCS}, r AS (SELECT tokens, row_number() OVER (ORDER BY tokens) - 1 AS i, count(*) OVER () AS n FROM d)
        SELECT min(tokens) AS min_tokens, {', '.join(f"max(tokens) FILTER (i = floor({p}::DOUBLE * (n - 1))) AS {k}" for k, p in (('p10', 0.10), ('p25', 0.25), ('median', 0.5), ('p75', 0.75), ('p90', 0.9), ('p95', 0.95), ('p99', 0.99)))},
        max(tokens) AS max_tokens, round(sum(tokens)::DOUBLE / count(*), 2) AS mean_tokens FROM r""",
    "a10_context_fit": f"""{TOK_DOCS} SELECT l::INT AS context_length, round(avg((tokens <= l)::INT) * 100, 2) AS fitting_pct, round(avg((tokens > l)::INT) * 100, 2) AS splitting_pct, sum(ceil(tokens::DOUBLE / l))::BIGINT AS sequences,
        round(sum(tokens)::DOUBLE / (sum(ceil(tokens::DOUBLE / l)) * l) * 100, 2) AS filling_pct FROM d, (SELECT unnest([128, 256, 512, 1024, 2048, 4096]) AS l) GROUP BY l""",
    "a11_category_coverage": f"""{TOK_DOCS} SELECT coalesce(primary_category, category, '(none)') AS primary_category, sum(tokens)::BIGINT AS tokens, count(DISTINCT source_id) AS sources, count(DISTINCT {UNIT}) AS documents, count(*) AS training_units FROM d GROUP BY 1""",
    "a12_concept_coverage": f"""{TOK_DOCS}, x AS (SELECT unnest(related_concepts) AS concept, source_id, relative_path, id, tokens FROM d), p AS (SELECT concept, source_id, sum(tokens) AS t FROM x GROUP BY ALL),
        g AS (SELECT concept, sum(tokens)::BIGINT AS tokens, count(DISTINCT source_id) AS sources, count(DISTINCT {UNIT}) AS documents, count(*) AS units FROM x GROUP BY concept),
        m AS (SELECT concept, max(t) AS top, first(source_id ORDER BY t DESC, source_id) AS s FROM p GROUP BY concept), v AS (SELECT unnest({arr(sorted(V.CONCEPT_PHRASES))}) AS concept),
        r AS (SELECT v.concept, coalesce(tokens, 0) AS tokens, coalesce(sources, 0) AS sources, coalesce(documents, 0) AS documents, coalesce(units, 0) AS training_units, round(coalesce(top, 0)::DOUBLE / greatest(1, coalesce(tokens, 0)), 4) AS dominant_source_share, s AS dominant_source
        FROM v LEFT JOIN g ON v.concept = g.concept LEFT JOIN m ON v.concept = m.concept)
        SELECT *, CASE WHEN training_units = 0 THEN 'NO_COVERAGE' ELSE coalesce(nullif(concat_ws(';', CASE WHEN tokens < 10000 THEN 'LOW_TOKENS' END, CASE WHEN sources < 30 THEN 'LOW_SOURCE_DIVERSITY' END, CASE WHEN documents < 2 THEN 'LOW_DOCUMENT_DIVERSITY' END,
        CASE WHEN dominant_source_share > 0.1::DOUBLE THEN 'HIGH_SOURCE_CONCENTRATION' END), ''), 'healthy') END AS status FROM r""",
    "a13_concept_matrix": f"{TOK_DOCS}, x AS (SELECT unnest(related_concepts) AS concept, source_id, tokens FROM d) SELECT concept, source_id, sum(tokens)::BIGINT AS tokens FROM x GROUP BY ALL",
    "a14_candidates": f"""{TOK_DOCS}, x AS (SELECT unnest(candidate_concepts) AS candidate, source_id, relative_path, id, tokens FROM d)
        SELECT candidate, count(*) AS count, sum(tokens)::BIGINT AS tokens, count(DISTINCT source_id) AS sources, count(DISTINCT {UNIT}) AS documents, array_to_string(list_sort(list_distinct(list(id)))[1:3], ',') AS sample_ids FROM x GROUP BY candidate""",
    "a15_capacity": f"""{TOK_DOCS}, w AS (SELECT unnest({arr([*V.CATEGORIES[:9], 'robotics'])}) AS category), h AS (SELECT primary_category AS category, sum(tokens) AS a FROM d GROUP BY 1), c AS (SELECT category, count(*) AS n FROM source_config GROUP BY 1),
        r AS (SELECT w.category, coalesce(a, 0)::BIGINT AS a, coalesce(n, 0) AS n FROM w LEFT JOIN h ON w.category = h.category LEFT JOIN c ON w.category = c.category)
        SELECT category, 0.1::DOUBLE AS target_share, 200000::BIGINT AS target_tokens, a AS available_tokens, greatest(0, 200000 - a)::BIGINT AS deficit_tokens, round(greatest(0, 200000 - a)::DOUBLE / 200000, 4) AS deficit_share, n AS contributing_sources,
        CASE WHEN n = 0 THEN 'no_source_configured' WHEN a = 0 THEN 'quality_rejection_or_insufficient_raw_content' WHEN a < 200000 THEN 'insufficient_eligible_content_or_source_cap' ELSE 'available' END AS cause FROM r""",
    "a15_capped_sources": f"""{TOK_DOCS}, h AS (SELECT source_id, count(*) AS n, sum(tokens) AS t FROM d GROUP BY 1)
        SELECT s.id AS source_id, coalesce(nullif(source_token_cap, 0), 5000)::BIGINT AS cap, coalesce(n, 0) AS eligible_documents, coalesce(t, 0)::BIGINT AS eligible_tokens, least(coalesce(nullif(source_token_cap, 0), 5000), coalesce(t, 0))::BIGINT AS capped_tokens
        FROM source_config s LEFT JOIN h ON s.id = h.source_id""",
    "a16_rejection_reasons": f"SELECT source_id, reason, count(*) AS documents FROM (SELECT source_id, unnest({gate(300, 60, 0.05)}) AS reason FROM corpus_document) GROUP BY ALL",
    "a17_rarity": f"{TOK_DOCS} SELECT concept, count(DISTINCT source_id) AS sources FROM (SELECT unnest(related_concepts) AS concept, source_id FROM d) GROUP BY concept",
    "a19_source_audit": f"""WITH k AS (SELECT source_id, {tokens('text')} AS t, row_number() OVER (PARTITION BY {squeeze('text')} ORDER BY ord) = 1 AS kept FROM corpus_document),
        g AS (SELECT source_id, count(*) AS discovered, count(*) FILTER (NOT kept) AS rejected, count(*) FILTER (kept) AS curated, coalesce(sum(t) FILTER (kept), 0)::BIGINT AS final_tokens FROM k GROUP BY 1)
        SELECT s.id AS source_id, enabled, category, coalesce(discovered, 0) AS discovered, coalesce(rejected, 0) AS rejected, coalesce(curated, 0) AS curated, coalesce(final_tokens, 0) AS final_tokens,
        CASE WHEN NOT coalesce(enabled, false) THEN 'disabled' WHEN coalesce(discovered, 0) = 0 THEN 'no_documents' END AS reason_if_zero FROM source_config s LEFT JOIN g ON s.id = g.source_id""",
    "a20_license_audit": f"""WITH {CURRENT} SELECT coalesce(nullif(metadata['verified_license_id'], ''), nullif(license_id, ''), 'unverified') AS license, count(*) AS documents,
        count(*) FILTER (coalesce(metadata['verified_license_id'], '') = '' OR license_id IS NULL) AS unverified FROM docs GROUP BY 1""",
    "a22_sample_distribution": "SELECT 'category' AS dimension, category AS value, count(*) AS samples FROM benchmark_sample GROUP BY 2 UNION ALL SELECT 'difficulty', difficulty, count(*) FROM benchmark_sample GROUP BY 2",
    "w3_review_sample": f"WITH {CURRENT}, r AS (SELECT category, id, row_number() OVER (PARTITION BY category ORDER BY sha256(id), id) AS place FROM docs WHERE category IN ({', '.join(map(q, V.CATEGORIES))})) SELECT * FROM r WHERE place <= 5",
    "w4_audit_sample": "WITH r AS (SELECT item_id, difficulty, row_number() OVER (PARTITION BY difficulty ORDER BY item_id) AS n FROM benchmark_sample) SELECT item_id, difficulty FROM r WHERE n <= CASE difficulty WHEN 'easy' THEN 5 WHEN 'medium' THEN 10 WHEN 'hard' THEN 10 ELSE 0 END",
    "split_two_way": f"""WITH {CURRENT}, s AS (SELECT id, {hexnum('''('42:' || id)''', 1, 8)}::DOUBLE / 4294967295::DOUBLE AS s FROM docs) SELECT id, CASE WHEN s < 1.0::DOUBLE - 0.9::DOUBLE THEN 'validation' ELSE 'train' END AS split FROM s""",
    "split_three_way": f"WITH {CURRENT}, g AS (SELECT id, coalesce(nullif(metadata['provenance_group_id'], ''), id) AS g FROM docs) SELECT id, {three_way('g')} AS split FROM g",
    "u2_set_operations": """WITH a AS (SELECT DISTINCT source_id FROM corpus_document WHERE ord % 2 = 0), b AS (SELECT DISTINCT source_id FROM corpus_document WHERE ord % 3 = 0)
        SELECT 'intersect' AS operation, source_id FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'except', source_id FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'union', source_id FROM (SELECT * FROM a UNION SELECT * FROM b)""",
    "j1_policy_join": f"{TOK_DOCS} SELECT d.id, d.source_id, coalesce(quality_score, 0)::DOUBLE AS quality, tokens, s.source_priority AS priority, s.release_eligible FROM d LEFT JOIN source_config s ON d.source_id = s.id",
    "build_stats": f"""WITH {BUILT}, a AS (SELECT source_id, count(*) AS documents, sum(length(text))::BIGINT AS characters, sum(len({words('text')}))::BIGINT AS words FROM g WHERE kept AND ok GROUP BY 1),
        r AS (SELECT source_id, count(*) AS n FROM g WHERE kept AND NOT ok GROUP BY 1), d AS (SELECT source_id, count(*) AS n FROM g WHERE NOT kept GROUP BY 1), i AS (SELECT DISTINCT source_id FROM g)
        SELECT i.source_id, coalesce(documents, 0) AS documents, coalesce(characters, 0) AS characters, coalesce(words, 0) AS words, coalesce(r.n, 0) AS rejected, coalesce(d.n, 0) AS duplicates,
        coalesce(round(characters::DOUBLE / documents, 2), 0) AS avg_characters, coalesce(round(words::DOUBLE / documents, 2), 0) AS avg_words
        FROM i LEFT JOIN a ON i.source_id = a.source_id LEFT JOIN r ON i.source_id = r.source_id LEFT JOIN d ON i.source_id = d.source_id""",
    "build_ledger": f"""WITH {BUILT} SELECT 'quarantined' AS decision, count(*) AS entries FROM p WHERE bad HAVING count(*) > 0 UNION ALL SELECT 'exact_duplicate', count(*) FROM g WHERE NOT kept HAVING count(*) > 0
        UNION ALL SELECT 'rejected_quality', count(*) FROM g WHERE kept AND NOT ok HAVING count(*) > 0 UNION ALL SELECT 'kept', count(*) FROM g WHERE kept AND ok HAVING count(*) > 0""",
    "s20_inventory_of_allowed": f"SELECT source_id, count(*) AS files, sum(strlen(text))::BIGINT AS bytes, (sum(strlen(text)) // 4)::BIGINT AS estimated_tokens FROM corpus_document WHERE NOT {BENCH} AND {SUFFIX} IN ('md', 'markdown', 'txt', 'adoc', 'rst') GROUP BY source_id",
    "c8_chunks": f"""WITH RECURSIVE {CURRENT}, d AS (SELECT id, text, {tokens('text')} AS t FROM docs),
        ps AS (SELECT id, list_filter(list_transform(string_split(text, {PAR}), lambda x: {strip('x')}), lambda x: x <> '') AS l FROM d WHERE t > 100),
        p AS (SELECT id, unnest(l) AS p, unnest(range(1, len(l) + 1)) AS i FROM ps), c AS (SELECT *, {tokens('p')} AS cost FROM p),
        fold AS (SELECT id, i, 1 AS chunk, cost AS load FROM c WHERE i = 1 UNION ALL SELECT c.id, c.i, CASE WHEN load + cost > 100 THEN chunk + 1 ELSE chunk END, CASE WHEN load + cost > 100 THEN cost ELSE load + cost END
            FROM fold JOIN c ON c.id = fold.id AND c.i = fold.i + 1),
        parts AS (SELECT id, chunk, string_agg(p, {PAR} ORDER BY i) AS text FROM fold JOIN c USING (id, i) GROUP BY id, chunk UNION ALL SELECT id, 1, text FROM d WHERE t <= 100)
        SELECT id || '_chunk_' || lpad(chunk::VARCHAR, 3, '0') AS chunk_id, id, chunk::INT AS chunk_index, count(*) OVER (PARTITION BY id)::INT AS total_chunks, {tokens('text')} AS tokens, md5(text) AS text_md5 FROM parts""",
    "c6_sectionize": f"""WITH RECURSIVE {CURRENT}, d AS (SELECT id, title, text, {tokens('text')} AS t FROM docs),
        ss AS (SELECT id, list_filter(list_transform({_parts}, lambda x: {strip('x')}), lambda x: x <> '') AS l FROM d WHERE t > 120),
        sec AS (SELECT id, unnest(l) AS s, unnest(range(1, len(l) + 1)) AS k FROM ss),
        hd AS (SELECT id, k, s, CASE WHEN regexp_matches(regexp_extract(s, '^[^{chr(92)}n]*'), '^{HEADING}') THEN {strip(f"regexp_replace(regexp_extract(s, '^[^{chr(92)}n]*'), '^{HEADING}', '')")} END AS title FROM sec),
        q AS (SELECT id, k, title, regexp_split_to_array(s, '{chr(92)}n{{2,}}') AS l FROM hd), p AS (SELECT id, k, title, unnest(l) AS p, unnest(range(1, len(l) + 1)) AS i FROM q),
        c AS (SELECT *, len({words('p')}) AS cost FROM p),
        fold AS (SELECT id, k, i, 1 AS chunk, cost AS load FROM c WHERE i = 1 UNION ALL SELECT c.id, c.k, c.i, CASE WHEN floor((load + cost) * 1.3::DOUBLE) > 120 THEN chunk + 1 ELSE chunk END,
            CASE WHEN floor((load + cost) * 1.3::DOUBLE) > 120 THEN cost ELSE load + cost END FROM fold JOIN c ON c.id = fold.id AND c.k = fold.k AND c.i = fold.i + 1),
        parts AS (SELECT id, k, chunk, any_value(title) AS title, string_agg(p, {PAR} ORDER BY i) AS text FROM fold JOIN c USING (id, k, i) GROUP BY id, k, chunk),
        n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY k, chunk) - 1 AS idx, last_value(title IGNORE NULLS) OVER (PARTITION BY id ORDER BY k, chunk ROWS UNBOUNDED PRECEDING) AS carried FROM parts)
        SELECT substr(sha256(id || ':' || idx || ':' || text), 1, 16) AS id, id AS parent_id, idx::INT AS section_index, carried AS section_title, md5(text) AS text_md5 FROM n
        UNION ALL SELECT id, id, 0, title, md5(text) FROM d WHERE t <= 120""",
    "x13_normalize_concept": f"""WITH l AS (SELECT DISTINCT unnest(list_concat(coalesce(related_concepts, []), coalesce(candidate_concepts, []), [category, title])) AS label FROM corpus_document),
        m AS (SELECT unnest({arr(_SLUGS)}) AS slug, unnest({arr(_SLUGS.values())}) AS concept)
        SELECT label, concept FROM l LEFT JOIN m ON regexp_replace(regexp_replace(lower(label), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') = slug WHERE label IS NOT NULL""",
    "x17_annotation": f"""WITH c AS (SELECT ord, lower(text) AS low, {concepts('lower(text)')} AS found, category_hint FROM corpus_document),
        s AS (SELECT ord, low, found, {classify('found', 'low', 'category_hint')[0]} AS s FROM c), t AS (SELECT *, {classify('found', 'low', 'category_hint')[1]} AS total FROM s)
        SELECT ord, array_to_string(found, ',') AS related_concepts, array_to_string(list_filter([{', '.join(f"CASE WHEN regexp_matches(low, '(?:^|[^{WORD}]){p}(?:[^{WORD}]|$)') THEN '{x}' END" for x, p in sorted((x, p) for p, x in V.CANDIDATE_PHRASES.items()))}], lambda x: x IS NOT NULL), ',') AS candidate_concepts,
        CASE WHEN total = 0 THEN 'software_architecture' ELSE s[1].name END AS primary_category, CASE WHEN total = 0 THEN 0.0 ELSE round(-s[1].m / total, 3) END::DOUBLE AS category_confidence FROM t""",
    "x18_rubric": f"WITH {EVALUATED} SELECT doc_id, item_id, category, difficulty, {', '.join(DIMENSIONS)}, overall, claims, revisits FROM e",
    "x20_prompt_echo": f"WITH {ECHO}, {judged('pr', 'x')} SELECT doc_id, echo FROM x",
    "a23_benchmark_scores": f"""WITH {EVALUATED} SELECT 'category' AS by, category AS value, {exact_mean('overall')} AS mean FROM e GROUP BY 2 UNION ALL SELECT 'difficulty', difficulty, {exact_mean('overall')} FROM e GROUP BY 2
        {' '.join(f"UNION ALL SELECT 'dimension', '{x}', {exact_mean(x)} FROM e" for x in DIMENSIONS)}
        UNION ALL SELECT 'all', 'overall', {exact_mean('overall')} FROM e UNION ALL SELECT 'all', 'claim_rate', round(avg((claims > 0)::INT), 4) FROM e UNION ALL SELECT 'all', 'revisit_rate', round(avg((revisits > 0)::INT), 4) FROM e""",
    "a23_failure_modes": f"""WITH {EVALUATED}, r AS (SELECT doc_id, item_id, overall, concat_ws(';', CASE WHEN claims > 0 THEN 'unsupported_claims' END, CASE WHEN tradeoff_quality < 0.4::DOUBLE THEN 'weak_tradeoffs' END,
        CASE WHEN reliability_reasoning < 0.4::DOUBLE THEN 'missing_reliability' END, CASE WHEN revisit_conditions < 0.4::DOUBLE THEN 'no_revisit_conditions' END,
        CASE WHEN missing_info AND clarification_awareness <> 0.9::DOUBLE THEN 'missed_information' END) AS reasons FROM e)
        SELECT doc_id, item_id, overall, CASE WHEN reasons = '' THEN 'low_score' ELSE reasons END AS reasons FROM r WHERE reasons <> '' OR overall < 0.5::DOUBLE""",
    "w8_worst_responses": f"WITH {EVALUATED} SELECT doc_id, item_id, overall FROM e ORDER BY overall, doc_id, item_id LIMIT 20",
    "j4_review_export": f"""WITH {EVALUATED} SELECT e.doc_id, e.item_id, overall, claims, question, e.difficulty, md5(text) AS response_md5, false AS audited, '' AS notes, NULL::DOUBLE AS score_override
        FROM e JOIN benchmark_sample b ON e.item_id = b.item_id JOIN documents d ON e.doc_id = d.doc_id""",
    "j6_incomplete_runs": f"""WITH {EVALUATED}, m AS (SELECT item_id, concat_ws(';', CASE WHEN item_id NOT IN (SELECT item_id FROM e) THEN 'output' END, CASE WHEN item_id NOT IN (SELECT item_id FROM e WHERE difficulty <> 'easy') THEN 'score' END) AS missing FROM benchmark_sample)
        SELECT item_id, missing FROM m WHERE missing <> ''""",
    "o11_comparison": f"""WITH {EVALUATED}, r AS ({' UNION ALL '.join(f"SELECT '{x}' AS metric, {exact_mean(x, "difficulty = 'easy'")} AS base, {exact_mean(x, "difficulty = 'hard'")} AS candidate FROM e" for x in [*DIMENSIONS, 'overall'])})
        SELECT *, round(candidate - base, 4) AS delta FROM r""",
    "a24_behaviour": f"WITH {ECHO}, {judged('pr', 'x')} SELECT * FROM x_s",
    "a25_regressions": f"""WITH {ECHO}, pw AS (SELECT doc_id, prompt, prompt || ' ' || prompt AS response, 0.3::DOUBLE AS score FROM pr), {judged('pr', 'x')}, {judged('pw', 'y')},
        f AS (SELECT concat_ws(';', {', '.join(f"CASE WHEN x_s.{n} > 0.05::DOUBLE THEN 'base_unhealthy:{n}' END, CASE WHEN y_s.{n} > x_s.{n} + 0.05::DOUBLE THEN 'regressed:{n}' END" for n in ('repetition_rate', 'echo_rate', 'failure_rate'))},
        CASE WHEN y_s.mean_score < x_s.mean_score - 0.1::DOUBLE THEN 'regressed:mean_score' END) AS failures FROM x_s, y_s) SELECT failures = '' AS passed, failures FROM f""",
    "a26_fingerprint": f"WITH {CURRENT}, l AS (SELECT sha256(id || chr(0) || sha256(text) || chr(0) || coalesce(license_id, '')) AS h FROM docs) SELECT sha256('curated' || string_agg(h, '' ORDER BY h)) AS fingerprint FROM l",
    "a27_corpus_hash": f"WITH {CURRENT}, l AS (SELECT sha256(coalesce(text, '')) AS h FROM docs) SELECT sha256(string_agg(h, '' ORDER BY h)) AS fingerprint FROM l",
    "a28_packing_statistics": f"WITH {CURRENT}, {STREAM} SELECT t AS packed_tokens, sequences * 2048 - t AS padding_tokens, sequences, coalesce(round(t::DOUBLE / nullif(sequences * 2048, 0), 6), 0) AS efficiency FROM total",
    "a29_manifest": f"""{TOK_DOCS}, x AS (SELECT *, {three_way("coalesce(nullif(metadata['provenance_group_id'], ''), id)")} AS split, sha256(id || chr(0) || sha256(id) || chr(0)) AS h FROM d)
        SELECT count(*) AS documents, sum(tokens)::BIGINT AS tokens, count(DISTINCT source_id) AS sources, count(DISTINCT category) AS categories,
        {', '.join(f"coalesce(sum(tokens) FILTER (split = '{x}'), 0)::BIGINT AS {x}_tokens" for x in ('train', 'validation', 'heldout'))}, sha256(string_agg(h, '' ORDER BY h)) AS fingerprint FROM x""",
    "a21_diagnostics": """SELECT id AS source_id, category, CASE WHEN coalesce(enabled, false) THEN 'active' WHEN contains(coalesce(license_id, ''), 'NC') THEN 'disabled_license_restriction' ELSE 'disabled_user_config' END AS status,
        CASE WHEN coalesce(enabled, false) THEN 'verified_active' WHEN contains(coalesce(license_id, ''), 'NC') THEN 'license_non_commercial_restriction' ELSE 'disabled_user_config' END AS classification, coalesce(enabled, false) AS active FROM source_config""",
    "a30_readiness": f"WITH {READY} SELECT * EXCLUDE (benchmark_samples) FROM v",
    "a30_readiness_reverse": f"WITH {READY} SELECT * FROM v",
    "f15_preflight": f"""{TOK_DOCS}, h AS (SELECT source_id, sum(tokens) AS t FROM d GROUP BY 1), c AS (SELECT sum(coalesce(nullif(source_token_cap, 0), 600000)) AS cap, sum(least(coalesce(nullif(source_token_cap, 0), 600000), coalesce(t, 0))) AS reach
        FROM source_config s LEFT JOIN h ON s.id = h.source_id), w AS (SELECT unnest({arr([*V.CATEGORIES[:9], 'robotics'])}) AS category), g AS (SELECT category, sum(tokens) AS t FROM d GROUP BY 1)
        SELECT 'source_caps' AS rule, cap::VARCHAR AS value FROM c WHERE cap < 600000 UNION ALL SELECT 'eligible_tokens', reach::VARCHAR FROM c WHERE reach < 588000
        UNION ALL SELECT 'category_floor', w.category FROM w LEFT JOIN g ON w.category = g.category WHERE coalesce(t, 0) < 30000""",
    "f16_violations": f"""{TOK_DOCS}, n AS (SELECT sum(tokens)::DOUBLE AS n FROM d), w AS (SELECT unnest({arr(V.CATEGORIES)}) AS category), g AS (SELECT category, sum(tokens) AS t FROM d GROUP BY 1)
        SELECT 'token_tolerance' AS rule, n::BIGINT::VARCHAR AS value FROM n WHERE n < 196000 OR n > 204000
        UNION ALL SELECT 'source_share', source_id FROM d, n GROUP BY source_id, n HAVING round(sum(tokens) / n, 4) > 0.05::DOUBLE + 0.0001::DOUBLE
        UNION ALL SELECT 'category_share', w.category FROM w LEFT JOIN g ON w.category = g.category, n WHERE abs(coalesce(round(t / n, 4), 0) - 0.1::DOUBLE) > 0.05::DOUBLE
        UNION ALL SELECT 'duplicate_id', id FROM d GROUP BY id HAVING count(*) > 1 UNION ALL SELECT 'duplicate_content', sha256({squeeze('text')}) FROM d GROUP BY 2 HAVING count(*) > 1""",
    "f17_batch_problems": f"WITH {CURRENT}, {STREAM}, q AS (SELECT unnest(range(sequences)) AS sequence FROM total) SELECT sequence, CASE sequence % 7 WHEN 1 THEN 'length' WHEN 2 THEN 'token_range' ELSE 'no_labels' END AS problem FROM q WHERE sequence % 7 IN (1, 2, 3)",
    "w10_pack_stream": f"""WITH {CURRENT}, {STREAM}, o AS (SELECT id, w, sum(size) OVER (ORDER BY id) - size AS begin FROM m),
        x AS (SELECT begin + unnest(range(len(w) + 1)) AS pos, unnest(list_append(list_transform(w, lambda z: ({hexnum('z', 1, 8)} % 100000)::BIGINT), 0::BIGINT)) AS token FROM o),
        y AS (SELECT (pos // 2048)::BIGINT AS sequence, string_agg(token::VARCHAR, ',' ORDER BY pos) AS ids, count(*) AS n FROM x GROUP BY 1)
        SELECT sequence, md5(ids || repeat(',0', 2048 - n)) AS ids_md5, (2048 - n)::INT AS padding FROM y""",
    "d6_components": f"""WITH RECURSIVE {CURRENT}, l AS (SELECT DISTINCT 's:' || source_id AS u, 'c:' || c || '/' || license_id AS v FROM (SELECT source_id, license_id, unnest(related_concepts) AS c FROM docs)),
        e AS (SELECT u, v FROM l WHERE u IS NOT NULL AND v IS NOT NULL UNION SELECT v, u FROM l WHERE u IS NOT NULL AND v IS NOT NULL), n AS (SELECT u AS node FROM l WHERE u IS NOT NULL AND v IS NOT NULL UNION SELECT v FROM l WHERE v IS NOT NULL),
        reach AS (SELECT node AS root, node FROM n UNION SELECT root, v FROM reach JOIN e ON node = u) SELECT node, min(root) AS component FROM reach GROUP BY node""",
    "d8_near_duplicates": f"{NEAR} SELECT * FROM near",
    "split_clusters": f"{NEAR} SELECT id, cluster, CASE WHEN {score64(KEY42)} < 0.95::DOUBLE THEN 'train' ELSE 'validation' END AS split FROM near",
    "d12_cross_editions": f"""{near_sql(BY_CRAWL)}, t AS (SELECT id, source_id, text, {tokens('text')} AS tokens FROM docs),
        g AS (SELECT sha256(text) AS key, count(*) AS documents, (sum(tokens) - max(tokens))::BIGINT AS tokens_saved FROM t GROUP BY 1 HAVING count(DISTINCT source_id) = 2),
        c AS (SELECT cluster AS key, count(*) AS documents, coalesce(sum(tokens) FILTER (NOT kept), 0)::BIGINT AS tokens_saved FROM near JOIN t USING (id) GROUP BY 1 HAVING count(DISTINCT source_id) = 2)
        SELECT 'text' AS kind, * FROM g UNION ALL SELECT 'cluster', * FROM c""",
}
