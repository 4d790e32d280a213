"""The operators' queries as SQL for DuckDB, brute force where the operator is not."""

from __future__ import annotations

from .license_scan import ALL_TEMPLATES, NO_LINE, PHRASES, SPAN, TELLING, family
from .quality import BOILERPLATE, NAVIGATION, TERMINAL, UNSPACED

#: Dated entries (list, rule, blocks, adds, day of 2024).
URL_ENTRIES = (
    ("abuse", "spam-farm.example.org", True, True, 40),
    ("abuse", "example.net", True, True, 100),
    ("abuse", "example.net", True, False, 130),
    ("abuse", "example.net", True, True, 300),
    ("partners", "example.com", False, True, 0),
    ("partners", "example.com", False, False, 200),
    ("partners", "example.org", False, True, 150),
)

WORD = r"[^\x20\x09-\x0D]+"

def _op1_sql() -> str:
    sets = ", ".join("({}, '{}', '{}', [{}], '{}')".format(k, label, family(label), ", ".join(f"'{w}'" for w in sorted(set(notice.split()))), TELLING.get(label, "")) for k, (label, notice) in enumerate(ALL_TEMPLATES))
    marks = " ".join(
        "WHEN " + " AND ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split(), 1)) + f" THEN '{label}'" for phrase, label in PHRASES
    )
    return rf"""
WITH t(k, label, family, notice, telling) AS (VALUES {sets}),
d AS (SELECT doc_id, coalesce(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d),
p AS (SELECT doc_id, i, CASE {marks} END AS label FROM (SELECT doc_id, ws, unnest(range(len(ws))) AS i FROM w)),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, list_sort(list_distinct(list(label))) AS labels
         FROM p WHERE label IS NOT NULL GROUP BY doc_id),
blocks AS (SELECT doc_id, block_no, regexp_extract_all(block, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
           FROM (SELECT doc_id, unnest(string_split_regex(text, '{NO_LINE}')) AS block, generate_subscripts(string_split_regex(text, '{NO_LINE}'), 1) AS block_no FROM d)),
near AS (SELECT doc_id, block_no, ws, t.* FROM blocks, t WHERE len(ws) > 0 AND len(list_intersect(ws, notice)) >= 0.85 * len(notice) - 1e-9),
m AS (SELECT doc_id, block_no, k, label, family, notice, telling, unnest(CASE WHEN len(ws) <= {SPAN} * len(notice) THEN [ws]
        ELSE [ws[i:i + {SPAN} * len(notice) - 1] FOR i IN range(1, len(ws) + 1) IF list_contains(notice, ws[i])] END) AS part FROM near),
hits AS (SELECT doc_id, block_no, k, label, family, max(len(list_intersect(part, notice)) / len(notice)::DOUBLE) AS c, max(regexp_matches(' ' || array_to_string(part, ' ') || ' ', telling)::INT) AS told
         FROM m WHERE len(list_intersect(part, notice)) >= 0.85 * len(notice) - 1e-9 GROUP BY doc_id, block_no, k, label, family),
best AS (SELECT *, max(told) OVER f AS any_told, max(c) OVER f AS most FROM hits WINDOW f AS (PARTITION BY doc_id, block_no, family)),
found AS (SELECT doc_id, list_distinct(list(label) FILTER (told = 1 OR (any_told = 0 AND c = most))) AS labels, max(c) AS c, count(*) AS matches FROM best GROUP BY doc_id)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(array_to_string(base.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
       CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(found.c, 0.0) END::DOUBLE AS score, coalesce(matches, 0)::BIGINT AS n_matches
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)"""


def _op3_sql() -> str:
    fixed = ", ".join(f"('{a}', '{b}', {c}, {d}, {e})" for a, b, c, d, e in URL_ENTRIES)
    return rf"""
WITH pg AS (SELECT page_id, url, (DATE '2024-01-01' + ((page_id * 37) % 366)::INT)::DATE AS fetched,
            nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '') AS host,
            regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS seg FROM pages),
hosts AS (SELECT DISTINCT host AS rule FROM pg WHERE host IS NOT NULL),
crc AS (SELECT rule, ('0x' || substr(md5(rule), 1, 8))::BIGINT AS c FROM hosts),
listed AS (SELECT 'hosts' AS list, rule, true AS blocks, true AS adds, (c % 300)::INT AS day FROM crc WHERE c % 11 = 0
           UNION ALL SELECT 'hosts', rule, true, false, (c % 300 + 120)::INT FROM crc WHERE c % 11 = 0 AND c % 2 = 0
           UNION ALL VALUES {fixed}),
e AS (SELECT list, rule, blocks, adds, (DATE '2024-01-01' + day)::DATE AS since, lead((DATE '2024-01-01' + day)::DATE) OVER (PARTITION BY list, rule ORDER BY day, adds) AS upto FROM (SELECT DISTINCT * FROM listed)),
k AS (SELECT page_id, url, fetched, unnest(list_distinct(list_concat(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
      CASE WHEN seg <> '' THEN [host || '/' || seg] ELSE [] END))) AS rule FROM pg WHERE host IS NOT NULL),
m AS (SELECT page_id, url, count(*) AS n, max(row(length(rule), blocks, rule)) AS top FROM k JOIN e USING (rule)
      WHERE adds AND since <= fetched AND (upto IS NULL OR fetched < upto) GROUP BY page_id, url)
SELECT pg.page_id, pg.url, host, strftime(fetched, '%Y-%m-%d') AS fetched, coalesce(n, 0)::BIGINT AS n_active,
       CASE WHEN n IS NULL THEN 'none' WHEN top[2] THEN 'block' ELSE 'allow' END AS verdict, top[3] AS rule
FROM pg LEFT JOIN m USING (page_id, url)"""


_OP5_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5('mix' || doc_id) AS shuffle FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM s),
r AS (SELECT *, cap / weight AS ratio, sum(source_size) OVER ()::BIGINT * 1.5::DOUBLE AS budget FROM w),
l AS (SELECT *, (budget - sum(cap) OVER o + cap) / (sum(weight) OVER () - sum(weight) OVER o + weight) AS level FROM r
      WINDOW o AS (ORDER BY ratio, source NULLS LAST)),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, ratio) FROM l WHERE level <= ratio) * weight, cap)) AS target FROM l),
c AS (SELECT d.*, source_size, target, sum(size) OVER (PARTITION BY d.source ORDER BY shuffle, size) AS done
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source WHERE size > 0),
y AS (SELECT *, (copy * source_size + done) / target AS finish FROM (SELECT *, unnest([0, 1]) AS copy FROM c)),
z AS (SELECT *, sum(size) OVER (ORDER BY finish, source NULLS FIRST, shuffle, copy) - size AS pos, (SELECT floor(sum(size) * 1.5::DOUBLE) FROM d)::BIGINT AS budget FROM y),
x AS (SELECT doc_id, min(pos) AS mix_start, sum(least(size, budget - pos)) AS taken FROM z WHERE pos < budget GROUP BY doc_id)
SELECT d.doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken, mix_start::BIGINT AS mix_start
FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN x USING (doc_id)"""

_OP4_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i + 1:i + 13], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 12)) AS i FROM d WHERE len(ws) >= 13)),
f AS (SELECT g, min(doc_id) AS least FROM w GROUP BY g),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM (SELECT doc_id, i, unnest(range(13)) AS k FROM w JOIN f USING (g) WHERE doc_id > least)),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept
      FROM (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM d) ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)"""



def _op7_sql() -> str:
    quoted = lambda x: x.replace("'", "''")
    inner = r"0-9a-z\x{80}-\x{10FFFF}"
    whole = lambda p: rf"regexp_matches(low, '(?:^|[^{inner}]){p}(?:$|[^{inner}])')"
    unspaced = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in UNSPACED)
    notices, menu = " OR ".join(map(whole, BOILERPLATE)), " + ".join(f"CASE WHEN {whole(p)} THEN {p.count(' ') + 1} ELSE 0 END" for p in NAVIGATION)
    n = lambda pattern: f"len(regexp_extract_all(line, '{pattern}'))"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
g AS (SELECT doc_id, i, ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] AS g FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 2)) AS i FROM d WHERE len(ws) >= 3)),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(3)) AS k FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS line_no FROM d),
l AS (SELECT *, lower(line) AS low, regexp_extract_all(line, '{WORD}') AS lw, row_number() OVER (PARTITION BY doc_id, line ORDER BY line_no) > 1 AS dup FROM s),
m AS (SELECT *, len(lw) AS n, len(lw) + {n(f"[{unspaced}]")} // 2 AS size, right(lw[len(lw)], 1) AS last FROM l WHERE len(lw) > 0),
f AS (SELECT doc_id, n, dup,
        dup OR ((NOT contains('{quoted(TERMINAL)}', last) OR last = '…' OR regexp_matches(line, '\.\.\.[\x20\x09-\x0D]*$')) AND size < 10)
        OR {n("[#*$%&|<>]")} > 0.25 * size OR {n("[|]")} > 0.15 * size OR {n("!")} > 0.5 * size OR (({notices}) AND size < 20)
        OR ({menu} > 0 AND 2 * ({menu}) >= n)
        OR ({n("[A-Z]")} > 0.6 * {n("[A-Za-z]")} AND {n("[A-Za-z]")} >= 10 AND size < 20)
        OR len(list_filter(lw, lambda x: regexp_matches(x, '[0-9]') AND NOT regexp_matches(x, '[A-Za-z\x{{80}}-\x{{10FFFF}}]'))) > 0.5 * n
        OR len(list_filter(range(1, n), lambda i: lw[i] = lw[i + 1])) > 0.3 * size AS fails FROM m),
t AS (SELECT doc_id, sum(CASE WHEN dup THEN 1 ELSE 0 END) AS dups, sum(CASE WHEN fails THEN n ELSE 0 END) AS lost FROM f GROUP BY doc_id),
o AS (SELECT d.doc_id, len(ws)::BIGINT AS n_words, len(array_to_string(ws, ''))::BIGINT AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
        coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_lost_words
      FROM d LEFT JOIN r USING (doc_id) LEFT JOIN t USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_lost_words <= 0.5 * n_words AS kept FROM o"""


#: Components of the links l(a, b) among the nodes n(id), and each node's number of links.
_COMPONENTS = """e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(id, reached) AS (SELECT id, id FROM n UNION SELECT e.a, r.reached FROM r JOIN e ON e.b = r.id),
c AS (SELECT id, min(reached) AS component FROM r GROUP BY id),
k AS (SELECT a AS id, count(*) AS links FROM e GROUP BY a)"""

_OP8_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{WORD}'), []) AS ws FROM documents),
g AS (SELECT DISTINCT doc_id AS id, array_to_string(ws[i + 1:i + 5], ' ') AS gram FROM (SELECT doc_id, ws, unnest(range(0, greatest(len(ws) - 4, 1))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT id, count(*) AS size FROM g GROUP BY id),
pairs AS (SELECT x.id AS a, y.id AS b, count(*) AS common FROM g x JOIN g y ON x.gram = y.gram AND x.id < y.id GROUP BY x.id, y.id),
l AS (SELECT a, b FROM pairs JOIN n x ON x.id = a JOIN n y ON y.id = b WHERE common >= 0.8 * (x.size + y.size - common) - 1e-9),
{_COMPONENTS}
SELECT doc_id, coalesce(component, doc_id) AS group_id, coalesce(links, 0)::BIGINT AS n_links, coalesce(component, doc_id) = doc_id AS kept
FROM d LEFT JOIN c ON c.id = doc_id LEFT JOIN k ON k.id = doc_id"""

_OP9_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id AS id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
n AS (SELECT id FROM v),
l AS (SELECT p.id AS a, q.id AS b FROM v p JOIN v q ON p.label = q.label AND len(p.x) = len(q.x) AND p.id < q.id WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
{_COMPONENTS}
SELECT vec_id, coalesce(links, 0)::BIGINT AS n_links, coalesce(component, vec_id) AS component_id, coalesce(component, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON c.id = vec_id LEFT JOIN k ON k.id = vec_id"""

_OP11_SQL = rf"""
WITH f(x, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM f a, f b, f c, f d, f e
      WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, k::INT AS step, bits[k] AS bit, coalesce(list_sum(bits[:k - 1]), 0)::INT AS before FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS k FROM o)),
d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
m AS (SELECT doc_id, part, CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
        + CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * len(text) THEN 4 ELSE 0 END + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
        + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 16 ELSE 0 END AS mask FROM d),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic FROM m LEFT JOIN l USING (doc_id) GROUP BY part, mask),
r AS (SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant, sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM c, s GROUP BY part, filter_order, step, bit)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM r"""

#: All pages of the tables mark their text as the one article, of h1, p, b and br.
_OP12_SQL = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') AS body FROM pages),
b AS (SELECT page_id, url, list_transform(string_split_regex(body, '</?(?:h1|p)>'), lambda x: trim(regexp_replace(regexp_replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '\s+', ' ', 'g'))) AS parts FROM a),
t AS (SELECT page_id, url, coalesce(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10) || chr(10)), '') AS text FROM b)
SELECT page_id, url, text, len(text)::BIGINT AS n_chars FROM t"""

_OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS ws, sha256('1:' || doc_id) AS h FROM documents),
x AS (SELECT doc_id, text, ws, len(ws)::BIGINT AS n, [('0x' || substr(h, 8 * k + 1, 8))::BIGINT FOR k IN range(4)] AS h FROM d),
c AS (SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS lo, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS hi,
        CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT doc_id, text, n, form, coalesce(array_to_string(ws[1:lo], ''), '') AS prefix, coalesce(array_to_string(ws[lo + 1:hi], ''), '') AS middle, coalesce(array_to_string(ws[hi + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN len(prefix)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN len(middle)::BIGINT END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM p"""

ORACLE_SQL: dict[str, str] = {
    "op1_license_scan": _op1_sql(),
    "op3_url_filter": _op3_sql(),
    "op4_substring_dedup": _OP4_SQL,
    "op5_mixing": _OP5_SQL,
    "op7_quality_rules": _op7_sql(),
    "op8_ngram_join": _OP8_SQL,
    "op9_embedding_dedup": _OP9_SQL,
    "op11_filter_audit": _OP11_SQL,
    "op12_html_extraction": _OP12_SQL,
    "op13_fill_in_middle": _OP13_SQL,
}
