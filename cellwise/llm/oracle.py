"""SQL equivalents of the numbered queries, where SQL can express them."""

from __future__ import annotations

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = """
WITH sized AS (
  SELECT source, sum(length(text)) AS size FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN size > 0 THEN sum(size) OVER () / count(*) FILTER (size > 0) OVER () / size END AS mean FROM sized),
steps AS (
  SELECT source, mean, greatest(1, ceil(mean / 32))::INT AS draws FROM rates),
terms AS (
  SELECT source, k, sum(exp(k * ln(mean / draws) - mean / draws - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS upto
  FROM steps, generate_series(0, 160) AS t(k) WHERE mean > 0),
drawn AS (
  SELECT d.*, s.mean, j, ('0x' || substr(md5('42:' || coalesce(doc_id::VARCHAR, 'null') || ':' || j), 1, 13))::BIGINT / 4503599627370496 AS u
  FROM documents d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source, unnest(generate_series(1, s.draws)) AS t(j)),
counted AS (
  SELECT doc_id, text, lang, source, n_chars, sum(CASE WHEN mean IS NULL THEN 1 ELSE
    (SELECT count(*) FROM terms t WHERE t.source IS NOT DISTINCT FROM drawn.source AND u >= upto) END)::INT AS n_copies
  FROM drawn GROUP BY ALL)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, n_copies,
  md5('42 order:' || coalesce(doc_id::VARCHAR, 'null') || ':' || copy) AS shuffle_key
FROM counted, unnest(generate_series(1, n_copies)) AS t(copy)
"""

OP5 = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
wb AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS n, array_to_string(ws[i:i + least(len(ws), 13) - 1], ' ') AS w
  FROM b, unnest(generate_series(1, len(ws) - least(len(ws), 13) + 1)) AS t(i) WHERE len(ws) > 0),
wd AS (
  SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS w
  FROM d, (SELECT DISTINCT n FROM wb), unnest(generate_series(1, len(ws) - n + 1)) AS t(i)),
hits AS (SELECT doc_id, i, n, item_id FROM wd JOIN wb USING (n, w)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM hits, unnest(generate_series(i, i + n - 1)) AS t(p) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS list
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"

OP6 = rf"""
WITH p AS (
  SELECT page_id, url, url LIKE '%://%' AS whole,
    translate(regexp_extract(coalesce(url, ''), '{_PARTS}', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '{_PARTS}', 2) AS path, regexp_extract(coalesce(url, ''), '{_PARTS}', 3) AS query FROM pages),
q AS (
  SELECT *, list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)='))) AS args FROM p),
k AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '/+$', '')
    || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END AS key FROM q),
r AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule FROM k)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN whole AND key IN (SELECT key FROM k WHERE whole AND regexp_matches(url, '(?i)://([^/?#]*[.])?spam')) THEN 'block'
  ELSE 'allow' END AS verdict
FROM r
"""

OP7 = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS w
  FROM d, unnest(generate_series(1, greatest(1, len(ws) - 4))) AS t(i) WHERE len(ws) > 0),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.w = y.w AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id
FROM d LEFT JOIN size USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = d.doc_id
"""


def _spans(kind: str, order: int, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""SELECT doc_id, '{kind}' AS kind, {order} AS o, e - m AS s, e FROM (
      SELECT doc_id, m, g, sum(gap + m) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
        SELECT doc_id, i, length(ms[i]) AS m, length(gs[i]) AS g, length(gaps[i]) AS gap FROM (
          SELECT doc_id, regexp_extract_all(text, '{pattern}', 0) AS ms, regexp_extract_all(text, '{pattern}', {group}) AS gs,
            string_split_regex(text, '{pattern}') AS gaps FROM documents), unnest(generate_series(1, len(ms))) AS t(i)))
      WHERE g >= {least}"""


def op9(rules, base) -> str:
    each = "\nUNION ALL ".join(_spans(r.kind, i, r.pattern, r.group, r.least) for i, r in enumerate(rules))
    own = ", ".join(f"'{r.kind}'" for r in base)
    counts = ", ".join(f"count(kind) FILTER (kind = '{r.kind}')::BIGINT AS n_{r.kind}" for r in base)
    one = "kind || ':' || s || ':' || e"
    return f"""WITH found AS ({each})
SELECT d.doc_id, {counts},
  sha256(coalesce(string_agg({one}, ',' ORDER BY s, o) FILTER (kind IN ({own})), '')) AS base_sha256,
  coalesce(string_agg({one}, ',' ORDER BY s, o), '') AS spans
FROM documents d LEFT JOIN found USING (doc_id) GROUP BY d.doc_id"""


def _all() -> dict[str, str]:
    from cellwise.llm import secrets

    return {"op3_mixture": OP3, "op5_decontaminate": OP5, "op6_url_filter": OP6, "op7_jaccard_join": OP7, "op9_secrets": op9(secrets.RULES, secrets.BASE)}


ORACLE: dict[str, str] = _all()


def _codes_sql(rounds: int = 6) -> str:
    """Integer k-means by parts, one round after the other."""
    steps = [
        "k as materialized (select vec_id, label, list_transform(embedding, lambda x: floor(4096*x::double)::bigint) as x from embeddings"
        " where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
        "p as materialized (select vec_id, part, list_slice(x, part*(len(x)//8) + 1, (part + 1)*(len(x)//8)) as v from k, range(8) t(part))",
        "b0 as materialized (select part, row_number() over (partition by part order by vec_id) - 1 as e, v from p"
        " where vec_id in (select vec_id from k order by vec_id limit 16))",
    ]
    for r in range(rounds + 1):
        distance = "list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2])*(z[1] - z[2])))::bigint"
        steps.append(f"d{r} as (select vec_id, p.part, p.v, b.e, {distance} as d from p join b{r} b on p.part = b.part)")
        steps.append(f"a{r} as materialized (select vec_id, part, any_value(v) as v, arg_min(e, (d, e)) as e, min(d) as d from d{r} group by vec_id, part)")
        if r < rounds:
            steps.append(f"m{r} as (select part, e, pos, floor(sum(x)::double/count(*))::bigint as x from (select part, e, unnest(v) as x, unnest(range(len(v))) as pos from a{r}) group by all)")
            steps.append(f"n{r} as (select part, e, list(x order by pos) as v from m{r} group by part, e)")
            steps.append(f"b{r + 1} as materialized (select b.part, b.e, coalesce(n.v, b.v) as v from b{r} b left join n{r} n on n.part = b.part and n.e = b.e)")
    steps.append(f"c as (select vec_id, string_agg(format('{{:02x}}', e), '' order by part) as code, sum(d)::bigint as error from a{rounds} group by vec_id)")
    steps.append(f"h as (select sha256(string_agg(x::varchar, ',' order by part, e, pos)) as codebooks_sha256 from (select part, e, unnest(v) as x, unnest(range(len(v))) as pos from b{rounds}))")
    return (
        f"with {', '.join(steps)} select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256"
        " from c join k using (vec_id), h"
    )


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLE["op11_vector_codes"] = _codes_sql()
ORACLE["op13_lexical_search"] = (
    f"with q as (select item_id, unnest({_TERMS}) as term from benchmark), d as (select doc_id, unnest({_TERMS}) as term from documents),"
    " n as (select doc_id, count(*) as n from d group by doc_id), s as (select count(*) as docs, sum(n)::bigint as words from n),"
    " tf as (select doc_id, term, count(*) as tf from d where term in (select term from q) group by all),"
    " w as (select term, floor(1000*ln((2*docs + 2)/(2*count(*) + 1)))::bigint as w from tf, s group by term, docs),"
    " sc as (select item_id, doc_id, sum(w*((1000000000*tf)//(1000*tf + 8*(25 + (75*n*docs)//words))))::bigint as score"
    " from q join tf using (term) join w using (term) join n using (doc_id), s group by item_id, doc_id)"
    " select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score from sc where score > 0"
    " qualify rank <= 10"
)
