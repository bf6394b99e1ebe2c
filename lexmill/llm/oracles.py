"""DuckDB SQL with the results that the queries must give."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+')"

OP1 = f"""
WITH RECURSIVE w AS MATERIALIZED (SELECT doc_id, {_WORDS} AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i+3], ' '))) END AS hs FROM w),
n AS MATERIALIZED (SELECT doc_id, len(hs)::BIGINT AS n FROM s),
x AS MATERIALIZED (SELECT doc_id, unnest(hs) AS h FROM s),
p AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS MATERIALIZED (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
both_ways AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
r AS (SELECT doc_id AS v, doc_id AS u FROM n UNION SELECT r.v, both_ways.b FROM r JOIN both_ways ON r.u = both_ways.a)
SELECT n.doc_id, n.n AS n_shingles, m.c AS component_id, n.doc_id = m.c AS kept
FROM n JOIN (SELECT v, min(u) AS c FROM r GROUP BY v) m ON m.v = n.doc_id
"""

OP2 = """
WITH u AS (SELECT page_id, CASE WHEN url IS NULL OR strpos(url, '://') = 0 THEN '' ELSE substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT row_number() OVER () AS r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
rules(verdict, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT r, arg_max(rh || rp, 1000 * length(rh || rp) + length(rh)) AS rule, arg_max(verdict, 1000 * length(rh || rp) + length(rh)) AS verdict
  FROM p JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY r)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fits USING (r)
"""

#: A stretch of 13 tokens with two substitutions, or a short item with one, holds four equal tokens in a row: these give the diagonals.
OP4 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
t AS MATERIALIZED (SELECT row_number() OVER () AS i, item_id, {_WORDS} AS ws FROM benchmark),
dg AS MATERIALIZED (SELECT r, p, array_to_string(ws[p:p+3], ' ') AS g FROM (SELECT r, ws, unnest(range(1, len(ws) - 2)) AS p FROM d)),
tg AS MATERIALIZED (SELECT i, p, array_to_string(ws[p:p+3], ' ') AS g FROM (SELECT i, ws, unnest(range(1, len(ws) - 2)) AS p FROM t WHERE len(ws) >= 8)),
g AS MATERIALIZED (SELECT DISTINCT r, i, dg.p - tg.p AS diagonal FROM dg JOIN tg USING (g)),
aligned AS (
  SELECT r, i, diagonal, len(t.ws) AS n, d.ws AS dw, t.ws AS tw, unnest(range(greatest(0, diagonal), least(len(d.ws), diagonal + len(t.ws)))) AS pos FROM g JOIN d USING (r) JOIN t USING (i)),
same AS MATERIALIZED (SELECT r, i, diagonal, n, pos, (dw[pos + 1] = tw[pos - diagonal + 1])::INTEGER AS s FROM aligned),
starts AS (
  SELECT *, CASE WHEN n < 13 THEN count(*) OVER (PARTITION BY r, i, diagonal) = n AND sum(1 - s) OVER (PARTITION BY r, i, diagonal) <= 1
    ELSE count(*) OVER ahead = 13 AND sum(1 - s) OVER ahead <= 2 END AS good
  FROM same WINDOW ahead AS (PARTITION BY r, i, diagonal ORDER BY pos ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING)),
inside AS (SELECT *, bool_or(good) OVER (PARTITION BY r, i, diagonal ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) AS covers FROM starts),
found AS (
  SELECT r, i, diagonal, min(pos) AS doc_start, max(pos) + 1 AS doc_end, count(*) AS covered, sum(s) AS matched FROM inside WHERE covers GROUP BY r, i, diagonal
  UNION ALL SELECT r, i, 0, 0, len(t.ws), len(t.ws), len(t.ws) FROM t JOIN d ON d.ws = t.ws WHERE len(t.ws) BETWEEN 1 AND 7)
SELECT doc_id, item_id, doc_start::BIGINT AS doc_start, doc_end::BIGINT AS doc_end, covered::BIGINT AS covered, matched::BIGINT AS matched
FROM (SELECT *, row_number() OVER (PARTITION BY r, i ORDER BY covered DESC, matched DESC, doc_start, diagonal) AS k FROM found) JOIN d USING (r) JOIN t USING (i) WHERE k = 1
"""

OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

#: Texts as hexadecimal digits, two for each byte.
OP6 = """
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
long AS MATERIALIZED (SELECT r, s, md5(substr(x, 2 * s + 1, 800)) AS h FROM (SELECT r, x, unnest(range(0, len(x) // 2 - 399)) AS s FROM d)),
again AS (SELECT r, s FROM long SEMI JOIN (SELECT h FROM long GROUP BY h HAVING count(*) > 1) USING (h)),
cut AS (
  SELECT r, min(s) AS b, max(s) + 400 AS e FROM (SELECT r, s, sum(apart) OVER (PARTITION BY r ORDER BY s) AS k
    FROM (SELECT r, s, coalesce((s - lag(s) OVER (PARTITION BY r ORDER BY s) > 400)::INTEGER, 0) AS apart FROM again)) GROUP BY r, k),
gone AS (
  SELECT r, sum(e - b)::BIGINT AS n, count(*) AS spans, string_agg(substr(x, 2 * done + 1, 2 * (b - done)), '' ORDER BY b) || substr(any_value(x), 2 * max(e) + 1) AS kept
  FROM (SELECT r, b, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY b), 0) AS done FROM cut) JOIN d USING (r) GROUP BY r),
brief AS MATERIALIZED (SELECT r, s, md5(substr(x, 2 * s + 1, 512)) AS h FROM (SELECT r, x, unnest(range(0, len(x) // 2 - 255)) AS s FROM d)),
shared AS (SELECT r, s FROM brief SEMI JOIN (SELECT h FROM brief GROUP BY h HAVING min(r) < max(r)) USING (h)),
runs AS (
  SELECT r, min(s) AS b, max(s) + 256 AS e FROM (SELECT r, s, sum(apart) OVER (PARTITION BY r ORDER BY s) AS k
    FROM (SELECT r, s, coalesce((s - lag(s) OVER (PARTITION BY r ORDER BY s) > 256)::INTEGER, 0) AS apart FROM shared)) GROUP BY r, k),
worded AS (
  SELECT r, e - b AS n, len(regexp_extract_all(array_to_string(list_transform(regexp_extract_all(substr(x, 2 * b + 1, 2 * (e - b)), '..'), lambda c: CASE WHEN c IN ('20', '09', '0A', '0B', '0C', '0D') THEN ' ' ELSE 'x' END), ''), 'x+')) AS words
  FROM runs JOIN d USING (r)),
passages AS (SELECT r, sum(n)::BIGINT AS n, count(*) AS passages FROM worded WHERE words >= 50 GROUP BY r)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(gone.n, 0) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, x))) AS kept_sha256, coalesce(passages.n, 0) AS n_shared, coalesce(passages, 0) AS n_passages
FROM d LEFT JOIN gone USING (r) LEFT JOIN passages USING (r)
"""


def _op7(rounds: int = 12, temper: float = 0.7, keep: float = 0.5, seed: int = 7) -> str:
    ctes = [
        rf"""d AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
          CASE WHEN length(coalesce(text, '')) = 0 THEN 'empty' WHEN contains(text, 'Licens') OR contains(text, 'Copyright') THEN 'licence' WHEN contains(text, ' | ') THEN 'table'
            WHEN contains(text, '@') THEN 'contact' WHEN length(text) < 600 THEN 'short' ELSE 'prose' END AS topic,
          len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens FROM documents)""",
        "c AS MATERIALIZED (SELECT source, lang, topic, sum(greatest(n_tokens, 1))::DOUBLE AS tokens FROM d GROUP BY ALL)",
        "w0 AS MATERIALIZED (SELECT source, lang, topic, tokens, tokens / sum(tokens) OVER () AS w FROM c)",
    ]
    margins = ("source", "lang", "topic")
    for m in margins:
        ctes.append(f"g_{m} AS MATERIALIZED (SELECT {m}, g / sum(g) OVER () AS g FROM (SELECT {m}, pow(sum(tokens) / (SELECT sum(tokens) FROM c), {temper}) AS g FROM c GROUP BY {m}))")
    k = 0
    for _ in range(rounds):
        for m in margins:
            ctes.append(f"w{k + 1} AS MATERIALIZED (SELECT a.source, a.lang, a.topic, a.tokens, a.w * g.g / sum(a.w) OVER (PARTITION BY a.{m}) AS w FROM w{k} a JOIN g_{m} g ON g.{m} = a.{m})")
            k += 1
    ctes.append(f"r AS MATERIALIZED (SELECT source, lang, topic, tokens, w / tokens AS r, sum(tokens) OVER () * {keep} AS goal FROM w{k})")
    # with the cells from the largest r down to before this one taken whole, c is what the others need
    ctes.append("o AS MATERIALIZED (SELECT *, (goal - coalesce(sum(tokens) OVER up, 0)) / sum(tokens * r) OVER down AS c FROM r WINDOW up AS (ORDER BY r DESC, source, lang, topic ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), down AS (ORDER BY r DESC, source, lang, topic ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))")
    ctes.append("p AS MATERIALIZED (SELECT source, lang, topic, round(least(1.0, r * (SELECT arg_max(c, r) FROM o WHERE c * r < 1)), 9) AS p FROM o)")
    draw = f"('0x' || substr(md5('{seed}|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0"
    return "WITH " + ",\n".join(ctes) + f"\nSELECT doc_id, source, lang, topic, n_tokens, p FROM d JOIN p USING (source, lang, topic) WHERE {draw} < p"


_MARKS = r"^(?:[ \t]*>)+"
_NORM = r"trim(lower(regexp_replace({}, '[ \t\r\n]+', ' ', 'g')))"
_RULE = r"(?i)(?:wrote|schrieb|écrit|escribió)[ \t ]*:[ \t]*$"

OP10 = f"""
WITH RECURSIVE m AS MATERIALIZED (SELECT row_number() OVER () AS r, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
l AS MATERIALIZED (
  SELECT r, pos, line, length(regexp_replace(regexp_extract(line, '{_MARKS}'), '[^>]', '', 'g')) AS level
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM m)),
n AS MATERIALIZED (SELECT *, coalesce(lead(level) OVER (PARTITION BY r ORDER BY pos) > 0, false) AS above FROM l),
own AS MATERIALIZED (
  SELECT m.r, CASE WHEN max(n.level) > 0 THEN trim(coalesce(string_agg(n.line, chr(10) ORDER BY n.pos) FILTER (n.level = 0 AND NOT (n.above AND regexp_matches(n.line, '{_RULE}'))), '')) ELSE any_value(m.text) END AS own
  FROM m JOIN n ON n.r = m.r GROUP BY m.r),
q AS MATERIALIZED (
  SELECT r, level, min(pos) AS place, string_agg(regexp_replace(line, '{_MARKS}', ''), ' ' ORDER BY pos) AS body
  FROM (SELECT *, pos - row_number() OVER (PARTITION BY r, level ORDER BY pos) AS island FROM l WHERE level > 0) GROUP BY r, level, island),
passage AS MATERIALIZED (SELECT r, level, place, md5({_NORM.format("body")}) AS h FROM q WHERE {_NORM.format("body")} <> ''),
whole AS (SELECT * FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND role IS NOT NULL),
said AS MATERIALIZED (
  SELECT conv_id, md5({_NORM.format("part")}) AS h, min(turn) AS origin
  FROM (SELECT conv_id, turn, unnest(list_concat([own], list_concat(regexp_split_to_array(own, '\\n[ \\t]*\\n'), string_split(own, chr(10))))) AS part FROM whole JOIN own USING (r))
  WHERE {_NORM.format("part")} <> '' GROUP BY ALL),
found AS MATERIALIZED (
  SELECT DISTINCT w.conv_id, w.turn, p.place, p.level, s.origin FROM whole w JOIN passage p USING (r) JOIN said s ON s.conv_id = w.conv_id AND s.h = p.h AND s.origin < w.turn),
link AS MATERIALIZED (SELECT conv_id, turn, arg_min(origin, level * 1000000000 - origin) AS reply_to, count(DISTINCT place) AS n_linked FROM found GROUP BY ALL),
up AS (
  SELECT conv_id, turn, reply_to AS thread, 1 AS depth FROM link
  UNION ALL SELECT up.conv_id, up.turn, link.reply_to, up.depth + 1 FROM up JOIN link ON link.conv_id = up.conv_id AND link.turn = up.thread),
top AS (SELECT conv_id, turn, min(thread) AS thread, max(depth) AS depth FROM up GROUP BY ALL),
cnt AS (SELECT r, count(*) AS n FROM passage GROUP BY r)
SELECT m.conv_id, m.turn, m.role, CASE WHEN m.role IS NOT NULL THEN link.reply_to END AS reply_to,
  CASE WHEN m.role IS NOT NULL THEN coalesce(top.thread, m.turn) ELSE m.turn END AS thread, CASE WHEN m.role IS NOT NULL THEN coalesce(top.depth, 0) ELSE 0 END::BIGINT AS depth,
  coalesce(cnt.n, 0)::BIGINT AS n_quotes, CASE WHEN m.role IS NOT NULL THEN coalesce(link.n_linked, 0) ELSE 0 END::BIGINT AS n_linked,
  '<|im_start|>' || coalesce(m.role, '') || chr(10) || own.own || '<|im_end|>' AS chat
FROM m JOIN own USING (r) LEFT JOIN link ON link.conv_id = m.conv_id AND link.turn = m.turn LEFT JOIN top ON top.conv_id = m.conv_id AND top.turn = m.turn LEFT JOIN cnt ON cnt.r = m.r
"""

ORACLES: dict[str, str] = {
    "op1_minhash_dedup": OP1,
    "op2_url_filter": OP2,
    "op4_decontaminate": OP4,
    "op5_topk_nra": OP5,
    "op6_substring_dedup": OP6,
    "op7_mixing": _op7(),
    "op10_chat_threads": OP10,
}
