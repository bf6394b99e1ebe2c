"""Registered queries of the core library, each with the DuckDB SQL of its results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .config import BOILERPLATE, COMMON_GATE, COMMON_LIGHT, COMMON_SCORE, DELIBERATION, UNCERTAINTY, BlendParams, MinHashParams
from .functions import metrics as M
from .functions import text as T
from .operators import alerts, blend, dedup, gates, index, profile, sample, select, sft
from .plans.corpus import dedup_quality
from .streaming.incremental import sessions, windowed_counts

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query under its function's name; without SQL the tests check it by brute force."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# --- pieces of SQL ----------------------------------------------------------
_SP = r"[ \t\n\r\f\x0B\x1C-\x1F\x85\p{Z}]"


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '^{_SP}+|{_SP}+$', '', 'g')"


def _count(t: str, p: str) -> str:
    return f"(length({t}) - length(regexp_replace({t}, '{p}', '', 'g')))"


def _words(t: str) -> str:
    return f"list_filter(regexp_split_to_array({t}, '{_SP}+'), lambda w: w <> '')"


def _lines(t: str) -> str:
    return f"list_filter(list_transform(string_split({t}, chr(10)), lambda x: {_strip('x')}), lambda x: x <> '')"


def _letter_words(t: str, letters: str) -> str:
    return rf"list_filter(regexp_extract_all(lower({t}), '[\p{{L}}\p{{N}}_]+'), lambda w: regexp_full_match(w, '[{letters}]+'))"


def _common(words: list[str]) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in dict.fromkeys(words)) + "]"


def _q(s: str) -> str:
    return s.replace("'", "''")


_HASH = "md5(concat_ws('|', '{seed}', {keys}))"


def _order(seed: int, *keys: str) -> str:
    return "md5(concat_ws('|', '" + str(seed) + "', " + ", ".join(f"{k}::VARCHAR" for k in keys) + "))"


def _uniform(seed: int, *keys: str) -> str:
    return f"(('0x' || substr({_order(seed, *keys)}, 1, 13))::BIGINT::DOUBLE / 4503599627370496.0)"


def _tokens(t: Column) -> Column:
    return F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


_N_TOK = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))::BIGINT"


def _indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("doc_idx"), "source", _tokens(F.col("text")).alias("n_tok"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cleaned and gated: kept and rejected by source."""
    return gates.gate_counts(gates.clean_documents(table(spark, sf_dir, "documents")))


# --- cleaning and gates -----------------------------------------------------
_CLEAN0 = rf"regexp_replace(regexp_replace(regexp_replace(text, 'https?://\S+|www\.\S+', ' ', 'g'), '[\w.+-]+@[\w-]+\.[\w.]+', ' ', 'g'), '<[^>]{{1,200}}>', '', 'g')"
_CLEAN1 = f"array_to_string(list_filter(string_split({_CLEAN0}, chr(10)), lambda l: NOT regexp_matches(l, '{_q(BOILERPLATE).replace('(?iu)', '(?i)')}')), chr(10))"
_CLEAN2 = f"translate({_CLEAN1}, '«»“”‘’–—' || chr(160), '\"\"\"\"''''-- ')"
_CLEAN = _strip(rf"regexp_replace(regexp_replace({_CLEAN2}, '[ \t]{{2,}}', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g')")


@query(f"SELECT doc_id, md5({_CLEAN}) AS digest, length({_CLEAN})::INTEGER AS chars FROM documents")
def clean_text(spark, d):
    c = T.clean(F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(c.cast("binary")).alias("digest"), F.length(c).alias("chars"))


def _gate_sql(rel: str) -> str:
    return rf"""
    g0 AS (SELECT *, length(text) AS n, {_count("text", chr(92) + "p{L}")} AS alpha, {_count("text", _SP)} AS space, {_count("text", chr(92) + "p{Nd}")} AS digit,
      {_count("text", chr(92) + "p{Lu}")} AS upper, {_words("text")} AS ws, {_lines("text")} AS ls, {_letter_words("substr(text, 1, 2000)", "a-zàâäéèêëîïôùûüçœæ")} AS fw FROM {rel}),
    g1 AS (SELECT *, list_filter(ws, lambda w: regexp_full_match(w, '\p{{L}}+')) AS aw, n - alpha - space - digit AS other, len(list_filter(fw, lambda w: list_contains({_common(COMMON_GATE)}, w))) / nullif(len(fw), 0) AS fr FROM g0),
    g2 AS (SELECT *, CASE WHEN len(aw) >= 10 THEN list_sum(list_transform(aw, lambda w: length(w))) / len(aw) END AS mean FROM g1),
    gated AS (SELECT *, CASE WHEN n < 300 THEN 'too short' WHEN len(ls) < 3 THEN 'too few lines' WHEN len(ws) < 50 THEN 'too few words' WHEN mean < 3.5 THEN 'short words' WHEN mean > 12.0 THEN 'long words'
      WHEN alpha / n < 1 - 0.12::DOUBLE - 0.15::DOUBLE - 0.15::DOUBLE THEN 'too special' WHEN digit / n > 0.15::DOUBLE THEN 'too many digits' WHEN other / n > 0.12::DOUBLE THEN 'too much punctuation'
      WHEN alpha > 0 AND upper / alpha > 0.15::DOUBLE THEN 'too many capitals' WHEN len(ls) >= 10 AND 1 - len(list_distinct(ls)) / len(ls) > 0.25::DOUBLE THEN 'repeated lines'
      WHEN len(ls) >= 10 AND len(list_filter(ls, lambda x: regexp_matches(x, '^[*#-]'))) / len(ls) > 0.60::DOUBLE THEN 'list'
      WHEN len(fw) >= 20 AND fr < 0.01::DOUBLE THEN 'not French' END AS reason FROM g2)"""


@query(f"WITH {_gate_sql('documents')} SELECT doc_id, reason FROM gated")
def gate_reason(spark, d):
    return gates.with_reason(table(spark, d, "documents").select("doc_id", "source", "text")).select("doc_id", "reason")


@query(f"WITH c AS (SELECT doc_id, source, {_CLEAN} AS text FROM documents), {_gate_sql('c')} SELECT source, count(*) AS total, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason IS NOT NULL) AS rejected FROM gated GROUP BY source")
def clean_and_gate(spark, d):
    return flagship(spark, d)


@query(rf"""
WITH t AS (SELECT doc_id, {_strip("text")} AS text FROM documents),
m AS (SELECT doc_id, length(text) AS n, {_count("text", chr(92) + "p{L}")} AS alpha, {_count("text", _SP)} AS space, {_count("text", chr(92) + "p{Nd}")} AS digit, {_count("text", chr(92) + "p{Lu}")} AS upper,
  len({_words("text")}) AS w, len({_lines("text")}) AS l, {_letter_words("substr(text, 1, 3000)", "a-zà-ÿ")} AS fw FROM t)
SELECT doc_id, n >= 200 AND w >= 30 AND l >= 1 AND digit / n <= 0.18::DOUBLE AND (n - alpha - space - digit) / n <= 0.15::DOUBLE AND (alpha = 0 OR upper / alpha <= 0.20::DOUBLE)
  AND (len(fw) < 10 OR len(list_filter(fw, lambda w: list_contains({_common(COMMON_LIGHT)}, w))) / len(fw) >= 0.05::DOUBLE) AS ok FROM m""")
def light_gate(spark, d):
    return gates.with_light(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "ok")


_SCORE = rf"""
c AS (SELECT doc_id, unnest(string_split(substr(text, 1, 2000), '')) AS ch FROM documents),
cc AS (SELECT doc_id, ch, count(*) AS k FROM c WHERE ch <> '' GROUP BY ALL),
h AS (SELECT doc_id, log2(sum(k)) - sum(k * log2(k)) / sum(k) AS h FROM cc GROUP BY doc_id),
v AS (SELECT doc_id, source, text, {_words("lower(text)")}[1:500] AS ws, {_letter_words("substr(text, 1, 3000)", "a-zàâäéèêëîïôùûüçœæ")} AS fw FROM documents),
s AS (SELECT doc_id, source, text, 0.5 * greatest(0.0, least(1.0, (coalesce(h, 0) - 2.5) / 2.5)) + 0.3 * coalesce(len(list_distinct(ws)) / nullif(len(ws), 0), 0)
  + 0.2 * (CASE WHEN len(fw) >= 5 THEN len(list_filter(fw, lambda w: list_contains({_common(COMMON_SCORE)}, w))) / len(fw) ELSE 0.5 END) AS score FROM v LEFT JOIN h USING (doc_id))"""


@query(f"WITH {_SCORE} SELECT doc_id, round(score, 6) AS score FROM s")
def quality_score(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(M.quality_score(F.col("text")), 6).alias("score"))


@query(f"WITH {_SCORE}, r AS (SELECT *, row_number() OVER (ORDER BY round(score, 6)) - 1 AS i, count(*) OVER () AS n FROM s), t AS (SELECT round(score, 6) AS lim FROM r WHERE i = least(floor(n * (1 - 0.85::DOUBLE)), n - 1)) SELECT doc_id, round(score, 6) AS score FROM s, t WHERE round(score, 6) >= lim")
def top_quality(spark, d):
    scored = table(spark, d, "documents").select("doc_id", F.round(M.quality_score(F.col("text")), 6).alias("score"))
    return select.top_share(scored, "score", 0.85)


@query(rf"""
WITH l AS (SELECT doc_id, {_lines("text")} AS ls, {_words("text")} AS ws, text FROM documents)
SELECT doc_id, round(coalesce(1 - len(list_distinct(ls)) / nullif(len(ls), 0), 0), 6) AS line_repetition, round(coalesce(len(list_filter(ls, lambda x: regexp_matches(x, '^[*#-]'))) / nullif(len(ls), 0), 0), 6) AS list_share,
  len(ws)::INTEGER AS n_words, round(coalesce({_count("text", chr(92) + "p{Lu}")} / nullif({_count("text", chr(92) + "p{L}")}, 0), 0), 6) AS upper_share,
  round({_count("substr(text, 1, 2000)", "[A-Za-z0-9À-ſ" + chr(92) + "s.,;:!?''" + chr(34) + "()" + chr(92) + "-]")} / length(substr(text, 1, 2000)), 6) AS latin FROM l""")
def text_metrics(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.round(M.line_repetition(t), 6).alias("line_repetition"), F.round(M.list_share(t), 6).alias("list_share"), F.size(M.words(t)).alias("n_words"), F.round(M.upper_share(t), 6).alias("upper_share"), F.round(M.latin_share(t), 6).alias("latin"))


_FR = M.FRENCH


@query(rf"""
WITH w AS (SELECT doc_id, unnest({_words("text")}) AS w FROM documents),
c AS (SELECT doc_id, regexp_replace(w, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g') AS c FROM w),
f AS (SELECT doc_id, c, lower(c) AS low, regexp_full_match(c, '\p{{L}}+') AS plain,
  coalesce(list_sum(list_transform(range(1, length(c)), lambda i: (regexp_matches(substr(c, i, 1), '\p{{Lu}}') <> regexp_matches(substr(c, i + 1, 1), '\p{{Lu}}'))::INTEGER)), 0) AS flips FROM c WHERE c <> ''),
s AS (SELECT doc_id, regexp_matches(c, '\p{{L}}') AND (regexp_matches(regexp_replace(c, '[{_FR}]', '', 'g'), '\p{{L}}') OR regexp_matches(c, '\p{{L}}\p{{Nd}}|\p{{Nd}}\p{{L}}') OR (plain AND length(c) >= 3 AND NOT regexp_matches(low, '[aeiouyàâäéèêëîïôöùûüœæ]'))
  OR regexp_matches(low, '[bcdfghjklmnpqrstvwxzç]{{4,}}') OR (plain AND length(c) >= 4 AND flips >= 2)) AS bad FROM f)
SELECT doc_id, round(coalesce(avg(bad::INTEGER), 0), 6) AS suspect FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id""")
def suspect_words(spark, d):
    return table(spark, d, "documents").select("doc_id", F.round(M.suspect_share(F.col("text")), 6).alias("suspect"))


@query(f"SELECT doc_id, sha256({_strip('regexp_replace(lower(text), ' + repr(_SP + '+').replace(chr(92) * 2, chr(92)) + ', chr(32), ' + repr('g') + ')')}) AS h FROM documents")
def normalized_hash(spark, d):
    return table(spark, d, "documents").select("doc_id", T.normalized_hash(F.col("text")).alias("h"))


# --- profiles ---------------------------------------------------------------
@query("SELECT source, CASE WHEN length(text) < 100 THEN '<100' WHEN length(text) < 500 THEN '100-500' WHEN length(text) < 2000 THEN '500-2000' WHEN length(text) < 10000 THEN '2000-10000' ELSE '>=10000' END AS bucket, count(*) AS docs FROM documents GROUP BY ALL")
def length_histogram(spark, d):
    return profile.histogram(table(spark, d, "documents"))


@query(rf"""SELECT source, count(*) AS docs, min(length(text))::INTEGER AS min_chars, max(length(text))::INTEGER AS max_chars, avg(length(text)) AS mean_chars, sum(length(text))::BIGINT AS chars,
  count(*) FILTER ({_count("substr(text, 1, 2000)", "[A-Za-z0-9À-ſ" + chr(92) + "s.,;:!?''" + chr(34) + "()" + chr(92) + "-]")} / length(substr(text, 1, 2000)) < 0.85::DOUBLE) AS low_latin, count(*) FILTER (length(text) < 50) AS too_short FROM documents GROUP BY source""")
def length_profile(spark, d):
    return profile.length_stats(table(spark, d, "documents"))


@query(rf"""WITH w AS (SELECT {_letter_words("text", "a-zà-ÿ")} AS ws FROM documents),
g AS (SELECT unnest(list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' '))) AS gram FROM w)
SELECT gram, count(*) AS n FROM g GROUP BY gram ORDER BY n DESC, gram LIMIT 50""")
def common_trigrams(spark, d):
    return profile.top_trigrams(table(spark, d, "documents"), None)


_PCT = ", ".join(f"round(quantile_cont(n_tok, {q}), 4) AS p{round(100 * q)}" for q in (0.5, 0.75, 0.9, 0.95, 0.99))


@query(f"SELECT source, round(avg(n_tok), 4) AS mean, {_PCT}, round(max(n_tok)::DOUBLE, 4) AS max FROM (SELECT source, {_N_TOK} AS n_tok FROM documents) GROUP BY source")
def token_percentiles(spark, d):
    return profile.percentiles(_indexed(spark, d), "n_tok", ["source"])


@query("SELECT lang, count(*) AS n, count(*) / (SELECT count(*) FROM documents) AS share FROM documents GROUP BY lang")
def language_shares(spark, d):
    return profile.shares(table(spark, d, "documents"), "lang")


@query(f"SELECT x AS threshold, avg((n_tok < x)::INTEGER) AS share, sum(CASE WHEN n_tok < x THEN n_tok ELSE 0 END) / sum(n_tok) AS weighted FROM (SELECT {_N_TOK} AS n_tok FROM documents), (VALUES (50.0::DOUBLE), (100.0), (200.0), (500.0), (1000.0), (2000.0)) v(x) GROUP BY x")
def keep_shares(spark, d):
    return select.keep_shares(_indexed(spark, d), "n_tok", "n_tok", (50, 100, 200, 500, 1000, 2000))


@query("SELECT key AS field, count(*) AS n FROM (SELECT unnest(json_keys(props)) AS key FROM events) GROUP BY key")
def event_fields(spark, d):
    return profile.field_counts(table(spark, d, "events").select(F.col("props").alias("raw"))).groupBy("field").agg(F.sum("n").alias("n"))


# --- selection --------------------------------------------------------------
@query("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS n FROM documents) WHERE n <= 5")
def head_per_source(spark, d):
    return select.head_per_group(table(spark, d, "documents"), "source", ["doc_id"], 5).select("doc_id", "source")


_BYTES = "coalesce(sum(strlen(text)) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"


@query(f"SELECT doc_id FROM (SELECT doc_id, {_BYTES} AS b FROM documents) WHERE b < 20000")
def byte_cap_crossing(spark, d):
    return select.byte_cap(table(spark, d, "documents"), "source", ["doc_id"], F.octet_length("text"), 20000, True).select("doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, strlen(text) AS s, {_BYTES} AS b FROM documents) WHERE b + s <= 20000")
def byte_cap_below(spark, d):
    return select.byte_cap(table(spark, d, "documents"), "source", ["doc_id"], F.octet_length("text"), 20000, False).select("doc_id")


@query(f"SELECT doc_idx FROM (SELECT doc_id AS doc_idx, {_N_TOK} AS n_tok, sum({_N_TOK}) OVER (PARTITION BY source ORDER BY doc_id) AS s FROM documents) WHERE s - n_tok < 3000")
def budget_prefix(spark, d):
    return select.budget_prefix(_indexed(spark, d), ["source"], ["doc_idx"], "n_tok", 3000).select("doc_idx")


@query(f"WITH r AS (SELECT doc_id AS doc_idx, {_N_TOK} AS n_tok, row_number() OVER (ORDER BY {_N_TOK}, doc_id) - 1 AS i, count(*) OVER () AS n FROM documents) SELECT d::INTEGER AS decile, doc_idx, n_tok FROM r, range(0, 101, 10) v(d) WHERE i = floor(d / 100 * (n - 1))")
def decile_picks(spark, d):
    return select.decile_picks(_indexed(spark, d), [F.col("n_tok"), F.col("doc_idx")]).select("decile", "doc_idx", "n_tok")


@query("SELECT p_partkey AS item, p_retailprice AS price FROM part WHERE contains(lower(p_name), substr((SELECT lower(min(p_name)) FROM part), 1, 3)) AND p_retailprice > 0 AND p_retailprice <= 1500 ORDER BY p_retailprice, p_name LIMIT 5")
def cheapest_offers(spark, d):
    part = table(spark, d, "part")
    hint = (part.agg(F.min("p_name")).first()[0] or "")[:3]
    offers = part.select(F.col("p_partkey").alias("item"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))
    return select.cheapest(offers, hint, 1500.0, 5).select("item", "price")


@query("""
WITH a AS (SELECT source AS grp, doc_id AS item, n_chars / 1000.0::DOUBLE AS score FROM documents), r AS (SELECT *, rank() OVER (PARTITION BY grp ORDER BY score DESC) AS r FROM a), k AS (SELECT * FROM r WHERE r <= 20),
m AS (SELECT *, exp(score - max(score) OVER (PARTITION BY grp)) AS m FROM k), p AS (SELECT *, m / sum(m) OVER (PARTITION BY grp) AS p FROM m),
b AS (SELECT *, coalesce(sum(p) OVER (PARTITION BY grp ORDER BY score DESC, item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM p) SELECT grp, item FROM b WHERE b <= 0.9""")
def nucleus(spark, d):
    df = table(spark, d, "documents").select(F.col("source").alias("grp"), F.col("doc_id").alias("item"), (F.col("n_chars") / 1000.0).alias("score"))
    return select.nucleus(df, "grp", "score", 20, 0.9).select("grp", "item")


# --- sampling ---------------------------------------------------------------
@query(f"SELECT doc_id FROM documents ORDER BY {_order(42, 'doc_id')}, doc_id LIMIT 50")
def reservoir(spark, d):
    return sample.reservoir(table(spark, d, "documents"), "doc_id", 50).select("doc_id")


@query(f"SELECT doc_id, source FROM documents JOIN (VALUES ('src0', 1.0), ('src1', 0.5), ('src2', 0.1)) v(source, p) USING (source) WHERE {_uniform(42, 'doc_id')} <= p")
def stratified_sample(spark, d):
    return sample.stratified(table(spark, d, "documents"), "doc_id", "source", {"src0": None, "src1": 0.5, "src2": 0.1}).select("doc_id", "source")


@query(f"SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY {_order(42, 'doc_id')}, doc_id) AS n FROM documents) WHERE n <= 3")
def sample_per_source(spark, d):
    return sample.per_group(table(spark, d, "documents"), "doc_id", "source", 3).select("doc_id", "source")


@query(f"SELECT conv_id, CASE WHEN row_number() OVER (ORDER BY {_order(42, 'conv_id')}, conv_id) <= greatest(1, floor(count(*) OVER () * 0.02::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM (SELECT DISTINCT conv_id FROM conversations)")
def split_conversations(spark, d):
    return sample.split_rows(table(spark, d, "conversations").select("conv_id").distinct(), "conv_id").select("conv_id", "split")


@query(f"""
WITH s AS (SELECT source, count(*)::DOUBLE AS w FROM documents GROUP BY source), r AS (SELECT source, sum(w) OVER (ORDER BY source) / sum(w) OVER () AS hi FROM s), b AS (SELECT source, hi, coalesce(lag(hi) OVER (ORDER BY source), -1) AS lo FROM r)
SELECT item_id, source FROM (SELECT item_id, {_uniform(7, "item_id")} AS u FROM benchmark) JOIN b ON u <= hi AND u > lo""")
def weighted_picks(spark, d):
    items = table(spark, d, "documents").groupBy("source").agg(F.count("*").cast("double").alias("w"))
    draws = table(spark, d, "benchmark").select("item_id", sample.uniform(7, F.col("item_id")).alias("u"))
    return sample.weighted_picks(items, draws, "w", "source", "u").select("item_id", "source")


# --- index ------------------------------------------------------------------
@query("SELECT source, (dense_rank() OVER (ORDER BY f) - 1)::INTEGER AS code, lines FROM (SELECT source, min(doc_id) AS f, count(*) AS lines FROM documents GROUP BY source)")
def source_codes(spark, d):
    return index.source_codes(table(spark, d, "documents").withColumnRenamed("doc_id", "line_no"))


@query(f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_idx, source, {_N_TOK} AS n_tok, (sum({_N_TOK}) OVER (ORDER BY doc_id))::BIGINT - 1 AS eos_off FROM documents")
def document_index(spark, d):
    return index.document_index(_indexed(spark, d).withColumnRenamed("doc_idx", "ord"))


@query(f"SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_idx, {_N_TOK} AS n_tok FROM documents")
def lengths_from_offsets(spark, d):
    return index.lengths(index.document_index(_indexed(spark, d).withColumnRenamed("doc_idx", "ord")).select("doc_idx", "eos_off")).select("doc_idx", "n_tok")


@query("SELECT doc_id AS line_no, (coalesce(sum(strlen(text) + 1) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS byte_off FROM documents")
def line_offsets(spark, d):
    return index.line_offsets(table(spark, d, "documents").select(F.col("doc_id").alias("line_no"), F.col("text").alias("raw")))


@query(f"WITH s AS (SELECT source, CASE WHEN source IN ('src1', 'src2') THEN 'editorial' ELSE 'web' END AS class, count(*) AS docs, sum({_N_TOK})::BIGINT AS tokens FROM documents GROUP BY ALL) SELECT source, class, docs, tokens, 100 * tokens / sum(tokens) OVER () AS pct, tokens / docs AS mean_tokens FROM s")
def source_totals(spark, d):
    return index.source_totals(_indexed(spark, d), ("src1", "src2"))


@query(f"""
WITH s AS (SELECT source, sum({_N_TOK})::BIGINT AS tokens, min(doc_id) AS ord FROM documents GROUP BY source), h AS (SELECT *, sum(tokens) OVER (ORDER BY ord) AS hi FROM s)
SELECT pos, source AS file, (pos - (hi - tokens))::BIGINT AS "offset" FROM (SELECT item_id * 5000 AS pos FROM benchmark) JOIN h ON pos >= hi - tokens AND pos < hi""")
def locate_positions(spark, d):
    shards = _indexed(spark, d).groupBy(F.col("source").alias("file")).agg(F.sum("n_tok").alias("tokens"), F.min("doc_idx").alias("ord"))
    return index.locate_in_shards(table(spark, d, "benchmark").select((F.col("item_id") * 5000).alias("pos")), shards)


# --- blend ------------------------------------------------------------------
_WEIGHTS = {"src0": 0.5, "src1": 0.3, "src2": 0.2}
_PLAN = f"""
d AS MATERIALIZED (SELECT doc_id AS doc_idx, source, {_N_TOK} AS n_tok FROM documents),
w(source, weight, ep) AS (VALUES ('src0', 0.5::DOUBLE, 4), ('src1', 0.3, NULL), ('src2', 0.2, NULL)),
a AS (SELECT source, sum(n_tok)::BIGINT AS avail, count(*) AS docs_avail FROM d GROUP BY source),
plan AS MATERIALIZED (SELECT source, weight / (SELECT sum(weight) FROM w) AS weight, coalesce(avail, 0) AS avail, coalesce(docs_avail, 0) AS docs_avail, floor(100000.0 * weight / (SELECT sum(weight) FROM w))::BIGINT AS target, ep FROM w LEFT JOIN a USING (source)),
b AS MATERIALIZED (SELECT *, CASE WHEN avail > 0 THEN least(target, coalesce(ep * avail, target)) ELSE 0 END AS budget FROM plan),
e AS (SELECT d.source, doc_idx, n_tok, budget, unnest(range(1, ceil(budget / avail)::BIGINT + 1)) AS epoch FROM d JOIN b ON b.source = d.source AND budget > 0),
o AS (SELECT *, {_order(1234, "epoch", "doc_idx")} AS o FROM e),
c AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY source ORDER BY epoch, o, doc_idx) AS rn FROM (SELECT *, sum(n_tok) OVER (PARTITION BY source ORDER BY epoch, o, doc_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM o) WHERE s - n_tok < budget)"""


def _plan(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = _indexed(spark, d)
    plan = blend.budgets(docs, 100_000, _WEIGHTS, {"src0": 4})
    return plan, blend.select_documents(docs, plan, 1234)


@query(f"WITH {_PLAN} SELECT source, doc_idx, epoch::INTEGER AS epoch, row_number() OVER (ORDER BY (rn - 1) // 50, md5(concat_ws('|', '1234', ((rn - 1) // 50)::VARCHAR, source)), rn) - 1 AS place FROM c")
def blend_order(spark, d):
    _, chosen = _plan(spark, d)
    return blend.interleave(chosen, 1234, 50).select("source", "doc_idx", "epoch", "place")


@query(f"""WITH {_PLAN}, g AS (SELECT source, sum(n_tok)::BIGINT AS t, count(*) AS k FROM c GROUP BY source)
SELECT source, weight, target AS tokens_target, coalesce(t, 0) AS tokens_effective, greatest(0, target - coalesce(t, 0)) AS deficit, coalesce(k, 0) AS docs_selected, docs_avail AS docs_unique_avail, avail AS avail_tokens_1epoch,
  CASE WHEN avail > 0 THEN coalesce(t, 0) / avail ELSE 0 END AS epochs_approx FROM b LEFT JOIN g USING (source)""")
def blend_report(spark, d):
    plan, chosen = _plan(spark, d)
    return blend.blend_report(chosen, plan)


@query(f"WITH {_PLAN}, f AS (SELECT doc_idx, n_tok, {_order(1234, 'doc_idx')} AS o FROM d WHERE doc_idx NOT IN (SELECT doc_idx FROM c)) SELECT doc_idx FROM (SELECT doc_idx, n_tok, sum(n_tok) OVER (ORDER BY o, doc_idx) AS s FROM f) WHERE s - n_tok < 5000")
def blend_validation(spark, d):
    _, chosen = _plan(spark, d)
    return blend.validation(_indexed(spark, d), chosen, 5000, 1234).select("doc_idx")


@query(f"""WITH t AS (SELECT doc_id, list_transform({_words("text")}, lambda w: length(w)) AS tk FROM documents)
SELECT doc_id, k, tk[k * 16 + 1 : k * 16 + 16] AS x, tk[k * 16 + 2 : k * 16 + 17] AS y FROM (SELECT doc_id, tk, unnest(range(0, (len(tk) - 1 - 16) // 16 + 1)) AS k FROM t WHERE len(tk) > 16)""")
def training_windows(spark, d):
    tokens = F.transform(M.words(F.col("text")), lambda w: F.length(w)).alias("tk")
    return blend.array_windows(table(spark, d, "documents").select("doc_id", tokens), "tk", 16)


# --- instruction data -------------------------------------------------------
_PAIRS = "p AS (SELECT a.conv_id, a.turn, u.text AS instruction, a.text AS reponse FROM conversations a JOIN conversations u ON u.conv_id = a.conv_id AND u.turn + 1 = a.turn AND u.role = 'user' WHERE a.role = 'assistant')"
_MARKS = " OR ".join(f"contains(lower(reponse), '{_q(m)}')" for m in (*DELIBERATION, *UNCERTAINTY))


@query(f"WITH {_PAIRS} SELECT conv_id, turn, '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || reponse || '<|im_end|>' AS text FROM p")
def chatml_pairs(spark, d):
    pairs = sft.conversation_pairs(table(spark, d, "conversations"))
    return pairs.select("conv_id", "turn", T.chatml(F.col("instruction"), F.col("reponse")).alias("text"))


@query(f"""WITH {_PAIRS} SELECT conv_id, turn FROM p WHERE length(instruction) BETWEEN 8 AND 800 AND length(reponse) BETWEEN 20 AND 4000 AND NOT contains(lower(instruction || ' ' || reponse), '<think>')
  AND NOT contains(lower(instruction || ' ' || reponse), '</think>') AND NOT starts_with(instruction, '```') AND NOT (starts_with(reponse, '{{') AND ends_with(reponse, '}}')) AND instruction <> reponse AND NOT ({_MARKS}) AND {_count("reponse", "[?]")} < 2""")
def valid_examples(spark, d):
    return sft.valid(sft.conversation_pairs(table(spark, d, "conversations"))).select("conv_id", "turn")


@query(f"SELECT min(doc_id) AS doc_id FROM (SELECT doc_id, {_strip('regexp_replace(lower(text), ' + repr(_SP + '+').replace(chr(92) * 2, chr(92)) + ', chr(32), ' + repr('g') + ')')} AS t FROM documents) GROUP BY t")
def exact_dedup(spark, d):
    return dedup.exact_dedup(table(spark, d, "documents"), "text", ["doc_id"]).select("doc_id")


@query("SELECT role AS registre, count(*) AS n, min(length(text))::INTEGER AS min_chars, max(length(text))::INTEGER AS max_chars, floor(sum(length(text)) / count(*))::BIGINT AS mean_chars, count(*) FILTER (length(text) < 40) AS short, count(*) FILTER (length(text) > 2000) AS long, count(*) FILTER (regexp_matches(lower(text), '\\b(the|and|with|this|that)\\b')) AS english, count(DISTINCT conv_id) AS distinct_instructions FROM conversations GROUP BY role")
def answer_profile(spark, d):
    return sft.profile(table(spark, d, "conversations").select(F.col("role").alias("registre"), F.col("text").alias("reponse"), F.col("conv_id").alias("instruction")))


# --- events -----------------------------------------------------------------
@query("SELECT event_id, recent, recent >= 3 AS alert FROM (SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY epoch_us(ts) RANGE BETWEEN 1799999999 PRECEDING AND CURRENT ROW) AS recent FROM events)")
def sliding_alerts(spark, d):
    return alerts.sliding_count(table(spark, d, "events"), "event_type").select("event_id", "recent", "alert")


@query("SELECT event_id FROM (SELECT event_id, value > 100 AS c, coalesce(lag(value > 100) OVER (PARTITION BY user_id ORDER BY ts, event_id), false) AS b FROM events) WHERE c AND NOT b")
def rising_edges(spark, d):
    return alerts.rising_edges(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("value") > 100).filter("edge").select("event_id")


@query("""WITH b AS (SELECT event_id, user_id, ts, value < 50 AS idle, sum((value >= 50)::INTEGER) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS b FROM events)
SELECT event_id, (sum(idle::INTEGER) OVER (PARTITION BY user_id, b ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))::BIGINT AS idle_run FROM b""")
def idle_runs(spark, d):
    return alerts.idle_runs(table(spark, d, "events"), "user_id", ["ts", "event_id"], F.col("value") < 50).select("event_id", "idle_run")


@query("SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS start, time_bucket(INTERVAL 30 MINUTE, ts) + INTERVAL 30 MINUTE AS \"end\", event_type, count(*) AS n FROM events GROUP BY ALL")
def event_windows(spark, d):
    return windowed_counts(table(spark, d, "events"), slide="30 minutes").select("start", "end", "event_type", "n")


@query("""SELECT event_id, CASE WHEN epoch(ts) - epoch(first_value(ts) OVER w) > 0 THEN (n - first_value(n) OVER w) / (epoch(ts) - epoch(first_value(ts) OVER w)) END AS rate
FROM (SELECT event_id, event_type, ts, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events) WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)""")
def sliding_rate(spark, d):
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000
    n = F.row_number().over(Window.partitionBy("event_type").orderBy("ts", "event_id"))
    df = table(spark, d, "events").withColumns({"s": seconds, "n": n})
    return alerts.sliding_rate(df, "event_type", ["ts", "event_id"], "n", "s").select("event_id", "rate")


@query("SELECT o_orderkey, CASE WHEN o_orderkey < 1000 THEN 0.0003::DOUBLE * (o_orderkey + 1) / 1000 ELSE 0.00003::DOUBLE + 0.5 * (1 + cos(pi() * least(1.0, (o_orderkey - 1000) / 9000.0::DOUBLE))) * (0.0003::DOUBLE - 0.00003::DOUBLE) END AS lr FROM orders")
def learning_rate(spark, d):
    return table(spark, d, "orders").select("o_orderkey", M.learning_rate(F.col("o_orderkey"), 1000, 10_000, 0.0003, 0.00003).alias("lr"))


@query("SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS \"end\", count(*) AS n FROM (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM (SELECT *, coalesce((ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) + INTERVAL 30 MINUTE)::INTEGER, 1) AS new FROM events)) GROUP BY user_id, s")
def user_sessions(spark, d):
    return sessions(table(spark, d, "events"))


# --- near duplicates --------------------------------------------------------
@query()
def near_dedup_greedy(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), "text")
    return dedup.near_dedup(docs, MinHashParams())


@query()
def dedup_and_quality(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), "source", "text")
    return dedup_quality(docs).select("id", "keep", "score")


from . import more_queries  # noqa: E402, F401
