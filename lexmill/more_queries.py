"""Further registered queries: operators that need markup, logs, token streams or named sources, which are made from the tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import BOILERPLATE_LINE, COMMON_GATE, DEFAULT_GATE, PREMIUM_SOURCES, SOURCE_GATES, SOURCE_ORDER, MinHashParams
from .functions import metrics as M
from .functions import text as T
from .operators import dedup, gates, index, profile, sample, select, sft
from .plans.corpus import dedup_quality, quality_kept, quality_threshold
from .queries import _FR, _N_TOK, _PAIRS, _SCORE, _SP, _count, _indexed, _letter_words, _lines, _order, _q, _strip, _uniform, _words, query, table
from .sources import readers, sinks

#: The tables' sources under names that have parameters of their own.
NAMES = dict(zip((f"src{k}" for k in range(8)), SOURCE_ORDER, strict=True))
_NAMED = "CASE source " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items()) + " ELSE source END"


def named(spark: SparkSession, d: str) -> DataFrame:
    source = F.col("source")
    for k, v in NAMES.items():
        source = F.when(F.col("source") == k, v).otherwise(source)
    return table(spark, d, "documents").withColumn("source", source)


# --- text -------------------------------------------------------------------
_SIGNS = r'[{}\[\]<>|="\\*#\x00-\x1F-]'


def _pick(*choices: str) -> Column:
    """One of the texts by the document's id; {t} stands for its text without marks that mean something in markup or JSON, {i} for its id."""
    own = F.regexp_replace("text", _SIGNS, "")
    out = None
    for k, c in enumerate(choices):
        made = F.replace(F.replace(F.lit(c), F.lit("{t}"), own), F.lit("{i}"), F.col("doc_id").cast("string"))
        out = made if out is None else F.when(F.col("doc_id") % len(choices) == k, made).otherwise(out)
    return out


def _pick_sql(*choices: str) -> str:
    own = f"regexp_replace(text, '{_SIGNS}', '', 'g')"
    cases = " ".join(f"WHEN {k} THEN replace(replace('{_q(c)}', '{{t}}', {own}), '{{i}}', doc_id::VARCHAR)" for k, c in enumerate(choices))
    return f"CASE doc_id % {len(choices)} {cases} END"


_MARKED = (
    "== Titre {i} ==\n{t}<!-- off -->", "{{cite|a={i}{{b}}}}{t}[[File:x.jpg|thumb]]", "[[Paris|{t}]] et [[Lyon {i}]]", "a<ref name=x>{t}</ref>b{i}<ref name=y/>c",
    "[http://a.b/{i} {t}] fin", "{| class=x\n| {t}\n|}\nreste {i}\n-----\nfin", "<math>{i}</math>{t}<b>gras</b>[[Catégorie:X]]", "{{a{{b}}c}}{t}{{d {i}}}",
)
_WIKI = (
    (r"(?s)<!--.*?-->", ""), (r"(?is)<ref[^>]*>.*?</ref>", ""), (r"(?i)<ref[^/]*/>", ""), (r"(?s)\{\|.*?\|\}", ""), (r"(?is)<math[^>]*>.*?</math>", ""), (r"(?i)\[\[(?:File|Image|Fichier|Media):[^\]]*\]\]", ""),
    (r"(?i)\[\[(?:Catégorie|Category):[^\]]*\]\]", ""), (r"\{\{[^{}]*(?:\{\{[^{}]*\}\}[^{}]*)?\}\}", ""), (r"\{\{[^{}]*(?:\{\{[^{}]*\}\}[^{}]*)?\}\}", ""), (r"\[\[(?:[^\]|]*?\|)?([^\]]*?)\]\]", r"\1"),
    (r"\[https?://[^\s\]]*(?:\s([^\]]+))?\]", r"\1"), (r"<[^>]{1,200}>", ""), (r"={2,}([^=\n]+)={2,}", r"\1" + "\n"), (r"(?m)^[-=*#]{5,}\s*$", ""),
)


def _wiki_sql(t: str) -> str:
    for pattern, to in _WIKI:
        t = f"regexp_replace({t}, '{_q(pattern)}', '{to}', 'g')"
    return t


@query(f"SELECT doc_id, {_wiki_sql('m')} AS plain FROM (SELECT doc_id, {_pick_sql(*_MARKED)} AS m FROM documents)")
def wiki_markup(spark, d):
    return table(spark, d, "documents").select("doc_id", T.wiki_markup(_pick(*_MARKED)).alias("plain"))


_BOILED = ("Tous droits réservés.", "{t}", "Lire la suite...", "COOKIES et vous {i}", "partager sur facebook", "En savoir plus", "All rights reserved", "voir plus", "Creative commons {t}")


@query(f"SELECT doc_id, regexp_matches(l, '{_q(BOILERPLATE_LINE).replace('(?iu)', '(?i)')}') AS boilerplate FROM (SELECT doc_id, {_pick_sql(*_BOILED)} AS l FROM documents)")
def boilerplate_lines(spark, d):
    return table(spark, d, "documents").select("doc_id", T.is_boilerplate_line(_pick(*_BOILED)).alias("boilerplate"))


@query(f"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(replace(text, chr(13), ''), '([.!?…])\\s+', '\\1' || chr(10), 'g'), chr(10)), lambda x: {_strip('x')}), lambda x: length(x) >= 20) AS ls FROM documents)
SELECT doc_id, len(ls)::INTEGER AS n, md5(array_to_string(ls, '|')) AS digest FROM l WHERE len(list_filter(ls, lambda x: length(x) > 4000)) = 0""")
def split_lines(spark, d):
    docs = table(spark, d, "documents").withColumn("ls", T.split_lines(F.col("text")))
    long = F.exists(F.split(F.regexp_replace(F.replace(F.col("text"), F.lit("\r"), F.lit("")), r"([.!?…])\s+", "$1\n"), "\n"), lambda x: F.length(T.strip(x)) > 4000)
    return docs.filter(~long).select("doc_id", F.size("ls").alias("n"), F.md5(F.array_join("ls", "|").cast("binary")).alias("digest"))


@query("SELECT o_orderkey, CASE WHEN n >= 1e9 THEN format('{:.1f}B', n / 1e9::DOUBLE) WHEN n >= 1e6 THEN format('{:.1f}M', n / 1e6::DOUBLE) WHEN n >= 1e3 THEN format('{:.1f}K', n / 1e3::DOUBLE) ELSE n::VARCHAR END AS short FROM (SELECT o_orderkey, o_orderkey * o_orderkey * 10 + 1 AS n FROM orders)")
def human_numbers(spark, d):
    n = F.col("o_orderkey") * F.col("o_orderkey") * 10 + 1
    return table(spark, d, "orders").select("o_orderkey", T.human(n).alias("short"))


def _fold(t: str) -> str:
    return f"lower({_strip(f"regexp_replace({t}, '{_SP}+', ' ', 'g')")})"


_VIEW = f"""v0 AS (SELECT doc_id, substr(text, 1, 100000) AS c, {_fold("substr(text, 1, 100000)")} AS f FROM documents), v1 AS (SELECT *, length(c) AS n, length(f) AS m FROM v0),
v AS (SELECT doc_id, CASE WHEN n <= 18000 AND m <= 9000 THEN f WHEN n <= 18000 THEN substr(f, 1, 3000) || ' ' || substr(f, m // 2 - 1499, 3000) || ' ' || substr(f, m - 2999, 3000)
  ELSE substr({_fold("substr(c, 1, 4500)")}, 1, 3000) || ' ' || substr({_fold("substr(c, n // 2 - 2249, 4500)")}, 1, 3000) || ' ' || substr({_fold("substr(c, n - 4499, 4500)")}, 1, 3000) END AS t FROM v1)"""


@query(f"WITH {_VIEW} SELECT doc_id, md5(t) AS digest FROM v")
def signature_windows(spark, d):
    return table(spark, d, "documents").select("doc_id", F.md5(T.windows(F.col("text")).cast("binary")).alias("digest"))


# --- gates by source --------------------------------------------------------
def _of(name: str) -> str:
    return "CASE source " + " ".join(f"WHEN '{k}' THEN {getattr(v, name)}::DOUBLE" for k, v in SOURCE_GATES.items()) + f" ELSE {getattr(DEFAULT_GATE, name)}::DOUBLE END"


_BY_SOURCE = rf"""
g0 AS (SELECT doc_id, {_NAMED} AS source, text, length(text) AS n, {_count("text", chr(92) + "p{L}")} AS alpha, {_count("text", _SP)} AS space, {_count("text", chr(92) + "p{Nd}")} AS digit, {_count("text", chr(92) + "p{Lu}")} AS upper,
  {_words("text")} AS ws, {_lines("text")} AS ls, {_letter_words("substr(text, 1, 2000)", "a-zàâäéèêëîïôùûüçœæ")} AS fw FROM documents),
g1 AS (SELECT *, list_filter(ws, lambda w: regexp_full_match(w, '\p{{L}}+')) AS aw, n - alpha - space - digit AS other, len(list_filter(fw, lambda w: list_contains([{", ".join("'" + w + "'" for w in dict.fromkeys(COMMON_GATE))}], w))) / nullif(len(fw), 0) AS fr FROM g0),
g2 AS (SELECT *, CASE WHEN len(aw) >= 10 THEN list_sum(list_transform(aw, lambda w: length(w))) / len(aw) END AS mean FROM g1),
gated AS (SELECT doc_id, source, CASE WHEN n < {_of("min_chars")} THEN 'too short' WHEN len(ls) < {_of("min_lines")} THEN 'too few lines' WHEN len(ws) < {_of("min_words")} THEN 'too few words' WHEN mean < 3.5 THEN 'short words' WHEN mean > 12.0 THEN 'long words'
  WHEN alpha / n < 1 - {_of("max_special")} - {_of("max_digits")} - 0.15::DOUBLE THEN 'too special' WHEN digit / n > {_of("max_digits")} THEN 'too many digits' WHEN other / n > {_of("max_special")} THEN 'too much punctuation'
  WHEN alpha > 0 AND upper / alpha > {_of("max_upper")} THEN 'too many capitals' WHEN len(ls) >= 10 AND 1 - len(list_distinct(ls)) / len(ls) > {_of("max_line_repetition")} THEN 'repeated lines'
  WHEN len(ls) >= 10 AND len(list_filter(ls, lambda x: regexp_matches(x, '^[*#-]'))) / len(ls) > 0.60::DOUBLE THEN 'list'
  WHEN n >= 200 AND len(fw) >= 20 AND fr < {_of("french")} AND fr < 0.01::DOUBLE THEN 'not French' END AS reason FROM g2)"""


@query(f"WITH {_BY_SOURCE} SELECT doc_id, source, reason FROM gated")
def gate_reason_by_source(spark, d):
    return gates.with_reason(named(spark, d)).select("doc_id", "source", "reason")


@query(f"WITH {_SCORE}, n AS (SELECT *, {_NAMED} AS name FROM s WHERE length(text) >= 50), r AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS k FROM n WHERE name NOT IN {PREMIUM_SOURCES}) SELECT round(score, 6) AS threshold FROM r WHERE i = least(floor(k * (1 - 0.85::DOUBLE)), k - 1)")
def score_threshold(spark, d):
    limit = quality_threshold(named(spark, d).filter(F.length("text") >= 50))
    return spark.createDataFrame([(None if limit is None else round(limit, 6),)], "threshold double")


@query(f"WITH {_SCORE} SELECT doc_id, CASE WHEN {_NAMED} IN {PREMIUM_SOURCES} THEN NULL ELSE round(score, 6) END AS score, {_NAMED} IN {PREMIUM_SOURCES} OR score >= 0.62::DOUBLE AS ok FROM s WHERE length(text) >= 50")
def quality_preset(spark, d):
    return quality_kept(named(spark, d), threshold=0.62).select("doc_id", F.round("score", 6).alias("score"), "ok")


# --- noise ------------------------------------------------------------------
_PANEL = rf"""
c AS (SELECT doc_id, regexp_replace(w, '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g') AS c FROM (SELECT doc_id, unnest({_words("text")}) AS w FROM documents)),
f AS (SELECT doc_id, c, lower(c) AS low, regexp_full_match(c, '\p{{L}}+') AS plain,
  coalesce(list_sum(list_transform(range(1, length(c)), lambda i: (regexp_matches(substr(c, i, 1), '\p{{Lu}}') <> regexp_matches(substr(c, i + 1, 1), '\p{{Lu}}'))::INTEGER)), 0) AS flips FROM c WHERE c <> ''),
b AS (SELECT doc_id, ceil(length(c) / 4) AS pieces, regexp_matches(c, '\p{{L}}') AND (regexp_matches(regexp_replace(c, '[{_FR}]', '', 'g'), '\p{{L}}') OR regexp_matches(c, '\p{{L}}\p{{Nd}}|\p{{Nd}}\p{{L}}') OR (plain AND length(c) >= 3 AND NOT regexp_matches(low, '[aeiouyàâäéèêëîïôöùûüœæ]'))
  OR regexp_matches(low, '[bcdfghjklmnpqrstvwxzç]{{4,}}') OR (plain AND length(c) >= 4 AND flips >= 2)) AS bad FROM f),
s AS (SELECT doc_id, coalesce(avg(bad::INTEGER), 0) AS suspect, coalesce(sum(pieces) / count(pieces), 1.54) AS fertility FROM documents LEFT JOIN b USING (doc_id) GROUP BY doc_id),
panel AS (SELECT doc_id, suspect, fertility, coalesce(({_count("text", chr(92) + "p{L}")} - {_count("text", "[" + _FR + "]")}) / nullif({_count("text", chr(92) + "p{L}")}, 0), 0) AS frgn FROM documents JOIN s USING (doc_id))"""


def _panel(spark: SparkSession, d: str) -> DataFrame:
    """With a tokenizer of pieces of four characters."""
    cores = M.word_cores(F.col("text"))
    pieces = F.flatten(F.transform(cores, lambda w: F.array_repeat(F.lit("p"), F.ceil(F.length(w) / 4).cast("int"))))
    return profile.noise_panel(table(spark, d, "documents"), fertility=M.fertility(pieces, F.col("text")))


@query(f"WITH {_PANEL} SELECT doc_id, round(frgn, 6) AS foreign_letters, round(greatest(suspect, least(1.0, greatest(0.0, (fertility - 1.54) / 1.5)), frgn, 0.0), 6) AS noise FROM panel")
def noise_panel(spark, d):
    return _panel(spark, d).select("doc_id", F.round("foreign", 6).alias("foreign_letters"), F.round("noise", 6).alias("noise"))


@query(f"WITH {_PANEL} SELECT round(100 * avg((suspect < 0.05::DOUBLE)::INTEGER), 6) AS clean_pct, round(100 * avg((suspect > 0.20::DOUBLE)::INTEGER), 6) AS noisy_pct FROM panel")
def noise_shares(spark, d):
    out = profile.share_below(table(spark, d, "documents").select(M.suspect_share(F.col("text")).alias("suspect")), F.col("suspect"))
    return out.select(F.round("clean_pct", 6).alias("clean_pct"), F.round("noisy_pct", 6).alias("noisy_pct"))


_PIECES = ("<0x0A>", "<0xfF>", "<0x0>", "{t}", "<0x0G>", "x<0x0A>", "▁{i}")


@query(f"SELECT doc_id, regexp_full_match({_pick_sql(*_PIECES)}, '<0x[0-9A-Fa-f]{{2}}>') AS byte_piece FROM documents")
def byte_pieces(spark, d):
    return table(spark, d, "documents").select("doc_id", M.is_byte_piece(_pick(*_PIECES)).alias("byte_piece"))


@query("SELECT key AS field, CASE json_type(v) WHEN 'VARCHAR' THEN 'STRING' WHEN 'DOUBLE' THEN 'NUMBER' WHEN 'UBIGINT' THEN 'NUMBER' WHEN 'BIGINT' THEN 'NUMBER' ELSE json_type(v) END AS type, count(*) AS n FROM (SELECT key, json_extract(props, '$.\"' || key || '\"') AS v FROM (SELECT props, unnest(json_keys(props)) AS key FROM events)) GROUP BY ALL")
def event_field_types(spark, d):
    counts = profile.field_counts(table(spark, d, "events").select(F.col("props").alias("raw")))
    kind = F.when(F.col("type").rlike("BIGINT|DECIMAL|DOUBLE"), "NUMBER").otherwise(F.col("type"))
    return counts.groupBy("field", kind.alias("type")).agg(F.sum("n").alias("n"))


# --- lines of JSON, logs ----------------------------------------------------
_LINES = ('{"text": "{t} {i}"}', "  ", "{broken {i}", '{"text": ""}', '{"content": "{i}"}', "[{i}]", '{"body": "b", "id": {i}}')
_REASONS = (None, "blank", "invalid", "no text", None, "not an object", None)
_REASON = f"CASE doc_id % {len(_LINES)} " + " ".join(f"WHEN {k} THEN {'NULL' if r is None else repr(r)}" for k, r in enumerate(_REASONS)) + " END"


def _json_lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("line_no"), "source", _pick(*_LINES).alias("raw"), F.col("doc_id"))


@query(f"SELECT doc_id AS line_no, {_REASON} AS reason FROM documents WHERE {_REASON} IS NOT NULL")
def skipped_lines(spark, d):
    return index.skipped_lines(_json_lines(spark, d)).select("line_no", "reason")


def _stream(spark: SparkSession, d: str) -> DataFrame:
    """(pos, token): for each line that gives a document its id modulo 50, plus 10, as often as its id modulo 5, and an end token."""
    good = sample.with_rank(_json_lines(spark, d).filter(M.skip_reason(F.col("raw")).isNull()), [F.col("line_no")], "_n")
    sized = sample.with_running(good, [F.col("line_no")], F.col("line_no") % 5 + 1, "_sum")
    each = sized.select("line_no", "_sum", F.posexplode(F.sequence(F.lit(0), (F.col("line_no") % 5).cast("int"))).alias("k", "x"))
    size = F.col("line_no") % 5 + 1
    return each.select((F.col("_sum") - size + F.col("k")).alias("pos"), F.when(F.col("k") == size - 1, 3).otherwise(F.col("line_no") % 50 + 10).cast("int").alias("token"))


_GOOD = f"g AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS doc_idx, doc_id AS line_no, source, doc_id % 5 + 1 AS n_tok, (sum(doc_id % 5 + 1) OVER (ORDER BY doc_id))::BIGINT - 1 AS eos_off FROM documents WHERE {_REASON} IS NULL)"


@query(f"WITH {_GOOD} SELECT doc_idx, line_no, source, n_tok, eos_off FROM g")
def finalized_index(spark, d):
    return index.finalized(_json_lines(spark, d), _stream(spark, d))


@query(f"WITH {_GOOD} SELECT doc_idx, eos_off, n_tok FROM g")
def eos_scan(spark, d):
    return index.lengths(index.eos_offsets(_stream(spark, d)))


@query(f"WITH {_GOOD}, s AS (SELECT *, doc_idx % 7 AS f FROM g) SELECT 'part' || f::VARCHAR AS file, sum(n_tok)::BIGINT AS tokens, count(*) AS docs, true AS ends_on_eos FROM s GROUP BY f")
def shard_ends(spark, d):
    spans = index.lengths(index.eos_offsets(_stream(spark, d))).withColumn("first", F.col("eos_off") - F.col("n_tok") + 1)
    docs = index.doc_tokens(_stream(spark, d), spans.select("doc_idx", "first", F.col("eos_off").alias("last")))
    rows = docs.select(F.concat(F.lit("part"), (F.col("doc_idx") % 7).cast("string")).alias("file"), F.posexplode("tokens").alias("k", "token"), "doc_idx")
    return index.shard_ends(rows.select("file", (F.col("doc_idx") * 100 + F.col("k")).alias("at"), "token"))


@query(f"WITH {_GOOD} SELECT doc_idx, list_transform(range(1, n_tok + 1), lambda k: CASE WHEN k = n_tok THEN 3 ELSE line_no % 50 + 10 END)::INTEGER[] AS tokens FROM g")
def shard_documents(spark, d):
    spans = index.lengths(index.eos_offsets(_stream(spark, d)))
    return index.doc_tokens(_stream(spark, d), spans.select("doc_idx", (F.col("eos_off") - F.col("n_tok") + 1).alias("first"), F.col("eos_off").alias("last")))


@query(f"WITH {_GOOD} SELECT min(doc_idx) AS doc_idx FROM g WHERE doc_idx >= 40")
def first_mismatch(spark, d):
    docs = index.finalized(_json_lines(spark, d), _stream(spark, d)).select("doc_idx", F.col("line_no").cast("string").alias("text"))
    decoded = docs.select("doc_idx", F.when(F.col("doc_idx") < 40, F.col("text")).otherwise("x").alias("decoded"))
    return index.first_mismatch(decoded, docs)


@query(f"WITH {_GOOD}, t AS (SELECT doc_idx FROM g ORDER BY {_order(42, 'doc_idx')}, doc_idx LIMIT 3) SELECT doc_idx, doc_idx % 2 = 0 AS same FROM t")
def sanity_decode(spark, d):
    docs = index.finalized(_json_lines(spark, d), _stream(spark, d)).select("doc_idx", F.col("line_no").cast("string").alias("text"))
    return index.sanity(docs, docs.select("doc_idx", F.when(F.col("doc_idx") % 2 == 0, F.col("text")).alias("decoded")), docs)


@query(f"SELECT c AS \"check\", got FROM (SELECT 'tokens' AS c, sum({_N_TOK})::BIGINT AS got FROM documents UNION ALL SELECT 'longest', max({_N_TOK}) FROM documents)")
def index_violations(spark, d):
    docs = _indexed(spark, d)
    return index.violations(docs, docs.count(), 7, 3)


@query(f"WITH s AS (SELECT CASE WHEN source IN ('src1', 'src2') THEN 'editorial' ELSE 'web' END AS class, {_N_TOK} AS n FROM documents) SELECT class, count(*) AS docs, sum(n)::BIGINT AS tokens, round(100 * sum(n) / (SELECT sum(n) FROM s), 6) AS pct, round(sum(n) / count(*), 6) AS mean_tokens FROM s GROUP BY class")
def class_totals(spark, d):
    out = index.class_totals(index.source_totals(_indexed(spark, d), ("src1", "src2")))
    return out.select("class", "docs", "tokens", F.round("pct", 6).alias("pct"), F.round("mean_tokens", 6).alias("mean_tokens"))


@query("SELECT doc_id, s.source, code FROM documents JOIN (SELECT source, (row_number() OVER (ORDER BY min(doc_id)) - 1)::INTEGER AS code FROM documents GROUP BY source) s USING (source)")
def coded_documents(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    return docs.join(F.broadcast(index.source_codes(docs.withColumnRenamed("doc_id", "line_no")).select("source", "code")), "source").select("doc_id", "source", "code")


@query("SELECT doc_id AS line_no, k AS place, CASE WHEN k = 0 THEN '{\"a\": \"}{\"}' ELSE '{\"b\": ' || doc_id::VARCHAR || '}' END AS object FROM documents, range(0, 2) r(k)")
def fused_objects(spark, d):
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("line_no"), F.concat(F.lit('{"a": "}{"}{"b": '), F.col("doc_id").cast("string"), F.lit("}")).alias("raw"))
    return index.fused_objects(lines).filter("valid").select("line_no", "place", "object")


@query("SELECT o_orderkey, o_orderkey AS step, o_orderkey + 1000 AS steps, round((o_orderkey % 97) / 10.0::DOUBLE, 1) AS loss, round((o_orderkey % 83) / 10.0::DOUBLE, 1) AS ktok FROM orders")
def log_lines(spark, d):
    k = F.col("o_orderkey")
    line = F.format_string("[step %,d/%,d] loss %.1f | lr 1e-4 | %.1fk tok/s", k, k + 1000, (k % 97) / 10.0, (k % 83) / 10.0)
    return table(spark, d, "orders").select("o_orderkey", M.log_fields(line).alias("f")).select("o_orderkey", "f.*")


@query("SELECT o_orderkey, CASE WHEN r > 0 THEN round(1000 * 65536 / r, 3) END AS eta, CASE WHEN r > 0 THEN round(1000 * 65536 / r / 3600 * 2.5 * 4, 6) END AS price FROM (SELECT o_orderkey, (o_orderkey % 5) * 1000.0::DOUBLE AS r FROM orders)")
def budget_and_eta(spark, d):
    rate = (F.col("o_orderkey") % 5) * F.lit(1000.0)
    hours = M.training_hours(F.lit(1000), 65536, rate)
    return table(spark, d, "orders").select("o_orderkey", F.round(M.remaining_seconds(F.lit(0), F.lit(1000), 65536, rate), 3).alias("eta"), F.round(M.budget_estimate(F.lit(2.5), hours, 4), 6).alias("price"))


# --- instruction data -------------------------------------------------------
@query(f"WITH {_PAIRS} SELECT conv_id, turn, instruction, reponse FROM p")
def sft_examples(spark, d):
    """Pairs wrapped as models put them, and taken out again."""
    pairs = sft.conversation_pairs(table(spark, d, "conversations"))
    one = F.to_json(F.struct("instruction", "reponse"))
    other = F.to_json(F.struct(F.col("instruction").alias("question"), F.col("reponse").alias("answer")))
    raw = (
        F.when(F.col("turn") % 4 == 0, F.concat(F.lit("<think>{no}</think>```json\n"), one, F.lit("\n```"))).when(F.col("turn") % 4 == 1, F.concat(F.lit('{"exemples": ['), other, F.lit("]}")))
        .when(F.col("turn") % 4 == 2, F.concat(F.lit("Voici : "), one, F.lit(" fin"))).otherwise(F.concat(F.lit("["), other, F.lit("]")))
    )
    return sft.examples(pairs.select("conv_id", "turn", raw.alias("raw")))


_FOLD = _strip("regexp_replace(lower(instruction), '" + _SP + "+', ' ', 'g')")


@query(f"""WITH {_PAIRS}, k AS (SELECT *, conv_id * 1000 + turn AS ord, row_number() OVER (PARTITION BY {_FOLD} ORDER BY conv_id * 1000 + turn) AS r FROM p WHERE instruction <> '' AND reponse <> ''),
n AS (SELECT *, row_number() OVER (ORDER BY {_order(42, 'ord')}, ord) AS place, count(*) OVER () AS total FROM k WHERE r = 1)
SELECT '<|im_start|>user' || chr(10) || instruction || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || reponse || '<|im_end|>' AS text, 'r' || (turn % 3)::VARCHAR AS registre,
  CASE WHEN place <= greatest(1, floor(total * 0.02::DOUBLE)) THEN 'val' ELSE 'train' END AS split FROM n""")
def chatml_split(spark, d):
    pairs = sft.conversation_pairs(table(spark, d, "conversations")).withColumns({"ord": F.col("conv_id") * 1000 + F.col("turn"), "registre": F.concat(F.lit("r"), (F.col("turn") % 3).cast("string"))})
    return sft.chatml_rows(pairs, "ord")


_IDS = f"list_transform({_words('text')}, lambda w: length(w) % 10)::INTEGER[]"
_MASKED = f"""
i AS (SELECT doc_id, {_IDS} AS ids FROM documents), a AS (SELECT *, list_max(list_filter(range(1, len(ids)), lambda k: ids[k] = 3 AND ids[k + 1] = 2)) AS place FROM i),
l AS (SELECT *, list_transform(range(1, len(ids) + 1), lambda k: CASE WHEN k >= place + 2 THEN ids[k] ELSE -100 END)[1:64] AS labels, ids[1:64] AS input_ids FROM a WHERE place IS NOT NULL),
m AS (SELECT doc_id, input_ids, labels::INTEGER[] AS labels FROM l WHERE len(list_filter(labels, lambda x: x <> -100)) > 0)"""


def _masked(spark: SparkSession, d: str) -> DataFrame:
    ids = F.transform(M.words(F.col("text")), lambda w: (F.length(w) % 10).cast("int"))
    # the ids are a column of their own: in a lambda the text would be taken apart for each of them
    held = sinks.staged(table(spark, d, "documents").select("doc_id", ids.alias("ids")))
    out = held.select("doc_id", sft.masked(F.col("ids"), F.array(F.lit(3), F.lit(2)), 64).alias("m"))
    return out.filter("m is not null").select("doc_id", "m.input_ids", "m.labels")


@query(f"WITH {_MASKED} SELECT doc_id, input_ids, labels FROM m")
def masked_examples(spark, d):
    return _masked(spark, d)


@query(f"WITH {_MASKED} SELECT doc_id, list_transform(range(1, 80), lambda k: coalesce(input_ids[k], 3))::INTEGER[] AS x, list_transform(range(2, 81), lambda k: coalesce(labels[k], -100))::INTEGER[] AS y FROM m")
def collated_examples(spark, d):
    return sft.collated(_masked(spark, d), 80)


@query("SELECT round(avg(value), 6) AS loss, round(exp(least(avg(value), 20.0)), 3) AS perplexity FROM events WHERE event_id % 3 <> 0")
def masked_loss(spark, d):
    rows = table(spark, d, "events").select(F.col("value").alias("loss"), F.when(F.col("event_id") % 3 == 0, sft.IGNORED).otherwise(1).alias("label"))
    return sft.masked_loss(rows).select(F.round("loss", 6).alias("loss"), F.round("perplexity", 3).alias("perplexity"))


# --- samples, selection -----------------------------------------------------
@query(f"SELECT doc_id, row_number() OVER (ORDER BY {_order(42, 'doc_id')}, doc_id) - 1 AS place FROM documents")
def shuffle_places(spark, d):
    return sample.shuffle_place(table(spark, d, "documents").select("doc_id"), "doc_id")


@query(f"SELECT doc_id FROM (SELECT doc_id, strlen(text) AS b, sum(strlen(text)) OVER (ORDER BY doc_id) AS s FROM documents WHERE {_uniform(42, 'doc_id')} <= 0.5) WHERE s - b < 100000")
def sample_to_bytes(spark, d):
    return sample.bernoulli_to(table(spark, d, "documents").select("doc_id", "text"), "doc_id", F.octet_length("text"), 100_000, 200_000).select("doc_id")


@query("SELECT conv_id, role, turn FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS n FROM conversations) WHERE n = 1")
def newest_by_id(spark, d):
    return dedup.first_by(table(spark, d, "conversations"), ["conv_id"], [F.desc("turn")]).select("conv_id", "role", "turn")


@query("SELECT source, arg_min(doc_id, (-n_chars, doc_id)) AS doc_id FROM (SELECT source, doc_id, n_chars FROM documents) GROUP BY source")
def longest_per_source(spark, d):
    return select.best_of(table(spark, d, "documents"), "source", "doc_id", "n_chars")


@query("SELECT row_number() OVER (ORDER BY n_nationkey, r_regionkey) AS try_no, n_nationkey AS candidate_no, r_regionkey AS place_no FROM nation, region")
def try_list(spark, d):
    return select.try_list(table(spark, d, "nation").select(F.col("n_nationkey").alias("candidate_no")), table(spark, d, "region").select(F.col("r_regionkey").alias("place_no")))


@query("SELECT event_id FROM events ORDER BY event_id DESC LIMIT 5")
def newest_checkpoints(spark, d):
    return sinks.latest(table(spark, d, "events"), "event_id", 5).select("event_id")


@query("SELECT n_nationkey FROM nation WHERE n_regionkey NOT IN (1, 3)")
def pending_files(spark, d):
    files = table(spark, d, "nation").withColumn("path", F.col("n_regionkey").cast("string"))
    return sinks.pending(files, files.filter("n_regionkey in (1, 3)")).select("n_nationkey")


@query("SELECT n_name AS source, CASE WHEN n_regionkey = 2 THEN 100 ELSE n_nationkey END::BIGINT AS lines_done, n_regionkey::BIGINT AS kept FROM nation")
def progress_upsert(spark, d):
    old = table(spark, d, "nation").select(F.col("n_name").alias("source"), F.col("n_nationkey").cast("long").alias("lines_done"), F.col("n_regionkey").cast("long").alias("kept"))
    return sinks.progress_upsert(old, old.filter("kept = 2").withColumn("lines_done", F.lit(100).cast("long")))


@query(f"WITH s AS (SELECT DISTINCT {_NAMED} AS source FROM documents), o AS (SELECT source, list_position({list(SOURCE_ORDER)}, source) AS p FROM s) SELECT source, (row_number() OVER (ORDER BY p NULLS LAST, source) - 1)::INTEGER AS source_rank FROM o")
def source_ranks(spark, d):
    return readers.source_ranks(spark, [r.source for r in named(spark, d).select("source").distinct().collect()])


# --- readers and sinks, there and back --------------------------------------
def _folder(spark: SparkSession, name: str) -> str:
    return f"{sinks.staging_dir(spark)}/{name}-{sinks.uuid.uuid4().hex}"


@query("SELECT doc_id::VARCHAR AS id, source, md5(text) AS digest FROM documents WHERE text <> ''")
def jsonl_there_and_back(spark, d):
    path = _folder(spark, "jsonl")
    sinks.write_jsonl(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("id"), "source", "text"), path, ascii_only=True, rows_per_file=300)
    return readers.read_jsonl(spark, path).select("id", "source", F.md5(F.col("text").cast("binary")).alias("digest"))


@query(f"SELECT 'hplt' AS source, md5(text) AS digest, count(*) AS n FROM documents WHERE {_strip('text')} <> '' GROUP BY text")
def parquet_there_and_back(spark, d):
    path = _folder(spark, "parquet")
    table(spark, d, "documents").select(F.col("text").alias("content"), "lang").write.parquet(path)
    out = readers.read_source(spark, "hplt", path)
    return out.groupBy("source", F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.count_distinct("id").alias("n"))


@query("SELECT md5(doc_id::VARCHAR || chr(10) || source) AS digest, 1::BIGINT AS n FROM documents")
def plain_text_there_and_back(spark, d):
    path = _folder(spark, "plain")
    table(spark, d, "documents").select(F.concat(F.col("doc_id").cast("string"), F.lit("\n"), F.col("source"), F.lit("\n"))).write.text(path)
    return readers.read_source(spark, "cc100", path).groupBy(F.md5(F.col("text").cast("binary")).alias("digest")).agg(F.count_distinct("id").alias("n"))


@query(f"WITH {_GOOD} SELECT sum(n_tok)::BIGINT AS tokens, count(*) AS rows FROM g")
def token_sink(spark, d):
    stream = _stream(spark, d)
    spans = index.lengths(index.eos_offsets(stream))
    docs = index.doc_tokens(stream, spans.select("doc_idx", (F.col("eos_off") - F.col("n_tok") + 1).alias("first"), F.col("eos_off").alias("last"))).withColumnRenamed("doc_idx", "pos")
    path = _folder(spark, "tokens")
    n = sinks.write_tokens(spark, docs, path)
    return spark.read.parquet(path).agg(F.lit(n).cast("long").alias("tokens"), F.count("*").alias("rows"))


@query(f"WITH {_BY_SOURCE} SELECT source, count(*) AS total, count(*) FILTER (reason IS NULL) AS kept FROM gated GROUP BY source")
def gated_by_source(spark, d):
    return gates.gate_counts(gates.with_reason(named(spark, d))).select("source", "total", "kept")


@query("""WITH l AS (SELECT doc_id AS line_no, CASE WHEN lang = 'en' THEN '' ELSE md5(text) END AS line FROM documents),
b AS (SELECT *, count(*) FILTER (line = '') OVER (ORDER BY line_no) AS b FROM l)
SELECT min(line_no) AS doc, md5(string_agg(line, chr(10) ORDER BY line_no)) AS digest FROM b WHERE line <> '' GROUP BY b""")
def paragraphs_of_lines(spark, d):
    lines = table(spark, d, "documents").select(F.col("doc_id").alias("line_no"), F.when(F.col("lang") == "en", "").otherwise(F.md5(F.col("text").cast("binary"))).alias("line"))
    return readers.paragraphs(lines).select("doc", F.md5(F.col("text").cast("binary")).alias("digest"))


# --- near duplicates, piece by piece ----------------------------------------
#: As the greedy query, but for the hash and the number of permutations, which SQL can follow.
_MD5 = MinHashParams(permutations=16, bands=4, hash="md5")
_SHINGLED = f"{_VIEW}, s AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, length(t) - 3), lambda i: substr(t, i, 5))) AS g FROM v)"


def _signed_sql() -> str:
    a, b = dedup.permutations(_MD5)
    rows = ", ".join(f"({k}, {x}, {y})" for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)))
    return f"""{_SHINGLED}, h AS MATERIALIZED (SELECT DISTINCT doc_id, ('0x' || substr(md5(g), 1, 8))::BIGINT AS h FROM s), p(k, a, b) AS (VALUES {rows}),
m AS MATERIALIZED (SELECT doc_id, k, min((((a::HUGEINT * h + b) % {dedup.MERSENNE}) % 4294967296)::BIGINT) AS m FROM h, p GROUP BY ALL),
sig AS MATERIALIZED (SELECT doc_id, coalesce(list(m ORDER BY k) FILTER (m IS NOT NULL), list_transform(range(0, 16), lambda x: 4294967295)) AS signature FROM documents LEFT JOIN m USING (doc_id) GROUP BY doc_id),
bands AS MATERIALIZED (SELECT doc_id, j AS band, array_to_string(signature[j * 4 + 1 : j * 4 + 4], ',') AS key FROM sig, range(0, 4) r(j))"""


_SIGNED = _signed_sql()
_GREEDY = f"""{_SIGNED}, o AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id) AS i, doc_id, ks FROM (SELECT doc_id, list(hash(band, key)) AS ks FROM bands GROUP BY doc_id)),
r AS (SELECT 0::BIGINT AS i, 0::BIGINT AS doc_id, false AS keep, []::UBIGINT[] AS seen
  UNION ALL SELECT o.i, o.doc_id, NOT list_has_any(r.seen, o.ks), CASE WHEN list_has_any(r.seen, o.ks) THEN r.seen ELSE list_concat(r.seen, o.ks) END FROM r JOIN o ON o.i = r.i + 1),
kept AS (SELECT doc_id, keep FROM r WHERE i > 0)"""


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), "source", "text")


@query(f"WITH {_SHINGLED} SELECT doc_id, count(g) AS n FROM documents LEFT JOIN s USING (doc_id) GROUP BY doc_id")
def shingle_counts(spark, d):
    views = sinks.staged(table(spark, d, "documents").select("doc_id", T.windows(F.col("text")).alias("view")))
    return views.select("doc_id", F.size(dedup.shingles(F.col("view"))).cast("long").alias("n"))


@query(f"WITH {_SIGNED} SELECT doc_id, array_to_string(signature, ',') AS signature FROM sig")
def minhash_signatures(spark, d):
    return dedup.with_signature(_documents(spark, d), _MD5).select(F.col("id").alias("doc_id"), F.array_join("signature", ",").alias("signature"))


@query(f"WITH {_SIGNED}, f AS (SELECT band, key, min(doc_id) AS first FROM bands GROUP BY ALL) SELECT doc_id, min(first) AS first, count(*) AS bands FROM bands JOIN f USING (band, key) WHERE first < doc_id GROUP BY doc_id")
def band_matches(spark, d):
    return dedup.band_matches(dedup.band_keys(dedup.with_signature(_documents(spark, d), _MD5), _MD5)).select(F.col("id").alias("doc_id"), "first", "bands")


@query(f"WITH {_SIGNED}, f AS (SELECT doc_id, min(first) AS first FROM bands JOIN (SELECT band, key, min(doc_id) AS first FROM bands GROUP BY ALL) USING (band, key) WHERE first < doc_id GROUP BY doc_id) SELECT f.doc_id, round(len(list_filter(range(1, 17), lambda k: a.signature[k] = b.signature[k])) / 16, 6) AS alike FROM f JOIN sig a ON a.doc_id = f.doc_id JOIN sig b ON b.doc_id = first")
def signature_similarity(spark, d):
    signed = sinks.staged(dedup.with_signature(_documents(spark, d), _MD5))
    first = dedup.band_matches(dedup.band_keys(signed, _MD5))
    met = first.join(signed.select("id", F.col("signature").alias("a")), "id").join(signed.select(F.col("id").alias("first"), F.col("signature").alias("b")), "first")
    return met.select(F.col("id").alias("doc_id"), F.round(dedup.similarity(F.col("a"), F.col("b")), 6).alias("alike"))


@query(f"WITH RECURSIVE {_GREEDY} SELECT doc_id, keep FROM kept")
def near_dup_kept(spark, d):
    return dedup.near_dedup(_documents(spark, d), _MD5).select(F.col("id").alias("doc_id"), "keep")


@query(f"WITH RECURSIVE {_GREEDY} SELECT source, count(*) AS \"read\", count(*) FILTER (keep AND n_chars >= 300) AS kept, count(*) FILTER (NOT keep) AS dup, count(*) FILTER (keep AND n_chars < 300) AS low_quality FROM documents JOIN kept USING (doc_id) GROUP BY source")
def dedup_statistics(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", "n_chars")
    return dedup.dedup_stats(docs, dedup.near_dedup(_documents(spark, d), _MD5), F.col("n_chars") < 300)


@query(f"""WITH RECURSIVE big AS MATERIALIZED (SELECT * FROM documents WHERE length(text) >= 50),
judged AS MATERIALIZED (WITH {_SCORE} SELECT doc_id, CASE WHEN {_NAMED} NOT IN {PREMIUM_SOURCES} THEN score END AS score FROM s WHERE length(text) >= 50),
ranked AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS k FROM judged WHERE score IS NOT NULL),
once AS MATERIALIZED (WITH RECURSIVE documents AS (SELECT * FROM big), {_GREEDY} SELECT doc_id, keep FROM kept)
SELECT doc_id, keep AND (score IS NULL OR score >= (SELECT score FROM ranked WHERE i = least(floor(k * (1 - 0.85::DOUBLE)), k - 1))) AS keep, round(score, 6) AS score FROM judged JOIN once USING (doc_id)""")
def dedup_quality_plan(spark, d):
    """The whole plan of ``dedup_and_quality`` under sources that have parameters of their own."""
    docs = named(spark, d).select(F.col("doc_id").alias("id"), F.col("doc_id").alias("ord"), "source", "text")
    return dedup_quality(docs, _MD5).select(F.col("id").alias("doc_id"), "keep", F.round("score", 6).alias("score"))
