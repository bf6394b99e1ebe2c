import bz2
import io
import json
import lzma
import random
import tarfile

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from lexmill.config import MinHashParams
from lexmill.functions import metrics as M
from lexmill.functions import text as T
from lexmill.operators import blend, dedup, index, ranks, select, sft
from lexmill.sources import readers, sinks
from lexmill.streaming import incremental

from .conftest import same


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {'string' if isinstance(v, str) else 'array<int>' if isinstance(v, list) else 'long'}" for k, v in cols.items()))
    return df.select(expr.alias("x")).first()[0]


@pytest.mark.parametrize("raw, want", [
    ("a<!-- x -->b", "ab"), ("x<ref name=a>y</ref>z<ref name=b/>!", "xz!"), ("{{a|{{b}}}}c{{d}}", "c"), ("[[Paris|la ville]] et [[Lyon]]", "la ville et Lyon"),
    ("[http://a.b texte]", "texte"), ("== Titre ==\nx", " Titre \n\nx"), ("{{a{{b{{c{{d}}}}}}}}e", "e"), ("[[Fichier:x.jpg]]k", "k"),
])
def test_wiki_markup(spark, raw, want):
    assert one(spark, T.wiki_markup(F.col("t")), t=raw) == want


@pytest.mark.parametrize("raw, want", [("  «a»  ‘b’ –\n\n\n\nc ", "\"a\" 'b' -\n\nc"), ("d\u00c3\u00a9j\u00c3\u00a0 vu", "déjà vu"), ("x" * 120 + "Ã©", "x" * 120 + "Ã©"), ("Ã 漢", "Ã 漢")])
def test_normalize(spark, raw, want):
    assert one(spark, T.normalize(F.col("t")), t=raw) == want


def test_clean_chain(spark):
    assert one(spark, T.clean(F.col("t")), t="Bonjour <b>toi</b>\nMentions Légales ici\nvoir http://x.y/z ou a.b@c.de fin") == "Bonjour toi\nvoir ou fin"


def test_entropy(spark):
    assert one(spark, M.entropy(F.col("t")), t="aabb") == pytest.approx(1.0)
    assert one(spark, M.entropy(F.col("t")), t="") == 0.0


@pytest.mark.parametrize("word, bad", [("bonjour", False), ("xnzr", True), ("n8oob", True), ("1984", False), ("привет", True), ("arts", False), ("BoNjOur", True), ("Schtzsch", True)])
def test_suspect_word(spark, word, bad):
    assert one(spark, M.is_suspect_word(F.col("t")), t=word) is bad


def test_split_lines(spark):
    got = one(spark, T.split_lines(F.col("t")), t="Une phrase assez longue ici. Courte. Une autre phrase assez longue !\n" + "mot " * 1500)
    assert got[:2] == ["Une phrase assez longue ici.", "Une autre phrase assez longue !"]
    assert all(20 <= len(x) <= 4000 for x in got) and "".join(got[2:]).count("mot") == 1500

    assert one(spark, T.split_lines(F.col("t")), t="abcde " + "x" * 4500) == ["abcde", "x" * 4000, "x" * 500]
    assert one(spark, T.split_lines(F.col("t")), t="x" * 4010) == ["x" * 4000]
    assert [len(x) for x in one(spark, T.split_lines(F.col("t")), t="x" * 3999 + "  " + "y" * 4000 + " " + "z" * 30)] == [3999, 4000, 30]


def test_language_detector(spark):
    said = lambda lang, prob: lambda t: F.struct(F.lit(lang).alias("lang"), F.lit(prob).alias("prob"))
    doubtful, foreign = "le " + "mot " * 60, "word " * 60
    for text, detector, want in (
        (doubtful, None, True), (doubtful, said("fr", 0.99), True), (doubtful, said("en", 0.99), False), (doubtful, said("en", 0.5), True), (doubtful, lambda t: F.lit(None).cast("struct<lang:string,prob:double>"), True),
        (foreign, said("fr", 0.99), False), ("short", said("en", 0.99), True),
    ):
        assert one(spark, M.is_french(F.col("t"), 0.08, detector), t=text) is want


def test_windows(spark):
    assert one(spark, T.windows(F.col("t")), t="  A  B ") == "a b"
    assert len(one(spark, T.windows(F.col("t")), t="x" * 50_000)) == 9002


def test_signature_equals_integers():
    p = MinHashParams(permutations=16, bands=4)
    a, b = dedup.permutations(p)
    x = np.array([0, 1, 77, 2**32 - 1, 123456789], dtype=np.uint64)
    want = [min((int(i) * int(j) + int(k)) % dedup.MERSENNE & 0xFFFFFFFF for i in x) for j, k in zip(a, b, strict=True)]
    assert dedup.signature(x, a, b).tolist() == want
    assert dedup.signature(x[:0], a, b).tolist() == [dedup.EMPTY] * 16


def test_texts_are_signed_together(monkeypatch):
    """A shingle that many texts have is hashed and permuted once, and the signatures are those of each text alone."""
    rng = random.Random(5)
    texts = ["", "abc", "abcde", "été ß ΣΑΣ", "\U0001f600" * 9] + ["".join(rng.choice("ab é漢") for _ in range(rng.randrange(300))) for _ in range(60)]
    texts += ["".join(chr(rng.randrange(0x4E00, 0x9FFF)) for _ in range(6000))] * 2  # too many letters for one word of bits
    counts, hashed = [], dedup._hashed
    monkeypatch.setattr(dedup, "_hashed", lambda own, n, kind: counts.append(n) or hashed(own, n, kind))
    for p in (MinHashParams(), MinHashParams(permutations=16, bands=4, hash="md5")):
        a, b = dedup.permutations(p)
        want = [dedup.signature(dedup.base_hashes(t, p.shingle, p.hash), a, b).tolist() for t in texts]
        counts.clear()
        assert dedup.signatures(texts, p, a, b).tolist() == want
        assert counts == [len({t[i : i + 5] for t in texts for i in range(len(t) - 4)})]
        with monkeypatch.context() as m:
            m.setattr(dedup, "TABLE", 500)
            assert dedup.signatures(texts, p, a, b).tolist() == want


def test_passes_equal_columns(spark):
    """The view and the score of a Python string are those of the expressions."""
    rng = random.Random(6)
    odd = "\t\n\x0b\x1c\x1f\x85\u00a0\u1680\u2003\u2028\u202f\u3000\u200b\u180eabcÉÎŒœßİΣς_9²½٣漢\U0001f600e\u0301'-."
    texts = ["", " ", "x", "ΟΔΟΣ ΟΔΟΣ", "le la les de du", "x" * 50_000, "le petit chat et la ville " * 900, "mot_1 le l'été de " * 40]
    texts += ["".join(rng.choice(odd) for _ in range(n)) for n in (1, 5, 60, 700, 2500, 9100, 17_999, 18_001, 40_000, 110_000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string")
    for r in docs.select("id", T.windows(F.col("text")).alias("w"), M.quality_score(F.col("text")).alias("s")).collect():
        assert T.window_text(texts[r.id]) == r.w
        assert M.quality_of(texts[r.id]) == pytest.approx(r.s, abs=1e-12)


def test_texts_are_passed_once(spark, monkeypatch):
    """The plan scores and signs in one pass; no expression scores a text again."""
    from lexmill.functions.metrics import quality_score
    from lexmill.plans import corpus

    texts = ["Le chat de la maison dort sur le tapis rouge du salon %d." % i for i in range(30)] + ["zz " * 30, "Short.", None]
    rows = [(i, i, ("wikipedia", "web", None)[i % 3], t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "id long, ord long, source string, text string")
    want = {r.id: r.s for r in docs.filter("length(text) >= 50").select("id", F.when(F.col("source") == "web", quality_score(F.col("text"))).alias("s")).collect()}
    kept = {r.id: r.keep for r in dedup.near_dedup(docs.filter("length(text) >= 50")).collect()}
    monkeypatch.setattr(corpus, "quality_score", None)
    got = {r.id: r for r in corpus.dedup_quality(docs).collect()}
    assert {i: r.score for i, r in got.items()} == pytest.approx(want)
    limit = sorted(s for s in want.values() if s is not None)[int(sum(s is not None for s in want.values()) * (1 - 0.85))]
    assert {i: r.keep for i, r in got.items()} == {i: kept[i] and (s is None or got[i].score >= limit - 1e-12) for i, s in want.items()}


def test_cheapest_of_equal_offers(spark):
    """Of offers with one price and name the smallest items are taken, wherever they stand."""
    rows = [(i, "blue gear", 900.0) for i in range(60, 0, -1)] + [(0, "blue gear", 901.0), (61, "blue anvil", 900.0)]
    for n in (1, 7):
        offers = spark.createDataFrame(rows, "item long, name string, price double").repartition(n)
        assert [r.item for r in select.cheapest(offers, "Blu", 1500.0, 5).collect()] == [61, 1, 2, 3, 4]


def test_length_profile_equals_sql_on_odd_texts(spark, tmp_path):
    import duckdb

    from lexmill.queries import ORACLES, QUERIES

    texts = ["", None, "a\x0b" * 30, "a\r\n\t\f" * 30, "a\u00a0" * 30, "a" * 85 + "#" * 15, "a" * 1700 + "#" * 300 + "#" * 900, "#" * 60, "\U0001f600a" * 40]
    rows = [(i, t, s) for i, t in enumerate(texts) for s in (f"s{i}", "all", None)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    same(QUERIES["length_profile"](spark, str(tmp_path)), con, ORACLES["length_profile"])


def test_greedy_is_not_transitive(spark):
    keyed = spark.createDataFrame([(1, 1, 0, "a"), (2, 2, 0, "a"), (2, 2, 1, "b"), (3, 3, 1, "b"), (4, 4, 0, "z")], "id long, ord long, band int, key string")
    assert {r.id: r.keep for r in dedup.settle(keyed).collect()} == {1: True, 2: False, 3: True, 4: True}


def test_greedy_equals_sequential_on_random_bands(spark):
    rng = random.Random(4)
    rows = [(i, i, band, str(rng.choice((0, rng.randrange(40))))) for i in range(250) for band in range(3)]
    seen, want = set(), {}
    for i in range(250):
        own = {(b, k) for j, _, b, k in rows if j == i}
        want[i] = not own & seen
        seen |= own if want[i] else set()
    assert {r.id: r.keep for r in dedup.settle(spark.createDataFrame(rows, "id long, ord long, band int, key string")).collect()} == want


def test_near_dedup_equals_sequential(spark):
    rng = random.Random(3)
    base = [" ".join(rng.choice("alpha beta gamma delta rho sigma tau phi chi psi".split()) + str(rng.randrange(30)) for _ in range(60)) for _ in range(12)]
    texts = [t if rng.random() < 0.4 else t + " fin" + str(rng.randrange(9)) for t in base for _ in range(4)]
    p = MinHashParams()
    docs = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "id long, ord long, text string")
    got = {r.id: r.keep for r in dedup.near_dedup(docs, p).collect()}
    a, b = dedup.permutations(p)
    seen, want = set(), {}
    for i, t in enumerate(texts):
        sig = dedup.signature(dedup.base_hashes(t.lower(), p.shingle), a, b)
        bands = {(k, *sig[k * p.rows : (k + 1) * p.rows].tolist()) for k in range(p.bands)}
        want[i] = not bands & seen
        if want[i]:
            seen |= bands
    assert got == want


def test_ranks_over_partitions(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919 % 1000))
    rows = ranks.with_running(df, [F.col("v")], F.col("v"), "s").collect()
    assert all(r.s == r.v * (r.v + 1) // 2 for r in rows)


def test_windows_of_stream(spark):
    for n in (4, 5, 9, 13):
        df = spark.range(n).select(F.col("id").alias("pos"), F.col("id").cast("int").alias("token"))
        got = {r.k: (r.x, r.y) for r in blend.windows_of(df, n, 4).collect()}
        assert got == {k: (list(range(4 * k, 4 * k + 4)), list(range(4 * k + 1, 4 * k + 5))) for k in range((n - 1 - 4) // 4 + 1 if n > 4 else 0)}


def test_budget_of_an_empty_source(spark):
    docs = spark.createDataFrame([(1, "a", 10), (2, "a", 10)], "doc_idx long, source string, n_tok long")
    plan = blend.budgets(docs, 100, {"a": 0.5, "gone": 0.5}, {"a": 2})
    assert {r.source: r.budget for r in plan.collect()} == {"a": 40, "gone": 0}
    assert blend.select_documents(docs, plan, 1).count() == 4


def test_index_over_skipped_lines(spark):
    raw = ['{"text": "a"}', "", "{broken", '{"text": ""}', '{"content": "b"}', "[1]"]
    lines = spark.createDataFrame(list(enumerate(raw)), "line_no long, raw string")
    assert [r.reason for r in index.skipped_lines(lines).orderBy("line_no").collect()] == ["blank", "invalid", "no text", "not an object"]
    docs = spark.createDataFrame([(0, "a"), (1, "b")], "doc_idx long, decoded string")
    assert sorted((r.line_no, r.decoded) for r in index.shift_over_skipped(lines, docs).collect()) == [(0, "a"), (4, "b")]


def test_eos_offsets(spark):
    tokens = spark.createDataFrame(list(enumerate([5, 3, 6, 7, 3])), "pos long, token int")
    assert [(r.doc_idx, r.eos_off, r.n_tok) for r in index.lengths(index.eos_offsets(tokens)).orderBy("doc_idx").collect()] == [(0, 1, 2), (1, 4, 3)]


def test_sft_parsing(spark):
    raw = ["<think>x</think>```json\n{\"exemples\": [{\"instruction\": \"i1\", \"réponse\": \"r1\"}, {\"question\": \"i2\", \"answer\": \"r2\"}]}\n```", "bla {\"instruction\": \"i3\", \"reponse\": \"r3\"} fin", "rien"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(raw)], "k int, raw string")
    assert sorted((r.k, r.instruction, r.reponse) for r in sft.examples(df).collect()) == [(0, "i1", "r1"), (0, "i2", "r2"), (1, "i3", "r3")]


def test_masking(spark):
    ids = F.array(*(F.lit(x) for x in (1, 9, 8, 4, 9, 8, 6, 7)))
    marker = F.array(F.lit(9), F.lit(8))
    got = spark.range(1).select(sft.masked(ids, marker, 7).alias("m"), sft.padded(ids, 10, 3).alias("p")).first()
    assert got.m.labels == [-100] * 6 + [6] and len(got.m.input_ids) == 7 and got.p[-2:] == [3, 3]


def test_nucleus_keeps_the_first(spark):
    df = spark.createDataFrame([("g", 1, 5.0), ("g", 2, 1.0), ("g", 3, 0.5)], "grp string, item int, score double")
    assert [r.item for r in select.nucleus(df, "grp", "score", 3, 0.01).collect()] == [1]


def test_readers(spark, tmp_path):
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "livre.txt").write_bytes("été".encode("latin-1"))
    (tmp_path / "b" / "autre.txt").write_bytes("hiver é".encode())
    assert sorted(r.text for r in readers.read_books(spark, str(tmp_path / "b")).collect()) == ["hiver é", "été"]
    (tmp_path / "c").mkdir()
    (tmp_path / "c" / "x.xz").write_bytes(lzma.compress(b"a\nb\n\n\nc"))
    (tmp_path / "c" / "y.txt").write_bytes(b"d\n")
    assert sorted(r.text for r in readers.read_blank_separated(spark, str(tmp_path / "c")).collect()) == ["a\nb", "c", "d"]
    page = "<page><title>T</title><ns>{ns}</ns><id>{i}</id><revision><id>9</id><text>{t}</text></revision></page>"
    dump = "<mediawiki>" + page.format(ns=0, i=1, t="corps") + page.format(ns=0, i=2, t="#REDIRECT [[x]]") + page.format(ns=1, i=3, t="non") + "</mediawiki>"
    (tmp_path / "w.xml.bz2").write_bytes(bz2.compress(dump.encode()))
    assert [(r.id, r.text, r.title) for r in readers.read_wiki(spark, str(tmp_path / "w.xml.bz2")).collect()] == [("wp_1", "corps", "T")]
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode="w:gz") as tar:
        data = f"<R><NOTA>{'n' * 60}</NOTA><CONTENU>{'c' * 60}</CONTENU></R>".encode()
        info = tarfile.TarInfo("a.xml")
        info.size = len(data)
        tar.addfile(info, io.BytesIO(data))
    (tmp_path / "l.tar.gz").write_bytes(buf.getvalue())
    assert [r.text for r in readers.read_legal(spark, str(tmp_path / "l.tar.gz")).collect()] == ["c" * 60 + "\n\n" + "n" * 60]
    (tmp_path / "j.jsonl").write_text("\n".join(['{"text": "a", "id": "1", "source": "s"}', "", "{x", '{"content": "b"}', "[]"]))
    assert sorted(r.text for r in readers.read_jsonl(spark, str(tmp_path / "j.jsonl")).collect()) == ["a", "b"]
    (tmp_path / "t.bin").write_bytes(np.array([5, 3, 65000], dtype="<u2").tobytes())
    assert [r.token for r in readers.read_token_shards(spark, str(tmp_path / "t.bin")).orderBy("at").collect()] == [5, 3, 65000]
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(ValueError):
        readers.read_token_shards(spark, str(tmp_path / "odd.bin"))
    spark.createDataFrame([("x", 1), (" ", 2)], "complete_text string, n int").write.parquet(str(tmp_path / "p"))
    assert [(r.source, r.text) for r in readers.read_source(spark, "pleia_books", str(tmp_path / "p")).collect()] == [("pleia_books", "x")]
    with pytest.raises(ValueError):
        readers.read_source(spark, "mc4", "x")


def test_zstd_lines_and_discovery(spark, tmp_path):
    (tmp_path / "z").mkdir()
    (tmp_path / "z" / "a.zst").write_bytes(zstandard.compress("été\r\nb\n".encode()) + zstandard.compress(b"\nlast"))
    got = readers.read_zstd_lines(spark, str(tmp_path / "z"))
    assert sorted((r.line_no, r.line) for r in got.collect()) == [(1, "été"), (2, "b"), (3, ""), (4, "last")]
    assert sorted(r.line_no for r in readers.read_zstd_lines(spark, str(tmp_path / "z"), max_bytes=8).collect()) == [1, 2]
    for name in ("zeta/zeta_cleaned.jsonl", "hplt/b_cleaned.jsonl", "hplt/a_cleaned.jsonl", "wikipedia/a_cleaned.jsonl", "wikipedia/wikipedia_cleaned.jsonl", "alpha/x_cleaned.jsonl", "none/other.jsonl"):
        (tmp_path / "s" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "s" / name).write_text("")
    found = [(s, p.rpartition("/")[2]) for s, p in readers.discover(spark, str(tmp_path / "s"))]
    assert found == [("wikipedia", "wikipedia_cleaned.jsonl"), ("hplt", "a_cleaned.jsonl"), ("alpha", "x_cleaned.jsonl"), ("zeta", "zeta_cleaned.jsonl")]


def test_windows_go_on(spark):
    df = spark.range(23).select(F.col("id").alias("pos"), F.col("id").alias("token"))
    everything = {r.k: (r.x, r.y) for r in blend.windows_of(df, 23, 4, 3).collect()}
    for start in (0, 2, len(everything), len(everything) + 1):
        assert {r.k: (r.x, r.y) for r in blend.windows_of(df, 23, 4, 3, start).collect()} == {k: v for k, v in everything.items() if k >= start % len(everything)}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "é", "s")], "id string, text string, source string")
    assert sinks.write_jsonl(df, str(tmp_path / "o")) and not sinks.write_jsonl(df, str(tmp_path / "o"))
    line = "".join(p.read_text() for p in (tmp_path / "o").glob("part-*"))
    assert json.loads(line) == {"id": "a", "text": "é", "source": "s"}
    docs = spark.createDataFrame([(1, [7, 3]), (0, [5, 3])], "pos long, tokens array<int>")
    assert sinks.write_tokens(spark, docs, str(tmp_path / "tok")) == 4
    old = spark.createDataFrame([("a", 1, 1), ("b", 2, 2)], "source string, lines_done long, kept long")
    new = spark.createDataFrame([("a", 9, 8)], "source string, lines_done long, kept long")
    assert sorted(map(tuple, sinks.progress_upsert(old, new).collect())) == [("a", 9, 8), ("b", 2, 2)]


def test_stream_ingest(spark, tmp_path):
    text = "\n".join("Le chat est dans la maison avec les enfants et il regarde par la grande porte du jardin vers le soir" + str(k) for k in range(4)) + " de la"
    spark.createDataFrame([(1, "web", text), (2, "web", text), (3, "web", "court")], "doc_id long, source string, text string").write.parquet(str(tmp_path / "in"))
    q = incremental.ingest(spark, str(tmp_path / "in"), "doc_id long, source string, text string", str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_fused_objects(spark):
    lines = spark.createDataFrame([(0, '{"a": "}{"}{"b": 1}'), (1, "[1] x"), (2, "")], "line_no long, raw string")
    got = sorted((r.line_no, r.place, r.object, r.valid) for r in index.fused_objects(lines).collect())
    assert got == [(0, 0, '{"a": "}{"}', True), (0, 1, '{"b": 1}', True), (1, 0, "[1]", True), (1, 1, "x", False)]


def test_log_line(spark):
    got = one(spark, M.log_fields(F.col("t")), t="[step 121,900/478,000] loss 3.2730 | lr 1e-4 | 123.9k tok/s")
    assert (got.step, got.steps, got.loss, got.ktok) == (121900, 478000, 3.273, 123.9)
    assert one(spark, M.log_fields(F.col("t")), t="nothing").loss is None


def test_learning_rate(spark):
    got = [one(spark, M.learning_rate(F.col("s"), 10, 110, 1.0, 0.1), s=s) for s in (0, 9, 10, 60, 110, 500)]
    assert got == pytest.approx([0.1, 1.0, 1.0, 0.55, 0.1, 0.1])


def test_quality_threshold_covers_all_documents(spark):
    """A large source's weak documents count wherever they stand."""
    from lexmill.functions.metrics import quality_score
    from lexmill.plans.corpus import quality_threshold

    good, bad = "The house of the old town was built by the river and the people live there in peace. ", "x9 ## 77 !! zzkt "
    docs = spark.range(300_000).select(F.col("id").alias("ord"), F.when(F.col("id") == 0, "small").otherwise("hot").alias("source"), F.when(F.col("id") < 250_005, good).otherwise(bad).alias("text"))
    score = {r.text: r.s for r in docs.select("text").distinct().select("text", quality_score(F.col("text")).alias("s")).collect()}
    assert score[bad] < score[good] and quality_threshold(docs) == score[bad]
