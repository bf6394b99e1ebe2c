"""Empty tables, nulls, repeated rows, very long values and clashing columns, for every operator and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexmill.llm import brown_lm, chat_threads, decontaminate, mixing, quality_gam, queries, secrets, substring_dedup, topk_nra, url_filter
from lexmill.llm.workspace import table

from ..conftest import SMALL

CLASHING = ("n", "key", "rid", "h", "y", "x", "v", "score", "rule", "verdict", "size", "item_id", "turn", "kept")


def clash(df):
    """With columns that bear the names of inner ones."""
    return df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Rows with the columns of documents: null and empty texts, null ids, repeated rows and a very long text."""
    docs = table(spark, SMALL, "documents")
    odd = [(None, None), (1, None), (2, ""), (3, " \n\t "), (4, "same words in this row twice"), (4, "same words in this row twice"), (5, "0" * 3000 + " " + "-" * 3000), (6, "palabra larga " * 60_000)]
    rows = spark.createDataFrame(odd, "doc_id long, text string")
    for f in docs.schema:
        if f.name not in rows.columns:
            rows = rows.withColumn(f.name, F.lit(None).cast(f.dataType))
    return rows.select(docs.columns)


DOCUMENT_OPERATORS = {
    "lm": lambda d, s: brown_lm.score_texts(d),
    "substrings": lambda d, s: substring_dedup.repeated_bytes(d),
    "secrets": lambda d, s: secrets.scan_secrets(d),
    "quality": lambda d, s: quality_gam.score_quality(d, table(s, SMALL, "labels")),
    "benchmark": lambda d, s: decontaminate.contaminated(d, table(s, SMALL, "benchmark")),
    "mixing": lambda d, s: mixing.mix_sources(d),
}


@pytest.mark.parametrize("name", DOCUMENT_OPERATORS)
def test_no_documents(spark, name):
    assert DOCUMENT_OPERATORS[name](table(spark, SMALL, "documents").limit(0), spark).count() == 0


@pytest.mark.parametrize("name", ["lm", "substrings", "secrets", "quality"])
def test_odd_documents_have_a_row_each(spark, odd_docs, name):
    rows = DOCUMENT_OPERATORS[name](clash(odd_docs), spark).collect()
    assert sorted((r.doc_id for r in rows), key=str) == sorted([None, 1, 2, 3, 4, 4, 5, 6], key=str)
    twice = [r for r in rows if r.doc_id == 4]
    assert twice[0] == twice[1]


def test_urls_of_odd_tables(spark):
    pages = table(spark, SMALL, "pages").select("page_id", "url")
    assert url_filter.judge_urls(pages.limit(0), queries.RULES).count() == 0
    deep = "a." * 200 + "example.com"
    rows = [(None, "http://example.net/en/x"), (1, None), (2, ""), (3, "no scheme"), (4, f"http://{deep}/de/" + "p" * 500_000), (5, "http://EXAMPLE.com/de/"), (5, "http://EXAMPLE.com/de/"), (6, "x://"), (7, "http://net")]
    got = [tuple(r)[:5] for r in url_filter.judge_urls(clash(spark.createDataFrame(rows, "page_id long, url string")), queries.RULES).select("page_id", "host", "path", "rule", "verdict").collect()]
    by = {(r[0], len(r[1]), len(r[2]), *r[3:]) for r in got}
    assert len(got) == len(rows)
    assert by == {
        (None, 11, 5, "example.net/en/", "allow"), (1, 0, 0, None, "allow"), (2, 0, 0, None, "allow"), (3, 0, 0, None, "allow"), (4, len(deep), 500_004, "example.com/de/", "block"),
        (5, 11, 4, "example.com/de/", "block"), (6, 0, 0, None, "allow"), (7, 3, 0, None, "allow"),
    }


def test_benchmark_of_odd_tables(spark):
    rng = random.Random(3)
    passage = " ".join(f"q{rng.randrange(10**6)}" for _ in range(30))
    long = " ".join(f"f{i % 977}" for i in range(200_000))
    docs = clash(spark.createDataFrame([(1, passage), (1, passage), (2, long + " " + passage + " " + long), (3, None), (None, passage), (4, long)], "doc_id long, text string"))
    items = spark.createDataFrame([(7, passage), (7, passage), (8, None), (9, "")], "item_id long, text string")
    found = decontaminate.contaminated(docs, items).select("doc_id", "item_id").distinct().collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(1, 7), (2, 7), (None, 7)}
    assert sorted((r.doc_id for r in decontaminate.drop_contaminated(docs, items).collect()), key=str) == [3, 4]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_vectors_of_odd_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk_nra.top_k(spark.createDataFrame([], schema)).count() == 0
    rows = [(100, [1.0, 0.5]), (200, None), (300, [float("nan"), 1.0]), (400, [None, 1.0]), (None, [1.0, 1.0]), (1, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [-1.0, 0.0]), (500, [])]
    got = {(r.query_id, r["rank"], r.vec_id, r.score) for r in topk_nra.top_k(clash(spark.createDataFrame(rows, schema))).collect()}
    own = 1024 * 1024 + 512 * 512
    assert got == {(100, 1, 1, own), (100, 2, 2, own), (100, 3, 3, -1024 * 1024)}


def test_vectors_that_are_all_equal(spark):
    rows = [(i, [0.25] * 8) for i in range(301)]
    got = topk_nra.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)).collect()
    for q in (0, 100, 200, 300):
        assert [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])] == [i for i in range(11) if i != q][:10]


def test_classifier_without_labels_or_of_one_class(spark, odd_docs):
    docs = table(spark, SMALL, "documents")
    labels = table(spark, SMALL, "labels")
    for own in (labels.limit(0), labels.withColumn("quality", F.lit(1).cast("int"))):
        scores = {r.score for r in quality_gam.score_quality(docs, own).collect()}
        assert len(scores) == 1 and all(0 <= x <= 1 and np.isfinite(x) for x in scores)


def test_chat_of_odd_tables(spark):
    turns = table(spark, SMALL, "conversations")
    assert chat_threads.reply_ordered(turns.limit(0)).count() == 0
    assert chat_threads.reply_ordered(clash(turns)).count() == turns.count()
    assert chat_threads.reply_ordered(turns.unionAll(turns)).count() == 2 * turns.count()


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_tables(spark, odd_docs, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    assert run(spark, odd_docs.limit(0), SMALL).count() == 0
    mixed = clash(table(spark, SMALL, "documents").unionByName(odd_docs))
    out = run(spark, mixed, SMALL)
    assert set(odd_docs.columns) <= set(out.columns)
    n = out.count()
    assert 0 < n <= mixed.count()
    if stage == "secret_scan":
        assert n == mixed.count()


def test_pipeline_of_odd_tables(spark, odd_docs, tmp_path):
    for name in ("labels", "benchmark"):
        table(spark, SMALL, name).write.parquet(f"{tmp_path}/{name}.parquet")
    table(spark, SMALL, "documents").unionByName(odd_docs).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    table(spark, SMALL, "documents").limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
