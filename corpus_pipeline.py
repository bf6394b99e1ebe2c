"""From raw documents to a training mix: the pipeline of the llm subpackage.

Each stage takes (spark, docs, sf_dir) and returns the rows for the next one, with
the columns of ``documents`` and any others that came in.  An empty table gives an
empty table, and rows are never invented.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.llm.decontaminate import drop_contaminated
from lexmill.llm.minhash_dedup import MinHashParams, one_of_each
from lexmill.llm.mixing import sample_rows
from lexmill.llm.quality_gam import keep_quality
from lexmill.llm.secrets import redact_secrets
from lexmill.llm.workspace import Workspace, table

#: Stages on word shingles take five words.
NEAR = MinHashParams(words=5, percent=80)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go.

    A null text is scored as an empty one; repeated rows have one score, so they stay
    or go together.
    """
    return keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the smallest doc_id.

    Rows that share a doc_id are one document, of which one row stays.  Documents without
    words are linked with nothing and stay, and so do all rows without a doc_id.
    """
    return one_of_each(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go.

    Null and empty texts overlap with nothing, on either side.
    """
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced by a mark.

    A null text stays null; repeated rows get the same text.
    """
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn to the target shares of source, language and topic.

    A null source or language is a class of its own; texts without words weigh as one
    token.  Draws go by doc_id, so repeated rows of one cell share their fate.
    """
    return sample_rows(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontamination", decontamination), ("secret_scan", secret_scan), ("mixing", mixing)]

#: The classifier's tables and the entropy spans can't be had from SQL; the tests go by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, each on the table that the one before has written."""
    ws = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = ws.save(stage(spark, docs, sf_dir), name)
        if k:
            ws.drop(STAGES[k - 1][0])
    return docs
