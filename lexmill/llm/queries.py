"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .brown_lm import score_texts
from .chat_threads import reply_ordered
from .decontaminate import contaminated
from .minhash_dedup import near_duplicates
from .mixing import mix_sources
from .oracles import ORACLES
from .quality_gam import score_quality
from .secrets import scan_secrets
from .substring_dedup import repeated_bytes
from .topk_nra import top_k
from .url_filter import Rule, judge_urls
from .workspace import table

RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), RULES)


def op3_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_topk_nra(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op9_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_chat_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reply_ordered(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_brown_lm": op3_brown_lm,
    "op4_decontaminate": op4_decontaminate,
    "op5_topk_nra": op5_topk_nra,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_mixing": op7_mixing,
    "op8_secret_scan": op8_secret_scan,
    "op9_quality_gam": op9_quality_gam,
    "op10_chat_threads": op10_chat_threads,
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
