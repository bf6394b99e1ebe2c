"""Quality gates: the reason for which a document is rejected, in the order in which the tests are made."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COMMON_GATE, COMMON_LIGHT, DEFAULT_GATE, LIGHT_GATE, SOURCE_GATES, GateParams
from ..functions import metrics as M
from ..functions.text import clean


def by_source(source: Column, name: str, overrides: Mapping[str, GateParams] = SOURCE_GATES, default: GateParams = DEFAULT_GATE) -> Column:
    """A parameter, as the row's source has it."""
    base = getattr(default, name)
    out = None
    for key, own in overrides.items():
        if getattr(own, name) != base:
            out = (F.when if out is None else out.when)(source == key, getattr(own, name))
    return F.lit(base) if out is None else out.otherwise(base)


def with_reason(docs: DataFrame, overrides: Mapping[str, GateParams] = SOURCE_GATES, default: GateParams = DEFAULT_GATE) -> DataFrame:
    """``docs`` (source, text) with the reason for rejection, null for a document that passes.

    The first failing test gives the reason; the language test is the last.  Words,
    lines and counts are columns of their own before the tests, so that each is made
    once and not once for every test that looks at it.
    """
    own = lambda name: by_source(F.col("source"), name, overrides, default)
    t, col = F.col("_g_t"), lambda k: F.col(f"_g_{k}")
    parts = {"lines": M.lines(t), "words": M.words(t), "found": M.letter_words(F.substring(t, 1, 2000), "a-zàâäéèêëîïôùûüçœæ")}
    counts = {"n": F.length(t), "alpha": M.count(t, M.LETTER), "space": M.count(t, M.SPACE), "digit": M.count(t, M.DIGIT), "upper": M.count(t, M.UPPER)}
    plain = F.filter(col("words"), lambda w: w.rlike(r"^\p{L}+$"))
    n_lines = F.size(col("lines"))
    sums = {
        "n_lines": n_lines, "n_words": F.size(col("words")), "mean": M.mean_length(plain, 10), "repeats": 1 - F.size(F.array_distinct(col("lines"))) / F.greatest(n_lines, F.lit(1)),
        "listed": F.size(F.filter(col("lines"), lambda x: x.rlike("^[*#-]"))) / F.greatest(n_lines, F.lit(1)), "french": M.common_share(col("found"), COMMON_GATE, 20, None),
    }
    alpha, digit, n = col("alpha"), col("digit"), col("n")
    other = (n - alpha - col("space") - digit) / n
    french = F.when((n < 200) | col("french").isNull() | (col("french") >= own("french")), True).otherwise(col("french") >= 0.01)
    reason = (
        F.when(n < own("min_chars"), "too short").when(col("n_lines") < own("min_lines"), "too few lines").when(col("n_words") < own("min_words"), "too few words")
        .when(col("mean") < default.min_word_length, "short words").when(col("mean") > default.max_word_length, "long words")
        .when(alpha / n < 1 - own("max_special") - own("max_digits") - 0.15, "too special").when(digit / n > own("max_digits"), "too many digits")
        .when(other > own("max_special"), "too much punctuation").when(F.when(alpha > 0, col("upper") / alpha) > own("max_upper"), "too many capitals")
        .when((col("n_lines") >= 10) & (col("repeats") > own("max_line_repetition")), "repeated lines").when((col("n_lines") >= 10) & (col("listed") > 0.60), "list")
        .when(~french, "not French")
    )
    out = docs.withColumn("_g_t", F.substring(F.coalesce("text", F.lit("")), 1, default.max_chars))
    out = out.withColumns({f"_g_{k}": v for k, v in (parts | counts).items()})
    out = out.withColumns({f"_g_{k}": v for k, v in sums.items()})
    return out.withColumn("reason", reason).select(*docs.columns, "reason")


def with_light(docs: DataFrame, p: GateParams = LIGHT_GATE) -> DataFrame:
    """``docs`` (text) with ok: whether a text passes the light gate.  Counts are columns of their own, as in ``with_reason``."""
    t, col = F.col("_g_t"), lambda k: F.col(f"_g_{k}")
    counts = {"n": F.length(t), "alpha": M.count(t, M.LETTER), "space": M.count(t, M.SPACE), "digit": M.count(t, M.DIGIT), "upper": M.count(t, M.UPPER), "words": F.size(M.words(t)), "lines": F.size(M.lines(t)), "found": M.letter_words(F.substring(t, 1, 3000), "a-zà-ÿ")}
    n, alpha = col("n"), col("alpha")
    sizes = (n >= p.min_chars) & (col("words") >= p.min_words) & (col("lines") >= p.min_lines)
    shares = (col("digit") / n <= p.max_digits) & ((n - alpha - col("space") - col("digit")) / n <= p.max_special) & (F.when(alpha > 0, col("upper") / alpha).otherwise(0.0) <= p.max_upper)
    french = M.common_share(col("found"), COMMON_LIGHT, 10, None)
    out = docs.withColumn("_g_t", M.strip(F.col("text"))).withColumns({f"_g_{k}": v for k, v in counts.items()})
    ok = F.coalesce(F.when(sizes, shares & (french.isNull() | (french >= p.french))).otherwise(False), F.lit(False))
    return out.withColumn("ok", ok).select(*docs.columns, "ok")


def clean_documents(docs: DataFrame, wiki_sources: tuple[str, ...] = ("wikipedia", "wikisource"), **gate) -> DataFrame:
    """Cleaned text, its length and the reason for rejection; rejected rows are kept for the counts."""
    out = with_reason(docs.withColumn("text", clean(F.col("text"), F.col("source").isin(*wiki_sources))), **gate)
    return out.withColumn("text", F.substring("text", 1, DEFAULT_GATE.max_chars)).withColumn("chars", F.length("text"))


def gate_counts(marked: DataFrame) -> DataFrame:
    """Kept and rejected rows by source."""
    return marked.groupBy("source").agg(F.count("*").alias("total"), F.count_if(F.col("reason").isNull()).alias("kept"), F.count_if(F.col("reason").isNotNull()).alias("rejected"))
