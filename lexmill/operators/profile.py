"""Profiles of sources: lengths, histograms, fields, n-grams and noise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as M


def length_stats(docs: DataFrame, group: str = "source", text: str = "text") -> DataFrame:
    """Lengths of each group's texts; null and empty ones have no share of letters, so they aren't counted as low_latin."""
    n = F.length(text)
    return docs.groupBy(group).agg(F.count("*").alias("docs"), F.min(n).alias("min_chars"), F.max(n).alias("max_chars"), F.avg(n).alias("mean_chars"), F.sum(n).alias("chars"), F.count_if((n > 0) & (M.latin_share(F.col(text)) < 0.85)).alias("low_latin"), F.count_if(n < 50).alias("too_short"))


def histogram(docs: DataFrame, group: str = "source", text: str = "text", bounds: Sequence[int] = (100, 500, 2000, 10000)) -> DataFrame:
    return docs.groupBy(group, M.bucket(F.length(text), bounds).alias("bucket")).agg(F.count("*").alias("docs"))


def field_counts(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """(field, type, n) over JSON objects, one a line."""
    fields = lines.select(F.explode(F.from_json(F.col(raw), "map<string,variant>")).alias("field", "value"))
    return fields.groupBy("field", F.schema_of_variant("value").alias("type")).agg(F.count("*").alias("n"))


def top_trigrams(docs: DataFrame, group: str | None = "source", text: str = "text", k: int = 50, per_doc: int | None = None) -> DataFrame:
    """The ``k`` commonest trigrams, of whole texts or of the first ``per_doc`` of each."""
    keys = [group] if group else []
    counts = docs.select(*keys, F.explode(M.trigrams(F.col(text), most=per_doc)).alias("gram")).groupBy(*keys, "gram").agg(F.count("*").alias("n"))
    order = [F.desc("n"), F.col("gram")]
    if not group:
        return counts.orderBy(*order).limit(k)
    return counts.withColumn("_r", F.row_number().over(Window.partitionBy(group).orderBy(*order))).filter(F.col("_r") <= k).drop("_r")


def noise_panel(docs: DataFrame, text: str = "text", fertility: Column | None = None, fallback: Column | None = None) -> DataFrame:
    """Row-wise shares of suspect words and foreign letters, and their rank.

    ``fertility`` (tokens for each word) and ``fallback`` (share of byte tokens) come
    from whatever tokenizer the caller has; without them they don't count.
    """
    out = docs.withColumns({"suspect": M.suspect_share(F.col(text)), "foreign": M.foreign_share(F.col(text))})
    return out.withColumn("noise", M.noise_rank(F.col("suspect"), F.lit(1.54) if fertility is None else F.coalesce(fertility, F.lit(1.54)), F.col("foreign"), F.lit(0.0) if fallback is None else fallback))


def percentiles(df: DataFrame, value: str, group: Sequence[str] = (), points: Sequence[float] = (0.5, 0.75, 0.9, 0.95, 0.99)) -> DataFrame:
    """Mean, exact percentiles by linear interpolation and maximum, to four places."""
    named = {f"p{round(100 * q)}": F.round(F.percentile(value, F.lit(float(q))), 4) for q in points}
    return df.groupBy(*group).agg(F.round(F.avg(value), 4).alias("mean"), *(c.alias(k) for k, c in named.items()), F.round(F.max(value).cast("double"), 4).alias("max"))


def shares(df: DataFrame, group: str) -> DataFrame:
    """(group, n, share)."""
    counts = df.groupBy(group).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_t"))
    return counts.crossJoin(F.broadcast(total)).select(group, "n", (F.col("n") / F.col("_t")).alias("share"))


def share_below(df: DataFrame, value: Column, low: float = 0.05, high: float = 0.20) -> DataFrame:
    return df.agg((100 * F.avg((value < low).cast("int"))).alias("clean_pct"), (100 * F.avg((value > high).cast("int"))).alias("noisy_pct"))
