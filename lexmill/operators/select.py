"""Selection: thresholds by rank, caps, heads, top-k and deciles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.sinks import staged
from .ranks import with_rank, with_running_in


def top_share(df: DataFrame, score: str, share: float = 0.85) -> DataFrame:
    """Rows at or above the score that ``share`` of the rows reach: the one at place min(int(n * (1 - share)), n - 1) from below."""
    df = staged(df)  # the rows are gone through for the places and again for the cut
    n = df.count()
    if not n:
        return df
    at = min(int(n * (1 - share)), n - 1)
    limit = with_rank(df.select(score), [F.col(score)], "_at").filter(F.col("_at") == at + 1).select(F.col(score).alias("_limit"))
    return df.join(F.broadcast(limit), F.col(score) >= F.col("_limit"), "left_semi")


def head_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    keys = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).drop("_n")


def byte_cap(df: DataFrame, group: str, order: Sequence[Column | str], size: Column, cap: int, crossing: bool) -> DataFrame:
    """Rows of each group up to ``cap`` bytes, with or without the one that crosses it."""
    summed = with_running_in(df.withColumn("_size", size), [group], order, F.col("_size"), "_sum")
    before = F.col("_sum") - F.col("_size")
    return summed.filter(before < cap if crossing else F.col("_sum") <= cap).drop("_size", "_sum")


def budget_prefix(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], tokens: str, budget: Column | str | int) -> DataFrame:
    """Rows until the running sum reaches the budget; the crossing one is in."""
    limit = F.lit(budget) if isinstance(budget, int) else F.col(budget) if isinstance(budget, str) else budget
    return with_running_in(df, group, order, F.col(tokens), "_sum").filter(F.col("_sum") - F.col(tokens) < limit).drop("_sum")


def best_of(df: DataFrame, group: str, item: str, score: str) -> DataFrame:
    """(group, item): the item with the greatest score of each group, the smallest of equals."""
    return df.groupBy(group).agg(F.min_by(item, F.struct((-F.col(score)).alias("s"), F.col(item).alias("i"))).alias(item))


def try_list(candidates: DataFrame, places: DataFrame) -> DataFrame:
    """(try_no, ...): every candidate at every place, candidates in their order; both are short lists of names, and of at most 1000 rows each."""
    short = [df.limit(1001) for df in (candidates, places)]
    if any(df.count() > 1000 for df in short):
        raise ValueError("lists to try are of at most 1000 rows")
    tried = short[0].join(F.broadcast(short[1]), how="cross")
    return with_rank(tried, [F.col("candidate_no"), F.col("place_no")], "try_no")


def decile_picks(df: DataFrame, order: Sequence[Column], deciles: Sequence[int] = tuple(range(0, 101, 10))) -> DataFrame:
    """The rows at int(d / 100 * (n - 1)) in the order, with d as decile."""
    n = df.count()
    places = [(d, int(d / 100 * (n - 1)) + 1) for d in deciles] if n else []
    want = df.sparkSession.createDataFrame(places, "decile int, _at long")
    return with_rank(df, order, "_at").join(F.broadcast(want), "_at").drop("_at")


def keep_shares(df: DataFrame, value: str, weight: str, limits: Sequence[float]) -> DataFrame:
    """For each limit the share of rows, and of weight, strictly below it."""
    wide = df.select(value, weight).agg(
        F.array(*(F.struct(F.lit(float(x)).alias("threshold"), F.avg((F.col(value) < x).cast("int")).alias("share"), (F.sum(F.when(F.col(value) < x, F.col(weight)).otherwise(0)) / F.sum(weight)).alias("weighted")) for x in limits)).alias("rows")
    )
    return wide.select(F.explode("rows").alias("r")).select("r.*")


def nucleus(df: DataFrame, group: str, score: str, k: int, p: float) -> DataFrame:
    """Rows of each group within the k-th score (ties stay) and within cumulative softmax mass p; the first always stays."""
    w = Window.partitionBy(group)
    by = w.orderBy(F.desc(score), "item")
    ranked = df.withColumn("_r", F.rank().over(w.orderBy(F.desc(score)))).filter(F.col("_r") <= k)
    mass = F.exp(F.col(score) - F.max(score).over(w))
    ranked = ranked.withColumn("_m", mass).withColumn("_m", F.col("_m") / F.sum("_m").over(w))
    before = F.coalesce(F.sum("_m").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return ranked.withColumn("_b", before).filter((F.col("_b") <= p)).drop("_r", "_m", "_b")


def cheapest(offers: DataFrame, hint: str, most: float, k: int = 1) -> DataFrame:
    """The k cheapest offers (item, name, price) whose name holds the hint, at a positive price within the cap; of equal price and name the smallest items."""
    return offers.filter(F.lower("name").contains(hint.lower()) & (F.col("price") > 0) & (F.col("price") <= most)).orderBy("price", "name", "item").limit(k)
