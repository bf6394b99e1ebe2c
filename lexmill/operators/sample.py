"""Reproducible sampling, shuffling and splitting: every draw is a hash of the seed and the row's key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranks import with_rank, with_running
from .select import head_per_group


def order_key(seed: int | str, *keys: Column) -> Column:
    """Hex digest of seed and keys: sorts like a shuffle."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(k.cast("string") for k in keys)).cast("binary"))


def uniform(seed: int | str, *keys: Column) -> Column:
    """In [0, 1)."""
    return F.conv(F.substring(order_key(seed, *keys), 1, 13), 16, 10).cast("double") / float(1 << 52)


def reservoir(df: DataFrame, key: str, k: int, seed: int = 42) -> DataFrame:
    """k rows, each set of k as likely as another."""
    return df.withColumn("_o", order_key(seed, F.col(key))).orderBy("_o", key).limit(k).drop("_o")


def bernoulli(df: DataFrame, key: str, p: Column | float, seed: int = 42) -> DataFrame:
    return df.filter(uniform(seed, F.col(key)) <= p)


def stratified(df: DataFrame, key: str, group: str, rates: Mapping[str, float | None], seed: int = 42) -> DataFrame:
    """A rate by group; None keeps all of it, and groups that aren't named go."""
    table = df.sparkSession.createDataFrame([(g, 1.0 if r is None else min(1.0, r)) for g, r in rates.items()], f"{group} string, _p double")
    return bernoulli(df.join(F.broadcast(table), group), key, F.col("_p"), seed).drop("_p")


def per_group(df: DataFrame, key: str, group: str, k: int, seed: int = 42) -> DataFrame:
    """k rows of each group, without replacement."""
    return head_per_group(df, group, [order_key(seed, F.col(key)), key], k)


def weighted_picks(items: DataFrame, draws: DataFrame, weight: str, order: str, u: str) -> DataFrame:
    """For each draw u in [0, 1) the first item whose running share of the weights reaches it.

    Shares are cut to as many cells as there are items, so the join is by equality of cells.
    """
    total, n = items.agg(F.sum(weight), F.count("*")).first()
    n = max(1, n)
    summed = with_running(items, [F.col(order)], F.coalesce(F.col(weight), F.lit(0)), "_hi")
    spans = with_rank(summed.withColumn("_hi", F.col("_hi") / F.lit(total)), [F.col(order)], "_n")
    before = spans.select((F.col("_n") + 1).alias("_n"), F.col("_hi").alias("_lo"))
    spans = spans.join(before, "_n", "left").withColumn("_lo", F.coalesce("_lo", F.lit(-1.0)))
    cell = lambda x: F.least(F.floor(x * n), F.lit(n - 1))
    cells = spans.withColumn("_cell", F.explode(F.sequence(cell(F.greatest("_lo", F.lit(0.0))), cell(F.col("_hi")))))
    met = draws.withColumn("_cell", cell(F.col(u))).join(cells, "_cell")
    return met.filter((F.col(u) <= F.col("_hi")) & (F.col(u) > F.col("_lo"))).drop("_hi", "_lo", "_cell", "_n")


def split_rows(df: DataFrame, key: str, share: float = 0.02, seed: int = 42) -> DataFrame:
    """Column split: val for the first max(1, int(n * share)) rows of a shuffle, train for the others."""
    n_val = max(1, int(df.count() * share))
    ranked = with_rank(df.withColumn("_o", order_key(seed, F.col(key))), [F.col("_o"), F.col(key)], "_n")
    return ranked.withColumn("split", F.when(F.col("_n") <= n_val, "val").otherwise("train")).drop("_o", "_n")


def split_tokens(df: DataFrame, used: DataFrame, key: str, tokens: str, budget: int, seed: int = 42) -> DataFrame:
    """Rows not in ``used``, shuffled, until the budget of tokens is reached."""
    free = df.join(used.select(key).distinct(), key, "left_anti").withColumn("_o", order_key(seed, F.col(key)))
    return with_running(free, [F.col("_o"), F.col(key)], F.col(tokens), "_sum").filter(F.col("_sum") - F.col(tokens) < budget).drop("_o", "_sum")


def bernoulli_to(df: DataFrame, key: str, size: Column, target: int, read_cap: int, seed: int = 42) -> DataFrame:
    """Rows drawn at the rate target / read_cap, in the order of ``key``, until ``target`` bytes are reached; the crossing one is in."""
    drawn = bernoulli(df, key, min(1.0, target / read_cap), seed).withColumn("_size", size)
    return with_running(drawn, [F.col(key)], F.col("_size"), "_sum").filter(F.col("_sum") - F.col("_size") < target).drop("_size", "_sum")


def shuffle_place(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """With place, from 0: where a seeded shuffle puts the row."""
    return with_rank(df.withColumn("_o", order_key(seed, F.col(key))), [F.col("_o"), F.col(key)], "place").withColumn("place", F.col("place") - 1).drop("_o")


def shuffled(df: DataFrame, key: str, seed: int = 42, cols: Sequence[str] = ()) -> DataFrame:
    """In the order of a seeded shuffle."""
    return df.withColumn("_o", order_key(seed, *(F.col(c) for c in cols), F.col(key))).orderBy("_o", key).drop("_o")
