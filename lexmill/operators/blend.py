"""Token-budgeted blends: budgets by source, repetition by epochs, interleaving, training windows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import with_rank, with_running, with_running_in
from .sample import order_key, split_tokens
from .select import budget_prefix


def normalised(weights: Mapping[str, float]) -> dict[str, float]:
    total = sum(weights.values())
    return {k: w / total for k, w in weights.items()}


def budgets(docs: DataFrame, target: int, weights: Mapping[str, float], max_epochs: Mapping[str, int] | None = None) -> DataFrame:
    """(source, weight, avail, budget): the target's share, at most ``max_epochs`` times what there is.

    A source without tokens has no budget, whatever its weight.
    """
    spark = docs.sparkSession
    caps = max_epochs or {}
    plan = spark.createDataFrame([(s, w, caps.get(s)) for s, w in normalised(weights).items()], "source string, weight double, max_epochs int")
    avail = docs.groupBy("source").agg(F.sum("n_tok").alias("avail"), F.count("*").alias("docs_avail"))
    share = F.floor(F.lit(float(target)) * F.col("weight")).cast("long")
    out = F.broadcast(plan).join(avail, "source", "left").withColumns({"avail": F.coalesce("avail", F.lit(0)), "docs_avail": F.coalesce("docs_avail", F.lit(0)), "target": share})
    cap = F.when(F.col("max_epochs").isNotNull(), F.col("max_epochs") * F.col("avail")).otherwise(share)
    return out.withColumn("budget", F.when(F.col("avail") > 0, F.least(share, cap)).otherwise(0))


def select_documents(docs: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """(source, doc_idx, epoch, n_tok, rn): documents in a new shuffle for each epoch, until the budget is reached; the crossing one is in."""
    own = docs.join(F.broadcast(plan.select("source", "avail", "budget").filter("budget > 0")), "source")
    epochs = own.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("budget") / F.col("avail")).cast("int"))))
    keyed = epochs.withColumn("_o", order_key(seed, F.col("epoch"), F.col("doc_idx")))
    kept = budget_prefix(keyed, ["source"], ["epoch", "_o", "doc_idx"], "n_tok", "budget")
    ranked = with_running_in(kept.withColumn("_one", F.lit(1)), ["source"], ["epoch", "_o", "doc_idx"], F.col("_one"), "rn")
    return ranked.withColumn("rn", F.col("rn").cast("int")).select("source", "doc_idx", "epoch", "n_tok", "rn")


def interleave(chosen: DataFrame, seed: int, chunk: int = 2000) -> DataFrame:
    """With place: chunks of each source by rounds, sources in a new order each round."""
    rounds = chosen.withColumn("round", F.floor((F.col("rn") - 1) / chunk)).withColumn("_s", order_key(seed, F.col("round"), F.col("source")))
    return with_rank(rounds, [F.col("round"), F.col("_s"), F.col("rn")], "place").withColumn("place", F.col("place") - 1).drop("_s")


def blend_report(chosen: DataFrame, plan: DataFrame) -> DataFrame:
    got = chosen.groupBy("source").agg(F.sum("n_tok").alias("tokens_effective"), F.count("*").alias("docs_selected"))
    out = plan.join(got, "source", "left").withColumns({"tokens_effective": F.coalesce("tokens_effective", F.lit(0)), "docs_selected": F.coalesce("docs_selected", F.lit(0))})
    return out.select(
        "source", "weight", F.col("target").alias("tokens_target"), "tokens_effective", F.greatest(F.lit(0), F.col("target") - F.col("tokens_effective")).alias("deficit"), "docs_selected",
        F.col("docs_avail").alias("docs_unique_avail"), F.col("avail").alias("avail_tokens_1epoch"), F.when(F.col("avail") > 0, F.col("tokens_effective") / F.col("avail")).otherwise(0.0).alias("epochs_approx"),
    )


def validation(docs: DataFrame, chosen: DataFrame, budget: int, seed: int) -> DataFrame:
    """Documents that training doesn't use, up to the budget."""
    return split_tokens(docs, chosen, "doc_idx", "n_tok", budget, seed)


def flat_positions(ordered: DataFrame) -> DataFrame:
    """First token position of each document in the flat stream, in the order of place."""
    return with_running(ordered, [F.col("place")], F.col("n_tok"), "_sum").withColumn("first_pos", F.col("_sum") - F.col("n_tok")).drop("_sum")


def windows_of(tokens: DataFrame, n: int, ctx: int, stride: int | None = None, start: int = 0) -> DataFrame:
    """(k, x, y): windows of ctx + 1 tokens of a stream (pos, token) of n tokens, y one ahead of x.

    Every token goes to the windows that hold it, so nothing is windowed over the stream.  An interrupted
    run goes on at window ``start``, taken modulo their number; tokens of earlier windows alone aren't read.
    """
    stride = stride or ctx
    count = max(0, (n - 1 - ctx) // stride + 1) if n > ctx else 0
    start %= max(count, 1)
    tokens = tokens.filter(F.col("pos") >= start * stride)
    lo = F.greatest(F.lit(start), F.ceil((F.col("pos") - ctx) / stride)).cast("long")
    hi = F.least(F.lit(count - 1), F.floor(F.col("pos") / stride)).cast("long")
    dealt = tokens.filter(F.lit(count) > 0).filter(lo <= hi).select(F.explode(F.sequence(lo, hi)).alias("k"), "pos", "token")
    seq = F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda s: s["token"])
    return dealt.groupBy("k").agg(seq.alias("s")).select("k", F.slice("s", 1, ctx).alias("x"), F.slice("s", 2, ctx).alias("y"))


def array_windows(df: DataFrame, tokens: str, ctx: int, stride: int | None = None) -> DataFrame:
    """The same for a token array in each row: a row for each window, with the other columns."""
    stride = stride or ctx
    n = F.size(tokens)
    count = F.when(n > ctx, F.floor((n - 1 - ctx) / stride) + 1).otherwise(0).cast("int")
    each = df.filter(n > ctx).withColumn("k", F.explode(F.sequence(F.lit(0), count - 1)))
    first = F.col("k") * stride + 1
    return each.select(*(c for c in df.columns if c != tokens), F.col("k").cast("long").alias("k"), F.slice(tokens, first, F.lit(ctx)).alias("x"), F.slice(tokens, first + 1, F.lit(ctx)).alias("y"))
