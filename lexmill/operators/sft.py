"""Instruction data: parsing model output, validation, ChatML, splits, masked tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import is_valid_example
from ..functions.text import chatml, normalized_hash, strip
from .dedup import first_by
from .sample import split_rows

IGNORED = -100
_ITEM = "struct<instruction:string,question:string,reponse:string,`réponse`:string,answer:string,response:string>"


def json_block(raw: Column) -> Column:
    """The JSON in a model's output: thoughts off; a fenced block, the whole, or from the first brace to the last."""
    text = strip(F.regexp_replace(raw, r"(?s)<think>.*?</think>", ""))
    fenced = F.regexp_extract(text, r"(?s)```(?:json)?\s*(.*?)```", 1)
    braces = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    ok = lambda t: F.when((t != "") & F.try_parse_json(t).isNotNull(), t)
    return F.coalesce(ok(fenced), ok(text), ok(braces))


def examples(raw: DataFrame, text: str = "raw") -> DataFrame:
    """A row (instruction, reponse) for each example in the outputs, with the other columns."""
    block = json_block(F.col(text))
    inner = F.coalesce(*(F.get_json_object(block, f"$.{k}") for k in ("exemples", "examples", "data", "items")), block)
    listed = F.when(inner.startswith("["), inner).otherwise(F.concat(F.lit("["), inner, F.lit("]")))
    item = F.explode(F.from_json(listed, f"array<{_ITEM}>")).alias("e")
    keep = [c for c in raw.columns if c != text]
    return raw.select(*keep, item).select(*keep, F.coalesce("e.instruction", "e.question").alias("instruction"), F.coalesce("e.reponse", F.col("e.`réponse`"), "e.answer", "e.response").alias("reponse"))


def valid(df: DataFrame) -> DataFrame:
    return df.filter(is_valid_example(F.col("instruction"), F.col("reponse")))


def chatml_rows(df: DataFrame, order: str, share: float = 0.02, seed: int = 42) -> DataFrame:
    """(text, registre, split): the first of equal instructions, formatted and split."""
    full = df.filter((F.coalesce("instruction", F.lit("")) != "") & (F.coalesce("reponse", F.lit("")) != ""))
    once = first_by(full.withColumn("_h", normalized_hash(F.col("instruction"))), ["_h"], [order])
    return split_rows(once, order, share, seed).select(chatml(F.col("instruction"), F.col("reponse")).alias("text"), "registre", "split")


def conversation_pairs(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, instruction, reponse): each assistant turn with the user turn right before it."""
    user = turns.filter("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("instruction"))
    return turns.filter("role = 'assistant'").join(user, ["conv_id", "turn"]).select("conv_id", "turn", "instruction", F.col("text").alias("reponse"))


def masked(ids: Column, marker: Column, ctx: int) -> Column:
    """struct(input_ids, labels): what stands up to the last ``marker`` (an array of ids) is ignored; cut to ctx; null if nothing is left to learn."""
    k = F.size(marker)
    at = F.array_max(F.filter(F.sequence(F.lit(1), F.greatest(F.size(ids) - k + 1, F.lit(1))), lambda i: F.slice(ids, i, k) == marker))
    start = at + k - 1  # a lambda over the ids would look for the marker once for each of them
    labels = F.concat(F.array_repeat(F.lit(IGNORED), start), F.slice(ids, start + 1, F.greatest(F.size(ids) - start, F.lit(0))))
    cut = F.slice(labels, 1, ctx)
    return F.when(at.isNotNull() & F.exists(cut, lambda x: x != IGNORED), F.struct(F.slice(ids, 1, ctx).alias("input_ids"), cut.alias("labels")))


def padded(ids: Column, size: Column | int, pad: int) -> Column:
    n = F.lit(size) if isinstance(size, int) else size
    return F.slice(F.concat(ids, F.array_repeat(F.lit(pad), F.greatest(F.lit(0), n - F.size(ids)).cast("int"))), F.lit(1), n)


def collated(rows: DataFrame, size: int, pad: int = 3) -> DataFrame:
    """x and y of training rows (input_ids, labels): ids padded with ``pad``, labels with what is ignored, y one ahead of x."""
    ids, labels = padded(F.col("input_ids"), size, pad), padded(F.col("labels"), size, IGNORED)
    keep = [c for c in rows.columns if c not in ("input_ids", "labels")]
    return rows.select(*keep, F.slice(ids, 1, size - 1).alias("x"), F.slice(labels, 2, size - 1).alias("y"))


def profile(df: DataFrame) -> DataFrame:
    """Counts and lengths by register, with answers that are very short, very long or still have English in them."""
    n = F.length("reponse")
    english = F.lower("reponse").rlike(r"\b(the|and|with|this|that)\b")
    return df.groupBy("registre").agg(F.count("*").alias("n"), F.min(n).alias("min_chars"), F.max(n).alias("max_chars"), F.floor(F.sum(n) / F.count("*")).alias("mean_chars"), F.count_if(n < 40).alias("short"), F.count_if(n > 2000).alias("long"), F.count_if(english).alias("english"), F.count_distinct("instruction").alias("distinct_instructions"))


def masked_loss(rows: DataFrame, loss: str = "loss", label: str = "label") -> DataFrame:
    """Mean loss over what isn't ignored, and its perplexity."""
    return rows.filter(F.col(label) != IGNORED).agg(F.avg(loss).alias("loss"), F.exp(F.least(F.avg(loss), F.lit(20.0))).alias("perplexity"))
