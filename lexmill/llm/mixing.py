"""Mixing sources to target weights by iterative proportional fitting.

Token weights of the cells source x language x topic are raked to the target
shares of the three marginals in turn; each document is then sampled with the
calibrated probability of its cell.  A target share is the marginal's token share
to the power ``temper``, normalised, which lifts small classes and damps a source
that holds a third of everything; shares may also be given outright.

Probabilities are scaled so that the share ``keep`` of all tokens is expected; a
cell that would need more than there is is taken whole (no document is repeated)
and the others make up for it in their proportions.  The draw is a hash of the seed
and the document's id, so it does not depend on partitions or order.

Raking runs on the driver for up to ``max_cells`` cells and as DataFrame steps on
the cells beyond that; the results are the same.

Defined results: null source and lang, and null and empty texts, are classes of
their own (empty strings, topic ``empty``); documents without tokens weigh as one
token; a null doc_id draws as the empty string; repeated rows share their fate.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

MARGINS = ("source", "lang", "topic")


@dataclass(frozen=True)
class MixParams:
    temper: float = 0.7
    keep: float = 0.5  #: share of the tokens to expect
    rounds: int = 12
    seed: int = 7
    max_cells: int = 1_000_000
    targets: dict[str, dict[str, float]] = field(default_factory=dict)  #: by margin; missing classes get 0


def n_tokens(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def topic(text: Column) -> Column:
    """A coarse topic from the text alone; callers with topics of their own pass a ``topic`` column."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.length(t) == 0, "empty").when(t.contains("Licens") | t.contains("Copyright"), "licence").when(t.contains(" | "), "table")
        .when(t.contains("@"), "contact").when(F.length(t) < 600, "short").otherwise("prose")
    )


def draw(doc_id: Column, seed: int) -> Column:
    """Uniform in [0, 1), from the first 52 bits of an md5."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def shares(tokens: pd.Series, keys: pd.Series, margin: str, p: MixParams) -> pd.Series:
    total = tokens.groupby(keys).sum().astype(float)
    if margin in p.targets:
        given = pd.Series(p.targets[margin], dtype=float).reindex(total.index).fillna(0.0)
        return given / given.sum() if given.sum() else given
    powered = (total / total.sum()) ** p.temper
    return powered / powered.sum()


def rake(cells: pd.DataFrame, p: MixParams) -> np.ndarray:
    """Fitted shares of the cells (columns source, lang, topic, tokens)."""
    w = cells["tokens"].to_numpy(float) / cells["tokens"].sum()
    goals = {m: shares(cells["tokens"], cells[m], m, p) for m in MARGINS}
    codes = {m: pd.factorize(cells[m], sort=True) for m in MARGINS}
    for _ in range(p.rounds):
        for m in MARGINS:
            code, names = codes[m]
            now = np.bincount(code, w, len(names))
            w *= np.divide(goals[m].reindex(names).to_numpy(), now, out=np.zeros(len(names)), where=now > 0)[code]
    return w


def scale(cells: pd.DataFrame, r: np.ndarray, p: MixParams) -> np.ndarray:
    """min(1, c * r), with c such that the expected tokens are the share to keep."""
    tokens = cells["tokens"].to_numpy(float)
    whole = r > np.inf
    while True:
        rest = (tokens * r)[~whole].sum()
        c = (p.keep * tokens.sum() - tokens[whole].sum()) / rest if rest > 0 else 0.0
        now = whole | (c * r >= 1)
        if (now == whole).all():
            return np.where(whole, 1.0, np.maximum(c, 0.0) * r)
        whole = now


def _scale_steps(fitted: DataFrame, p: MixParams) -> DataFrame:
    """The same on a table of cells (tokens, r)."""
    total, limit = float(fitted.agg(F.sum("tokens")).first()[0]), float("inf")
    while True:
        own = fitted.agg(F.coalesce(F.sum(F.when(F.col("r") >= limit, F.col("tokens"))), F.lit(0)).cast("double"), F.coalesce(F.sum(F.when(F.col("r") < limit, F.col("tokens") * F.col("r"))), F.lit(0.0))).first()
        c = max(0.0, (p.keep * total - own[0]) / own[1]) if own[1] > 0 else 0.0
        if c == 0.0 or 1 / c >= limit or fitted.filter((F.col("r") >= 1 / c) & (F.col("r") < limit)).isEmpty():
            return fitted.withColumn("p", F.when(F.col("r") >= limit, 1.0).otherwise(F.lit(c) * F.col("r")))
        limit = 1 / c


def _rake_steps(cells: DataFrame, p: MixParams, ws: Workspace) -> DataFrame:
    """The same on a table of any number of cells: (source, lang, topic, tokens, w)."""
    spark = cells.sparkSession
    total = float(cells.agg(F.sum("tokens")).first()[0])
    now = ws.save(cells.withColumn("w", F.col("tokens") / F.lit(total)), "rake-0")
    goals = {}
    for m in MARGINS:
        by = now.groupBy(m).agg(F.sum("tokens").cast("double").alias("t"))
        if m in p.targets:
            given = spark.createDataFrame(list(p.targets[m].items()), f"{m} string, g double")
            by = by.join(given, m, "left").select(m, F.coalesce("g", F.lit(0.0)).alias("g"))
        else:
            by = by.select(m, F.pow(F.col("t") / F.lit(total), F.lit(p.temper)).alias("g"))
        whole = by.agg(F.sum("g")).first()[0] or 1.0
        goals[m] = ws.save(by.select(m, (F.col("g") / F.lit(whole)).alias("g")), f"goal-{m}")
    k = 0
    for _ in range(p.rounds):
        for m in MARGINS:
            factor = now.groupBy(m).agg(F.sum("w").alias("s")).join(goals[m], m).select(m, F.when(F.col("s") > 0, F.col("g") / F.col("s")).otherwise(0.0).alias("f"))
            k += 1
            nxt = ws.save(now.join(factor, m).select(*MARGINS, "tokens", (F.col("w") * F.col("f")).alias("w")), f"rake-{k}")
            ws.drop(f"rake-{k - 1}")
            now = nxt
    return now


def probabilities(docs: DataFrame, p: MixParams = MixParams(), ws: Workspace | None = None) -> DataFrame:
    """(source, lang, topic, p) of the cells of ``docs`` (source, lang, topic, n_tokens); p is rounded to 9 places."""
    spark = docs.sparkSession
    cells = docs.groupBy(*MARGINS).agg(F.sum(F.greatest("n_tokens", F.lit(1))).alias("tokens"))
    got = cells.limit(p.max_cells + 1).toPandas()
    schema = "source string, lang string, topic string, p double"
    if len(got) > p.max_cells:
        ws = ws or Workspace(spark, "mix")
        fitted = _rake_steps(ws.save(cells, "cells"), p, ws).withColumn("r", F.col("w") / F.col("tokens"))
        return _scale_steps(fitted, p).select(*MARGINS, F.round("p", 9).alias("p"))
    if not len(got):
        return spark.createDataFrame([], schema)
    got = got.sort_values(list(MARGINS), ignore_index=True)
    r = rake(got, p) / got["tokens"].to_numpy(float)
    got["p"] = np.round(scale(got, r, p), 9)
    return F.broadcast(spark.createDataFrame(got[[*MARGINS, "p"]], schema))


def _cells(docs: DataFrame) -> dict[str, Column]:
    own = F.coalesce(F.col("topic").cast("string"), F.lit("")) if "topic" in docs.columns else topic(F.col("text"))
    return {"source": F.coalesce(F.col("source"), F.lit("")), "lang": F.coalesce(F.col("lang"), F.lit("")), "topic": own, "n_tokens": n_tokens(F.col("text"))}


def mix_sources(docs: DataFrame, p: MixParams = MixParams(), ws: Workspace | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, p) of the documents drawn."""
    ws = ws or Workspace(docs.sparkSession, "mix")
    cells = _cells(docs)
    # the counts of the first pass are kept, so texts are read once
    counted = ws.save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(c.alias(k) for k, c in cells.items())), "counted")
    probs = probabilities(counted, p, ws)
    return counted.join(probs, list(MARGINS)).filter(draw(F.col("doc_id"), p.seed) < F.col("p")).select("doc_id", *MARGINS, "n_tokens", "p")


def sample_rows(docs: DataFrame, p: MixParams = MixParams(), ws: Workspace | None = None) -> DataFrame:
    """The rows drawn, with all their columns."""
    tagged = docs.withColumns({f"_mix_{k}": c for k, c in _cells(docs).items()})
    counted = tagged.select(*(F.col(f"_mix_{k}").alias(k) for k in (*MARGINS, "n_tokens")))
    probs = probabilities(counted, p, ws)
    keys = [tagged[f"_mix_{m}"] == probs[m] for m in MARGINS]
    met = tagged.join(probs.select(*(F.col(m) for m in MARGINS), F.col("p").alias("_mix_p")), keys)
    return met.filter(draw(tagged["doc_id"], p.seed) < F.col("_mix_p")).select(*(tagged[f"`{c}`"] for c in docs.columns))
