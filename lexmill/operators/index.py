"""Document, source and token index, with integrity checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.metrics import skip_reason
from .ranks import with_rank, with_running


def source_codes(lines: DataFrame) -> DataFrame:
    """(source, code, lines): codes from 0 in the order of first appearance."""
    per = lines.groupBy("source").agg(F.min("line_no").alias("first"), F.count("*").alias("lines"))
    return per.withColumn("code", F.dense_rank().over(Window.orderBy("first")) - 1).select("source", "code", "lines")


def eos_offsets(tokens: DataFrame, eos: int = 3) -> DataFrame:
    """(doc_idx, eos_off) from a stream (pos, token): a document ends at each end token."""
    return with_rank(tokens.filter(F.col("token") == eos).select(F.col("pos").alias("eos_off")), [F.col("eos_off")], "_n").select((F.col("_n") - 1).alias("doc_idx"), "eos_off")


def shard_ends(tokens: DataFrame, eos: int = 3) -> DataFrame:
    """(file, tokens, docs, ends_on_eos) of a stream (file, at, token)."""
    return tokens.groupBy("file").agg(F.count("*").alias("tokens"), F.count_if(F.col("token") == eos).alias("docs"), (F.max_by("token", "at") == eos).alias("ends_on_eos"))


def doc_tokens(tokens: DataFrame, spans: DataFrame) -> DataFrame:
    """(doc_idx, tokens) of documents ``spans`` (doc_idx, first, last) out of a stream (pos, token): random access across files.

    Spans are cut to blocks of positions, so the join is by equality of blocks.
    """
    block = 1 << 16
    wanted = spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor(F.col("last") / block))))
    met = tokens.withColumn("block", F.floor(F.col("pos") / block)).join(wanted, "block").filter(F.col("pos").between(F.col("first"), F.col("last")))
    return met.groupBy("doc_idx").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda s: s["token"]).alias("tokens"))


def finalized(lines: DataFrame, tokens: DataFrame, raw: str = "raw", eos: int = 3) -> DataFrame:
    """(doc_idx, line_no, source, n_tok, eos_off): the documents of a token stream (pos, token) with the lines (line_no, source, raw) they came from.

    Lines that give no document are shifted over; an error if there are more lines than documents or the other way round.
    """
    docs = lengths(eos_offsets(tokens, eos))
    good = lines.filter(skip_reason(F.col(raw)).isNull()).count()
    if (have := docs.count()) != good:
        raise ValueError(f"{good} lines give documents, but the stream has {have}")
    return shift_over_skipped(lines, docs, raw).select("doc_idx", "line_no", "source", "n_tok", "eos_off")


def sanity(docs: DataFrame, decoded: DataFrame, lines: DataFrame, k: int = 3, seed: int = 42) -> DataFrame:
    """(doc_idx, same) of k documents: whether what their tokens decode to is the line's text."""
    from .sample import reservoir

    return reservoir(docs.select("doc_idx"), "doc_idx", k, seed).join(decoded, "doc_idx").join(lines, "doc_idx").select("doc_idx", F.col("decoded").eqNullSafe(F.col("text")).alias("same"))


def class_totals(totals: DataFrame) -> DataFrame:
    """Roll-up of ``source_totals`` to classes."""
    return totals.groupBy("class").agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"), F.sum("pct").alias("pct"), (F.sum("tokens") / F.sum("docs")).alias("mean_tokens"))


def lengths(offsets: DataFrame) -> DataFrame:
    """n_tok of each document: up to its end token from that of the one before."""
    before = offsets.select((F.col("doc_idx") + 1).alias("doc_idx"), F.col("eos_off").alias("_before"))
    return offsets.join(before, "doc_idx", "left").select("doc_idx", "eos_off", (F.col("eos_off") - F.coalesce("_before", F.lit(-1))).alias("n_tok"))


def document_index(docs: DataFrame) -> DataFrame:
    """(doc_idx, source, n_tok, eos_off) of ``docs`` (ord, source, n_tok), by running sums."""
    summed = with_running(docs, [F.col("ord")], F.col("n_tok"), "_sum")
    return with_rank(summed.select("ord", "source", "n_tok", "_sum"), [F.col("ord")], "_n").select((F.col("_n") - 1).alias("doc_idx"), "source", "n_tok", (F.col("_sum") - 1).alias("eos_off"))


def shift_over_skipped(lines: DataFrame, docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Documents joined to the lines they came from: the k-th document is the k-th line that isn't skipped."""
    good = with_rank(lines.filter(skip_reason(F.col(raw)).isNull()), [F.col("line_no")], "_n").withColumn("doc_idx", F.col("_n") - 1).drop("_n")
    return good.join(docs, "doc_idx")


def skipped_lines(lines: DataFrame, raw: str = "raw") -> DataFrame:
    return lines.withColumn("reason", skip_reason(F.col(raw))).filter("reason is not null")


def line_offsets(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """(line_no, byte_off): bytes of all earlier lines and their line feeds."""
    size = F.octet_length(raw) + 1
    return with_running(lines, [F.col("line_no")], size, "_sum").select("line_no", (F.col("_sum") - size).alias("byte_off"))


def first_mismatch(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """The smallest doc_idx at which the decoded text isn't the line's: one join where a bisection would probe."""
    return docs.join(lines, "doc_idx").filter(~F.col("decoded").eqNullSafe(F.col("text"))).agg(F.min("doc_idx").alias("doc_idx"))


def locate_in_shards(positions: DataFrame, shards: DataFrame) -> DataFrame:
    """(pos, file, offset): the shard that holds a token position.

    Shards are cut to cells of their mean size, two for each shard at most on average, so the join is by equality of cells.
    """
    spans = with_running(shards.select("file", "tokens", "ord").filter("tokens > 0"), [F.col("ord")], F.col("tokens"), "_hi").withColumn("_lo", F.col("_hi") - F.col("tokens"))
    total, n = spans.agg(F.coalesce(F.max("_hi"), F.lit(1)), F.count("*")).first()
    cell = max(1, total // max(1, n))
    cells = spans.withColumn("_cell", F.explode(F.sequence(F.expr(f"_lo div {cell}"), F.expr(f"(_hi - 1) div {cell}"))))
    met = positions.select("pos", F.expr(f"pos div {cell}").alias("_cell")).join(cells, "_cell").filter((F.col("pos") >= F.col("_lo")) & (F.col("pos") < F.col("_hi")))
    return met.select("pos", "file", (F.col("pos") - F.col("_lo")).alias("offset"))


def source_totals(docs: DataFrame, editorial: tuple[str, ...] = ()) -> DataFrame:
    """Documents, tokens, their share in per cent and mean, by source and by class."""
    kind = F.when(F.col("source").isin(*editorial), "editorial").otherwise("web") if editorial else F.lit("web")
    per = docs.groupBy("source", kind.alias("class")).agg(F.count("*").alias("docs"), F.sum("n_tok").alias("tokens"))
    total = docs.agg(F.sum("n_tok").alias("_total"))
    return per.crossJoin(F.broadcast(total)).select("source", "class", "docs", "tokens", (100 * F.col("tokens") / F.col("_total")).alias("pct"), (F.col("tokens") / F.col("docs")).alias("mean_tokens"))


def violations(docs: DataFrame, lines: int, tokens: int, longest: int = (1 << 32) - 1) -> DataFrame:
    """A row for each count that isn't as stated."""
    got = docs.agg(F.count("*").alias("lines"), F.coalesce(F.sum("n_tok"), F.lit(0)).alias("tokens"), F.coalesce(F.max("n_tok"), F.lit(0)).alias("longest"))
    want = {"lines": F.col("lines") == lines, "tokens": F.col("tokens") == tokens, "longest": F.col("longest") <= longest}
    rows = F.array(*(F.struct(F.lit(k).alias("check"), F.col(k).cast("long").alias("got"), ok.alias("ok")) for k, ok in want.items()))
    return got.select(F.explode(rows).alias("r")).select("r.*").filter("not ok").drop("ok")


def _take_apart(batches):
    import json

    import pyarrow as pa

    read = json.JSONDecoder()
    for batch in batches:
        rows = []
        for no, raw in zip(batch.column("line_no").to_pylist(), batch.column("raw").to_pylist(), strict=True):
            rest, place = (raw or "").strip(), 0
            while rest:
                try:
                    _, end = read.raw_decode(rest)
                except ValueError:
                    rows.append((no, place, rest, False))
                    break
                rows.append((no, place, rest[:end], True))
                rest, place = rest[end:].lstrip(), place + 1
        cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["line_no", "place", "object", "valid"])


def fused_objects(lines: DataFrame) -> DataFrame:
    """(line_no, place, object, valid): the JSON values that stand one after another in a line; what can't be read is the last one, and not valid."""
    return lines.select("line_no", "raw").mapInArrow(_take_apart, "line_no long, place long, object string, valid boolean")
