"""Chat formatting by quotation linking, in DataFrame operations only.

Lines that begin with ``>`` are quotes; the number of marks is their level.
Consecutive lines of one level form a quoted passage.  Passages are normalised
(marks off, case and white space folded) and hashed, and the hashes are joined
within the conversation to what earlier messages say in their own words: a whole
message, one of its paragraphs or one of its lines.  A passage belongs to the
earliest message that says it.  A passage that no message says as such was trimmed:
its paragraphs, its lines and its runs of lines are looked up as well, each in the
earliest message that says it, and it belongs to the one that says most of its
lines (then the longest run, then the earliest), if that is half of them.  Runs have
1, 2, 4, ... lines or all of a passage's; blank lines don't count.  A message replies to the message of its outermost
quote that is found, and of several such quotes to the latest message.

Threads are found by pointer doubling.  A conversation's reply order is by thread,
threads by their first message, and by turn inside a thread, so every reply comes
after what it replies to.  Rows are returned in that order, over range partitions
that split long conversations; no conversation is gathered into one task.

Quotes are removed from the text, with the attribution line directly above them
(one that ends in a colon and says wrote, schrieb, écrit or escribió).

Defined results: a null text is empty; a null conversation, turn or role links
with nothing and starts a thread of its own (thread is its turn); repeated rows
are returned as often, linked alike; a quote that no earlier message says is
removed and counted, and does not link.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace

MARKS = r"^(?:[ \t]*>)+"
ATTRIBUTION = r"(?i)(?:wrote|schrieb|écrit|escribió)[ \t ]*:[ \t]*$"


def level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def normal(text: Column) -> Column:
    """Case and white space folded."""
    return F.trim(F.lower(F.regexp_replace(text, r"[ \t\r\n]+", " ")))


def own_words(text: Column) -> Column:
    """The text without quotes and the attribution lines above them."""
    lines = F.split(text, "\n")
    own = F.filter(
        F.transform(lines, lambda x, i: F.struct(x.alias("x"), i.alias("i"))),
        lambda s: (level(s["x"]) == 0) & ~(s["x"].rlike(ATTRIBUTION) & F.coalesce(level(F.get(lines, s["i"] + 1)) > 0, F.lit(False))),
    )
    return F.when(text.rlike("(?m)" + MARKS), F.trim(F.array_join(F.transform(own, lambda s: s["x"]), "\n"))).otherwise(text)


def sayings(own: Column) -> Column:
    """Hashes by which a message can be quoted."""
    parts = F.concat(F.array(own), F.split(own, r"\n[ \t]*\n"), F.split(own, "\n"))
    return F.array_distinct(F.transform(F.filter(parts, lambda x: normal(x) != ""), lambda x: F.md5(normal(x).cast("binary"))))


def passages(messages: DataFrame) -> DataFrame:
    """(text_key, place, level, hash, lines) of the quoted passages of the distinct texts."""
    texts = messages.filter(F.col("text").rlike("(?m)" + MARKS)).select(F.sha2("text", 256).alias("text_key"), "text").dropDuplicates(["text_key"])
    lines = texts.select("text_key", F.posexplode(F.split("text", "\n")).alias("at", "line")).select("text_key", "at", level(F.col("line")).alias("level"), F.regexp_replace("line", MARKS, "").alias("body"))
    island = F.col("at") - F.row_number().over(Window.partitionBy("text_key", "level").orderBy("at"))
    runs = lines.filter("level > 0").withColumn("island", island).groupBy("text_key", "level", "island")
    joined = runs.agg(F.min("at").alias("place"), F.transform(F.array_sort(F.collect_list(F.struct("at", "body"))), lambda s: s["body"]).alias("lines")).withColumn("body", F.array_join("lines", " "))
    return joined.filter(normal(F.col("body")) != "").select("text_key", "place", "level", F.md5(normal(F.col("body")).cast("binary")).alias("hash"), "lines")


def said_lines(lines: Column) -> Column:
    """The lines that aren't blank, normalised."""
    return F.filter(F.transform(lines, normal), lambda x: x != "")


def runs_of(lines: Column, size: Column) -> Column:
    """(at, n, hash) of the runs of ``size`` lines, ``at`` from 1."""
    starts = F.when(F.size(lines) >= size, F.sequence(F.lit(1), F.size(lines) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.struct(i.alias("at"), size.alias("n"), F.md5(F.array_join(F.slice(lines, i, size), " ").cast("binary")).alias("hash")))


def paragraphs_of(lines: Column) -> Column:
    """(at, n, hash) of the paragraphs between blank lines, ``at`` counted in the lines that aren't blank."""
    kept = F.transform(lines, normal)
    parts = F.transform(F.split(F.array_join(kept, "\n"), r"\n\n+"), lambda x: F.filter(F.split(x, "\n"), lambda y: y != ""))
    before = lambda i: F.aggregate(F.slice(parts, 1, i), F.lit(0), lambda n, x: n + F.size(x))
    named = F.transform(parts, lambda x, i: F.struct((before(i) + 1).alias("at"), F.size(x).alias("n"), F.md5(F.array_join(x, " ").cast("binary")).alias("hash")))
    return F.filter(named, lambda s: s["n"] > 0)


def trimmed_links(left: DataFrame, own: DataFrame, said: DataFrame) -> DataFrame:
    """(conv_id, turn, place, level, origin) of the passages ``left`` (conv_id, turn, place, level, lines) that are said in parts; ``own`` has (conv_id, turn, own)."""
    quoted = left.withColumn("said", said_lines(F.col("lines"))).withColumn("total", F.size("said"))
    doublings = F.filter(F.transform(F.sequence(F.lit(0), F.lit(30)), lambda k: F.pow(F.lit(2), k).cast("int")), lambda x: x <= F.col("total"))
    quoted = quoted.withColumn("sizes", F.array_distinct(F.concat(doublings, F.array("total"))))
    parts = quoted.withColumn("part", F.explode(F.concat(F.flatten(F.transform("sizes", lambda x: runs_of(F.col("said"), x))), paragraphs_of(F.col("lines")))))
    parts = parts.select("conv_id", "turn", "place", "level", "total", F.col("part.at").alias("at"), F.col("part.n").alias("n"), F.col("part.hash").alias("hash")).distinct()
    # runs of the sizes that the conversation's passages ask for
    sizes = quoted.select("conv_id", F.explode("sizes").alias("size")).distinct()
    spoken = own.withColumn("said", said_lines(F.split("own", "\n"))).join(sizes, "conv_id").select("conv_id", "turn", F.explode(runs_of(F.col("said"), F.col("size"))).alias("part"))
    spoken = spoken.select("conv_id", F.col("part.hash").alias("hash"), F.col("turn").alias("origin")).unionByName(said.select("conv_id", "hash", "origin"))
    first = spoken.groupBy("conv_id", "hash").agg(F.min("origin").alias("origin"))
    found = parts.join(first, ["conv_id", "hash"]).filter("origin < turn")
    passage = ["conv_id", "turn", "place", "level"]
    lines = found.withColumn("line", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)))
    votes = lines.groupBy(*passage, "origin").agg(F.countDistinct("line").alias("covered"), F.max("n").alias("run"), F.max("total").alias("total")).filter("2 * covered >= total")
    return votes.groupBy(*passage).agg(F.max_by("origin", F.struct("covered", "run", (-F.col("origin")).alias("o"))).alias("origin"))


def reply_links(messages: DataFrame, ws: Workspace) -> DataFrame:
    """(conv_id, turn, reply_to, n_linked) of the messages with a quote that is found."""
    quoting = messages.filter("conv_id is not null and turn is not null and role is not null").filter(F.col("text").rlike("(?m)" + MARKS)).select("conv_id", "turn", F.sha2("text", 256).alias("text_key"))
    quotes = quoting.distinct().join(passages(messages), "text_key").select("conv_id", "turn", "place", "level", "hash", "lines")
    said = messages.filter("conv_id is not null and turn is not null and role is not null").join(quoting.select("conv_id").distinct(), "conv_id", "left_semi")
    own = said.select("conv_id", "turn", own_words(F.col("text")).alias("own"))
    said = own.select("conv_id", "turn", F.explode(sayings(F.col("own"))).alias("hash")).groupBy("conv_id", "hash").agg(F.min("turn").alias("origin"))
    met = ws.save(quotes.join(said, ["conv_id", "hash"], "left").withColumn("origin", F.when(F.col("origin") < F.col("turn"), F.col("origin"))), "met")
    found = met.filter("origin is not null").select("conv_id", "turn", "place", "level", "origin")
    left = met.filter("origin is null").select("conv_id", "turn", "place", "level", "lines")
    asked = own.join(left.select("conv_id").distinct(), "conv_id", "left_semi")
    found = found.unionByName(trimmed_links(left, asked, said))
    return found.groupBy("conv_id", "turn").agg(F.min_by("origin", F.struct("level", (-F.col("origin")).alias("o"))).alias("reply_to"), F.countDistinct("place").alias("n_linked"))


def threads(links: DataFrame, ws: Workspace) -> DataFrame:
    """(conv_id, turn, thread, depth) of the messages that reply, by pointer doubling."""
    now = ws.save(links.select("conv_id", "turn", F.col("reply_to").alias("thread"), F.lit(1).cast("long").alias("depth")), "up-0")
    k = 0
    while True:
        over = now.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("next"), F.col("depth").alias("more"))
        met = now.join(over, ["conv_id", "thread"], "left")
        if met.filter("next is not null").isEmpty():
            return now
        k += 1
        now = ws.save(met.select("conv_id", "turn", F.coalesce("next", "thread").alias("thread"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth")), f"up-{k}")
        ws.drop(f"up-{k - 1}")


def reply_ordered(messages: DataFrame, ws: Workspace | None = None) -> DataFrame:
    """A row for each message: conv_id, turn, role, reply_to, thread, depth, n_quotes, n_linked, chat; in reply order."""
    ws = ws or Workspace(messages.sparkSession, "chat")
    m = messages.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text"))
    plain = m.withColumns({"own": own_words(F.col("text")), "text_key": F.when(F.col("text").rlike("(?m)" + MARKS), F.sha2("text", 256))}).drop("text")
    links = ws.save(reply_links(m, ws), "links")
    counts = passages(m).groupBy("text_key").agg(F.count("*").alias("n_quotes"))
    linked = links.join(threads(links, ws), ["conv_id", "turn"])
    whole = F.col("role").isNotNull()
    out = plain.join(linked, ["conv_id", "turn"], "left").join(counts, "text_key", "left").withColumns({
        "reply_to": F.when(whole, F.col("reply_to")), "thread": F.when(whole, F.coalesce("thread", "turn")).otherwise(F.col("turn")),
        "depth": F.when(whole, F.coalesce("depth", F.lit(0))).otherwise(F.lit(0)).cast("long"), "n_quotes": F.coalesce("n_quotes", F.lit(0)), "n_linked": F.when(whole, F.coalesce("n_linked", F.lit(0))).otherwise(F.lit(0)),
    })
    chat = F.concat(F.lit("<|im_start|>"), F.coalesce("role", F.lit("")), F.lit("\n"), "own", F.lit("<|im_end|>"))
    ordered = out.select("conv_id", "turn", "role", "reply_to", "thread", "depth", "n_quotes", "n_linked", chat.alias("chat"))
    return ordered.orderBy("conv_id", "thread", "turn", "role", "chat")
