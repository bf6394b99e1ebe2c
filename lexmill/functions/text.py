"""Text cleaning as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import BOILERPLATE, BOILERPLATE_LINE

#: White space as Unicode has it.
SPACE = r"[ \t\n\r\f\x0B\x1C-\x1F\x85\p{Z}]"
_MARKUP_DROP = (
    r"(?s)<!--.*?-->", r"(?is)<ref[^>]*>.*?</ref>", r"(?i)<ref[^/]*/>", r"(?s)\{\|.*?\|\}", r"(?is)<gallery[^>]*>.*?</gallery>", r"(?is)<math[^>]*>.*?</math>",
    r"(?i)\[\[(?:File|Image|Fichier|Imagen|Media):[^\]]*\]\]", r"(?i)\[\[(?:Catégorie|Category|Kategoría|Kategorie):[^\]]*\]\]",
)
_TEMPLATE = r"\{\{[^{}]*(?:\{\{[^{}]*\}\}[^{}]*)?\}\}"
_LINKS = ((r"\[\[(?:[^\]|]*?\|)?([^\]]*?)\]\]", "$1"), (r"\[https?://[^\s\]]*(?:\s([^\]]+))?\]", "$1"))


def strip(text: Column) -> Column:
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def wiki_markup(text: Column, template_passes: int = 4) -> Column:
    """Comments, references, tables, formulas, files, categories and templates out; links and headings to their text."""
    for pattern in _MARKUP_DROP:
        text = F.regexp_replace(text, pattern, "")
    for _ in range(template_passes):  # further passes change nothing once none is left
        text = F.regexp_replace(text, _TEMPLATE, "")
    for pattern, to in _LINKS:
        text = F.regexp_replace(text, pattern, to)
    text = F.regexp_replace(text, r"<[^>]{1,200}>", "")
    text = F.regexp_replace(text, r"={2,}([^=\n]+)={2,}", "$1\n")
    return F.regexp_replace(text, r"(?m)^[-=*#]{5,}\s*$", "")


def urls(text: Column) -> Column:
    return F.regexp_replace(text, r"https?://\S+|www\.\S+", " ")


def emails(text: Column) -> Column:
    return F.regexp_replace(text, r"[\w.+-]+@[\w-]+\.[\w.]+", " ")


def html_tags(text: Column) -> Column:
    return F.regexp_replace(text, r"<[^>]{1,200}>", "")


def boilerplate(text: Column) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda line: ~line.rlike(BOILERPLATE)), "\n")


def is_boilerplate_line(line: Column) -> Column:
    return line.rlike(BOILERPLATE_LINE)


def mojibake(text: Column) -> Column:
    """UTF-8 that was read as Latin-1, put right; only if a sign of it is among the first 100 characters and the whole text can be."""
    suspect = F.substring(text, 1, 100).contains("Ã") & ~text.rlike(r"[^\x{0}-\x{FF}]")
    raw = F.encode(F.when(suspect, text).otherwise(F.lit("")), "ISO-8859-1")
    return F.when(suspect & F.is_valid_utf8(raw.cast("string")), raw.cast("string")).otherwise(text)


def normalize(text: Column) -> Column:
    text = F.translate(mojibake(text), "«»“”‘’–— ", "\"\"\"\"''-- ")
    text = F.regexp_replace(F.regexp_replace(text, r"[ \t]{2,}", " "), r"\n{3,}", "\n\n")
    return strip(text)


def clean(text: Column, wiki: Column | None = None) -> Column:
    """The whole chain; ``wiki`` says which rows have markup."""
    if wiki is not None:
        text = F.when(wiki, wiki_markup(text)).otherwise(text)
    return normalize(boilerplate(html_tags(emails(urls(text)))))


def windows(text: Column, size: int = 3000, cap: int = 100_000) -> Column:
    """The part of a text that signatures look at: all of it up to three windows, else its start, middle and end."""
    fold = lambda t: F.lower(strip(F.regexp_replace(t, f"{SPACE}+", " ")))
    capped = F.substring(text, 1, cap)
    n = F.length(capped)
    folded = fold(capped)
    m = F.length(folded)
    cut = lambda t, at, k: F.substr(t, at.cast("int"), F.lit(k))
    small = F.when(m <= 3 * size, folded).otherwise(F.concat_ws(" ", cut(folded, F.lit(1), size), cut(folded, F.floor(m / 2) - size // 2 + 1, size), cut(folded, m - size + 1, size)))
    wide = 3 * size // 2
    large = F.concat_ws(" ", *(F.substring(fold(cut(capped, at, wide)), 1, size) for at in (F.lit(1), F.floor(n / 2) - wide // 2 + 1, n - wide + 1)))
    return F.when(n <= 6 * size, small).otherwise(large)


def window_text(text: str, size: int = 3000, cap: int = 100_000) -> str:
    """``windows`` of a Python string, for Arrow passes; ``str.split`` knows the same white space as ``SPACE``."""
    fold = lambda t: " ".join(t.split()).lower()
    text = text[:cap]
    n = len(text)
    if n > 6 * size:
        wide = 3 * size // 2
        return " ".join(fold(text[at : at + wide])[:size] for at in (0, n // 2 - wide // 2, n - wide))
    folded = fold(text)
    m = len(folded)
    return folded if m <= 3 * size else " ".join(folded[at : at + size] for at in (0, m // 2 - size // 2, m - size))


def split_lines(text: Column, least: int = 20, most: int = 4000) -> Column:
    """Sentences as an array: paragraphs cut after ``.!?…``, short ones dropped, very long ones cut at the last space below ``most``, or else at ``most``.

    Of a sentence that was cut only the last piece can be dropped as short.
    """
    lines = F.split(F.regexp_replace(text, "\r", ""), r"\n+|(?<=[.!?…])\s+")
    kept = F.filter(F.transform(lines, strip), lambda x: F.length(x) >= least)
    piece = r"(?s)%s*+(.{1,%d}\z|.{1,%d}(?= )|.{1,%d})" % (SPACE, most, most - 1, most)
    cut = lambda x: F.transform(F.regexp_extract_all(x, F.lit(piece), F.lit(1)), strip)
    whole = lambda ps: F.when(F.length(F.element_at(ps, -1)) >= least, ps).otherwise(F.slice(ps, F.lit(1), F.size(ps) - 1))
    return F.flatten(F.transform(kept, lambda x: F.when(F.length(x) <= most, F.array(x)).otherwise(whole(cut(x)))))


def chatml(instruction: Column, answer: Column, system: Column | None = None) -> Column:
    turn = lambda role, t: F.concat(F.lit(f"<|im_start|>{role}\n"), t, F.lit("<|im_end|>"))
    turns = [turn("user", instruction), turn("assistant", answer)]
    if system is not None:
        turns.insert(0, F.when(system.isNotNull(), turn("system", system)))
    return F.concat_ws("\n", *turns)


def normalized_hash(text: Column) -> Column:
    """sha256 of the text with case and white space folded."""
    return F.sha2(strip(F.regexp_replace(F.lower(text), f"{SPACE}+", " ")), 256)


def human(n: Column) -> Column:
    """A number in short form: 1.2K, 3.4M, 5.6B."""
    short = lambda k, unit: F.concat(F.format_string("%.1f", n / k), F.lit(unit))
    return F.when(n >= 1e9, short(1e9, "B")).when(n >= 1e6, short(1e6, "M")).when(n >= 1e3, short(1e3, "K")).otherwise(n.cast("long").cast("string"))
