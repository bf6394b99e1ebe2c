"""Text metrics and predicates as column expressions."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import COMMON_GATE, COMMON_LIGHT, COMMON_SCORE, DELIBERATION, UNCERTAINTY
from .text import SPACE, strip

LETTER, DIGIT, UPPER = r"\p{L}", r"\p{Nd}", r"\p{Lu}"
FRENCH = "a-zA-ZàâäéèêëîïôöùûüÿçœæÀÂÄÉÈÊËÎÏÔÖÙÛÜŸÇŒÆ"
_CONSONANTS = "bcdfghjklmnpqrstvwxzç"
_VOWELS = "aeiouyàâäéèêëîïôöùûüœæ"


def count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def share(text: Column, pattern: str) -> Column:
    """Of the characters; 0 for an empty text."""
    n = F.length(text)
    return F.when(n > 0, count(text, pattern) / n).otherwise(0.0)


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"{SPACE}+"), lambda w: w != "")


def lines(text: Column) -> Column:
    """Stripped, and not empty."""
    return F.filter(F.transform(F.split(text, "\n"), strip), lambda x: x != "")


def upper_share(text: Column) -> Column:
    """Of the letters."""
    letters = count(text, LETTER)
    return F.when(letters > 0, count(text, UPPER) / letters).otherwise(0.0)


def mean_length(plain: Column, least: int) -> Column:
    """Of an array of words; null with fewer than ``least``."""
    return F.when(F.size(plain) >= least, F.aggregate(plain, F.lit(0), lambda a, w: a + F.length(w)) / F.size(plain))


def mean_word_length(text: Column, least: int = 10) -> Column:
    """Of the words of letters only; null with fewer than ``least``."""
    return mean_length(F.filter(words(text), lambda w: w.rlike(r"^\p{L}+$")), least)


def line_repetition(text: Column) -> Column:
    own = lines(text)
    return F.when(F.size(own) > 0, 1 - F.size(F.array_distinct(own)) / F.size(own)).otherwise(0.0)


def list_share(text: Column) -> Column:
    """Lines that begin like a list's."""
    own = lines(text)
    return F.when(F.size(own) > 0, F.size(F.filter(own, lambda x: x.rlike(r"^[*#-]"))) / F.size(own)).otherwise(0.0)


def letter_words(text: Column, letters: str) -> Column:
    """Words, as runs of letters and digits, that hold only ``letters``."""
    return F.filter(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)), lambda w: w.rlike(f"^[{letters}]+$"))


def common_share(found: Column, common: Sequence[str], least: int, otherwise: float | None) -> Column:
    known = F.array(*(F.lit(w) for w in dict.fromkeys(common)))
    return F.when(F.size(found) >= least, F.size(F.filter(found, lambda w: F.array_contains(known, w))) / F.size(found)).otherwise(otherwise)


def french_share(text: Column) -> Column:
    """Of the gate; null with fewer than 20 words."""
    return common_share(letter_words(F.substring(text, 1, 2000), "a-zàâäéèêëîïôùûüçœæ"), COMMON_GATE, 20, None)


def is_french(text: Column, threshold: Column | float, detector: Callable[[Column], Column] | None = None, confidence: float = 0.75) -> Column:
    """Short texts count as French, and so do undecided ones, unless a ``detector`` is sure of another language.

    The detector makes a struct (lang, prob), or null, of a text's first 3000 characters.
    """
    r = french_share(text)
    undecided = F.lit(True)
    if detector is not None:
        said = detector(F.substring(text, 1, 3000))
        undecided = F.coalesce((said["lang"] == "fr") | (said["prob"] < confidence), F.lit(True))
    return F.when((F.length(text) < 200) | (r >= threshold), True).when(r < 0.01, False).otherwise(undecided)


def is_french_light(text: Column, threshold: Column | float) -> Column:
    r = common_share(letter_words(F.substring(text, 1, 3000), "a-zà-ÿ"), COMMON_LIGHT, 10, None)
    return r.isNull() | (r >= threshold)


def entropy(text: Column) -> Column:
    """Shannon entropy of the characters, in bits; each distinct one is counted by what its removal takes away."""
    n = F.length(text)
    kinds = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    part = F.transform(kinds, lambda c: (n - F.length(F.replace(text, c, F.lit("")))).cast("double"))
    total = F.aggregate(part, F.lit(0.0), lambda s, k: s + k * F.log2(k))
    return F.when(n > 0, F.greatest(F.lit(0.0), F.log2(n) - total / n)).otherwise(0.0)


def vocabulary(text: Column, most: int = 500) -> Column:
    """Distinct words among the first ``most``."""
    own = F.slice(words(F.lower(text)), 1, most)
    return F.when(F.size(own) > 0, F.size(F.array_distinct(own)) / F.size(own)).otherwise(0.0)


def french_density(text: Column) -> Column:
    return common_share(letter_words(F.substring(text, 1, 3000), "a-zàâäéèêëîïôùûüçœæ"), COMMON_SCORE, 5, 0.5)


def quality_score(text: Column) -> Column:
    h = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (entropy(F.substring(text, 1, 2000)) - 2.5) / 2.5))
    return 0.5 * h + 0.3 * vocabulary(text) + 0.2 * french_density(text)


_FRENCH_WORD = re.compile(r"\b[a-zàâäéèêëîïôùûüçœæ]+\b")
_COMMON_SCORE = frozenset(COMMON_SCORE)


def quality_of(text: str) -> float:
    """``quality_score`` of a Python string, for Arrow passes."""
    head = text[:2000]
    n = len(head)
    h = max(0.0, math.log2(n) - sum(k * math.log2(k) for k in Counter(head).values()) / n) if n else 0.0
    own = text.lower().split(None, 500)[:500]
    found = _FRENCH_WORD.findall(text[:3000].lower())
    french = sum(w in _COMMON_SCORE for w in found) / len(found) if len(found) >= 5 else 0.5
    return 0.5 * max(0.0, min(1.0, (h - 2.5) / 2.5)) + 0.3 * (len(set(own)) / len(own) if own else 0.0) + 0.2 * french


def latin_share(text: Column, wide: bool = False) -> Column:
    """Of the first 2000 characters; the wide class also has brackets, quotes, dashes, percent, euro and the vertical tab, which SQL's white space hasn't."""
    own = r"[A-Za-z0-9À-ſ \t\n\f\r.,;:!?'\"()\-" + (r"\x0B\[\]–—…«»%€" if wide else "") + "]"
    return share(F.substring(text, 1, 2000), own)


def bucket(n: Column, bounds: Sequence[int] = (100, 500, 2000, 10000)) -> Column:
    """Half-open: the first bound that n is below, or the last one with a plus."""
    out = F.when(n < bounds[0], f"<{bounds[0]}")
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        out = out.when(n < hi, f"{lo}-{hi}")
    return out.otherwise(f">={bounds[-1]}")


def trigrams(text: Column, letters: str = "a-zà-ÿ", most: int | None = 50) -> Column:
    own = letter_words(text, letters)
    # words are shifted against each other, so the text is taken apart three times and not once for each gram
    two = F.zip_with(own, F.slice(own, F.lit(2), F.lit(1 << 30)), lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    three = F.zip_with(two, F.slice(own, F.lit(3), F.lit(1 << 30)), lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)))
    out = F.filter(three, lambda g: g.isNotNull())
    return F.slice(out, 1, most) if most else out


def is_suspect_word(core: Column) -> Column:
    """Signs of bad recognition in a word without its outer punctuation: foreign letters, letters beside digits, no vowel, four consonants on end, changing case."""
    low = F.lower(core)
    plain = core.rlike(r"^\p{L}+$")
    flips = F.regexp_count(core, F.lit(r"\p{Lu}(?=\P{Lu})|\P{Lu}(?=\p{Lu})"))
    return core.rlike(r"\p{L}") & (
        core.rlike(rf"[\p{{L}}&&[^{FRENCH}]]") | core.rlike(r"\p{L}\p{Nd}|\p{Nd}\p{L}") | (plain & (F.length(core) >= 3) & ~low.rlike(f"[{_VOWELS}]"))
        | low.rlike(f"[{_CONSONANTS}]{{4,}}") | (plain & (F.length(core) >= 4) & (flips >= 2))
    )


def word_cores(text: Column) -> Column:
    """Words without outer punctuation that hold a letter or digit."""
    return F.filter(F.transform(words(text), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")), lambda w: w != "")


def suspect_share(text: Column) -> Column:
    cores = word_cores(text)
    return F.when(F.size(cores) > 0, F.size(F.filter(cores, is_suspect_word)) / F.size(cores)).otherwise(0.0)


def foreign_share(text: Column) -> Column:
    """Letters that aren't French, of the letters."""
    letters = count(text, LETTER)
    return F.when(letters > 0, count(text, rf"[\p{{L}}&&[^{FRENCH}]]") / letters).otherwise(0.0)


def training_hours(steps: Column, tokens_per_step: int, rate: Column) -> Column:
    """Hours that the steps take at a rate of tokens per second; null without a rate."""
    return F.when(rate > 0, steps * tokens_per_step / rate / 3600)


def budget_estimate(price_per_hour: Column, hours: Column, count: Column | int = 1) -> Column:
    """Price of ``count`` machines for the hours."""
    return price_per_hour * hours * count


def noise_rank(suspect: Column, fertility: Column, foreign: Column, fallback: Column, base: float = 1.54) -> Column:
    return F.greatest(suspect, F.least(F.lit(1.0), F.greatest(F.lit(0.0), (fertility - base) / 1.5)), foreign, fallback)


def is_valid_example(instruction: Column, answer: Column) -> Column:
    """Of an instruction and its answer: lengths, no markup of thoughts, no echo, no thinking aloud, no more than one question."""
    low, ans = F.lower(F.concat_ws(" ", instruction, answer)), F.lower(answer)
    good = F.length(instruction).between(8, 800) & F.length(answer).between(20, 4000)
    bad = low.contains("<think>") | low.contains("</think>") | low.startswith("```") | (answer.startswith("{") & answer.endswith("}")) | (instruction == answer)
    for mark in (*DELIBERATION, *UNCERTAINTY):
        bad = bad | ans.contains(mark)
    return F.coalesce(good & ~bad & (count(answer, r"\?") < 2), F.lit(False))


def skip_reason(line: Column, names: Sequence[str] = ("text", "content", "raw_content", "body", "page_content")) -> Column:
    """Why a line of JSON gives no document; null if it does."""
    parsed = F.try_parse_json(line)
    found = F.coalesce(*(F.when(F.get_json_object(line, f"$.{k}") != "", F.get_json_object(line, f"$.{k}")) for k in names))
    return F.when(strip(line) == "", "blank").when(parsed.isNull(), "invalid").when(~strip(line).startswith("{"), "not an object").when(found.isNull(), "no text")


def log_fields(line: Column) -> Column:
    """Step, steps, loss and thousand tokens per second of a training log line; what is missing is null."""
    get = lambda p, t: F.regexp_extract(line, p, 1).try_cast(t)
    return F.struct(
        get(r"\[step\s+([\d,]+)/", "string").alias("step_text"), F.regexp_replace(F.regexp_extract(line, r"\[step\s+([\d,]+)/", 1), ",", "").try_cast("long").alias("step"),
        F.regexp_replace(F.regexp_extract(line, r"/\s*([\d,]+)\]", 1), ",", "").try_cast("long").alias("steps"), get(r"loss\s+([\d.]+)", "double").alias("loss"), get(r"([\d.]+)\s*k tok/s", "double").alias("ktok"),
    ).dropFields("step_text")


def learning_rate(step: Column, warmup: int, total: int, top: float, floor: float) -> Column:
    """Linear warm-up, then half a cosine down to ``floor``."""
    ratio = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (step - warmup) / F.lit(float(max(1, total - warmup)))))
    return F.when(step < warmup, top * (step + 1) / warmup).otherwise(floor + 0.5 * (1 + F.cos(F.pi() * ratio)) * (top - floor))


def is_byte_piece(piece: Column) -> Column:
    """Whether a vocabulary piece stands for one byte, as in ``<0x0A>``."""
    return piece.rlike("^<0x[0-9A-Fa-f]{2}>$")


def fertility(tokens: Column, text: Column) -> Column:
    """Tokens for each word; null without words."""
    n = F.size(word_cores(text))
    return F.when(n > 0, F.size(tokens) / n)


def remaining_seconds(step: Column, steps: Column, tokens_per_step: int, rate: Column) -> Column:
    """Until the last step, at a rate of tokens per second."""
    return F.when(rate > 0, (steps - step) * tokens_per_step / rate)
