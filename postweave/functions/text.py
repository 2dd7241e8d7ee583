"""Text expressions: trimming, cleaning, tokens, chart labels."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postweave import settings

# The characters that count as white space. Java's ``\s`` is ASCII only and its
# Unicode variant leaves out U+001C..U+001F, so the set is written out.
WHITESPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# The same characters one by one, for trimming.
SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# Web addresses, up to the next white space, and the letters and digits of words.
ADDRESS = rf"(?:http|www)[^{WHITESPACE}]+"
WORD_CHARACTERS = "0-9a-zа-яё"


def strip(c: Column) -> Column:
    """Trim every kind of white space (``F.trim`` alone knows only the blank)."""
    return F.trim(c, F.lit(SPACES))


def has_text(c: Column) -> Column:
    """Whether anything but white space is there; stops at the first such character."""
    return c.rlike(f"[^{WHITESPACE}]")


def _words(column: str, min_length: int = 1) -> str:
    """SQL for the lower-cased words of a column, without addresses and escaped ampersands.

    Words are pulled out by what they consist of. Blanking what lies between them instead gives the
    same, but Java matches a negated class of non-ASCII letters about seven times slower.
    """
    text = f"replace(regexp_replace(lower(`{column}`), r'{ADDRESS}', ' '), '&amp;', ' ')"
    return f"regexp_extract_all({text}, r'[{WORD_CHARACTERS}]{{{min_length},}}', 0)"


def clean_text(column: str) -> Column:
    """Lower-cased words with single blanks between them; no addresses or punctuation."""
    return F.array_join(F.expr(_words(column)), " ")


def word_list(listed: Iterable[str]) -> str:
    """SQL list of words.

    The expressions over word lists are written as SQL: one call builds them, where a column
    function would make one literal object per word.
    """
    quoted = (w.replace("\\", "\\\\").replace("'", "\\'") for w in sorted(set(listed)))
    return ", ".join(f"'{w}'" for w in quoted)


def tokenize(
    column: str,
    stop_words: Iterable[str] | None = None,
    extra_stop_words: Iterable[str] = (),
    min_length: int = settings.MIN_TOKEN_LENGTH,
) -> Column:
    """Words of raw text: cleaned, without stop words, short words and plain numbers."""
    stop = settings.default_stop_words() if stop_words is None else frozenset(stop_words)
    stop = word_list(stop.union(w.lower() for w in extra_stop_words))
    # A cleaned word that starts with a letter sorts after the digits, so the pattern only runs on
    # words that start with a digit.
    keep = "(t >= ':' OR t RLIKE '[^0-9]')" + (f" AND t NOT IN ({stop})" if stop else "")
    return F.expr(f"filter({_words(column, max(min_length, 1))}, t -> {keep})")


def normalize_text(column: str, **options) -> Column:
    """The tokens of raw text joined by one blank."""
    return F.array_join(tokenize(column, **options), " ")


def words(posts: DataFrame) -> Column:
    """Token array of a posts frame: its ``tokens`` column, or ``clean_text`` split at white space."""
    if "tokens" in posts.columns:
        return F.coalesce(F.col("tokens"), F.array().cast("array<string>"))
    if "clean_text" not in posts.columns:
        raise ValueError("the frame has neither a tokens nor a clean_text column")
    text = F.coalesce(F.col("clean_text").cast("string"), F.lit(""))
    return F.array_remove(F.split(text, f"[{WHITESPACE}]+"), "")


def sanitize_label(c: Column) -> Column:
    """Chart label without pictographs and odd signs; ``unknown`` if nothing is left."""
    text = F.coalesce(c.cast("string"), F.lit("None"))
    kept = F.regexp_replace(text, rf"(?U)[^\w{WHITESPACE}\-.,:/()]+", "")
    label = strip(F.regexp_replace(kept, f"[{WHITESPACE}]+", " "))
    return F.when(label == "", F.lit("unknown")).otherwise(label)
