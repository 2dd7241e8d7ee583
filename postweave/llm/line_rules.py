"""Line-first cleaning with DataFrame functions only.

Each line is judged by three rules; lines that fail go, and a document that loses too much of its text
goes as a whole. All numbers of a document are made within its row: nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
PUNCTUATION = r"[!-/:-@\[-`{-~]"
SEPARATOR = r"[|>»•·›]"
SENTENCE_END = r"[.!?:;…\"”»)\]][\x20\x09-\x0D]*$"

# Phrases of page furniture and notices, in lower case.
BOILERPLATE = (
    "all rights reserved",
    "click here",
    "cookie policy",
    "copyright ©",
    "enable javascript",
    "follow us on",
    "general public license",
    "licensed under",
    "log in to",
    "permission is hereby granted",
    "privacy policy",
    "sign up for",
    "skip to content",
    "spdx-license-identifier",
    "subscribe to",
    "terms of service",
    "terms of use",
    "use of cookies",
)

# A line of fewer words needs the end of a sentence; boilerplate is sought in lines up to the second number of words.
SHORT_LINE, NOTICE_LINE = 5, 30
# A line fails with more than this share (percent) of punctuation; a document, if it loses more than that share.
MOST_PUNCTUATION, MOST_LOST = 20, 30
# Words of a window, the least words of a document, and the most words (percent) in repeated windows.
WINDOW, LEAST_WORDS, MOST_REPEATED = 8, 20, 30


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once for each row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def punctuation_fails(line: Column, words: Column, chars: Column) -> Column:
    """Mostly punctuation, or a fragment: a few words without the end of a sentence."""
    heavy = F.regexp_count(line, F.lit(PUNCTUATION)) * 100 > chars * MOST_PUNCTUATION
    return heavy | ((words < SHORT_LINE) & ~line.rlike(SENTENCE_END))


def navigation_fails(line: Column, words: Column) -> Column:
    """A separator for every five words or fewer, as in menus and bread crumbs."""
    separators = F.regexp_count(line, F.lit(SEPARATOR))
    return (separators > 0) & (separators * 5 >= words)


def boilerplate_fails(line: Column, words: Column) -> Column:
    """A short line with a phrase of page furniture."""
    found = let(F.lower(line), lambda low: F.exists(F.array(*map(F.lit, BOILERPLATE)), lambda p: F.contains(low, p)))
    return (words <= NOTICE_LINE) & found


def judged_lines(text: Column) -> Column:
    """Array of (line, words, chars, failed) of the lines that hold a word, in order."""
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    counted = F.transform(
        lines,
        lambda line: F.struct(
            line.alias("line"),
            F.regexp_count(line, F.lit(WORD)).cast("long").alias("words"),
            F.length(F.regexp_replace(line, SPACE, "")).cast("long").alias("chars"),
        ),
    )

    def judge(x: Column) -> Column:
        line, words, chars = x["line"], x["words"], x["chars"]
        failed = navigation_fails(line, words) | punctuation_fails(line, words, chars) | boilerplate_fails(line, words)
        return F.struct(line.alias("line"), words.alias("words"), chars.alias("chars"), failed.alias("failed"))

    return F.transform(counted, judge)


def total(lines: Column, field: str) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda sum_, x: sum_ + x[field])


def repeated_words(text: Column, window: int = WINDOW) -> Column:
    """Number of words that lie in a window found twice or more in the text, the first one included.

    Windows are compared by the 64-bit hash of their words' hashes. Only texts with equal windows sort them
    with their places; the words covered are then the gaps between places, each counted up to the window.
    """

    def covered(places: Column) -> Column:
        gaps = F.transform(places, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(places, i + 1) - p, F.lit(window))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda sum_, gap: sum_ + gap)

    def repeated(ordered: Column) -> Column:
        near = lambda x, i: (x["hash"] == F.get(ordered, i - 1)["hash"]) | (x["hash"] == F.get(ordered, i + 1)["hash"])
        found = F.filter(ordered, near)
        return let(F.sort_array(F.transform(found, lambda x: x["place"])), covered)

    def of_windows(hashes: Column) -> Column:
        placed = F.transform(hashes, lambda h, i: F.struct(h.alias("hash"), i.alias("place")))
        unique = F.size(F.array_distinct(hashes)) == F.size(hashes)
        return F.when(unique, F.lit(0).cast("long")).otherwise(let(F.sort_array(placed), repeated))

    def of_words(words: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(words) - window)
        windows = F.transform(at, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(window))))
        return F.when(F.size(words) <= window, F.lit(0).cast("long")).otherwise(let(windows, of_windows))

    return let(F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda word: F.xxhash64(word)), of_words)


def clean_lines(docs: DataFrame, text: str = "text", name: str = "rules") -> DataFrame:
    """All columns of ``docs`` and one struct ``rules`` (or another ``name``) of the findings.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, lost_chars, kept,
    clean_text (the lines that passed). A null text counts as empty: no words, not kept. Equal rows get
    equal findings. If ``docs`` has a column of that name, the new one takes its place.
    """
    value = F.coalesce(F.col(text), F.lit(""))

    def findings(lines: Column) -> Column:
        plain = F.transform(lines, lambda x: x["line"])
        failed = F.filter(lines, lambda x: x["failed"])
        return F.struct(
            total(lines, "words").alias("n_words"),
            total(lines, "chars").alias("word_chars"),
            F.regexp_count(value, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
            (F.size(plain) - F.size(F.array_distinct(plain))).cast("long").alias("n_dup_lines"),
            repeated_words(value).alias("n_repeat_words"),
            total(failed, "chars").alias("lost_chars"),
            F.array_join(F.transform(F.filter(lines, lambda x: ~x["failed"]), lambda x: x["line"]), "\n").alias("clean_text"),
        )

    def verdict(x: Column) -> Column:
        base = (x["n_words"] < LEAST_WORDS) | (100 * x["n_repeat_words"] > MOST_REPEATED * x["n_words"])
        lost = 100 * x["lost_chars"] > MOST_LOST * x["word_chars"]
        return x.withField("base_failed", base).withField("kept", ~base & ~lost)

    # Out of an explode of one element the findings are made once, however many filters and columns use them.
    return docs.withColumn(name, F.explode(F.array(let(let(judged_lines(value), findings), verdict))))


def line_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each document: its numbers and whether it is kept."""
    rules = clean_lines(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")))
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars")
    return rules.select("doc_id", *(F.col(f"rules.{f}").alias(f) for f in fields))


def clean_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """The documents that are kept, with the columns of ``docs``; their text is what passed, ``n_chars`` its length."""
    name = "rules"
    while name in docs.columns:
        name += "_"
    rules = F.col(f"{name}.clean_text")
    new = {text: rules} | ({n_chars: F.length(rules).cast(docs.schema[n_chars].dataType)} if n_chars in docs.columns else {})
    return clean_lines(docs, text, name).where(f"{name}.kept").select(*(new.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns))


def _sql_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


LINE_REPORT_SQL = f"""
WITH lines AS (
  SELECT doc_id, n, u.line, u.nth,
         len(regexp_extract_all(u.line, '{WORD}')) AS words,
         length(regexp_replace(u.line, '{SPACE}', '', 'g')) AS chars,
         len(regexp_extract_all(u.line, '{PUNCTUATION}')) AS marks,
         len(regexp_extract_all(u.line, '{SEPARATOR}')) AS separators
  FROM (SELECT doc_id, row_number() OVER () AS n, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents) d,
       LATERAL (SELECT unnest(parts) AS line, generate_subscripts(parts, 1) AS nth) u
), judged AS (
  SELECT *,
         (separators > 0 AND 5 * separators >= words)
         OR 100 * marks > {MOST_PUNCTUATION} * chars
         OR (words < {SHORT_LINE} AND NOT regexp_matches(line, '{SENTENCE_END}'))
         OR (words <= {NOTICE_LINE} AND len(list_filter([{_sql_list(BOILERPLATE)}], lambda p: contains(lower(line), p))) > 0) AS failed
  FROM lines WHERE words > 0
), per_doc AS (
  SELECT n, sum(words) AS n_words, sum(chars) AS word_chars, count(*) - count(DISTINCT line) AS n_dup_lines,
         coalesce(sum(chars) FILTER (failed), 0) AS lost_chars
  FROM judged GROUP BY n
), tokens AS (
  SELECT n, unnest(w) AS word, generate_subscripts(w, 1) AS place
  FROM (SELECT row_number() OVER () AS n, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents)
), windows AS (
  SELECT n, place, list(word) OVER (PARTITION BY n ORDER BY place ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS words
  FROM tokens
), repeated AS (
  SELECT n, place FROM windows WHERE len(words) = {WINDOW}
  QUALIFY count(*) OVER (PARTITION BY n, words) > 1
), gaps AS (
  SELECT n, least({WINDOW}, coalesce(lead(place) OVER (PARTITION BY n ORDER BY place) - place, {WINDOW})) AS gap FROM repeated
), repeats AS (
  SELECT n, sum(gap) AS n_repeat_words FROM gaps GROUP BY n
), numbered AS (
  SELECT doc_id, row_number() OVER () AS n, len(regexp_extract_all(coalesce(text, ''), '{SYMBOL}')) AS n_symbols FROM documents
), numbers AS (
  SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM numbered LEFT JOIN per_doc USING (n) LEFT JOIN repeats USING (n)
)
SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words AS base_failed,
       NOT (n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED} * n_words)
       AND NOT 100 * lost_chars > {MOST_LOST} * word_chars AS kept
FROM numbers
"""
