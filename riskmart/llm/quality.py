"""Quality rules, line first: lines are judged before documents.

Every line is tested for punctuation, navigation and boilerplate; failing lines go, and a document that
loses too large a share of its word characters goes as a whole. All of it is array expressions over the
text of one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import SPACES, n_words, words

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50
SYMBOLS = "#*$%&|<>"
# A line fails by: many separators (navigation), symbols on words (junk), no sentence mark in a short
# line (heading or menu), or a stock phrase (boilerplate).
NAVIGATION = r"(?:[|»›·•][^|»›·•]*){3}"
JUNK, JUNK_WORDS = r"[\p{L}\p{N}][#*$%&<>]{2,}", 3
SENTENCE_MARK = r"[.!?…。:;]"
SHORT_LINE = 7
BOILERPLATE = (r"(?i)all rights reserved|(?:licensed|released) under|terms of (?:use|service)|privacy policy|"
               r"accept (?:all )?cookies|click here|subscribe to|sign (?:in|up) to|enable javascript|lorem ipsum")


def line_passes(line: Column) -> Column:
    """Blank lines pass; they carry no text."""
    heading = ~line.rlike(SENTENCE_MARK) & n_words(line).between(1, SHORT_LINE)
    junk = F.regexp_count(line, F.lit(JUNK)) >= JUNK_WORDS
    return ~(line.rlike(NAVIGATION) | line.rlike(BOILERPLATE) | junk | heading)


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep``, ``text``, ``cleaned`` (its passing lines) and the counts of the base rules.

    Repeated words: every run of three words is hashed with its place, sorted by hash, and kept where a
    neighbour has the same hash; the places then say how many words the kept runs cover.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(*keep, text.alias("text")).withColumn("w", words(F.col("text")))
    runs = F.when(F.size("w") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("w") - 3),
        lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i"))))
    sorted_runs = base.withColumn("runs", F.sort_array(F.coalesce(runs, F.array().cast("array<struct<h:bigint,i:int>>"))))
    again = F.filter("runs", lambda x, j: (F.get("runs", j + 1)["h"] == x["h"])
                     | ((j > 0) & (F.get("runs", j - 1)["h"] == x["h"])))
    placed = sorted_runs.withColumn("at", F.sort_array(F.transform(again, lambda x: x["i"])))
    steps = F.zip_with(F.slice("at", F.lit(2), F.greatest(F.size("at") - 1, F.lit(0))), "at",
                       lambda b, a: F.least(F.lit(3), F.coalesce(b - a, F.lit(0))))
    lines = F.split("text", "\n", -1)
    full = F.filter(lines, lambda x: F.length(without(x, SPACES)) > 0)
    counts = F.struct(
        F.size("w").cast("long").alias("n_words"),
        F.length(without(F.col("text"), SPACES)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("at") > 0, 3 + F.aggregate(steps, F.lit(0), lambda s, x: s + x))
        .otherwise(0).cast("long").alias("n_repeat_words"),
        F.array_join(F.filter(lines, line_passes), "\n").alias("cleaned"))
    # as the one row of a generator: a filter on a count stays above it and is not worked out per element below
    return placed.withColumn("full", full).select(*keep, "text", F.inline(F.array(counts)))


def judge(docs: DataFrame, *keep: str, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Adds ``kept_chars`` (word characters of the passing lines), ``base_failed`` and ``kept``.

    Null text is empty text: no words, so it fails the base rules. Repeated rows are judged alike, columns
    that are not named in ``keep`` play no part, an empty table gives an empty result.
    """
    return (measures(docs, *keep)
            .withColumn("kept_chars", F.length(without(F.col("cleaned"), SPACES)).cast("long"))
            .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
            .withColumn("kept", ~F.col("base_failed") & (100 * (F.col("word_chars") - F.col("kept_chars"))
                                                         <= max_lost_percent * F.col("word_chars"))))


def clean(docs: DataFrame) -> DataFrame:
    """Documents that pass, with their own columns, whatever their names, and the text of the passing lines.

    Null and empty texts have too few words and go; repeated rows stay or go together; a text of any length is judged
    whole, and an empty table gives no row.
    """
    packed = docs.select("text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    fields = [F.col("cleaned").alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return judge(packed, "row").filter("kept").select(*fields)
