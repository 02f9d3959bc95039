"""Benchmark decontamination by spaced seeds.

A mask is laid on every place of a text and compares some of the words from there on, so a passage in which words
were exchanged still shares a seed with its source where the exchanged words fall on places a mask ignores.
Seeds of the training text meet those of the benchmark in a hash join, and around each hit the two texts are laid
on each other and compared word by word.

The masks are a family: of every window of 8 to 16 words in which a quarter is exchanged, wherever, at least one
mask compares only words that are equal. What the comparison accepts is therefore always found.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import id_out, keyed, with_key
from riskmart.session import stage

# The masks; 1 is compared, 0 ignored.
MASKS = ("11101", "100111", "1101001")
# A passage counts where, of WINDOW words laid on each other (or all of a shorter item), this share is equal.
WINDOW = 16
MIN_EQUAL_PERCENT = 75
# Items of fewer than SHORT words must be there word by word; those of fewer than MIN_ITEM are too short to tell from
# chance.
SHORT, MIN_ITEM = 8, 5
TOKEN = r"[\p{L}\p{N}]+"
# The seeds of the benchmark are broadcast up to this many bytes; beyond it the join shuffles.
BROADCAST_BYTES = 64 << 20
SEED_ROW_BYTES = 64


def tokens(text: Column) -> Column:
    """Words without punctuation and letter case; empty for null."""
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)), F.array().cast("array<string>"))


def token_hashes(text: Column) -> Column:
    return F.transform(tokens(text), lambda w: F.xxhash64(w))


def _compared(mask: str) -> list[int]:
    return [p for p, on in enumerate(mask) if on == "1"]


def _seeds(hashes: str, i: Column) -> Column:
    """One seed for each mask at place ``i``, null where the mask does not fit; each mask's seeds are its own."""
    return F.array(*[F.when(i + len(mask) <= F.size(hashes), F.xxhash64(F.lit(n), *[F.get(hashes, i + p) for p in _compared(mask)]))
                     for n, mask in enumerate(MASKS)])


def with_seeds(rows: DataFrame, hashes: str, place: str) -> DataFrame:
    """A row for each place of ``hashes`` and mask that fits there, with ``place`` and ``seed``.

    The outer form of explode keeps the optimizer from testing the array, and so hashing the text, once more.
    """
    starts = F.when(F.size(hashes) >= MIN_ITEM, F.sequence(F.lit(0), F.size(hashes) - MIN_ITEM))
    runs = rows.withColumn(place, F.explode_outer(starts)).filter(F.col(place).isNotNull())
    return runs.withColumn("seed", F.explode(_seeds(hashes, F.col(place))))


def benchmark_seeds(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The items (``item_id, item``: hashes of its words) and their seeds (``seed, item_id, item_place``)."""
    items = stage(benchmark.select(F.col("item_id").cast("long").alias("item_id"),
                                   token_hashes(F.col("text").cast("string")).alias("item"))
                  .filter(F.col("item_id").isNotNull() & (F.size("item") >= MIN_ITEM)).distinct(), "benchmark-items")
    seeds = stage(with_seeds(items, "item", "item_place").filter("seed IS NOT NULL")
                  .select("seed", "item_id", "item_place", "item").distinct(), "benchmark-seeds")
    return items, seeds


def hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``id, th, item_id, matched, first_word, last_word`` for each document and item with an overlap.

    ``matched`` is the largest number of equal words in a window; the words are places in the document.
    """
    _, seeds = benchmark_seeds(benchmark)
    bytes_ = seeds.select(F.sum(SEED_ROW_BYTES + 8 * F.size("item"))).first()[0] or 0
    side = F.broadcast(seeds) if bytes_ <= BROADCAST_BYTES else seeds
    train = with_seeds(keyed(docs).select("id", "th", token_hashes(F.col("text")).alias("words")), "words", "place")
    met = train.join(side, "seed")
    # a hit that goes on from one on the place before is part of the same overlap
    follows = None
    for mask in MASKS:
        same = (F.coalesce(F.get("words", F.col("place") - 1 + p) == F.get("item", F.col("item_place") - 1 + p), F.lit(False)) for p in _compared(mask))
        before = reduce(lambda x, y: x & y, same)
        follows = before if follows is None else follows | before
    starts = met.filter(~((F.col("place") > 0) & (F.col("item_place") > 0) & follows))
    # what is laid on each other, once for each shift. It is written, so that the comparison stays behind the
    # join: within its condition, every row of the join would carry its words.
    begin = F.greatest(F.lit(0), -F.col("shift"))
    laid = stage(starts.withColumn("shift", F.col("place") - F.col("item_place"))
            .withColumn("from", begin)
            .withColumn("n", F.least(F.size("item"), F.size("words") - F.col("shift")) - F.col("from"))
            .withColumn("width", F.least(F.lit(WINDOW), F.size("item")))
            .filter(F.col("n") >= F.col("width"))
            .select("id", "th", "item_id", "shift", "from", "n", "width",
                    F.slice("words", F.col("shift") + F.col("from") + 1, F.col("n")).alias("words"),
                    F.slice("item", F.col("from") + 1, F.col("n")).alias("item")).distinct(), "laid")
    laid = laid.withColumn("equal", F.zip_with("words", "item", lambda a, b: (a == b).cast("int")))
    laid = laid.withColumn("sums", F.transform(
        F.sequence(F.lit(1), F.col("n") - F.col("width") + 1),
        lambda s: F.aggregate(F.slice("equal", s, F.col("width")), F.lit(0), lambda a, x: a + x)))
    share = F.when(F.col("width") < SHORT, 100).otherwise(MIN_EQUAL_PERCENT)
    good = laid.withColumn("matched", F.array_max("sums")).filter(100 * F.col("matched") >= share * F.col("width"))
    first = F.col("shift") + F.col("from")
    return good.groupBy("id", "th", "item_id").agg(
        F.max("matched").alias("matched"), F.min(first).alias("first_word"), F.max(first + F.col("n") - 1).alias("last_word"))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """A row for each document: ``doc_id, contaminated, n_items, item_ids`` (sorted, joined by commas), ``matched``.

    An item is found where it overlaps the document by ``WINDOW`` words, or by all of a shorter item, of which
    ``MIN_EQUAL_PERCENT`` are equal place by place; one of fewer than ``SHORT`` words where all are equal, and one of
    fewer than ``MIN_ITEM`` is passed over. Null and empty texts hold no words and are clean, as are all documents for
    an empty benchmark; a text of any length is searched whole. Repeated rows are judged alike, columns other than
    doc_id and text play no part, and an empty table gives no row.
    """
    found = stage(hits(docs, benchmark), "overlaps").groupBy("id", "th").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"), F.max("matched").alias("matched"))
    return (keyed(docs).select("id", "th").join(found, ["id", "th"], "left")
            .select(id_out().alias("doc_id"), F.col("items").isNotNull().alias("contaminated"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce(F.array_join(F.col("items").cast("array<string>"), ","), F.lit("")).alias("item_ids"),
                    F.coalesce("matched", F.lit(0)).cast("long").alias("matched")))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without an overlap, with their own columns, whatever their names.

    Null and empty texts stay, repeated rows stay or go together, an empty table gives no row.
    """
    found = stage(hits(docs, benchmark).select("id", "th").distinct(), "contaminated")
    return with_key(docs).join(found, ["id", "th"], "left_anti").select("row.*")
