"""Mixing sources to target weights by subset-sum budget fitting.

Documents are counted by source and exact length; each source's budget is laid out over the lengths in
proportion from the longest down, and a bounded-knapsack program fits the remaining words. The
documents of a length are then taken in the order of a seeded hash. Only counts by (source, length) meet in
one task; rows do not.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskmart.llm.common import NULL_ID, n_words, with_key
from riskmart.session import stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MAX_COPIES = 2
SEED = 20240229
DP_WORDS = 1 << 16


def targets(sizes: DataFrame) -> DataFrame:
    """``source, source_size, target`` from one row per source.

    Weights repeat over the sources by code point, null last. A target above ``MAX_COPIES`` times its source
    stops there and the excess is shared again by weight: with the sources in the order of limit / weight,
    those before the first one below its limit are the ones at their limit, and the others get the rest of
    the budget by weight. The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), place + 1)
    everything = Window.partitionBy()
    ranked = sizes.withColumn("weight", weight).withColumn("most", MAX_COPIES * F.col("source_size"))
    ranked = ranked.withColumn("budget", SHARE * F.sum("source_size").over(everything))
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    ranked = ranked.withColumn("per_weight", (F.col("budget") - F.coalesce(F.sum("most").over(before), F.lit(0)))
                               / F.sum("weight").over(after))
    free = F.col("most") / F.col("weight") > F.col("per_weight")
    ranked = ranked.withColumn("free", F.max(free).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ranked = ranked.withColumn("at", F.row_number().over(order))
    level = F.min_by("per_weight", F.when(F.col("free"), F.col("at"))).over(everything)
    return ranked.withColumn("level", level).select(
        "source", "source_size",
        F.when(F.col("free"), F.col("weight") * F.col("level")).otherwise(F.col("most")).cast("double").alias("target"))


def fit_counts(lengths: list[int], counts: list[int], budget: int, dp_words: int = DP_WORDS) -> list[int]:
    """How many documents of each length to take, at most ``counts``, for ``budget`` words at most.

    From the longest to the shortest, each length gets its share of what is left of the budget, or as many as
    it takes for the shorter ones to be able to fill the rest. What then is still missing is fitted by the
    bounded knapsack: the largest sum that the counts left can make, then with up to ``dp_words`` words given
    back, then with one more document of a length above ``dp_words``. A budget within ``dp_words`` is always
    met as closely as the lengths can.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if total == 0 or budget <= 0:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    order = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    best, most = [0] * len(lengths), -1
    for more in [None, *(i for i in order if dp_words < lengths[i] <= budget)]:
        shares = _shares(lengths, counts, budget, total, order, more)
        for back in ((), order[::-1], order, order[1::2] + order[::2]):
            taken = _filled(lengths, counts, budget, list(shares), order, dp_words, back)
            words = sum(n * t for n, t in zip(lengths, taken))
            if words > most:
                best, most = taken, words
            if most == budget:
                return best
    return best


def _shares(lengths: list[int], counts: list[int], budget: int, total: int, order: list[int], more: int | None) -> list[int]:
    """Counts near the budget's share of each; ``more`` is the place of a length that gets one document above it."""
    taken, rest, others = [0] * len(lengths), budget, total
    for i in order:
        n, c = lengths[i], counts[i]
        if n == 0:
            taken[i] = c * budget // total
            continue
        share = c * rest // others if others else 0
        others -= n * c
        needed = max(0, -((others - rest) // n))
        taken[i] = min(max(share, needed) + (i == more), c, rest // n)
        rest -= n * taken[i]
    return taken


def _filled(lengths: list[int], counts: list[int], budget: int, taken: list[int], order: list[int], dp_words: int,
            back: Sequence[int]) -> list[int]:
    """``taken`` with the knapsack over the rest of the budget and ``dp_words`` words of ``back``, given back in this order."""
    rest = budget - sum(n * t for n, t in zip(lengths, taken))
    for i in back:
        if lengths[i] and rest < dp_words:
            less = min(taken[i], (dp_words - rest) // lengths[i])
            taken[i], rest = taken[i] - less, rest + less * lengths[i]
    left = [counts[i] - taken[i] for i in order]
    for place, add in _knapsack([lengths[i] for i in order], left, min(rest, dp_words)).items():
        taken[order[place]] += add
    return taken


def _knapsack(lengths: list[int], counts: list[int], rest: int) -> dict[int, int]:
    """Counts by place for the largest reachable sum up to ``rest``.

    Reachable sums are the bits of one integer; counts are split into powers of two, and for each sum the
    item that first reached it is noted, so memory is one entry per sum.
    """
    if rest <= 0:
        return {}
    full = (1 << (rest + 1)) - 1
    sums, first = 1, {}
    items: list[tuple[int, int]] = []
    for i, (n, count) in enumerate(zip(lengths, counts)):
        if not 0 < n <= rest:
            continue
        count, power = min(count, rest // n), 1
        while count > 0 and not sums >> rest & 1:
            take = min(power, count)
            fresh = (sums << (n * take)) & full & ~sums
            sums |= fresh
            while fresh:
                low = fresh & -fresh
                first[low.bit_length() - 1] = len(items)
                fresh ^= low
            items.append((i, take))
            count, power = count - take, power * 2
        if sums >> rest & 1:
            break
    at, out = sums.bit_length() - 1, {}
    while at:
        i, take = items[first[at]]
        out[i] = out.get(i, 0) + take
        at -= lengths[i] * take
    return out


def _fit_source(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("size")
    size, target = int(rows["source_size"].iloc[0]), int(rows["target"].iloc[0])
    base = min(target // size, MAX_COPIES) if size else 0
    extra = fit_counts(rows["size"].tolist(), rows["n"].tolist(), target - base * size if base < MAX_COPIES else 0)
    return rows.assign(base=base, extra=extra)[["s", "sn", "size", "n", "source_size", "target", "base", "extra"]]


def plan(rows: DataFrame) -> DataFrame:
    """By source (``s``, ``sn``) and ``size``: documents ``n``, whole copies ``base`` and ``extra`` documents more."""
    lengths = stage(rows.groupBy("s", "sn", "size").agg(F.count(F.lit(1)).alias("n")), "mix-lengths")
    sizes = (lengths.groupBy("s", "sn").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
             .select(F.when(~F.col("sn"), F.col("s")).alias("source"), "source_size"))
    aims = targets(sizes).select(F.coalesce("source", F.lit("")).alias("s"), F.col("source").isNull().alias("sn"),
                                 "source_size", "target")
    return stage(lengths.join(aims, ["s", "sn"]).groupBy("s", "sn").applyInPandas(
        _fit_source, "s string, sn boolean, size long, n long, source_size long, target double, base long, extra long"),
        "mix-plan")


def measured(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``id, th, s, sn, size, h``: key, source and whether it is null, words, and the seeded hash."""
    text = F.col("row.text").cast("string")
    source = F.col("row.source").cast("string")
    return with_key(docs).select(
        "id", "th", F.coalesce(source, F.lit("")).alias("s"), source.isNull().alias("sn"),
        n_words(text).alias("size"), F.xxhash64(F.lit(seed), "id", "th").alias("h"))


def choose(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``id, th, s, sn, size, source_size, target, copies``, a row for each row of ``docs``.

    The ``extra`` documents of a (source, length) are those first by hash. A group may hold much of the table,
    so its ranks are put together from about sqrt(n) hash buckets of about sqrt(n) rows, never in one task.
    Null text has no words, null source is a source of its own; rows equal in doc_id and text tie, and any of
    them may be the ones taken. Columns other than doc_id, text and source play no part. A text of any length counts
    whole, and an empty table gives no row.
    """
    rows = stage(measured(docs, seed), "mix-rows")
    group = ["s", "sn", "size"]
    placed = rows.join(plan(rows), group).withColumn("bucket", F.pmod("h", F.ceil(F.sqrt("n"))).cast("long"))
    cell = Window.partitionBy(*group, "bucket")
    before = Window.partitionBy(*group).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = (placed.groupBy(*group, "bucket").agg(F.count(F.lit(1)).alias("in_cell"))
             .withColumn("offset", F.coalesce(F.sum("in_cell").over(before), F.lit(0))).drop("in_cell"))
    rank = F.row_number().over(cell.orderBy("h")) + F.col("offset")
    return (placed.join(cells, [*group, "bucket"])
            .withColumn("copies", F.col("base") + (rank <= F.col("extra")).cast("long"))
            .select("id", "th", *group, "source_size", "target", "copies"))


def mix(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Documents that the mix takes, with their own columns and ``mix_copies``, how often it takes them.

    Rows equal in doc_id and text share the larger number.
    """
    chosen = stage(choose(docs, seed).filter("copies > 0").groupBy("id", "th").agg(F.max("copies").alias("copies")), "mix")
    name = _free("mix_copies", docs.columns)
    return with_key(docs).join(chosen, ["id", "th"]).select("row.*", F.col("copies").alias(name))


def _free(name: str, taken: list[str]) -> str:
    while name in taken:
        name += "_"
    return name


def source_out() -> Column:
    return F.when(~F.col("sn"), F.col("s"))


__all__ = ["NULL_ID", "choose", "fit_counts", "mix", "plan", "source_out", "targets"]
