"""Line dedup by a tree of log templates.

A line goes down a tree of fixed depth: by its number of words, then by its leading words, words with a
digit counting as the wildcard. In each leaf the words that most lines share make the template, other places
become wildcards; lines close enough to it belong to it. The rest are grouped again, by recurring words where no
majority is, until no further template covers ``MIN_DOCS`` lines; what is left are templates of their own.
Templates that recur across documents are dropped from all of them.

Copies are not boilerplate: however many copies and near copies of one text there are, they count as one
document, as finding copies of documents is another operator's work. Documents with text of their own all
count and lose what recurs, whatever share of them it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm.common import WORD, id_out, keyed, with_key, words
from riskmart.session import stage

DEPTH = 3
MIN_DOCS = 10
MIN_SIMILAR_PERCENT = 70
WILD = "<*>"


def masked(line: Column) -> Column:
    """Words of the line, those with a digit as the wildcard; lines of fewer than ``DEPTH`` words stay as they are."""
    def wild(w: Column) -> Column:
        return F.when(w.rlike("[0-9]"), F.lit(WILD)).otherwise(w)

    # as the item of an array, the words are found once and used twice
    return F.get(F.transform(F.array(words(line)), lambda ws: F.when(F.size(ws) >= DEPTH, F.transform(ws, wild)).otherwise(ws)), 0)


def _lines(docs: DataFrame) -> DataFrame:
    """``id, th, j, line``: every line, by place."""
    text = F.coalesce("text", F.lit(""))
    return keyed(docs).select("id", "th", F.posexplode(F.split(text, "\n", -1)).alias("j", "line"))


def _leaves(lines: DataFrame) -> DataFrame:
    """Adds ``t`` (masked words), ``leaf`` and ``own``, the hash of the masked line, for lines with a word."""
    rows = lines.filter(F.col("line").rlike(WORD)).withColumn("t", masked(F.col("line")))
    return rows.select("*", F.xxhash64(F.size("t"), F.slice("t", 1, DEPTH)).alias("leaf"), F.xxhash64("t").alias("own"))


def _templates(lines: DataFrame, min_docs: int) -> DataFrame:
    """``leaf, own, template``: the template of each distinct masked line of ``lines`` (``leaf, own, t, n``).

    All groups of a round are worked at once. Where the majority template of a group takes lines, the rest of
    the group comes again; where it takes none, the group is split by a place with recurring words. It ends
    when no group has ``min_docs`` lines left or a place to split at; lines left over are their own templates.
    """
    rest, found = stage(lines.withColumn("g", F.col("leaf")), "line-groups"), []
    while True:
        words_at = rest.select("g", "n", F.posexplode("t").alias("p", "word"))
        counts = words_at.groupBy("g", "p", "word").agg(F.sum("n").alias("n"))
        # the place whose recurring words cover most lines, then that with the fewest words
        recurs = F.col("n") >= min_docs
        places = (counts.groupBy("g", "p").agg(F.max(F.struct("n", "word")).alias("top"), F.sum("n").alias("total"),
                                               F.sum(F.when(recurs, F.col("n"))).alias("covered"), F.count(F.lit(1)).alias("k"))
                  .select("g", "p", F.when(2 * F.col("top.n") > F.col("total"), F.col("top.word")).alias("word"),
                          F.when(F.col("covered").isNotNull() & (F.col("k") > 1),
                                 F.struct("covered", -F.col("k"), -F.col("p"))).alias("cut")))
        shapes = places.groupBy("g").agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "word"))),
                                                     lambda x: x["word"]).alias("template"), (-F.max("cut")["col3"]).alias("cut"))
        same = F.aggregate(F.zip_with("t", "template", lambda a, b: a.eqNullSafe(b).cast("int")), F.lit(0), lambda s, x: s + x)
        judged = rest.join(shapes, "g").select("leaf", "own", "t", "n", "g", "cut",
                                               (100 * same >= MIN_SIMILAR_PERCENT * F.size("t")).alias("fits"))
        judged = stage(judged, "line-judged")
        found.append(judged.filter("fits").select("leaf", "own", F.col("g").alias("template")))
        groups = judged.groupBy("g").agg(F.max("fits").alias("took"), F.sum(F.when(~F.col("fits"), F.col("n"))).alias("left"))
        open_ = judged.filter("NOT fits").join(groups.filter(F.col("left") >= min_docs), "g")
        again = F.xxhash64("g", F.lit("rest"))
        by_word = (open_.filter(~F.col("took") & F.col("cut").isNotNull())
                   .withColumn("word", F.get("t", F.col("cut"))))
        often = by_word.groupBy("g", "word").agg(F.sum("n").alias("m")).filter(F.col("m") >= min_docs)
        split = by_word.join(often, ["g", "word"], "left").select(
            "leaf", "own", "t", "n", F.when(F.col("m").isNotNull(), F.xxhash64("g", "cut", "word")).otherwise(again).alias("g"))
        rest = open_.filter("took").select("leaf", "own", "t", "n", again.alias("g")).unionByName(split)
        lasting = rest.groupBy("g").agg(F.sum("n").alias("m")).filter(F.col("m") >= min_docs).select("g")
        rest = stage(rest.join(lasting, "g"), "line-groups")
        if rest.isEmpty():
            break
    taken = reduce(DataFrame.unionByName, found)
    return (lines.select("leaf", "own").join(taken, ["leaf", "own"], "left")
            .select("leaf", "own", F.coalesce("template", "own").alias("template")))


def recurring(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``id, th, j`` of the lines to drop."""
    leaves = _leaves(_lines(docs))
    often = stage(leaves.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs)
                  .select("leaf"), "line-often")
    rows = stage(leaves.join(often, "leaf").select("id", "th", "j", "leaf", "own", "t"), "line-rows")
    distinct = stage(rows.groupBy("leaf", "own").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("t")), "line-distinct")
    template_of = stage(_templates(distinct, min_docs), "line-templates")
    placed = stage(rows.drop("t").join(template_of, ["leaf", "own"]).select("id", "th", "j", "template"), "line-placed")

    first = stage(placed.select("template", "id", "th").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("docs"))
                  .filter(F.col("docs") >= min_docs), "line-recurring")
    lines = stage(placed.join(first, "template"), "line-candidates")
    text = stage(_texts(docs, lines), "line-texts")
    dropped = stage(lines.join(text, ["id", "th"]).select("template", "text").distinct().groupBy("template")
                    .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_docs).select("template"), "line-dropped")
    return lines.join(dropped, "template").select("id", "th", "j")


def _texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """``id, th, text``: which text a document holds; copies and near copies of one text hold the same.

    ``lines`` are the candidates (``id, th, j, template, docs``). The rarest template of a document stands for
    what it may be a copy of: the templates that more than half of the documents with that template hold. A
    document with no more lines of its own than it lacks of those is a copy, any other a text of its own.
    """
    held = lines.select("id", "th", "template", "docs").distinct()
    rarest = stage(held.groupBy("id", "th").agg(F.min(F.struct("docs", "template")).alias("m"), F.count(F.lit(1)).alias("held"))
                   .select("id", "th", F.col("m.template").alias("rarest"), "m.docs", "held"), "line-rarest")
    marks = rarest.select("rarest", "docs").distinct()
    with_mark = held.select("id", "th", F.col("template").alias("rarest")).join(marks, "rarest")
    common = (with_mark.join(held.select("id", "th", "template"), ["id", "th"]).groupBy("rarest", "template")
              .agg(F.count(F.lit(1)).alias("n"), F.first("docs").alias("docs")).filter(2 * F.col("n") > F.col("docs")))
    common = stage(common.select("rarest", "template"), "line-common")
    whole = common.groupBy("rarest").agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("template").cast("decimal(38,0)")).alias("sum"))
    has = (rarest.select("id", "th", "rarest").join(held.select("id", "th", "template"), ["id", "th"])
           .join(common, ["rarest", "template"]).groupBy("id", "th").agg(F.count(F.lit(1)).alias("has")))
    filled = keyed(docs).select("id", "th", F.size(F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD)))
                                .alias("filled")).distinct()
    taken = lines.groupBy("id", "th").agg(F.count_distinct("j").alias("taken"))
    joined = (rarest.join(has, ["id", "th"]).join(filled, ["id", "th"]).join(taken, ["id", "th"])
              .join(whole, "rarest"))
    copy = F.col("filled") - F.col("taken") <= F.col("size") - F.col("has")
    return joined.select("id", "th", F.when(copy, F.struct(F.col("sum").cast("string").alias("a"), F.col("size").cast("string").alias("b")))
                         .otherwise(F.struct(F.col("id").cast("string").alias("a"), F.concat(F.lit("d"), F.col("th").cast("string")).alias("b")))
                         .alias("text"))


def _edits(docs: DataFrame, min_docs: int) -> DataFrame:
    return stage(recurring(docs, min_docs).groupBy("id", "th").agg(F.collect_set("j").alias("drop")), "line-edits")


def _kept() -> Column:
    """The ``lines`` whose places are not in ``drop``."""
    return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "drop"),
                                    lambda i: F.get("lines", i)), "\n")


def report(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """A row for each document: ``doc_id, n_lines, n_dropped, cleaned`` (null where nothing was dropped from null).

    Null text has no line, empty text one. Lines without a word always stay. Rows equal in doc_id
    and text are one document; columns other than these play no part; an empty table gives an empty result.
    """
    rows = keyed(docs).join(_edits(docs, min_docs), ["id", "th"], "left").withColumn("lines", F.split("text", "\n", -1))
    return rows.select(id_out().alias("doc_id"),
                       F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
                       F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
                       F.when(F.col("drop").isNull(), F.col("text")).otherwise(_kept()).alias("cleaned"))


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """Documents with their own columns and without the recurring lines; ``n_chars``, if there, follows the text."""
    rows = (with_key(docs).join(_edits(docs, min_docs), ["id", "th"], "left")
            .withColumn("lines", F.split(F.col("row.text").cast("string"), "\n", -1)))
    text = F.when(F.col("drop").isNull(), F.col("row.text").cast("string")).otherwise(_kept())
    rows = rows.select("row", "drop", text.alias("cleaned"))
    fields = []
    for c in docs.columns:
        if c == "text":
            fields.append(F.col("cleaned").alias(c))
        elif c == "n_chars":
            fields.append(F.when(F.col("drop").isNull(), F.col(f"row.`{c}`"))
                          .otherwise(F.length("cleaned")).cast(docs.schema[c].dataType).alias(c))
        else:
            fields.append(F.col(f"row.`{c}`").alias(c))
    return rows.select(*fields)
