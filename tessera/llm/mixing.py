"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A source's target is its share by weight of all sizes, capped at three times its own size; what a
cap cuts off is shared again by weight. The shares that end this way are ``least(3 size, weight x
level)`` for one level, which the sources in the order of ``3 size / weight`` give in one pass. A
source first takes as many complete epochs of all its documents as fit. The rest is a fractional
selection: each document has the key ``-ln(u) / quality`` with ``u`` from a hash of its id, and
documents are taken in the order of their keys until the budget is used; the document at the border
gives its leading words only, so the mix meets its budgets to the word.

The prefix sums need no sort of a whole source: keys are cut into bins of some thousands of
documents, bins are summed, and only the bin that holds a source's border is sorted and summed
document by document. A source that holds a third of all rows is so many bins more.

Cases: null text has size zero; a source of size zero has target zero and takes nothing; a null
source is a source of its own, the last; ties of keys (rows of one id) are ordered by size and
share what the border leaves them in that order; equal rows may take different shares of the
border, the same set of rows each time; a null id has a key as any other; an empty table gives an
empty result; columns beyond those named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import attach, store

CAP = 3
#: Documents in a bin about.
BIN_ROWS = 2000
#: Sampling weight of a document by its quality label; unlabelled ones are between.
QUALITY = {0: 0.5, 1: 2.0}


def size_of(text: Column) -> Column:
    """Number of words of a text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def quality_weights(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, quality_weight) of labelled documents; of several labels the lowest counts."""
    known = labels.where(F.col("quality").isin(*QUALITY) & F.col(key).isNotNull()).groupBy(key).agg(F.min("quality").alias("q"))
    return known.select(key, F.when(F.col("q") == 1, QUALITY[1]).otherwise(QUALITY[0]).alias("quality_weight"))


def sized(docs: DataFrame, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text", source: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, key) without the texts, as a table in the shared folder; ``key`` orders the sampling."""
    attach(docs.sparkSession)
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), size_of(F.col(text)).alias("size"), *carry)
    weight = F.lit(1.0)
    if labels is not None:
        rows = rows.join(quality_weights(labels, key).withColumnRenamed(key, "doc_id"), "doc_id", "left")
        weight = F.coalesce("quality_weight", weight)
    # 52 bits of a hash; one half keeps u inside (0, 1)
    u = (F.conv(F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return store(rows.select("doc_id", "source", "size", (-F.log(u) / weight).alias("key"), *carry), "mixing")


def targets(rows: DataFrame) -> DataFrame:
    """(source, source_size, n, weight, target): a row for each source."""
    by = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row a source
    by = by.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    cap = F.col("source_size") * CAP
    by = by.withColumn("ratio", cap / F.col("weight"))
    every = Window.partitionBy()
    ascending = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = ascending.rowsBetween(Window.unboundedPreceding, -1)
    by = by.withColumns({
        "total": F.sum("source_size").over(every), "weights": F.sum("weight").over(every),
        "place": F.row_number().over(ascending), "capped": F.coalesce(F.sum(cap).over(before), F.lit(0)), "weighed": F.coalesce(F.sum("weight").over(before), F.lit(0)),
    })
    # the level if exactly the sources before this one are capped; the first that it leaves uncapped decides
    level = (F.col("total") - F.col("capped")) / (F.col("weights") - F.col("weighed"))
    by = by.withColumn("level", level)
    fits = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("place", "level"))).over(every)["level"]
    target = F.when(cap.cast("double") <= F.col("weight") * fits, cap.cast("double")).otherwise(F.coalesce(F.col("weight") * fits, cap.cast("double")))
    return by.select("source", "source_size", "n", "weight", target.alias("target"))


def mix(rows: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken, *carry) for the rows of :func:`sized`."""
    by = targets(rows)
    # words to take: complete epochs, and a budget for the fractional selection
    whole = F.when(F.col("source_size") > 0, F.floor(F.round(F.col("target")) / F.col("source_size"))).otherwise(0)
    by = by.withColumn("epochs", whole.cast("long"))
    by = by.withColumn("budget", (F.round("target").cast("long") - F.col("epochs") * F.col("source_size")))
    by = by.withColumn("bins", F.greatest(F.lit(1), F.ceil(F.col("n") / BIN_ROWS)).cast("long"))
    by = store(by, "targets")
    same = rows["source"].eqNullSafe(by["source"])
    # 1 - exp(-key) is even over (0, 1) for weight 1; other weights only make bins uneven
    bin_of = F.least(F.floor((1 - F.exp(-rows["key"])) * F.col("bins")), F.col("bins") - 1).cast("long")
    placed = rows.join(by, same).select("doc_id", rows["source"], "size", "key", "source_size", "target", "epochs", "budget", bin_of.alias("bin"), *carry)
    sums = placed.groupBy("source", "bin").agg(F.sum("size").alias("bin_size"))
    earlier = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sums = store(sums.select("source", "bin", "bin_size", F.coalesce(F.sum("bin_size").over(earlier), F.lit(0)).alias("before")), "bins")
    border = sums.join(by.select(F.col("source").alias("s"), "budget"), F.col("source").eqNullSafe(F.col("s")))
    border = border.where((F.col("before") < F.col("budget")) & (F.col("before") + F.col("bin_size") > F.col("budget")))
    border = border.select(F.col("source").alias("s"), F.col("bin").alias("border"), F.col("before"))
    # sources that take all or nothing of each bin have no border
    last = sums.join(by.select(F.col("source").alias("s2"), "budget"), F.col("source").eqNullSafe(F.col("s2"))).where(F.col("before") + F.col("bin_size") <= F.col("budget")).groupBy("source").agg(F.max("bin").alias("full"))
    marks = by.select("source").join(border, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    last = last.select(F.col("source").alias("s3"), "full")
    marks = marks.join(last, F.col("source").eqNullSafe(F.col("s3")), "left").select(F.col("source").alias("s"), "border", "before", "full")
    dealt = placed.join(store(marks, "borders"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    out = ["doc_id", "source", "size", "source_size", "target", *carry]
    clear = dealt.where(~F.col("bin").eqNullSafe(F.col("border")))
    extra = F.when(F.col("bin") <= F.coalesce("full", F.lit(-1)), F.col("size")).otherwise(0)
    clear = clear.select(*out, (F.col("epochs") * F.col("size") + extra).alias("taken"))
    run = Window.partitionBy("source").orderBy("key", F.col("doc_id").asc_nulls_first(), "size").rowsBetween(Window.unboundedPreceding, -1)
    at = F.col("before") + F.coalesce(F.sum("size").over(run), F.lit(0))
    close = dealt.where(F.col("bin") == F.col("border")).withColumn("at", at)
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("budget") - F.col("at")))
    return clear.unionByName(close.select(*out, (F.col("epochs") * F.col("size") + part).alias("taken")))
