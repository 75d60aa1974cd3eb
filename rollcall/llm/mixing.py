"""Mixing sources to target weights: whole copies that are certain, the rest by Pareto order sampling.

The sources share a number of words by weight; a target above ``most`` times its source's words stops there and the
excess is shared again. A source whose target is r times its words takes floor(r) copies of every document for certain.
The remaining words come from one more copy of some documents: each draws a random number u, and documents are ranked by
the odds of u divided by the odds of their inclusion probability, the smallest first (Pareto order sampling). A
probability is the same for all documents of a source but the long ones: beyond an eighth of the remaining words it falls
with the length, so that no single document decides what the source gives.

What is fixed is the number of words. Documents are ranked in four classes of length, the long ones first; each class
takes the head of its ranking whose words come nearest to its share, and what it misses is left to the next class. So a
source ends within half of one of its short documents of the target, as far as its documents allow.

Rankings are cut without sorting a source: ranks fall evenly into about sqrt(n) buckets, of which only the words are
summed in order, and only the one bucket in which a share ends is sorted. Everything is DataFrame operations.

Words are runs of anything but ASCII white space. NULL and empty texts have none and are never taken. Sources are
numbered by code point, NULL is a source of its own and the last; a source without words has the target 0. Random numbers
are a digest of seed, source, id, size and, for rows that agree in these, of their number among them: reruns agree
however the rows are dealt out, and repeated rows draw for themselves. Only id, source and size leave the scan, so other
columns, whatever their names, play no part. There is one row of figures per source. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
#: A class of length begins above this part of the remaining words; the last one takes all others.
CLASSES = (8, 64, 512)
#: Highest probability of the copies that are not certain.
LIKELY = 1023 / 1024


def drawn(docs: DataFrame, *, id_column: str, text_column: str, source_column: str, seed: int) -> DataFrame:
    """source, id, size and the random number u (above 0, below 1) of each row."""
    size = F.regexp_count(F.coalesce(F.col(text_column).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
    alike = docs.select(F.col(source_column).cast("string").alias("source"), F.col(id_column).alias("id"), size.alias("size"))
    alike = alike.groupBy("source", "id", "size").agg(F.count("*").alias("rows"))
    each = alike.select("source", "id", "size", F.explode(F.sequence(F.lit(1), "rows")).alias("number"))
    name = F.concat_ws("|", F.lit(seed), F.coalesce(F.col("source"), F.lit("")), F.coalesce(F.col("id").cast("string"), F.lit("")),
                       "size", "number")
    head = F.conv(F.substring(F.md5(name.cast("binary")), 1, 13), 16, 10).cast("double")
    return each.select("source", "id", "size", ((head + 0.5) / F.lit(2.0 ** 52)).alias("u"))


def targets(sizes: DataFrame, weights: Sequence[float] | DataFrame = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, source_size, rows, weight, target: ``sizes`` has source, source_size and rows, one row per source.

    ``weights`` repeat over the sources in order of code point, or are a table of source and weight (0 where it has none).
    """
    if isinstance(weights, DataFrame):
        given = weights.select(F.col("source").alias("_of"), F.col("weight").cast("double").alias("weight"))
        weighed = sizes.join(given, F.col("source").eqNullSafe(F.col("_of")), "left").drop("_of").fillna(0.0, ["weight"])
    else:
        place = F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1
        weighed = sizes.withColumn("weight", F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int")))
    # Sources by what fills them first: the level at which a source stops is its most words over its weight.
    limit = F.col("source_size") * float(most)
    stops = F.when(F.col("weight") > 0, limit / F.col("weight")).otherwise(F.lit(float("inf")))
    order, everywhere = (F.asc("stops"), F.asc_nulls_last("source")), Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    levels = weighed.withColumn("stops", stops)
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy(*order).rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(everywhere) * float(share)
    left = F.sum("weight").over(after)
    level = F.when(left > 0, (total - F.coalesce(F.sum(limit).over(before), F.lit(0.0))) / left).otherwise(F.lit(0.0))
    levels = levels.withColumn("level", level)
    fits = F.min_by(F.when(F.col("level") <= F.col("stops"), F.col("level")), F.when(
        F.col("level") <= F.col("stops"), F.col("stops"))).over(everywhere)
    target = F.least(limit, F.coalesce(fits * F.col("weight"), limit))
    return levels.select("source", "source_size", "rows", "weight", target.alias("target"))


def _same(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _odds(p: Column) -> Column:
    return p / (1 - p)


def _ranked(rows: DataFrame, figures: DataFrame, scratch: Scratch) -> DataFrame:
    """Each row with its class of length, rank and bucket; ``share`` is the share of its class that counts for it."""
    rest = F.col("target") - F.col("copies") * F.col("source_size")
    figures = figures.withColumn("copies", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0))
    figures = figures.withColumn("rest", F.greatest(rest, F.lit(0.0))).withColumn(
        "long", F.greatest(F.ceil(F.col("rest") / CLASSES[0]), F.lit(1)))
    named = figures.withColumnRenamed("source", "_of")
    known = rows.join(named, _same("source", "_of")).drop("_of")
    counts = F.least("size", "long")
    sums = known.groupBy("source").agg(F.sum(counts).alias("counting")).withColumnRenamed("source", "_of")
    ranked = known.join(sums, _same("source", "_of")).drop("_of")
    likely = F.least(F.when(F.col("counting") > 0, F.col("rest") / F.col("counting")).otherwise(0.0), F.lit(LIKELY))
    length = F.lit(len(CLASSES))
    for number, part in reversed(list(enumerate(CLASSES))):
        length = F.when(F.col("size") * part > F.col("rest"), number).otherwise(length)
    ranked = ranked.withColumn("likely", likely).withColumn(
        "length", F.when((F.col("rest") > 0) & (F.col("size") > 0), length).otherwise(-1))
    chance = F.col("likely") * F.least(F.lit(1.0), F.col("long") / F.col("size"))
    # Odds of u over odds of the chance; times the odds of the source, so that ranks of ordinary documents are even.
    rank = _odds(F.col("u")) / _odds(chance)
    ranked = ranked.withColumn("rank", F.when(F.col("length") >= 0, rank))
    even = F.col("rank") * _odds(F.col("likely"))
    buckets = F.ceil(F.sqrt("rows"))
    bucket = F.least(buckets - 1, F.floor(even / (1 + even) * buckets))
    return scratch.store(ranked.select(
        "source", "id", "size", "u", "source_size", "target", "copies", "rest", "counting", "length", "rank",
        bucket.cast("long").alias("bucket"), counts.alias("counts")), "mix-ranked")


def _inside(rows: DataFrame) -> DataFrame:
    """Rows of the buckets in which a share ends, with whether they belong to its head."""
    order = Window.partitionBy("source", "length").orderBy("rank", "u", "size", F.col("id").cast("string"))
    run = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("run", F.col("before") + run).withColumn(
        "chosen", 2 * F.col("run") - F.col("size") < 2 * F.col("budget")).drop("run")


def _cuts(ranked: DataFrame, scratch: Scratch) -> DataFrame:
    """source, length, cut, before, budget: the bucket in which the share of a class ends and the words before it."""
    shares = scratch.store(ranked.where("length >= 0").groupBy("source", "length", "bucket").agg(
        F.sum("size").alias("words"), F.sum("counts").alias("counts"), F.first("rest").alias("rest"),
        F.first("counting").alias("counting")), "mix-buckets")
    order = Window.partitionBy("source").orderBy("bucket")
    run = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    classes = scratch.store(shares.groupBy("source", "length").agg(
        (F.sum("counts") * F.first("rest") / F.first("counting")).alias("share"), F.sum("words").alias("words")), "mix-shares")
    # What the classes so far have missed, by source.
    missed = classes.groupBy("source").agg(F.lit(0.0).alias("missed"))
    found = []
    for length in range(len(CLASSES) + 1):
        own = classes.where(F.col("length") == length).select(F.col("source").alias("_of"), "share", "words")
        state = missed.join(own, _same("source", "_of"), "left").drop("_of").select(
            "source", F.greatest(F.col("missed") + F.coalesce("share", F.lit(0.0)), F.lit(0.0)).alias("budget"),
            F.coalesce("words", F.lit(0)).alias("words"))
        summed = shares.where(F.col("length") == length).select("source", "bucket", F.col("words").alias("_words")).withColumn(
            "run", F.sum("_words").over(run)).withColumnRenamed("source", "_of")
        ends = summed.join(state.select("source", "budget"), _same("source", "_of")).where("run >= budget").groupBy("source").agg(
            F.min_by(F.struct("bucket", (F.col("run") - F.col("_words")).alias("before"), "budget"), "bucket").alias("end"))
        cut = scratch.store(ends.select("source", F.lit(length).alias("length"), F.col("end.bucket").alias("cut"),
                                        F.col("end.before").alias("before"), F.col("end.budget").alias("budget")), "mix-cuts")
        found.append(cut)
        last = ranked.where(F.col("length") == length).join(
            cut.select(F.col("source").alias("_of"), "cut", "before", "budget"), _same("source", "_of") & (F.col("bucket") == F.col("cut")))
        took = _inside(last).groupBy("source").agg(
            F.first("before").alias("before"), F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(0)).alias("inside"))
        # A share that ends in no bucket takes its whole class.
        missed = scratch.store(state.join(took.withColumnRenamed("source", "_of"), _same("source", "_of"), "left").select(
            "source", (F.col("budget") - F.coalesce(F.col("before") + F.col("inside"), F.col("words"))).alias("missed")), "mix-missed")
    cuts = found[0]
    for cut in found[1:]:
        cuts = cuts.union(cut)
    return scratch.store(cuts, "mix-all-cuts")


def mix(
    docs: DataFrame, *, weights: Sequence[float] | DataFrame = WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 1,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
) -> DataFrame:
    """source, id, size, source_size, target, copies, taken for each row: how often and with how many words it is in the mix.

    ``share`` is the size of the mix as a part of all words, ``most`` how often a document may be in it.
    """
    with Scratch(docs.sparkSession) as scratch:
        rows = scratch.store(drawn(docs, id_column=id_column, text_column=text_column, source_column=source_column, seed=seed), "mix-rows")
        sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
        figures = scratch.store(targets(sizes, weights, share, most), "mix-targets")
        ranked = _ranked(rows, figures, scratch)
        cuts = _cuts(ranked, scratch)
        scratch.keep(ranked, cuts)
    ends = cuts.select(F.col("source").alias("_of"), F.col("length").alias("_length"), "cut", "before", "budget")
    placed = ranked.join(ends, _same("source", "_of") & (F.col("length") == F.col("_length")), "left").drop("_of", "_length")
    inside = _inside(placed.where("bucket = cut"))
    outside = placed.where("cut IS NULL OR bucket <> cut").withColumn(
        "chosen", (F.col("length") >= 0) & (F.col("cut").isNull() | (F.col("bucket") < F.col("cut"))))
    copies = F.col("copies") + F.coalesce("chosen", F.lit(False)).cast("long")
    return outside.unionByName(inside).select(
        "source", "id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
