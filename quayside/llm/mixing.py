"""Mixing sources to target weights, in DataFrame functions only.

Sources share the words of the corpus by weight. A source gives its words in the order of a hash of document id and text, over
and over until its target is met. Hash keys are uniform, so their leading digits cut every source into ranges of even
size without sampling; rows that share one key by the thousands, being equal, are cut further by a hash of their places. A range
is ordered by one task, the totals of the ranges are summed along a source, and
a document's running total is that of the ranges before plus that within its range. The document in which a
source's budget ends gives the words up to it.

Defined results: null text has size 0; a null source is a source of its own, after all others; rows with equal
doc_id and text are ordered by their places in the stored table; a corpus without words
has targets of 0; an empty table gives an empty result. Other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.stored import placed, stored
from quayside.session import apply_settings, new_folder

#: Fixed values of the mix: weights in the order of the sources' names, and the most often a source may be read.
WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3

#: Rows that one range of a source holds on average.
RANGE_ROWS = 10_000


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, key (hash-random, from id and text), place, size in words, of a stored table."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(text.cast("binary")))
    return placed(docs, "_place").select(
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.md5(own.cast("binary")).alias("key"),
        F.col("_place").alias("place"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("size"),
    )


def source_targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """source, source_size, rows, target: shares of all words by weight, none above `max_epochs` times its source's size.

    Taking the excess of capped sources and sharing it out again ends with min(cap, rate * weight) for one rate. Sources
    by rising cap / weight are capped up to the first whose cap exceeds what the rest would get.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    everything = Window.partitionBy()  # one row per source
    by_name = everything.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    weighed = totals.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(max_epochs)))
    by_ratio = everything.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    rate = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    rated = weighed.withColumn("rate", rate)
    open_rate = F.max(F.when(F.col("cap") / F.col("weight") > F.col("rate"), F.col("rate"))).over(everything)
    target = F.least("cap", F.coalesce(open_rate * F.col("weight"), F.col("cap")))
    return rated.select("source", "source_size", "rows", target.alias("target"))


def mix_sources(
    docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """One row per document: doc_id, place, source, size, source_size, target, taken (words, repeats counted)."""
    spark = apply_settings(docs.sparkSession)
    folder = new_folder(spark, "mixing")
    sized(stored(docs)).write.parquet(f"{folder}/sized")
    rows = spark.read.parquet(f"{folder}/sized")
    # Hexadecimal digits of the key that cut the whole corpus into ranges; 16 times finer at each digit.
    total, digits = rows.count(), 0
    while total > range_rows * 16**digits:
        digits += 1
    rows = _cut_hot_keys(rows.withColumn("range", F.substring("key", 1, digits) if digits else F.lit("")), range_rows)
    cut = ["source", "range", "part"]
    order = Window.partitionBy(*cut).orderBy("key", "place").rowsBetween(Window.unboundedPreceding, 0)
    along = Window.partitionBy("source").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = (
        rows.groupBy(*cut)
        .agg(F.sum("size").alias("range_size"))
        .select(*cut, F.coalesce(F.sum("range_size").over(along), F.lit(0)).alias("earlier"))
    )
    targets = source_targets(rows, weights, max_epochs).drop("rows")
    summed = rows.withColumn("through", F.sum("size").over(order))
    found = summed.alias("d").join(
        ranges.join(targets, ranges["source"].eqNullSafe(targets["source"]))
        .select(ranges["source"].alias("s"), F.col("range").alias("r"), F.col("part").alias("p"), "earlier", "source_size", "target"),
        F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")) & (F.col("part") == F.col("p")),
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    begun = F.col("earlier") + F.col("through") - F.col("size")
    rest = budget - epochs * F.col("source_size") - begun
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))
    return found.select("doc_id", "place", "source", "size", "source_size", "target", taken.cast("long").alias("taken"))


def _cut_hot_keys(rows: DataFrame, range_rows: int) -> DataFrame:
    """`part` within a row's range: 0, or for rows of a key that alone would fill a range, one of as many parts as they need.

    Such rows are equal but for their place; they come after the other rows of their range.
    """
    counts = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > range_rows)
    hot = counts.select("key", F.ceil(F.col("n") / range_rows).cast("int").alias("parts")).checkpoint()
    if hot.isEmpty():
        return rows.withColumn("part", F.lit(0))
    # In the order of the key, then of the part: the digits of the key keep two hot keys of one range apart.
    part = F.when(F.col("parts").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64("place"), F.col("parts")).cast("int"))
    return rows.join(hot, "key", "left").withColumn("part", part).drop("parts")


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: float = MAX_EPOCHS) -> DataFrame:
    """The rows of `docs`, all columns, as often as the mix takes them; the document at the end of a budget stays whole."""
    docs = stored(docs)
    mix = mix_sources(docs, weights, max_epochs).filter("taken > 0")
    times = mix.select(F.col("place").alias("_mix_place"), F.ceil(F.col("taken") / F.col("size")).cast("int").alias("_mix_times"))
    return (
        placed(docs, "_mix_place")
        .join(times, "_mix_place")
        .withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_times"))))
        .select(*[docs[c] for c in docs.columns])
    )
