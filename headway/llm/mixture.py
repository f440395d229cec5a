"""Mixing sources to target weights.

Words are summed per source, every source gets a repetition rate, and a document
goes out ``floor(rate)`` times plus once more with the probability of the rest. The
draw is a hash of seed and document, so that reruns agree.

Defined results: a null text has size 0; a null source is a source of its own and
comes last; documents of a source without words go out once. Rows that repeat a
document draw alike. Other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.grouping import stored

WORD = r"[^\x20\x09-\x0D]+"

# The columns added; input columns of these names are replaced.
ADDED = ("mix_source", "mix_size", "mix_source_size", "mix_target", "mix_copies", "mix_copy")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, most: int = 3, weights: tuple[int, ...] = (1, 2, 3)
) -> DataFrame:
    """Targets of (source, source_size), one row per source.

    Sources in order of their code points, null last, take the weights in turn and
    share the sum of all sizes by weight. A target stops at `most` times its source;
    what is too much is shared anew among the others. Ordered by size per weight, the
    full sources are a prefix: a source is full if its limit is at most its share of
    what the sources before it leave. Only this table, a row per source, is ordered.
    """
    ranked = sizes.select(
        "source",
        "source_size",
        (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("place"),
    )
    weight = F.element_at(
        F.array(*(F.lit(w).cast("long") for w in weights)),
        (F.col("place") % len(weights) + 1).cast("int"),
    )
    weighed = ranked.withColumn("weight", weight)
    # Least limit per weight first; products instead of ratios keep it exact.
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    shared = weighed.select(
        "*",
        (F.sum("source_size").over(everything)
         - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("left"),
        (F.sum("weight").over(everything)
         - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("weight_left"),
    )
    full = most * F.col("source_size") * F.col("weight_left") <= F.col("weight") * F.col("left")
    marked = shared.withColumn("full", full)
    open_left = F.min(F.when(~F.col("full"), F.struct("place_by_ratio", "left", "weight_left")))
    numbered = marked.withColumn("place_by_ratio", F.row_number().over(by_ratio))
    with_first = numbered.withColumn("open", open_left.over(everything))
    target = F.when(
        F.col("full"), (most * F.col("source_size")).cast("double")
    ).otherwise(
        (F.col("weight") * F.col("open.left")).cast("double")
        / F.col("open.weight_left").cast("double")
    )
    return with_first.select("source", "source_size", target.alias("target"))


def draw(doc_id: Column, seed: str) -> Column:
    """A number in [0, 2**32) from seed and document."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def mix_sources(
    documents: DataFrame,
    most: int = 3,
    weights: tuple[int, ...] = (1, 2, 3),
    seed: str = "mix",
) -> DataFrame:
    """Documents with `mix_size`, `mix_source_size`, `mix_target` and `mix_copies`.

    Two passes over the documents: one sums sizes per source, the second joins the
    targets. These, one row per source, are written first, so that their size is known when
    the join is planned: below the session's threshold they are broadcast and no text moves;
    beyond it both sides are dealt by source and adaptive execution splits hot ones.
    """
    sized = documents.drop(*ADDED).withColumn("mix_size", word_count(F.col("text")))
    sizes = sized.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    targets = source_targets(sizes, most, weights).select(
        F.col("source").alias("mix_source"),
        F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"),
    )
    targets = stored(targets, "targets")
    joined = sized.join(targets, F.col("source").eqNullSafe(F.col("mix_source")), "left")
    rate = F.when(
        F.col("mix_source_size") > 0, F.col("mix_target") / F.col("mix_source_size")
    ).otherwise(F.lit(1.0))
    rest = rate - F.floor(rate)
    extra = (draw(F.col("doc_id"), seed) < rest * F.lit(float(1 << 32))).cast("long")
    return joined.withColumn("mix_copies", F.floor(rate).cast("long") + extra).drop("mix_source")


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it was drawn."""
    own = [c for c in mixed.columns if c not in ADDED]
    copies = F.explode(F.array_repeat(F.lit(1), F.col("mix_copies").cast("int")))
    return mixed.select(*own, copies.alias("mix_copy")).select(*own)
