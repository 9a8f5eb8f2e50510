"""Mix sources to target weights by hash thresholds.

Every document hashes to 60 bits.  A source whose target is ``k`` whole copies and a rest takes all its documents
``k`` times and, once more, those whose hash lies below a threshold.  Thresholds come from histograms: words are
summed by source and the first 12 bits, the bucket in which the rest runs out is found, and only that bucket is
summed again by its next 12 bits, until it is one hash value.  Nothing is sorted but the few buckets of a source,
and sums combine inside map tasks, so a source with a third of all rows is no hot group.

Defined results: a null text has size 0; a null source is a source of its own, last in order; rows equal in id and text are taken
alike, rows of one id (or without one) with different texts apart; an empty table gives an empty result; sources without words have target 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger.llm.common import HASH_BITS, cut, hash60, named, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
BITS = 12


def _source_key(source: Column) -> Column:
    """Sources as non-null strings that keep their order, null last."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def _own_hash(doc_id: Column, text: Column) -> Column:
    return hash60(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit("|"), F.coalesce(text, F.lit(""))))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Words each source should give: shares by weight, none above ``cap`` times its size.

    ``totals`` has one row per source.  In the order of cap per weight, the sources that stop at their
    cap come first; the level of the others follows from running sums.
    """
    place = F.row_number().over(Window.orderBy("_key")) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    ceiling = F.col("_source_size") * float(cap)
    before = Window.orderBy("_fill", "_key").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy("_fill", "_key").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    return (
        totals.withColumn("_weight", weight)
        .withColumn("_ceiling", ceiling)
        .withColumn("_fill", F.col("_ceiling") / F.col("_weight"))
        .withColumn("_level", (F.sum("_source_size").over(everything) * share
                               - F.coalesce(F.sum("_ceiling").over(before), F.lit(0.0))) / F.sum("_weight").over(onward))
        .withColumn("_level", F.max(F.when(F.col("_fill") > F.col("_level"), F.col("_level"))).over(everything))
        .withColumn("_target", F.coalesce(F.least(F.col("_weight") * F.col("_level"), F.col("_ceiling")), F.col("_ceiling")))
        .withColumn("_whole", F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(F.lit(0)))
        .withColumn("_rest", F.col("_target") - F.col("_whole") * F.col("_source_size"))
        .select("_key", "_source_size", "_target", "_whole", "_rest")
    )


def _boundary(sized: DataFrame, state: DataFrame, depth: int) -> DataFrame:
    """Narrow each source's boundary bucket from ``depth`` bits to ``BITS`` more."""
    bucket = F.shiftright("_hash", HASH_BITS - depth - BITS)
    inside = sized.join(state.select("_key", "_prefix"), "_key").filter(
        F.shiftright("_hash", HASH_BITS - depth) == F.col("_prefix")
    )
    sums = inside.groupBy("_key", bucket.alias("_bucket")).agg(F.sum("_size").alias("_sum"))
    running = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = Window.partitionBy("_key").orderBy("_bucket")
    return (
        sums.join(state.drop("_prefix", "_sum"), "_key")
        .withColumn("_below", F.col("_below") + F.coalesce(F.sum("_sum").over(running), F.lit(0)))
        .filter(F.col("_below") + F.col("_sum") > F.col("_rest"))
        .withColumn("_rn", F.row_number().over(first))
        .filter(F.col("_rn") == 1)
        .select("_key", "_source_size", "_target", "_whole", "_rest", F.col("_bucket").alias("_prefix"), "_below", "_sum")
    )


def thresholds(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Per source its target, its whole copies and the hash below which documents are taken once more."""
    totals = sized.groupBy("_key").agg(F.sum("_size").alias("_source_size"))
    goals = cut(targets(totals, weights, share, cap), "mix-targets")
    state = goals.filter(F.col("_source_size") > 0).withColumns(
        {"_prefix": F.lit(0).cast("long"), "_below": F.lit(0).cast("long"), "_sum": F.col("_source_size")})
    for depth in range(0, HASH_BITS, BITS):
        state = cut(_boundary(sized, state, depth), "mix-level")
    at = F.when(F.col("_below") + F.col("_sum") / 2 <= F.col("_rest"), F.col("_prefix") + 1).otherwise(F.col("_prefix"))
    return cut(
        goals.join(state.select("_key", at.alias("_threshold")), "_key", "left").fillna(0, ["_threshold"]), "mix-thresholds")


def sized_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Id, source, size and hash of every document, written once for the passes over it."""
    return cut(docs.select(
        named(doc_id).alias("_id"), _source_key(named(source)).alias("_key"), word_count(named(text)).alias("_size"),
        _own_hash(named(doc_id), named(text)).alias("_hash")), "mix-sizes")


def _copies() -> Column:
    return (F.col("_whole") + (F.col("_hash") < F.col("_threshold")).cast("long")).cast("long")


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    sized = sized_documents(docs)
    return sized.join(thresholds(sized, weights, share, cap), "_key").select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * _copies()).alias("taken"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns kept."""
    bounds = thresholds(sized_documents(docs), weights, share, cap).select("_key", "_whole", "_threshold")
    bounds = bounds.withColumnsRenamed({c: f"_llm{c}" for c in bounds.columns})
    mine = _source_key(named("source")) == F.col("_llm_key")
    times = (F.col("_llm_whole") + (_own_hash(named("doc_id"), named("text")) < F.col("_llm_threshold")).cast("long")).cast("int")
    return (
        docs.join(bounds, mine)
        .withColumn("_llm_copy", F.explode(F.array_repeat(F.lit(1), times)))
        .select(*[named(c) for c in docs.columns])
    )
