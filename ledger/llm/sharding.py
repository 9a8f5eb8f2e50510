"""Shards by extendible hashing.

A shard is a prefix of the document hash.  It starts as the empty prefix; a shard above the byte limit splits on
the next bit, the others stay.  Bytes are summed by 12 hash bits at a time: the sums of all shorter prefixes follow from
those few rows, and only documents under prefixes that are still too large are summed again by 12 further bits.

Defined results: a null text has 0 bytes; a null id hashes by its text; rows with equal ids share a hash and hence
a shard; a shard that holds one hash value only cannot split and stays whole even above the limit
(``oversize``); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger.llm.common import HASH_BITS, cut, free_name, hash60, named

MAX_BYTES = 1 << 20
BITS = 12


def shard_hash(doc_id: Column, text: Column) -> Column:
    return hash60(F.coalesce(doc_id.cast("string"), F.concat(F.lit("t"), text), F.lit("")))


def _bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def _prefix(depth: Column | int) -> Column:
    """The first ``depth`` bits of the hash (Spark shifts by at most 63)."""
    return F.call_function("shiftright", F.col("_hash"), (F.lit(HASH_BITS) - depth).cast("int"))


def _leaves(rows: DataFrame, start: int, limit: int) -> DataFrame:
    """For each prefix of ``start + BITS`` bits: the depth of the shard above it, null where all are too large."""
    end = start + BITS
    leaves = rows.groupBy(_prefix(end).alias("_leaf")).agg(
        F.sum("_bytes").alias("_bytes"), F.count(F.lit(1)).alias("_docs"), F.min("_hash").alias("_low"), F.max("_hash").alias("_high"))
    # Depth 0 is looked at in the first round only; afterwards the start depth is known to be too large.
    depths = F.explode(F.sequence(F.lit(start if start == 0 else start + 1), F.lit(end)))
    nodes = (
        leaves.withColumn("_depth", depths)
        .withColumn("_node", F.call_function("shiftright", F.col("_leaf"), (F.lit(end) - F.col("_depth")).cast("int")))
    )
    sums = nodes.groupBy("_depth", "_node").agg(
        F.sum("_bytes").alias("_bytes"), F.sum("_docs").alias("_docs"), F.min("_low").alias("_low"), F.max("_high").alias("_high"))
    fitting = sums.filter((F.col("_bytes") <= limit) | (F.col("_low") == F.col("_high")))
    own = Window.partitionBy("_leaf").orderBy("_depth")
    found = (
        nodes.select("_leaf", "_depth", "_node").join(fitting, ["_depth", "_node"])
        .withColumn("_rn", F.row_number().over(own)).filter(F.col("_rn") == 1)
        .select("_leaf", "_depth", "_node", F.col("_bytes").alias("_shard_bytes"), F.col("_docs").alias("_shard_docs"))
    )
    return leaves.select("_leaf").join(found, "_leaf", "left")


def _bits(node: Column, depth: Column) -> Column:
    return F.when(depth == 0, F.lit("")).otherwise(F.lpad(F.conv(node.cast("string"), 10, 2), depth, "0"))


def shard_leaves(hashed: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """Tables from hash prefixes to shards, one per 12 bits, as many as needed.

    ``hashed`` has ``_hash`` and ``_bytes``.  A leaf without a depth goes on in the next table.
    """
    found, rows, start = [], hashed, 0
    while True:
        leaves = cut(_leaves(rows, start, limit), "shard-leaves")
        found.append((start + BITS, leaves))
        still = leaves.filter(F.col("_depth").isNull()).select("_leaf")
        if start + BITS >= HASH_BITS or still.isEmpty():
            return found
        rows = rows.join(still, _prefix(start + BITS) == F.col("_leaf"), "left_semi")
        start += BITS


def with_shard(rows: DataFrame, tables: list[tuple[int, DataFrame]]) -> DataFrame:
    """Add ``_shard``, ``_depth``, ``_shard_bytes``, ``_shard_docs`` to rows that have ``_hash``."""
    fields = ["_depth", "_node", "_shard_bytes", "_shard_docs"]
    for i, (end, leaves) in enumerate(tables):
        rows = rows.join(leaves.withColumnsRenamed({c: f"{c}{i}" for c in leaves.columns}), _prefix(end) == F.col(f"_leaf{i}"), "left")
    for f in fields:
        rows = rows.withColumn(f, F.coalesce(*[F.col(f"{f}{i}") for i in range(len(tables))]))
    return rows.withColumn("_shard", _bits(F.col("_node"), F.col("_depth").cast("int")))


def plan_shards(docs: DataFrame, limit: int = MAX_BYTES) -> DataFrame:
    """One row per document: doc_id, n_bytes, shard (its hash prefix in bits), depth, shard_bytes, shard_docs, oversize."""
    hashed = cut(docs.select(
        named("doc_id").alias("_id"), shard_hash(named("doc_id"), named("text")).alias("_hash"),
        _bytes(named("text")).alias("_bytes")), "shard-hashes")
    return with_shard(hashed, shard_leaves(hashed, limit)).select(
        F.col("_id").alias("doc_id"), F.col("_bytes").alias("n_bytes"), F.col("_shard").alias("shard"),
        F.col("_depth").cast("int").alias("depth"), F.col("_shard_bytes").alias("shard_bytes"),
        F.col("_shard_docs").alias("shard_docs"), (F.col("_shard_bytes") > limit).alias("oversize"))


def assign_shards(docs: DataFrame, limit: int = MAX_BYTES) -> DataFrame:
    """The rows of ``docs`` with a further column ``shard`` (underscores added where that name is taken)."""
    name = free_name(docs, "shard")
    kept = {c: f"_llm_c{i}" for i, c in enumerate(docs.columns)}
    small = cut(docs.select(shard_hash(named("doc_id"), named("text")).alias("_hash"), _bytes(named("text")).alias("_bytes")), "shard-hashes")
    tables = shard_leaves(small, limit)
    rows = docs.select(*[named(c).alias(n) for c, n in kept.items()], shard_hash(named("doc_id"), named("text")).alias("_hash"))
    return with_shard(rows, tables).select(*[F.col(n).alias(c) for c, n in kept.items()], F.col("_shard").alias(name))


def directory(shards: DataFrame) -> DataFrame:
    """The directory: every slot of the deepest shard's bits and the shard it points to.

    ``shards`` has one row per shard with ``shard`` and ``depth``.
    """
    depth = shards.agg(F.coalesce(F.max("depth"), F.lit(0))).first()[0]
    low = F.coalesce(F.conv(F.rpad("shard", depth, "0"), 2, 10).cast("long"), F.lit(0).cast("long"))
    width = F.call_function("shiftleft", F.lit(1).cast("long"), (F.lit(depth) - F.col("depth")).cast("int"))
    return shards.select(F.explode(F.sequence(low, low + width - 1)).alias("slot"), "shard", "depth")


def write_shards(docs: DataFrame, path: str, limit: int = MAX_BYTES) -> None:
    """One folder per shard; rows of a shard are brought together first, so it is one file."""
    out = assign_shards(docs, limit)
    name = out.columns[-1]
    out.repartition(F.col(f"`{name}`")).write.partitionBy(name).parquet(path)
