"""Find benchmark passages in documents: SimHash of item-sized windows, multi-index blocks, exact verification.

Texts are lower-cased words of letters and digits; a shingle is five words, a text of fewer words is one shingle.  The
similarity of a window and an item is their weighted Jaccard: shingles weigh their number of occurrences.

1. Shingles of documents meet the shingles of the items (in slices of bounded size, each broadcast).  A window that
   reaches the similarity holds most of the item's shingles, so documents that hold fewer drop out here; this
   loses nothing.
2. Around what is left, every window of the item's size gets a 64-bit SimHash of its shingles.
3. Both fingerprints are cut into ``RADIUS + 1`` blocks.  Two that differ in at most ``RADIUS`` bits agree in one
   block, so an equi-join on block and value finds every pair within the radius; the full distance is then taken.
4. The exact weighted Jaccard decides.

At a similarity of 0.8 the expected distance is 10 of 64 bits with a deviation of 3; the radius of 22 lies four deviations
above.  Everything is DataFrame code.

Defined results: null and wordless texts and items match nothing; an item of fewer than five words matches only a whole text of the
same words; windows at a document's ends are cut to it; rows equal in id and text count once; empty tables give an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledger.llm.common import cut, document_key, named

SHINGLE_WORDS = 5
SIMILARITY = 0.8
RADIUS = 22
#: Item shingles in one broadcast slice: 24 bytes each in a hash table, so well below 200 MB.
SLICE_SHINGLES = 1_000_000


def _word_hashes(text: Column) -> Column:
    words = F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1)
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _shingles(words: Column) -> Column:
    """Hashes of the shingles in order; one if there are fewer words, none if there are no words."""
    n = F.size(words)
    many = F.transform(
        F.sequence(F.lit(0), n - SHINGLE_WORDS),
        lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE_WORDS)]))
    return F.when(n >= SHINGLE_WORDS, many).when(n > 0, F.array(F.xxhash64(words))).otherwise(F.array().cast("array<bigint>"))


def _with_shingles(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_w", _word_hashes(F.col("_text"))).withColumn("_sh", _shingles(F.col("_w"))).drop("_w", "_text")


def _lanes(shingle: str) -> list[Column]:
    """Thirty-two sums of two 32-bit lanes each: how often each of the 64 bits is set."""
    def bit(k: int) -> Column:
        return F.shiftrightunsigned(shingle, k).bitwiseAND(1)
    return [F.sum(bit(k).bitwiseOR(F.shiftleft(bit(k + 32), 32))).alias(f"_lane{k}") for k in range(32)]


def _fingerprint(count: str) -> Column:
    bits = []
    for k in range(32):
        for j in range(2):
            n = F.shiftrightunsigned(f"_lane{k}", 32 * j).bitwiseAND(0xFFFFFFFF)
            bits.append(F.shiftleft((n * 2 > F.col(count)).cast("long"), k + 32 * j))
    return reduce(Column.bitwiseOR, bits)


def _simhashes(windows: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``_fp``; ``windows`` has the keys and ``_win``."""
    return (
        windows.select(*keys, F.explode("_win").alias("_s"))
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("_count"), *_lanes("_s"))
        .select(*keys, _fingerprint("_count").alias("_fp"))
    )


def _numbered(shingles: Column) -> Column:
    """Shingles with their occurrence, so that a set of them is the multiset of shingles."""
    return F.transform(shingles, lambda s, i: F.struct(
        s.alias("s"), F.size(F.filter(F.slice(shingles, 1, i), lambda o: o == s)).alias("n")))


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``_item_key``, ``_item``, ``_sh`` and ``_m`` (number of shingles) of items with words."""
    rows = benchmark.select(
        named("item_id").alias("_item"), document_key(named("item_id"), named("text")).alias("_item_key"), named("text").alias("_text"))
    return cut(_with_shingles(rows.dropDuplicates(["_item_key"])).withColumn("_m", F.size("_sh")), "leak-bench").filter(F.col("_m") > 0)


def _least_shared(m: Column) -> Column:
    """Shared shingles below which two runs of ``m`` cannot reach the similarity.

    A window cut at a document's end is shorter; then the union is at least ``m``.
    """
    return F.ceil(m * SIMILARITY - 1e-9)


def _cells(docs: DataFrame, items: DataFrame, slice_shingles: int) -> DataFrame:
    """Places where documents and items share shingles, one row per half an item's length.

    A row has the number of shared places in its cell, the first of them and the shingles around it: all of any
    window of the item's size that holds this place.  They are taken where the document is read, so no text moves.
    """
    shingles = cut(items.select("_item_key", "_m", F.posexplode("_sh").alias("_q", "_s")), "leak-items")
    total = shingles.count()
    slices = max(1, -(-total // slice_shingles))
    # With a shingle, the items that hold it: equal shingles of one item count once here.
    index = shingles.groupBy("_s", "_item_key", "_m").agg(F.count(F.lit(1)).alias("_q"))
    keyed = _with_shingles(docs.select(
        document_key(named("doc_id"), named("text")).alias("_doc_key"), named("doc_id").alias("_id"), named("text").alias("_text")))
    # The outer form: for the inner one Catalyst adds a filter that works out the shingles a second time, word by word.
    positions = keyed.select("_doc_key", "_id", "_sh", F.posexplode_outer("_sh").alias("_p", "_t"))
    start = F.greatest(F.col("_p") - F.col("_m") + 1, F.lit(0))
    around = F.slice("_sh", start + 1, F.least(F.col("_p") + F.col("_m"), F.size("_sh")) - start)
    cell = F.floor(F.col("_p") / F.greatest(F.floor(F.col("_m") / 2), F.lit(1)))
    parts = []
    for i in range(slices):
        part = index if slices == 1 else index.filter(F.pmod(F.xxhash64("_s"), F.lit(slices)) == i)
        parts.append(positions.join(F.broadcast(part), F.col("_t") == F.col("_s")).select(
            "_doc_key", "_id", "_item_key", "_m", cell.alias("_cell"), F.struct("_p", start.alias("_from"), around.alias("_around")).alias("_place")))
    return reduce(DataFrame.union, parts).groupBy("_doc_key", "_id", "_item_key", "_m", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_place"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
               slice_shingles: int = SLICE_SHINGLES) -> DataFrame:
    """One row per document and item it holds: doc_id, item_id, similarity, distance, start_word, _doc_key.

    The window with the highest similarity is given; among equals the closest, then the first.
    """
    if similarity < SIMILARITY:
        raise ValueError(f"the filters are lossless from {SIMILARITY} on")
    items = benchmark_items(benchmark)
    cells = cut(_cells(docs, items, slice_shingles), "leak-cells")
    enough = cells.groupBy("_doc_key", "_item_key", "_m").agg(F.sum("_n").alias("_all")).filter(F.col("_all") >= _least_shared(F.col("_m")))
    # A window that reaches the similarity lacks fewer places than a cell has, so it holds a shared place of each cell
    # it covers, and it covers one: the windows around one place per cell are all that count.
    places = cells.join(enough.select("_doc_key", "_item_key"), ["_doc_key", "_item_key"]).select(
        "_doc_key", "_id", "_item_key", "_m", "_place._p", "_place._from", "_place._around")
    starts = F.explode(F.sequence(F.col("_p") - F.col("_m") + 1, F.col("_p"))).alias("_start")
    windows = (
        places.select("_doc_key", "_id", "_item_key", "_m", "_from", "_around", starts)
        .withColumn("_skip", F.greatest("_start", F.lit(0)) - F.col("_from"))
        .withColumn("_win", F.slice("_around", F.col("_skip") + 1, F.least(F.col("_start") + F.col("_m") - F.col("_from"), F.size("_around")) - F.col("_skip")))
        .filter(F.size("_win") >= _least_shared(F.col("_m")))
        .select("_doc_key", "_id", "_item_key", "_m", "_start", "_win").dropDuplicates(["_doc_key", "_item_key", "_start"])
    )
    # A window is compared with the item whose shingles led to it: other items of its length have windows of their own.
    windows = cut(windows, "leak-windows")
    window_prints = _simhashes(windows, ["_doc_key", "_item_key", "_start"])
    item_prints = _simhashes(items.withColumn("_win", F.col("_sh")), ["_item_key"])
    blocks = radius + 1
    edges = [64 * i // blocks for i in range(blocks + 1)]

    def blocked(prints: DataFrame) -> DataFrame:
        values = [F.shiftrightunsigned("_fp", edges[i]).bitwiseAND((1 << (edges[i + 1] - edges[i])) - 1) for i in range(blocks)]
        return prints.select("*", F.posexplode(F.array(*values)).alias("_block", "_value"))

    theirs = blocked(item_prints).withColumnRenamed("_fp", "_item_fp")
    candidates = (
        blocked(window_prints)
        .join(theirs, ["_item_key", "_block", "_value"])
        .withColumn("_distance", F.bit_count(F.col("_fp").bitwiseXOR(F.col("_item_fp"))))
        .filter(F.col("_distance") <= radius)
        .select("_doc_key", "_item_key", "_start", "_distance").distinct()
    )
    verified = (
        candidates.join(windows, ["_doc_key", "_item_key", "_start"])
        .join(items.select("_item_key", "_item", "_sh"), "_item_key")
        .withColumn("_both", F.size(F.array_intersect(_numbered(F.col("_win")), _numbered(F.col("_sh")))))
        .withColumn("similarity", F.col("_both") / (F.size("_win") + F.col("_m") - F.col("_both")))
        .filter(F.col("similarity") >= similarity)
        .groupBy("_doc_key", "_item_key")
        .agg(F.max(F.struct("similarity", -F.col("_distance"), -F.col("_start"), "_item", "_id")).alias("_best"))
    )
    return verified.select(
        F.col("_best._id").alias("doc_id"), F.col("_best._item").alias("item_id"), F.col("_best.similarity").alias("similarity"),
        (-F.col("_best.col2")).alias("distance"), F.greatest(-F.col("_best.col3"), F.lit(0)).alias("start_word"), "_doc_key")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; all columns kept."""
    leaks = cut(find_leaks(docs, benchmark).select("_doc_key").distinct(), "leak-keys")
    marked = docs.withColumn("_llm_key", document_key(named("doc_id"), named("text")))
    return marked.join(leaks, F.col("_llm_key") == F.col("_doc_key"), "left_anti").select(*[named(c) for c in docs.columns])
