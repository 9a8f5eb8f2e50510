"""SimHash fingerprints and near-duplicate components through pigeonring filtering.

The 64 bits of a fingerprint form a ring of four segments.  If two fingerprints differ in at most three bits,
some segment starts a chain in which the first ``k`` segments differ in at most ``k * 3 / 4`` bits together, for every ``k``:
0, 1, 2 and 3.  So the first segment is equal, and one half of the second is equal too; that pair is
the bucket key, eight for a fingerprint.  Inside a bucket the rest of the chain is checked before the full distance.

Equal fingerprints are one entry, whatever the number of copies.  A bucket above ``BUCKET_ROWS`` entries is cut into chunks, and each pair
of chunks is a group of its own, so no task holds more than two chunks of a bucket.  A group returns a spanning tree of its
links, never all pairs.  Components come from those edges by repeated minimum over neighbours and pointer jumping in Spark.

Defined results: null and wordless texts have fingerprint zero and link like any other; rows with equal ids are vertices of their own
while fingerprints differ, and all take part; a component without any id gets null; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import LOWER, UPPER, cut, document_key, named

SHINGLE_WORDS = 3
RADIUS = 3
SEGMENTS = 4
SEED = 42
BUCKET_ROWS = 1024
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
_CHUNK = 1 << 17


def shingle_hashes(text: str | None, width: int = SHINGLE_WORDS) -> list[int]:
    """XXH64 of each shingle; one of the whole sequence if it has fewer words; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return []
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    if len(words) <= width:
        return [digest(line, SEED)]
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-width]))
    return [digest(line[a:b], SEED) for a, b in zip(starts.tolist(), (ends[width - 1:] - 1).tolist(), strict=True)]


def majority_bits(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One fingerprint per run of ``sizes`` hashes: bits set in over half of the run; 0 for empty runs."""
    out = np.zeros(len(sizes), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        counts = np.add.reduceat(bits, at, axis=0, dtype=np.int32)
        out[full] = np.packbits(counts * 2 > sizes[full, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def _long_majority(hashes: np.ndarray) -> np.uint64:
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = np.ascontiguousarray(hashes[i:i + _CHUNK])
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0]


def simhash_texts(texts: list[str | None], width: int = SHINGLE_WORDS) -> np.ndarray:
    """Fingerprints of texts, in slices of bounded size."""
    out, pending, sizes = [], [], []

    def flush() -> None:
        if sizes:
            out.append(majority_bits(np.array(pending, np.uint64), np.array(sizes)))
            pending.clear()
            sizes.clear()

    for text in texts:
        hashes = shingle_hashes(text, width)
        if len(hashes) > _CHUNK:
            flush()
            out.append(np.array([_long_majority(np.array(hashes, np.uint64))], np.uint64))
            continue
        pending += hashes
        sizes.append(len(hashes))
        if len(pending) > _CHUNK:
            flush()
    flush()
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, width: int = SHINGLE_WORDS) -> DataFrame:
    """``_id``, ``_key`` (of id and text) and ``_fp`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = simhash_texts(batch.column(2).to_pylist(), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints.view(np.int64))], ["_id", "_key", "_fp"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select(named("doc_id").alias("_id"), document_key(named("doc_id"), named("text")).alias("_key"), named("text").alias("_text"))
    return rows.mapInArrow(run, f"_id {kind}, _key bigint, _fp bigint")


def _bucket_keys(prints: DataFrame) -> DataFrame:
    """``_bucket`` and ``_fp``: eight rows per fingerprint."""
    width = 64 // SEGMENTS
    half = width // 2
    keys = []
    for i in range(SEGMENTS):
        first = F.shiftrightunsigned("_fp", i * width).bitwiseAND((1 << width) - 1)
        second = F.shiftrightunsigned("_fp", (i + 1) % SEGMENTS * width).bitwiseAND((1 << width) - 1)
        for j in range(2):
            part = F.shiftrightunsigned(second, j * half).bitwiseAND((1 << half) - 1)
            place = (2 * i + j) << (width + half)
            keys.append(F.lit(place).bitwiseOR(F.shiftleft(first, half)).bitwiseOR(part))
    return prints.select(F.explode(F.array(*keys)).alias("_bucket"), "_fp")


def chain_holds(difference: np.ndarray, start: int) -> np.ndarray:
    """Whether the chain of segments from ``start`` stays within its budgets."""
    width = 64 // SEGMENTS
    ok, total = np.ones(difference.shape, bool), np.zeros(difference.shape, np.int64)
    for k in range(SEGMENTS):
        shift = np.uint64((start + k) % SEGMENTS * width)
        total += np.bitwise_count((difference >> shift) & np.uint64((1 << width) - 1))
        ok &= total <= (k + 1) * RADIUS // SEGMENTS
    return ok


def tree_links(prints: np.ndarray, start: int, chunk: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among ``prints``.

    ``chunk`` tells two chunks apart; only links between them are looked at then, those within one belong to another group.
    """
    links, left = [], np.arange(len(prints))
    while len(left) > 1:
        frontier, left = [int(left[0])], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            difference = prints[left] ^ prints[at]
            near = chain_holds(difference, start)
            if chunk is not None:
                near &= chunk[left] != chunk[at]
            for other in left[near].tolist():
                links.append((at, other))
                frontier.append(other)
            left = left[~near]
    return links


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each run of equal (bucket, a, b); rows come sorted, runs may cross batches."""
    kept: list[np.ndarray] = []

    def work(rows: np.ndarray) -> pa.RecordBatch:
        new = np.flatnonzero(np.any(rows[1:, :3] != rows[:-1, :3], axis=1)) + 1
        starts, ends = np.concatenate(([0], new)), np.concatenate((new, [len(rows)]))
        found: list[tuple[int, int]] = []
        for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist(), strict=True):
            bucket, low, high = rows[a, :3]
            prints = np.ascontiguousarray(rows[a:b, 4]).view(np.uint64)
            chunk = rows[a:b, 3] if low != high else None
            start = int(bucket) >> (64 // SEGMENTS * 3 // 2) >> 1
            found += [(int(rows[a + x, 4]), int(rows[a + y, 4])) for x, y in tree_links(prints, start, chunk)]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["_a", "_b"])

    for batch in batches:
        rows = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]).astype(np.int64)
        if not len(rows):
            continue
        if kept:
            rows = np.concatenate([*kept, rows])
        last = np.flatnonzero(np.any(rows[:, :3] != rows[-1, :3], axis=1))
        edge = int(last[-1]) + 1 if len(last) else 0
        if edge:
            yield work(rows[:edge])
        kept = [rows[edge:]]
    if kept:
        yield work(kept[0])


def near_links(prints: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``_a``, ``_b``: links that connect all fingerprints (distinct ``_fp``) within the radius."""
    keys = _bucket_keys(prints)
    large = cut(keys.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > bucket_rows), "simhash-large")
    chunks = F.ceil(F.col("_n") / bucket_rows).cast("int")
    own = F.pmod(F.xxhash64("_fp"), chunks).cast("int")
    # Chunk c meets every chunk, itself included: the pairs (min, max).
    pairs = F.when(F.col("_n").isNull(), F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high")))).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("_chunks") - 1),
                    lambda i: F.struct(F.least(i, "_chunk").alias("low"), F.greatest(i, "_chunk").alias("high"))))
    rows = (
        keys.join(large, "_bucket", "left")
        .withColumns({"_chunks": chunks, "_chunk": F.coalesce(own, F.lit(0))})
        .select("_bucket", F.explode(pairs).alias("_pair"), "_chunk", "_fp")
        .select("_bucket", F.col("_pair.low").alias("_low"), F.col("_pair.high").alias("_high"), "_chunk", "_fp")
    )
    return (
        rows.repartition("_bucket", "_low", "_high").sortWithinPartitions("_bucket", "_low", "_high")
        .mapInArrow(_group_links, "_a bigint, _b bigint").distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """``_node`` and ``_root``, the smallest node of its component, for every node of ``links``.

    Each round takes the smallest label among neighbours and then the label of that label, so labels travel
    at least twice as far in each round.  Every round is a written table.
    """
    edges = cut(links.select("_a", "_b").union(links.select("_b", "_a")).distinct(), "component-edges")
    labels = cut(edges.groupBy(F.col("_a").alias("_node")).agg(F.least(F.col("_node"), F.min("_b")).alias("_root")), "component-labels")
    while True:
        told = edges.join(labels, F.col("_b") == F.col("_node")).groupBy("_a").agg(F.min("_root").alias("_near"))
        nearer = labels.join(told, F.col("_node") == F.col("_a")).select(
            "_node", F.least("_root", "_near").alias("_new"), F.col("_root").alias("_old"))
        nearer = cut(nearer, "component-step")
        jump = nearer.select(F.col("_node").alias("_hop"), F.col("_new").alias("_further"))
        jumped = nearer.join(jump, F.col("_new") == F.col("_hop"), "left").select(
            "_node", F.least("_new", "_further").alias("_root"), "_old")
        jumped = cut(jumped, "component-labels")
        labels = jumped.select("_node", "_root")
        if jumped.filter(F.col("_root") != F.col("_old")).isEmpty():
            return labels


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``_id``, ``_key``, ``_fp``, ``_root`` (the fingerprint that names the component) and ``_component`` (the smallest id reachable) of every row."""
    rows = cut(fingerprints(docs), "simhash-rows")
    entries = cut(rows.groupBy("_fp").agg(F.min("_id").alias("_least")), "simhash-entries")
    roots = components(near_links(entries.select("_fp")))
    entries = entries.join(roots, F.col("_fp") == F.col("_node"), "left").select(
        "_fp", "_least", F.coalesce("_root", "_fp").alias("_root"))
    least = entries.groupBy(F.col("_root").alias("_of")).agg(F.min("_least").alias("_component"))
    entries = entries.join(least, F.col("_root") == F.col("_of")).select(F.col("_fp").alias("_print"), "_root", "_component")
    return rows.join(entries, F.col("_fp") == F.col("_print")).select("_id", "_key", "_fp", "_root", "_component")


def simhash_components(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id."""
    return near_duplicates(docs).select(
        F.col("_id").alias("doc_id"), F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_component").alias("component_id"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One row of each component, that of its smallest id (among equal ids, the smallest key); all columns kept.

    A component without ids keeps the row with the smallest key.  Repeated rows count as copies.  Components that share their smallest id, or
    have none, each keep a row.  Of rows equal in id and text the one whose other columns come first as JSON stays.
    """
    rows = near_duplicates(docs)
    first = rows.groupBy("_root").agg(
        F.min(F.when(F.col("_id").eqNullSafe(F.col("_component")), F.col("_key"))).alias("_llm_keep"))
    first = cut(first.select("_llm_keep"), "simhash-kept")
    marked = docs.withColumn("_llm_key", document_key(named("doc_id"), named("text")))
    held = marked.join(first, F.col("_llm_key") == F.col("_llm_keep"), "left_semi")
    fields = [named(c) for c in docs.columns]
    other = [named(c) for c in docs.columns if c != "text"]
    one = held.groupBy("_llm_key").agg(F.min_by(F.struct(*fields), F.to_json(F.struct(*other))).alias("_llm_row"))
    return one.select(*[F.col("_llm_row").getField(c).alias(c) for c in docs.columns])
