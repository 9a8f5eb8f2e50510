"""Document fingerprints from spot signatures.

A signature is a common word (the anchor) and the two content words that follow it; a fingerprint is the sorted set of the 32-bit hashes of a text's signatures,
eight hex digits each.  Common words sit in running prose everywhere, so a changed half leaves the signatures of the other half alone.
Texts without a signature (no anchor before two content words) have the hash of their words as their only one; wordless texts have none.

Two fingerprints are as alike as the Jaccard index of their sets.  The search for near copies compares sets only within classes of set length, and with the next
class where the lengths allow the threshold; a signature index of the rarest few signatures finds candidates, and the comparison stops as soon as
too many signatures are missing.

Defined results: null texts are empty; two empty fingerprints are alike by 1, an empty and another by 0; documents with equal ids follow each
other in the order of their hashes, null ids come last; the only document of a table is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import cut, document_key, named
from ledger.llm.simhash import components

CHAIN = 2
THRESHOLD = 0.8
#: Common words of English, German, French and Spanish.
ANCHORS = frozenset("""
a an and are as at be by for from has have he in is it of on or that the this to was were with
das dem den der des die ein eine er es ich im ist mit nicht sich sie und von zu
au aux ce dans de du elle en est et il la le les ne pas plus pour que qui sur un une
al con del el las lo los no para por se su una y
""".split())
_WORD = regex.compile(r"\w+")
OUT_ROWS = 256


def signatures(text: str | None) -> set[int]:
    """The signature set of a text."""
    words = _WORD.findall((text or "").lower())
    spots, content = [], []
    for word in words:
        if word in ANCHORS:
            spots.append((word, len(content)))
        else:
            content.append(word)
    digest, last = xxhash.xxh32_intdigest, len(content) - CHAIN
    found = {digest(f"{anchor} {' '.join(content[at:at + CHAIN])}") for anchor, at in spots if at <= last}
    if not found and words:
        found.add(digest(" ".join(words)))
    return found


def written(found: set[int]) -> str:
    return "".join([f"{s:08x}" for s in sorted(found)])


def likeness(a: set[int], b: set[int]) -> float:
    """Jaccard index."""
    if not a and not b:
        return 1.0
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def alike(a: list[int], b: list[int], threshold: float) -> bool:
    """Whether two sorted sets reach the threshold; stops when the rest cannot."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if len(small) < threshold * len(large):
        return False
    need = threshold * (len(a) + len(b)) / (1 + threshold) - 1e-9
    may_miss, at = len(small) - need, 0
    for value in small:
        at = bisect_left(large, value, at)
        if at == len(large) or large[at] != value:
            may_miss -= 1
            if may_miss < 0:
                return False
    return True


# --- a document, its edited text and its next one ----------------------------------------------------


def _cuts(docs: DataFrame, parts: int) -> list[int]:
    """At most ``parts`` ids of ``docs``, falling, the largest first: each heads a run of about equally many documents."""
    shares = [i / parts for i in range(1, parts + 1)]
    found = docs.agg(F.percentile_approx(named("doc_id"), shares, 20 * parts).alias("cuts"), F.max(named("doc_id")).alias("top")).first()
    return sorted({*(found["cuts"] or []), *([found["top"]] if found["top"] is not None else [])}, reverse=True)


def _placed(docs: DataFrame, cuts: list[int]) -> DataFrame:
    """Rows with the part they belong to, texts compressed.

    The head of a part is sent to the part before it as well, where it is the last document's next one; the head of all goes to the last part.
    """
    rising = cuts[::-1]
    last = max(len(cuts) - 1, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            out: list[tuple] = []
            for doc_id, h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
                packed = press(text.as_py())
                if doc_id is None:
                    out.append((last, 0, doc_id, h, packed))
                    continue
                part = len(rising) - 1 - bisect_left(rising, doc_id)
                out.append((part, 0, doc_id, h, packed))
                if doc_id == cuts[part]:
                    out.append(((part or len(cuts)) - 1, 1, doc_id, h, packed))
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], k) for c, k in enumerate(kinds)], ["part", "ghost", "id", "h", "text"])

    rows = docs.select(named("doc_id").cast("long").alias("_id"), F.xxhash64(named("text")).alias("_h"), F.coalesce(named("text"), F.lit("")).alias("_text"))
    return rows.mapInArrow(run, "part int, ghost int, id bigint, h bigint, text binary")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last half of a document replaced by the first characters of the next one in falling order of ids.
    Documents are dealt into runs of ids, so a run needs one document from outside.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = _cuts(docs, parts)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        first = held = None
        done: list[tuple] = []

        def judged(row: tuple, after: tuple) -> tuple:
            doc_id, text, own = row
            half = len(text) // 2
            edited = text[:len(text) - half] + after[1][:half]
            changed = signatures(edited)
            return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(own), written(changed),
                    likeness(own, changed), likeness(own, after[2]))

        def out() -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            batch = pa.RecordBatch.from_arrays([pa.array([r[c] for r in done], k) for c, k in enumerate(kinds)], names)
            done.clear()
            return batch

        for batch in batches:
            for ghost, doc_id, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if ghost and held is None:
                    continue
                text = expand(packed.as_py()).decode("utf-8", "surrogatepass")
                row = (doc_id, text, signatures(text))
                if held is not None:
                    done.append(judged(held, row))
                held = None if ghost else row
                first = first or row
                if len(done) >= OUT_ROWS:
                    yield out()
        if held is not None:  # a single part without any id
            done.append(judged(held, first))
        if done:
            yield out()

    rows = _placed(docs, cuts).repartitionById(max(len(cuts), 1), F.col("part"))
    rows = rows.sortWithinPartitions("ghost", F.col("id").desc_nulls_last(), "h")
    return rows.select("ghost", "id", "text").mapInArrow(
        run, "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


# --- near copies in a table --------------------------------------------------------------------------


def length_class(size: int, threshold: float = THRESHOLD) -> int:
    """Classes of set length: sets two classes apart can never reach the threshold."""
    edge, number = 1, 0
    while edge <= size:
        edge, number = max(edge + 1, int(edge / threshold) + 1), number + 1
    return number


def near_copies(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its class).

    Equal sets are one entry.  An entry is listed under its rarest signatures, as many as any set that reaches the threshold must share one
    of, in its own length class and the next one.  Inside a list an entry is compared with the members of each class found so far until one
    matches, which joins them: a list gives a spanning forest of its links, not all pairs.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(signatures(t)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([xxhash.xxh64_intdigest(written(set(f))) - (1 << 63) for f in found], pa.int64()),
                 pa.array([length_class(len(f), threshold) for f in found], pa.int32()), pa.array(found, pa.list_(pa.int64()))],
                ["_id", "_key", "_set", "_class", "_signs"])

    kind = dict(docs.dtypes)["doc_id"]
    rows = cut(docs.select(named("doc_id").alias("_id"), document_key(named("doc_id"), named("text")).alias("_key"), named("text").alias("_text")).mapInArrow(
        run, f"_id {kind}, _key bigint, _set bigint, _class int, _signs array<bigint>"), "spots-rows")
    sets = cut(rows.groupBy("_set").agg(F.first("_class").alias("_class"), F.first("_signs").alias("_signs")), "spots-sets")
    signs = sets.select("_set", F.explode("_signs").alias("_sign"))
    often = signs.groupBy("_sign").agg(F.count(F.lit(1)).alias("_often"))
    size = F.size("_signs")
    ranked = (
        signs.join(often, "_sign").groupBy("_set").agg(F.sort_array(F.collect_list(F.struct("_often", "_sign"))).alias("_ranked"))
        .join(sets, "_set").withColumn("_prefix", F.slice("_ranked", 1, size - F.ceil(size * threshold - 1e-9).cast("int") + 1))
    )
    listed = ranked.select("_set", "_class", "_signs", F.explode("_prefix._sign").alias("_sign")).withColumn(
        "_list", F.explode(F.array("_class", F.col("_class") + 1)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, classes = None, []
        for batch in batches:
            links = []
            for sign, number, own, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (sign, number) != key:
                    key, classes = (sign, number), []
                joined, apart = [(own, found)], []
                for members in classes:
                    match = next((name for name, other in members if alike(found, other, threshold)), None)
                    if match is None:
                        apart.append(members)
                    else:
                        links.append((match, own))
                        joined += members
                classes = [*apart, joined]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["_a", "_b"])

    links = cut(listed.repartition("_sign", "_list").sortWithinPartitions("_sign", "_list", "_set").select("_sign", "_list", "_set", "_signs").mapInArrow(
        compare, "_a bigint, _b bigint").distinct(), "spots-links")
    roots = components(links)
    classed = rows.join(roots, F.col("_set") == F.col("_node"), "left").withColumn("_of", F.coalesce("_root", "_set"))
    least = classed.groupBy(F.col("_of").alias("_cls")).agg(F.min("_id").alias("class_id"))
    return classed.join(least, F.col("_of") == F.col("_cls")).select(F.col("_id").alias("doc_id"), "class_id")
