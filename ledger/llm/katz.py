"""Katz backoff language model over words, trained and applied to whole tables.

*Model.*  Words and an end mark, order two.  ``P(w | h) = d(c) c(h, w) / (c(h) + 1)`` for pairs seen in training, else ``a(h) P(w)``; ``P(w) = d(c) c(w) / (N + 1)`` for known words,
else the rest, ``P(unknown)``.  ``d`` are Good-Turing discounts for counts up to ``K`` (1 where the counts of counts allow none).  The one added to the
denominators keeps mass for the unseen even where no count is discounted.  ``a(h)`` is the mass left at ``h`` over the mass of ``P`` outside the
words seen after ``h``, so every distribution sums to one.  A history without training counts passes on to ``P`` alone.

*Data flow.*  A table of 10^14 bytes has neither a vocabulary nor a pair table that fits anywhere, so counts are looked up by exchange:

1. Documents become batches of about ``BATCH_TOKENS`` tokens (written once): the distinct word hashes, and tokens as numbers into them.
2. Each batch asks for its words, split by hash range; a bucket adds up the batches, numbers the words and answers every batch
   with numbers and counts, in the order asked.  A word is asked for once a batch, however frequent.
3. With those, each batch asks for its distinct pairs, split by the first word (a frequent one is split further by the second).  The
   bucket adds up, answers with the pair counts and writes, for first words that some batch asks for in vain, what their ``a(h)`` needs.
4. Each batch evaluates its documents token by token from the answers; pairs never seen join the written backoff table.

All exchanged arrays are packed bytes, a row per batch and bucket, so hot words and hot pairs are single entries and no group is larger
than a bucket.  Numbers of buckets follow from the table's totals.

Words are known by their 64-bit XXH64; two words of one corpus share a hash with a chance of about V^2 / 2^65 for V words (10^-6 for 10 million).

Defined results: a null or empty text is the end alone; a null id counts as the text '' for the fold; repeated rows are documents of their own; without
training tokens the base is that of N = V = 0 and the score that of the unknown word; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import LOWER, UPPER, cut, named

FOLDS, HELD_OUT = 7, 2
K = 5
BATCH_TOKENS = 1 << 21
BUCKET_ENTRIES = 1 << 20
SEED = 42
_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: No word is empty and none holds a blank, so these stand for the end and for what precedes a text.
END = xxhash.xxh64_intdigest(b"", SEED)


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD_OUT


# --- packed arrays -----------------------------------------------------------------------------------


def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes of the smallest width, compressed."""
    top = int(values.max()) if len(values) else 0
    width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    planes = np.ascontiguousarray(values.astype(f"<u{width}")).view(np.uint8).reshape(-1, width).T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes, kind: type = np.int64) -> np.ndarray:
    width = blob[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(kind)


def _batch(names: list[str], *columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), names)


# --- Good-Turing -------------------------------------------------------------------------------------


def discounts(counts_of_counts: list[int]) -> list[float]:
    """Factors for counts 1 to K from the numbers of entries with counts 1 to K + 1."""
    n = [0, *counts_of_counts]
    common = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    factors = []
    for r in range(1, K + 1):
        better = (r + 1) * n[r + 1] / n[r] / r if n[r] else 0.0
        factor = (better - common) / (1 - common) if common < 1 else 0.0
        factors.append(factor if 0 < factor <= 1 else 1.0)
    return factors


def _discounted(counts: np.ndarray, factors: list[float]) -> np.ndarray:
    table = np.ones(K + 2)
    table[1:K + 1] = factors
    return table[np.minimum(counts, K + 1)] * counts


class Unigrams:
    """P of words by their training count."""

    def __init__(self, total: int, distinct: int, counts_of_counts: list[int]) -> None:
        self.total, self.distinct = total, distinct
        self.factors = discounts(counts_of_counts)
        kept = sum((1 - d) * r * n for r, (d, n) in enumerate(zip(self.factors, counts_of_counts, strict=False), 1))
        self.unknown = (1 + kept) / (total + 1)

    def p(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, _discounted(counts, self.factors) / (self.total + 1), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.total + self.distinct + 1))


# --- 1. batches of tokens ----------------------------------------------------------------------------


def token_batches(docs: DataFrame, batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """A row per batch: its documents, its distinct word hashes, its tokens and the training counts of its words."""
    kind = dict(docs.dtypes)["doc_id"]
    names = ["batch", "doc_ids", "held", "lengths", "words", "tokens", "seen", "n_words", "n_tokens", "n_train_docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        digest, ids, held, lengths, hashes, size = xxhash.xxh64_intdigest, [], [], [], [], 0
        for batch in batches:
            id_type = batch.column(0).type
            for i, text in enumerate(batch.column(2).cast(pa.binary())):
                found = [digest(w, SEED) for w in text.as_py().translate(_LOWER).split()]
                found.append(END)
                hashes.append(np.array(found, np.uint64))
                ids.append(batch.column(0)[i].as_py())
                held.append(batch.column(1)[i].as_py())
                lengths.append(len(found))
                size += len(found)
                if size >= batch_tokens:
                    yield packed(number, id_type, ids, held, lengths, hashes)
                    number += 1
                    ids, held, lengths, hashes, size = [], [], [], [], 0
        if ids:
            yield packed(number, id_type, ids, held, lengths, hashes)

    def packed(number: int, id_type: pa.DataType, ids: list, held: list, lengths: list, hashes: list) -> pa.RecordBatch:
        words, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
        train = np.repeat(~np.array(held), lengths)
        seen = np.bincount(tokens[train], minlength=len(words))
        return _batch(
            names, pa.array([number]), pa.array([ids], pa.list_(id_type)), pa.array([pack(np.array(held))], pa.binary()),
            pa.array([pack(np.array(lengths))], pa.binary()), pa.array([words.tobytes()], pa.binary()), pa.array([pack(tokens)], pa.binary()),
            pa.array([pack(seen)], pa.binary()), pa.array([len(words)]), pa.array([int(sum(lengths))]), pa.array([held.count(False)]))

    rows = docs.select(named("doc_id").alias("_id"), held_out(named("doc_id")).alias("_held"), F.coalesce(named("text"), F.lit("")).alias("_text"))
    return rows.mapInArrow(run, f"batch bigint, doc_ids array<{kind}>, held binary, lengths binary, words binary, tokens binary, seen binary, "
                                "n_words bigint, n_tokens bigint, n_train_docs bigint")


# --- 2. words ----------------------------------------------------------------------------------------


def _word_requests(batches: DataFrame, buckets: int) -> DataFrame:
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = -(-(1 << 64) // buckets)
        for batch in rows:
            for i in range(batch.num_rows):
                words, seen = np.frombuffer(batch.column(1)[i].as_py(), np.uint64), unpack(batch.column(2)[i].as_py())
                edges = np.searchsorted(words, np.array([min(b * step, (1 << 64) - 1) for b in range(1, buckets)], np.uint64))
                edges = [0, *edges.tolist(), len(words)]
                used = [b for b in range(buckets) if edges[b] < edges[b + 1]]
                yield _batch(
                    ["bucket", "batch", "words", "seen"], pa.array(used, pa.int32()), pa.array([batch.column(0)[i].as_py()] * len(used), pa.int64()),
                    pa.array([words[edges[b]:edges[b + 1]].tobytes() for b in used], pa.binary()),
                    pa.array([pack(seen[edges[b]:edges[b + 1]]) for b in used], pa.binary()))

    return batches.select("batch", "words", "seen").mapInArrow(run, "bucket int, batch bigint, words binary, seen binary")


def _histogram(counts: np.ndarray) -> list[int]:
    return np.bincount(counts[(counts > 0) & (counts <= K + 1)], minlength=K + 2)[1:].tolist()


def _word_answers(requests: DataFrame, buckets: int) -> DataFrame:
    names = ["batch", "kind", "bucket", "numbers", "counts", "total", "distinct", "often"]

    def run(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        asked = [np.frombuffer(w.as_py(), np.uint64) for w in group["words"]]
        seen = np.concatenate([unpack(s.as_py()) for s in group["seen"]])
        known, place = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(place, seen, len(known)).astype(np.int64)
        numbers = np.arange(len(known)) * buckets + bucket
        ends = np.cumsum([len(a) for a in asked])
        parts = np.split(place, ends[:-1])
        n = len(parts)
        first = [1] + [0] * (n - 1)
        return pa.table([
            group["batch"].combine_chunks(), pa.array([0] * n, pa.int32()), pa.array([bucket] * n, pa.int32()),
            pa.array([pack(numbers[p]) for p in parts], pa.binary()), pa.array([pack(counts[p]) for p in parts], pa.binary()),
            pa.array([int(counts.sum()) * f for f in first], pa.int64()), pa.array([int((counts > 0).sum()) * f for f in first], pa.int64()),
            pa.array([_histogram(counts) if f else [0] * (K + 1) for f in first], pa.list_(pa.int64()))], names=names)

    return requests.groupBy("bucket").applyInArrow(
        run, "batch bigint, kind int, bucket int, numbers binary, counts binary, total bigint, distinct bigint, often array<bigint>")


# --- 3. pairs ----------------------------------------------------------------------------------------


class Batch:
    """One batch with the answers about its words: tokens, histories and their numbers and counts."""

    def __init__(self, row: pa.Table, answers: pa.Table, train_docs: int) -> None:
        self.number = row["batch"][0].as_py()
        self.ids = row["doc_ids"].combine_chunks().values
        self.lengths = unpack(row["lengths"][0].as_py())
        self.held = unpack(row["held"][0].as_py()).astype(bool)
        tokens = unpack(row["tokens"][0].as_py())
        words = answers.filter(pc.equal(answers["kind"], 0)).sort_by("bucket")
        numbers = np.concatenate([unpack(b.as_py()) for b in words["numbers"]])
        counts = np.concatenate([unpack(b.as_py()) for b in words["counts"]])
        # One further entry stands for what precedes a text.
        self.numbers = np.append(numbers + 1, 0)
        self.counts = np.append(counts, train_docs)
        self.size = len(self.numbers)
        starts = np.cumsum(self.lengths) - self.lengths
        self.tokens = tokens
        history = np.empty_like(tokens)
        history[1:] = tokens[:-1]
        history[starts] = self.size - 1
        self.doc = np.repeat(np.arange(len(self.lengths)), self.lengths)
        self.pairs, self.pair_of = np.unique(history.astype(np.uint64) * np.uint64(self.size) + tokens.astype(np.uint64), return_inverse=True)
        self.first = (self.pairs // np.uint64(self.size)).astype(np.int64)
        self.second = (self.pairs % np.uint64(self.size)).astype(np.int64)

    def asked(self, buckets: int, hot: int) -> tuple[np.ndarray, np.ndarray]:
        """The pairs to ask for (their history has training counts), ordered by bucket, and the bucket edges."""
        h, w = self.numbers[self.first].astype(np.uint64), self.numbers[self.second].astype(np.uint64)
        splits = (self.counts[self.first] // hot + 1).astype(np.uint64)
        mixed = _mix(h + _mix(_mix(w) % splits))
        bucket = (mixed % np.uint64(buckets)).astype(np.int64)
        bucket[self.counts[self.first] == 0] = buckets
        order = np.argsort(bucket, kind="stable")
        return order, np.searchsorted(bucket[order], np.arange(buckets + 1))


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread numbers over 64 bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of runs of equal values."""
    starts = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    return starts, np.diff(np.append(starts, len(values)))


_ANSWERS = "batch bigint, kind int, bucket int, numbers binary, counts binary"
_BATCH_FIELDS = ["batch", "doc_ids", "held", "lengths", "tokens"]


def _by_batch(batches: DataFrame, answers: DataFrame, work: Callable, schema: str) -> DataFrame:
    left = batches.select(*_BATCH_FIELDS).groupBy("batch")
    return left.cogroup(answers.groupBy("batch")).applyInArrow(work, schema)


def _pair_requests(batches: DataFrame, words: DataFrame, buckets: int, hot: int, train_docs: int) -> DataFrame:
    names = ["bucket", "batch", "first", "runs", "history", "second", "seen", "known"]

    def run(row: pa.Table, answers: pa.Table) -> pa.Table:
        b = Batch(row, answers, train_docs)
        seen = np.bincount(b.pair_of[~b.held[b.doc]], minlength=len(b.pairs))
        order, edges = b.asked(buckets, hot)
        out = []
        for i in np.flatnonzero(np.diff(edges)).tolist():
            at = order[edges[i]:edges[i + 1]]
            starts, runs = _runs(b.first[at])
            heads, tails = b.first[at[starts]], b.second[at]
            out.append((i, b.number, pack(b.numbers[heads]), pack(runs), pack(b.counts[heads]), pack(b.numbers[tails]), pack(seen[at]), pack(b.counts[tails])))
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 6]
        return pa.table([pa.array([r[c] for r in out], k) for c, k in enumerate(kinds)], names=names)

    return _by_batch(batches, words.select("batch", "kind", "bucket", "numbers", "counts"), run,
                     "bucket int, batch bigint, first binary, runs binary, history binary, second binary, seen binary, known binary")


def _pair_answers(requests: DataFrame, unigrams: Unigrams, hot: int) -> DataFrame:
    """Kinds of rows: 1 counts for a batch, 2 what the backoff weight of a history needs, 3 counts of counts."""
    schema = (f"{_ANSWERS}, history bigint, total bigint, few array<bigint>, mass double")

    def run(group: pa.Table) -> pa.Table:
        bucket = group["bucket"][0].as_py()
        first, history, second, seen, known, sizes = [], [], [], [], [], []
        for i in range(group.num_rows):
            runs = unpack(group["runs"][i].as_py())
            first.append(np.repeat(unpack(group["first"][i].as_py()), runs))
            history.append(np.repeat(unpack(group["history"][i].as_py()), runs))
            second.append(unpack(group["second"][i].as_py()))
            seen.append(unpack(group["seen"][i].as_py()))
            known.append(unpack(group["known"][i].as_py()))
            sizes.append(len(second[-1]))
        first, history, second, seen, known = map(np.concatenate, (first, history, second, seen, known))
        heads, head = np.unique(first, return_inverse=True)
        tails, tail = np.unique(second, return_inverse=True)
        pairs, at, place = np.unique(head.astype(np.uint64) * np.uint64(len(tails)) + tail.astype(np.uint64), return_index=True, return_inverse=True)
        counts = np.bincount(place, seen, len(pairs)).astype(np.int64)
        pair_head, pair_known = head[at], known[at]
        totals = np.zeros(len(heads), np.int64)
        totals[head] = history
        # Histories with a pair asked for in vain; split ones always, as other parts may have one.
        wanted = np.flatnonzero((np.bincount(pair_head, counts == 0, len(heads)) > 0) | (totals >= hot))
        few = np.column_stack([np.bincount(pair_head, counts == r, len(heads)) for r in range(1, K + 1)]).astype(np.int64)
        mass = np.bincount(pair_head, np.where(counts > 0, unigrams.p(pair_known), 0.0), len(heads))
        parts = np.split(counts[place], np.cumsum(sizes)[:-1])
        n, m = len(parts), len(wanted)
        blank, none = pa.nulls(m + 1, pa.binary()), pa.nulls(n, pa.int64())
        return pa.table([
            pa.concat_arrays([group["batch"].combine_chunks(), pa.array([-1] * (m + 1), pa.int64())]),
            pa.array([1] * n + [2] * m + [3], pa.int32()), pa.array([bucket] * (n + m + 1), pa.int32()), pa.nulls(n + m + 1, pa.binary()),
            pa.concat_arrays([pa.array([pack(p) for p in parts], pa.binary()), blank]),
            pa.concat_arrays([none, pa.array(heads[wanted]), pa.nulls(1, pa.int64())]),
            pa.concat_arrays([none, pa.array(totals[wanted]), pa.nulls(1, pa.int64())]),
            pa.array([None] * n + few[wanted].tolist() + [_histogram(counts)], pa.list_(pa.int64())),
            pa.concat_arrays([pa.nulls(n, pa.float64()), pa.array(mass[wanted]), pa.nulls(1, pa.float64())]),
        ], names=["batch", "kind", "bucket", "numbers", "counts", "history", "total", "few", "mass"])

    return requests.groupBy("bucket").applyInArrow(run, schema)


def backoff_weights(pair_answers: DataFrame, factors: list[float]) -> DataFrame:
    """``history`` and ``log_a``: the decimal logarithm of its backoff weight."""
    rows = pair_answers.filter(F.col("kind") == 2)
    kept = sum((F.lit((1 - d) * r) * F.get("few", F.lit(r - 1)) for r, d in enumerate(factors, 1)), F.lit(0.0))
    sums = rows.groupBy("history").agg(F.max("total").alias("total"), F.sum(kept).alias("kept"), F.sum("mass").alias("mass"))
    return sums.select("history", (F.log10((F.col("kept") + 1) / (F.col("total") + 1)) - F.log10(1 - F.col("mass"))).alias("log_a"))


# --- 4. scores ---------------------------------------------------------------------------------------


def _evaluated(batches: DataFrame, answers: DataFrame, unigrams: Unigrams, factors: list[float], buckets: int, hot: int, train_docs: int, kind: str) -> DataFrame:
    """Kinds of rows: 0 a document with what is known of its score, 1 tokens of a document that back off from a history."""
    schema = f"kind int, batch bigint, place int, doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, history bigint, n bigint"

    def run(row: pa.Table, told: pa.Table) -> pa.Table:
        b = Batch(row, told, train_docs)
        pairs = told.filter(pc.equal(told["kind"], 1)).sort_by("bucket")
        order, edges = b.asked(buckets, hot)
        counts = np.zeros(len(b.pairs), np.int64)
        if pairs.num_rows:
            counts[order[:edges[-1]]] = np.concatenate([unpack(c.as_py()) for c in pairs["counts"]])
        docs = len(b.lengths)
        word_counts = b.counts[b.tokens]
        # P of every pair: seen ones at once, the others by their word, the weight of the history still to come.
        seen = counts > 0
        p = np.where(seen, _discounted(counts, factors) / (b.counts[b.first] + 1), unigrams.p(b.counts[b.second]))
        score = np.bincount(b.doc, np.log10(p)[b.pair_of], docs)
        back = (~seen & (b.counts[b.first] > 0))[b.pair_of]
        keys, times = np.unique(b.doc[back] * b.size + b.first[b.pair_of[back]], return_counts=True)
        n, m = docs, len(keys)
        def both(mine: np.ndarray | pa.Array, other: pa.Array) -> pa.Array:
            return pa.concat_arrays([mine if isinstance(mine, pa.Array) else pa.array(mine), other])
        return pa.table([
            pa.array([0] * n + [1] * m, pa.int32()), pa.array([b.number] * (n + m), pa.int64()),
            both(np.arange(n, dtype=np.int32), pa.array((keys // b.size).astype(np.int32))), both(b.ids, pa.nulls(m, b.ids.type)),
            both(b.held, pa.nulls(m, pa.bool_())), both(b.lengths, pa.nulls(m, pa.int64())),
            both(np.bincount(b.doc, word_counts > 0, docs).astype(np.int64), pa.nulls(m, pa.int64())),
            both(np.bincount(b.doc, unigrams.base(word_counts), docs), pa.nulls(m, pa.float64())), both(score, pa.nulls(m, pa.float64())),
            both(pa.nulls(n, pa.int64()), pa.array(b.numbers[keys % b.size])), both(pa.nulls(n, pa.int64()), pa.array(times)),
        ], names=["kind", "batch", "place", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "history", "n"])

    return _by_batch(batches, answers, run, schema)


def score_documents(docs: DataFrame, batch_tokens: int = BATCH_TOKENS, bucket_entries: int = BUCKET_ENTRIES) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    kind = dict(docs.dtypes)["doc_id"]
    batches = cut(token_batches(docs, batch_tokens), "katz-batches")
    sums = batches.agg(F.sum("n_words"), F.sum("n_tokens"), F.sum("n_train_docs")).first()
    n_words, n_tokens, train_docs = (x or 0 for x in sums)
    word_buckets, pair_buckets = 1 + n_words // bucket_entries, 1 + n_tokens // bucket_entries
    hot = max(1, n_tokens // pair_buckets // 4)
    words = cut(_word_answers(_word_requests(batches, word_buckets), word_buckets), "katz-words")
    told = words.agg(F.sum("total"), F.sum("distinct"), *[F.sum(F.get("often", F.lit(i))) for i in range(K + 1)]).first()
    unigrams = Unigrams(told[0] or 0, told[1] or 0, [x or 0 for x in told[2:]])
    words = words.select("batch", "kind", "bucket", "numbers", "counts")
    pairs = cut(_pair_answers(_pair_requests(batches, words, pair_buckets, hot, train_docs), unigrams, hot), "katz-pairs")
    told = pairs.filter(F.col("kind") == 3).agg(*[F.sum(F.get("few", F.lit(i))) for i in range(K + 1)]).first()
    factors = discounts([x or 0 for x in told])
    answers = words.union(pairs.filter(F.col("kind") == 1).select("batch", "kind", "bucket", "numbers", "counts"))
    rows = cut(_evaluated(batches, answers, unigrams, factors, pair_buckets, hot, train_docs, kind), "katz-scores")
    backed = (
        rows.filter(F.col("kind") == 1).select("batch", "place", F.col("history").alias("_h"), "n")
        .join(backoff_weights(pairs, factors), F.col("_h") == F.col("history"))
        .groupBy(F.col("batch").alias("_batch"), F.col("place").alias("_place")).agg(F.sum(F.col("n") * F.col("log_a")).alias("_more"))
    )
    return (
        rows.filter(F.col("kind") == 0)
        .join(backed, (F.col("batch") == F.col("_batch")) & (F.col("place") == F.col("_place")), "left")
        .select("doc_id", "held_out", "n_tokens", "n_known", F.lit(unigrams.total).cast("long").alias("train_tokens"), "base_score",
                (F.col("score") + F.coalesce("_more", F.lit(0.0))).alias("score"))
    )
