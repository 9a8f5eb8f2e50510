"""Find runs, the periodic stretches of a text's words, and collapse each to its first period.

A run is a stretch of words with smallest period q, at least ``max(24, 3 * q)`` words long, that no neighbouring word
extends.  Runs are found by longest common extensions.  Ukkonen's algorithm builds the suffix trees of the words and of
their reversal; an Euler tour of each with range minima over its string depths gives the depth of any two leaves' lowest
common ancestor in constant time, which is how far two places agree forwards (or, in the reversal, backwards).
Every run begins one of its periods with a Lyndon word, the longest at its place under the word order or the reversed
word order, so the Lyndon words at all places are the candidates; each is extended in both directions.

Trees are built for the stretches of a text that can hold runs.  In a run of at least 24 words and three periods any place lies in a
window of 16 words that occurs again one period on, so places covered by no repeated window (found by window hashes; equal
hashes of different windows only add places) belong to no run, and a run lies whole within one covered stretch.

A text is handled within one task: about 1 KB of memory a word of its longest such stretch.

Defined results: null and empty texts and texts without words have no runs and an empty collapsed text; words are bytes of
UTF-8, compared exactly; repeated rows and null ids are rows like any others; extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledger.llm.common import named, words_of

LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Every place of a run lies in a window of this many words that repeats: two thirds of the shortest run.
WINDOW = LEAST_WORDS - LEAST_WORDS // LEAST_PERIODS
#: Entries of an Euler tour that share one entry of the table of range minima.
BLOCK = 16

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def suffix_tree(s: list[int], letters: int) -> tuple[list[int], list[int], list[int], dict[int, int]]:
    """Ukkonen's tree of ``s`` (numbers below ``letters``, the last one unique).

    Returns where each node's edge begins and ends in ``s``, the suffix of each leaf (-1: inner node), and the
    edges as ``node * letters + first number -> node``.  Node 0 is the root.
    """
    n = len(s)
    begin, end, suffix, link = [0], [0], [-1], [0]
    edges: dict[int, int] = {}
    node = at = depth = waiting = 0
    for i, c in enumerate(s):
        waiting += 1
        unlinked = 0
        while waiting:
            if not depth:
                at = i
            key = node * letters + s[at]
            below = edges.get(key)
            if below is None:
                edges[key] = len(begin)
                begin.append(i), end.append(n), suffix.append(i - waiting + 1), link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                first = begin[below]
                size = end[below] - first
                if depth >= size:
                    at += size
                    depth -= size
                    node = below
                    continue
                here = s[first + depth]
                if here == c:
                    depth += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                split = len(begin)
                begin.append(first), end.append(first + depth), suffix.append(-1), link.append(0)
                edges[key] = split
                begin[below] = first + depth
                edges[split * letters + here] = below
                edges[split * letters + c] = split + 1
                begin.append(i), end.append(n), suffix.append(i - waiting + 1), link.append(0)
                if unlinked:
                    link[unlinked] = split
                unlinked = split
            waiting -= 1
            if node:
                node = link[node]
            elif depth:
                depth -= 1
                at = i - waiting + 1
    return begin, end, suffix, edges


class Extensions:
    """How far the sequence agrees from two places on, for arrays of places, by lowest common ancestors."""

    def __init__(self, s: list[int], letters: int):
        """``letters`` is the number that ends the sequence: larger than all, and taken as the smallest in order."""
        self.n = len(s)
        begin, end, suffix, edges = suffix_tree([*s, letters], letters + 1)
        size = len(begin)
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        below = np.fromiter(edges.values(), np.int64, len(edges))
        parent, letter = np.divmod(keys, letters + 1)
        self._suffix = suffix
        self._children = self._ordered(parent, (letter + 1) % (letters + 1), below, size)
        self._backwards = (parent, np.where(letter == letters, 0, letters - letter), below, size)
        spans = [b - a for a, b in zip(begin, end, strict=True)]
        first, kids = self._children
        # Euler tour: the depth on entering a node and again after each of its children.
        depth, tour, where = [0] * size, [], [0] * (self.n + 1)
        path, turn = [0], first[:]
        tour.append(0)
        while path:
            node = path[-1]
            k = turn[node]
            if k < first[node + 1]:
                turn[node] = k + 1
                child = kids[k]
                depth[child] = d = depth[node] + spans[child]
                if suffix[child] >= 0:
                    where[suffix[child]] = len(tour)
                    tour.append(d)
                    tour.append(depth[node])
                else:
                    tour.append(d)
                    path.append(child)
            else:
                path.pop()
                if path:
                    tour.append(depth[path[-1]])
        self._where = np.array(where)
        pad = -len(tour) % BLOCK
        grid = np.concatenate([np.array(tour, np.int32), np.full(pad, np.iinfo(np.int32).max, np.int32)]).reshape(-1, BLOCK)
        self._tour = grid.ravel()
        self._upto = np.minimum.accumulate(grid, axis=1).ravel()
        self._from = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        levels = [grid.min(axis=1)]
        while (step := 1 << (len(levels) - 1)) * 2 <= len(grid):
            levels.append(np.minimum(levels[-1][:-step], levels[-1][step:]))
        self._levels = levels

    @staticmethod
    def _ordered(parent: np.ndarray, letter: np.ndarray, below: np.ndarray, size: int) -> tuple[list[int], list[int]]:
        order = np.lexsort((letter, parent))
        first = np.searchsorted(parent[order], np.arange(size + 1))
        return first.tolist(), below[order].tolist()

    def agree(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from the places ``a`` and ``b`` on; ``a`` and ``b`` differ, places up to the length are allowed."""
        x, y = self._where[a], self._where[b]
        x, y = np.minimum(x, y), np.maximum(x, y)
        low, high = x // BLOCK, y // BLOCK
        out = np.minimum(self._from[x], self._upto[y])
        gap = high - low - 1
        far = np.flatnonzero(gap > 0)
        if len(far):
            level = np.log2(gap[far]).astype(np.int64)
            for k in np.unique(level):
                rows, table = far[level == k], self._levels[k]
                out[rows] = np.minimum(out[rows], np.minimum(table[low[rows] + 1], table[high[rows] - (1 << int(k))]))
        near = np.flatnonzero(gap < 0)
        if len(near):
            steps = x[near, None] + np.arange(BLOCK)
            inside = steps <= y[near, None]
            out[near] = np.where(inside, self._tour[np.minimum(steps, len(self._tour) - 1)], np.iinfo(np.int32).max).min(axis=1)
        return out.astype(np.int64)

    def ranks(self, backwards: bool = False) -> list[int]:
        """The rank of every suffix; ``backwards`` turns the order of the numbers round, a prefix still comes first."""
        first, kids = self._ordered(*self._backwards) if backwards else self._children
        ranks, stack, suffix, at = [0] * (self.n + 1), [0], self._suffix, 0
        while stack:
            node = stack.pop()
            if suffix[node] >= 0:
                ranks[suffix[node]] = at
                at += 1
            else:
                stack.extend(reversed(kids[first[node]:first[node + 1]]))
        return ranks[:-1]


def lyndon_ends(ranks: list[int]) -> np.ndarray:
    """Where the longest Lyndon word at each place ends: at the next place with a smaller suffix."""
    ends, stack = np.full(len(ranks), len(ranks)), []
    for i, rank in enumerate(ranks):
        while stack and ranks[stack[-1]] > rank:
            ends[stack.pop()] = i
        stack.append(i)
    return ends


def runs_of(s: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of numbers from 0 on, by start, then period."""
    n, letters = len(s), max(s, default=0) + 1
    forwards, back = Extensions(s, letters), Extensions(s[::-1], letters)
    found = []
    for turned in (False, True):
        ends = lyndon_ends(forwards.ranks(turned))
        starts = np.flatnonzero((ends - np.arange(n)) * LEAST_PERIODS <= n)
        ends = ends[starts]
        periods = ends - starts
        right = forwards.agree(starts, ends)
        left = back.agree(n - starts, n - ends)
        lengths = left + periods + right
        long = lengths >= np.maximum(LEAST_WORDS, LEAST_PERIODS * periods)
        found.append(np.stack([starts - left, lengths, periods], axis=1)[long])
    rows = np.unique(np.concatenate(found), axis=0)
    return [tuple(r) for r in rows[np.lexsort((rows[:, 2], rows[:, 0]))].tolist()]


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches that hold all runs: maximal ones whose places are all covered by windows that occur again."""
    if len(codes) < LEAST_WORDS:
        return []
    h = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    width = 1
    while width < WINDOW:
        h = h[:-width] * np.uint64(0xBF58476D1CE4E5B9) + h[width:]
        h ^= h >> np.uint64(31)
        width *= 2
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return []
    again = np.zeros(len(h) + 2, np.bool_)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    # Windows that begin less than a window apart cover one stretch.
    at = np.flatnonzero(again)
    breaks = np.flatnonzero(np.diff(at) > WINDOW) + 1
    cuts = [0, *breaks.tolist(), len(at)]
    found = [(int(at[a]), int(at[b - 1]) + WINDOW) for a, b in pairwise(cuts)]
    return [(a, b) for a, b in found if b - a >= LEAST_WORDS]


def runs_of_words(words: list[bytes]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    numbers: dict[bytes, int] = {}
    codes = [numbers.setdefault(w, len(numbers)) for w in words]
    found = []
    for a, b in stretches(np.array(codes, np.int64)):
        _, part = np.unique(codes[a:b], return_inverse=True)
        found += [(a + start, length, period) for start, length, period in runs_of(part.tolist())]
    return found


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by one blank."""
    if not runs:
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    kept = np.cumsum(edges[:-1]) == 0
    return b" ".join([w for w, keep in zip(words, kept.tolist(), strict=True) if keep])


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    for batch in batches:
        all_runs, texts = [], []
        for text in batch.column(1):
            # bytes.split() without an argument splits at exactly the six blanks of ``common.WORD``.
            words = (text.as_py() or "").encode().split()
            runs = runs_of_words(words)
            all_runs.append([{"start": s, "length": n, "period": p} for s, n, p in runs])
            texts.append(collapsed(words, runs).decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(all_runs, run), pa.array(texts, pa.string())], ["doc_id", "runs", "collapsed"])


def find_runs(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, ``runs`` (by start, then period) and ``collapsed``, the text with each run cut to one period."""
    rows = docs.select(named("doc_id").alias("doc_id"), named("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_batches, f"doc_id {kind}, runs array<{RUN}>, collapsed string")


def with_planted_repeats(docs: DataFrame) -> DataFrame:
    """doc_id and text, where every tenth text (by the CRC-32 of its id) repeats a stretch of words up to its end."""
    h = F.crc32(F.coalesce(named("doc_id").cast("string"), F.lit("")))
    rows = docs.select(named("doc_id").alias("doc_id"), named("text").alias("text"), h.alias("_h"))
    g, words, n = F.floor(F.col("_h") / 10).cast("long"), F.col("_words"), F.col("_n")
    planted = F.concat(
        F.slice(words, F.lit(1), F.col("_a")),
        F.transform(F.sequence(F.lit(0), n - F.col("_a") - 1), lambda i: F.get(words, F.col("_a") + i % F.col("_p"))))
    return (
        rows.withColumn("_words", F.when(F.col("_h") % 10 == 0, words_of(F.col("text"))))
        .withColumn("_n", F.size("_words"))
        .withColumn("_a", F.when(n > 0, (g % n).cast("int")))
        .withColumn("_p", F.when(n > 0, (1 + F.floor((n - F.col("_a")) / (3 + g % 8))).cast("int")))
        .select("doc_id", F.when(n > 0, F.array_join(planted, " ")).otherwise(F.col("text")).alias("text"))
    )


def _foremost(a: Column, b: Column) -> Column:
    """Order of runs: the greatest exponent first, compared exactly, then start, then period."""
    more, less = (x.length.cast("decimal(19,0)") * y.period for x, y in ((a, b), (b, a)))
    return (F.when(more > less, -1).when(more < less, 1).when(a.start < b.start, -1).when(a.start > b.start, 1)
            .when(a.period < b.period, -1).when(a.period > b.period, 1).otherwise(0))


def run_digests(found: DataFrame) -> DataFrame:
    """Per document: the number of runs, the one with the greatest exponent, digests of all runs and of the collapsed text."""
    best = F.get(F.array_sort("runs", _foremost), F.lit(0))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(F.lit(""))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("_best.length * 1000 div _best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
