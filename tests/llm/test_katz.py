"""Katz scores against a dictionary model of the same definitions."""

import math
import random
import zlib
from collections import Counter, defaultdict

import odd
import pytest

from ledger.llm import katz


class Model:
    def __init__(self, texts):
        self.words, self.pairs, self.after = Counter(), Counter(), defaultdict(set)
        self.histories = Counter()
        for text in texts:
            before = "<"
            for w in [*odd.words(text), ">"]:
                self.words[w] += 1
                self.pairs[before, w] += 1
                self.histories[before] += 1
                self.after[before].add(w)
                before = w
        self.n = sum(self.words.values())
        self.d1 = self.discounts(self.words)
        self.d2 = self.discounts(self.pairs)
        self.unknown = 1 - sum(self.p1(w) for w in self.words)

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        common = 6 * n[6] / n[1] if n[1] else 1.0
        out = {}
        for r in range(1, 6):
            f = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0
            out[r] = f if 0 < f <= 1 else 1.0
        return out

    def p1(self, w):
        c = self.words[w] if w in self.words else 0
        return self.d1.get(c, 1.0) * c / (self.n + 1) if c else self.unknown

    def p(self, h, w):
        c = self.pairs[h, w] if (h, w) in self.pairs else 0
        total = self.histories[h] if h in self.histories else 0
        if c:
            return self.d2.get(c, 1.0) * c / (total + 1)
        if not total:
            return self.p1(w)
        left = 1 - sum(self.d2.get(self.pairs[h, x], 1.0) * self.pairs[h, x] / (total + 1) for x in self.after[h])
        return left / (1 - sum(self.p1(x) for x in self.after[h])) * self.p1(w)

    def score(self, text):
        total, before = 0.0, "<"
        for w in [*odd.words(text), ">"]:
            total += math.log10(self.p(before, w))
            before = w
        return total

    def base(self, text):
        return sum(math.log10((self.words.get(w, 0) + 1) / (self.n + len(self.words) + 1)) for w in [*odd.words(text), ">"])


def held(doc):
    return zlib.crc32(("" if doc is None else str(doc)).encode()) % 7 == 2


def texts() -> list[tuple]:
    rng = random.Random(7)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)]
    out = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(250)]
    out += [(1000 + i, "Hot pair " * 30) for i in range(30)]
    return out


def check(spark, docs, rows, **kw):
    model = Model([t for d, t in rows if not held(d)])
    got = sorted((tuple(r) for r in katz.score_documents(docs, **kw).collect()), key=lambda r: (str(r[0]), r[6]))
    want = sorted(((d, held(d), len(odd.words(t)) + 1, sum(w in model.words for w in [*odd.words(t), ">"]), model.n, model.base(t), model.score(t)) for d, t in rows),
                  key=lambda r: (str(r[0]), r[6]))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert g[5:] == pytest.approx(w[5:], rel=1e-9, abs=1e-9)
    return model


def test_many_batches_and_buckets(spark):
    rows = texts()
    model = check(spark, odd.plain(spark, rows).repartition(5), rows, batch_tokens=400, bucket_entries=300)
    # Every history's distribution sums to one over the known words and the unknown one.
    for h in ["<", "hot", "pair", "w1", "w2", next(iter(model.after))]:
        assert sum(model.p(h, w) for w in model.words) + model.p(h, "never seen") == pytest.approx(1)


def test_production_sizes(spark):
    rows = texts()
    check(spark, odd.plain(spark, rows), rows)


def test_odd_rows(spark):
    check(spark, odd.documents(spark), [(r[0], r[1]) for r in odd.rows()])


def test_nothing_to_learn_from(spark):
    only = next(i for i in range(100) if held(i))
    check(spark, odd.plain(spark, [(only, "some words")]), [(only, "some words")])
    assert katz.score_documents(odd.documents(spark).limit(0)).count() == 0


def test_packed_arrays():
    import numpy as np

    for values in ([], [0], [255, 256], [1 << 40, 3]):
        assert katz.unpack(katz.pack(np.array(values, np.int64))).tolist() == values
