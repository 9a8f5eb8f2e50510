"""Runs against all periods at all places, and the query against a plain reading of its contract."""

import hashlib
import random
import zlib
from fractions import Fraction

import odd
import pytest

from ledger.llm import periodic_runs as pr
from ledger.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def brute(words: list) -> list[tuple[int, int, int]]:
    n, found, taken = len(words), [], set()
    for period in range(1, n // 3 + 1):
        i = 0
        while i + period < n:
            j = i
            while j + period < n and words[j] == words[j + period]:
                j += 1
            length = j + period - i
            if j > i and length >= max(24, 3 * period):
                # The smallest period of a stretch is met first; it must not come again with a multiple.
                if not any((i, length, p) in taken for p in range(1, period)):
                    found.append((i, length, period))
                taken.add((i, length, period))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = odd.re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute(words)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    digests = [hashlib.sha256(t.encode()).hexdigest() for t in (
        "".join(f"{s},{length},{p}\n" for s, length, p in runs), " ".join(w for i, w in enumerate(words) if i not in dropped))]
    return (doc_id, len(runs), *(best or (None,) * 3), None if best is None else 1000 * best[1] // best[2], *digests)


@pytest.mark.parametrize("seed", range(6))
def test_random_sequences(seed):
    rng = random.Random(seed)
    for _ in range(120):
        letters, words = rng.choice([1, 2, 2, 3, 5]), []
        for _ in range(rng.randint(0, 6)):
            unit = [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
            words += unit * rng.randint(1, 9) if rng.random() < 0.7 else [rng.randrange(40) for _ in range(rng.randint(0, 30))]
        words = [str(w).encode() for w in words]
        assert pr.runs_of_words(words) == brute(words)


def test_extensions_and_lyndon_words():
    rng = random.Random(1)
    for _ in range(60):
        s = [rng.randrange(3) for _ in range(rng.randint(2, 60))]
        tree = pr.Extensions(s, 3)
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s) + 1) if i != j]
        a, b = (pr.np.array(x) for x in zip(*pairs, strict=True))
        for (i, j), n in zip(pairs, tree.agree(a, b), strict=True):
            k = 0
            while max(i, j) + k < len(s) and s[i + k] == s[j + k]:
                k += 1
            assert n == k
        for backwards in (False, True):
            t = [-x for x in s] if backwards else s
            # The empty suffix comes first.
            assert tree.ranks(backwards) == [1 + sorted(t[i:] for i in range(len(t))).index(t[i:]) for i in range(len(t))]


def test_long_text():
    unit = [str(i).encode() for i in range(700)]
    words = [b"x", *unit * 60, *unit[:5], b"y"]
    assert pr.runs_of_words(words) == [(1, 42_005, 700)]
    assert pr.collapsed(words, [(1, 42_005, 700)]).split() == [b"x", *unit, b"y"]


def rows_for_query() -> list[tuple]:
    rng = random.Random(2)
    texts = ["a " * 23, "a " * 24, "a b c d e f g h i " * 3 + "a", "x y " * 40 + "z " * 30, "", None, " \t\n", "é ñ " * 20, ("p q r " * 9 + "s ") * 4]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, "k " * 30), (None, None)]
    return rows + [(100 + i, " ".join(str(rng.randrange(8)) for _ in range(rng.randrange(300)))) for i in range(60)]


def test_contract(spark, tmp_path):
    docs = odd.plain(spark, rows_for_query())
    docs = docs.withColumn("runs", docs.doc_id).withColumn("collapsed", docs.text).withColumn("_h", docs.doc_id)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op12_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((expected(*r) for r in rows_for_query()), key=str)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect()}
    rows = [r for r in docs.collect() if len((r.text or "").split()) < 400]
    assert len(got) == docs.count() and sum(r[1] for r in got.values()) >= 10
    for r in rows:
        assert got[r.doc_id] == expected(r.doc_id, r.text)


def test_empty_table(spark):
    found = pr.find_runs(odd.plain(spark, []))
    assert pr.run_digests(found).collect() == []
