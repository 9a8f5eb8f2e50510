"""SimHash components against all pairs."""

import random

import odd
import xxhash

from ledger.llm import simhash

SF = "/root/testdata/sf0.001"


def fingerprint(text: str | None) -> int:
    words = odd.words(text)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(rows: list[tuple]) -> list[tuple]:
    prints = [fingerprint(t) for _, t in rows]
    root = odd.roots(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 3)
    ids: dict[int, list[int]] = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        ids.setdefault(root[p], []).append(doc)
    return sorted(((d, f"{p:016x}", min((x for x in ids[root[p]] if x is not None), default=None)) for (d, _), p in zip(rows, prints, strict=True)), key=str)


def found(docs) -> list[tuple]:
    return sorted((tuple(r) for r in simhash.simhash_components(docs).collect()), key=str)


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd.rows()]
    assert found(odd.documents(spark)) == expected(rows)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    rng = random.Random(3)
    for doc, text in rows[:40]:
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        rows.append((doc + 100_000, " ".join(words)))
    assert found(odd.plain(spark, rows)) == expected(rows)


def test_clusters_in_chunks(spark):
    """Dense and chained clusters, with buckets far above the chunk size."""
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        centre = at = rng.getrandbits(64)
        for _ in range(25):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))))
            at ^= sum(1 << b for b in rng.sample(range(64), 3))
            prints.add(at)
    prints |= {rng.getrandbits(64) for _ in range(300)} | {0, 1, (1 << 64) - 1}
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    want = odd.roots(signed, lambda a, b: (a ^ b).bit_count() <= 3 if (a < 0) == (b < 0) else ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3)
    df = spark.createDataFrame([(p,) for p in signed], "_fp bigint")
    for size in (4, 1024):
        got = {r["_node"]: r["_root"] for r in simhash.components(simhash.near_links(df, size)).collect()}
        groups = {}
        for p in signed:
            groups.setdefault(want[p], set()).add(p)
        assert {p: got.get(p, p) for p in signed} == {p: min(groups[want[p]]) for p in signed}


def test_a_list_of_links_is_a_forest():
    import numpy as np

    near = np.array([1 << b for b in range(16)], np.uint64)
    assert len(simhash.tree_links(near, 1)) == 15


def test_drop_keeps_one_of_each_group(spark):
    docs = odd.documents(spark)
    rows = [(r[0], r[1]) for r in odd.rows()]
    want = expected(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    # One row per component: groups without an id count as one.
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted({w[2] for w in want}, key=str)


def test_drop_keeps_unrelated_rows_without_or_with_one_id(spark):
    rng = random.Random(11)
    texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(30)) for _ in range(40)]
    rows = [(None if i % 2 else 7, t) for i, t in enumerate(texts)]
    copies = [(None, texts[1]), (None, texts[1] + " "), (9, texts[0]), (3, texts[3].upper())]
    assert len(set(odd.roots(sorted({fingerprint(t) for t in texts}), lambda a, b: (a ^ b).bit_count() <= 3).values())) == 40
    kept = [(r.doc_id, r.text.lower().strip()) for r in simhash.drop_near_duplicates(odd.plain(spark, rows + copies)).collect()]
    # Of the copies only the one with an id, in a component that had none, is kept for its component.
    assert sorted(kept, key=str) == sorted([(3 if i == 3 else d, t) for i, (d, t) in enumerate(rows)], key=str)


def test_empty(spark):
    empty = odd.documents(spark).limit(0)
    assert found(empty) == []
    assert simhash.drop_near_duplicates(empty).count() == 0


def test_the_row_that_stays_does_not_depend_on_the_order(spark):
    """Rows equal in id and text but not in other columns: always the same one stays."""
    rows = [(1, odd.PROSE, s, n) for s in ("b", "a", None) for n in (3, 1, 2)] + [(2, "other words here today", "z", None)]
    schema = "doc_id bigint, text string, source string, `n.chars` bigint"
    kept = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        kept.add(tuple(sorted((tuple(r) for r in simhash.drop_near_duplicates(spark.createDataFrame(rows, schema).repartition(4)).collect()), key=str)))
    assert len(kept) == 1 and len(next(iter(kept))) == 2
