"""Spot signatures: edited texts, neighbours across parts, near copies."""

import hashlib

import odd

from ledger.llm import spot_signatures as s


def expected(rows: list[tuple], tie) -> list[tuple]:
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), tie[r]))
    out = []
    for i, (doc, text) in enumerate(order):
        own, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(own) // 2
        edited = own[:len(own) - half] + after[:half]
        a, b, c = s.signatures(own), s.signatures(edited), s.signatures(after)
        out.append((doc, len(own), hashlib.sha256(edited.encode()).hexdigest(), s.written(a), s.written(b), s.likeness(a, b), s.likeness(a, c)))
    return sorted(out, key=str)


def check(spark, docs):
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    tie = {(r[0], r[1]): r[2] for r in docs.selectExpr("doc_id", "text", "xxhash64(text)").collect()}
    got = sorted((tuple(r) for r in s.fingerprint_documents(docs).collect()), key=str)
    assert got == expected(rows, tie)


def test_odd_rows(spark):
    check(spark, odd.documents(spark).repartition(3))


def test_many_parts(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        check(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_few_rows(spark):
    check(spark, odd.plain(spark, [(1, "only")]))
    check(spark, odd.plain(spark, [(None, "no id"), (None, "none here either")]))
    check(spark, odd.plain(spark, [(2, None), (1, "")]))
    assert s.fingerprint_documents(odd.documents(spark).limit(0)).count() == 0


def test_likeness():
    assert s.likeness(set(), set()) == 1 and s.likeness(set(), {1}) == 0
    assert s.signatures(odd.PROSE) == s.signatures(odd.PROSE.upper())
    assert s.alike([1, 2, 3, 4, 5], [1, 2, 3, 4, 5], 0.8) and not s.alike([1, 2, 3], [3, 4, 5, 6], 0.8)
    assert s.alike([1, 2, 3, 4], [1, 2, 3, 4, 5], 0.8) and not s.alike([1, 2, 3, 9], [1, 2, 3, 4, 5], 0.8)


def test_length_classes_hold_what_can_reach_the_threshold():
    for a in range(1, 300):
        for b in range(a, int(a / 0.8) + 1):
            assert s.length_class(b) - s.length_class(a) <= 1


def test_near_copies_against_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    for doc, text in rows[:40]:
        words = text.split(" ")
        rows.append((doc + 1000, " ".join(words[:-1])))
        rows.append((doc + 2000, " ".join(words[1:])))
    rows += [(5000, None), (5001, ""), (5002, "plain")]
    sets = {d: s.signatures(t) for d, t in rows}
    want = odd.roots(sorted(sets), lambda a, b: sets[a] == sets[b] or bool(sets[a] and sets[b]) and s.likeness(sets[a], sets[b]) >= 0.8)
    got = {r.doc_id: r.class_id for r in s.near_copies(odd.plain(spark, rows)).collect()}
    assert got == want
    assert len(set(got.values())) < len(rows) - 60
