"""Mixing, sharding and url judging: their SQL over given and odd tables, and what must hold whatever the table."""

import duckdb
import numpy as np
import odd
import pytest

from ledger.llm import mixing, sharding, sql, url_filter

LONG = "CAST(NULL AS BIGINT)"


def rows_of(df) -> list:
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def rows_of_sql(view: str, df, text: str) -> list:
    con = duckdb.connect()
    frame = df.toPandas()  # noqa: F841
    kinds = {"bigint": "BIGINT", "string": "VARCHAR"}
    cols = ", ".join(f'CAST("{c}" AS {kinds[k]}) AS "{c}"' for c, k in df.dtypes)
    con.execute(f"CREATE TABLE {view} AS SELECT {cols} FROM frame")
    cur = con.execute(text)
    names = [d[0] for d in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in cur.fetchall()), key=str)


def many(spark, n=4000):
    """A source with a third of all rows, a null one, one without words."""
    return spark.range(n).selectExpr(
        "id AS doc_id", "CASE WHEN id % 50 = 0 THEN '' ELSE repeat('word ', CAST(1 + id * 7 % 23 AS INT)) END AS text",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL WHEN id % 350 = 50 THEN 'silent' ELSE concat('s', id % 5) END AS source")


@pytest.mark.parametrize("make", [lambda s: odd.documents(s).select("doc_id", "text", "source"), many], ids=["odd", "many"])
def test_mix_equals_its_sql(spark, make):
    docs = make(spark)
    assert rows_of(mixing.plan_mix(docs)) == rows_of_sql("documents", docs, sql.MIX)


def test_mix_comes_near_its_targets(spark):
    rows = mixing.plan_mix(many(spark)).collect()
    sources = {}
    for r in rows:
        assert r.taken in (0, r["size"], 2 * r["size"])
        sources.setdefault((r.source_size, r.target), []).append(r)
    for (_, target), own in sources.items():
        assert abs(sum(r.taken for r in own) - target) <= max(r["size"] for r in own)
    total = sum(r["size"] for r in rows)
    assert sum(t for _, t in sources) == pytest.approx(1.5 * total)


def test_mixed_rows_are_the_planned_ones(spark):
    docs = odd.documents(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    plan = {}
    for r in mixing.plan_mix(docs).collect():
        plan[r.doc_id] = plan.get(r.doc_id, 0) + r.taken
    got = {}
    for r in mixed.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(odd.words(r.text))
    assert {k: v for k, v in plan.items() if v} == {k: v for k, v in got.items() if v}


def shards_in_python(docs, limit):
    import hashlib

    hashed = [(d, int(hashlib.md5((str(d) if d is not None else "t" + t if t is not None else "").encode()).hexdigest()[:15], 16), len((t or "").encode())) for d, t in docs]

    def split(rows, prefix):
        if sum(r[2] for r in rows) <= limit or len({r[1] for r in rows}) == 1:
            return [(r[0], r[2], prefix) for r in rows]
        bit = 59 - len(prefix)
        return split([r for r in rows if not r[1] >> bit & 1], prefix + "0") + split([r for r in rows if r[1] >> bit & 1], prefix + "1") if rows else []

    return sorted(split(hashed, ""), key=str) if hashed else []


@pytest.mark.parametrize("limit", [100, 600, 5000, 1 << 20])
def test_shards_equal_repeated_splitting(spark, limit):
    docs = many(spark, 3000).unionByName(odd.documents(spark).select("doc_id", "text", "source"))
    docs = docs.unionByName(spark.range(30).selectExpr("77 AS doc_id", "repeat('long text ', 20) AS text", "'x' AS source"))
    plan = sharding.plan_shards(docs, limit).collect()
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert sorted(((r.doc_id, r.n_bytes, r.shard) for r in plan), key=str) == shards_in_python(rows, limit)
    sums, counts = {}, {}
    for r in plan:
        sums[r.shard] = sums.get(r.shard, 0) + r.n_bytes
        counts[r.shard] = counts.get(r.shard, 0) + 1
    assert all(r.shard_bytes == sums[r.shard] and r.shard_docs == counts[r.shard] and r.oversize == (r.shard_bytes > limit) for r in plan)


def test_shards_equal_their_sql(spark):
    docs = many(spark, 500).select("doc_id", "text").unionByName(odd.documents(spark).select("doc_id", "text"))
    text = sql.SHARDS.replace(str(sharding.MAX_BYTES), "3000")
    assert rows_of(sharding.plan_shards(docs, 3000)) == rows_of_sql("documents", docs, text)


def test_directory_points_every_slot_to_its_shard(spark):
    shards = sharding.plan_shards(many(spark, 500), 2000).select("shard", "depth").distinct()
    deepest = max(r.depth for r in shards.collect())
    slots = {r.slot: r.shard for r in sharding.directory(shards).collect()}
    assert sorted(slots) == list(range(1 << deepest))
    assert all(f"{slot:0{deepest}b}".startswith(shard) for slot, shard in slots.items())


def test_assigned_shards_keep_columns_and_rows(spark):
    docs = odd.documents(spark)
    out = sharding.assign_shards(docs, 4000)
    assert out.columns == [*docs.columns, "shard_"]
    assert out.select("doc_id", "shard").count() == docs.count()


PAGES = [
    (1, "http://a.com/x"), (2, "HTTP://WWW.Example.COM/en/1?q=/fr/"), (3, "https://example.com/en/"), (4, "https://x.example.com/en"), (5, "http://net/es/"),
    (6, "http://notnet/es/"), (7, "ftp://b.net/fr/x#y"), (8, None), (9, "no scheme"), (10, ""), (11, "http://com"), (12, "http://deep.b.net/de/"),
    (13, "http://c.org/1"), (14, "http://d.org/2"), (15, "x://?a/b"), (16, "http://e.org:80/a://b"), (17, "http://deep.b.net/de/"), (None, "http://f.org/"),
]
HTML = {
    13: '<a href="http://b.net/fr/1">x</a> <a HREF = \'//B.net/2\'>', 14: '<a href=https://a.com/>', 16: '<a href="/local">', 1: '<a href="http://d.org/9">',
    8: '<a href="http://c.org/">', 12: None,
}


def pages(spark):
    return spark.createDataFrame([(p, u, HTML.get(p, "<p>")) for p, u in PAGES], "page_id bigint, url string, html string")


def test_urls_equal_their_sql(spark):
    assert rows_of(url_filter.judge_urls(pages(spark))) == rows_of_sql("pages", pages(spark), sql.urls())


def test_urls_by_hand(spark):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages(spark)).collect()}
    assert got[1] == ("a.com", "/x", "com/", "allow")
    assert got[2] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[3] == ("example.com", "/en/", "example.com/en/", "block")
    assert got[4] == ("x.example.com", "/en", "com/", "allow")
    assert got[5] == ("net", "/es/", "net/es/", "block")
    assert got[6] == ("notnet", "/es/", None, "allow")
    assert got[8] == got[9] == got[10] == ("", "", None, "allow")
    assert got[11] == ("com", "", None, "allow")
    assert got[12] == ("deep.b.net", "/de/", None, "block")  # its parent is a blocked host
    assert got[13][3] == "block"  # links to a blocked host only
    assert got[14][3] == "allow"  # linked from a trusted host and linking to one
    assert got[15] == ("", "", None, "allow")


def test_scores_reach_the_end_of_a_long_chain(spark):
    chain = [(i, f"http://h{i}.test/", f'<a href="http://h{i + 1}.test/">') for i in range(24)] + [(24, "http://h24.test/", None), (25, "http://alone.test/", None)]
    df = spark.createDataFrame(chain, "page_id bigint, url string, html string")
    got = {r.page_id: r.verdict for r in url_filter.judge_urls(df, (("block", "h24.test", "/"),)).collect()}
    assert got == {**dict.fromkeys(range(25), "block"), 25: "allow"}


def test_ranks_equal_the_solved_equations(spark):
    rng = np.random.default_rng(4)
    weights = np.where(rng.random((30, 30)) < 0.08, rng.integers(1, 9, (30, 30)), 0) * (1 - np.eye(30))
    edges = [(f"h{a}", f"h{b}", float(weights[a, b])) for a, b in np.argwhere(weights).tolist()]
    seeds = [("trust", "h0", 0.25), ("trust", "h1", 0.75), ("distrust", "h2", 1.0)]
    ranks = url_filter.propagate(spark.createDataFrame(edges, "_src string, _dst string, _weight double"),
                                 spark.createDataFrame(seeds, "_kind string, host string, _seed double"))
    got = {(r["_kind"], r.host): r["_rank"] for r in ranks.collect()}
    for kind, matrix in (("trust", weights), ("distrust", weights.T)):
        shares = matrix / np.maximum(matrix.sum(1, keepdims=True), 1)
        start = np.zeros(30)
        for k, host, seed in seeds:
            start[int(host[1:])] += seed * (k == kind)
        want = np.linalg.solve(np.eye(30) - url_filter.DAMPING * shares.T, (1 - url_filter.DAMPING) * start)
        for i in range(30):
            assert got.get((kind, f"h{i}"), 0.0) == pytest.approx(want[i], rel=1e-5, abs=1e-15)


def test_rows_of_one_id_are_mixed_apart(spark):
    """Half of a source's rows share one id, others have none: the taken words still come near the target."""
    rows = [(7 if i % 2 else None if i % 3 else i, " ".join(f"w{i}" for _ in range(1 + i % 9)), "a" if i % 5 else "b") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.plan_mix(docs).collect()
    for source in ("a", "b"):
        sizes = sum(len(t.split()) for _, t, s in rows if s == source)
        own = [r for r in got if r.source_size == sizes]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 10
    assert rows_of(mixing.plan_mix(docs)) == rows_of_sql("documents", docs, sql.MIX)


def test_empty(spark):
    docs = odd.documents(spark).limit(0)
    assert mixing.plan_mix(docs).count() == mixing.mix(docs).count() == 0
    assert sharding.plan_shards(docs).count() == sharding.assign_shards(docs).count() == 0
    assert url_filter.judge_urls(pages(spark).limit(0)).count() == 0
