"""Benchmark passages in documents against every window of every item's size."""

import random
import re
from collections import Counter

import odd

from ledger.llm import decontaminate as d


def shingles(text: str | None) -> list[tuple]:
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return [tuple(words[i:i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])


def best(text: str | None, item: str | None) -> float:
    have, want = shingles(text), shingles(item)
    if not want:
        return 0.0
    top, target = 0.0, Counter(want)
    for start in range(1 - len(want), len(have)):
        window = Counter(have[max(start, 0):start + len(want)])
        both = sum((window & target).values())
        top = max(top, both / (sum(window.values()) + len(want) - both)) if window else top
    return top


def check(spark, docs: list[tuple], items: list[tuple], **kw) -> dict:
    got = {(r.doc_id, r.item_id): round(r.similarity, 9) for r in d.find_leaks(
        odd.plain(spark, docs), spark.createDataFrame(items, "item_id bigint, text string"), **kw).collect()}
    want = {}
    for doc, text in docs:
        for item, passage in items:
            value = best(text, passage)
            if value >= 0.8:
                want[doc, item] = max(round(value, 9), want.get((doc, item), 0))
    assert got == want
    return got


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        kind = rng.randrange(3)
        if kind == 0:
            words[at] = "other"
        elif kind == 1:
            words.insert(at, "inserted")
        else:
            del words[at]
    return words


def test_edited_passages_in_long_texts(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(12, 90)))) for i in range(12)]
    items += [(20, "a few words"), (21, None), (22, ""), (23, "x " * 30)]
    docs = []
    for n in range(80):
        passage = edited(rng, items[n % 12][1].split(), n % 5)
        if n % 9 == 0:
            half = len(passage) // 2
            passage = passage[half:] + passage[:half]
        around = rng.choices(vocabulary, k=rng.choice([0, 3, 60]))
        docs.append((n, " ".join(around + passage + around[:20]).upper() if n % 2 else ", ".join(around + passage)))
    docs += [(100, "A few, words"), (101, "say a few words more here"), (102, None), (103, ""), (104, items[3][1]), (104, items[3][1]), (105, "x " * 64), (106, items[0][1] + " " + items[1][1])]
    got = check(spark, docs, items)
    assert len(got) > 30
    assert check(spark, docs, items, slice_shingles=40) == got


def test_drop_keeps_clean_rows_and_columns(spark):
    docs = odd.documents(spark)
    bench = spark.createDataFrame([(1, odd.PROSE)], "item_id bigint, text string")
    kept = d.drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (r[0] for r in odd.rows() if best(r[1], odd.PROSE) < 0.8), key=str)


def test_empty(spark):
    docs, bench = odd.documents(spark), spark.createDataFrame([(1, odd.PROSE)], "item_id bigint, text string")
    assert d.find_leaks(docs.limit(0), bench).count() == 0
    assert d.find_leaks(docs, bench.limit(0)).count() == 0
    assert d.drop_leaks(docs, bench.limit(0)).count() == docs.count()


def test_long_item_and_places_at_the_start(spark):
    """An item of 70,000 words is counted without overflow; a passage cut at a text's start begins at its first word."""
    rng = random.Random(13)
    long = " ".join(str(rng.randrange(10 ** 6)) for _ in range(70_000))
    passage = [f"p{i}" for i in range(60)]
    docs = odd.plain(spark, [(1, " ".join(passage[8:] + ["then"] * 3)), (2, "x " * 50), (3, long[:5000])])
    items = spark.createDataFrame([(1, long), (2, " ".join(passage))], "item_id bigint, text string")
    assert [(r.doc_id, r.item_id, r.start_word) for r in d.find_leaks(docs, items).collect()] == [(1, 2, 0)]


def test_items_of_one_length_meet_their_own_windows_only(spark):
    rng = random.Random(17)
    items = [(i, " ".join(f"i{i}w{rng.randrange(99)}" for _ in range(40))) for i in range(60)]
    docs = [(i, "before it " + items[i][1] + " after it " + items[(i + 1) % 60][1]) for i in range(60)]
    check(spark, docs, items)
