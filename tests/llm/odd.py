"""Tables with every kind of odd row, and plain-Python readings of the definitions."""

from __future__ import annotations

import re

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard string, size bigint, fingerprint string, `a.b` string"
PROSE = "The cat sat on the mat and looked at a bird in the tree while the old man read a book by the fire of his house"
LONG = " ".join(f"{w}{i % 977}" for i, w in enumerate(PROSE.split() * 2500))


def rows() -> list[tuple]:
    texts = [
        (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, PROSE.upper(), "en", "b"), (4, None, "en", "b"), (5, "", None, None), (6, " \t\r\n\x0b\x0c", "de", None),
        (7, "one", None, "c"), (8, "one two", "fr", "c"), (9, "one two three", "fr", "a"), (10, LONG, "en", "a"), (11, LONG + " more", "en", "a"),
        (12, "12 34 !!", "es", "b"), (13, "Éa ñandú über 日本語 🎉", "es", ""), (14, "<|endoftext|> is text <|startoftext|>", "en", "b"),
        (15, PROSE + " of his", "en", "a"), (15, PROSE + " of his", "en", "a"), (15, "another text under the same id", "en", "c"),
        (None, "no id at all", "en", "a"), (None, None, None, None), (16, "é combining", "fr", "b"),
    ]
    return [(d, t, lang, s, None if t is None else len(t), "own shard", 7, "own print", "dotted") for d, t, lang, s in texts]


def documents(spark, extra: list[tuple] = ()):
    return spark.createDataFrame([*rows(), *extra], SCHEMA)


def plain(spark, pairs: list[tuple]):
    return spark.createDataFrame(pairs, "doc_id bigint, text string")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def roots(nodes: list, linked) -> dict:
    """Component of each node by comparing all pairs; the first node names it."""
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1:]:
            if linked(a, b):
                x, y = find(a), find(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}
