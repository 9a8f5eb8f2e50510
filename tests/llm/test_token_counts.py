"""Compiled token counts against the library."""

import odd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledger.llm import token_counts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def machine():
    return token_counts.Transducer(PATH)


def wanted(machine, texts):
    return [len(machine.library.encode(t or "", add_special_tokens=False).ids) for t in texts]


ALPHABET = "abestrlv'mdIT .,!?-0189éñüßΣσςİ日本\u0301\n\t\u00a0\u0085\x1c<|>"


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=700), max_size=5))
def test_random_texts(machine, texts):
    assert machine.count(texts) == wanted(machine, texts)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=80))
def test_any_characters(machine, text):
    assert machine.count([text]) == wanted(machine, [text])


def test_chunks_without_white_space(machine):
    texts = ["a" * 2000, "é" * 1500 + " x", "x" * 255 + " y", "x" * 256 + " y", "don't" * 400, "'" * 600, "1" * 600, odd.LONG]
    assert machine.count(texts) == wanted(machine, texts)


def test_special_strings(machine):
    texts = ["<|endoftext|>", "a<|startoftext|>b <|ENDOFTEXT|> <|endoftext|><|endoftext|>", "<|endoftext"]
    assert machine.count(texts) == wanted(machine, texts)


def test_more_characters_than_columns_and_a_full_table(monkeypatch):
    monkeypatch.setattr(token_counts, "SYMBOLS", 20)
    monkeypatch.setattr(token_counts, "MAX_STATES", 50)
    machine = token_counts.Transducer(PATH)
    texts = [odd.PROSE, "xyz 123 üöä ñ 日本語", "plain", odd.PROSE.upper()]
    for _ in range(3):
        assert machine.count(texts) == wanted(machine, texts)


def test_table(spark, machine):
    got = sorted((tuple(r) for r in token_counts.count_tokens(odd.documents(spark), PATH).collect()), key=str)
    rows = [(r[0], r[1]) for r in odd.rows()]
    counts = wanted(machine, [t for _, t in rows])
    assert got == sorted(((d, len((t or "").encode()), n, n > 2048) for (d, t), n in zip(rows, counts, strict=True)), key=str)
    assert any(g[3] for g in got)
    assert token_counts.count_tokens(odd.documents(spark).limit(0), PATH).count() == 0
