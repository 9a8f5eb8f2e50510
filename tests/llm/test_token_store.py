"""The binary token store: exact round trips."""

import random
import zlib

import numpy as np
import odd
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledger.llm import token_store
from ledger.session import scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def check(docs, library, rows):
    got = [tuple(r)[:4] for r in token_store.round_trip(docs, PATH).collect()]
    encoded = [(d, ids(library, t)) for d, t in rows]
    crc = {(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in encoded}
    assert len(got) == len(rows)
    assert {(d, n, c) for d, _, n, c in got} == crc
    # Starts follow the order of ids, nulls first, and leave no gap.
    got.sort(key=lambda r: r[1])
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    order = [(-1 << 62) if r[0] is None else r[0] for r in got]
    assert order == sorted(order)


def test_odd_rows(spark, library):
    check(odd.documents(spark).repartition(4), library, [(r[0], r[1]) for r in odd.rows()])


def test_given_documents_and_single_reads(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(docs, library, rows)
    path = scratch(spark, "tokens-test")
    token_store.write_store(docs, path, PATH, block_bytes=4000)
    assert spark.read.parquet(f"{path}/blocks").count() > 10
    assert len(spark.read.parquet(f"{path}/dictionary").first()["dictionary"]) > 0
    for doc, text in rows[::41]:
        assert token_store.read_ids(spark, path, doc) == [ids(library, text)]
    assert token_store.read_ids(spark, path, -5) == []


def test_wrong_dictionary_is_refused(spark):
    docs = odd.documents(spark)
    path = scratch(spark, "tokens-bad")
    token_store.write_store(docs, path, PATH)
    row = spark.read.parquet(f"{path}/dictionary").first()
    bad = scratch(spark, "tokens-bad-copy")
    spark.read.parquet(f"{path}/blocks").write.parquet(f"{bad}/blocks")
    spark.createDataFrame([(bytearray(b"other"), row["dict_hash"], row["width"], row["tokenizer"])],
                          "dictionary binary, dict_hash bigint, width int, tokenizer string").write.parquet(f"{bad}/dictionary")
    with pytest.raises(ValueError, match="damaged"):
        token_store.read_store(spark, bad)


def test_empty(spark):
    assert token_store.round_trip(odd.documents(spark).limit(0), PATH).count() == 0


def test_pieces_give_the_librarys_ids(library, monkeypatch):
    monkeypatch.setattr(token_store, "MEMORY_PIECES", 3)
    encode = token_store.Encoder(PATH)
    for text in [odd.PROSE, " ''s it's  \n\n x", "a\u0085b\x1cc\u3000d", "日本語 ñ é", "<|endoftext|> <|endoftext", "١٢٣ Ⅻ ²", "\u0378 \U0010ffff"]:
        assert np.frombuffer(encode(text), encode.kind).tolist() == ids(library, text)


def test_every_control_character_before_contractions_and_scripts(library):
    encode, rng = token_store.Encoder(PATH), random.Random(3)
    controls = [chr(i) for i in (*range(33), *range(127, 161), 0x1680, 0x180E, 0x200B, 0x2028, 0x3000, 0xFEFF)]
    after = ["'t", "'re x", "'S", "a", "É", "日", "ب", "0", "٠", "½", "_", "\u0301", "🎉", " ", "\n", ""]
    texts = [b + c + a for c in controls for a in after for b in ("", "x", " ", "1")]
    pool = [*controls, *after, "'", "tsar", "  "]
    texts += ["".join(rng.choices(pool, k=rng.randint(1, 8))) for _ in range(8000)]
    for text in texts:
        assert np.frombuffer(encode(text), encode.kind).tolist() == ids(library, text), repr(text)


def test_long_documents_train_a_dictionary_too(spark):
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(300)]
    docs = odd.plain(spark, [(i, " ".join(rng.choices(words, k=1500))) for i in range(60)])
    path = scratch(spark, "tokens-long")
    token_store.write_store(docs, path, PATH)
    assert len(spark.read.parquet(f"{path}/dictionary").first()["dictionary"]) > 0
