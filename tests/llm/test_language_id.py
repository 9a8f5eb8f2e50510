"""Language identification: held-out accuracy and odd rows."""

import zlib

import numpy as np
import odd

from ledger.llm import language_id

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: r.lang for r in docs.collect()}
    rows = language_id.identify_languages(docs).collect()
    assert len(rows) == len(want)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == want[r.doc_id] for r in held]) > 0.98


def test_labels_of_the_fold_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    spoiled = docs.selectExpr("doc_id", "text", "CASE WHEN pmod(crc32(CAST(doc_id AS STRING)), 5) = 0 THEN 'xx' ELSE lang END AS lang")
    assert language_id.train(docs) == language_id.train(spoiled)


def test_prediction_needs_the_text_only(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language_id.train(docs)
    with_all = language_id.predict(docs, model).select("text", "_llm_lang", "_llm_score")
    alone = language_id.predict(docs.select("text"), model)
    assert sorted(map(tuple, with_all.collect())) == sorted(map(tuple, alone.collect()))


def test_odd_rows(spark):
    docs = odd.documents(spark)
    rows = language_id.identify_languages(docs).collect()
    assert len(rows) == docs.count()
    none = {r.doc_id for r in rows if r.lang_pred == "und"}
    assert {4, 5, 6, 12} <= none and not {1, 3, 7, 10, 13} & none
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    kept = language_id.keep_identified(docs)
    assert kept.columns == docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in r[1] or "") for r in odd.rows())


def test_nothing_to_learn_from(spark):
    docs = odd.documents(spark).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language_id.identify_languages(docs).collect()} == {"und"}
    assert language_id.identify_languages(odd.documents(spark).limit(0)).count() == 0


def test_stage_without_labels_keeps_texts_with_a_letter(spark):
    lettered = sorted((str((r[0], r[1])) for r in odd.rows() if any(c.isalpha() for c in r[1] or "")))
    docs = odd.documents(spark)
    # No label at all, labels in fold 0 only, labels on texts without a letter only.
    labels = ["CAST(NULL AS STRING)", "CASE WHEN pmod(crc32(CAST(COALESCE(CAST(doc_id AS STRING), '') AS BINARY)), 5) = 0 THEN lang END",
              "CASE WHEN doc_id IN (4, 6, 12) THEN lang END"]
    for label in labels:
        given = docs.selectExpr("doc_id", "text", f"{label} AS lang")
        assert language_id.train(given) == b""
        kept = language_id.keep_identified(given)
        assert kept.columns == given.columns
        assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == lettered


def test_languages_in_several_scripts():
    """Alphabets of hundreds of letters beside frequent small ones: rare scripts are told apart by their own letters."""
    rng = np.random.default_rng(2)
    letters = {
        "en": [chr(c) for c in range(0x61, 0x7B)], "el": [chr(c) for c in range(0x3B1, 0x3C2)], "ru": [chr(c) for c in range(0x430, 0x450)],
        "ja": [chr(c) for c in range(0x3041, 0x3097)], "ko": [chr(c) for c in range(0xAC00, 0xAC00 + 400)], "zh": [chr(c) for c in range(0x4E00, 0x4E00 + 400)],
        "zz": [chr(c) for c in range(0x4E00 + 400, 0x4E00 + 800)],
    }
    words = {lang: ["".join(rng.choice(own, 3)) for _ in range(60)] for lang, own in letters.items()}

    def texts(n: int, seed: int) -> tuple[list[str], list[str]]:
        pick = np.random.default_rng(seed)
        langs = [lang for lang in letters for _ in range(n)]
        return [" ".join(pick.choice(words[lang], 400 if lang in ("en", "el", "ru") else 25)) for lang in langs], langs

    given, langs = texts(20, 3)
    blob = language_id.fit(given, langs, landmarks=10)
    more, want = texts(10, 4)
    got, _ = language_id.Model(blob).predict(more)
    assert got == want


def test_binary_search_equals_the_table(monkeypatch):
    given = ["the house of the cat", "das haus und der hund", "дом и кот", "the cat", "der hund", "кот и дом"]
    langs = ["en", "de", "ru"] * 2
    codes = "".join(sorted({c for t in given for c in t if c.isalpha()}))
    blob = language_id.fit(given, langs, landmarks=2)
    tables = language_id.Model(blob)
    monkeypatch.setattr(language_id, "TABLE", 0)
    assert language_id.fit(given, langs, landmarks=2) == blob
    searched = language_id.Model(blob)
    more = [*given, "the дом und x", "", "q", "猫"]
    assert searched.grams.letters == codes
    assert (searched.grams.presence(more) == tables.grams.presence(more)).all()
    # The columns are the n-grams that two texts hold.
    spaced = [f" {t} " for t in given]
    for n in range(1, language_id.GRAMS + 1):
        held = [{t[i:i + n] for i in range(len(t) - n + 1)} for t in spaced]
        assert len(tables.grams.levels[n - 1][0]) == sum(sum(g in h for h in held) >= 2 for g in set().union(*held))


def test_collapsed_matrix_equals_the_kernel_machine():
    """The one matrix gives what landmarks, Nyström map and ridge weights give one after another."""
    rng = np.random.default_rng(1)
    texts = [" ".join(rng.choice(["der", "die", "und", "haus"] if i % 2 else ["the", "and", "house", "of"], 12)) for i in range(40)]
    langs = ["de" if i % 2 else "en" for i in range(40)]
    model = language_id.Model(language_id.fit(texts, langs, landmarks=5))
    got, scores = model.predict(texts + ["the house", "das haus und"])
    assert got == [*langs, "en", "de"] and min(scores) > 0.5


def test_the_stage_keeps_allowed_and_recognised_languages(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    predicted = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify_languages(docs).collect()}
    for languages, least in ((None, 0.0), (("en", "fr"), 0.0), (None, 0.99), (("de",), 0.9), ((), 0.0)):
        kept = language_id.keep_identified(docs, languages, least)
        assert kept.columns == docs.columns
        want = {d for d, (lang, score) in predicted.items() if lang != "und" and score >= least and (languages is None or lang in languages)}
        assert {r.doc_id for r in kept.select("doc_id").collect()} == want
    everything = {d for d, (lang, _) in predicted.items() if lang != "und"}
    assert {r.doc_id for r in language_id.keep_identified(docs).select("doc_id").collect()} == everything
