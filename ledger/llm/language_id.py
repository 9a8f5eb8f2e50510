"""Language identification with a string kernel.

*Kernel.*  A text is the set of its n-grams of one to four characters (lower-cased letters; everything else is one blank).  The blended-spectrum presence
kernel of two texts counts the n-grams they share, divided by the root of the product of their numbers.  Its feature space are the n-grams
that at least two landmarks hold.
*Fit.*  ``PER_LANGUAGE`` labelled documents of each language (those with the smallest hashes) are the training set, the first ``LANDMARKS`` of each the Nyström
landmarks; one-versus-rest ridge regression runs on the Nyström features.  That bounded sample is a parameter; it is trained in one task.
*Scores.*  Kernel values are linear in the presence vector, so landmarks, Nyström map and ridge weights multiply to one matrix; documents are scored by batched
matrix products of presence rows with it.  ``score`` is the softmax of the winning output.

Defined results: ``und`` with score 0 for null texts, texts without a letter, or where nothing could be learned; a null id is the text ''
for the fold; null labels are never learned from; empty tables give an empty result.
"""

from __future__ import annotations

import io
import zlib
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from ledger.llm.common import named

FOLDS = 5
PER_LANGUAGE = 300
LANDMARKS = 64
RIDGE = 1e-4
SHARPNESS = 6.0
GRAMS = 4
#: The most keys of one n-gram length that are looked up in a table.
TABLE = 1 << 24
BATCH_CHARS = 1 << 19
BATCH_TEXTS = 64
_LETTER = regex.compile(r"\p{L}")
NONE = "und"


def lettered(text: str | None) -> bool:
    return bool(text and _LETTER.search(text))


def fold(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


class Grams:
    """Codes of characters and numbers of n-grams.

    ``letters`` are all letters of the training sample, of any script, each with a code of its own; letters outside it are in no feature and share
    code 1.  The first characters of a feature are a feature themselves, so an n-gram is keyed by the number of its beginning and its last
    code; that stays below 2^63 for any alphabet.  Keys are looked up in a table where a small one holds all of them, else by binary search.
    """

    def __init__(self, letters: str, keys: list[np.ndarray]) -> None:
        self.letters = letters
        self.base = len(letters) + 2
        self.codes = np.full(0x110000, -1, np.int32)
        self.codes[[ord(char) for char in letters]] = np.arange(2, self.base)
        self.levels: list[tuple[np.ndarray, np.ndarray | None]] = []
        self.width = 0
        for known in keys:
            self.add(known)

    def add(self, known: np.ndarray) -> None:
        """The features one character longer than those so far, as sorted keys."""
        room, numbers = ((len(self.levels[-1][0]) if self.levels else 0) + 1) * self.base, None
        if room <= TABLE:
            # Numbers of n-grams from 1 on, 0 for those that are no feature; two bytes each where that is enough.
            numbers = np.zeros(room, np.uint16 if len(known) < 1 << 16 else np.int32)
            numbers[known] = 1 + np.arange(len(known))
        self.levels.append((known, numbers))
        self.width += len(known)

    def coded(self, text: str) -> np.ndarray:
        """Character codes with a blank at both ends; runs of other characters become one blank."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.codes[points]
        for point in np.unique(points[codes < 0]).tolist():
            self.codes[point] = 1 if chr(point).isalpha() else 0
        codes = self.codes[points]
        codes = np.concatenate(([0], codes, [0])).astype(np.int64)
        return codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]

    def keys(self, codes: np.ndarray, begin: np.ndarray | None, n: int) -> np.ndarray:
        """Keys of the n-grams at every place, given the numbers of those one shorter (0: no feature)."""
        return codes if begin is None else begin[:max(0, len(codes) - n + 1)].astype(np.int64) * self.base + codes[n - 1:]

    def numbered(self, codes: np.ndarray) -> Iterator[np.ndarray]:
        """For each length the number of the n-gram at every place, 0 where it is no feature."""
        begin = None
        for n, (known, numbers) in enumerate(self.levels, 1):
            key = self.keys(codes, begin, n)
            if numbers is not None:
                found = numbers[key]
            elif len(known):
                place = np.minimum(np.searchsorted(known, key), len(known) - 1)
                found = np.where(known[place] == key, place + 1, 0)
            else:
                found = np.zeros(len(key), np.int64)
            # What begins with no feature is none: its key would be that of a blank beginning otherwise.
            begin = found if begin is None else np.where(begin[:len(found)] > 0, found, 0)
            yield begin

    def longer(self, codes: np.ndarray) -> np.ndarray:
        """Distinct keys one character longer than the features so far."""
        begin = None
        for begin in self.numbered(codes):
            pass
        key = self.keys(codes, begin, len(self.levels) + 1)
        return np.unique(key if begin is None else key[begin[:len(key)] > 0])

    def presence(self, texts: list[str]) -> np.ndarray:
        """A row per text, a column per n-gram: whether it occurs.  Texts of any length are read in slices."""
        out = np.zeros((len(texts), self.width), bool)
        for row, text in zip(out, texts, strict=True):
            codes = self.coded(text)
            for at in range(0, len(codes), BATCH_CHARS):
                part, offset = codes[at:at + BATCH_CHARS + GRAMS - 1], 0
                for (known, _), found in zip(self.levels, self.numbered(part), strict=True):
                    held = np.zeros(len(known) + 1, bool)
                    held[found] = True
                    row[offset:offset + len(known)] |= held[1:]
                    offset += len(known)
        return out


def _kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.float32), b.astype(np.float32)
    scale = np.sqrt(np.maximum(a.sum(1), 1))[:, None] * np.sqrt(np.maximum(b.sum(1), 1))[None]
    return (a @ b.T / scale).astype(np.float64)


def fit(texts: list[str], langs: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE) -> bytes:
    """Train on labelled texts; the model as bytes."""
    keep = [i for i, t in enumerate(texts) if _LETTER.search(t)]
    texts, langs = [texts[i] for i in keep], [langs[i] for i in keep]
    known = sorted(set(langs))
    if not known:
        return b""
    letters = "".join(sorted({char for text in texts for char in text.lower() if char.isalpha()}))
    chosen = [i for lang in known for i in [j for j, own in enumerate(langs) if own == lang][:landmarks]]
    least = min(2, len(chosen))
    grams, keys = Grams(letters, []), []
    coded = [grams.coded(texts[i]) for i in chosen]
    for _ in range(GRAMS):
        found, often = np.unique(np.concatenate([grams.longer(codes) for codes in coded]), return_counts=True)
        keys.append(found[often >= least])
        grams.add(keys[-1])
    presence = grams.presence(texts)
    marks = presence[chosen]
    values, vectors = np.linalg.eigh(_kernel(marks, marks))
    good = values > values.max() * 1e-6
    root = vectors[:, good] / np.sqrt(values[good])
    features = _kernel(presence, marks) @ root
    targets = np.array([[1.0 if own == lang else -1.0 for lang in known] for own in langs])
    offset, centre = targets.mean(0), features.mean(0)
    centred = features - centre
    weights = np.linalg.solve(centred.T @ centred + ridge * len(texts) * np.eye(centred.shape[1]), centred.T @ (targets - offset))
    scaled = marks.astype(np.float64) / np.sqrt(np.maximum(marks.sum(1), 1))[:, None]
    out = io.BytesIO()
    np.savez(out, matrix=(scaled.T @ (root @ weights)).astype(np.float32), bias=offset - centre @ weights,
             letters=np.array([letters]), langs=np.array(known), **{f"keys{n}": k for n, k in enumerate(keys, 1)})
    return out.getvalue()


class Model:
    def __init__(self, blob: bytes) -> None:
        with np.load(io.BytesIO(blob)) as held:
            self.matrix, self.bias, self.langs = held["matrix"], held["bias"], held["langs"].tolist()
            self.grams = Grams(str(held["letters"][0]), [held[f"keys{n}"] for n in range(1, GRAMS + 1)])

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        langs, scores = [NONE] * len(texts), [0.0] * len(texts)
        told = [i for i, t in enumerate(texts) if lettered(t)]
        for at in range(0, len(told), BATCH_TEXTS):
            rows = told[at:at + BATCH_TEXTS]
            presence = self.grams.presence([texts[i] for i in rows])
            size = np.sqrt(np.maximum(presence.sum(1), 1))
            outputs = presence.astype(np.float32) @ self.matrix / size[:, None] + self.bias
            power = np.exp(SHARPNESS * (outputs - outputs.max(1, keepdims=True)))
            best = outputs.argmax(1)
            for i, b, p in zip(rows, best.tolist(), (power.max(1) / power.sum(1)).tolist(), strict=True):
                langs[i], scores[i] = self.langs[b], p
        return langs, scores


_models: dict[int, Model] = {}


def _model(blob: bytes) -> Model:
    key = zlib.crc32(blob)
    if key not in _models:
        _models.clear()
        _models[key] = Model(blob)
    return _models[key]


def train(docs: DataFrame, folds: int = FOLDS, per_language: int = PER_LANGUAGE) -> bytes:
    """Fit on the documents outside fold 0.

    Language counts give each language a hash threshold that lets through about four times the sample, so the window that
    picks the exact sample stays small however large the table is.
    """
    hashed = F.pmod(F.xxhash64(named("doc_id"), named("text")), F.lit(1 << 40))
    rows = (
        docs.filter(named("lang").isNotNull() & named("text").isNotNull() & (fold(named("doc_id"), folds) != 0))
        .select(named("lang").alias("_lang"), named("text").alias("_text"), hashed.alias("_h"))
    )
    counts = {r["_lang"]: r["n"] for r in rows.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return b""
    limit = F.lit(0).cast("long")
    for lang, n in sorted(counts.items()):
        limit = F.when(F.col("_lang") == lang, F.lit(int((1 << 40) * min(1.0, 4 * per_language / n)) + 1)).otherwise(limit)
    place = F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_text"))
    sample = rows.filter(F.col("_h") < limit).withColumn("_rn", place).filter(F.col("_rn") <= per_language).select("_lang", "_text", "_rn")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        held.sort(key=lambda r: (r[0], r[2]))
        yield pa.RecordBatch.from_arrays([pa.array([fit([r[1] for r in held], [r[0] for r in held])], pa.binary())], ["model"])

    return bytes(sample.repartition(1).mapInArrow(run, "model binary").first()["model"])


def predict(docs: DataFrame, model: bytes, unlearned: str = NONE) -> DataFrame:
    """``docs`` with ``_llm_lang`` and ``_llm_score``; needs only the column ``text``.

    Without a model, texts that hold a letter get ``unlearned``.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with dots do not pass through Arrow
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            langs, scores = _model(model).predict(texts) if model else ([unlearned if lettered(t) else NONE for t in texts], [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*batch.schema.names, "lang", "score"])

    schema = StructType(list(plain.schema.fields)).add("lang", StringType()).add("score", DoubleType())
    return plain.mapInArrow(run, schema).toDF(*docs.columns, "_llm_lang", "_llm_score")


def identify_languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    rows = docs.select(named("doc_id").alias("doc_id"), named("text").alias("text"))
    return predict(rows, train(docs)).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), F.col("_llm_lang").alias("lang_pred"), F.col("_llm_score").alias("score"))


#: Score below which a language does not count as recognised; an even spread over four languages scores a quarter.
LEAST_SCORE = 0.35


def keep_identified(docs: DataFrame, languages: Collection[str] | None = None, least_score: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs`` in a recognised language; all columns kept.

    A row goes if its text holds no letter, if the predicted language scores less than ``least_score``, or if it is not one of
    ``languages`` (None: all that were learned).  Where no model could be fitted (no label outside fold 0, or none on a text
    with a letter), no language is known and the letter decides alone.
    """
    model = train(docs)
    kept = F.col("_llm_lang") != NONE
    if model:
        kept &= F.col("_llm_score") >= least_score
        if languages is not None:
            kept &= F.col("_llm_lang").isin(list(languages))
    return predict(docs, model, unlearned="").filter(kept).select(*[named(c) for c in docs.columns])
