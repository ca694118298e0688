"""Language identification by nearest centroid.

A text is a TF-IDF vector of hashed letter trigrams, normalised. Each language has several centroids, found
by clustering a sample; the nearest by cosine gives the language, and a text too far from all
centroids for its length is rejected.

The classifier is fitted on a bounded sample of labelled rows: PER_LANGUAGE texts of each language, those of
smallest hashed identifier, so the sample is the same whatever the partitions. Their sparse vectors come to the
driver, DIMENSIONS entries at most, with the PIECE trigrams at both ends: at most 70 KB a text however long it is, for
PER_LANGUAGE texts a language. Both learning and predicting read whole texts.

Rejection: the sample is dealt into FOLDS parts, and pieces of each part's texts of each length (by powers of two) are
held against a model of the other parts; this gives the cosines that unseen texts of that language and length have. A
text below their lowest LOW is rejected, judged by the language it is nearest to. Where a language has too few pieces to tell
this share, those of all languages of that length count, and where these are too few, those of the next shorter length.
Short texts have low cosines, and are judged by those of other short texts.

Defined results: a null text and one without a letter are `und` with score 0 and rejected; so is every text if
there was nothing to learn from; between equal cosines the language first in order wins; rows without identifier are held
out; rows that repeat are answered each; no rows give no rows; a result column replaces an input column of its name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerfold.sources.batches import bound_batches

PER_LANGUAGE = 400
CENTROIDS = 4
ROUNDS = 10
DIMENSIONS = 1 << 13
LOW = 0.005  # the share of unseen texts of a language that may be rejected
PIECE = 1 << 12  # the longest pieces that rejection is set by
FOLDS = 5
UNDETERMINED = "und"
# ASCII letters and all bytes beyond ASCII stay; the rest become blanks.
_LETTERS = np.array([c if c > 127 or chr(c).isalpha() else 32 for c in range(256)], np.uint8)


def is_held_out(doc_id: Column) -> Column:
    """Every fifth document by the checksum of its identifier is never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def trigrams(text: str) -> np.ndarray:
    """The hashed trigrams of the letters, with a blank at both ends and one between words."""
    letters = _LETTERS[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
    blank = letters == 32
    letters = letters[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint32)
    codes = letters[:-2] | letters[1:-1] << np.uint32(8) | letters[2:] << np.uint32(16)
    return (codes * np.uint32(2654435761)) >> np.uint32(32 - DIMENSIONS.bit_length() + 1)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray  # one row each, normalised
    of: np.ndarray  # the language of each centroid
    least: np.ndarray  # the lowest cosine accepted, by language and the power of two of the number of trigrams

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return normal(np.log1p(counts) * self.idf)

    def nearest(self, grams: np.ndarray) -> tuple[int, float]:
        cosines = self.centroids @ self.vector(np.bincount(grams, minlength=DIMENSIONS))
        best = int(np.argmax(cosines))
        return int(self.of[best]), float(cosines[best])

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return UNDETERMINED, 0.0, True
        grams = trigrams(text)
        if not len(grams):
            return self.languages[0], 0.0, True
        language, cosine = self.nearest(grams)
        score = min(1.0, max(0.0, cosine))
        return self.languages[language], score, score < self.least[language, length_class(len(grams))]


def normal(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=-1, keepdims=True)
    return (rows / np.where(size > 0, size, 1)).astype(np.float32)


def length_class(n: int) -> int:
    return min(int(n).bit_length(), PIECE.bit_length()) - 1


def cluster(rows: np.ndarray, count: int = CENTROIDS) -> np.ndarray:
    """Spherical k-means from the first row and those farthest from the ones before."""
    chosen = [rows[0]]
    while len(chosen) < min(count, len(rows)):
        chosen.append(rows[int(np.argmin(np.max(rows @ np.array(chosen).T, axis=1)))])
    centroids = np.array(chosen)
    for _ in range(ROUNDS):
        nearest = np.argmax(rows @ centroids.T, axis=1)
        centroids = normal(
            np.array([rows[nearest == i].sum(axis=0) if (nearest == i).any() else centroids[i] for i in range(len(centroids))])
        )
    return centroids


@dataclass
class Example:
    language: str
    indices: np.ndarray  # trigrams that occur
    counts: np.ndarray
    start: np.ndarray  # the first and last PIECE trigrams
    end: np.ndarray

    def dense(self) -> np.ndarray:
        return np.bincount(self.indices, self.counts, minlength=DIMENSIONS)


def example(language: str, text: str) -> Example:
    grams = trigrams(text)
    indices, counts = np.unique(grams, return_counts=True)
    return Example(language, indices, counts, grams[:PIECE], grams[-PIECE:])


def fit_centroids(examples: list[Example]) -> Model:
    """A model that rejects nothing; the order of the examples decides between equals."""
    languages = sorted({e.language for e in examples})
    held = np.zeros(DIMENSIONS)
    for e in examples:
        held[e.indices] += 1
    idf = np.log((1 + len(examples)) / (1 + held)) + 1
    least = np.zeros((len(languages), PIECE.bit_length()))
    model = Model(languages, idf, np.zeros((0, DIMENSIONS), np.float32), np.zeros(0, int), least)
    if not languages:
        return model
    found = [
        cluster(np.array([model.vector(e.dense()) for e in examples if e.language == language])) for language in languages
    ]
    model.centroids, model.of = np.concatenate(found), np.repeat(np.arange(len(found)), [len(f) for f in found])
    return model


def lowest(cosines: list[float]) -> float | None:
    """What LOW of unseen texts are expected to lie below; None if there are too few to tell."""
    rank = int(LOW * (len(cosines) + 1))
    return sorted(cosines)[rank - 1] if rank else None


def fit(examples: list[Example]) -> Model:
    """A model of the examples; their order decides between equals."""
    examples = [e for e in examples if len(e.indices)]
    model = fit_centroids(examples)
    classes = PIECE.bit_length()
    found: list[list[list[float]]] = [[[] for _ in range(classes)] for _ in model.languages]
    for fold in range(FOLDS):
        others = fit_centroids([e for i, e in enumerate(examples) if i % FOLDS != fold])
        for e in examples[fold::FOLDS]:
            if e.language not in others.languages:
                continue
            for at in range(min(classes, len(e.start).bit_length())):
                pieces = (e.start[: 1 << at], e.end[-(1 << at) :])
                found[model.languages.index(e.language)][at] += [others.nearest(p)[1] for p in pieces]
    for at in range(classes):
        pooled = lowest([c for of in found for c in of[at]])
        for language, of in enumerate(found):
            own = lowest(of[at])
            shorter = model.least[language, at - 1] if at else 0.0
            model.least[language, at] = next(x for x in (own, pooled, shorter) if x is not None)
    return model


_EXAMPLE = "lang string, mark long, indices binary, counts binary, first binary, last binary"


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [example("", text.as_py()) for text in batch.column(2)]
        fields = [
            pa.array([getattr(e, name).astype("<u4").tobytes() for e in made], pa.binary())
            for name in ("indices", "counts", "start", "end")
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *fields], names=["lang", "mark", "indices", "counts", "first", "last"]
        )


def learn(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fits the bounded sample of the documents with a language that aren't held out."""
    known = docs.where(F.col("lang").isNotNull() & ~is_held_out(F.col("doc_id"))).select(
        "lang", F.xxhash64("doc_id").alias("mark"), "text"
    )
    first = Window.partitionBy("lang").orderBy("mark")
    # Identifiers alone decide, so texts of others are neither sorted nor moved.
    marks = known.select("lang", "mark").withColumn("at", F.row_number().over(first)).where(F.col("at") <= per_language)
    last = marks.groupBy(F.col("lang").alias("of")).agg(F.max("mark").alias("last"))
    # One row a language, of which the model that is broadcast holds several centroids each.
    sample = known.join(F.broadcast(last), (F.col("lang") == F.col("of")) & (F.col("mark") <= F.col("last"))).where("text IS NOT NULL")
    limited = sample.select("lang", "mark", "text").withColumn("at", F.row_number().over(first)).where(
        F.col("at") <= per_language
    )
    rows = [tuple(row) for row in limited.select("lang", "mark", "text").mapInArrow(_examples, _EXAMPLE).collect()]
    rows.sort(key=lambda row: (*row[:2], *map(bytes, row[2:])))
    return fit([Example(row[0], *(np.frombuffer(part, "<u4") for part in row[2:])) for row in rows])


def identify(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """docs with lang_pred, score and rejected; all that a prediction reads is the text."""
    shared = spark.sparkContext.broadcast(model)
    wanted = [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("rejected", T.BooleanType()),
    ]
    taken = {field.name for field in wanted}
    kept = [field for field in docs.schema.fields if field.name.lower() not in taken]
    names = [*(field.name for field in kept), *(field.name for field in wanted)]

    def batches(given: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in given:
            found = [shared.value.predict(text.as_py()) for text in batch.column(batch.num_columns - 1)]
            made = [
                pa.array([f[i] for f in found], kind)
                for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *made], names=names)

    given = docs.select(*[F.col(f"`{field.name}`") for field in kept], F.col("text").alias("__text"))
    bound_batches(spark)
    return given.mapInArrow(batches, T.StructType([*kept, *wanted]))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents that a model learnt from docs does not reject, with the columns of docs."""
    clear = docs.select(F.struct("*").alias("row"), "doc_id", "lang", "text")
    return identify(docs.sparkSession, clear.select("row", "text"), learn(clear)).where("NOT rejected").select("row.*")
