"""A classifier trained on labelled rows: hashed words, marks and pairs of them, logistic regression.

Fitting and scoring stay in the JVM: the features are one Spark ML pipeline, the fit is Spark's
distributed optimiser, whose driver holds one number for each feature and label, and scoring is an
expression over whole texts. A fitted model is a stored pipeline, so a second session scores
with the very same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, Normalizer, RegexTokenizer, SQLTransformer, StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.constants import STATUS_OK
from ledgerfold.functions.answers import classification, no_text, readable, text_window
from ledgerfold.operators.classify import tabulate
from ledgerfold.sources.staging import stage

FEATURES = 1 << 18
MAX_LABELS = 1000
# A word of letters and digits of any script, or a run of marks between them.
TOKEN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]+"


class NothingToLearn(ValueError):
    """The labelled rows cannot train a classifier."""


def features(source: str = "_text", buckets: int = FEATURES, pairs: bool = True) -> list:
    """Stages from a text column to `_features`: counts of hashed words and pairs, scaled to length 1."""
    joined = "concat(_words, _pairs)" if pairs else "_words"
    return [
        RegexTokenizer(inputCol=source, outputCol="_words", pattern=TOKEN, gaps=False),
        NGram(n=2, inputCol="_words", outputCol="_pairs"),
        SQLTransformer(statement=f"SELECT *, {joined} AS _terms FROM __THIS__"),
        HashingTF(numFeatures=buckets, inputCol="_terms", outputCol="_counts"),
        Normalizer(inputCol="_counts", outputCol="_features"),
    ]


@dataclass
class Trained:
    """A fitted pipeline from `_text` to `_probability`, and its labels by number."""

    pipeline: PipelineModel
    labels: list[str]

    def save(self, location: str) -> None:
        """Store the pipeline; a location in use is refused."""
        indexer = StringIndexerModel.from_labels(self.labels, inputCol="label", outputCol="_number")
        PipelineModel([indexer, *self.pipeline.stages]).write().save(location)

    @staticmethod
    def load(spark: SparkSession, location: str) -> Trained:
        stored = PipelineModel.load(location)
        return Trained(PipelineModel(stored.stages[1:]), list(stored.stages[0].labels))


def train(
    rows: DataFrame,
    text: str = "text",
    label: str = "label",
    buckets: int = FEATURES,
    pairs: bool = True,
    regularised: float = 1e-4,
    rounds: int = 50,
    balanced: bool = True,
) -> Trained:
    """Fit on all rows (text, label) that have a readable text and a label.

    `balanced` gives every label the same weight in all, however rare it is. Fewer than two labels, or
    more than MAX_LABELS, are refused: the labels are known to every task.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    usable = rows.where(F.col(label).isNotNull() & readable(whole)).select(
        whole.alias("_text"), F.col(label).cast("string").alias("_label")
    )
    prepared = PipelineModel(features(buckets=buckets, pairs=pairs)).transform(usable)
    # The optimiser reads the features once a step: they are stored, and the texts left behind.
    ready = stage(prepared.select("_label", "_features"), "features")
    # At most one row more than may be.
    found = ready.groupBy("_label").agg(F.count("*").alias("n")).limit(MAX_LABELS + 1).collect()
    if not 2 <= len(found) <= MAX_LABELS:
        raise NothingToLearn(f"a classifier needs 2 to {MAX_LABELS} labels, there are {len(found)}")
    counts = {row["_label"]: row["n"] for row in found}
    labels = sorted(counts)
    total = sum(counts.values())
    weights = {at: total / (len(labels) * counts[v]) if balanced else 1.0 for at, v in enumerate(labels)}
    indexer = StringIndexerModel.from_labels(labels, inputCol="_label", outputCol="_number")
    weight = F.create_map(*[F.lit(x) for at, w in weights.items() for x in (float(at), w)])
    numbered = indexer.transform(ready).withColumn("_weight", weight[F.col("_number")])
    optimiser = LogisticRegression(
        featuresCol="_features",
        labelCol="_number",
        weightCol="_weight",
        probabilityCol="_probability",
        rawPredictionCol="_raw",
        predictionCol="_best",
        regParam=regularised,
        maxIter=rounds,
        standardization=False,
        family="multinomial" if len(labels) > 2 else "binomial",
    )
    model = optimiser.fit(numbered)
    return Trained(PipelineModel([*features(buckets=buckets, pairs=pairs), model]), labels)


def classify_trained(
    files: DataFrame,
    model: Trained,
    text: str = "text",
    window: int | None = None,
    hint: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Classify files (path, name, text) with a trained model.

    The confidence is the likeliest label's probability, rounded to two places; of labels that are
    equally likely the first by name wins. Texts that cannot be read are not guessed.
    """
    scored = model.pipeline.transform(
        files.withColumn("_text", text_window(F.coalesce(F.col(text), F.lit("")), window))
    ).withColumn("_shares", vector_to_array("_probability"))
    labels = F.array(*[F.lit(v) for v in model.labels])
    top = F.array_max("_shares")
    answer = classification(
        F.element_at(labels, F.array_position("_shares", top).cast("int")),
        F.round(top, 2),
        F.lit(STATUS_OK),
        F.lit(f"likeliest of {len(model.labels)} trained labels"),
    )
    judged = scored.withColumn("_result", F.when(~readable(F.col("_text")), no_text(F.col("_text"))).otherwise(answer))
    return tabulate(judged, F.col("_text"), "_result", hint, keep)
