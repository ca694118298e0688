"""Classification from text alone: the name and the folder never reach the model."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerfold.constants import LABELS, STATUS_OK
from ledgerfold.functions.answers import (
    no_text,
    parse_answer,
    readable,
    text_window,
)
from ledgerfold.functions.paths import folder_hint
from ledgerfold.functions.text import sql_text
from ledgerfold.operators.skew import attach_groups
from ledgerfold.sources.staging import stage

# Words that speak for a label, for use where no model is given.
BUSINESS_WORDS = {
    "invoice": ("invoice", "bill", "amount", "due", "vendor", "payment", "usd"),
    "contract": ("agreement", "contract", "amendment", "parties", "party", "term", "clause"),
    "correspondence": ("from", "subject", "re", "hi", "regards", "thanks", "email"),
    "report": ("report", "period", "summary", "quarter", "forecast", "revenue", "expenses"),
}

ROUND_TEXTS = 100_000

Predict = Callable[[list[str]], "list[str | Exception]"]


class ModelUnavailable(RuntimeError):
    """The model cannot be reached at all; the job stops instead of recording errors."""


def tabulate(
    df: DataFrame, text: Column, result: str, hint: Column | None, keep: Sequence[str]
) -> DataFrame:
    hint = folder_hint(F.col("path")) if hint is None else hint
    return df.withColumns(
        {"chars": F.length(text).cast("bigint"), "folder_hint": hint}
    ).selectExpr(
        "path",
        "name",
        "chars",
        f"{result}.label AS label",
        f"{result}.confidence AS confidence",
        "folder_hint",
        f"{result}.status AS status",
        f"{result}.reason AS reason",
        *[f"`{c}`" for c in keep],
    )


def _asking(predict: Predict):
    """A column function from texts to raw answers and names of failures; null texts are not asked."""

    @F.pandas_udf("answer STRING, error STRING")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            asked = texts.dropna()
            replies = predict(list(asked)) if len(asked) else []
            if len(replies) != len(asked):
                raise ModelUnavailable(f"{len(replies)} answers for {len(asked)} texts")
            failed = [type(r).__name__ if isinstance(r, Exception) else None for r in replies]
            answers = [None if isinstance(r, Exception) else r for r in replies]
            out = pd.DataFrame({"answer": answers, "error": failed}, index=asked.index, dtype=object)
            yield out.reindex(texts.index)

    return ask


def classify_batch(
    files: DataFrame,
    predict: Predict,
    labels: Sequence[str] = LABELS,
    text: str = "text",
    window: int | None = None,
    hint: Column | None = None,
    keep: Sequence[str] = (),
    store: str | None = None,
) -> DataFrame:
    """Classify files (path, name, text) with a model that answers in JSON.

    `predict` gets a list of texts and returns one raw answer per text, or an
    exception for a text it failed on, which becomes a model_error row. It
    raises to stop the job. Only the text column crosses to Python. Columns in
    `keep` are carried along, so a manifest and its labels can come from one pass.

    With `store`, a location kept for one model, equal texts are asked once, and answers outlive
    the run: see stored_answers().
    """
    seen = text_window(F.coalesce(F.col(text), F.lit("")), window)
    given = files.withColumn("_text", seen)
    if store is None:
        asked = given.withColumn("_reply", _asking(predict)(F.when(readable(F.col("_text")), F.col("_text"))))
    else:
        asked = _with_stored(given, predict, store)
    judged = asked.withColumn(
        "_result",
        F.when(~readable(F.col("_text")), no_text(F.col("_text"))).otherwise(
            parse_answer(F.col("_reply.answer"), F.col("_reply.error"), labels)
        ),
    )
    return tabulate(judged, F.col("_text"), "_result", hint, keep)


ANSWERS = "key STRING, answer STRING, error STRING"


def read_answers(spark: SparkSession, store: str) -> DataFrame:
    """(key, answer, error) of all finished rounds, one row a key."""
    try:
        answers = spark.read.schema(ANSWERS).parquet(store)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        answers = spark.createDataFrame([], ANSWERS)
    return answers.dropDuplicates(["key"])


def stored_answers(texts: DataFrame, predict: Predict, store: str, round_texts: int = ROUND_TEXTS) -> DataFrame:
    """(key, answer, error) for every text of `texts` (text), where the key is the text's SHA-256.

    Texts without an answer in the store are asked, each once however many rows hold it, in
    rounds of about `round_texts`. A round's answers are added to the store when it is finished, so
    a run that breaks off loses one round at most and the next one goes on from there. Failures on
    a text are answers too. The store's rows are never changed.
    """
    spark = texts.sparkSession
    keyed = texts.select(F.sha2("text", 256).alias("key"), "text")
    missing = keyed.join(read_answers(spark, store), "key", "left_anti")
    # Copies of a text are combined before the shuffle.
    once = missing.groupBy("key").agg(F.first("text").alias("text"))
    waiting = stage(once, "texts-to-ask")
    rounds = -(-waiting.count() // round_texts)
    for at in range(rounds):
        some = waiting.where(F.pmod(F.xxhash64("key"), F.lit(rounds)) == at)
        replies = some.select("key", _asking(predict)("text").alias("reply")).select("key", "reply.answer", "reply.error")
        replies.write.mode("append").parquet(store)
    return read_answers(spark, store)


def _with_stored(given: DataFrame, predict: Predict, store: str) -> DataFrame:
    can = readable(F.col("_text"))
    asking = given.where(can).withColumn("_key", F.sha2("_text", 256))
    answers = stored_answers(given.where(can).select(F.col("_text").alias("text")), predict, store)
    sizes = asking.groupBy("_key").agg(F.count("*").alias("_copies"))
    replies = sizes.join(answers.withColumnRenamed("key", "_key"), "_key").select(
        "_key", "_copies", F.struct("answer", "error").alias("_reply")
    )
    # One text may be that of a third of all files.
    answered = attach_groups(asking, replies, "_key", "_copies", "path").drop("_key", "_copies")
    none = F.lit(None).cast("struct<answer:string,error:string>")
    return answered.unionByName(given.where(~can).withColumn("_reply", none))


# Letters a word is made of, after lower-casing; all else parts words.
LETTERS = "[a-zà-ÿ]"


def keyword_hits(text: Column, words: Iterable[str]) -> Column:
    """Every whole-word occurrence of one of the words, found in one pass over the text."""
    pattern = f"(?<!{LETTERS})(?:{'|'.join(map(re.escape, words))})(?!{LETTERS})"
    return F.regexp_extract_all(F.lower(text), F.lit(pattern), F.lit(0))


def classify_keyword(
    files: DataFrame,
    words: Mapping[str, Sequence[str]] = BUSINESS_WORDS,
    text: str = "text",
    window: int | None = None,
    hint: Column | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Classify files (path, name, text) by counting words that speak for a label.

    Ties go to the label that comes first by name; no hit at all means `other`.
    The confidence is the label's share of all hits, rounded half up to two
    places in whole numbers. Everything stays in generated code.
    """
    labels = sorted(words)
    every_word = [word for label in labels for word in words[label]]
    counted = (
        files.withColumn("_text", text_window(F.coalesce(F.col(text), F.lit("")), window))
        .withColumn("_found", keyword_hits(F.col("_text"), every_word))
        .selectExpr(
            "*",
            *[
                f"CAST(size(filter(_found, w -> w IN ({', '.join(map(sql_text, words[label]))}))) "
                f"AS BIGINT) AS _hits_{at}"
                for at, label in enumerate(labels)
            ],
        )
    )
    scores = [f"_hits_{at}" for at in range(len(labels))]
    counted = counted.selectExpr(
        "*", f"greatest({', '.join(scores)}) AS _top", f"{' + '.join(scores)} AS _all"
    )
    winner = " ".join(f"WHEN _hits_{at} = _top THEN {sql_text(label)}" for at, label in enumerate(labels))
    answer = f"""named_struct(
        'label', CASE WHEN _top = 0 THEN 'other' {winner} END,
        'confidence', IF(_all = 0, 0.0D, ((_top * 200 + _all) DIV greatest(_all * 2, 1)) / 100.0D),
        'status', '{STATUS_OK}',
        'reason', concat(_top, ' of ', _all, ' keyword hits'))"""
    judged = counted.withColumn(
        "_result",
        F.when(~readable(F.col("_text")), no_text(F.col("_text"))).otherwise(
            F.expr(answer)
        ),
    )
    return tabulate(judged, F.col("_text"), "_result", hint, keep)
