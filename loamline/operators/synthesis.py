"""Generated columns, translation of questions, their scores, and small models."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Imputer, Normalizer, OneHotEncoder, StandardScaler, StringIndexer, Tokenizer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def generated(df: DataFrame, key: str, prompt: str, client: Callable[[list[str]], list[str]], name: str = "made", batch: int = 32) -> DataFrame:
    """``df``'s (key, prompt) with what a client makes of each prompt; null prompts and answers are dropped.

    The client is called with a batch of prompts at a time inside the workers; give one that can be pickled.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            said = b.column(1).to_pylist()
            made: list[str | None] = []
            for at in range(0, len(said), batch):
                made += client(said[at : at + batch])
            kept = pa.array([i for i, m in enumerate(made) if m is not None], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(kept), b.column(1).take(kept), pa.array([m for m in made if m is not None], pa.string())], names=[key, prompt, name])

    return df.where(F.col(prompt).isNotNull()).select(key, prompt).mapInArrow(run, f"`{key}` {kind}, `{prompt}` string, `{name}` string")


def flat_questions(questions: DataFrame) -> DataFrame:
    """(question_id, kind, pos, said): a row for the question and for each of its choices."""
    asked = questions.select("question_id", F.lit("question").alias("kind"), F.lit(0).alias("pos"), F.col("question").alias("said"))
    return asked.unionAll(questions.select("question_id", F.lit("choice"), F.posexplode("options").alias("pos", "said")))


def translated_questions(questions: DataFrame, client: Callable[[list[str]], list[str]]) -> DataFrame:
    """Questions whose texts went through a client one by one and are put together again; only whole ones stay."""
    flat = flat_questions(questions).withColumn("id", F.concat_ws("#", "question_id", "kind", "pos"))
    done = flat.join(generated(flat, "id", "said", client).select("id", "made"), "id")
    whole = done.groupBy("question_id").agg(F.max(F.when(F.col("kind") == "question", F.col("made"))).alias("question"), F.sort_array(F.collect_list(F.when(F.col("kind") == "choice", F.struct("pos", "made")))).alias("c"))
    sizes = questions.select("question_id", F.size("options").alias("n"), "answer_index")
    return whole.join(sizes, "question_id").where("question IS NOT NULL AND size(c) = n").select("question_id", "question", F.transform("c", lambda x: x["made"]).alias("options"), "answer_index")


def seed_prompt(subject: Column, question: Column, choices: Column) -> Column:
    lettered = F.transform(choices, lambda o, i: F.concat(F.lit("("), F.char(F.lit(65) + i), F.lit(") "), o))
    return F.concat(F.lit("Subject: "), F.coalesce(subject, F.lit("-")), F.lit("\n"), question, F.lit("\n"), F.array_join(lettered, "\n"))


def _grams(items, n: int) -> Counter:
    return Counter(tuple(items[i : i + n]) for i in range(len(items) - n + 1))


def bleu_score(said: str, reference: str) -> float:
    """BLEU of one pair in percent, up to four words, with add-one smoothing beyond the first."""
    a, b = said.split(), reference.split()
    if not a or not b:
        return 0.0
    total = 0.0
    for n in range(1, 5):
        x, y = _grams(a, n), _grams(b, n)
        hit, all_ = sum((x & y).values()), sum(x.values())
        hit, all_ = (hit, all_) if n == 1 else (hit + 1, all_ + 1)
        if not hit or not all_:
            return 0.0
        total += math.log(hit / all_) / 4
    return 100 * math.exp(min(0.0, 1 - len(b) / len(a)) + total)


def chrf_score(said: str, reference: str, most: int = 6, beta: float = 2.0) -> float:
    """chrF of one pair in percent: F-score of character runs of up to six, recall counting twice."""
    a, b = "".join(said.split()), "".join(reference.split())
    precision, recall, k = 0.0, 0.0, 0
    for n in range(1, most + 1):
        x, y = _grams(a, n), _grams(b, n)
        if not x or not y:
            continue
        hit = sum((x & y).values())
        precision, recall, k = precision + hit / sum(x.values()), recall + hit / sum(y.values()), k + 1
    if not k or not precision + recall:
        return 0.0
    p, r = precision / k, recall / k
    return 100 * (1 + beta**2) * p * r / (beta**2 * p + r)


def ter_score(said: str, reference: str) -> float:
    """Edits of words per word of the reference, in percent; without shifts."""
    a, b = said.split(), reference.split()
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return 100 * row[-1] / max(1, len(b))


def _scored(score: Callable[[str, str], float], said: str, reference: str) -> Column:
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else round(score(x, y), 4) for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(run, "double")(said, reference)


def bleu(said: str, reference: str) -> Column:
    return _scored(bleu_score, said, reference)


def chrf(said: str, reference: str) -> Column:
    return _scored(chrf_score, said, reference)


def ter(said: str, reference: str) -> Column:
    return _scored(ter_score, said, reference)


def hashed_embeddings(df: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(key, embedding): hashed words weighed by their rarity, of unit length."""
    rows = df.where(F.col(text).isNotNull()).select(key, F.col(text).alias("t"))
    steps = Pipeline(stages=[Tokenizer(inputCol="t", outputCol="w"), HashingTF(inputCol="w", outputCol="f", numFeatures=size), IDF(inputCol="f", outputCol="i"), Normalizer(inputCol="i", outputCol="e")])
    return steps.fit(rows).transform(rows).select(key, vector_to_array("e").alias("embedding"))


def classified(known: DataFrame, asked: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, score, label): the chance of the label by a logistic regression."""
    ready = lambda d: d.select(key, F.col(label).alias("label"), array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"))
    model = LogisticRegression(maxIter=50, regParam=0.01).fit(ready(known))
    return model.transform(ready(asked)).select(key, F.round(vector_to_array("probability")[1], 6).alias("score"), "label")


def regressed(rows: DataFrame, numbers: list[str], kinds: list[str], target: str, held: str) -> DataFrame:
    """(rows, rmse, mae): errors of a linear regression on the rows that are held out."""
    steps = [Imputer(inputCols=numbers, outputCols=[f"{c}_n" for c in numbers])]
    steps += [StringIndexer(inputCols=kinds, outputCols=[f"{c}_i" for c in kinds], handleInvalid="keep"), OneHotEncoder(inputCols=[f"{c}_i" for c in kinds], outputCols=[f"{c}_o" for c in kinds], handleInvalid="keep")]
    steps += [VectorAssembler(inputCols=[f"{c}_n" for c in numbers] + [f"{c}_o" for c in kinds], outputCol="raw"), StandardScaler(inputCol="raw", outputCol="features"), LinearRegression(labelCol=target, regParam=0.001)]
    model = Pipeline(stages=steps).fit(rows.where(f"NOT `{held}`"))
    gap = F.col("prediction") - F.col(target)
    return model.transform(rows.where(held)).agg(F.count("*").alias("rows"), F.round(F.sqrt(F.avg(gap * gap)), 4).alias("rmse"), F.round(F.avg(F.abs(gap)), 4).alias("mae"))
