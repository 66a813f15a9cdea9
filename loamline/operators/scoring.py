"""Scores and clean-ups of texts that built-in functions can't express, behind Arrow functions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import HashingTF, IndexToString, StringIndexer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent words that tell a few languages apart.
STOP_WORDS = {
    "EN": "the and that was with for this from not are his they had",
    "DE": "der die und das nicht mit ist den auf ein eine dem sich",
    "FR": "les des est dans une pour que pas sur avec sont aux cette",
    "ES": "los las una por con para del que como más pero sus este",
    "NL": "het een van dat niet met zijn voor aan ook maar wordt naar",
    "IT": "che non una per con del della sono gli anche più nel alla",
    "PT": "não uma com para dos que mais como foi pelo seu ao das",
}


def _language(text: str) -> tuple[str, float]:
    words = re.findall(r"[^\W\d_]+", text.lower())
    if not words:
        return "", 0.0
    hits = {code: sum(w in own for w in words) / len(words) for code, own in _SETS.items()}
    code = max(sorted(hits), key=hits.get)
    return (code, hits[code] / max(sum(hits.values()), 1e-9)) if hits[code] >= 0.02 else ("", 0.0)


_SETS = {code: set(words.split()) for code, words in STOP_WORDS.items()}


def language_score(text: str | Column, classify: Callable[[str], tuple[str, float]] = _language) -> Column:
    """(score, code) of a text; give another classifier to replace the plain one."""

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([(round(s, 4), c) for c, s in (classify(t) if t else ("", 0.0) for t in texts)], columns=["score", "code"])

    return F.pandas_udf(run, "score double, code string")(text)


def repaired(text: str | Column) -> Column:
    """Text that was decoded twice is set right, compatibility forms are composed and control characters go."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        if re.search("[ÂÃâ][\x80-\xbf€™œ]", t):
            try:
                t = t.encode("cp1252").decode("utf-8")
            except (UnicodeEncodeError, UnicodeDecodeError):
                pass
        t = unicodedata.normalize("NFC", t)
        return "".join(c for c in t if c in "\n\t" or unicodedata.category(c) != "Cc")

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(one)

    return F.pandas_udf(run, "string")(text)


def domains(known: DataFrame, asked: DataFrame, key: str, text: str, label: str, keep: list[str] | None = None, size: int = 1 << 14) -> DataFrame:
    """(key, domain, score) by naive Bayes over hashed words, fitted on ``known``; only the wanted domains stay."""
    ready = lambda d: d.where(F.col(text).isNotNull()).withColumn("__t", F.col(text))
    index = StringIndexer(inputCol=label, outputCol="__y", handleInvalid="skip").fit(ready(known))
    steps = Pipeline(stages=[index, Tokenizer(inputCol="__t", outputCol="__w"), HashingTF(inputCol="__w", outputCol="__f", numFeatures=size), NaiveBayes(featuresCol="__f", labelCol="__y", predictionCol="__p", probabilityCol="__c")])
    fitted = steps.fit(ready(known))
    rows = ready(asked)
    for stage in fitted.stages[1:]:
        rows = stage.transform(rows)
    named = IndexToString(inputCol="__p", outputCol="domain", labels=index.labels).transform(rows).select(key, "domain", F.round(F.array_max(vector_to_array("__c")), 4).alias("score"))
    return named.where(F.col("domain").isin(keep)) if keep else named


def question_pairs(said: Column) -> Column:
    """Generated question and answer pairs, one (question, answer) for each pair that is whole."""
    pairs = F.regexp_extract_all(said, F.lit(r"(?s)(?:Question|Q):\s*(.*?)\s*(?:Answer|A):\s*(.*?)(?=\s*(?:Question|Q):|\s*\z)"), F.lit(0))
    part = lambda p, k: F.regexp_extract(p, r"(?s)(?:Question|Q):\s*(.*?)\s*(?:Answer|A):\s*(.*)$", k)
    made = F.transform(pairs, lambda p: F.struct(part(p, 1).alias("question"), F.trim(part(p, 2)).alias("answer")))
    return F.filter(made, lambda x: (x["question"] != "") & (x["answer"] != ""))


def bullet_items(said: Column) -> Column:
    """The items of a generated list, without their marks."""
    return F.transform(F.filter(F.split(said, "\n"), lambda x: x.rlike(r"^\s*[-*•]\s+\S")), lambda x: F.regexp_replace(x, r"^\s*[-*•]\s+|\s+$", ""))
