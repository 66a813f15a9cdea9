"""Multiple-choice questions."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _two_means(choices: list[str], answer: int, rounds: int = 20) -> int:
    """How many other choices are in the answer's cluster of two."""
    v = np.array([[len(c), c.count(" "), sum(map(ord, c)) / max(1, len(c)) / 16] for c in choices], float)
    if not 0 <= answer < len(v):
        return -1
    far = np.linalg.norm(v[:, None] - v[None], axis=2)
    centres = v[list(np.unravel_index(far.argmax(), far.shape))]
    for _ in range(rounds):
        own = np.linalg.norm(v[:, None] - centres[None], axis=2).argmin(axis=1)
        new = np.array([v[own == k].mean(axis=0) if (own == k).any() else centres[k] for k in (0, 1)])
        if np.allclose(new, centres):
            break
        centres = new
    return int((own == own[answer]).sum()) - 1


def choice_neighbours(questions: DataFrame, key: str, choices: str, answer_index: str, least: int = 1) -> DataFrame:
    """(key, neighbours, outlier): an answer with fewer than ``least`` choices like it gives itself away."""

    def run(listed: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series([_two_means(list(c), int(a)) if c is not None and a == a else -1 for c, a in zip(listed, at)], dtype="int32")

    near = F.pandas_udf(run, "int")(choices, answer_index)
    return questions.select(key, near.alias("neighbours")).withColumn("outlier", F.col("neighbours") < least)
