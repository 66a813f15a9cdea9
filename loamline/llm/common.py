"""What several of the operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.session import cut

#: A word: a run of letters and digits.
WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """The words of ``text`` in order, lower-cased."""
    joined = "\n".join(WORD.findall(text)).lower()
    return joined.split("\n") if joined else []


def once(df: DataFrame, key: str, *also: str) -> DataFrame:
    """``df`` with one row for each value of ``key`` (and of ``also``).

    Rows delivered twice count once. Rows whose key is null can't be told apart from rows that
    were never delivered before, so each of them stays. Which of several rows with one key stays
    is left open; delivered twice means that they are the same.
    """
    apart = "__null_key"
    marked = df.withColumn(apart, F.when(F.col(key).isNull(), F.monotonically_increasing_id()))
    # A number of partitions that is given isn't made smaller: work in Python mostly follows.
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.sparkSession.sparkContext.defaultParallelism)
    return marked.repartition(parts, key, *also, apart).dropDuplicates([key, *also, apart]).drop(apart)


def small(df: DataFrame, rows: int = 500_000) -> DataFrame:
    """``df``, a narrow frame of a few numbers a row, written once; to be broadcast if it has at most ``rows`` rows, else to be joined as it comes."""
    kept = cut(df)
    return F.broadcast(kept) if kept.count() <= rows else kept


#: The words of a column in SQL.
WORDS_SQL = r"regexp_extract_all(lower({}), '[\p{{L}}\p{{N}}]+')"


def blank(text: Column) -> Column:
    return text.isNull() | ~text.rlike(r"\S")
