"""Joins that Spark has no operator for, and kinds of joins that need care."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def drop_listed(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not listed; rows with a null key stay."""
    return df.join(listed.select(key).distinct(), key, "left_anti")


def mark_listed(df: DataFrame, listed: DataFrame, key: str, mark: str = "listed") -> DataFrame:
    """A flag that is never null: whether the key is listed."""
    flags = listed.select(key).where(F.col(key).isNotNull()).distinct().withColumn(mark, F.lit(True))
    return df.join(flags, key, "left").withColumn(mark, F.coalesce(mark, F.lit(False)))


def all_or_nothing(parts: DataFrame, lookup: DataFrame, owner: str, keys: list[str], value: str) -> DataFrame:
    """(owner, values): the values of an owner's parts in order of the keys, for owners all of whose parts are found."""
    joined = parts.join(lookup.select(*keys, value), keys, "left")
    grouped = joined.groupBy(owner).agg(F.count("*").alias("n"), F.count(value).alias("found"), F.sort_array(F.collect_list(F.struct(*keys, value))).alias("v"))
    return grouped.where("n = found").select(owner, F.transform("v", lambda x: x[value]).alias("values"))


def at_positions(df: DataFrame, target: DataFrame, position: str, order: str) -> DataFrame:
    """Rows with the row of ``target`` at a position counted from 0; positions out of range are dropped."""
    numbered = target.withColumn(position, (F.row_number().over(Window.orderBy(order)) - 1).cast("bigint"))
    return df.join(numbered, position)


def range_join(left: DataFrame, right: DataFrame, key: str, span: int, left_span: tuple[str, str] = ("start", "end"), right_span: tuple[str, str] = ("start", "end")) -> DataFrame:
    """Pairs of half-open intervals of one key that overlap.

    The axis is cut into bins of ``span``; an interval is copied into each bin it touches, the bins are
    joined by equality, and a pair counts in the bin where the later one of the two starts. A long
    interval costs one copy for each bin; choose ``span`` near the usual length.
    """
    ls, le = left_span
    rs, re = right_span
    bins = lambda s, e: F.explode(F.sequence(F.floor(F.col(s) / span), F.floor(F.greatest(F.col(s), F.col(e) - 1) / span)))
    a = left.withColumn("__bin", bins(ls, le))
    b = right.withColumnsRenamed({rs: "__rs", re: "__re"} if (rs, re) == (ls, le) else {}).withColumn("__bin", bins("__rs", "__re") if (rs, re) == (ls, le) else bins(rs, re))
    bs, be = ("__rs", "__re") if (rs, re) == (ls, le) else (rs, re)
    met = a.join(b, [key, "__bin"]).where((F.col(ls) < F.col(be)) & (F.col(le) > F.col(bs)) & (F.floor(F.greatest(F.col(ls), F.col(bs)) / span) == F.col("__bin")))
    return met.drop("__bin")


def clip(df: DataFrame, start: str, end: str, low: str, high: str, step: int, least: int) -> DataFrame:
    """Ranges cut to [low, high), their start rounded up and their end down to a step from low; short ones are dropped."""
    s = F.greatest(F.col(start), F.col(low)) - F.col(low)
    e = F.least(F.col(end), F.col(high)) - F.col(low)
    inside = df.withColumn("clip_start", F.col(low) + F.ceil(s / step) * step).withColumn("clip_end", F.col(low) + F.floor(e / step) * step)
    return inside.where(F.col("clip_end") - F.col("clip_start") >= least)


def as_of(left: DataFrame, right: DataFrame, key: str, time: str, value: str, tie: str) -> DataFrame:
    """Each left row with the value of the right row of its key that was the last at or before its time.

    One sort over the union of both sides, not a join of ranges: the last value before a row is carried
    along. A key that is hot is one partition of the window, which spills rather than being collected.
    """
    both = left.withColumn("__side", F.lit(1)).withColumn("__v", F.lit(None).cast(right.schema[value].dataType)).select(*left.columns, "__side", "__v").unionByName(
        right.select(key, time, F.col(value).alias("__v")).withColumn("__side", F.lit(0)), allowMissingColumns=True
    )
    upto = Window.partitionBy(key).orderBy(time, "__side", tie).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(value, F.last("__v", ignorenulls=True).over(upto)).where("__side = 1").select(*left.columns, value)


def _vectors(column) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _in_parts(queries: DataFrame, query: str, columns: list[str], most: int):
    """The rows of a stated query set, broadcast in parts of at most about ``most`` rows."""
    parts = max(1, -(-queries.count() // most))
    for part in range(parts):
        some = queries if parts == 1 else queries.where(F.pmod(F.xxhash64(query), F.lit(parts)) == part)
        table = some.select(query, *columns).toArrow()
        yield queries.sparkSession.sparkContext.broadcast(table.combine_chunks())


def _best(scores: np.ndarray, allowed: np.ndarray, few: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the ``few`` greatest allowed scores of each row; ties go to the smaller column."""
    scores = np.where(allowed, scores, -np.inf)
    few = min(few, scores.shape[1])
    floor = -np.partition(-scores, few - 1, axis=1)[:, few - 1 : few]
    take = (scores >= floor) & np.isfinite(scores)
    for r in np.flatnonzero(take.sum(axis=1) > few):
        take[r] = False
        take[r, np.argsort(-scores[r], kind="stable")[:few]] = True
    return np.nonzero(take)


def nearest(queries: DataFrame, corpus: DataFrame, query: str, item: str, vector: str, k: int, exclude_same: bool = True, most_queries: int = 50_000) -> DataFrame:
    """(query, item, score, rank): the ``k`` items with the greatest dot product for each query, exactly.

    A stated set of queries against all rows, in blocks: each task multiplies a block of the corpus' vectors
    with blocks of queries and keeps the best ``k`` for each query; only these move, and a second step
    merges them. Scores are rounded to 6 digits and ties go to the smaller item. The queries are sent
    to the tasks in parts of bounded size, the corpus is read once for each part. Null vectors are left out.
    """
    qt, it = queries.schema[query].dataType.simpleString(), corpus.schema[item].dataType.simpleString()
    found = None
    for sent in _in_parts(queries.where(F.col(vector).isNotNull()), query, [vector], most_queries):

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            asked = sent.value
            names, matrix = asked.column(query).combine_chunks(), _vectors(asked.column(vector))
            for b in batches:
                if not b.num_rows or not len(names):
                    continue
                b = b.take(pc.sort_indices(b.column(0)))
                ids, v = b.column(0), _vectors(b.column(1))
                plain, own = np.array(ids.to_pylist(), object), np.array(names.to_pylist(), object)
                for at in range(0, len(names), 512):
                    scores = np.round(matrix[at : at + 512] @ v.T, 6)
                    allowed = own[at : at + 512, None] != plain[None, :] if exclude_same else np.ones(scores.shape, bool)
                    r, c = _best(scores, allowed, k)
                    yield pa.RecordBatch.from_arrays([names.take(pa.array(r + at)), ids.take(pa.array(c)), pa.array(scores[r, c])], names=["q", "i", "score"])

        one = corpus.where(F.col(vector).isNotNull()).select(item, vector).mapInArrow(run, f"q {qt}, i {it}, score double")
        found = one if found is None else found.unionAll(one)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "i")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(F.col("q").alias(query), F.col("i").alias(item), "score", "rank")


def hard_negatives(queries: DataFrame, corpus: DataFrame, query: str, item: str, vector: str, label: str, k: int, margin: float = 0.95, most_queries: int = 50_000) -> DataFrame:
    """(query, item, score, rank): for each query the ``k`` best items of another label that score at most
    ``margin`` of its worst item of the same label. Two passes in blocks, as in ``nearest``."""
    qt, it = queries.schema[query].dataType.simpleString(), corpus.schema[item].dataType.simpleString()
    rows = corpus.where(F.col(vector).isNotNull() & F.col(label).isNotNull()).select(item, vector, label)
    asked = queries.where(F.col(vector).isNotNull() & F.col(label).isNotNull())

    def worst(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            t = sent.value
            names, matrix, labels = t.column(query).combine_chunks(), _vectors(t.column(vector)), np.array(t.column(label).to_pylist(), object)
            own, least = np.array(names.to_pylist(), object), np.full(len(names), np.inf)
            for b in batches:
                if b.num_rows and len(names):
                    scores = np.round(matrix @ _vectors(b.column(1)).T, 6)
                    same = (labels[:, None] == np.array(b.column(2).to_pylist(), object)[None, :]) & (own[:, None] != np.array(b.column(0).to_pylist(), object)[None, :])
                    least = np.minimum(least, np.where(same, scores, np.inf).min(axis=1))
            seen = np.flatnonzero(np.isfinite(least))
            yield pa.RecordBatch.from_arrays([names.take(pa.array(seen)), pa.array(least[seen])], names=["q", "low"])

        return run

    found = None
    for sent in _in_parts(asked, query, [vector, label], most_queries):
        low = rows.mapInArrow(worst(sent), f"q {qt}, low double").groupBy("q").agg((F.min("low") * margin).alias("ceiling"))
        with_ceiling = asked.select(query, vector, label).join(low.withColumnRenamed("q", query), query)
        for inner in _in_parts(with_ceiling, query, [vector, label, "ceiling"], most_queries):

            def run(batches: Iterator[pa.RecordBatch], inner=inner) -> Iterator[pa.RecordBatch]:
                t = inner.value
                names, matrix, labels, ceiling = t.column(query).combine_chunks(), _vectors(t.column(vector)), np.array(t.column(label).to_pylist(), object), t.column("ceiling").to_numpy()
                for b in batches:
                    if not b.num_rows or not len(names):
                        continue
                    b = b.take(pc.sort_indices(b.column(0)))
                    v, other = _vectors(b.column(1)), np.array(b.column(2).to_pylist(), object)
                    for at in range(0, len(names), 512):
                        scores = np.round(matrix[at : at + 512] @ v.T, 6)
                        r, c = _best(scores, (labels[at : at + 512, None] != other[None, :]) & (scores <= ceiling[at : at + 512, None]), k)
                        yield pa.RecordBatch.from_arrays([names.take(pa.array(r + at)), b.column(0).take(pa.array(c)), pa.array(scores[r, c])], names=["q", "i", "score"])

            one = rows.mapInArrow(run, f"q {qt}, i {it}, score double")
            found = one if found is None else found.unionAll(one)
    order = Window.partitionBy("q").orderBy(F.desc("score"), "i")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(F.col("q").alias(query), F.col("i").alias(item), "score", "rank")
