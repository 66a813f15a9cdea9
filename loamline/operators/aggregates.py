"""Aggregates that need more than one built-in function."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_weight(df: DataFrame, value: str, weight: str, cuts: int = 200) -> DataFrame:
    """(value, weight, upto, total): the weight up to each different value, in order of the values.

    Equal values are added up first. The axis is then cut at approximate quantiles, whose totals are few
    and are summed along; each cut runs on from there by itself, so no task sorts the whole axis.
    """
    merged = df.where(F.col(value).isNotNull() & F.col(weight).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.sum(weight).alias("weight"))
    edges = sorted({*merged.approxQuantile("value", [k / cuts for k in range(1, cuts)], 0.001)}) if cuts > 1 else []
    bins = merged.withColumn("cut", F.size(F.filter(F.array(*map(F.lit, edges)).cast("array<double>"), lambda e: e < F.col("value"))))
    sums = bins.groupBy("cut").agg(F.sum("weight").alias("sum"))
    before = Window.partitionBy(F.lit(1)).orderBy("cut")  # as many rows as cuts
    starts = sums.select("cut", (F.sum("sum").over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("sum")).alias("start"), F.sum("sum").over(Window.partitionBy(F.lit(1))).alias("total"))
    inner = Window.partitionBy("cut").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    return bins.join(F.broadcast(starts), "cut").select("value", "weight", (F.col("start") + F.sum("weight").over(inner)).alias("upto"), "total")


def weighted_percentiles(df: DataFrame, value: str, weight: str, percents: list[int]) -> DataFrame:
    """(p, threshold): the smallest value with at least ``p`` percent of the weight at or below it (no interpolation)."""
    ran = running_weight(df, value, weight)
    reached = ran.withColumn("p", F.explode(F.array(*map(F.lit, percents)))).where(F.col("upto") * 100 >= F.col("p") * F.col("total"))
    return reached.groupBy("p").agg(F.min("value").alias("threshold"))


def bucket_of(score: Column, thresholds: Column) -> Column:
    """How many thresholds lie at or below a score."""
    return F.size(F.filter(thresholds, lambda t: t <= score))


def bucketed(df: DataFrame, score: str, weight: str, percents: list[int], name: str = "bucket") -> DataFrame:
    """``df`` with the bucket of its score between the byte-weighted percentiles of the table."""
    table = weighted_percentiles(df, score, weight, percents).agg(F.sort_array(F.collect_list("threshold")).alias("__t"))
    return df.join(F.broadcast(table)).withColumn(name, F.when(F.col(score).isNotNull(), bucket_of(F.col(score), F.col("__t")))).drop("__t")


def ranking_metrics(ranked: DataFrame, relevant: DataFrame, query: str, item: str, ks: list[int]) -> DataFrame:
    """(k, ndcg, recall, precision, map) over the queries that have a relevant item; ``ranked`` has (query, item, rank)."""
    sizes = relevant.groupBy(query).agg(F.count("*").alias("n"))
    hits = ranked.join(relevant.select(query, item).withColumn("hit", F.lit(1)), [query, item]).withColumn("nth", F.row_number().over(Window.partitionBy(query).orderBy("rank")))
    per = None
    for k in ks:
        found = hits.where(F.col("rank") <= k).groupBy(query).agg(F.count("*").alias("found"), F.sum(1 / F.log2(F.col("rank") + 1)).alias("gain"), F.sum(F.col("nth") / F.col("rank")).alias("ap"))
        ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("n"), F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + 1.0))
        one = sizes.join(found, query, "left").fillna(0).agg(
            F.round(F.avg(F.col("gain") / ideal), 6).alias("ndcg"), F.round(F.avg(F.col("found") / F.col("n")), 6).alias("recall"), F.round(F.avg(F.col("found") / k), 6).alias("precision"), F.round(F.avg(F.col("ap") / F.least(F.col("n"), F.lit(k))), 6).alias("map")
        ).withColumn("k", F.lit(k))
        per = one if per is None else per.unionAll(one)
    return per


def packing_metrics(bins: DataFrame, by: list[str], container: str, tokens: str, capacity: int) -> DataFrame:
    """(*by, sequences, bins, packing_factor, efficiency) of rows that say in which container each sequence lies."""
    n = F.count("*")
    b = F.count_distinct(container)
    return bins.groupBy(*by).agg(n.alias("sequences"), b.alias("bins"), F.round(n / F.nullif(b, F.lit(0)), 2).alias("packing_factor"), F.round(F.sum(tokens) * 100 / F.nullif(b * capacity, F.lit(0)), 1).alias("efficiency"))
