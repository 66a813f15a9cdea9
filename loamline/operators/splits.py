"""Splits and samples. Every choice is a hash of (seed, stable key), so a run can be repeated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The items of a pool that is drawn from.
MOST_ITEMS = 100_000


def _ranked(names: DataFrame, key: str, digest: Column) -> DataFrame:
    """(key, k, n): the place of each different name in the order of its digest, and how many there are.

    The order is made in slices of the digest's first letters: a name's place is the number of names in
    earlier slices and its place in its own, so no task sorts them all.
    """
    hashed = names.where(F.col(key).isNotNull()).select(key).distinct().withColumn("h", digest).withColumn("slice", F.substring("h", 1, 2))
    sizes = hashed.groupBy("slice").agg(F.count("*").alias("m"))
    whole = Window.partitionBy(F.lit(1))  # over 256 slices
    starts = sizes.select("slice", (F.sum("m").over(whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)) - F.col("m")).alias("start"), F.sum("m").over(whole).alias("n"))
    own = F.row_number().over(Window.partitionBy("slice").orderBy("h", key))
    return hashed.withColumn("at", own).join(F.broadcast(starts), "slice").select(key, (F.col("start") + F.col("at")).alias("k"), "n")


def _md5(seed: int, key: str) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def last_rows(df: DataFrame, part: str, order: str, held: int) -> DataFrame:
    """The last ``held`` rows of each part are ``val``; a part that isn't larger is all ``train``."""
    w = Window.partitionBy(part)
    at, n = F.row_number().over(w.orderBy(order)), F.count("*").over(w)
    return df.withColumn("split", F.when((n > held) & (at > n - held), "val").otherwise("train"))


def shard_splits(shards: DataFrame, key: str, test: int, valid: int, seed: int) -> DataFrame:
    """Shards in shuffled order: the first are ``test``, the next ``valid``, the rest ``train``. Shards without a name are dropped."""
    split = F.when(F.col("k") <= test, "test").when(F.col("k") <= test + valid, "valid").otherwise("train")
    return shards.join(_ranked(shards, key, _md5(seed, key)).select(key, split.alias("split")), key)


def group_splits(df: DataFrame, group: str, train: float, val: float, seed: int) -> DataFrame:
    """Whole groups go to one split. Rows without a group are dropped."""
    a, b = F.floor(F.col("n") * train), F.floor(F.col("n") * val)
    split = F.when(F.col("k") <= a, "train").when(F.col("k") <= a + b, "val").otherwise("test")
    return df.join(_ranked(df, group, _md5(seed, group)).select(group, split.alias("split")), group)


def sampled(shards: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """A share of the shards, at least one, by a hash of (seed, name)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    return _ranked(shards, key, digest).where(F.col("k") <= F.greatest(F.lit(1), F.ceil(F.col("n") * fraction))).select(key)


def ratio_to_shards(total: Column, ratio: float) -> Column:
    return F.lit(0) if ratio <= 0 else F.greatest(F.lit(1), F.round(total * ratio).cast("int"))


def weighted_draws(queries: DataFrame, query: str, pool: DataFrame, item: str, weight: str, draws: int, seed: int) -> DataFrame:
    """(query, draw, item): draws with replacement from a small pool, by where a hash falls on its cumulative weights.

    The pool is sent to all executors, so one of more than ``MOST_ITEMS`` is an error.
    """
    if pool.limit(MOST_ITEMS + 1).count() > MOST_ITEMS:
        raise ValueError(f"a pool to draw from has at most {MOST_ITEMS} items")
    whole = Window.partitionBy(F.lit(1))
    upto = F.sum(weight).over(whole.orderBy(item).rowsBetween(Window.unboundedPreceding, 0)) / F.sum(weight).over(whole)
    table = pool.select(item, upto.alias("upto")).agg(F.sort_array(F.collect_list(F.struct("upto", item))).alias("pool"))
    asked = queries.select(query, F.explode(F.sequence(F.lit(1), F.lit(draws))).alias("draw")).withColumn("u", F.pmod(F.xxhash64(F.lit(seed), query, "draw"), F.lit(1 << 30)) / float(1 << 30))
    return asked.join(F.broadcast(table)).select(query, "draw", F.try_element_at(F.filter("pool", lambda p: p["upto"] > F.col("u")), F.lit(1))[item].alias(item))
