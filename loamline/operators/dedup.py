"""Exact, fuzzy, substring and semantic deduplication. The smallest id survives."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.text import short_digest
from loamline.operators.graph import components
from loamline.session import cut, spread


def exact_duplicate_ids(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key): every document whose text a document with a smaller id has too. Null texts have no copies.

    Only digests move; the survivor of each is pre-aggregated, so a text that fills a third of the corpus is
    no heavier than any other.
    """
    hashed = docs.where(F.col(text).isNotNull()).select(key, F.md5(text).alias("same"))
    first = hashed.groupBy("same").agg(F.min(key).alias("first"), F.count("*").alias("n")).where("n > 1")
    return hashed.join(first, "same").where(F.col(key) != F.col("first")).select(key)


def corpus_of(df: DataFrame, text: str) -> DataFrame:
    """(corpus_id, text): the different texts, named by their digest."""
    return df.where(F.col(text).isNotNull()).select(F.col(text).alias("text")).distinct().select(short_digest(F.col("text"), "d_").alias("corpus_id"), "text")


def _character_runs(text: str, width: int) -> np.ndarray:
    """The hashes of the different runs of ``width`` characters."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if len(codes) < width:
        return np.zeros(0, np.uint64)
    h, done = codes, 1  # h[i] stands for the ``done`` characters from i on
    while done < width:
        step = min(done, width - done)
        h = (h[: len(h) - step] * np.uint64(0x9E3779B97F4A7C15) ^ (h[step:] + np.uint64(done))) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        done += step
    return np.unique(h)


def _permutations(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Factor and summand of ``n`` permutations of 32 bits."""
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), rng.integers(0, 1 << 32, n, dtype=np.uint32)


def _minima(runs: np.ndarray, permutations: tuple[np.ndarray, np.ndarray], block: int = 1 << 15) -> np.ndarray:
    """The minimum hash by each permutation, over all runs; the tables of a text of any length hold ``block`` hashes."""
    factor, summand = (x[:, None] for x in permutations)
    h = (runs >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(factor), np.iinfo(np.uint32).max, np.uint32)
    for start in range(0, len(h), block):
        part = h[start : start + block]
        step = max(1, block // len(part))
        for at in range(0, len(factor), step):
            x = factor[at : at + step] * part
            x += summand[at : at + step]
            np.minimum(least[at : at + step], x.min(axis=1), out=least[at : at + step])
    return least


def _minhash(width: int, bands: int, rows: int, seed: int):
    permutations = _permutations(bands * rows, seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            owner, bucket = [], [np.zeros(0, np.int64)]
            for i, t in enumerate(b.column(1).to_pylist()):
                runs = _character_runs(t or "", width)
                if len(runs):
                    least = _minima(runs, permutations)
                    own = [xxhash.xxh64_intdigest(least[k * rows : (k + 1) * rows].tobytes(), seed + k) for k in range(bands)]
                    owner += [i] * bands
                    bucket.append(np.array(own, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner, pa.int64())), pa.array(np.concatenate(bucket))], names=["id", "bucket"])

    return run


def fuzzy_duplicates(docs: DataFrame, key: str, text: str, width: int = 24, bands: int = 20, rows: int = 13, seed: int = 42) -> DataFrame:
    """(key, group): documents that share a band of minimum hashes of their character runs, by connected component.

    A document is linked with the smallest id of each of its buckets, so a bucket of any size gives one
    link a document; the minimum is pre-aggregated and the links make up the same components as all pairs would.
    """
    kind = docs.schema[key].dataType.simpleString()
    placed = cut(spread(docs.select(key, text).where(F.col(key).isNotNull())).mapInArrow(_minhash(width, bands, rows, seed), f"id {kind}, bucket bigint"))
    least = placed.groupBy("bucket").agg(F.min("id").alias("y"), F.count("*").alias("n")).where("n > 1").drop("n")
    links = placed.join(least, "bucket").where("id <> y").select(F.col("id").alias("x"), "y").distinct()
    return components(links).select(F.col("node").alias(key), F.col("label").alias("group"))


def repeated_ranges(tokens: DataFrame, key: str, words: str, width: int) -> DataFrame:
    """(key, start, end): token ranges whose every run of ``width`` tokens occurred before, in (key, position) order.

    Each run's first place is pre-aggregated; a run at any other place marks its tokens, and marked
    stretches are joined where they touch (gaps and islands within a document).
    """
    runs = tokens.where(F.size(words) >= width).select(key, F.posexplode(F.transform(F.sequence(F.lit(1), F.size(words) - (width - 1)), lambda k: F.xxhash64(F.array_join(F.slice(words, k, width), "\u0001")))).alias("at", "run"))
    first = runs.groupBy("run").agg(F.min(F.struct(key, "at")).alias("first"), F.count("*").alias("n")).where("n > 1")
    again = runs.join(first, "run").where((F.col(f"first.{key}") != F.col(key)) | (F.col("first.at") != F.col("at"))).select(key, F.col("at").alias("start"), (F.col("at") + width).alias("end"))
    order = Window.partitionBy(key).orderBy("start")
    opened = again.withColumn("new", F.when(F.col("start") <= F.lag("end").over(order), 0).otherwise(1)).withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return opened.groupBy(key, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def without_ranges(tokens: DataFrame, ranges: DataFrame, key: str, words: str) -> DataFrame:
    """The tokens outside the ranges of their document."""
    listed = ranges.groupBy(key).agg(F.collect_list(F.struct("start", "end")).alias("__cut"))
    kept = F.filter(F.col(words), lambda w, i: ~F.exists("__cut", lambda r: (i >= r["start"]) & (i < r["end"])))
    return tokens.join(listed, key, "left").withColumn(words, F.when(F.col("__cut").isNull(), F.col(words)).otherwise(kept)).drop("__cut")


def _near_in_blocks(key: str, least: float):
    """For the rows of two blocks (or of one): each row's nearest one with a smaller key, at ``least`` similarity."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by(key)
        ids, v = table.column(key), np.array(table.column("v").to_pylist(), np.float64)
        length = np.linalg.norm(v, axis=1)
        v = v[:, :] / np.where(length > 0, length, 1)[:, None]
        one = table.column("tree").to_numpy() == table.column("by").to_numpy()
        side = table.column("asks").to_numpy(zero_copy_only=False)
        mine, best, score = [], [], []
        for at in range(0, len(v), 512):
            s = np.round(v[at : at + 512] @ v.T, 6)
            earlier = np.arange(len(v))[None, :] < np.arange(at, at + len(s))[:, None]
            allowed = earlier & (one[at : at + 512, None] | (side[at : at + 512, None] != side[None, :])) & (length[None, :] > 0) & (length[at : at + 512, None] > 0)
            s = np.where(allowed, s, -2.0)
            top = s.argmax(axis=1)  # the first of equal ones: the smallest key
            hit = np.flatnonzero(s[np.arange(len(s)), top] >= least)
            mine += (hit + at).tolist()
            best += top[hit].tolist()
            score += s[hit, top[hit]].tolist()
        return pa.table({key: ids.take(pa.array(mine, pa.int64())), "other": ids.take(pa.array(best, pa.int64())), "s": pa.array(score, pa.float64())})

    return run


def clusters(rows: DataFrame, key: str, vector: str, k: int, seed: int = 5, fit_rows: int = 100_000) -> DataFrame:
    """``rows`` with the number of their cluster by k-means, fitted on about ``fit_rows`` rows chosen by hash."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    ready = rows.where(F.col(vector).isNotNull()).withColumn("__v", array_to_vector(F.transform(vector, lambda x: x.cast("double"))))
    share = min(1.0, fit_rows / max(1, ready.count()))
    model = KMeans(k=k, seed=seed, featuresCol="__v", predictionCol="cluster").fit(ready.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1_000_000)) < share * 1_000_000))
    return model.transform(ready).drop("__v")


def semantic_duplicates(rows: DataFrame, key: str, vector: str, cluster: str, eps: float, block_rows: int = 4_000) -> DataFrame:
    """(key, other): rows within cosine distance ``eps`` of a row of their cluster with a smaller key; the closest
    such row, of equal ones the smallest.

    A cluster is cut into blocks of about ``block_rows``; every block meets itself and each other block of its
    cluster in a task of its own, as a product of matrices, and gives one row for each of its rows at most. Null
    and zero vectors are near nothing.
    """
    kind = rows.schema[key].dataType.simpleString()
    held = rows.where(F.col(vector).isNotNull() & F.col(key).isNotNull()).select(key, F.col(cluster).alias("c"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    blocks = held.groupBy("c").agg(F.ceil(F.count("*") / block_rows).alias("blocks"))
    placed = held.join(blocks, "c").withColumn("block", F.pmod(F.xxhash64(F.lit(3), key), F.col("blocks")))
    meets = placed.withColumn("meets", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    pairs = meets.select(key, "c", "v", F.least("block", "meets").alias("tree"), F.greatest("block", "meets").alias("by"), (F.col("block") > F.col("meets")).alias("asks"))
    found = pairs.groupBy("c", "tree", "by").applyInArrow(_near_in_blocks(key, round(1 - eps, 6)), f"`{key}` {kind}, other {kind}, s double")
    return found.groupBy(key).agg(F.min_by("other", F.struct(-F.col("s"), "other")).alias("other"))
