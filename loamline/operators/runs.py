"""Plans of runs: shards, receipts, artifacts and what they were made from."""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.session import cut


def balance(sizes: list[tuple[str, int]], shards: int) -> dict[str, int]:
    """The shard of each file: the largest first, each to the shard that has least. Without sizes, in turn."""
    if not any(n for _, n in sizes):
        return {name: k % shards for k, (name, _) in enumerate(sorted(sizes))}
    heap = [(0, k) for k in range(shards)]
    out = {}
    for name, n in sorted(sizes, key=lambda x: (-x[1], x[0])):
        load, k = heapq.heappop(heap)
        out[name] = k
        heapq.heappush(heap, (load + n, k))
    return out


def balanced(files: DataFrame, dataset: str, name: str, size: str, shards: int) -> DataFrame:
    """(dataset, name, size, shard) of a listing of files, which is small beside what they hold; by dataset."""

    def run(table: pa.Table) -> pa.Table:
        own = balance(list(zip(table.column(name).to_pylist(), table.column(size).to_pylist())), shards)
        return table.append_column("shard", pa.array([own[n] for n in table.column(name).to_pylist()], pa.int32()))

    rows = files.select(dataset, name, F.coalesce(size, F.lit(0)).cast("bigint").alias(size))
    return rows.groupBy(dataset).applyInArrow(run, ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns) + ", shard int")


def apportioned(files: DataFrame, dataset: str, name: str, size: str, shards: int) -> DataFrame:
    """(dataset, name, share): how many row shards each file gives when there are no more files than shards.

    Each file has the whole part of its share, at least one. What is left goes to the largest fractions, of equal ones
    to the first file. What is too much, because of the files that have one in place of less, is taken back one at a
    time from files with more than one, from the one that is then least short of its exact share; so the shares of a
    dataset add up to ``shards``. Files of no size at all count alike. A dataset of more files than shards gives
    one to each.
    """
    every = Window.partitionBy(dataset)
    count, total = F.count("*").over(every), F.sum(F.coalesce(size, F.lit(0))).over(every)
    share = F.when(total > 0, F.coalesce(size, F.lit(0)) * shards / total).otherwise(F.lit(float(shards)) / count)
    base = files.select(dataset, name, size).withColumn("exact", share).withColumn("whole", F.greatest(F.lit(1), F.floor("exact")))
    left = base.withColumn("left", shards - F.sum("whole").over(every)).withColumn("turn", F.row_number().over(every.orderBy(F.desc(F.col("exact") - F.floor("exact")), name)))
    # Each share beyond the first can be taken back: no more rows than files and shards.
    spare = left.where("left < 0 AND whole > 1").select(dataset, name, "exact", "whole", "left", F.explode(F.sequence(F.lit(1), F.col("whole") - 1)).alias("nth"))
    back = spare.withColumn("taken", F.row_number().over(every.orderBy(F.col("exact") - F.col("whole") + F.col("nth"), name))).where("taken <= -left").groupBy(dataset, name).agg(F.count("*").alias("less"))
    given = F.col("whole") + F.when(F.col("turn") <= F.col("left"), 1).otherwise(0) - F.coalesce("less", F.lit(0))
    return left.join(back, [dataset, name], "left").select(dataset, name, given.cast("bigint").alias("share"))


def plan_hash(*parts: Column) -> Column:
    return F.substring(F.sha2(F.to_json(F.struct(*parts)), 256), 1, 16)


def pending(plan: DataFrame, receipts: DataFrame, keys: list[str]) -> DataFrame:
    """Shards of a plan that have no completed receipt of the same plan."""
    return plan.join(receipts.where("status = 'completed'").select(*keys).distinct(), keys, "left_anti")


def enough_files(files: DataFrame, dataset: str, name: str, rows: str, target: int, margin: float = 2.0) -> DataFrame:
    """The first files of a dataset whose estimated rows reach a target with a margin."""
    before = F.coalesce(F.sum(rows).over(Window.partitionBy(dataset).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return files.withColumn("before", before).where(F.col("before") < target * margin).drop("before")


def latest_versions(artifacts: DataFrame, name: str, version: str) -> DataFrame:
    """Each artifact's latest version."""
    best = artifacts.groupBy(name).agg(F.max(version).alias(version))
    return artifacts.join(best, [name, version])


def made_from(edges: DataFrame, child: str, parent: str, most_rounds: int = 60) -> DataFrame:
    """(child, ancestor, depth): all that an artifact was made from, directly or not; the shortest way counts.

    The reach doubles every round: ancestors are joined with the ancestors of those, so a chain of a
    thousand steps takes ten rounds. Cycles end when nothing new is found.
    """
    known = cut(edges.select(F.col(child).alias("c"), F.col(parent).alias("a")).where("c <> a").distinct().withColumn("d", F.lit(1)))
    size = known.count()
    for _ in range(most_rounds):
        further = known.alias("x").join(known.alias("y"), F.col("x.a") == F.col("y.c")).select(F.col("x.c").alias("c"), F.col("y.a").alias("a"), (F.col("x.d") + F.col("y.d")).alias("d")).where("c <> a")
        new = cut(known.unionAll(further).groupBy("c", "a").agg(F.min("d").alias("d")))
        n = new.count()
        known, done, size = new, n == size, n
        if done:
            return known.select(F.col("c").alias(child), F.col("a").alias("ancestor"), F.col("d").alias("depth"))
    raise RuntimeError("the lineage did not settle")


def unmet(steps: DataFrame, edges: DataFrame) -> DataFrame:
    """(step, needs): inputs of the steps of a graph that no step before them makes.

    ``steps`` has (step, needs array, makes array), ``edges`` (step, after).
    """
    before = made_from(edges, "step", "after").select("step", F.col("ancestor").alias("other"))
    made = before.join(steps.select(F.col("step").alias("other"), F.explode("makes").alias("needs")), "other").select("step", "needs")
    return steps.select("step", F.explode("needs").alias("needs")).join(made.distinct(), ["step", "needs"], "left_anti")
