"""Approximate nearest neighbours by random hyperplanes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.functions.vectors import dot


class HyperplaneIndex:
    """Every row is in one cell of each table; a query asks its own cells and those one or two bits away.

    The planes depend on the dimension and a seed only, so nothing is fitted. A hot cell is split by
    the join, and scores are computed for the candidates only.
    """

    def __init__(self, rows: DataFrame, key: str, vector: str, tables: int = 48, planes: int = 8, seed: int = 3) -> None:
        self.rows, self.key, self.vector = rows, key, vector
        self.tables, self.planes, self.seed = tables, planes, seed

    def _cells(self, df: DataFrame, key: str, flips: int) -> DataFrame:
        tables, planes, seed = self.tables, self.planes, self.seed

        def run(batches):
            normals = None
            for b in batches:
                if not b.num_rows:
                    continue
                v = np.array(b.column(1).to_pylist(), np.float64)
                if normals is None:
                    normals = np.random.default_rng(seed).standard_normal((v.shape[1], tables * planes))
                side = (v @ normals).reshape(len(v), tables, planes)
                code = ((side > 0) * (1 << np.arange(planes))).sum(axis=2)
                found = [code]
                near = np.argsort(np.abs(side), axis=2)  # the planes that a vector lies closest to
                for n in range(flips):
                    found.append(code ^ (1 << near[:, :, n]))
                if flips > 1:
                    found.append(code ^ (1 << near[:, :, 0]) ^ (1 << near[:, :, 1]))
                cells = np.stack(found, axis=2) + (np.arange(tables) << planes)[None, :, None]
                per = cells.shape[1] * cells.shape[2]
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(np.repeat(np.arange(len(v)), per))), pa.array(cells.reshape(-1).astype(np.int32))], names=["id", "cell"])

        kind = df.schema[key].dataType.simpleString()
        return df.select(key, self.vector).where(F.col(self.vector).isNotNull()).mapInArrow(run, f"id {kind}, cell int")

    def search(self, queries: DataFrame, query: str, k: int) -> DataFrame:
        """(query, key, score, rank) by dot product; a query isn't its own neighbour."""
        asked = self._cells(queries, query, 2).withColumnRenamed("id", "q")
        pairs = asked.join(self._cells(self.rows, self.key, 0), "cell").where("q <> id").select("q", "id").distinct()
        both = pairs.join(queries.select(F.col(query).alias("q"), F.col(self.vector).alias("x")), "q").join(self.rows.select(F.col(self.key).alias("id"), F.col(self.vector).alias("y")), "id")
        scored = both.select("q", "id", F.round(dot(F.col("x"), F.col("y")), 6).alias("score"))
        best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
        return scored.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(F.col("q").alias(query), F.col("id").alias(self.key), "score", "rank")
