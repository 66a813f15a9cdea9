"""Packing of token sequences into bins, and the packed rows."""

from __future__ import annotations

import random
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


class _Room:
    """The first bin with room enough, in logarithmic time: a tree of the largest room below each node."""

    def __init__(self, most: int) -> None:
        self.size = 1 << max(1, (most - 1).bit_length())
        self.room = [0] * (2 * self.size)
        self.bins = 0

    def set(self, b: int, room: int) -> None:
        at = self.size + b
        self.room[at] = room
        while at > 1:
            at >>= 1
            self.room[at] = max(self.room[2 * at], self.room[2 * at + 1])

    def first(self, need: int) -> int | None:
        if self.room[1] < need:
            return None
        at = 1
        while at < self.size:
            at = 2 * at if self.room[2 * at] >= need else 2 * at + 1
        return at - self.size


def _first_fit(order: list[int], lengths: list[int], capacity: int) -> list[int]:
    tree = _Room(max(1, len(lengths)))
    own = [0] * len(lengths)
    for i in order:
        n = min(lengths[i], capacity)
        b = tree.first(n) if n else 0 if tree.bins else None
        if b is None:
            b, tree.bins = tree.bins, tree.bins + 1
            tree.set(b, capacity)
        tree.set(b, tree.room[tree.size + b] - n)
        own[i] = b
    return own


def first_fit_decreasing(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each sequence: longest first, equal ones in their order, each into the first bin with room."""
    return _first_fit(sorted(range(len(lengths)), key=lambda i: -min(lengths[i], capacity)), lengths, capacity)


def first_fit_shuffled(lengths: list[int], capacity: int, seed: int) -> list[int]:
    order = list(range(len(lengths)))
    random.Random(seed).shuffle(order)
    return _first_fit(order, lengths, capacity)


def next_fit(lengths: list[int], capacity: int) -> list[int]:
    """In the given order; a sequence that doesn't fit opens the next bin."""
    own, b, used = [], -1, capacity + 1
    for n in (min(n, capacity) for n in lengths):
        if used + n > capacity:
            b, used = b + 1, 0
        used += n
        own.append(b)
    return own


def assign_bins(seqs: DataFrame, shard: str, key: str, length: str, capacity: int, method: Callable[[list[int], int], list[int]] = first_fit_decreasing, shard_rows: int = 200_000) -> DataFrame:
    """(shard, part, key, length, bin): longer sequences count as ``capacity`` long and will be cut.

    Packing runs for each shard by itself; a shard of more than ``shard_rows`` rows is cut into parts by a hash of
    the key, so that a task never holds more than about that many lengths.
    """
    sizes = seqs.groupBy(shard).agg(F.ceil(F.count("*") / shard_rows).alias("__parts"))
    rows = seqs.select(shard, key, F.least(F.col(length), F.lit(capacity)).cast("int").alias(length)).join(sizes, shard)
    rows = rows.withColumn("part", F.pmod(F.xxhash64(key), F.col("__parts")).cast("int")).drop("__parts")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(key)
        return table.append_column("bin", pa.array(method(table.column(length).to_pylist(), capacity), pa.int32()))

    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns) + ", bin int"
    return rows.groupBy(shard, "part").applyInArrow(run, schema).select(shard, "part", key, length, "bin")


def packed_rows(seqs: DataFrame, bins: DataFrame, shard: str, key: str, tokens: str, mask: str, capacity: int) -> DataFrame:
    """(shard, part, bin, input_ids, loss_mask, seq_start_id): the sequences of a bin put together in order of their keys.

    A sequence is cut at ``capacity``; its mask is shifted for labels, with a 0 at its end; ``seq_start_id`` is
    where each sequence starts.
    """
    from loamline.operators.chat import shifted_mask

    cut = seqs.select(shard, key, F.slice(tokens, 1, capacity).alias("t"), F.slice(mask, 1, capacity).alias("m"))
    held = cut.join(bins.select(shard, key, "part", "bin"), [shard, key])
    order = Window.partitionBy(shard, "part", "bin").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    placed = held.withColumn("at", F.coalesce(F.sum(F.size("t")).over(order), F.lit(0)).cast("int")).withColumn("m", shifted_mask(F.col("m")))
    packed = placed.groupBy(shard, "part", "bin").agg(F.sort_array(F.collect_list(F.struct("at", key, "t", "m"))).alias("__s"))  # as many as fit a bin
    return packed.select(
        shard, "part", "bin", F.flatten(F.transform("__s", lambda x: x["t"])).alias("input_ids"), F.flatten(F.transform("__s", lambda x: x["m"])).alias("loss_mask"), F.transform("__s", lambda x: x["at"]).alias("seq_start_id")
    )


def rejoin(parts: DataFrame, owner: str, position: str, text: str, length: str, most: int, separator: str = "\n", alone: bool = True) -> DataFrame:
    """(owner, piece, text, length): consecutive parts of an owner put together again up to ``most``.

    A part longer than that is a piece of its own (``alone``) or is dropped.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(position)
        out: list[list] = []
        for t, n in zip(table.column(text).to_pylist(), table.column(length).to_pylist()):
            if n > most and not alone:
                continue
            if out and out[-1][1] + n <= most:
                out[-1][0].append(t)
                out[-1][1] += n
            else:
                out.append([[t], n])
        return pa.table({owner: table.column(owner).take(pa.array(np.zeros(len(out), np.int64))), "piece": pa.array(range(len(out)), pa.int32()), "text": [separator.join(t) for t, _ in out], "length": pa.array([n for _, n in out], pa.int64())})

    return parts.where(F.col(text).isNotNull()).select(owner, position, text, length).groupBy(owner).applyInArrow(run, f"`{owner}` {parts.schema[owner].dataType.simpleString()}, piece int, text string, length bigint")
