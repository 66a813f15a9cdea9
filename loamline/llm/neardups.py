"""Problem 5: groups of records that are edited copies of one another.

Two records are near-duplicates if they share at least ``similarity`` of the different runs of
``run_words`` words found in either. Each record's runs are reduced to a fingerprint (an odd sketch): every run
turns one of 4,096 bits over. The fingerprints of two records differ in those bits that the runs found in only
one of them turn over an odd number of times, so their Hamming distance is never greater than the number of such
runs. A pair at the threshold has at most ``(1 - s) / (1 + s)`` of both records' runs on one side only,
which bounds its distance: within a tree no pair is lost.

The search uses BK-trees: a node's children are keyed by their integer Hamming distance to it, and a query
follows only the edges within its radius. The trees are built over shards of related records: minima of the runs'
hashes are banded, and each value of a band is a shard with a tree of its own. A pair at the
threshold shares some shard with a probability of ``1 - (1 - s**rows)**bands`` (above 0.9999 at 0.6 with
3 rows and 42 bands) and more the more similar it is. The trees of all shards of a task are built and asked at once, a
level at a time. A shard is cut into blocks of ``block_rows`` records, one for nearly all: the tree of a
block is asked by its own records and by those of the blocks after it, a pair of blocks at a time, so no
task holds more than two blocks of one shard. A sketch of some thousands of runs is nearly full and tells less: there
more nodes are visited and more pairs go on to the exact check, but none is lost. Trees lie beside the records that ask them instead of being broadcast, since
together they are as large as the corpus. Each pair found is held against the exact share of common runs.

Records with the same set of runs form a class and enter the search once, so a text that fills a third
of the corpus costs one record. Links run between class representatives; ``pairs`` expands them
to records and ``groups`` gives each record the id of its group, by rounds of joins.

Cases: null and blank texts and texts with fewer than ``min_runs`` different runs have no partner; in ``groups``
such texts of the same words form a class, and null and blank ones stay alone. Rows delivered twice count once.
Texts of any length are used whole. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.common import WORDS_SQL, small, words
from loamline.operators.graph import components
from loamline.registry import Registry
from loamline.session import cut, spread
from loamline.tables import load

registry = Registry()

SIMILARITY = 0.6
RUN_WORDS = 3
MIN_RUNS = 40
BITS = 4096
BANDS, ROWS = 42, 3
BLOCK_ROWS = 20_000
CHUNK_CHARS = 100_000
FRONTIER = 200_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on every bit of ``x``."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def runs_of(listed: list[list[str]], run_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, ends): the different runs of ``run_words`` words of some texts given as words, sorted within each text."""
    import xxhash

    every = [w for ws in listed for w in ws]
    known = {w: xxhash.xxh64_intdigest(w) for w in set(every)}
    h = np.fromiter(map(known.__getitem__, every), np.uint64, len(every))
    doc = np.repeat(np.arange(len(listed)), [len(ws) for ws in listed])
    n = len(h) - run_words + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.zeros(len(listed), np.int64)
    out = np.zeros(n, np.uint64)
    for k in range(run_words):
        out = mix(out + h[k : k + n] + _GOLDEN)
    inside = doc[:n] == doc[run_words - 1 :]
    out, doc = out[inside], doc[:n][inside]
    order = np.lexsort((out, doc))
    out, doc = out[order], doc[order]
    first = np.r_[True, (out[1:] != out[:-1]) | (doc[1:] != doc[:-1])] if len(out) else np.zeros(0, bool)
    return out[first], np.cumsum(np.bincount(doc[first], minlength=len(listed)))


def minima(runs: np.ndarray, starts: np.ndarray, n: int, seed: int) -> np.ndarray:
    """``n`` minwise hashes (rows) of each of some sets of hashes (columns), none of them empty."""
    keys = mix(np.arange(1, n + 1, dtype=np.uint64) * _GOLDEN + np.uint64(seed))
    out = np.empty((n, len(starts)), np.uint64)
    for k in range(n if len(starts) else 0):
        out[k] = np.minimum.reduceat((runs ^ keys[k]) * np.uint64(0xD6E8FEB86659FD93), starts)
    return out


def odd_sketches(runs: np.ndarray, doc: np.ndarray, n_docs: int, bits: int) -> np.ndarray:
    """A row of ``bits`` / 64 words for each set: bits turned over an odd number of times."""
    at = doc * bits + (mix(runs ^ _GOLDEN) % np.uint64(bits)).astype(np.int64)
    turned = np.bincount(at, minlength=n_docs * bits).astype(np.uint8) & 1
    return np.packbits(turned.reshape(n_docs, bits), axis=1).view(np.uint64)


class BKForest:
    """BK-trees over fingerprints (rows of 64-bit words) under the Hamming distance, built and asked a level at a time.

    ``root[k]`` is the row of the root of the tree that row ``k`` is put into; a root comes first in its tree. The trees
    are those that putting the rows in one after another gives.
    """

    def __init__(self, prints: np.ndarray, root: np.ndarray, sizes: np.ndarray) -> None:
        self.prints, self.sizes, self.span = prints, sizes, prints.shape[1] * 64 + 1
        rows = np.flatnonzero(root != np.arange(len(root)))
        at = root[rows]
        keys, children = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while len(rows):
            edge = at * self.span + self._distance(prints[rows], at)
            key, first, group = np.unique(edge, return_index=True, return_inverse=True)
            child = rows[first]  # the first row at a distance becomes the child there, the others go on from it
            keys.append(key)
            children.append(child)
            stay = np.ones(len(rows), bool)
            stay[first] = False
            rows, at = rows[stay], child[group[stay]]
        key, child = np.concatenate(keys), np.concatenate(children)
        order = np.argsort(key)
        self.keys, self.children = key[order], child[order]

    def _distance(self, asked: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.bitwise_count(asked ^ self.prints[at]).sum(axis=1, dtype=np.int64)

    def within(self, asked: np.ndarray, root: np.ndarray, reach: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """(asked, row, distance) of all rows within reach and of a size of at most ``most``, and how many nodes were visited for them.

        No row is farther from a node than their sizes add up to, so edges beyond that lead to rows that are too large.
        """
        q, at = np.arange(len(asked)), root
        found, visited = [], 0
        while len(q):
            d = self._distance(asked[q], at)
            visited += len(q)
            near = (d <= reach[q]) & (self.sizes[at] <= most[q])
            found.append((q[near], at[near], d[near]))
            low = np.searchsorted(self.keys, at * self.span + np.maximum(d - reach[q], 0))
            n = np.searchsorted(self.keys, at * self.span + np.minimum(np.minimum(d + reach[q], self.sizes[at] + most[q]), self.span - 1), "right") - low
            n = np.maximum(n, 0)
            upto = np.cumsum(n)
            q = np.repeat(q, n)
            at = self.children[np.arange(len(q)) - np.repeat(upto - n, n) + np.repeat(low, n)] if len(q) else at[:0]
        cols = [np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(3)]
        return cols[0], cols[1], cols[2], visited


def search(prints: np.ndarray, sizes: np.ndarray, group: np.ndarray, asks: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray, int]:
    """(left, right, visited): rows that may be near-duplicates, found by a tree for each group.

    ``group`` gives the first row of each row's group. The rows that ask come last in a group; where none does, the group
    is asked by its own rows, which come in order of size, each for those before it.
    """
    forest = BKForest(prints[~asks], (np.cumsum(~asks) - 1)[group[~asks]], sizes[~asks])
    member = np.flatnonzero(~asks)
    crossed = np.zeros(len(group), bool)
    crossed[group[asks]] = True
    crossed = crossed[group]
    askers = np.flatnonzero(asks | ~crossed)
    apart = (1 - similarity) / (1 + similarity)
    beside = np.where(crossed[askers], np.floor(sizes[askers] / similarity + 1e-9), sizes[askers])  # the largest that a partner can be
    reach = np.floor(apart * (sizes[askers] + beside) + 1e-9).astype(np.int64)
    width = np.bincount(group[~asks], minlength=len(group))[group[askers]]
    left, right, visited = [], [], 0
    cuts = np.searchsorted(np.cumsum(width), np.arange(FRONTIER, int(width.sum()) + FRONTIER, FRONTIER)) + 1 if len(width) else []
    start = 0
    for end in np.minimum(cuts, len(askers)):
        if end > start:
            some = askers[start:end]
            q, at, d, n = forest.within(prints[some], (np.cumsum(~asks) - 1)[group[some]], reach[start:end], beside[start:end])
            q, at, visited = some[q], member[at], visited + n
            fits = (d <= apart * (sizes[q] + sizes[at]) + 1e-9) & (crossed[q] | (at < q))
            left.append(q[fits])
            right.append(at[fits])
            start = end
    none = np.empty(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right]), visited


_PROFILE = "n_runs int, shards array<bigint>, same binary"


def profiles(docs: DataFrame, key: str, text: str, run_words: int, min_runs: int, bands: int, rows: int) -> DataFrame:
    """(key, n_runs, shards, same): what the search needs of each record; n_runs is 0 where no partner can be."""
    import xxhash

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            at = 0
            while at < len(texts):
                end, size = at + 1, len(texts[at] or "")
                while end < len(texts) and size + len(texts[end] or "") <= CHUNK_CHARS:
                    size += len(texts[end] or "")
                    end += 1
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, end - at), *some(texts[at:end])], names=[key, "n_runs", "shards", "same"])
                at = end

    def some(texts: list[str | None]) -> list[pa.Array]:
        listed = [words(t) if t else [] for t in texts]
        runs, ends = runs_of(listed, run_words)
        counts = np.diff(np.r_[0, ends])
        starts = ends - counts
        live = np.flatnonzero((counts >= min_runs) & (counts > 0))
        kept = np.repeat(np.isin(np.arange(len(texts)), live), counts)
        own = runs[kept]
        least = minima(own, np.r_[0, np.cumsum(counts[live])[:-1]] if len(live) else np.empty(0, np.int64), bands * rows, 2)
        folded = np.zeros((bands, len(live)), np.uint64)
        for r in range(rows):
            folded = mix(folded + least[r::rows] + _GOLDEN)
        shards = mix(folded.T + np.arange(bands, dtype=np.uint64)).view(np.int64)
        n_runs = np.zeros(len(texts), np.int32)
        n_runs[live] = counts[live]
        same = [None] * len(texts)
        for i in live.tolist():
            same[i] = xxhash.xxh128_digest(runs[starts[i] : ends[i]].tobytes())
        for i in np.flatnonzero(n_runs == 0).tolist():
            if listed[i]:
                same[i] = xxhash.xxh128_digest("\n".join(["", *listed[i]]))
        offsets = np.r_[0, np.cumsum(np.where(n_runs > 0, bands, 0))].astype(np.int32)
        return [pa.array(n_runs), pa.ListArray.from_arrays(pa.array(offsets), pa.array(shards.reshape(-1))), pa.array(same, pa.binary())]

    kind = docs.schema[key].dataType.simpleString()
    return spread(docs.select(key, text)).mapInArrow(run, f"`{key}` {kind}, {_PROFILE}")


def _each(run_words: int, make, names: list[str]):
    """For rows (rep, text): what ``make`` gives of the runs of some texts, a few texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                runs, ends = runs_of([words(t) for t in b.column(1).to_pylist()], run_words)
                yield pa.RecordBatch.from_arrays([b.column(0), *make(runs, ends)], names=["rep", *names])

    return run


def _sketches(run_words: int, bits: int):
    def make(runs: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        counts = np.diff(np.r_[0, ends])
        prints = odd_sketches(runs, np.repeat(np.arange(len(ends)), counts), len(ends), bits)
        return [pa.array(counts.astype(np.int32)), pa.array([p.tobytes() for p in prints], pa.binary())]

    return _each(run_words, make, ["n_runs", "print"])


def _runs(run_words: int):
    return _each(run_words, lambda runs, ends: [pa.ListArray.from_arrays(pa.array(np.r_[0, ends].astype(np.int32)), pa.array(runs.view(np.int64)))], ["runs"])


def _search_groups(similarity: float):
    """For rows sorted by (shard, tree, by, asks, n_runs): the pairs that the trees give."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for b in batches:
            rows = pa.Table.from_batches([b])
            rows = pa.concat_tables([kept, rows]).combine_chunks() if kept is not None else rows
            first = firsts(rows)
            last = int(first[-1]) if len(first) else 0  # the last group may go on in the next batch
            if last:
                yield found(rows.slice(0, last), first[:last])
            kept = rows.slice(last)
        if kept is not None and kept.num_rows:
            yield found(kept, firsts(kept))

    def firsts(rows: pa.Table) -> np.ndarray:
        """The first row of each row's group."""
        keys = [rows.column(c).to_numpy() for c in ("shard", "tree", "by")]
        new = np.zeros(rows.num_rows, bool)
        new[:1] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))

    def found(rows: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        prints = np.frombuffer(b"".join(rows.column("print").to_pylist()), np.uint8).reshape(rows.num_rows, -1).view(np.uint64)
        ids = rows.column("rep").combine_chunks()
        left, right, _ = search(prints, rows.column("n_runs").to_numpy().astype(np.int64), group, rows.column("asks").to_numpy(), similarity)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(left)), ids.take(pa.array(right))], names=["x", "y"])

    return run


class NearDuplicates:
    """The search over one table; its profile is written to the shared folder once."""

    def __init__(self, docs: DataFrame, key: str = "rec_id", text: str = "text", similarity: float = SIMILARITY, run_words: int = RUN_WORDS, min_runs: int = MIN_RUNS, bits: int = BITS, bands: int = BANDS, rows: int = ROWS, block_rows: int = BLOCK_ROWS) -> None:
        self.key, self.similarity, self.run_words, self.bits, self.block_rows = key, similarity, run_words, bits, block_rows
        self.kind = docs.schema[key].dataType.simpleString()
        self.docs = docs.select(F.col(key).alias("rep"), F.col(text).alias("text")).where("rep IS NOT NULL")
        self.all = cut(profiles(docs.where(F.col(key).isNotNull()), key, text, run_words, min_runs, bands, rows))
        least = self.all.where("same IS NOT NULL").groupBy("same").agg(F.min(key).alias("rep"))
        #: (key, rep, n_runs): the class of records with the same runs, named by its smallest id.
        self.members = self.all.select(key, "same", "n_runs").dropDuplicates([key]).join(least, "same", "left").select(key, F.coalesce("rep", key).alias("rep"), "n_runs")
        self.reps = self.all.where("n_runs > 0").join(least.select(F.col("rep").alias(key)), key, "left_semi").withColumnRenamed(key, "rep")

    def placed(self) -> DataFrame:
        """(shard, tree, by, asks, rep): the records of shards that hold two at least, for each meeting of blocks.

        Two copies of a long text with few edits meet in most of the bands. Of the shards with the same records, told
        by their number and a digest, one is kept: the others have the same tree and give the same pairs.
        """
        shards = self.reps.select(F.explode("shards").alias("shard"), "rep")
        counted = shards.groupBy("shard").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("rep")).alias("who")).where("n > 1")
        kept = small(counted.groupBy("n", "who").agg(F.min("shard").alias("shard")).select("shard", "n"))
        blocks = F.ceil(F.col("n") / self.block_rows).cast("int")
        block = F.pmod(F.xxhash64("rep", "shard"), F.col("blocks")).cast("int")
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        return (
            shards.join(kept, "shard").withColumn("blocks", blocks).withColumn("block", block)
            .select("shard", "rep", "block", other.alias("other"))
            .select("shard", "rep", F.least("block", "other").alias("tree"), F.greatest("block", "other").alias("by"), (F.col("block") > F.col("other")).alias("asks"))
        )

    def links(self) -> DataFrame:
        """(x, y, similarity): representatives of classes, x < y, at or above the threshold."""
        order = ["shard", "tree", "by", "asks", "n_runs", "rep"]
        placed = cut(self.placed())
        sketches = self.docs.join(small(placed.select("rep").distinct()), "rep", "left_semi").mapInArrow(_sketches(self.run_words, self.bits), f"rep {self.kind}, n_runs int, print binary")
        rows = placed.join(sketches, "rep").select(*order, "print").repartition("shard", "tree", "by").sortWithinPartitions(*order)
        found = rows.mapInArrow(_search_groups(self.similarity), f"x {self.kind}, y {self.kind}").where("x <> y")
        pairs = cut(found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
        met = pairs.select(F.col("x").alias("rep")).unionAll(pairs.select(F.col("y").alias("rep"))).distinct()
        runs = self.docs.join(small(met), "rep", "left_semi").mapInArrow(_runs(self.run_words), f"rep {self.kind}, runs array<bigint>")
        both = pairs.join(runs.select(F.col("rep").alias("x"), F.col("runs").alias("rx")), "x").join(runs.select(F.col("rep").alias("y"), F.col("runs").alias("ry")), "y")
        common = F.size(F.array_intersect("rx", "ry"))
        return (
            both.withColumn("common", common)
            .withColumn("similarity", F.col("common") / (F.size("rx") + F.size("ry") - F.col("common")))
            .where(F.col("similarity") >= self.similarity)
            .select("x", "y", "similarity")
            .distinct()  # texts delivered twice come twice
        )

    def pairs(self) -> DataFrame:
        """(rec_a, rec_b): every two records that are near-duplicates, the smaller id first."""
        key = self.key
        live = self.members.where("n_runs > 0")
        a = live.select(F.col("rep").alias("x"), F.col(key).alias("a"))
        b = live.select(F.col("rep").alias("y"), F.col(key).alias("b"))
        between = self.links().select("x", "y").join(a, "x").join(b, "y").select("a", "b")
        inside = a.join(b, F.col("x") == F.col("y")).where("a < b").select("a", "b")
        return between.unionAll(inside).select(F.least("a", "b").alias("rec_a"), F.greatest("a", "b").alias("rec_b"))

    def groups(self) -> DataFrame:
        """(key, group_id, links, copies): a row for each record; a group's name is its smallest id."""
        links = cut(self.links().select("x", "y"))
        labels = components(links)
        counts = links.select(F.explode(F.array("x", "y")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
        sizes = self.members.groupBy("rep").agg(F.count("*").alias("copies"))
        return (
            self.members.join(sizes, "rep")
            .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
            .join(counts, "rep", "left")
            .select(self.key, F.coalesce("label", "rep").alias("group_id"), F.coalesce("links", F.lit(0)).alias("links"), "copies")
        )


@registry.add(
    "p5_found",
    f"""
WITH d AS (SELECT DISTINCT rec_id, {WORDS_SQL.format('text')} AS w FROM tiny WHERE rec_id IS NOT NULL AND text IS NOT NULL),
r AS (SELECT DISTINCT rec_id, hash(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS run FROM (SELECT rec_id, w, unnest(range(1, len(w) - 1)) AS i FROM d) t),
n AS (SELECT rec_id, count(*) AS n FROM r GROUP BY rec_id HAVING count(*) >= 40),
c AS (SELECT a.rec_id AS x, b.rec_id AS y, count(*) AS n_both FROM r a JOIN r b ON a.run = b.run AND a.rec_id < b.rec_id GROUP BY ALL)
SELECT x AS rec_a, y AS rec_b FROM c JOIN n a ON a.rec_id = x JOIN n b ON b.rec_id = y WHERE n_both >= 0.6 * (a.n + b.n - n_both)""",
)
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return NearDuplicates(load(spark, sf_dir, "tiny")).pairs()


@registry.add("p5_groups")
def p5_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups at the production threshold for edited copies: five words, 0.8."""
    return NearDuplicates(load(spark, sf_dir, "tiny"), similarity=0.8, run_words=5, min_runs=1).groups()
