"""Problem 2: long exact spans that two or more records share, character by character.

The records' token k-mers are the edges of a De Bruijn graph that is kept sparse:

* A token is a run of at most 16 letters and digits, or else one character; longer runs (languages
  without blanks, encoded data) are tokens of one character each. What a token is depends only on the
  16 characters around it, so two records agree on the tokens of a shared span but for 16 characters
  at either end.
* The k-mer at a token is the shortest sequence of tokens from there that covers ``kmer_chars``
  characters. For every token the k-mer with the smallest hash is kept among those that start in the
  ``window`` characters from there. A span of ``min_chars`` holds a token whose window and k-mers lie within the
  agreed part, so two records that share one keep at least one k-mer in common: no shared span is lost.
* An edge runs from each kept k-mer to the next one of the record, which starts before the first one ends or where it
  ends. A k-mer that occurs in one record only is dropped. A path on which every occurrence of a k-mer has the
  same successor at the same distance, and every occurrence of that one the same predecessor, is compacted by
  joining k-mers with their neighbours, and only its head goes on; ``paths`` also gives the paths, by pointer jumping.
* Records that meet at a head are candidates. ``min_chars`` less the k-mer on either side of the head settle
  whether a span around it is long enough, so only this window of each text is carried along and compared.

Texts are never shuffled: k-mers are taken from them where they are read, and windows are cut out of them by a
join with the heads' places. Records with the same text are one class and enter the graph once. Only classes
that meet at a head are paired, through an equi-join that adaptive execution splits where one head is hot.

Cases: null texts and texts shorter than ``min_chars`` share nothing. Rows delivered twice count once.
A passage that occurs twice in one record only is no case. Each place of a k-mer in a record counts, places with the
same window once. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.registry import Registry
from loamline.session import cut, spread
from loamline.tables import load

registry = Registry()

MIN_CHARS = 400
RUN_CHARS = 16

_BASE = 0x9E3779B97F4A7C15 | 1
_tables: dict[str, np.ndarray] = {}


def _is_word() -> np.ndarray:
    if "word" not in _tables:
        _tables["word"] = np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)
    return _tables["word"]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("up", ())) < n:
        m = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(m, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.cumprod(steps)
    return _tables["up"][:n], _tables["down"][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def starts_of_tokens(codes: np.ndarray, starts: np.ndarray | None = None) -> np.ndarray:
    """Where tokens start in texts laid end to end; ``starts`` are the places where a text starts."""
    word = _is_word()[np.minimum(codes, 0x10FFFF)]
    border = np.r_[True, word[1:] != word[:-1], True]
    if starts is not None:
        border[starts] = True
    edge = np.flatnonzero(border)
    length = np.repeat(np.diff(edge), np.diff(edge))
    start = ~word | (length > RUN_CHARS)
    start[edge[:-1]] = True
    return np.flatnonzero(start)


def _hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(len(codes))
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(1)) * up)]
    return _mix((sums[ends] - sums[starts]) * down[starts])


def _least(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The place of the smallest of the ``counts[i]`` values from each i on, the first of equal ones."""
    best = np.arange(len(h))
    out = best.copy()
    level = np.int64(np.log2(counts))
    for k in range(int(level.max()) + 1):
        at = np.flatnonzero(level == k)
        a, b = best[at], best[at + counts[at] - (1 << k)]
        out[at] = np.where(h[b] < h[a], b, a)
        a, b = best[: -(1 << k)], best[1 << k :]
        best = np.where(h[b] < h[a], b, a)
    return out


def kmers(texts: list[str], kmer_chars: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, offset, hash) of the k-mers that are kept of each of a few texts."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    none = np.zeros(0, np.int64)
    if not len(codes):
        return none, none, none.astype(np.uint64)
    until = np.cumsum([len(t) for t in texts])
    begin = np.r_[0, until[:-1]]
    starts = starts_of_tokens(codes, begin[begin < len(codes)])
    ends = np.r_[starts[1:], len(codes)]
    row = np.searchsorted(until, starts, "right")
    upto = np.searchsorted(ends, starts + kmer_chars)
    last = ends[np.minimum(upto, len(ends) - 1)]
    whole = (upto < len(ends)) & (last <= until[row])
    starts, last, row = starts[whole], last[whole], row[whole]
    if not len(starts):
        return none, none, none.astype(np.uint64)
    h = _hashes(codes, starts, last)
    beyond = np.minimum(np.searchsorted(starts, starts + window), np.searchsorted(row, row, "right"))
    kept = np.unique(_least(h, beyond - np.arange(len(h))))
    return row[kept], starts[kept] - begin[row[kept]], h[kept]


def _places(kmer_chars: int, window: int, chars: int = 200_000):
    """For rows (key, same, chars, text): the kept k-mers of each text, a few texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(3).to_pylist()
            counts, offs, hashes = np.zeros(len(texts), np.int64), [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
            at = 0
            while at < len(texts):
                end, size = at + 1, len(texts[at])
                while end < len(texts) and size + len(texts[end]) <= chars:
                    size += len(texts[end])
                    end += 1
                row, off, h = kmers(texts[at:end], kmer_chars, window)
                counts[at:end] = np.bincount(row, minlength=end - at)
                offs.append(off.astype(np.int32))
                hashes.append(h.view(np.int64))
                at = end
            upto = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.ListArray.from_arrays(upto, pa.array(np.concatenate(offs))), pa.ListArray.from_arrays(upto, pa.array(np.concatenate(hashes)))],
                names=[*b.schema.names[:3], "offs", "hashes"],
            )

    return run


def _windows(size: int, kmer_chars: int):
    """The hashes of the windows of ``size`` characters that hold one of the given k-mers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rep, at, text in zip(b.column(0), b.column(1), b.column(2).to_pylist()):
                codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
                last = len(codes) - size
                steps = np.zeros(len(codes) + 2, np.int64)
                offs = at.values.to_numpy().astype(np.int64)
                np.add.at(steps, np.clip(offs + kmer_chars - size, 0, last + 1), 1)
                np.add.at(steps, np.clip(offs, -1, last) + 1, -1)
                starts = np.flatnonzero(np.cumsum(steps)[: last + 1] > 0)
                h = _hashes(codes, starts, starts + size).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([rep.as_py()] * len(starts), b.schema.field(0).type), pa.array(starts.astype(np.int32)), pa.array(h)], names=["rep", "start", "w"])

    return run


def _common(a: str, b: str, i: int, j: int) -> tuple[int, int, int]:
    """The longest span around a common position: its starts in both texts and its length."""

    def agree(same, most: int) -> int:
        low, step = 0, 64
        while low < most and same(low, min(most, low + step)):
            low, step = min(most, low + step), step * 2
        high = min(most, low + step)
        while low < high:  # the first ``low`` characters agree, ``high`` of them may
            mid = (low + high + 1) // 2
            low, high = (mid, high) if same(low, mid) else (low, mid - 1)
        return low

    right = agree(lambda x, y: a[i + x : i + y] == b[j + x : j + y], min(len(a) - i, len(b) - j))
    left = agree(lambda x, y: a[i - y : i - x] == b[j - y : j - x], min(i, j))
    return i - left, j - left, left + right


def shared_spans(a: str, b: str, coordinates: list[tuple[int, int]], min_chars: int) -> list[tuple[int, int, int]]:
    """The spans of two texts around common places: starts in both and length."""
    found: set[tuple[int, int, int]] = set()
    upto: dict[int, int] = {}  # the end in ``a`` of the last span of each diagonal
    for i, j in sorted(coordinates):
        if i >= upto.get(i - j, 0):
            found.add(x := _common(a, b, i, j))
            upto[i - j] = x[0] + x[2]
    return sorted(x for x in found if x[2] >= min_chars)


def _verify(min_chars: int):
    """Of pairs of windows with a common k-mer: those that share a span around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            four = zip(*(b.column(n).to_pylist() for n in ("wx", "wy", "ix", "iy")))
            kept = pa.array([k for k, (a, c, i, j) in enumerate(four) if _common(a, c, i, j)[2] >= min_chars], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(n).take(kept) for n in ("x", "y", "ox", "oy")], names=["x", "y", "ox", "oy"])

    return run


def _extend(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            index, spans = [], []
            for k, (at, a, c) in enumerate(zip(*(b.column(n).to_pylist() for n in ("at", "tx", "ty")))):
                found = shared_spans(a, c, [(p["x"], p["y"]) for p in at], min_chars)
                index += [k] * len(found)
                spans += found
            i = pa.array(index, pa.int64())
            three = [pa.array([s[n] for s in spans], pa.int32()) for n in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(0).take(i), b.column(1).take(i), *three], names=["x", "y", "start_x", "start_y", "chars"])

    return run


class SharedSpans:
    """The search over one table."""

    def __init__(self, docs: DataFrame, key: str = "rec_id", text: str = "text", min_chars: int = MIN_CHARS) -> None:
        if min_chars < 120:
            raise ValueError("spans of fewer than 120 characters are too short for this graph")
        # Of min_chars go 16 off at either end, 16 until the first token starts and 16 to end a k-mer with a token; what
        # is left is for the window and a k-mer. A k-mer is longer than a window by a token, so that it reaches the next one.
        left = min_chars - 4 * RUN_CHARS
        self.kmer_chars = (left + RUN_CHARS) // 2
        self.window = left - self.kmer_chars
        self.key, self.min_chars, self.kind = key, min_chars, docs.schema[key].dataType.simpleString()
        self.rows = docs.select(F.col(key), F.col(text).alias("text")).where(F.col(key).isNotNull() & (F.char_length(text) >= min_chars))
        named = spread(self.rows.select(key, F.unhex(F.md5("text")).alias("same"), F.char_length("text").alias("chars"), "text"))
        self.places = cut(named.mapInArrow(_places(self.kmer_chars, self.window), f"`{key}` {self.kind}, same binary, chars int, offs array<int>, hashes array<bigint>"))
        #: (key, rep, chars): the class of records with the same text, named by its smallest id.
        sized = self.places.select(key, "same", "chars").dropDuplicates([key])
        self.members = sized.join(sized.groupBy("same").agg(F.min(key).alias("rep")), "same").select(key, "rep", "chars")

    def _texts(self, some: DataFrame) -> DataFrame:
        """``some``, rows with a column ``rep``, with the texts, which are read again for that; texts delivered twice come twice."""
        return some.join(self.rows.select(F.col(self.key).alias("rep"), "text"), "rep")

    def graph(self) -> tuple[DataFrame, DataFrame]:
        """The edges at k-mers that occur in two classes at least, and these k-mers with their only neighbours."""
        reps = self.members.where(F.col(self.key) == F.col("rep")).select(F.col("rep").alias(self.key))
        hop = F.transform(
            "hashes",
            lambda x, i: F.struct(
                F.get("offs", i).alias("off"), x.alias("h"), F.get("hashes", i + 1).alias("after"), F.get("hashes", i - 1).alias("before"), (F.get("offs", i + 1) - F.get("offs", i)).alias("gap")
            ),
        )
        every = self.places.join(reps, self.key, "left_semi").select(F.col(self.key).alias("rep"), F.inline(hop))
        shared = every.groupBy("h").agg(F.min("rep").alias("r0"), F.max("rep").alias("r1")).where("r0 < r1").select("h")
        edges = cut(every.join(shared, "h", "left_semi").distinct())
        one = lambda c: (F.min(c) == F.max(c)) & (F.count(c) == F.count("*"))
        nodes = cut(
            edges.groupBy("h")
            .agg(F.when(one("after") & one("gap") & (F.min("after") != F.col("h")), F.min("after")).alias("next"), F.when(one("before") & (F.min("before") != F.col("h")), F.min("before")).alias("last"))
        )
        return edges, nodes

    @staticmethod
    def inner(nodes: DataFrame) -> DataFrame:
        """(h, to): the k-mers inside a path, each with the one before it."""
        step = nodes.where("next IS NOT NULL").select(F.col("h").alias("last"), F.col("next").alias("h"))
        return nodes.join(step, ["h", "last"], "left_semi").select("h", F.col("last").alias("to"))

    def heads(self) -> DataFrame:
        """(h, rep, off): the heads of compacted paths and where they occur. Every record on a path holds its head."""
        edges, nodes = self.graph()
        heads = nodes.select("h").join(self.inner(nodes).select("h"), "h", "left_anti")
        return edges.join(heads, "h", "left_semi").select("h", "rep", "off")

    def paths(self) -> DataFrame:
        """(head, kmers, records): the compacted paths, their length and the number of classes on them.

        Each k-mer points to the one before it; in every round it points twice as far, so there are as
        many rounds as the length of the longest path has binary digits.
        """
        edges, nodes = self.graph()
        jump = cut(self.inner(nodes))
        while True:
            beyond = jump.select(F.col("h").alias("to"), F.col("to").alias("beyond"))
            jump = cut(jump.select("h", "to").join(beyond, "to", "left").select("h", F.coalesce("beyond", "to").alias("to"), F.col("beyond").isNotNull().alias("moved")))
            if jump.where("moved").isEmpty():
                break
            jump = jump.select("h", "to")
        lengths = jump.groupBy(F.col("to").alias("h")).agg(F.count("*").alias("behind"))
        inside = nodes.join(jump.select("h"), "h", "left_anti")
        records = edges.join(inside.select("h"), "h", "left_semi").select("h", "rep").distinct().groupBy("h").agg(F.count("*").alias("records"))
        heads = inside.join(lengths, "h", "left").join(records, "h")
        return heads.select(F.col("h").alias("head"), (F.coalesce("behind", F.lit(0)) + 1).alias("kmers"), "records")

    def meetings(self) -> DataFrame:
        """(x, y, ox, oy): heads at which two classes share a span, x < y, with the places in both texts."""
        beside = self.min_chars - self.kmer_chars
        begin = F.greatest(F.col("off") - beside, F.lit(0))
        windows = (
            self._texts(self.heads())
            .select("h", "rep", "off", (F.col("off") - begin).alias("i"), F.substring("text", begin + 1, F.col("off") - begin + self.min_chars).alias("w"))
            .groupBy("h", "rep", "i", "w").agg(F.min("off").alias("off"))  # places with the same window settle the same
        )
        a = windows.select("h", F.col("rep").alias("x"), F.col("off").alias("ox"), F.col("i").alias("ix"), F.col("w").alias("wx"))
        b = windows.select("h", F.col("rep").alias("y"), F.col("off").alias("oy"), F.col("i").alias("iy"), F.col("w").alias("wy"))
        met = a.join(b, "h").where("x < y").select("x", "y", "ox", "oy", "ix", "iy", "wx", "wy")
        return met.mapInArrow(_verify(self.min_chars), f"x {self.kind}, y {self.kind}, ox int, oy int")

    def spans(self) -> DataFrame:
        """(x, y, start_x, start_y, chars): whole spans that two classes share, x < y."""
        pairs = self.meetings().groupBy("x", "y").agg(F.collect_list(F.struct(F.col("ox").alias("x"), F.col("oy").alias("y"))).alias("at"))  # no more than the heads of a text
        one = self._texts(pairs.withColumnRenamed("x", "rep")).withColumnsRenamed({"rep": "x", "text": "tx"}).dropDuplicates(["x", "y"])
        both = self._texts(one.withColumnRenamed("y", "rep")).withColumnsRenamed({"rep": "y", "text": "ty"}).dropDuplicates(["x", "y"])
        return both.select("x", "y", "at", "tx", "ty").mapInArrow(_extend(self.min_chars), f"x {self.kind}, y {self.kind}, start_x int, start_y int, chars int")

    def pairs(self) -> DataFrame:
        """(rec_a, rec_b): every two records that share a span, the smaller id first."""
        a = self.members.select(F.col("rep").alias("x"), F.col(self.key).alias("a"))
        b = self.members.select(F.col("rep").alias("y"), F.col(self.key).alias("b"))
        between = self.meetings().select("x", "y").distinct().join(a, "x").join(b, "y").select("a", "b")
        inside = a.join(b, F.col("x") == F.col("y")).where("a < b").select("a", "b")
        return between.unionAll(inside).select(F.least("a", "b").alias("rec_a"), F.greatest("a", "b").alias("rec_b"))

    def shares(self) -> DataFrame:
        """(key, text_class, copies, shared_chars, shared): how much of each record others have too.

        No pairs are made: only windows of ``min_chars`` around k-mers that occur in two classes can be
        shared, so these are hashed (64 bits), each hash is pre-aggregated to its smallest and largest class, and
        the windows of more than one class are laid over each text.
        """
        edges, _ = self.graph()
        met = edges.groupBy("rep").agg(F.collect_list("off").alias("at"))  # no more than the text is long
        rows = cut(self._texts(met).dropDuplicates(["rep"]).select("rep", "at", "text").mapInArrow(_windows(self.min_chars, self.kmer_chars), f"rep {self.kind}, start int, w bigint"))
        common = rows.groupBy("w").agg(F.min("rep").alias("r0"), F.max("rep").alias("r1")).where("r0 < r1").select("w")
        before = Window.partitionBy("rep").orderBy("start")
        found = rows.join(common, "w", "left_semi").withColumn("last", F.lag("start").over(before))
        covered = found.groupBy("rep").agg(F.sum(F.coalesce(F.least(F.col("start") - F.col("last"), F.lit(self.min_chars)), F.lit(self.min_chars))).alias("covered"))
        copies = self.members.groupBy("rep").agg(F.count("*").alias("copies"))
        chars = F.when(F.col("copies") > 1, F.col("chars")).otherwise(F.coalesce("covered", F.lit(0)))
        return (
            self.members.join(copies, "rep").join(covered, "rep", "left")
            .select(self.key, F.col("rep").alias("text_class"), "copies", chars.cast("bigint").alias("shared_chars"), F.round(chars / F.col("chars"), 6).alias("shared"))
        )


@registry.add(
    "p2_found",
    """
WITH d AS (SELECT DISTINCT rec_id, text FROM tiny WHERE rec_id IS NOT NULL AND length(text) >= 400),
w AS (SELECT DISTINCT rec_id, hash(substr(text, i, 400)) AS span FROM (SELECT rec_id, text, unnest(range(1, length(text) - 398)) AS i FROM d) t)
SELECT DISTINCT a.rec_id AS rec_a, b.rec_id AS rec_b FROM w a JOIN w b ON a.span = b.span AND a.rec_id < b.rec_id""",
)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SharedSpans(load(spark, sf_dir, "tiny")).pairs()


@registry.add("p2_shares")
def p2_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SharedSpans(load(spark, sf_dir, "tiny")).shares()


@registry.add("p2_paths")
def p2_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SharedSpans(load(spark, sf_dir, "tiny")).paths()
