"""Problem 6: put documents, measured in tokens, into containers of fixed capacity.

``measure`` counts the tokens of each document with a public tokenizer; ``pack`` fills containers.

Large-item matching: documents above a third of the capacity go at most two into a container. They
are matched greedily, the largest first, each with the largest other one that still fits beside it.
The smaller documents then go, in falling order of size, each into the gap that it fills best; a new
container is opened only when no gap is large enough. A document larger than a container is cut into
full containers and a rest; the rest is packed like any other item. No other document is cut.

Packing is sequential by nature, so it runs in shards of bounded size that a hash of the document id
makes: a shard has at most about ``shard_rows`` pairs of id and size in memory, whatever the size of
the corpus, and loses at most the gaps of its last few containers.

Cases: null and empty texts have size 0 and go into any container. Repeated rows of a document count
once; rows with a null id are items of their own. The tokenizer can't take a run of a million blanks,
so every text is cut after each 10,000th blank in a row and its parts are counted. The default
vocabulary is one for many languages, as one for English doubles or trebles the size of other scripts.
An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.common import once
from loamline.registry import Registry
from loamline.session import cut, spread
from loamline.tables import load

registry = Registry()

CAPACITY = 4096
SHARD_ROWS = 50_000
VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how the public byte-level vocabulary splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_BLANKS = re.compile(r"\s{10000}")
_encoders: dict[str, object] = {}


def encoder(vocabulary: str):
    """The tokenizer of a file of ranks, read once in a process."""
    if vocabulary not in _encoders:
        import tiktoken

        with open(vocabulary, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[vocabulary] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _encoders[vocabulary]


def count_tokens(text: str | None, enc) -> int:
    if not text:
        return 0
    ends = [m.end() for m in _BLANKS.finditer(text)]
    return sum(len(enc.encode_ordinary(text[i:j])) for i, j in zip([0, *ends], [*ends, len(text)]))


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(key, size): the tokens of each row's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            sizes = pa.array([count_tokens(t, enc) for t in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), sizes], names=[key, "size"])

    kind = docs.schema[key].dataType.simpleString()
    return spread(docs.select(key, text)).mapInArrow(run, f"`{key}` {kind}, size bigint")


def fill(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Containers as lists of (index of the item, number of its piece, tokens)."""
    bins: list[list[tuple[int, int, int]]] = []
    items: list[tuple[int, int, int]] = []
    for i, n in enumerate(sizes):
        full, rest = divmod(n, capacity) if n > capacity else (0, n)
        for piece in range(full):
            bins.append([(i, piece, capacity)])
        if rest or not full:
            items.append((rest, i, full))
    items.sort(key=lambda x: (-x[0], x[1]))
    gaps: dict[int, list[int]] = defaultdict(list)
    open_gaps = 0  # bit g is set if a container has a gap of g

    def put(gap: int, b: int) -> None:
        nonlocal open_gaps
        gaps[gap].append(b)
        open_gaps |= 1 << gap

    def take(gap: int) -> int:
        nonlocal open_gaps
        b = gaps[gap].pop()
        if not gaps[gap]:
            open_gaps &= ~(1 << gap)
        return b

    n_large = sum(n * 3 > capacity for n, _, _ in items)
    waiting: dict[int, list[int]] = defaultdict(list)  # by size, the large items that have no partner yet
    sizes_waiting = 0
    for k in range(n_large):
        waiting[items[k][0]].append(k)
        sizes_waiting |= 1 << items[k][0]

    def remove(n: int, k: int | None = None) -> int:
        nonlocal sizes_waiting
        k = waiting[n].pop() if k is None else waiting[n].pop(waiting[n].index(k))
        if not waiting[n]:
            sizes_waiting &= ~(1 << n)
        return k

    done = [False] * n_large
    for k in range(n_large):
        if done[k]:
            continue
        n, i, piece = items[k]
        remove(n, k)
        done[k] = True
        bins.append([(i, piece, n)])
        partner = (sizes_waiting & ((1 << (capacity - n + 1)) - 1)).bit_length() - 1
        if partner > 0:
            j = remove(partner)
            done[j] = True
            bins[-1].append((items[j][1], items[j][2], partner))
            n += partner
        put(capacity - n, len(bins) - 1)
    for n, i, piece in items[n_large:]:
        fitting = open_gaps >> n
        if fitting:
            gap = n + (fitting & -fitting).bit_length() - 1
            b = take(gap)
        else:
            gap, b = capacity, len(bins)
            bins.append([])
        bins[b].append((i, piece, n))
        put(gap - n, b)
    return bins


def pack(sizes: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(key, piece, n_pieces, tokens, shard, container): where each document, or piece of one, went.

    ``sizes`` has the columns ``key`` and ``size``. (shard, container) names a container.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    kept = cut(once(sizes.select(key, F.greatest(F.coalesce("size", F.lit(0)), F.lit(0)).cast("bigint").alias("size")), key))
    shards = max(1, -(-kept.count() // shard_rows))
    kind = sizes.schema[key].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("size", "descending"), (key, "ascending")])
        n = table.column("size").to_pylist()
        bins = fill(n, capacity)
        rows = [(i, piece, tokens, b) for b, held in enumerate(bins) for i, piece, tokens in held]
        index = pa.array([r[0] for r in rows], pa.int64())
        return pa.table(
            {
                key: table.column(key).take(index),
                "piece": pa.array([r[1] for r in rows], pa.int32()),
                "n_pieces": pa.array([max(1, -(-n[r[0]] // capacity)) for r in rows], pa.int32()),
                "tokens": pa.array([r[2] for r in rows], pa.int64()),
                "shard": table.column("shard").take(index),
                "container": pa.array([r[3] for r in rows], pa.int32()),
            }
        )

    return (
        kept.withColumn("shard", F.pmod(F.xxhash64(key), F.lit(shards)).cast("int"))
        .groupBy("shard")
        .applyInArrow(run, f"`{key}` {kind}, piece int, n_pieces int, tokens bigint, shard int, container int")
    )


def packed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(measure(load(spark, sf_dir, "documents")))


@registry.add("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(spark, sf_dir).where("piece = 0 AND n_pieces > 1").select("doc_id")


@registry.add("p6_containers")
def p6_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(spark, sf_dir)


@registry.add("p6_fill")
def p6_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers are, by shard."""
    used = packed_documents(spark, sf_dir).groupBy("shard", "container").agg(F.sum("tokens").alias("tokens"))
    return used.groupBy("shard").agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), F.round(F.sum("tokens") / (F.count("*") * CAPACITY), 4).alias("filled"))
