"""Problem 7: passages of evaluation items that occur in the training corpus.

One Aho-Corasick automaton is built over the items' normalised texts (words, lower-cased, one blank
between them) and every document's normalised text is scanned with it once. The automaton holds
blocks of words: a shared run of ``min_words`` words contains at least one whole block of
``(min_words + 1) // 2`` words that starts at a multiple of its length in the item, so that the blocks
find every run, with an automaton a tenth the size of all runs. Each hit is then extended word by
word to both sides; a run counts from ``min_words`` words on. Offsets are mapped back to the original
text.

The items are a held-out set of bounded size: up to ``max_item_words`` words go into one automaton,
which is broadcast. Beyond that the items are split by a hash of their id and the corpus is scanned
once for each part, so the memory of a worker stays bounded.

Cases: null and blank texts, and items with fewer than ``min_words`` words, give nothing. Repeated
items or documents give the row once in ``leaked``; ``passages`` has a row for each occurrence. Texts
of any length are scanned whole. Empty tables give empty results.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm.common import WORD, WORDS_SQL, words
from loamline.registry import Registry
from loamline.session import spread
from loamline.tables import load

registry = Registry()

MIN_WORDS = 13
MAX_ITEM_WORDS = 2_000_000

_built: dict[str, tuple] = {}


def build(fields: list[tuple[str, str, str]], min_words: int):
    """The automaton over the blocks of (id, field, text), and the fields' words."""
    import ahocorasick

    block = (min_words + 1) // 2
    places: dict[str, list[tuple[int, int]]] = {}
    texts = []
    for n, (_, _, text) in enumerate(fields):
        texts.append(own := words(text))
        if len(own) >= min_words:
            for at in range(0, len(own) - block + 1, block):
                places.setdefault(" " + " ".join(own[at : at + block]) + " ", []).append((n, at))
    automaton = ahocorasick.Automaton()
    for pattern, where in places.items():
        automaton.add_word(pattern, (len(pattern), where))
    if places:
        automaton.make_automaton()
    return automaton if places else None, texts


def scan(text: str, automaton, texts: list[list[str]], min_words: int) -> list[tuple[int, int, int, int, int]]:
    """(field, its first word, words, start and end in ``text``) of each run that ``text`` shares."""
    flat = " " + " ".join(WORD.findall(text)).lower() + " "
    hits = list(automaton.iter(flat))
    if not hits:
        return []
    own, spans = flat.split(), [m.span() for m in WORD.finditer(text)]
    found, before, counted = set(), 0, 0
    for end, (length, where) in hits:
        start = end - length + 1
        before += flat.count(" ", counted, start) if start >= counted else -flat.count(" ", start, counted)
        counted = start
        for n, at in where:
            other, a, b = texts[n], before, at
            while a and b and own[a - 1] == other[b - 1]:
                a, b = a - 1, b - 1
            c, d = before, at
            while c < len(own) and d < len(other) and own[c] == other[d]:
                c, d = c + 1, d + 1
            if c - a >= min_words:
                found.add((n, b, c - a, spans[a][0], spans[c - 1][1]))
    return sorted(found)


def passages(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "question_id", fields: tuple[str, ...] = ("question", "cot_content"), min_words: int = MIN_WORDS, max_item_words: int = MAX_ITEM_WORDS) -> DataFrame:
    """(key, item, field, first_word, n_words, start, end): each run of words that a document shares with an item."""
    long = items.select(F.col(item).cast("string").alias("item"), F.explode(F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f"`{f}`"))])).alias("field", "said")).where("said IS NOT NULL AND item IS NOT NULL").distinct()
    size = long.agg(F.coalesce(F.sum(F.size(F.split("said", r"[^\p{L}\p{N}]+"))), F.lit(0))).first()[0]
    parts = max(1, -(-size // max_item_words))
    kind = docs.schema[key].dataType.simpleString()
    rows = spread(docs.select(key, text))
    result = None
    for part in range(parts):
        chosen = long if parts == 1 else long.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        held = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, sorted((r["item"], r["field"], r["said"]) for r in chosen.collect())))

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            name, listed = held.value
            if name not in _built:
                _built.clear()
                _built[name] = build(listed, min_words)
            automaton, texts = _built[name]
            for b in batches:
                rows = []
                for i, t in enumerate(b.column(1).to_pylist() if automaton else []):
                    if t:
                        rows += [(i, *listed[n][:2], *rest) for n, *rest in scan(t, automaton, texts, min_words)]
                index, *cols = zip(*rows) if rows else [()] * 7
                kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(index, pa.int64())), *map(pa.array, map(list, cols), kinds)], names=[key, "item", "field", "first_word", "n_words", "start", "end"])

        one = rows.mapInArrow(run, f"`{key}` {kind}, item string, field string, first_word int, n_words int, start int, end int")
        result = one if result is None else result.unionAll(one)
    return result.withColumnRenamed("item", item)


def leaked(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """(key, item): the documents that give an item away, each pair once."""
    found = passages(docs, items, **how)
    return found.select(*found.columns[:2]).distinct()


@registry.add(
    "p7_found",
    f"""
WITH q AS (SELECT question_id, {WORDS_SQL.format('question')} AS w FROM benchmark_mcq UNION ALL SELECT question_id, {WORDS_SQL.format('cot_content')} FROM benchmark_mcq),
g AS (SELECT DISTINCT question_id, hash(array_to_string(w[i:i + 12], ' ')) AS run FROM (SELECT question_id, w, unnest(range(1, len(w) - 11)) AS i FROM q) t),
d AS (SELECT doc_id, {WORDS_SQL.format('text')} AS w FROM documents),
h AS (SELECT DISTINCT doc_id, hash(array_to_string(w[i:i + 12], ' ')) AS run FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d) t)
SELECT DISTINCT doc_id, question_id FROM h JOIN g USING (run)""",
)
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaked(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark_mcq"))


@registry.add("p7_passages")
def p7_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark_mcq"))
