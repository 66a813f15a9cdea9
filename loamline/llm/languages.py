"""Problem 8: the languages of documents and of the segments of mixed ones.

Language-bitmask n-gram filters: one bit-sliced Bloom filter holds, for every n-gram (four characters of
a word with its ends, short words whole, pairs of characters where no blanks are written), the set of
languages that it occurs in. A slot of the filter is a bitmask with one bit for each language, of as
many bytes as the languages need; the masks in an n-gram's slots are and-ed, so that one look-up gives all its languages. A word's score for
a language is the share of its n-grams that have the language's bit, less what the filter's fill
lets expect by chance, each n-gram shared out among its languages.

The filter is fitted on labelled documents, at most about ``train_docs`` of each language (chosen by a
hash of the id), since labels may be wrong or texts mixed: an n-gram is a language's own only if its
share of that language's documents is at least ``own_share`` of its greatest share in any language.

A document is read in units: words, or characters (half a unit) where no blanks are written. If no
stretch speaks against its main language, that language stands for the whole text. Otherwise the
most likely sequence of languages is found with a price on every change, and gives the segments. A
language belongs to a text if one of its segments has ``min_units`` units.

A stretch counts by itself, however long the text around it is; text in a language that the table
doesn't know belongs to none.

Cases: null, blank and near-blank texts (no stretch of ``min_units``) have no language and no segment.
Texts of any length are read whole. Labels are compared without case, outer blanks and region, as
two-letter code, three-letter code or English name; any other label names no language. Tables without
any usable label give no language. Empty tables give empty results. Repeated rows are repeated.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.registry import Registry
from loamline.session import cut, spread
from loamline.tables import load

registry = Registry()

TRAIN_DOCS = 400
MIN_UNITS = 25.0
FIRST_SHARE = 0.7
OWN_SHARE = 0.2
HASHES = 3
PRICE = 6.0
STRETCH = 16
MOST_LANGUAGES = 10_000

_WIDE = "぀-ヿ㐀-䶿一-鿿豈-﫿々〆"
_UNIT = re.compile(f"[{_WIDE}]+|[^\\W_{_WIDE}]+")
_HAS_WIDE = re.compile(f"[{_WIDE}]")
_held: dict[str, "Scorer"] = {}


def grams(unit: str) -> list[str]:
    """The n-grams of a unit. Numbers have none."""
    if _HAS_WIDE.match(unit):
        return [unit, unit[0]] if len(unit) > 1 else [unit]
    if unit.isdigit():
        return []
    w = f"^{unit}$"
    return [w] if len(w) <= 4 else [w[i : i + 4] for i in range(len(w) - 3)]


def units(text: str) -> list[str]:
    """Lower-cased words; where no blanks are written, each character with the one after it."""
    found = _UNIT.findall(text.lower())
    if not _HAS_WIDE.search(text):
        return found
    out = []
    for u in found:
        if _HAS_WIDE.match(u):
            out += [u[i : i + 2] for i in range(len(u))]
        else:
            out.append(u)
    return out


def _hashes(listed: list[str]) -> np.ndarray:
    import xxhash

    return np.fromiter((xxhash.xxh64_intdigest(g) for g in listed), np.uint64, len(listed))


class Filter:
    """A Bloom filter with a bitmask of languages in each slot."""

    def __init__(self, hashes: np.ndarray, spoken: np.ndarray, n_languages: int) -> None:
        """``spoken`` has a row for each n-gram and a column for each language."""
        self.n_languages = n_languages
        self.bits = max(12, int(np.ceil(np.log2(max(1, len(hashes)) * 12))))
        # A mask has as many bits as there are languages, in whole bytes.
        masks = np.packbits(spoken.reshape(len(hashes), n_languages), axis=1, bitorder="little")
        self.slots = np.zeros((1 << self.bits, masks.shape[1]), np.uint8)
        for at in self._places(hashes).T:
            np.bitwise_or.at(self.slots, at, masks)
        #: How often an n-gram seems to be of a language by chance.
        self.chance = np.unpackbits(self.slots, axis=1, count=n_languages, bitorder="little").mean(axis=0) ** HASHES if n_languages else np.zeros(0)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        step = (hashes >> np.uint64(32)) | np.uint64(1)
        return np.stack([((hashes + np.uint64(k) * step) & np.uint64((1 << self.bits) - 1)).astype(np.int64) for k in range(HASHES)], axis=1)

    def spoken(self, hashes: np.ndarray) -> np.ndarray:
        """For each n-gram (rows) the languages (columns) that the slots give it."""
        return np.unpackbits(np.bitwise_and.reduce(self.slots[self._places(hashes)], axis=1), axis=1, count=self.n_languages, bitorder="little")


class Scorer:
    """Scores of units; what a unit scores is worked out once in a process."""

    MOST = 400_000  # units kept; then it starts anew

    def __init__(self, codes: list[str], filter_: Filter) -> None:
        self.codes, self.filter = codes, filter_
        self._clear()

    def _clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.table = np.zeros((1 << 14, len(self.codes)), np.float32)
        self.weights = np.zeros(1 << 14, np.float32)

    def look_up(self, listed: list[str]) -> np.ndarray:
        """Row numbers of units in ``table`` and ``weights``."""
        if len(self.ids) > self.MOST:
            self._clear()
        ids = self.ids
        new = [u for u in dict.fromkeys(listed) if u not in ids]
        if new:
            start = len(ids)
            for k, u in enumerate(new, start):
                ids[u] = k
            while len(self.table) < len(ids):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.weights = np.concatenate([self.weights, np.zeros_like(self.weights)])
            listed_grams = [grams(u) for u in new]
            counts = np.array([len(g) for g in listed_grams])
            bits = self.filter.spoken(_hashes([g for gs in listed_grams for g in gs])).astype(np.float32)
            bits /= np.maximum(bits.sum(axis=1, keepdims=True), 1)
            row = np.repeat(np.arange(len(new)), counts)
            sums = np.zeros((len(new), len(self.codes)), np.float32)
            np.add.at(sums, row, bits)
            share = sums / np.maximum(counts, 1)[:, None]
            share = np.maximum(share - self.filter.chance, 0) / (1 - self.filter.chance)
            self.table[start : len(ids)] = share
            self.weights[start : len(ids)] = [0.5 if _HAS_WIDE.match(u) else 1.0 for u in new]
        return np.fromiter(map(ids.__getitem__, listed), np.int64, len(listed))

    @staticmethod
    def _spans(text: str, n: int) -> list[tuple[int, int]]:
        spans = [m.span() for m in _UNIT.finditer(text)]
        if len(spans) != n:  # characters of runs without blanks
            spans = [(i, i + 1) if _HAS_WIDE.match(text[s]) else (s, e) for s, e in spans for i in (range(s, e) if _HAS_WIDE.match(text[s]) else [s])]
        return spans

    def segments(self, text: str, at: np.ndarray, min_units: float, unknown: bool = False) -> list[tuple[int, float, int, int, float]]:
        """(language, confidence, start, end, units) along a text that may be mixed."""
        scores, weights = self.table[at], self.weights[at]
        # A language is likely if it leads, or nearly, over any stretch of the text, however long the rest is.
        sums = np.r_[np.zeros((1, len(self.codes))), np.cumsum(scores * weights[:, None], axis=0, dtype=np.float64)]
        stretch = sums[np.minimum(np.arange(len(at)) + STRETCH, len(at))] - sums[:-1]
        likely = np.flatnonzero((stretch >= np.maximum(0.6 * stretch.max(axis=1, keepdims=True), 0.5)).any(axis=0))
        if not len(likely):
            return []
        says = np.where(scores.sum(axis=1, keepdims=True) > 0.05, np.log(0.04 + scores[:, likely]), 0.0) * weights[:, None]
        if unknown:  # most of the text is in no language of the table: a state of its own takes these stretches
            counted = np.fromiter((not _number(text[a:b]) for a, b in self._spans(text, len(at))), bool, len(at))
            says = np.where(counted[:, None], np.log(0.04 + scores[:, likely]), 0.0) * weights[:, None]
            says = np.concatenate([says, np.where(counted, np.log(0.2), 0.0)[:, None] * weights[:, None]], axis=1)
        n, k = says.shape
        best = says[0].copy()
        back = np.empty((n, k), np.int16)
        keep = np.arange(k)
        for i in range(1, n):
            top = int(best.argmax())
            change = best[top] - PRICE > best
            back[i] = np.where(change, top, keep)
            best = np.where(change, best[top] - PRICE, best) + says[i]
        path = np.empty(n, np.int64)
        path[-1] = int(best.argmax())
        for i in range(n - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
        cuts = np.flatnonzero(np.r_[True, path[1:] != path[:-1], True])
        spans = self._spans(text, n)
        out = []
        for s, e in zip(cuts[:-1], cuts[1:]):
            speaks = scores[s:e].sum(axis=1) > 0.05
            size = float(weights[s:e].sum())
            if path[s] < len(likely) and size >= min_units and speaks.any():
                code = int(likely[path[s]])
                own = scores[s:e][speaks]
                rival = np.delete(own.sum(axis=0), code).max(initial=0.0)
                out.append((code, float(own[:, code].sum() / (own[:, code].sum() + rival)), spans[s][0], spans[min(e, len(spans)) - 1][1], size))
        return out

    def likelihoods(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For whole texts: the log-likelihood of each language (columns), the mean score of a unit and the units that aren't numbers."""
        listed = [[u for u in units(t) if not _number(u)] for t in texts]
        sizes = np.array([len(u) for u in listed], np.int64)
        says = np.zeros((len(texts), len(self.codes)))
        mean, weight = np.zeros(len(texts)), np.zeros(len(texts))
        some = np.flatnonzero(sizes)
        if len(some) and self.codes:
            at = self.look_up([u for us in listed for u in us])
            scores, weights = self.table[at], self.weights[at]
            starts = (np.cumsum(sizes) - sizes)[some]
            total = scores.sum(axis=1)
            says[some] = np.add.reduceat(np.log(0.04 + scores) * (weights * (total > 0.05))[:, None], starts)
            weight[some] = np.add.reduceat(weights, starts)
            mean[some] = np.add.reduceat(total * weights, starts) / weight[some]
        return says, mean, weight

    def read(self, texts: list[str | None], min_units: float) -> list[list[tuple[int, float, int, int, float]]]:
        """The segments of each text."""
        out: list[list[tuple[int, float, int, int, float]]] = [[] for _ in texts]
        if not self.codes:
            return out
        some, listed, sizes = [], [], []
        for i, t in enumerate(texts):
            u = units(t) if t else []
            if len(u) >= min_units:
                some.append(i)
                listed += u
                sizes.append(len(u))
        if not some:
            return out
        at = self.look_up(listed)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        scores, weights = self.table[at], self.weights[at]
        total = np.add.reduceat(scores * weights[:, None], starts)
        size = np.add.reduceat(weights, starts)
        main = total.argmax(axis=1)
        # A unit speaks against the main language if another one has much more of it.
        doc = np.repeat(np.arange(len(some)), sizes)
        own = scores[np.arange(len(at)), main[doc]]
        against = (scores.max(axis=1) > own + 0.35) * weights
        ran = np.r_[0.0, np.cumsum(against, dtype=np.float64)]
        ahead = np.minimum(np.arange(len(at)) + STRETCH, ends[doc])
        dense = np.maximum.reduceat(ran[ahead] - ran[:-1], starts)
        for j, i in enumerate(some):
            a, b = starts[j], ends[j]
            all_ = float(total[j].sum())
            if not all_ or all_ < 0.25 * size[j]:
                out[i] = self.segments(texts[i], at[a:b], min_units, unknown=True)
                continue
            share = float(total[j, main[j]]) / all_
            rival = float(np.delete(total[j], main[j]).max(initial=0.0))
            if dense[j] < 5.0 and share > 0.4:
                if size[j] >= min_units:
                    out[i] = [(int(main[j]), float(total[j, main[j]]) / (float(total[j, main[j]]) + rival), 0, len(texts[i]), float(size[j]))]
            else:
                out[i] = self.segments(texts[i], at[a:b], min_units)
        return out


def _number(unit: str) -> bool:
    return unit.isdigit()


def _table(codes: DataFrame) -> list:
    """The rows of the table of languages; more than there are languages in the world are an error."""
    rows = codes.select("code", "iso3", "english_name").limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"a table of languages has at most {MOST_LANGUAGES} rows")
    return rows


def named(label: Column, codes: DataFrame) -> Column:
    """The code that a label names, or null. ``codes`` is the small fixed table of languages."""
    pairs = {}
    for r in _table(codes):
        pairs |= {str(x).strip().lower(): r["code"] for x in r if x}
    if not pairs:
        return F.lit(None).cast("string")
    table = F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])
    tidy = F.lower(F.regexp_replace(label, r"^\s+|\s+$", ""))
    return F.coalesce(F.try_element_at(table, tidy), F.try_element_at(table, F.regexp_extract(tidy, r"^([a-z]{2,3})[-_][a-z0-9]+", 1)))


def fit(docs: DataFrame, codes: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", train_docs: int = TRAIN_DOCS, own_share: float = OWN_SHARE, first_share: float = FIRST_SHARE) -> tuple[list[str], Filter]:
    """The filter, fitted on about ``train_docs`` labelled documents of each language.

    Labels may be wrong more often than right for a rare language. A first, strict filter reads the
    chosen documents again; the second one is fitted on those in one language, as it was read.
    """
    listed = sorted({r["code"] for r in _table(codes) if r["code"] is not None})
    said = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), named(F.col(label), codes).alias("code")).where("code IS NOT NULL AND text IS NOT NULL")
    counts = {r["code"]: r["n"] for r in said.groupBy("code").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return listed, Filter(np.zeros(0, np.uint64), np.zeros((0, len(listed)), bool), len(listed))
    part = F.create_map(*[x for c, n in counts.items() for x in (F.lit(c), F.lit(min(1.0, train_docs / n)))])
    chosen = cut(spread(said).where(F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1_000_000)) < F.try_element_at(part, F.col("code")) * 1_000_000))
    first = listed, _filter(chosen, listed, first_share)
    read = segments(chosen, first, "key", "text", keep=("text",), min_units=MIN_UNITS)
    alone = read.groupBy("key").agg(F.min("lang").alias("code"), F.max("lang").alias("other"), F.first("text").alias("text")).where("code = other")
    return listed, _filter(cut(alone.select("text", "code")), listed, own_share)


def _filter(chosen: DataFrame, listed: list[str], own_share: float) -> Filter:
    number = {c: k for k, c in enumerate(listed)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, found = [np.zeros(0, np.int16)], [np.zeros(0, np.int64)]
            for t, c in zip(*(x.to_pylist() for x in b.columns)):
                h = np.unique(_hashes([g for u in set(units(t)) for g in grams(u)])).view(np.int64)
                found.append(h)
                own.append(np.full(len(h), number[c], np.int16))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own)), pa.array(np.concatenate(found))], names=["k", "gram"])

    n = {r["code"]: r["n"] for r in chosen.groupBy("code").agg(F.count("*").alias("n")).collect()}
    if not n:
        return Filter(np.zeros(0, np.uint64), np.zeros((0, len(listed)), bool), len(listed))
    per = F.create_map(*[x for c, m in n.items() for x in (F.lit(number[c]), F.lit(float(m)))])
    seen = chosen.select("text", "code").mapInArrow(run, "k smallint, gram bigint").groupBy("gram", "k").agg(F.count("*").alias("n"))
    shares = seen.where("n > 1").groupBy("gram").agg(F.collect_list(F.struct(F.col("k").cast("int").alias("k"), (F.col("n") / F.try_element_at(per, F.col("k").cast("int"))).alias("share"))).alias("of"))
    top = F.aggregate("of", F.lit(0.0), lambda a, x: F.greatest(a, x["share"]))
    own = F.transform(F.filter("of", lambda x: x["share"] >= own_share * F.col("top")), lambda x: x["k"])
    rows = shares.withColumn("top", top).select("gram", own.alias("own")).toArrow()  # of the size that train_docs bounds
    spoken = np.zeros((rows.num_rows, len(listed)), bool)
    lists = rows.column("own").combine_chunks()
    spoken[np.repeat(np.arange(rows.num_rows), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()] = True
    return Filter(rows.column("gram").to_numpy().view(np.uint64), spoken, len(listed))


def shared(spark: SparkSession, model: tuple[list[str], Filter]):
    """The model on all executors; its size is bounded by train_docs."""
    return spark.sparkContext.broadcast((uuid.uuid4().hex, *model))


def scorer_of(held) -> Scorer:
    """The scorer of a shared model, made once in a process."""
    name, codes, filter_ = held.value
    if name not in _held:
        _held.clear()
        _held[name] = Scorer(codes, filter_)
    return _held[name]


def segments(docs: DataFrame, model: tuple[list[str], Filter], key: str = "doc_id", text: str = "text", min_units: float = MIN_UNITS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, *keep, lang, confidence, start, end, units): the segments of each text; one for a text in one language."""
    held = shared(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, codes = scorer_of(held), held.value[1]
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                index, rows = [], []
                for i, found in enumerate(scorer.read(b.column(0).to_pylist(), min_units)):
                    index += [i] * len(found)
                    rows += found
                i = pa.array(index, pa.int64())
                cols = [pa.array([codes[r[0]] for r in rows], pa.string()), pa.array([round(r[1], 4) for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.int32()), pa.array([r[3] for r in rows], pa.int32()), pa.array([r[4] for r in rows], pa.float64())]
                yield pa.RecordBatch.from_arrays([*(c.take(i) for c in b.columns[1:]), *cols], names=[key, *keep, "lang", "confidence", "start", "end", "units"])

    carried = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in (key, *keep))
    return spread(docs.select(F.col(text).alias("__text"), key, *keep)).mapInArrow(run, f"{carried}, lang string, confidence double, start int, end int, units double")


def languages(docs: DataFrame, codes: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", **how) -> DataFrame:
    """(key, said, lang, confidence, segments, n_languages): a row for each language of each document."""
    model = fit(docs, codes, key, text, label, **how)
    said = docs.select(key, F.col(text).alias("text"), named(F.col(label), codes).alias("said"))
    found = segments(said, model, key, "text", keep=("said",))
    each = found.groupBy(key, "said", "lang").agg(F.max("confidence").alias("confidence"), F.count("*").alias("segments"))
    return each.groupBy(key, "said").agg(F.collect_list(F.struct("lang", "confidence", "segments")).alias("each")).select(
        key, "said", F.explode("each").alias("e"), F.size("each").alias("n_languages")
    ).select(key, "said", "e.*", "n_languages")


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return load(spark, sf_dir, "documents"), load(spark, sf_dir, "lang_codes")


@registry.add("p8_found")
def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = F.col("said").isNull() | (F.col("said") != F.col("lang")) | (F.col("n_languages") > 1)
    return languages(*_tables(spark, sf_dir)).where(wrong).select("doc_id", "lang")


@registry.add("p8_segments")
def p8_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, codes = _tables(spark, sf_dir)
    return segments(docs, fit(docs, codes))
