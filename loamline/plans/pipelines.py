"""Whole pipelines, put together from the operators: curation, token datasets, packed chats."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.functions.text import long_enough, word_count
from loamline.functions.tokens import tokenize
from loamline.operators import dedup
from loamline.operators.aggregates import bucketed
from loamline.operators.chat import render
from loamline.operators.packing import assign_bins, packed_rows
from loamline.operators.receipts import Receipts
from loamline.session import cut
from loamline.sources import binidx


def run_hash(**config) -> str:
    """The name of a run: alike for the same configuration."""
    return hashlib.sha256(json.dumps(config, sort_keys=True, default=str).encode()).hexdigest()[:16]


def curate(docs: DataFrame, key: str, text: str, min_chars: int = 100, words: tuple[int, int] = (50, 5000), fuzzy: bool = True) -> DataFrame:
    """Documents of fitting length, one of each text and of each group of near copies, with a quality bucket of 20."""
    kept = docs.where(long_enough(F.col(text), min_chars)).withColumn("n_words", word_count(F.col(text))).where(F.col("n_words").between(*words))
    kept = kept.join(dedup.exact_duplicate_ids(kept, key, text), key, "left_anti")
    if fuzzy:
        groups = dedup.fuzzy_duplicates(kept, key, text)
        kept = kept.join(groups.where(F.col(key) != F.col("group")).select(key), key, "left_anti")
    scored = kept.withColumn("score", F.char_length(text).cast("double") / F.col("n_words")).withColumn("bytes", F.octet_length(text).cast("bigint"))
    return bucketed(scored, "score", "bytes", list(range(5, 100, 5)))


def token_dataset(docs: DataFrame, key: str, text: str, folder: str, kind: str, vocabulary: str, min_chars: int = 0, max_tokens: int | None = None, end: int | None = None, dtype: str = "int32") -> dict:
    """Writes an indexed dataset of the documents' tokens, once for each configuration; gives its statistics."""
    spark = docs.sparkSession
    plan = run_hash(folder=folder, kind=kind, vocabulary=vocabulary, min_chars=min_chars, max_tokens=max_tokens, end=end, dtype=dtype)
    receipts = Receipts(spark, f"{folder}/receipts")
    target = f"{folder}/{plan}"
    binidx.register(spark)

    def work() -> str:
        made = tokenize(docs.where(long_enough(F.col(text), min_chars)), key, text, kind, vocabulary, end)
        rows = cut(made.select(F.slice("tokens", 1, max_tokens).alias("tokens") if max_tokens else "tokens", F.size("tokens").alias("n"), "error"))
        rows.where("tokens IS NOT NULL").select("tokens").write.format("binidx").option("dtype", dtype).mode("overwrite").save(target)
        stats = rows.agg(F.count("tokens").alias("sequences"), F.coalesce(F.sum(F.size("tokens")), F.lit(0)).alias("tokens"), F.count("error").alias("errors"), F.count_if(F.col("n") > (max_tokens or (1 << 31) - 1)).alias("cut"))
        return json.dumps(stats.first().asDict())

    receipts.once(plan, "all", work)
    done = receipts.table().where((F.col("plan") == plan) & (F.col("status") == "completed")).first()
    return {"path": target, **json.loads(done["stats"])}


def packed_chats(chats: DataFrame, key: str, messages: str, kind: str, vocabulary: str, capacity: int, shards: int = 16, tools: str | None = None) -> DataFrame:
    """(shard, part, bin, input_ids, loss_mask, seq_start_id) of conversations, packed by first fit.

    Every chunk of a rendered conversation is tokenized by itself; the loss is taken on the chunks to learn from.
    """
    turns = cut(render(chats, key, messages, tools).withColumn("seq", F.xxhash64(key, "sequence")))
    pieces = turns.select("seq", F.posexplode("chunks").alias("at", "c")).select(F.concat_ws("#", "seq", "at").alias("id"), "seq", "at", "c.text", "c.learn")
    made = tokenize(pieces, "id", "text", kind, vocabulary).where("tokens IS NOT NULL")
    whole = pieces.select("id", "seq", "at", "learn").join(made.select("id", "tokens"), "id").groupBy("seq").agg(F.sort_array(F.collect_list(F.struct("at", "learn", "tokens"))).alias("p"))
    mask = lambda p: F.transform(p["tokens"], lambda t: p["learn"].cast("tinyint"))
    seqs = cut(
        whole.select(F.pmod("seq", F.lit(shards)).cast("int").alias("shard"), "seq", F.flatten(F.transform("p", lambda p: p["tokens"])).alias("tokens"), F.flatten(F.transform("p", mask)).alias("mask")).withColumn("n", F.size("tokens"))
    )
    return packed_rows(seqs, assign_bins(seqs, "shard", "seq", "n", capacity), "shard", "seq", "tokens", "mask", capacity)
