"""Queries over the rest of the sources, sinks, deduplication stages and runs."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Observation
from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.operators import dedup as D
from loamline.operators.graph import components
from loamline.operators.receipts import Receipts
from loamline.plans import pipelines
from loamline.plans.q_joins import exact_duplicates
from loamline.plans.q_tokens import _SEQ, TOKENIZERS, _sequences
from loamline.registry import Registry
from loamline.sources import binidx, files, warc
from loamline.sources.scratch import scratch
from loamline.tables import load

registry = Registry()
add = registry.add


@add("scan01_reader_by_format", "SELECT n_nationkey, n_name FROM nation")
def scan01(spark, sf_dir):
    where = scratch(spark)
    load(spark, sf_dir, "nation").write.json(where)
    return files.read_any(spark, where, "n_nationkey int, n_name string")


@add("scan14_one_format", "SELECT 'parquet' AS format")
def scan14(spark, sf_dir):
    return spark.createDataFrame([(files.one_format(files.discover(spark, sf_dir)),)], "format string")


@add("scan20_index_headers", f"SELECT len(t) AS length, count(*) AS n FROM {_SEQ} a GROUP BY 1")
def scan20(spark, sf_dir):
    """Lengths of the sequences by the index files alone."""
    where = scratch(spark)
    binidx.register(spark)
    _sequences(spark, sf_dir).select("t").write.format("binidx").mode("append").save(where)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b.column(0).to_pylist():
                _, lengths, _ = binidx.read_index(path.removeprefix("file://").removeprefix("file:"))
                yield pa.RecordBatch.from_arrays([pa.array(lengths.astype("int64"))], names=["length"])

    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.idx").load(where).select("path")
    return listed.mapInArrow(run, "length bigint").groupBy("length").agg(F.count("*").alias("n"))


@add("scan27_archive_members", "SELECT question_id || '.txt' AS member, question AS said FROM benchmark_mcq")
def scan27(spark, sf_dir):
    where = scratch(spark)
    rows = load(spark, sf_dir, "benchmark_mcq").select(F.concat("question_id", F.lit(".txt")).alias("member"), F.encode("question", "utf-8").alias("content"))
    files.write_zips(rows, where, "member", "content")
    return files.read_zips(spark, where).select("member", F.decode("content", "utf-8").alias("said"))


@add("sink04_sequence_spool", f"SELECT seq_id, t FROM {_SEQ} a WHERE seq_id = 7")
def sink04(spark, sf_dir):
    """Sequences written in order of their ids; one is found by the statistics of its row group."""
    where = scratch(spark)
    _sequences(spark, sf_dir).repartitionByRange(4, "seq_id").sortWithinPartitions("seq_id").write.parquet(where)
    return spark.read.parquet(where).where("seq_id = 7")


@add("sink06_overwritten", "SELECT r_regionkey, r_name FROM region")
def sink06(spark, sf_dir):
    where = scratch(spark)
    load(spark, sf_dir, "nation").write.json(where)
    load(spark, sf_dir, "region").write.mode("overwrite").json(where)
    return spark.read.schema("r_regionkey int, r_name string").json(where)


@add("sink12_blend_manifest", "SELECT name, max(weight) AS weight FROM data_blend_raw_phase1 WHERE weight > 0 GROUP BY name")
def sink12(spark, sf_dir):
    where = scratch(spark)
    live = load(spark, sf_dir, "data_blend_raw_phase1").where("weight > 0").groupBy("name").agg(F.max("weight").alias("weight"))
    live.groupBy().agg(F.sort_array(F.collect_list(F.struct("name", "weight"))).alias("train")).write.json(where)  # one entry a source
    return spark.read.schema("train array<struct<name:string,weight:double>>").json(where).select(F.inline("train"))


@add("sink14_row_checks", "SELECT src, count(*) AS n, count(*) FILTER (WHERE cot_content IS NULL) AS no_thought, count(*) FILTER (WHERE len(options) <> 4) AS odd_choices, count(*) FILTER (WHERE options[answer_index + 1] IS NULL) AS no_answer FROM benchmark_mcq GROUP BY src")
def sink14(spark, sf_dir):
    return load(spark, sf_dir, "benchmark_mcq").groupBy("src").agg(
        F.count("*").alias("n"), F.count_if(F.col("cot_content").isNull()).alias("no_thought"), F.count_if(F.size("options") != 4).alias("odd_choices"), F.count_if(F.try_element_at("options", F.col("answer_index") + 1).isNull()).alias("no_answer")
    )


@add("proj24_recursive_chunks")
def proj24(spark, sf_dir):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [(i, k, c) for i, t in enumerate(b.column(1).to_pylist()) for k, c in enumerate(T.recursive_chunks(t, 800, 120))]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([m[0] for m in made], pa.int64())), pa.array([m[1] for m in made], pa.int32()), pa.array([m[2] for m in made], pa.string())], names=["doc_id", "chunk", "said"])

    return load(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", "text").mapInArrow(run, "doc_id bigint, chunk int, said string")


@add("proj30_main_text", "SELECT question_id, trim(regexp_replace(question, '\\s+', ' ', 'g')) AS said FROM benchmark_mcq")
def proj30(spark, sf_dir):
    rows = load(spark, sf_dir, "benchmark_mcq")
    escaped = F.regexp_replace(F.regexp_replace("question", "&", "&amp;"), "<", "&lt;")
    page = F.concat(F.lit("<html><head><style>x{}</style></head><body><ul><li><a href='#'>Home</a></li><li><a>Next</a></li></ul><div><p>"), escaped, F.lit("</p></div><footer><a>more links here, all of them</a></footer></body></html>"))
    return rows.select("question_id", warc.main_text(page).alias("said"))


@add("join02_drop_fuzzy_duplicates")
def join02(spark, sf_dir):
    docs = load(spark, sf_dir, "tiny").select("rec_id", "text").distinct()
    lost = D.fuzzy_duplicates(docs, "rec_id", "text").where("rec_id <> `group`").select("rec_id")
    return docs.join(lost, "rec_id", "left_anti").select("rec_id")


@add("join16_shared_buckets", "SELECT a.vec_id AS x, min(b.vec_id) AS y FROM embeddings a JOIN embeddings b ON a.label = b.label AND b.vec_id < a.vec_id GROUP BY a.vec_id HAVING min(b.vec_id) = (SELECT min(vec_id) FROM embeddings c WHERE c.label = any_value(a.label))")
def join16(spark, sf_dir):
    """Rows of one bucket linked with its smallest id: as many links as rows, and the same components as all pairs."""
    e = load(spark, sf_dir, "embeddings").select("vec_id", "label")
    least = e.groupBy("label").agg(F.min("vec_id").alias("y"))
    return e.join(least, "label").where("vec_id <> y").select(F.col("vec_id").alias("x"), "y")


@add("dedup03_components", "WITH RECURSIVE r AS (SELECT p_partkey AS node, p_partkey AS label FROM part WHERE p_partkey > 0 UNION ALL SELECT node, label // 4 FROM r WHERE label // 4 > 0) SELECT node, min(label) AS label FROM r GROUP BY node")
def dedup03_components(spark, sf_dir):
    links = load(spark, sf_dir, "part").select(F.col("p_partkey").alias("x"), F.floor(F.col("p_partkey") / 4).alias("y")).where("y > 0")
    return components(links)


@add("dedup11_hash_check", "SELECT count(*) AS n FROM (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL) t WHERE k > 1) u")
def dedup11(spark, sf_dir):
    """Duplicates by digest are those by the text itself."""
    return exact_duplicates(spark, sf_dir).agg(F.count("*").alias("n"))


@add("agg25_checksums", "SELECT source, CAST(sum(CAST('0x' || left(md5(text), 12) AS BIGINT)) AS VARCHAR) AS checksum FROM documents WHERE text IS NOT NULL GROUP BY source")
def agg25(spark, sf_dir):
    """A checksum of each source's texts that doesn't depend on their order and adds up before the shuffle."""
    d = load(spark, sf_dir, "documents").where("text IS NOT NULL").select("source", F.conv(F.substring(F.md5("text"), 1, 12), 16, 10).cast("decimal(38,0)").alias("d"))
    return d.groupBy("source").agg(F.sum("d").cast("string").alias("checksum"))


@add("run05_verified_outputs", f"SELECT count(*) AS n, true AS whole FROM {_SEQ} a")
def run05(spark, sf_dir):
    """What was written is read again and held against what was to be written."""
    where = scratch(spark)
    binidx.register(spark)
    rows = _sequences(spark, sf_dir)
    rows.select("t").write.format("binidx").mode("append").save(where)
    back = spark.read.format("binidx").load(where).agg(F.count("*").alias("n"), F.sum(F.size("tokens")).alias("tokens"))
    return back.join(rows.agg(F.sum(F.size("t")).alias("wanted"))).select("n", (F.col("tokens") == F.col("wanted")).alias("whole"))


@add("run06_receipts", "SELECT * FROM (VALUES ('a', 'completed'), ('b', 'failed')) t(shard, status)")
def run06(spark, sf_dir):
    r = Receipts(spark, scratch(spark))
    r.once("plan", "a", lambda: '{"rows": 1}')
    r.started("plan", "b")
    r.failed("plan", "b", "no room")
    return r.table().select("shard", "status")


@add("run08_run_names", "SELECT 16 AS n, true AS alike")
def run08(spark, sf_dir):
    a, b = pipelines.run_hash(x=1, y="z"), pipelines.run_hash(y="z", x=1)
    return spark.createDataFrame([(len(a), a == b)], "n int, alike boolean")


@add("run09_vocabulary_sizes", "SELECT 50256 AS n")
def run09(spark, sf_dir):
    """The number of ids that a vocabulary file holds."""
    return spark.read.text(f"{TOKENIZERS}/byte_bpe_50k.tiktoken").agg(F.count("*").cast("int").alias("n"))


@add("run13_observed", "SELECT count(*) AS n, count(text) AS texts FROM documents")
def run13(spark, sf_dir):
    """Figures that are taken while a pipeline writes, without another pass."""
    seen = Observation("pipeline")
    docs = load(spark, sf_dir, "documents").observe(seen, F.count("*").alias("n"), F.count("text").alias("texts"))
    docs.select("doc_id", "text").write.parquet(scratch(spark))
    return spark.createDataFrame([(seen.get["n"], seen.get["texts"])], "n bigint, texts bigint")


@add("run19_curation_pipeline")
def run19(spark, sf_dir):
    """The curation pipeline over all documents: filters, both deduplications and buckets."""
    return pipelines.curate(load(spark, sf_dir, "documents").select("doc_id", "text", "lang"), "doc_id", "text").groupBy("bucket").agg(F.count("*").alias("n"))


@add("run19_packed_chats")
def run19_chats(spark, sf_dir):
    """The chat pipeline over all rows: render, tokenize, mask and pack."""
    from loamline.plans.q_tokens import _chats

    rows = pipelines.packed_chats(_chats(spark, sf_dir), "row_id", "messages", "tiktoken", f"{TOKENIZERS}/byte_bpe_50k.tiktoken", 4096)
    return rows.select("shard", "part", "bin", F.size("input_ids").alias("tokens"), F.size("seq_start_id").alias("sequences"))
