"""Queries over sinks, plans of runs and streams."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.operators import runs as R
from loamline.plans.q_tokens import _SEQ, _sequences
from loamline.registry import Registry
from loamline.sources import binidx, tars
from loamline.sources.scratch import scratch
from loamline.streaming import events as E
from loamline.tables import load

registry = Registry()
add = registry.add


@add("sink01_indexed_dataset", f"SELECT t AS tokens FROM (SELECT seq_id, list_transform(t, lambda x: CAST(x AS BIGINT)) AS t FROM {_SEQ} a) b")
def sink01(spark, sf_dir):
    where = scratch(spark)
    binidx.register(spark)
    _sequences(spark, sf_dir).select("t").write.format("binidx").mode("append").save(where)
    return spark.read.format("binidx").load(where).select("tokens")


@add("sink02_json_lines", "SELECT rec_id, text FROM tiny WHERE text IS NOT NULL")
def sink02(spark, sf_dir):
    where = scratch(spark)
    load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", "text").write.option("compression", "gzip").json(where)
    return spark.read.schema("rec_id bigint, text string").json(where)


@add("sink03_packed_parquet", f"SELECT seq_id, t FROM {_SEQ} a")
def sink03(spark, sf_dir):
    where = scratch(spark)
    _sequences(spark, sf_dir).write.option("parquet.block.size", 8 << 20).option("compression", "zstd").parquet(where)
    return spark.read.parquet(where)


@add("sink05_partitioned", "SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1")
def sink05(spark, sf_dir):
    where = scratch(spark)
    load(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag").write.partitionBy("l_returnflag").parquet(where)
    return spark.read.parquet(where).where("l_returnflag = 'R'").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity"))


@add("sink07_tar_samples", "SELECT question_id AS key, question AS said FROM benchmark_mcq WHERE question IS NOT NULL")
def sink07(spark, sf_dir):
    where = scratch(spark)
    rows = load(spark, sf_dir, "benchmark_mcq").select(F.col("question_id").alias("key"), F.lit("txt").alias("extension"), F.encode("question", "utf-8").alias("content"))
    tars.write_tars(rows.repartition(3, "key"), where, "train")
    return tars.read_tars(spark, where).select("key", F.decode("content", "utf-8").alias("said"))


@add("sink08_member_index", "SELECT CAST(doc_id AS VARCHAR) AS key, CAST(512 + ceil(strlen(text) / 512) * 512 AS BIGINT) AS bytes, true AS aligned FROM documents WHERE text IS NOT NULL")
def sink08(spark, sf_dir):
    """The index of archives with a document a sample: a header and whole blocks each; only an archive's last sample reaches to its end."""
    where = scratch(spark)
    rows = load(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("key"), F.lit("txt").alias("extension"), F.encode("text", "utf-8").alias("content"))
    tars.write_tars(rows.repartition(8, "key"), where, "train")
    members = tars.read_tars(spark, where).select("archive", "key", "offset", F.octet_length("content").alias("n"))
    sizes = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(where).select(F.element_at(F.split("path", "/"), -1).alias("archive"), F.col("length").alias("bytes"))
    index = tars.member_index(members, sizes).join(members.select("archive", "key", "n"), ["archive", "key"])
    own = (512 + F.ceil(F.col("n") / 512) * 512).cast("bigint")
    last = F.col("sample") == F.max("sample").over(Window.partitionBy("archive"))
    return index.select("key", F.when(last & (F.col("bytes") >= own), own).otherwise(F.col("bytes")).cast("bigint").alias("bytes"), (F.col("offset") % 512 == 0).alias("aligned"))


@add("sink09_retrieval_files", "SELECT 'd' || b.vec_id AS corpus_id, 'q' || a.vec_id AS query_id, 1 AS score FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0")
def sink09(spark, sf_dir):
    """Corpus, queries and judgements as JSON lines and tab-separated values."""
    where = scratch(spark)
    e = load(spark, sf_dir, "embeddings").select("vec_id", "label")
    q = e.where("vec_id % 100 = 0")
    e.select(F.concat(F.lit("d"), "vec_id").alias("_id"), F.lit("").alias("title"), F.col("label").cast("string").alias("text")).write.json(f"{where}/corpus")
    q.select(F.concat(F.lit("q"), "vec_id").alias("_id"), F.col("label").cast("string").alias("text")).write.json(f"{where}/queries")
    judged = q.join(e.withColumnRenamed("vec_id", "other"), "label").where("vec_id <> other")
    judged.select(F.concat(F.lit("q"), "vec_id").alias("query-id"), F.concat(F.lit("d"), "other").alias("corpus-id"), F.lit(1).alias("score")).write.option("sep", "\t").option("header", "true").csv(f"{where}/qrels")
    back = spark.read.schema("`query-id` string, `corpus-id` string, score int").option("sep", "\t").option("header", "true").csv(f"{where}/qrels")
    known = spark.read.schema("_id string").json(f"{where}/corpus").withColumnRenamed("_id", "corpus-id")
    return back.join(known, "corpus-id", "left_semi").select(F.col("query-id").alias("query_id"), F.col("corpus-id").alias("corpus_id"), "score")


@add("sink10_retriever_training", "SELECT o_custkey AS question_id, list(o_orderkey ORDER BY o_orderkey) AS pos FROM orders GROUP BY o_custkey HAVING count(*) <= 5")
def sink10(spark, sf_dir):
    """Questions with their positives; a question of more than five is left out, before its positives are listed."""
    where = scratch(spark)
    found = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("question_id"), F.col("o_orderkey").alias("other"))
    few = found.groupBy("question_id").agg(F.count("*").alias("n")).where("n <= 5").select("question_id")
    found.join(few, "question_id", "left_semi").groupBy("question_id").agg(F.sort_array(F.collect_list("other")).alias("pos")).write.json(where)
    return spark.read.schema("question_id bigint, pos array<bigint>").json(where)


@add("sink11_split_folders", "SELECT split, count(*) AS n FROM (SELECT CASE WHEN source = 'scan' THEN 'valid' ELSE 'train' END AS split FROM documents) t GROUP BY split")
def sink11(spark, sf_dir):
    where = scratch(spark)
    load(spark, sf_dir, "documents").select("doc_id", F.when(F.col("source") == "scan", "valid").otherwise("train").alias("split")).write.partitionBy("split").parquet(where)
    return spark.read.parquet(where).groupBy("split").agg(F.count("*").alias("n"))


@add("sink13_threshold_file", "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS median FROM events GROUP BY event_type")
def sink13(spark, sf_dir):
    where = scratch(spark)
    load(spark, sf_dir, "events").groupBy("event_type").agg(F.round(F.percentile("value", F.lit(0.5)), 6).alias("median")).coalesce(1).write.json(where)
    return spark.read.schema("event_type string, median double").json(where)


@add("sink15_first_rows_of_subsets", "SELECT path, subset, record_id FROM (SELECT path, subset, record_id, row_number() OVER (PARTITION BY path, subset ORDER BY record_id) AS k FROM (SELECT DISTINCT path, subset, record_id FROM source_records WHERE n_tokens IS NOT NULL) t) u WHERE k <= 5")
def sink15(spark, sf_dir):
    rows = load(spark, sf_dir, "source_records").where("n_tokens IS NOT NULL").select("path", "subset", "record_id").distinct()
    return rows.withColumn("k", F.row_number().over(Window.partitionBy("path", "subset").orderBy("record_id"))).where("k <= 5").drop("k")


def _files(spark, sf_dir):
    return load(spark, sf_dir, "source_records").where("path IS NOT NULL").groupBy(F.coalesce("subset", F.lit("")).alias("dataset"), F.col("path").alias("file")).agg(F.count("*").alias("size"))


@add("run01_balanced_shards")
def run01(spark, sf_dir):
    return R.balanced(_files(spark, sf_dir), "dataset", "file", "size", 4)


_SHARES = """
f AS (SELECT coalesce(subset, '') AS dataset, path AS file, count(*) AS size FROM source_records WHERE path IS NOT NULL GROUP BY ALL),
e AS (SELECT *, size * 16 / sum(size) OVER (PARTITION BY dataset) AS exact FROM f WHERE dataset IN (SELECT dataset FROM f GROUP BY dataset HAVING count(*) <= 16)),
w AS (SELECT *, CAST(greatest(1, floor(exact)) AS BIGINT) AS whole FROM e),
r AS (SELECT *, 16 - sum(whole) OVER (PARTITION BY dataset) AS rest, row_number() OVER (PARTITION BY dataset ORDER BY exact - floor(exact) DESC, file) AS turn FROM w),
b AS (SELECT dataset, file, rest, row_number() OVER (PARTITION BY dataset ORDER BY exact - whole + nth, file) AS taken FROM (SELECT *, unnest(range(1, whole)) AS nth FROM r WHERE rest < 0) t),
l AS (SELECT dataset, file, count(*) AS less FROM b WHERE taken <= -rest GROUP BY ALL),
s AS (SELECT dataset, file, CAST(whole + CASE WHEN turn <= rest THEN 1 ELSE 0 END - coalesce(less, 0) AS BIGINT) AS share FROM r LEFT JOIN l USING (dataset, file))"""


def _few_files(spark, sf_dir):
    """Datasets of no more files than shards; others are balanced by file."""
    files = _files(spark, sf_dir)
    return files.join(files.groupBy("dataset").agg(F.count("*").alias("n")).where("n <= 16").select("dataset"), "dataset")


@add("run02_row_shards", f"WITH {_SHARES} SELECT dataset, file, share FROM s")
def run02(spark, sf_dir):
    return R.apportioned(_few_files(spark, sf_dir), "dataset", "file", "size", 16)


@add("run02_shards_add_up", "SELECT coalesce(subset, '') AS dataset, CAST(16 AS BIGINT) AS shares FROM source_records WHERE path IS NOT NULL GROUP BY coalesce(subset, '') HAVING count(DISTINCT path) <= 16")
def run02_sums(spark, sf_dir):
    return R.apportioned(_few_files(spark, sf_dir), "dataset", "file", "size", 16).groupBy("dataset").agg(F.sum("share").alias("shares"))


@add("run03_plan_hash", """SELECT name, left(sha256('{"name":"' || name || '","version":"1"}'), 16) AS plan FROM data_blend_raw_phase1""")
def run03(spark, sf_dir):
    return load(spark, sf_dir, "data_blend_raw_phase1").select("name", R.plan_hash(F.col("name").alias("name"), F.lit("1").alias("version")).alias("plan"))


@add("run04_pending_shards", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def run04(spark, sf_dir):
    o = load(spark, sf_dir, "orders")
    receipts = o.select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "completed").otherwise("started").alias("status"))
    return R.pending(o.select("o_orderkey"), receipts, ["o_orderkey"])


@add("run07_completed_receipts", "SELECT o_custkey, count(*) AS shards, max(o_orderdate) AS latest FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey")
def run07(spark, sf_dir):
    return load(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.count("*").alias("shards"), F.max("o_orderdate").alias("latest"))


@add("run10_enough_files", "SELECT dataset, file FROM (SELECT coalesce(subset, '') AS dataset, path AS file, count(*) AS size FROM source_records WHERE path IS NOT NULL GROUP BY ALL) f QUALIFY coalesce(sum(size) OVER (PARTITION BY dataset ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) < 40")
def run10(spark, sf_dir):
    return R.enough_files(_files(spark, sf_dir), "dataset", "file", "size", 20).select("dataset", "file")


@add("run12_byte_sizes", "SELECT doc_id, n_chars * 1024 AS kib, n_chars * 1073741824 AS gib, n_chars AS plain FROM documents")
def run12(spark, sf_dir):
    n = F.col("n_chars").cast("string")
    read = [T.bytes_of(F.concat(n, F.lit(unit))).alias(c) for unit, c in ((" kib", "kib"), ("GB", "gib"), ("", "plain"))]
    return load(spark, sf_dir, "documents").select("doc_id", *read)


@add(
    "run12_said_sizes",
    """SELECT record_id, CASE WHEN n < 1024 THEN n || 'B' WHEN n < 1048576 THEN CASE WHEN n % 1024 = 0 THEN (n // 1024) || 'KB' ELSE printf('%.1f', n / 1024) || 'KB' END
    WHEN n < 1073741824 THEN CASE WHEN n % 1048576 = 0 THEN (n // 1048576) || 'MB' ELSE printf('%.1f', n / 1048576) || 'MB' END ELSE CASE WHEN n % 1073741824 = 0 THEN (n // 1073741824) || 'GB' ELSE printf('%.1f', n / 1073741824) || 'GB' END END AS bytes,
    CASE WHEN n < 1000 THEN n || '' WHEN n < 1000000 THEN CASE WHEN n % 1000 = 0 THEN (n // 1000) || 'K' ELSE printf('%.1f', n / 1000) || 'K' END
    WHEN n < 1000000000 THEN CASE WHEN n % 1000000 = 0 THEN (n // 1000000) || 'M' ELSE printf('%.1f', n / 1000000) || 'M' END ELSE CASE WHEN n % 1000000000 = 0 THEN (n // 1000000000) || 'B' ELSE printf('%.1f', n / 1000000000) || 'B' END END AS many
    FROM (SELECT DISTINCT record_id, n_tokens * n_tokens AS n FROM source_records WHERE n_tokens > 0) t""",
)
def run12_said(spark, sf_dir):
    n = F.col("n_tokens") * F.col("n_tokens")
    return load(spark, sf_dir, "source_records").where("n_tokens > 0").select("record_id", n.alias("n")).distinct().select("record_id", T.said_bytes(F.col("n")).alias("bytes"), T.said_count(F.col("n")).alias("many"))


@add("run12_shard_counts", "SELECT path, greatest(1, CAST(ceil(sum(n_tokens) / 100000) AS BIGINT)) AS shards FROM source_records WHERE n_tokens > 0 GROUP BY path")
def run12_shards(spark, sf_dir):
    return load(spark, sf_dir, "source_records").where("n_tokens > 0").groupBy("path").agg(T.shards_for(F.sum("n_tokens"), F.lit(100_000)).alias("shards"))


@add("run14_stage_names", "SELECT DISTINCT source AS said, 'bin_idx_' || source AS plain FROM documents WHERE source IS NOT NULL")
def run14(spark, sf_dir):
    """Class names of stages, made of the kinds of origin, in their plain form."""
    rows = load(spark, sf_dir, "documents").where("source IS NOT NULL").select("source").distinct()
    return rows.select(F.col("source").alias("said"), T.snake(F.concat(F.lit("BinIdx"), F.initcap("source"), F.lit("Stage"))).alias("plain"))


@add("run15_latest_artifacts", "SELECT source_id, max(doc_id) AS version, arg_max(url, doc_id) AS url FROM documents WHERE url IS NOT NULL GROUP BY source_id")
def run15(spark, sf_dir):
    rows = load(spark, sf_dir, "documents").where("url IS NOT NULL").select("source_id", F.col("doc_id").alias("version"), "url")
    return R.latest_versions(rows, "source_id", "version")


@add("run16_lineage", "WITH RECURSIVE r AS (SELECT p_partkey, p_partkey // 3 AS ancestor, 1 AS depth FROM part WHERE p_partkey // 3 > 0 UNION ALL SELECT r.p_partkey, r.ancestor // 3, r.depth + 1 FROM r WHERE r.ancestor // 3 > 0) SELECT p_partkey, ancestor, depth FROM r")
def run16(spark, sf_dir):
    edges = load(spark, sf_dir, "part").select("p_partkey", F.floor(F.col("p_partkey") / 3).alias("parent")).where("parent > 0")
    return R.made_from(edges, "p_partkey", "parent")


@add("run17_unmet_inputs", "SELECT step, needs FROM (VALUES ('c', 'z'), ('e', 'x')) t(step, needs)")
def run17(spark, sf_dir):
    steps = spark.createDataFrame([("a", [], ["x"]), ("b", ["x"], ["y"]), ("c", ["y", "x", "z"], []), ("e", ["x"], ["z"])], "step string, needs array<string>, makes array<string>")
    return R.unmet(steps, spark.createDataFrame([("b", "a"), ("c", "b")], "step string, after string"))


@add("run18_resolved_names", "SELECT c_custkey, n_name || ':' || r_name AS resolved FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def run18(spark, sf_dir):
    n = load(spark, sf_dir, "nation").join(load(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.concat_ws(":", "n_name", "r_name").alias("resolved"))
    return load(spark, sf_dir, "customer").join(n, "c_nationkey").select("c_custkey", "resolved")


@add("stream01_tumbling", "SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events GROUP BY ALL")
def stream01(spark, sf_dir):
    """A stream over all files of the table, with its last state."""
    made = E.run_to_end(E.windowed(E.stream_of(spark, f"{sf_dir}/events.parquet"), "1 hour"), scratch(spark), "complete")
    return made.withColumn("start", F.col("start").cast("timestamp_ntz"))


@add("stream02_sliding", "SELECT to_timestamp(CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 - k * 1800)::TIMESTAMP AS start, event_type, count(*) AS n, round(sum(value), 4) AS value FROM events, (SELECT unnest([0, 1]) AS k) t GROUP BY ALL")
def stream02(spark, sf_dir):
    made = E.run_to_end(E.windowed(E.stream_of(spark, f"{sf_dir}/events.parquet"), "1 hour", "30 minutes"), scratch(spark), "complete")
    return made.withColumn("start", F.col("start").cast("timestamp_ntz"))


@add("stream03_sessions", """WITH o AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 2 HOURS THEN 0 ELSE 1 END AS new FROM events),
s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS k FROM (SELECT *, new FROM o) x)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOURS AS "end", count(*) AS n FROM s GROUP BY user_id, k""")
def stream03(spark, sf_dir):
    events = load(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    made = E.sessions(events, "2 hours")
    return made.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@add("stream04_first_seen", "SELECT count(DISTINCT event_id) AS n FROM events")
def stream04(spark, sf_dir):
    rows = E.first_seen(E.stream_of(spark, f"{sf_dir}/events.parquet").select("event_id", "ts"), ["event_id"])
    return E.run_to_end(rows, scratch(spark)).agg(F.count("*").alias("n"))


@add("stream05_batches_once", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream05(spark, sf_dir):
    where = scratch(spark)
    rows = E.stream_of(spark, f"{sf_dir}/events.parquet").select("event_id", "event_type")
    rows.writeStream.foreachBatch(E.once_per_batch(f"{where}/rows")).option("checkpointLocation", f"{where}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{where}/rows").groupBy("event_type").agg(F.count("*").alias("n"))


@add("rel01_pricing_summary", "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS quantity, round(sum(l_extendedprice * (1 - l_discount)), 2) AS net, round(avg(l_discount), 6) AS discount, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2")
def rel01(spark, sf_dir):
    kept = load(spark, sf_dir, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02 00:00:00'")
    return kept.groupBy("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("bigint").alias("quantity"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("net"), F.round(F.avg("l_discount"), 6).alias("discount"), F.count("*").alias("n"))


@add("rel02_revenue_by_nation", "SELECT n_name, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = c_nationkey JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def rel02(spark, sf_dir):
    li, o, c, s, n = (load(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "supplier", "nation"))
    joined = li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey).join(s, (li.l_suppkey == s.s_suppkey) & (s.s_nationkey == c.c_nationkey)).join(n, s.s_nationkey == n.n_nationkey)
    return joined.groupBy("n_name").agg(F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@add("rel03_json_properties", "SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM events GROUP BY event_type")
def rel03(spark, sf_dir):
    return load(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("bigint")).alias("k"))


@add("rel04_pivot", "SELECT l_returnflag, count(*) FILTER (WHERE l_linestatus = 'F') AS f, count(*) FILTER (WHERE l_linestatus = 'O') AS o FROM lineitem GROUP BY 1")
def rel04(spark, sf_dir):
    made = load(spark, sf_dir, "lineitem").groupBy("l_returnflag").pivot("l_linestatus", ["F", "O"]).count()
    return made.select("l_returnflag", F.coalesce("F", F.lit(0)).alias("f"), F.coalesce("O", F.lit(0)).alias("o"))


@add("tok11_sequences_by_source", "SELECT source, count(*) AS sequences, CAST(sum(least(n_chars, 8192)) AS BIGINT) AS held, CAST(0 AS BIGINT) AS overfull FROM documents WHERE n_chars > 0 GROUP BY source")
def pack_metrics(spark, sf_dir):
    """What the bins hold by source, and how many hold too much."""
    from loamline.operators.packing import assign_bins

    bins = assign_bins(load(spark, sf_dir, "documents").where("n_chars > 0"), "source", "doc_id", "n_chars", 8192)
    each = bins.groupBy("source", "part", "bin").agg(F.count("*").alias("n"), F.sum("n_chars").alias("held"))
    return each.groupBy("source").agg(F.sum("n").alias("sequences"), F.sum("held").alias("held"), F.count_if(F.col("held") > 8192).alias("overfull"))


