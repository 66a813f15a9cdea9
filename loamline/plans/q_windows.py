"""Queries over windows, sampling, splits, order and sets."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loamline.operators import splits as S
from loamline.plans.q_shaping import SFT, sft
from loamline.registry import Registry
from loamline.tables import load

registry = Registry()
add = registry.add


@add("win01_first_best", "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber) AS k FROM lineitem) t WHERE k = 1")
def win01(spark, sf_dir):
    w = Window.partitionBy("l_orderkey").orderBy(F.desc("l_extendedprice"), "l_linenumber")
    return load(spark, sf_dir, "lineitem").withColumn("k", F.row_number().over(w)).where("k = 1").select("l_orderkey", "l_linenumber")


@add("win02_running_offsets", "SELECT o_custkey, o_orderkey, CAST(coalesce(sum(CAST(o_totalprice AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS off FROM (SELECT o_custkey, o_orderkey, floor(o_totalprice) AS o_totalprice FROM orders) t")
def win02(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey").rowsBetween(Window.unboundedPreceding, -1)
    return load(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.coalesce(F.sum(F.floor("o_totalprice")).over(w), F.lit(0)).alias("off"))


@add("win03_sizes_from_offsets", "SELECT user_id, event_id, coalesce(lead(event_id) OVER (PARTITION BY user_id ORDER BY event_id) - event_id, CAST(ceil(event_id / 512) * 512 AS BIGINT) - event_id) AS size FROM events")
def win03(spark, sf_dir):
    w = Window.partitionBy("user_id").orderBy("event_id")
    last = (F.ceil(F.col("event_id") / 512) * 512).cast("bigint")
    return load(spark, sf_dir, "events").select("user_id", "event_id", F.coalesce(F.lead("event_id").over(w), last).alias("next")).select("user_id", "event_id", (F.col("next") - F.col("event_id")).alias("size"))


@add("win04_page_windows", "SELECT l_orderkey, CAST(floor((k - 1) / 2) AS BIGINT) AS win, list(l_linenumber ORDER BY k) AS pages FROM (SELECT l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS k FROM lineitem) t GROUP BY ALL HAVING count(*) = 2")
def win04(spark, sf_dir):
    """Whole windows of two; the rest of a document is dropped."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")
    pages = load(spark, sf_dir, "lineitem").withColumn("k", F.row_number().over(w)).groupBy("l_orderkey", F.floor((F.col("k") - 1) / 2).alias("win")).agg(F.sort_array(F.collect_list(F.struct("k", "l_linenumber"))).alias("p"))
    return pages.where("size(p) = 2").select("l_orderkey", "win", F.transform("p", lambda x: x["l_linenumber"]).alias("pages"))


@add("win05_row_shards", "SELECT event_type, event_id, CAST(floor((row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) / 100) AS BIGINT) AS shard FROM events")
def win05(spark, sf_dir):
    w = Window.partitionBy("event_type").orderBy("event_id")
    return load(spark, sf_dir, "events").select("event_type", "event_id", F.floor((F.row_number().over(w) - 1) / 100).alias("shard"))


@add("win06_last_rows_held_out", "SELECT file_name, doc_id, CASE WHEN n > 20 AND k > n - 20 THEN 'val' ELSE 'train' END AS split FROM (SELECT file_name, doc_id, row_number() OVER (PARTITION BY file_name ORDER BY doc_id) AS k, count(*) OVER (PARTITION BY file_name) AS n FROM documents) t")
def win06(spark, sf_dir):
    return S.last_rows(load(spark, sf_dir, "documents").select("file_name", "doc_id"), "file_name", "doc_id", 20)


@add("win07_latest_plan", "SELECT source_id, arg_max(doc_id, (crawled_at, doc_id)) AS latest FROM documents GROUP BY source_id")
def win07(spark, sf_dir):
    return load(spark, sf_dir, "documents").groupBy("source_id").agg(F.max_by("doc_id", F.struct("crawled_at", "doc_id")).alias("latest"))


@add("win08_shards_to_splits", "SELECT c_custkey, CASE WHEN k <= 10 THEN 'test' WHEN k <= 25 THEN 'valid' ELSE 'train' END AS split FROM (SELECT c_custkey, row_number() OVER (ORDER BY md5('7:' || c_custkey), c_custkey) AS k FROM customer) t")
def win08(spark, sf_dir):
    return S.shard_splits(load(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", test=10, valid=15, seed=7)


@add("win09_ratio_to_shards", "SELECT p_size, CASE WHEN p_size <= 2 THEN p_size ELSE greatest(1, p_size - CASE WHEN p_size * 0.02 > 0 THEN greatest(1, CAST(round(p_size * 0.02) AS INT)) ELSE 0 END * 2) END AS train FROM (SELECT DISTINCT p_size FROM part) t")
def win09(spark, sf_dir):
    sizes = load(spark, sf_dir, "part").select("p_size").distinct()
    held = S.ratio_to_shards(F.col("p_size"), 0.02)
    return sizes.select("p_size", F.when(F.col("p_size") <= 2, F.col("p_size")).otherwise(F.greatest(F.lit(1), F.col("p_size") - held * 2)).alias("train"))


@add("win10_split_by_group", "WITH g AS (SELECT source_id, row_number() OVER (ORDER BY md5('3:' || source_id), source_id) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT source_id FROM documents WHERE source_id IS NOT NULL) t) SELECT doc_id, CASE WHEN k <= floor(n * 0.8) THEN 'train' WHEN k <= floor(n * 0.8) + floor(n * 0.1) THEN 'val' ELSE 'test' END AS split FROM documents JOIN g USING (source_id)")
def win10(spark, sf_dir):
    return S.group_splits(load(spark, sf_dir, "documents").select("doc_id", "source_id"), "source_id", 0.8, 0.1, seed=3).select("doc_id", "split")


@add("win11_sampled_shards", "SELECT file_name FROM (SELECT file_name, row_number() OVER (ORDER BY sha256('5:' || file_name)) AS k, count(*) OVER () AS n FROM (SELECT DISTINCT file_name FROM documents) t) u WHERE k <= greatest(1, CAST(ceil(n * 0.5) AS BIGINT))")
def win11(spark, sf_dir):
    return S.sampled(load(spark, sf_dir, "documents").select("file_name").distinct(), "file_name", 0.5, seed=5)


@add("win12_weighted_samples")
def win12(spark, sf_dir):
    """Ten draws with replacement for each of five queries, by the cumulative weight of the entries."""
    pool = load(spark, sf_dir, "data_blend_raw_phase1").where("weight > 0").groupBy("name").agg(F.max("weight").alias("weight"))
    return S.weighted_draws(spark.range(5).withColumnRenamed("id", "query_id"), "query_id", pool, "name", "weight", 10, seed=11)


@add("win13_category_sampler")
def win13(spark, sf_dir):
    kinds = F.array(*map(F.lit, ("short", "long", "table")))
    return sft(spark, sf_dir).select("row_id", F.element_at(kinds, 1 + F.pmod(F.xxhash64(F.lit(9), "row_id"), F.lit(3)).cast("int")).alias("kind"))


@add("win14_seeded_order", f"SELECT row_id, row_number() OVER (PARTITION BY topic ORDER BY md5('13:' || row_id), row_id) AS at FROM {SFT} t")
def win14(spark, sf_dir):
    """Each topic in the order of a hash of (seed, id)."""
    w = Window.partitionBy("topic").orderBy(F.md5(F.concat(F.lit("13:"), "row_id")), "row_id")
    return sft(spark, sf_dir).select("row_id", F.row_number().over(w).cast("bigint").alias("at"))


@add("win15_repeat_rows", "SELECT n_nationkey, CAST(k AS INT) AS copy FROM nation, (SELECT unnest(generate_series(1, 3)) AS k) t")
def win15(spark, sf_dir):
    return load(spark, sf_dir, "nation").select("n_nationkey", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("copy"))


@add("win16_unrolled_positives", "SELECT CASE WHEN n > 1 THEN 'q' || l_orderkey || '_' || (k - 1) ELSE 'q' || l_orderkey END AS id, l_partkey FROM (SELECT l_orderkey, l_partkey, count(*) OVER (PARTITION BY l_orderkey) AS n, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey) AS k FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) a) t")
def win16(spark, sf_dir):
    q = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_set("l_partkey")).alias("pos"))
    rows = q.select("l_orderkey", F.size("pos").alias("n"), F.posexplode_outer("pos").alias("k", "l_partkey"))
    plain = F.concat(F.lit("q"), "l_orderkey")
    return rows.select(F.when(F.col("n") > 1, F.concat(plain, F.lit("_"), "k")).otherwise(plain).alias("id"), "l_partkey")


@add("win17_ids_after_filter", "SELECT 'q' || (row_number() OVER (ORDER BY question_id) - 1) AS qid, question_id FROM benchmark_mcq WHERE length(question) <= 280")
def win17(spark, sf_dir):
    kept = load(spark, sf_dir, "benchmark_mcq").where(F.char_length("question") <= 280)
    return kept.select(F.concat(F.lit("q"), F.row_number().over(Window.orderBy("question_id")) - 1).alias("qid"), "question_id")


@add("ord01_files_by_size", "SELECT path, CAST(sum(n_tokens) AS BIGINT) AS size FROM source_records GROUP BY path ORDER BY size DESC, path")
def ord01(spark, sf_dir):
    return load(spark, sf_dir, "source_records").groupBy("path").agg(F.sum("n_tokens").alias("size")).orderBy(F.desc("size"), "path")


@add("ord02_by_length", "SELECT row_id, length(assistant_response) AS n FROM " + SFT + " t WHERE assistant_response IS NOT NULL ORDER BY n, row_id")
def ord02(spark, sf_dir):
    return sft(spark, sf_dir).where("assistant_response IS NOT NULL").select("row_id", F.char_length("assistant_response").cast("bigint").alias("n")).orderBy("n", "row_id")


@add("ord03_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def ord03(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@add("ord04_first_rows", "SELECT event_id FROM events ORDER BY event_id LIMIT 100")
def ord04(spark, sf_dir):
    return load(spark, sf_dir, "events").select("event_id").orderBy("event_id").limit(100)


@add("ord05_by_metric", "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS metric FROM customer GROUP BY 1 ORDER BY metric DESC")
def ord05(spark, sf_dir):
    return load(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.round(F.avg("c_acctbal"), 4).alias("metric")).orderBy(F.desc("metric"))


@add("ord06_union_of_unlike_tables", "SELECT c_custkey AS id, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_acctbal, NULL FROM supplier")
def ord06(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    s = load(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"))
    return c.unionByName(s, allowMissingColumns=True)


@add("ord07_pending", "SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'")
def ord07(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey").exceptAll(load(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()).distinct()


@add("ord08_pending_and_sampled", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT l_orderkey FROM lineitem WHERE l_quantity > 45")
def ord08(spark, sf_dir):
    return load(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey").intersect(load(spark, sf_dir, "lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")))


@add("ord09_subset_of_tags", "SELECT question_id FROM benchmark_mcq WHERE len(list_filter(string_split(question, ' ')[1:1], lambda w: NOT list_contains(['The', 'In', 'A', 'Before', 'Two'], w))) = 0")
def ord09(spark, sf_dir):
    tags = F.slice(F.split("question", " "), 1, 1)
    return load(spark, sf_dir, "benchmark_mcq").where(F.size(F.array_except(tags, F.array(*map(F.lit, ("The", "In", "A", "Before", "Two"))))) == 0).select("question_id")


@add("ord10_blend_entries", "SELECT name, max(weight) AS weight, max(weight) / sum(max(weight)) OVER () > 0.03 AS heavy FROM data_blend_raw_phase1 WHERE weight > 0 GROUP BY name")
def ord10(spark, sf_dir):
    live = load(spark, sf_dir, "data_blend_raw_phase1").where("weight > 0").groupBy("name").agg(F.max("weight").alias("weight"))
    return live.withColumn("heavy", F.col("weight") / F.sum("weight").over(Window.partitionBy(F.lit(1))) > 0.03)
