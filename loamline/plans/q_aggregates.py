"""Queries over aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.functions import vectors as V
from loamline.operators import aggregates as A
from loamline.operators.dedup import exact_duplicate_ids
from loamline.plans.q_joins import top_k
from loamline.plans.q_shaping import PREF, SFT, pref, sft
from loamline.registry import Registry
from loamline.session import cut, spread
from loamline.tables import load

registry = Registry()
add = registry.add

PERCENTS = list(range(5, 100, 5))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of 50 to 5,000 words, the first of each text, with a score and their bytes."""
    docs = spread(load(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text").where(T.long_enough(F.col("text"), 100)))
    docs = docs.withColumn("n_words", T.word_count(F.col("text"))).where("n_words BETWEEN 50 AND 5000")
    first = docs.join(exact_duplicate_ids(docs, "doc_id", "text"), "doc_id", "left_anti")
    return first.select("doc_id", "lang", "source", (F.char_length("text") * 100 / F.col("n_words")).cast("bigint").cast("double").alias("score"), F.octet_length("text").cast("bigint").alias("bytes"))


_SCORED = r"""s0 AS (SELECT doc_id, lang, source, text, len(regexp_extract_all(text, '\S+')) AS n FROM documents WHERE length(text) >= 100),
s1 AS (SELECT *, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS k FROM s0 WHERE n BETWEEN 50 AND 5000),
scored AS (SELECT doc_id, lang, source, CAST(floor(length(text) * 100 / n) AS DOUBLE) AS score, CAST(strlen(text) AS BIGINT) AS bytes FROM s1 WHERE k = 1)"""
_CUM = "cum AS (SELECT score, sum(sum(bytes)) OVER (ORDER BY score) AS upto, sum(sum(bytes)) OVER () AS total FROM scored GROUP BY score)"
_THR = "thr AS (SELECT p, min(score) AS threshold FROM cum, (SELECT unnest(generate_series(5, 95, 5)) AS p) ps WHERE upto * 100 >= p * total GROUP BY p)"


@add("agg01_weighted_percentile", f"WITH {_SCORED}, {_CUM} SELECT min(score) AS median FROM cum WHERE upto * 100 >= 50 * total")
def agg01(spark, sf_dir):
    return A.weighted_percentiles(scored(spark, sf_dir), "score", "bytes", [50]).select(F.col("threshold").alias("median"))


@add("agg02_thresholds", f"WITH {_SCORED}, {_CUM}, {_THR} SELECT CAST(p AS INT) AS p, threshold FROM thr")
def agg02(spark, sf_dir):
    return A.weighted_percentiles(scored(spark, sf_dir), "score", "bytes", PERCENTS)


@add("agg02_quality_buckets", f"WITH {_SCORED}, {_CUM}, {_THR} SELECT bucket, lang, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT *, CAST((SELECT count(*) FROM thr WHERE threshold <= score) AS INT) AS bucket FROM scored) t GROUP BY bucket, lang")
def agg02_buckets(spark, sf_dir):
    """The flagship: filters, exact deduplication, byte-weighted percentiles, buckets and counts."""
    return A.bucketed(cut(scored(spark, sf_dir)), "score", "bytes", PERCENTS).groupBy("bucket", "lang").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))


#: A hundredth of the digests, as their first eight digits.
_HUNDREDTH = f"{round(0.01 * 16**8):08x}"


@add("agg03_threshold_sample", f"WITH {_SCORED.replace('scored AS', 'every AS')}, scored AS (SELECT * FROM every WHERE left(sha256('42:' || doc_id), 8) < '{_HUNDREDTH}'), {_CUM}, {_THR} SELECT CAST(p AS INT) AS p, threshold FROM thr")
def agg03(spark, sf_dir):
    """Thresholds from a seeded sample of a hundredth; a table of few documents may give none."""
    digest = F.substring(F.sha2(F.concat(F.lit("42:"), F.col("doc_id").cast("string")), 256), 1, 8)
    return A.weighted_percentiles(scored(spark, sf_dir).where(digest < _HUNDREDTH), "score", "bytes", PERCENTS)


@add("agg04_digitize", "SELECT l_orderkey, l_linenumber, CAST(len(list_filter([5.0, 10.0, 20.0, 30.0, 45.0], lambda t: t <= l_quantity)) AS INT) AS bucket FROM lineitem")
def agg04(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", A.bucket_of(F.col("l_quantity"), F.array(*map(F.lit, (5.0, 10.0, 20.0, 30.0, 45.0)))).alias("bucket"))


@add("agg05_ensemble_max", "SELECT p_partkey, greatest(CAST(p_size % 20 AS INT), CAST(p_partkey % 20 AS INT), CAST(length(p_name) % 20 AS INT)) AS best FROM part")
def agg05(spark, sf_dir):
    ints = [(F.col("p_size") % 20).cast("int"), (F.col("p_partkey") % 20).cast("int"), (F.char_length("p_name") % 20).cast("int")]
    return load(spark, sf_dir, "part").select("p_partkey", F.greatest(*ints).alias("best"))


@add("agg06_ordered_lists", "SELECT l_orderkey, list(l_partkey ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey")
def agg06(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("v"))
    return rows.select("l_orderkey", F.transform("v", lambda x: x["l_partkey"]).alias("parts"))


@add("agg07_few_shot_groups", "SELECT CAST(floor((row_number() OVER (ORDER BY question_id) - 1) / 5) AS BIGINT) AS line, question_id FROM benchmark_mcq")
def agg07(spark, sf_dir):
    q = load(spark, sf_dir, "benchmark_mcq").withColumn("line", F.floor((F.row_number().over(Window.orderBy("question_id")) - 1) / 5))
    grouped = q.groupBy("line").agg(F.collect_list("question_id").alias("ids"))
    return grouped.select("line", F.explode("ids").alias("question_id"))


@add("agg08_shard_statistics", "SELECT file_name, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, min(n_chars) AS least, max(n_chars) AS most, count(*) FILTER (WHERE n_chars < 300) AS short, count(*) FILTER (WHERE text IS NULL) AS missing FROM documents GROUP BY file_name")
def agg08(spark, sf_dir):
    return load(spark, sf_dir, "documents").groupBy("file_name").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.min("n_chars").alias("least"), F.max("n_chars").alias("most"), F.count_if(F.col("n_chars") < 300).alias("short"), F.count_if(F.col("text").isNull()).alias("missing"))


_BINS = "(SELECT doc_id, source, n, CAST(floor((sum(n) OVER (PARTITION BY source ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - n) / 4000) AS BIGINT) AS bin FROM (SELECT doc_id, source, least(coalesce(n_chars, 0), 4000) AS n FROM documents) a)"


@add("agg09_packing_statistics", f"SELECT source, count(*) AS sequences, count(DISTINCT bin) AS bins, round(count(*) / count(DISTINCT bin), 2) AS packing_factor, round(sum(n) * 100 / (count(DISTINCT bin) * 4000), 1) AS efficiency FROM {_BINS} b GROUP BY source")
def agg09(spark, sf_dir):
    n = F.least(F.coalesce("n_chars", F.lit(0)), F.lit(4000))
    ran = Window.partitionBy("source").orderBy("doc_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = load(spark, sf_dir, "documents").select("doc_id", "source", n.alias("n")).withColumn("bin", F.floor((F.sum("n").over(ran) - F.col("n")) / 4000))
    return A.packing_metrics(rows, ["source"], "bin", "n", 4000)


@add("agg10_splits", "SELECT event_type AS split, count(*) AS n, min(event_id) AS first FROM events GROUP BY event_type")
def agg10(spark, sf_dir):
    return load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("split")).agg(F.count("*").alias("n"), F.min_by("event_id", "event_id").alias("first"))


@add("agg11_ratios", "SELECT l_returnflag, round(count(*) / nullif(count(DISTINCT l_orderkey), 0), 2) AS factor FROM lineitem GROUP BY l_returnflag")
def agg11(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.round(F.count("*") / F.nullif(F.count_distinct("l_orderkey"), F.lit(0)), 2).alias("factor"))


@add("agg12_conditional_counts", f"SELECT count(*) AS n, count(*) FILTER (WHERE prompt IS NULL OR trim(prompt) = '') AS no_prompt, count(*) FILTER (WHERE response_a IS NULL) AS no_a, count(*) FILTER (WHERE response_b IS NULL) AS no_b, count(*) FILTER (WHERE response_a = response_b) AS same, count(*) FILTER (WHERE judge IS NULL) AS no_judge FROM {PREF} t")
def agg12(spark, sf_dir):
    return pref(spark, sf_dir).agg(
        F.count("*").alias("n"), F.count_if(F.col("prompt").isNull() | (F.trim("prompt") == "")).alias("no_prompt"), F.count_if(F.col("response_a").isNull()).alias("no_a"), F.count_if(F.col("response_b").isNull()).alias("no_b"),
        F.count_if(F.col("response_a") == F.col("response_b")).alias("same"), F.count_if(F.col("judge").isNull()).alias("no_judge"),
    )


@add("agg13_correct_ratio", "SELECT question_id, round(list_avg(v), 4) AS ratio, list_avg(v) > 0.8 AS easy, list_avg(v) < 0.5 AS hallucinated FROM (SELECT question_id, list_transform(options, lambda o: CASE WHEN length(o) % 2 = 0 THEN 1.0 ELSE 0.0 END) AS v FROM benchmark_mcq) t")
def agg13(spark, sf_dir):
    right = F.transform("options", lambda o: F.when(F.char_length(o) % 2 == 0, 1.0).otherwise(0.0))
    rows = load(spark, sf_dir, "benchmark_mcq").select("question_id", V.mean(right).alias("r"))
    return rows.select("question_id", F.round("r", 4).alias("ratio"), (F.col("r") > 0.8).alias("easy"), (F.col("r") < 0.5).alias("hallucinated"))


@add("agg14_coverage", "SELECT l_orderkey, round(count(DISTINCT l_suppkey) / count(*), 6) AS coverage, round(least(count(*), count(DISTINCT l_partkey)) / count(*), 6) AS most FROM lineitem GROUP BY l_orderkey")
def agg14(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.round(F.count_distinct("l_suppkey") / F.count("*"), 6).alias("coverage"), F.round(F.least(F.count("*"), F.count_distinct("l_partkey")) / F.count("*"), 6).alias("most"))


@add("agg15_choice_outliers")
def agg15(spark, sf_dir):
    """Two means over the lengths and letters of the choices; the answer is an outlier if it is alone in its cluster."""
    from loamline.operators.questions import choice_neighbours

    return choice_neighbours(load(spark, sf_dir, "benchmark_mcq"), "question_id", "options", "answer_index")


@add("agg16_composite_score", "SELECT p_partkey, round((p_size % 5 * 0.35 + p_partkey % 5 * 0.30 + length(p_name) % 5 * 0.15 + length(p_type) % 5 * 0.10 + length(p_brand) % 5 * 0.10) / 5, 2) AS score FROM part")
def agg16(spark, sf_dir):
    parts = [F.col("p_size") % 5, F.col("p_partkey") % 5, F.char_length("p_name") % 5, F.char_length("p_type") % 5, F.char_length("p_brand") % 5]
    total = sum((p * F.lit(w).cast("decimal(3,2)") for p, w in zip(parts, (0.35, 0.30, 0.15, 0.10, 0.10))), F.lit(0))
    return load(spark, sf_dir, "part").select("p_partkey", F.round(total / 5, 2).cast("double").alias("score"))


@add("agg17_aligned_scores", "SELECT question_id, o AS choice FROM (SELECT question_id, unnest(options) AS o FROM benchmark_mcq WHERE len(options) = 4) t WHERE length(o) >= 28")
def agg17(spark, sf_dir):
    q = load(spark, sf_dir, "benchmark_mcq").withColumn("scores", F.transform("options", lambda o: F.char_length(o) / 4)).where("size(options) = size(scores) AND size(options) = 4")
    return q.select("question_id", F.inline(F.arrays_zip(F.col("options").alias("choice"), F.col("scores").alias("score")))).where("score >= 7.0").select("question_id", "choice")


_RANKED = "r AS (SELECT a.vec_id, b.vec_id AS other, a.label = b.label AS rel, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) DESC, b.vec_id) AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)"


@add("agg18_ranking_metrics", f"""WITH {_RANKED}, n AS (SELECT vec_id, count(*) AS n FROM r WHERE rel GROUP BY vec_id), h AS (SELECT vec_id, rank, row_number() OVER (PARTITION BY vec_id ORDER BY rank) AS nth FROM r WHERE rel AND rank <= 100),
m AS (SELECT k, n.vec_id, n.n, count(h.rank) AS found, coalesce(sum(1 / log2(h.rank + 1)), 0) AS gain, coalesce(sum(h.nth / h.rank), 0) AS ap FROM n CROSS JOIN (SELECT unnest([1, 5, 10, 100]) AS k) ks LEFT JOIN h ON h.vec_id = n.vec_id AND h.rank <= k GROUP BY ALL)
SELECT CAST(k AS INT) AS k, round(avg(gain / list_sum(list_transform(generate_series(1, least(n, k)), lambda i: 1 / log2(i + 1)))), 6) AS ndcg, round(avg(found / n), 6) AS recall, round(avg(found / k), 6) AS precision, round(avg(ap / least(n, k)), 6) AS map FROM m GROUP BY k""")
def agg18(spark, sf_dir):
    e = load(spark, sf_dir, "embeddings").select("vec_id", "label")
    relevant = e.where("vec_id % 100 = 0").join(e.withColumnRenamed("vec_id", "other"), "label").where("vec_id <> other").select("vec_id", "other")
    return A.ranking_metrics(top_k(spark, sf_dir, 100), relevant, "vec_id", "other", [1, 5, 10, 100])


@add("agg19_metric_delta", "SELECT event_type, round(avg(value) FILTER (WHERE event_id % 2 = 0), 6) AS base, round(avg(value) FILTER (WHERE event_id % 2 = 1), 6) AS tuned, abs(avg(value) FILTER (WHERE event_id % 2 = 1) / avg(value) FILTER (WHERE event_id % 2 = 0) - 1) <= 0.03 AS within FROM events GROUP BY event_type")
def agg19(spark, sf_dir):
    m = load(spark, sf_dir, "events").groupBy("event_type", F.pmod("event_id", F.lit(2)).alias("run")).agg(F.avg("value").alias("v"))
    base, tuned = m.where("run = 0").select("event_type", F.col("v").alias("b")), m.where("run = 1").select("event_type", F.col("v").alias("t"))
    return base.join(tuned, "event_type").select("event_type", F.round("b", 6).alias("base"), F.round("t", 6).alias("tuned"), (F.abs(F.col("t") / F.col("b") - 1) <= 0.03).alias("within"))


@add("agg20_value_counts", f"SELECT topic, count(*) AS n FROM {SFT} t GROUP BY topic")
def agg20(spark, sf_dir):
    return sft(spark, sf_dir).groupBy("topic").agg(F.count("*").alias("n"))


@add("agg21_best_experiment", "SELECT c_mktsegment, arg_max(c_custkey, (c_acctbal, -c_custkey)) AS best, arg_min(c_custkey, (c_acctbal, c_custkey)) AS worst FROM customer GROUP BY c_mktsegment")
def agg21(spark, sf_dir):
    """The best and the worst by a metric; of equal ones the first."""
    return load(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.max_by("c_custkey", F.struct("c_acctbal", -F.col("c_custkey"))).alias("best"), F.min_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("worst"))


@add("agg22_regression_metrics", "SELECT round(sqrt(avg((l_extendedprice - p) * (l_extendedprice - p))), 4) AS rmse, round(avg(abs(l_extendedprice - p)), 4) AS mae, round(1 - sum((l_extendedprice - p) * (l_extendedprice - p)) / sum((l_extendedprice - m) * (l_extendedprice - m)), 6) AS r2 FROM (SELECT l_extendedprice, l_quantity * 1500.0 AS p, avg(l_extendedprice) OVER () AS m FROM lineitem) t")
def agg22(spark, sf_dir):
    y, p = F.col("l_extendedprice"), F.col("l_quantity") * 1500.0
    return load(spark, sf_dir, "lineitem").agg(F.sqrt(F.avg((y - p) * (y - p))).alias("r"), F.avg(F.abs(y - p)).alias("a"), (1 - F.sum((y - p) * (y - p)) / (F.var_pop(y) * F.count("*"))).alias("d")).select(F.round("r", 4).alias("rmse"), F.round("a", 4).alias("mae"), F.round("d", 6).alias("r2"))


@add("agg22_classification_metrics", "WITH t AS (SELECT l_returnflag AS y, CASE WHEN l_quantity > 30 THEN 'A' WHEN l_quantity > 15 THEN 'N' ELSE 'R' END AS p FROM lineitem), c AS (SELECT k, count(*) FILTER (WHERE y = k) AS s, count(*) FILTER (WHERE p = k) AS q, count(*) FILTER (WHERE y = k AND p = k) AS h FROM t, (SELECT unnest(['A', 'N', 'R']) AS k) ks GROUP BY k) SELECT round(sum(h) / sum(s), 6) AS accuracy, round(sum(s * (CASE WHEN h = 0 THEN 0 ELSE 2.0 * h / (s + q) END)) / sum(s), 6) AS f1 FROM c")
def agg22_classes(spark, sf_dir):
    t = load(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("y"), F.when(F.col("l_quantity") > 30, "A").when(F.col("l_quantity") > 15, "N").otherwise("R").alias("p"))
    pairs = t.groupBy("y", "p").agg(F.count("*").alias("n"))
    by = lambda c, name: pairs.groupBy(F.col(c).alias("k")).agg(F.sum("n").alias(name))
    each = by("y", "s").join(by("p", "q"), "k", "left").join(pairs.where("y = p").select(F.col("y").alias("k"), F.col("n").alias("h")), "k", "left").fillna(0)
    return each.agg(F.round(F.sum("h") / F.sum("s"), 6).alias("accuracy"), F.round(F.sum(F.col("s") * F.when(F.col("h") > 0, 2.0 * F.col("h") / (F.col("s") + F.col("q"))).otherwise(0.0)) / F.sum("s"), 6).alias("f1"))


@add("agg23_corpus_size", "SELECT count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, round(avg(length(text)), 4) AS mean, min(length(text)) AS least, max(length(text)) AS most, round(count(*) FILTER (WHERE text IS NULL) / count(*), 6) AS skipped FROM documents")
def agg23(spark, sf_dir):
    n = F.char_length("text")
    return load(spark, sf_dir, "documents").agg(F.count("*").alias("n"), F.sum(n).alias("chars"), F.round(F.avg(n), 4).alias("mean"), F.min(n).cast("bigint").alias("least"), F.max(n).cast("bigint").alias("most"), F.round(F.count_if(F.col("text").isNull()) / F.count("*"), 6).alias("skipped"))


@add("agg24_fingerprint", "SELECT sha256(string_agg(line, chr(10) ORDER BY line)) AS fingerprint FROM (SELECT file_name || ':' || count(*) || ':' || CAST(sum(n_chars) AS BIGINT) AS line FROM documents GROUP BY file_name) t")
def agg24(spark, sf_dir):
    files = load(spark, sf_dir, "documents").groupBy("file_name").agg(F.concat_ws(":", "file_name", F.count("*"), F.sum("n_chars")).alias("line"))
    return files.agg(F.sha2(F.array_join(F.sort_array(F.collect_list("line")), "\n"), 256).alias("fingerprint"))


@add("agg26_cube", "SELECT lang, source, count(*) AS n, CAST(grouping(lang) * 2 + grouping(source) AS BIGINT) AS level FROM documents GROUP BY CUBE (lang, source)")
def agg26(spark, sf_dir):
    return load(spark, sf_dir, "documents").cube("lang", "source").agg(F.count("*").alias("n"), F.grouping_id().alias("level"))


@add("agg26_rollup", "SELECT l_returnflag, l_linestatus, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def agg26_rollup(spark, sf_dir):
    return load(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").cast("bigint").alias("quantity"))


@add("agg26_grouping_sets", "SELECT event_type, user_id, count(*) AS n FROM events GROUP BY GROUPING SETS ((event_type), (user_id), ())")
def agg26_sets(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return e.groupingSets([[F.col("event_type")], [F.col("user_id")], []], F.col("event_type"), F.col("user_id")).agg(F.count("*").alias("n")).select("event_type", "user_id", "n")


@add("agg26_distinct_sketch")
def agg26_sketch(spark, sf_dir):
    """Approximate against exact numbers of different users."""
    return load(spark, sf_dir, "events").groupBy("event_type").agg(F.approx_count_distinct("user_id", 0.02).alias("about"), F.count_distinct("user_id").alias("exact"))


@add("agg27_input_bytes", "SELECT source, CAST(least(sum(strlen(coalesce(text, ''))), CAST(floor(avg(strlen(coalesce(text, '')))) AS BIGINT) * 50) AS BIGINT) AS bytes FROM documents GROUP BY source")
def agg27(spark, sf_dir):
    n = F.octet_length(F.coalesce("text", F.lit("")))
    return load(spark, sf_dir, "documents").groupBy("source").agg(F.least(F.sum(n), F.floor(F.avg(n)) * 50).alias("bytes"))
