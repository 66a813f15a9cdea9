"""Queries over joins and retrieval."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.functions import vectors as V
from loamline.operators import joins as J
from loamline.plans.q_shaping import SFT, sft
from loamline.registry import Registry
from loamline.tables import load

registry = Registry()
add = registry.add

_DUPS = "(SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL) t WHERE k > 1)"


def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from loamline.operators.dedup import exact_duplicate_ids

    return exact_duplicate_ids(load(spark, sf_dir, "documents"), "doc_id", "text")


@add("join01_drop_exact_duplicates", f"SELECT doc_id, source_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM {_DUPS} d)")
def join01(spark, sf_dir):
    return J.drop_listed(load(spark, sf_dir, "documents"), exact_duplicates(spark, sf_dir), "doc_id").select("doc_id", "source_id")


@add("join03_mark_duplicates", f"SELECT doc_id, doc_id IN (SELECT doc_id FROM {_DUPS} d) AS duplicate FROM documents")
def join03(spark, sf_dir):
    return J.mark_listed(load(spark, sf_dir, "documents").select("doc_id"), exact_duplicates(spark, sf_dir), "doc_id", "duplicate")


@add("join04_drop_outliers", "SELECT question_id FROM benchmark_mcq WHERE question_id NOT IN (SELECT question_id FROM benchmark_mcq WHERE length(question) > 280)")
def join04(spark, sf_dir):
    q = load(spark, sf_dir, "benchmark_mcq").select("question_id", "question")
    return J.drop_listed(q, q.where(F.char_length("question") > 280), "question_id").select("question_id")


@add("join05_judged_questions", "SELECT b.question_id, v.votes FROM benchmark_mcq b JOIN (SELECT category, count(*) AS votes FROM benchmark_mcq GROUP BY category) v ON b.category = v.category WHERE v.votes > 10")
def join05(spark, sf_dir):
    q = load(spark, sf_dir, "benchmark_mcq")
    return q.select("question_id", "category").join(q.groupBy("category").agg(F.count("*").alias("votes")), "category").where("votes > 10").select("question_id", "votes")


@add("join06_left_then_dropna", "SELECT b.question_id, c.n FROM benchmark_mcq b LEFT JOIN (SELECT category, count(cot_content) AS n FROM benchmark_mcq GROUP BY category HAVING count(cot_content) > 5) c ON b.category = c.category WHERE c.n IS NOT NULL")
def join06(spark, sf_dir):
    q = load(spark, sf_dir, "benchmark_mcq")
    few = q.groupBy("category").agg(F.count("cot_content").alias("n")).where("n > 5")
    return q.select("question_id", "category").join(few, "category", "left").dropna(subset=["n"]).select("question_id", "n")


@add("join07_inner_on_keys", "SELECT o_orderkey, c_mktsegment, n_name FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey WHERE o_totalprice > 300000")
def join07(spark, sf_dir):
    o = load(spark, sf_dir, "orders").where("o_totalprice > 300000")
    c = load(spark, sf_dir, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).join(load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("o_orderkey", "c_mktsegment", "n_name")


@add("join08_metadata_complete", "SELECT lang, l.english_name, (l.code IS NOT NULL) AS known, count(*) AS n FROM documents d LEFT JOIN lang_codes l ON d.lang = l.code GROUP BY ALL")
def join08(spark, sf_dir):
    codes = load(spark, sf_dir, "lang_codes")
    joined = load(spark, sf_dir, "documents").select("lang").join(codes, F.col("lang") == F.col("code"), "left")
    return joined.groupBy("lang", "english_name", F.col("code").isNotNull().alias("known")).agg(F.count("*").alias("n"))


@add("join09_placeholder_rows", f"SELECT row_id, question_id FROM {SFT} s JOIN (SELECT row_number() OVER (ORDER BY question_id) - 1 AS row_idx, question_id FROM benchmark_mcq) b ON s.row_id % 400 = b.row_idx")
def join09(spark, sf_dir):
    rows = sft(spark, sf_dir).select("row_id", (F.col("row_id") % 400).alias("row_idx"))
    return J.at_positions(rows, load(spark, sf_dir, "benchmark_mcq").select("question_id"), "row_idx", "question_id").select("row_id", "question_id")


@add("join10_all_segments_found", "SELECT o_orderkey, list(p_name ORDER BY l_partkey, p_name) AS names FROM (SELECT l_orderkey AS o_orderkey, l_partkey FROM lineitem GROUP BY ALL) l LEFT JOIN (SELECT * FROM part WHERE p_size > 5) p ON l_partkey = p_partkey GROUP BY o_orderkey HAVING count(*) = count(p_name)")
def join10(spark, sf_dir):
    parts = load(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("p_partkey")).distinct()
    return J.all_or_nothing(parts, load(spark, sf_dir, "part").where("p_size > 5"), "o_orderkey", ["p_partkey"], "p_name").withColumnRenamed("values", "names")


@add("join11_text_to_corpus_id", "SELECT DISTINCT rec_id, 'd_' || left(sha256(text), 16) AS corpus_id FROM tiny WHERE text IS NOT NULL")
def join11(spark, sf_dir):
    from loamline.operators.dedup import corpus_of

    rows = load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", "text").distinct()
    corpus = corpus_of(rows, "text")
    keyed = rows.select("rec_id", F.sha2("text", 256).alias("key"))
    return keyed.join(corpus.select(F.sha2("text", 256).alias("key"), "corpus_id"), "key").select("rec_id", "corpus_id")


@add("join12_known_only", "SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)")
def join12(spark, sf_dir):
    n = load(spark, sf_dir, "nation").where("n_regionkey = 2").select(F.col("n_nationkey").alias("s_nationkey"))
    return load(spark, sf_dir, "supplier").join(n, "s_nationkey", "left_semi").select("s_suppkey")


_COS = "round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 4)"


@add("join13_nearest_in_group", "SELECT vec_id, CAST(arg_max(other, s) AS BIGINT) AS other FROM (SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 9) AS s FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0) t GROUP BY vec_id")
def join13(spark, sf_dir):
    """The nearest vector of the same label, for the queries whose id is divisible by 100."""
    e = load(spark, sf_dir, "embeddings")
    a = e.where("vec_id % 100 = 0").select("vec_id", "label", F.col("embedding").alias("x"))
    b = e.select(F.col("vec_id").alias("other"), "label", F.col("embedding").alias("y"))
    scored = a.join(b, "label").where("vec_id <> other").select("vec_id", "other", F.round(V.cosine(F.col("x"), F.col("y")), 9).alias("s"))
    return scored.groupBy("vec_id").agg(F.max_by("other", "s").alias("other"))


@add("join14_dense_top_k", "SELECT vec_id, other, CAST(rank AS INT) AS rank FROM (SELECT a.vec_id, b.vec_id AS other, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) DESC, b.vec_id) AS rank FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id) t WHERE rank <= 10")
def join14(spark, sf_dir):
    return top_k(spark, sf_dir, 10).drop("score")


def top_k(spark: SparkSession, sf_dir: str, k: int) -> DataFrame:
    e = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return J.nearest(e.where("vec_id % 100 = 0"), e.withColumnRenamed("vec_id", "other"), "vec_id", "other", "embedding", k)


@add("join15_index_search")
def join15(spark, sf_dir):
    """Approximate top 10 through an index of random hyperplanes."""
    from loamline.operators.ann import HyperplaneIndex

    e = load(spark, sf_dir, "embeddings")
    return HyperplaneIndex(e, "vec_id", "embedding").search(e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), "query_id", 10)


@add("join17_hard_negatives", """WITH s AS (SELECT a.vec_id, b.vec_id AS other, a.label = b.label AS pos, round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
c AS (SELECT vec_id, min(score) * 0.95 AS ceiling FROM s WHERE pos GROUP BY vec_id)
SELECT vec_id, other, CAST(rank AS INT) AS rank FROM (SELECT s.vec_id, other, row_number() OVER (PARTITION BY s.vec_id ORDER BY score DESC, other) AS rank FROM s JOIN c ON s.vec_id = c.vec_id WHERE NOT pos AND score <= ceiling) t WHERE rank <= 5""")
def join17(spark, sf_dir):
    """The best of those that aren't positive and score at most 0.95 of the worst positive one."""
    e = load(spark, sf_dir, "embeddings")
    return J.hard_negatives(e.where("vec_id % 100 = 0"), e.withColumnRenamed("vec_id", "other"), "vec_id", "other", "embedding", "label", 5).drop("score")


@add("join18_reassemble", "SELECT question_id, list(o ORDER BY k) AS options FROM (SELECT question_id, unnest(options) AS o, unnest(generate_series(1, len(options))) AS k FROM benchmark_mcq) t GROUP BY question_id")
def join18(spark, sf_dir):
    """Questions and choices as rows of one table, as for a translator, and back."""
    q = load(spark, sf_dir, "benchmark_mcq")
    rows = q.select(F.concat(F.lit("q#"), "question_id").alias("id"), F.col("question").alias("said")).unionByName(
        q.select("question_id", F.posexplode("options").alias("k", "said")).select(F.concat(F.lit("c#"), "question_id", F.lit("#"), "k").alias("id"), "said")
    )
    part = F.split("id", "#")
    choices = rows.where(F.startswith("id", F.lit("c#"))).select(part[1].alias("question_id"), part[2].cast("int").alias("k"), "said").groupBy("question_id").agg(F.sort_array(F.collect_list(F.struct("k", "said"))).alias("c"))
    questions = rows.where(F.startswith("id", F.lit("q#"))).select(part[1].alias("question_id"), "said")
    return questions.join(choices, "question_id").select("question_id", F.transform("c", lambda x: x["said"]).alias("options"))


@add("join19_by_position", "SELECT question_id, k - 1 AS k, upper(options[k]) AS said FROM (SELECT question_id, options, unnest(generate_series(1, len(options))) AS k FROM benchmark_mcq) t")
def join19(spark, sf_dir):
    q = load(spark, sf_dir, "benchmark_mcq").select("question_id", F.posexplode("options").alias("k", "said"))
    done = q.select("question_id", "k", F.upper("said").alias("upper"))
    return q.join(done, ["question_id", "k"]).select("question_id", F.col("k").cast("bigint").alias("k"), F.col("upper").alias("said"))


@add("join20_documents_by_file_and_place", "SELECT d.doc_id, d.url FROM documents d WHERE d.source <> 'scan'")
def join20(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").withColumn("at", F.row_number().over(Window.partitionBy("file_name").orderBy("doc_id")))
    kept = docs.where("source <> 'scan'").select("file_name", "at")
    return docs.join(kept, ["file_name", "at"]).select("doc_id", "url")


_RANGES = """(SELECT user_id, event_id, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS s, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) + CAST(floor(value * 10) AS BIGINT) + 1 AS e FROM events WHERE value IS NOT NULL AND value >= 0)"""


def spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    start = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    rows = load(spark, sf_dir, "events").where("value >= 0").select("user_id", "event_id", start.alias("start"), (F.floor(F.col("value") * 10) + 1).alias("n"))
    return rows.select("user_id", "event_id", "start", (F.col("start") + F.col("n")).alias("end"))


@add("join21_overlapping_ranges", f"SELECT a.event_id AS a, b.event_id AS b FROM {_RANGES} a JOIN {_RANGES} b ON a.user_id = b.user_id AND a.s < b.e AND a.e > b.s WHERE a.event_id < b.event_id")
def join21(spark, sf_dir):
    a = spans(spark, sf_dir)
    b = a.withColumnsRenamed({"event_id": "other", "start": "s2", "end": "e2"})
    return J.range_join(a, b, "user_id", 4_000, ("start", "end"), ("s2", "e2")).where("event_id < other").select(F.col("event_id").alias("a"), F.col("other").alias("b"))


@add("join22_missing_partners", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def join22(spark, sf_dir):
    o = load(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return J.drop_listed(load(spark, sf_dir, "customer"), o, "c_custkey").select("c_custkey")


@add("join23_as_of", "SELECT a.event_id, (SELECT arg_max(b.value, (b.ts, b.event_id)) FROM events b WHERE b.user_id = a.user_id AND b.event_type = 'purchase' AND b.ts <= a.ts) AS value FROM events a WHERE a.event_type = 'click'")
def join23(spark, sf_dir):
    e = load(spark, sf_dir, "events")
    return J.as_of(e.where("event_type = 'click'").select("event_id", "user_id", "ts"), e.where("event_type = 'purchase'").select("event_id", "user_id", "ts", "value"), "user_id", "ts", "value", "event_id").select("event_id", "value")


@add("join24_shared_word_runs", r"""WITH b AS (SELECT DISTINCT question_id, array_to_string(w[k:k+12], ' ') AS g FROM (SELECT question_id, w, unnest(generate_series(1, len(w) - 12)) AS k FROM (SELECT question_id, list_filter(regexp_split_to_array(lower(question), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark_mcq) t WHERE len(w) >= 13) u),
d AS (SELECT DISTINCT doc_id, array_to_string(w[k:k+12], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS k FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL) t WHERE len(w) >= 13) u)
SELECT DISTINCT doc_id FROM d JOIN b USING (g)""")
def join24(spark, sf_dir):
    def grams(df, key, text):
        w = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda x: x != "")
        listed = df.where(F.col(text).isNotNull()).select(key, w.alias("w")).where(F.size("w") >= 13)
        return listed.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - 12), lambda k: F.xxhash64(F.array_join(F.slice("w", k, 13), " ")))).alias("g"))

    b = grams(load(spark, sf_dir, "benchmark_mcq"), "question_id", "question").select("g").distinct()
    return grams(load(spark, sf_dir, "documents"), "doc_id", "text").join(b, "g", "left_semi").select("doc_id").distinct()


@add("join25_retrieve_and_rerank", "SELECT vec_id, other, CAST(rank AS INT) AS rank FROM (SELECT vec_id, other, row_number() OVER (PARTITION BY vec_id ORDER BY d, other) AS rank FROM (SELECT a.vec_id, b.vec_id AS other, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) DESC, b.vec_id) AS k, round(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS d FROM embeddings a, embeddings b WHERE a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id) t WHERE k <= 20) u WHERE rank <= 5")
def join25(spark, sf_dir):
    """The best 20 by dot product, scored again by distance; the best 5 of them."""
    e = load(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = top_k(spark, sf_dir, 20).select("vec_id", "other")
    both = found.join(e.withColumnRenamed("embedding", "x"), "vec_id").join(e.select(F.col("vec_id").alias("other"), F.col("embedding").alias("y")), "other")
    gap = F.sqrt(F.aggregate(F.zip_with("x", "y", lambda a, b: F.pow(a.cast("double") - b.cast("double"), 2)), F.lit(0.0), lambda s, v: s + v))
    return both.withColumn("rank", F.row_number().over(Window.partitionBy("vec_id").orderBy(F.round(gap, 6), "other"))).where("rank <= 5").select("vec_id", "other", "rank")
