"""Queries over deduplication."""

from __future__ import annotations

from pyspark.sql import functions as F

from loamline.operators import dedup as D
from loamline.plans.q_joins import _DUPS, exact_duplicates
from loamline.registry import Registry
from loamline.tables import load

registry = Registry()
add = registry.add


@add("dedup01_exact", f"SELECT doc_id FROM {_DUPS} d")
def dedup01(spark, sf_dir):
    return exact_duplicates(spark, sf_dir)


@add("dedup02_exact_removal", f"SELECT url, warc_id, source_id, lang, text, file_name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM {_DUPS} d)")
def dedup02(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    return docs.join(exact_duplicates(spark, sf_dir), "doc_id", "left_anti").select("url", "warc_id", "source_id", "lang", "text", "file_name")


@add("dedup03_fuzzy_groups")
def dedup03(spark, sf_dir):
    """Minimum hashes of runs of 24 characters: 20 bands of 13."""
    return D.fuzzy_duplicates(load(spark, sf_dir, "documents"), "doc_id", "text")


@add("dedup03_fuzzy_removal")
def dedup03_removal(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    lost = D.fuzzy_duplicates(docs, "doc_id", "text").where("doc_id <> `group`").select("doc_id")
    return docs.join(lost, "doc_id", "left_anti").select("doc_id", "source_id", "lang")


@add("dedup03_shingles", "SELECT rec_id, len(list_distinct(list_transform(generate_series(1, length(text) - 23), lambda i: substring(text, i, 24)))) AS n FROM (SELECT DISTINCT rec_id, text FROM tiny WHERE length(text) >= 24) t")
def dedup03_shingles(spark, sf_dir):
    rows = load(spark, sf_dir, "tiny").where(F.char_length("text") >= 24).select("rec_id", "text").distinct()
    runs = F.transform(F.sequence(F.lit(1), F.char_length("text") - 23), lambda i: F.xxhash64(F.substr("text", i, F.lit(24))))
    return rows.select("rec_id", F.size(F.array_distinct(runs)).cast("bigint").alias("n"))


def _tokens(spark, sf_dir):
    return load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", F.split(F.trim("text"), r"\s+").alias("w")).distinct()


_RUNS = r"""WITH t AS (SELECT DISTINCT rec_id, regexp_split_to_array(trim(text), '\s+') AS w FROM tiny WHERE text IS NOT NULL),
r AS (SELECT rec_id, k - 1 AS pos, array_to_string(w[k:k+49], chr(1)) AS run FROM (SELECT rec_id, w, unnest(generate_series(1, len(w) - 49)) AS k FROM t WHERE len(w) >= 50) u),
f AS (SELECT run, min(row(rec_id, pos)) AS first FROM r GROUP BY run HAVING count(*) > 1),
a AS (SELECT rec_id, pos AS s, pos + 50 AS e FROM r JOIN f USING (run) WHERE first <> row(rec_id, pos)),
o AS (SELECT *, sum(n) OVER (PARTITION BY rec_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN s <= lag(e) OVER (PARTITION BY rec_id ORDER BY s) THEN 0 ELSE 1 END AS n FROM a) x),
g AS (SELECT rec_id, min(s) AS s, max(e) AS e FROM o GROUP BY rec_id, island)
"""


@add("dedup04_repeated_ranges", _RUNS + 'SELECT rec_id, CAST(s AS INT) AS start, CAST(e AS INT) AS "end" FROM g')
def dedup04(spark, sf_dir):
    return D.repeated_ranges(_tokens(spark, sf_dir), "rec_id", "w", 50)


@add("dedup04_removal", _RUNS + "SELECT t.rec_id, len(t.w) - coalesce(x.n, 0) AS n FROM t LEFT JOIN (SELECT rec_id, CAST(sum(e - s) AS BIGINT) AS n FROM g GROUP BY rec_id) x USING (rec_id)")
def dedup04_removal(spark, sf_dir):
    tokens = _tokens(spark, sf_dir)
    left = D.without_ranges(tokens, D.repeated_ranges(tokens, "rec_id", "w", 50), "rec_id", "w")
    return left.select("rec_id", F.size("w").cast("bigint").alias("n"))


@add("dedup04_clip_ranges", "SELECT l_orderkey, l_linenumber, lo + CAST(ceil(s / 2) * 2 AS BIGINT) AS clip_start, lo + CAST(floor(e / 2) * 2 AS BIGINT) AS clip_end FROM (SELECT l_orderkey, l_linenumber, CAST(l_partkey AS BIGINT) AS lo, greatest(l_suppkey * 20 + 3, l_partkey) - l_partkey AS s, least(l_suppkey * 20 + 3 + CAST(l_quantity AS BIGINT) * 9, l_partkey + 900) - l_partkey AS e FROM lineitem) t WHERE CAST(floor(e / 2) * 2 AS BIGINT) - CAST(ceil(s / 2) * 2 AS BIGINT) >= 100")
def dedup04_clip(spark, sf_dir):
    from loamline.operators.joins import clip

    rows = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", (F.col("l_suppkey") * 20 + 3).alias("s"), (F.col("l_suppkey") * 20 + 3 + F.col("l_quantity").cast("bigint") * 9).alias("e"), F.col("l_partkey").alias("lo"), (F.col("l_partkey") + 900).alias("hi"))
    return clip(rows, "s", "e", "lo", "hi", 2, 100).select("l_orderkey", "l_linenumber", "clip_start", "clip_end")


@add("dedup05_semantic", "SELECT vec_id, CAST(arg_max(other, (s, -other)) AS BIGINT) AS other FROM (SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS s FROM embeddings a JOIN embeddings b ON a.label = b.label AND b.vec_id < a.vec_id) t WHERE s >= 0.3 GROUP BY vec_id")
def dedup05(spark, sf_dir):
    return D.semantic_duplicates(load(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", 0.7)


@add("dedup06_drop_duplicates", "SELECT DISTINCT source_id, file_name FROM documents")
def dedup06(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("source_id", "file_name").dropDuplicates()


@add("dedup07_corpus_ids", "SELECT 'd_' || left(sha256(text), 16) AS corpus_id, text FROM (SELECT DISTINCT text FROM tiny WHERE text IS NOT NULL) t")
def dedup07(spark, sf_dir):
    return D.corpus_of(load(spark, sf_dir, "tiny"), "text")


@add("dedup08_first_receipt", "SELECT user_id, min(event_id) AS event_id FROM events GROUP BY user_id")
def dedup08(spark, sf_dir):
    return load(spark, sf_dir, "events").groupBy("user_id").agg(F.min("event_id").alias("event_id"))


@add("dedup09_downloads", "SELECT DISTINCT source_id, file_name, source FROM documents")
def dedup09(spark, sf_dir):
    return load(spark, sf_dir, "documents").dropDuplicates(["source_id", "file_name", "source"]).select("source_id", "file_name", "source")


@add("dedup10_choices", "SELECT question_id, len(list_distinct(list_transform(options, lambda o: string_split(o, ' ')[1]))) AS n FROM benchmark_mcq")
def dedup10(spark, sf_dir):
    return load(spark, sf_dir, "benchmark_mcq").select("question_id", F.size(F.array_distinct(F.transform("options", lambda o: F.split(o, " ")[0]))).cast("bigint").alias("n"))


@add("dedup05_semantic_clusters")
def dedup05_clusters(spark, sf_dir):
    """Clusters by k-means first, then near vectors within them."""
    rows = D.clusters(load(spark, sf_dir, "embeddings"), "vec_id", "embedding", 8)
    return D.semantic_duplicates(rows, "vec_id", "embedding", "cluster", 0.7)
