"""Queries over sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.registry import Registry
from loamline.sources import files, warc
from loamline.sources.scratch import scratch
from loamline.tables import TABLES, load

registry = Registry()
add = registry.add


@add("scan02_discover_files")
def scan02(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.discover(spark, sf_dir).select("name", "format", "size")


@add("scan03_mirror_files", """SELECT name, subset, concat(rtrim(path, '/ '), '/', coalesce(subset || '/', ''), coalesce(split, 'train'), '-00000.parquet') AS file
FROM data_blend_raw_phase1 WHERE regexp_matches(concat(rtrim(path, '/ '), '/', coalesce(subset || '/', ''), coalesce(split, 'train'), '-00000.parquet'), '(?i)(^|/)High-Quality(/|-|\\.)')""")
def scan03(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one subset in a mirror, by the parts of their paths."""
    file = F.concat(F.rtrim("path", F.lit("/ ")), F.lit("/"), F.coalesce(F.concat("subset", F.lit("/")), F.lit("")), F.coalesce("split", F.lit("train")), F.lit("-00000.parquet"))
    return load(spark, sf_dir, "data_blend_raw_phase1").select("name", "subset", file.alias("file")).where(F.col("file").rlike(r"(?i)(^|/)High-Quality(/|-|\.)"))


@add("scan04_split_match", r"""SELECT doc_id, regexp_matches(url, '(^|/)document-ocr(-|/|\.|$)') AS matches FROM documents WHERE url IS NOT NULL""")
def scan04(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where("url IS NOT NULL").select("doc_id", T.has_split(F.col("url"), "document-ocr").alias("matches"))


_COUNTED = list(TABLES)


@add("scan05_table_rows", " UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in _COUNTED))
def scan05(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts from the footers: nothing is read but metadata."""
    parts = [load(spark, sf_dir, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("name"), "n") for t in _COUNTED]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


@add("scan06_text_column", "SELECT text FROM documents")
def scan06(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("text")


@add("scan07_records", "SELECT * FROM tiny")
def scan07(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "tiny")


@add("scan08_json_lines", "SELECT row_id, persona, topic, user_query FROM sft_default")
def scan08(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    rows = load(spark, sf_dir, "sft_default").select("row_id", "persona", "topic", "user_query")
    rows.select(F.to_json(F.struct("*")).alias("value")).unionAll(spark.createDataFrame([("",), ("  ",)], "value string")).write.text(where)
    return files.read_json_lines(spark, where, rows.schema)


@add("scan09_format_of_names", r"""SELECT file_name, CASE WHEN regexp_matches(file_name, '(?i)\.jsonl?(\.(gz|zst))?$') THEN 'json' WHEN regexp_matches(file_name, '(?i)\.parquet$') THEN 'parquet' WHEN regexp_matches(file_name, '(?i)\.csv$') THEN 'csv' END AS format, count(*) AS n
FROM documents GROUP BY ALL""")
def scan09(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").groupBy("file_name").agg(F.count("*").alias("n")).withColumn("format", T.format_of(F.col("file_name")))


@add("scan10_json_fields", "SELECT rec_id, text FROM tiny")
def scan10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON reader that is told its fields parses nothing else."""
    where = scratch(spark)
    load(spark, sf_dir, "tiny").write.option("ignoreNullFields", "false").json(where)
    return spark.read.schema("rec_id bigint, text string").json(where)


@add("scan11_partition_folders", "SELECT r_regionkey, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_regionkey IN (1, 3) GROUP BY 1")
def scan11(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    load(spark, sf_dir, "nation").write.partitionBy("n_regionkey").parquet(where)
    picked = spark.read.option("basePath", where).parquet(f"{where}/n_regionkey=1", f"{where}/n_regionkey=3")
    return picked.groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.count("*").alias("n"))


@add("scan12_web_archive", "SELECT warc_id, url, text FROM documents WHERE url IS NOT NULL AND regexp_matches(text, '^[A-Za-z][A-Za-z ,]*\\. ') AND NOT contains(text, chr(13)) AND regexp_matches(text, '^[^\\n<&]+$') AND text = trim(text) AND NOT contains(text, '  ')")
def scan12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts put into web archive files as pages and taken out of them again."""
    docs = load(spark, sf_dir, "documents").where(
        F.col("url").isNotNull() & F.col("text").rlike(r"^[A-Za-z][A-Za-z ,]*\. ") & ~F.contains("text", F.lit("\r")) & F.col("text").rlike(r"^[^\n<&]+$") & (F.col("text") == F.trim("text")) & ~F.contains("text", F.lit("  "))
    )
    where = scratch(spark)
    warc.write_pages(docs.select("warc_id", "url", F.concat(F.lit("<html><head><title>t</title><script>var a;</script></head><body><p>"), "text", F.lit("</p></body></html>")).alias("html")), where)
    pages = warc.read_pages(spark, where)
    return pages.select("warc_id", "url", warc.main_text("html").alias("text"))


@add("scan12_all_pages")
def scan12_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with a url, as a page; one without text is an empty page. No SQL says what its main text is."""
    docs = load(spark, sf_dir, "documents").where("url IS NOT NULL")
    said = F.coalesce("text", F.lit(""))
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        said = F.replace(said, F.lit(mark), F.lit(entity))
    where = scratch(spark)
    warc.write_pages(docs.select("warc_id", "url", F.concat(F.lit("<html><head><title>t</title><script>var a;</script></head><body><p>"), said, F.lit("</p></body></html>")).alias("html")), where)
    return warc.read_pages(spark, where).select("warc_id", "url", warc.main_text("html").alias("text"))


@add("scan13_blocks_of_files", """SELECT record_id, CAST(floor((sum(size) OVER (PARTITION BY part ORDER BY record_id ROWS UNBOUNDED PRECEDING) - size) / 100000) AS BIGINT) AS block FROM
(SELECT record_id, coalesce(path, '') || '#' || coalesce(subset, '') AS part, greatest(coalesce(max(n_tokens), 0), 0) AS size FROM source_records GROUP BY 1, 2)""")
def scan13(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "source_records").groupBy("record_id", F.concat(F.coalesce("path", F.lit("")), F.lit("#"), F.coalesce("subset", F.lit(""))).alias("part")).agg(F.greatest(F.coalesce(F.max("n_tokens"), F.lit(0)), F.lit(0)).alias("size"))
    return files.blocks(rows, "part", "record_id", "size", 100_000).select("record_id", "block")


@add("scan15_generated_json", r"""SELECT pref_id, json_extract_string(j, '$.winner') AS winner FROM (SELECT pref_id, CASE WHEN json_valid(regexp_extract(judge, '(\{[\s\S]*\})', 1)) THEN regexp_extract(judge, '(\{[\s\S]*\})', 1) END AS j FROM (SELECT DISTINCT pref_id, judge FROM rl_pref) t) u WHERE j IS NOT NULL AND json_extract_string(j, '$.winner') IS NOT NULL""")
def scan15(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = load(spark, sf_dir, "rl_pref").select("pref_id", "judge").distinct()
    found = F.try_variant_get(F.try_parse_json(F.regexp_extract("judge", r"(\{[\s\S]*\})", 1)), "$.winner", "string")
    return judged.select("pref_id", found.alias("winner")).where("winner IS NOT NULL")


@add("scan16_corpus_statistics", """SELECT source, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, min(length(text)) AS least, max(length(text)) AS most, round(avg(length(text)), 4) AS mean FROM documents WHERE length(text) >= 50 GROUP BY source""")
def scan16(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.char_length("text")
    kept = load(spark, sf_dir, "documents").where(T.long_enough(F.col("text"), 50))
    return kept.groupBy("source").agg(F.count("*").alias("n"), F.sum(n).alias("chars"), F.min(n).cast("bigint").alias("least"), F.max(n).cast("bigint").alias("most"), F.round(F.avg(n), 4).alias("mean"))


@add("scan17_text_of_a_file", "SELECT doc_id, text FROM documents WHERE file_name = 'crawl-00-0001.jsonl'")
def scan17(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where(F.col("file_name") == "crawl-00-0001.jsonl").select("doc_id", "text")


@add("scan18_benchmark_adapter", "SELECT question_id AS id, question, coalesce(category, 'all') AS subject, options AS choices, answer FROM benchmark_mcq")
def scan18(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "benchmark_mcq").select(F.col("question_id").alias("id"), "question", F.coalesce("category", F.lit("all")).alias("subject"), F.col("options").alias("choices"), "answer")


@add("scan19_sequence_by_id", "SELECT vec_id, len(embedding) AS n FROM embeddings WHERE vec_id = 42")
def scan19(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "embeddings").where("vec_id = 42").select("vec_id", F.size("embedding").cast("bigint").alias("n"))


@add("scan22_delimited", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def scan22(spark: SparkSession, sf_dir: str) -> DataFrame:
    where = scratch(spark)
    load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal").write.option("header", "true").csv(where)
    return spark.read.schema("c_custkey bigint, c_name string, c_acctbal double").option("header", "true").csv(where)


@add("scan23_overlapping_chunks", """SELECT rec_id, CAST(k AS INT) AS chunk, substring(text, CAST(k AS BIGINT) * 680 + 1, 800) AS said FROM (SELECT DISTINCT rec_id, text FROM tiny WHERE text IS NOT NULL) t, LATERAL (SELECT unnest(generate_series(0, CAST(greatest(ceil((length(text) - 120) / 680), 1) AS BIGINT) - 1)) AS k)""")
def scan23(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", "text").distinct()
    return rows.select("rec_id", F.posexplode(T.chunks_of(F.col("text"), 800, 120)).alias("chunk", "said"))


@add("scan25_key_of_file_name", r"SELECT warc_id, regexp_extract(file_name, '^(.*?)(-[0-9]+)?\.[a-z]+$', 1) AS stem FROM documents")
def scan25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").select("warc_id", F.regexp_extract("file_name", r"^(.*?)(-[0-9]+)?\.[a-z]+$", 1).alias("stem"))


@add("scan26_subjects", "SELECT DISTINCT category AS subject, src FROM benchmark_mcq WHERE category IS NOT NULL ORDER BY 1, 2")
def scan26(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "benchmark_mcq").where("category IS NOT NULL").select(F.col("category").alias("subject"), "src").distinct().orderBy("subject", "src")


@add("scan29_valid_json_lines", "SELECT pref_id FROM (SELECT DISTINCT pref_id, judge FROM rl_pref) t WHERE judge IS NOT NULL AND json_valid(judge)")
def scan29(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no JSON are left out."""
    rows = load(spark, sf_dir, "rl_pref").select("pref_id", "judge").distinct()
    return rows.where(F.try_parse_json("judge").isNotNull()).select("pref_id")


@add("scan30_placeholder_targets", "SELECT row_number() OVER (ORDER BY question_id) - 1 AS row_idx, question_id FROM benchmark_mcq")
def scan30(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small target table with the positions that placeholders point to."""
    return load(spark, sf_dir, "benchmark_mcq").select((F.row_number().over(Window.orderBy("question_id")) - 1).cast("bigint").alias("row_idx"), "question_id")
