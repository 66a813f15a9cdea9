"""Queries over projections, filters and row shapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.functions import text as T
from loamline.operators import shaping as P
from loamline.registry import Registry
from loamline.tables import load

registry = Registry()
add = registry.add


def sft(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "sft_default").select("row_id", "persona", "topic", "user_query", "assistant_response").distinct()


def pref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "rl_pref").select("pref_id", "prompt", "response_a", "response_b", "judge").distinct()


SFT = "(SELECT DISTINCT row_id, persona, topic, user_query, assistant_response FROM sft_default)"
PREF = "(SELECT DISTINCT pref_id, prompt, response_a, response_b, judge FROM rl_pref)"


@add("proj01_instruction_pairs", f"SELECT user_query AS input, assistant_response AS output, persona AS system FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL")
def proj01(spark, sf_dir):
    return P.project(sft(spark, sf_dir), {"system": "persona"}, input="user_query", output="assistant_response")


@add("proj02_chat_messages", f"SELECT row_id, u.role AS role, u.content AS content FROM (SELECT row_id, unnest([{{'role': 'user', 'content': user_query}}, {{'role': 'assistant', 'content': assistant_response}}]) AS u FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL) x")
def proj02(spark, sf_dir):
    rows = sft(spark, sf_dir).where("user_query IS NOT NULL AND assistant_response IS NOT NULL")
    return rows.select("row_id", F.explode(P.chat(F.col("user_query"), F.col("assistant_response"))).alias("m")).select("row_id", "m.role", "m.content")


@add("proj03_shared_turns", f"SELECT row_id, u.f AS speaker, u.v AS value FROM (SELECT row_id, unnest([{{'f': 'human', 'v': user_query}}, {{'f': 'gpt', 'v': assistant_response}}]) AS u FROM {SFT} t WHERE user_query IS NOT NULL) x")
def proj03(spark, sf_dir):
    rows = sft(spark, sf_dir).where("user_query IS NOT NULL")
    turns = P.shared_turns(P.chat(F.col("user_query"), F.col("assistant_response")))
    return rows.select("row_id", F.explode(turns).alias("t")).select("row_id", F.col("t.from").alias("speaker"), "t.value")


@add("proj04_nested_params", "SELECT pref_id, prompt AS content FROM " + PREF + " t WHERE prompt IS NOT NULL")
def proj04(spark, sf_dir):
    """The input of nested request parameters; an empty list of tools is left out."""
    nested = pref(spark, sf_dir).where("prompt IS NOT NULL").select("pref_id", F.struct(F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))).alias("input"), F.array().cast("array<string>").alias("tools")).alias("params"))
    flat = nested.select("pref_id", F.col("params.input").alias("input"), F.when(F.size("params.tools") > 0, F.col("params.tools")).alias("tools"))
    return flat.where("tools IS NULL").select("pref_id", F.element_at("input", 1)["content"].alias("content"))


@add("proj05_pass_through", "SELECT * FROM lang_codes")
def proj05(spark, sf_dir):
    return load(spark, sf_dir, "lang_codes")


@add("proj06_strict_select", f"SELECT row_id, persona, topic FROM {SFT} t WHERE row_id IS NOT NULL AND persona IS NOT NULL AND topic IS NOT NULL")
def proj06(spark, sf_dir):
    return P.project(sft(spark, sf_dir), row_id="row_id", persona="persona", topic="topic")


@add("proj07_rename", "SELECT c_custkey AS id, c_name AS name FROM customer")
def proj07(spark, sf_dir):
    return P.project(load(spark, sf_dir, "customer"), id="c_custkey", name="c_name")


@add("proj08_min_chars", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n FROM documents WHERE length(text) >= 600")
def proj08(spark, sf_dir):
    return load(spark, sf_dir, "documents").where(T.long_enough(F.col("text"), 600)).select("doc_id", F.char_length("text").cast("bigint").alias("n"))


@add("proj09_truncate", r"SELECT source, count(*) AS n, CAST(sum(CASE WHEN len(w) > 100 THEN 1 ELSE 0 END) AS BIGINT) AS cut, CAST(sum(least(len(w), 100)) AS BIGINT) AS tokens FROM (SELECT source, regexp_extract_all(text, '\S+') AS w FROM documents WHERE text IS NOT NULL) t GROUP BY source")
def proj09(spark, sf_dir):
    words = load(spark, sf_dir, "documents").where("text IS NOT NULL").select("source", F.regexp_extract_all("text", F.lit(r"\S+"), F.lit(0)).alias("w"))
    return words.select("source", F.size("w").alias("all"), F.size(F.slice("w", 1, 100)).alias("kept")).groupBy("source").agg(
        F.count("*").alias("n"), F.count_if(F.col("all") > 100).alias("cut"), F.sum("kept").alias("tokens")
    )


@add("proj10_rows_per_shard", "SELECT doc_id, file_name FROM (SELECT doc_id, file_name, row_number() OVER (PARTITION BY file_name ORDER BY doc_id) AS k FROM documents WHERE length(text) >= 200) t WHERE k <= 25")
def proj10(spark, sf_dir):
    kept = load(spark, sf_dir, "documents").where(T.long_enough(F.col("text"), 200)).select("doc_id", "file_name")
    return P.first_rows(kept, "file_name", "doc_id", 25)


@add("proj11_row_modulus", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY file_name ORDER BY doc_id) - 1 AS k FROM documents) t WHERE k % 5 = 2")
def proj11(spark, sf_dir):
    return P.every_nth(load(spark, sf_dir, "documents").select("doc_id", "file_name"), "file_name", "doc_id", 5, 2).select("doc_id")


@add("proj12_used_in", "SELECT rec_id, list_contains(list_transform(string_split(file_name, '.'), lambda x: trim(x)), 'jsonl') AS hit FROM (SELECT DISTINCT rec_id, file_name FROM tiny) t")
def proj12(spark, sf_dir):
    rows = load(spark, sf_dir, "tiny").select("rec_id", "file_name").distinct()
    return rows.select("rec_id", P.used_in(F.replace("file_name", F.lit("."), F.lit(", ")), "jsonl").alias("hit"))


@add("proj13_tools_declared", f"SELECT row_id, NOT contains(coalesce(assistant_response, ''), 'account') OR contains(coalesce(user_query, ''), 'account') AS valid FROM {SFT} t")
def proj13(spark, sf_dir):
    swap = lambda c, mark: F.replace(F.coalesce(c, F.lit("")), F.lit("account"), F.lit(mark))
    rows = sft(spark, sf_dir).select("row_id", P.chat(swap("user_query", "# Tools"), swap("assistant_response", "<tool_call>")).alias("m"))
    return rows.select("row_id", P.tools_declared(F.col("m")).alias("valid"))


@add("proj14_language_filter", r"SELECT doc_id, upper(trim(lang)) AS lang FROM documents WHERE upper(trim(lang)) IN ('EN', 'DE')")
def proj14(spark, sf_dir):
    marked = load(spark, sf_dir, "documents").where("lang IS NOT NULL").select("doc_id", F.concat(F.lit("[0.9, '"), F.upper(F.trim("lang")), F.lit("']")).alias("mark"))
    return marked.withColumn("lang", F.regexp_extract("mark", r"'([^']*)'", 1)).where(F.col("lang").isin("EN", "DE")).select("doc_id", "lang")


@add("proj15_keep_language", "SELECT c.code, count(*) AS n FROM documents d JOIN lang_codes c ON d.lang = c.code WHERE c.code IN ('en', 'fr', 'ja') GROUP BY c.code")
def proj15(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where(F.col("lang").isin("en", "fr", "ja"))
    return docs.groupBy(F.col("lang").alias("code")).agg(F.count("*").alias("n"))


@add("proj17_word_count", r"SELECT doc_id, CAST(len(regexp_extract_all(text, '\S+')) AS BIGINT) AS n_words FROM documents WHERE len(regexp_extract_all(text, '\S+')) BETWEEN 50 AND 5000")
def proj17(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", T.word_count(F.col("text")).cast("bigint").alias("n_words")).where("n_words BETWEEN 50 AND 5000")


@add("proj19_prefix", "SELECT doc_id FROM documents WHERE starts_with(text, 'The ')")
def proj19(spark, sf_dir):
    return load(spark, sf_dir, "documents").where(F.startswith("text", F.lit("The "))).select("doc_id")


@add("proj20_predicates", "SELECT doc_id FROM documents WHERE lang = 'en' AND n_chars >= 900 AND source <> 'scan'")
def proj20(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("lang = 'en' AND n_chars >= 900 AND source <> 'scan'").select("doc_id")


@add("proj23_lines", "SELECT rec_id, CAST(u.k - 1 AS INT) AS line, u.t AS said FROM (SELECT rec_id, unnest(list_zip(generate_series(1, len(string_split(text, chr(10)))), string_split(text, chr(10)))) AS z FROM (SELECT DISTINCT rec_id, text FROM tiny WHERE text IS NOT NULL) a) b, LATERAL (SELECT z[1] AS k, z[2] AS t) u")
def proj23(spark, sf_dir):
    rows = load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", "text").distinct()
    return rows.select("rec_id", F.posexplode(F.split("text", "\n")).alias("line", "said"))


@add("proj25_windows", """SELECT rec_id, CAST(k AS INT) AS segment_id, CASE WHEN k = m - 1 THEN substring(text, CAST(k * 300 + 1 AS BIGINT)) ELSE substring(text, CAST(k * 300 + 1 AS BIGINT), 300) END AS segment, CAST(CASE WHEN k = m - 1 AND length(text) > (k + 1) * 300 THEN length(text) ELSE (k + 1) * 300 END AS INT) AS "end"
FROM (SELECT rec_id, text, CAST(greatest(floor(length(text) / 300), 1) AS BIGINT) AS m FROM (SELECT DISTINCT rec_id, text FROM tiny WHERE text IS NOT NULL) a) b, LATERAL (SELECT unnest(generate_series(0, m - 1)) AS k)""")
def proj25(spark, sf_dir):
    rows = load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", "text").distinct()
    return rows.select("rec_id", F.inline(T.windows_of(F.col("text"), 300))).drop("start")


@add("proj26_seeded_window")
def proj26(spark, sf_dir):
    """A window of fixed size at a place that a hash of (seed, id) gives."""
    n = F.char_length("text")
    at = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.greatest(n - 300, F.lit(0)) + 1).cast("int")
    return load(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", at.alias("start"), F.substr("text", at + 1, F.lit(300)).alias("chunk"))


@add("proj27_clean_up", r"""SELECT rec_id, regexp_replace(array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?m)^#{1,6}\s+', '', 'g'), '\[([^\]]*)\]\([^)]*\)', '\1', 'g'), '\*\*([^*]+)\*\*|__([^_]+)__', '\1\2', 'g'), '`([^`]*)`', '\1', 'g'), chr(10)), lambda x: NOT regexp_matches(x, '^\s*[-*•]')), chr(10)), '^"([\s\S]*)"$', '\1') AS said FROM (SELECT DISTINCT rec_id, trim(text) AS text FROM tiny WHERE text IS NOT NULL)""")
def proj27(spark, sf_dir):
    rows = load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", F.trim("text").alias("text")).distinct()
    return rows.select("rec_id", F.regexp_replace(T.without_lines(T.without_markdown(F.col("text")), r"^\s*[-*•]"), r'^"([\s\S]*)"$', "$1").alias("said"))


@add("proj29_drop_columns", "SELECT rec_id, file_name FROM tiny")
def proj29(spark, sf_dir):
    return load(spark, sf_dir, "tiny").drop("text", "created_at", "loaded_at", "no_such_column")


@add("proj31_page_boxes", r"""SELECT p_partkey, p_name AS text, CAST(p_size AS DOUBLE) AS x1, p_type AS label FROM part UNION ALL SELECT p_partkey, p_brand, 1.0, 'Brand' FROM part""")
def proj31(spark, sf_dir):
    mark = F.concat(F.lit("<x_"), "p_size", F.lit("><y_0.5>"), "p_name", F.lit("<x_9.5><y_8><class_"), "p_type", F.lit("><x_1><y_0>"), "p_brand", F.lit("<x_2><y_2><class_Brand>"))
    return load(spark, sf_dir, "part").select("p_partkey", F.inline(P.boxes(mark))).select("p_partkey", "text", "x1", "label")


@add("proj32_preferences", rf"""SELECT pref_id, prompt, CASE WHEN w = 'A' THEN response_a ELSE response_b END AS chosen, CASE WHEN w = 'A' THEN response_b ELSE response_a END AS rejected FROM (SELECT *, upper(trim(json_extract_string(CASE WHEN json_valid(j) THEN j END, '$.winner'))) AS w FROM (SELECT *, regexp_extract(judge, '(\{{[\s\S]*\}})', 1) AS j FROM {PREF} a) t) u WHERE w IN ('A', 'B')""")
def proj32(spark, sf_dir):
    won = F.try_variant_get(F.try_parse_json(T.json_part(F.col("judge"))), "$.winner", "string")
    made = pref(spark, sf_dir).select("pref_id", P.preference(F.col("prompt"), F.col("response_a"), F.col("response_b"), won).alias("p"))
    return made.where("p IS NOT NULL").select("pref_id", "p.*")


@add("proj33_gym_rows", f"SELECT row_id, coalesce(user_query, topic, persona) AS content, 'user' AS role FROM {SFT} t WHERE coalesce(user_query, topic, persona) IS NOT NULL")
def proj33(spark, sf_dir):
    rows = sft(spark, sf_dir).select("row_id", P.from_shared_turns(F.array(F.struct(F.lit("human").alias("from"), F.coalesce("user_query", "topic", "persona").alias("value")))).alias("m"))
    return rows.select("row_id", F.explode("m").alias("m")).select("row_id", "m.content", "m.role").where("content IS NOT NULL")


@add("proj34_fix_choices", "SELECT question_id, list_concat([a], list_sort(list_distinct(list_filter(options, lambda c: c <> a AND length(c) % 3 <> 0)))) AS choices FROM (SELECT question_id, options, options[answer_index + 1] AS a FROM benchmark_mcq) t")
def proj34(spark, sf_dir):
    rows = load(spark, sf_dir, "benchmark_mcq").select("question_id", "options", F.element_at("options", F.col("answer_index") + 1).alias("a"))
    fixed = P.fix_choices(F.col("options"), F.col("a"), F.transform("options", lambda c: F.char_length(c) % 3 != 0))
    return rows.select("question_id", fixed.alias("f")).select("question_id", F.concat(F.slice("f", 1, 1), F.sort_array(F.slice("f", F.lit(2), F.size("f")))).alias("choices"))


@add("proj35_answer_letters", r"SELECT question_id, CASE WHEN answer_index % 3 = 0 THEN answer WHEN answer_index % 3 = 1 THEN answer ELSE '-' END AS letter FROM benchmark_mcq")
def proj35(spark, sf_dir):
    said = F.when(F.col("answer_index") % 3 == 0, F.concat(F.lit("So the answer is ("), "answer", F.lit(")."))).when(F.col("answer_index") % 3 == 1, F.concat(F.lit("Answer: "), "answer")).otherwise("no idea")
    return load(spark, sf_dir, "benchmark_mcq").select("question_id", P.answer_letter(said).alias("letter"))


@add("proj36_window_sizes", "SELECT CAST(n AS INT) AS n, CAST(CASE WHEN n <= 10 THEN 2 WHEN n > 60 THEN 8 WHEN n % 10 = 0 THEN 2 ELSE floor(n / 10) + 2 END AS INT) AS pages FROM (SELECT unnest(generate_series(1, 70)) AS n)")
def proj36(spark, sf_dir):
    return spark.range(1, 71).select(F.col("id").cast("int").alias("n")).withColumn("pages", P.window_pages(F.col("n")))


@add("proj37_answer_text", "SELECT question_id, options[answer_index + 1] AS said FROM benchmark_mcq")
def proj37(spark, sf_dir):
    return load(spark, sf_dir, "benchmark_mcq").select("question_id", F.try_element_at("options", F.col("answer_index") + 1).alias("said"))


@add("proj39_tidy_paths", r"SELECT name, regexp_replace(regexp_replace(trim(path), '(?i)^hf://', ''), '/+$', '') AS place FROM data_blend_raw_phase1")
def proj39(spark, sf_dir):
    return load(spark, sf_dir, "data_blend_raw_phase1").select("name", F.regexp_replace(F.regexp_replace(F.trim("path"), r"(?i)^hf://", ""), r"/+$", "").alias("place"))


@add("proj40_first_user_text", f"SELECT row_id, CASE WHEN trim(coalesce(user_query, '')) <> '' THEN user_query WHEN trim(coalesce(topic, '')) <> '' THEN topic END AS asked FROM {SFT} t")
def proj40(spark, sf_dir):
    said = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return sft(spark, sf_dir).select("row_id", P.first_user_text(F.array(said("assistant", "persona"), said("user", "user_query"), said("user", "topic"))).alias("asked"))


@add("proj41_title_and_text", "SELECT doc_id, concat_ws(' ', source, url) AS said FROM documents")
def proj41(spark, sf_dir):
    return load(spark, sf_dir, "documents").select("doc_id", F.concat_ws(" ", "source", "url").alias("said"))


@add("proj42_row_ids", "SELECT warc_id, row_number() OVER (PARTITION BY file_name ORDER BY warc_id) - 1 AS at FROM documents")
def proj42(spark, sf_dir):
    from pyspark.sql import Window

    return load(spark, sf_dir, "documents").select("warc_id", (F.row_number().over(Window.partitionBy("file_name").orderBy("warc_id")) - 1).cast("bigint").alias("at"))


@add("proj43_columns_renamed", f"SELECT user_query AS question, assistant_response AS answer FROM {SFT} t")
def proj43(spark, sf_dir):
    return sft(spark, sf_dir).withColumnsRenamed({"user_query": "question", "assistant_response": "answer"}).select("question", "answer")


@add("proj44_final_questions", "SELECT question_id, question, answer, answer_index, coalesce(category, '-') AS category, '-' AS src FROM benchmark_mcq WHERE length(question) >= 200")
def proj44(spark, sf_dir):
    return load(spark, sf_dir, "benchmark_mcq").where(F.char_length("question") >= 200).select("question_id", "question", "answer", "answer_index", F.coalesce("category", F.lit("-")).alias("category"), F.lit("-").alias("src"))


@add("proj45_tool_arguments", """SELECT o_orderkey, '{"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}' AS arguments FROM orders""")
def proj45(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))).alias("arguments"))


@add("proj46_file_identifiers", r"SELECT source_id, CASE WHEN count(DISTINCT file_name) = 1 THEN regexp_extract(min(file_name), '([^/]*?)(\.[^./]*)?$', 1) ELSE left(md5(string_agg(DISTINCT file_name, '|' ORDER BY file_name)), 16) END AS identifier FROM documents GROUP BY source_id")
def proj46(spark, sf_dir):
    files = load(spark, sf_dir, "documents").groupBy("source_id").agg(F.collect_set("file_name").alias("f"))
    return files.select("source_id", T.file_identifier(F.col("f")).alias("identifier"))


@add("proj16_language_score")
def proj16(spark, sf_dir):
    from loamline.operators.scoring import language_score

    scored = load(spark, sf_dir, "documents").select("doc_id", language_score("text").alias("l"))
    return scored.select("doc_id", "l.score", "l.code").where("score >= 0.3")


@add("proj18_token_count", r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\s]')) AS BIGINT) AS tokens FROM documents WHERE len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\s]')) BETWEEN 30 AND 500")
def proj18(spark, sf_dir):
    from loamline.functions.tokens import plain_tokens

    return load(spark, sf_dir, "documents").select("doc_id", F.size(plain_tokens(F.col("text"))).cast("bigint").alias("tokens")).where("tokens BETWEEN 30 AND 500")


@add("proj21_domains")
def proj21(spark, sf_dir):
    from loamline.operators.scoring import domains

    rows = sft(spark, sf_dir)
    return domains(rows.where("topic IN ('banking', 'mathematics', 'retrieval')"), rows, "row_id", "user_query", "topic", ["banking"])


@add("proj22_repaired_text")
def proj22(spark, sf_dir):
    from loamline.operators.scoring import repaired

    rows = load(spark, sf_dir, "documents").select("doc_id", "text", repaired("text").alias("fixed"))
    return rows.select("doc_id", "fixed", (~F.col("text").eqNullSafe(F.col("fixed"))).alias("changed"))


@add("proj28_question_pairs", f"SELECT row_id, trim(user_query) AS question, trim(topic) AS answer FROM {SFT} t WHERE trim(user_query) <> '' AND trim(topic) <> ''")
def proj28(spark, sf_dir):
    from loamline.operators.scoring import question_pairs

    rows = sft(spark, sf_dir).where((F.trim("user_query") != "") & (F.trim("topic") != ""))
    said = F.concat(F.lit("Here they are.\nQuestion: "), "user_query", F.lit("\nAnswer: "), "topic", F.lit("\nQuestion: none\nAnswer: "))
    return rows.select("row_id", F.inline(question_pairs(said)))


@add("proj28_bullet_items", r"SELECT rec_id, trim(regexp_replace(s, '^\s*[-*•]\s+|\s+$', '', 'g')) AS item FROM (SELECT rec_id, unnest(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^\s*[-*•]\s+\S'))) AS s FROM (SELECT DISTINCT rec_id, text FROM tiny WHERE text IS NOT NULL) a) t")
def proj28_bullets(spark, sf_dir):
    from loamline.operators.scoring import bullet_items

    rows = load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", "text").distinct()
    return rows.select("rec_id", F.explode(bullet_items(F.col("text"))).alias("item")).withColumn("item", F.trim("item"))


@add("proj38_text_to_sql", "SELECT question_id, 'Schema: ' || category || chr(10) || 'Question: ' || question || chr(10) || 'SQL: ' || answer AS said FROM benchmark_mcq WHERE length('Schema: ' || category || chr(10) || 'Question: ' || question || chr(10) || 'SQL: ' || answer) <= 400 ORDER BY length(said)")
def proj38(spark, sf_dir):
    said = F.concat(F.lit("Schema: "), "category", F.lit("\nQuestion: "), "question", F.lit("\nSQL: "), "answer")
    return load(spark, sf_dir, "benchmark_mcq").select("question_id", said.alias("said")).where("char_length(said) <= 400").orderBy(F.char_length("said"), "question_id")
