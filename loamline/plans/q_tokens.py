"""Queries over tokens, chats, packing and question building."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loamline.functions import tokens as K
from loamline.operators import aggregates as A
from loamline.operators import chat as C
from loamline.operators import packing as B
from loamline.operators import shaping as P
from loamline.operators import synthesis as Y
from loamline.plans.q_aggregates import _CUM, _SCORED, _THR, PERCENTS, scored
from loamline.plans.q_shaping import PREF, SFT, pref, sft
from loamline.registry import Registry
from loamline.session import cut
from loamline.sources import binidx
from loamline.sources.scratch import scratch
from loamline.tables import load

registry = Registry()
add = registry.add
TOKENIZERS = os.environ.get("LOAMLINE_TOKENIZERS", "/opt/tokenizers")


@add("tok01_plain_tokens", r"SELECT doc_id, CAST(len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\p{L}\p{N}\s]')) AS BIGINT) AS n FROM documents WHERE text IS NOT NULL")
def tok01(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.size(K.plain_tokens(F.col("text"))).cast("bigint").alias("n"))


@add("tok01_file_tokenizer")
def tok01_file(spark, sf_dir):
    made = K.tokenize(load(spark, sf_dir, "documents"), "doc_id", "text", "tiktoken", f"{TOKENIZERS}/byte_bpe_50k.tiktoken", end=50256)
    return made.select("doc_id", F.size("tokens").alias("n"), "error")


@add("tok02_failures_alone", "SELECT count(*) + 1 AS n, count(text) AS tokenized, CAST(1 AS INT) AS failed FROM documents")
def tok02(spark, sf_dir):
    """A row that the tokenizer can't take, a million blanks, among the documents: it alone fails."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text")
    bad = spark.range(1).select(F.lit(-1).cast("bigint").alias("doc_id"), F.repeat(F.lit(" "), 1_000_000).alias("text"))
    made = K.tokenize(docs.unionByName(bad), "doc_id", "text", "tiktoken", f"{TOKENIZERS}/byte_bpe_50k.tiktoken")
    return made.agg(F.count("*").alias("n"), F.count("tokens").alias("tokenized"), F.count("error").cast("int").alias("failed"))


@add("tok03_parsed_arguments", "SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS priority FROM orders")
def tok03(spark, sf_dir):
    said = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")))
    return load(spark, sf_dir, "orders").select("o_orderkey", F.from_json(said, "status string, priority string").alias("a")).select("o_orderkey", "a.*")


def _chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"), F.lit(None).cast("string").alias("reasoning_content"))
    rows = sft(spark, sf_dir).where("user_query IS NOT NULL AND assistant_response IS NOT NULL")
    return rows.select("row_id", F.array(said("system", F.coalesce("persona", F.lit(""))), said("user", F.col("user_query")), said("assistant", F.col("assistant_response"))).alias("messages"))


_IM = r"'<|im_start|>system' || chr(10) || coalesce(persona, '') || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || user_query || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || regexp_replace('<think></think>' || assistant_response, '\s+$', '') || '<|im_end|>' || chr(10)"


@add("tok04_rendered_chats", f"SELECT row_id, {_IM} AS said FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL AND regexp_matches(assistant_response, '^[\\x20-\\x7e\\n]*$')")
def tok04(spark, sf_dir):
    rows = _chats(spark, sf_dir).where(F.element_at("messages", 3)["content"].rlike(r"^[\x20-\x7e\n]*$"))
    return C.render(rows, "row_id", "messages").select("row_id", F.array_join(F.transform("chunks", lambda c: c["text"]), "").alias("said"))


@add("tok04_all_chats")
def tok04_all(spark, sf_dir):
    """Conversations in all scripts. Answers lose the blanks of Unicode at their ends, which SQL's patterns don't know."""
    return C.render(_chats(spark, sf_dir), "row_id", "messages").select("row_id", F.array_join(F.transform("chunks", lambda c: c["text"]), "").alias("said"))


_PROMPT = "'<|im_start|>system' || chr(10) || coalesce(persona, '') || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || user_query || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<think></think>'"


@add("tok04_generation_prompts", f"SELECT row_id, {_PROMPT} AS prompt FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL")
def tok04_prompts(spark, sf_dir):
    return C.prompts(_chats(spark, sf_dir), "row_id", "messages")


@add("tok05_last_user_end", f"SELECT row_id, length({_PROMPT}) AS n FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL")
def tok05(spark, sf_dir):
    """Where the answer starts, behind the start of the answer itself."""
    return C.prompts(_chats(spark, sf_dir), "row_id", "messages").select("row_id", F.char_length("prompt").cast("bigint").alias("n"))


@add("tok06_role_chunks", f"SELECT row_id, 3 AS chunks, 1 AS learned FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL")
def tok06(spark, sf_dir):
    return C.render(_chats(spark, sf_dir), "row_id", "messages").select("row_id", F.size("chunks").alias("chunks"), F.size(F.filter("chunks", lambda c: c["learn"])).alias("learned"))


def _two_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = lambda role, text, thought=None: F.struct(F.lit(role).alias("role"), text.alias("content"), (thought if thought is not None else F.lit(None).cast("string")).alias("reasoning_content"))
    rows = pref(spark, sf_dir).where("prompt IS NOT NULL AND response_a IS NOT NULL AND response_b IS NOT NULL")
    thought = F.when(F.col("pref_id") % 2 == 0, F.lit("Let me see."))
    return rows.select("pref_id", F.array(said("user", F.col("prompt")), said("assistant", F.col("response_a"), thought), said("user", F.lit("Once more.")), said("assistant", F.col("response_b"))).alias("messages"))


@add("tok07_turn_sequences", f"SELECT pref_id, CAST(k AS INT) AS sequence, CASE WHEN pref_id % 2 = 0 AND k = 0 THEN 2 ELSE 4 END AS messages FROM {PREF} t, (SELECT unnest([0, 1]) AS k) ks WHERE prompt IS NOT NULL AND response_a IS NOT NULL AND response_b IS NOT NULL AND (k = 0 OR pref_id % 2 = 0)")
def tok07(spark, sf_dir):
    return _two_turns(spark, sf_dir).select("pref_id", F.posexplode(C.turn_prefixes(F.col("messages"))).alias("sequence", "m")).select("pref_id", "sequence", F.size("m").alias("messages"))


@add("tok08_learned_chunks", f"SELECT pref_id, CAST(k AS INT) AS sequence, CASE WHEN pref_id % 2 = 0 THEN 1 ELSE 2 END AS learned FROM {PREF} t, (SELECT unnest([0, 1]) AS k) ks WHERE prompt IS NOT NULL AND response_a IS NOT NULL AND response_b IS NOT NULL AND (k = 0 OR pref_id % 2 = 0)")
def tok08(spark, sf_dir):
    return C.render(_two_turns(spark, sf_dir), "pref_id", "messages").select("pref_id", "sequence", F.size(F.filter("chunks", lambda c: c["learn"])).alias("learned"))


_W = r"len(regexp_extract_all({}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]'))"


@add("tok09_loss_mask", f"SELECT row_id, {_W.format('user_query')} + {_W.format('assistant_response')} AS n, {_W.format('assistant_response')} AS learned FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL")
def tok09(spark, sf_dir):
    rows = sft(spark, sf_dir).where("user_query IS NOT NULL AND assistant_response IS NOT NULL").select("row_id", P.chat(F.col("user_query"), F.col("assistant_response")).alias("m"))
    mask = F.flatten(F.transform("m", lambda c: F.array_repeat(F.when(c["role"] == "assistant", 1).otherwise(0), F.size(K.plain_tokens(c["content"])))))
    return rows.select("row_id", mask.alias("mask")).select("row_id", F.size("mask").cast("bigint").alias("n"), F.aggregate("mask", F.lit(0), lambda a, x: a + x).cast("bigint").alias("learned"))


@add("tok10_chat_pipeline", f"SELECT count(*) AS sequences, CAST(sum(least({_W.format(_IM)}, 120)) AS BIGINT) AS tokens, count(*) FILTER (WHERE {_W.format(_IM)} > 120) AS cut FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL")
def tok10(spark, sf_dir):
    """Filter, render, tokenize and cut, with a counter for each cause."""
    made = C.render(_chats(spark, sf_dir), "row_id", "messages").select(F.size(K.plain_tokens(F.array_join(F.transform("chunks", lambda c: c["text"]), ""))).alias("n"))
    return made.agg(F.count("*").alias("sequences"), F.sum(F.least("n", F.lit(120))).alias("tokens"), F.count_if(F.col("n") > 120).alias("cut"))


def _lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "documents").where("n_chars > 0").select("source", "doc_id", "n_chars")


@add("tok11_first_fit_decreasing")
def tok11(spark, sf_dir):
    return B.assign_bins(_lengths(spark, sf_dir), "source", "doc_id", "n_chars", 8192)


@add("tok12_first_fit_shuffled")
def tok12(spark, sf_dir):
    return B.assign_bins(_lengths(spark, sf_dir), "source", "doc_id", "n_chars", 8192, lambda n, c: B.first_fit_shuffled(n, c, 42))


@add("tok13_next_fit", """WITH RECURSIVE s AS (SELECT source, doc_id, least(n_chars, 8192) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents WHERE n_chars > 0),
r AS (SELECT source, doc_id, k, n AS used, 0 AS bin FROM s WHERE k = 1 UNION ALL SELECT s.source, s.doc_id, s.k, CASE WHEN r.used + s.n > 8192 THEN s.n ELSE r.used + s.n END, r.bin + CASE WHEN r.used + s.n > 8192 THEN 1 ELSE 0 END FROM r JOIN s ON s.source = r.source AND s.k = r.k + 1)
SELECT source, doc_id, bin FROM r""")
def tok13(spark, sf_dir):
    return B.assign_bins(_lengths(spark, sf_dir), "source", "doc_id", "n_chars", 8192, B.next_fit).select("source", "doc_id", "bin")


@add("tok14_clamped_lengths", "SELECT source, CAST(sum(least(n_chars, 2000)) AS BIGINT) AS n, count(*) FILTER (WHERE n_chars > 2000) AS cut FROM documents GROUP BY source")
def tok14(spark, sf_dir):
    return load(spark, sf_dir, "documents").groupBy("source").agg(F.sum(F.least("n_chars", F.lit(2000))).alias("n"), F.count_if(F.col("n_chars") > 2000).alias("cut"))


_SEQ = "(SELECT l_orderkey AS seq_id, list(CAST(l_partkey AS INT) ORDER BY l_linenumber, l_partkey) AS t FROM lineitem GROUP BY l_orderkey)"


def _sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("seq_id")).agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("v"))
    return rows.select("seq_id", F.transform("v", lambda x: x["l_partkey"].cast("int")).alias("t"))


@add("tok15_bin_offsets", f"SELECT seq_id, CAST(k - 1 AS INT) AS pos, t[k] AS token FROM (SELECT seq_id, t, unnest(generate_series(1, len(t))) AS k FROM {_SEQ} a) b")
def tok15(spark, sf_dir):
    return _sequences(spark, sf_dir).select("seq_id", F.posexplode("t").alias("pos", "token"))


@add("tok16_packed_rows", f"""SELECT CAST(seq_id % 50 AS INT) AS shard, count(*) AS sequences, CAST(sum(len(t)) AS BIGINT) AS tokens, CAST(sum(list_sum(t)) AS BIGINT) AS ids, CAST(sum(len(t) - 1) AS BIGINT) AS learned, CAST(0 AS BIGINT) AS overfull, CAST(0 AS BIGINT) AS misplaced FROM {_SEQ} a GROUP BY 1""")
def tok16(spark, sf_dir):
    """Bins of a packer put together: nothing is lost, no row is overfull, every row starts at 0 and places rise."""
    s = _sequences(spark, sf_dir).withColumn("shard", (F.col("seq_id") % 50).cast("int")).withColumn("m", F.transform("t", lambda x: F.lit(1).cast("tinyint"))).withColumn("n", F.size("t"))
    packed = B.packed_rows(s, B.assign_bins(s, "shard", "seq_id", "n", 32), "shard", "seq_id", "t", "m", 32)
    add_up = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x)
    starts = F.col("seq_start_id")
    rising = F.forall(F.sequence(F.lit(1), F.size(starts)), lambda i: F.when(i == 1, starts[0] == 0).otherwise(F.get(starts, i - 1) > F.get(starts, i - 2)))
    return packed.groupBy("shard").agg(
        F.sum(F.size(starts)).alias("sequences"), F.sum(F.size("input_ids")).alias("tokens"), F.sum(add_up("input_ids")).alias("ids"), F.sum(add_up("loss_mask")).alias("learned"),
        F.count_if(F.size("input_ids") > 32).alias("overfull"), F.count_if(~rising).alias("misplaced"),
    )


@add("tok17_shifted_masks", f"SELECT seq_id, list_concat(m[2:], [0]) AS m FROM (SELECT seq_id, list_transform(t, lambda x: CAST(x % 2 AS INT)) AS m FROM {_SEQ} a) b")
def tok17(spark, sf_dir):
    mask = F.transform("t", lambda x: (x % 2).cast("tinyint"))
    return _sequences(spark, sf_dir).select("seq_id", F.transform(C.shifted_mask(mask), lambda x: x.cast("int")).alias("m"))


@add("tok19_prompt_budgets", "SELECT name, CAST(2048 - length(name) - 2 AS INT) AS budget FROM data_blend_raw_phase1")
def tok19(spark, sf_dir):
    return load(spark, sf_dir, "data_blend_raw_phase1").select("name", (F.lit(2048) - F.char_length("name") - 2).alias("budget"))


@add("tok20_rejoined_lines")
def tok20(spark, sf_dir):
    lines = load(spark, sf_dir, "tiny").where("text IS NOT NULL").select("rec_id", "text").distinct().select("rec_id", F.posexplode(F.split("text", "\n")).alias("pos", "said"))
    return B.rejoin(lines.withColumn("n", F.size(K.plain_tokens(F.col("said")))), "rec_id", "pos", "said", "n", 64)


@add("tok21_task_buckets", f"WITH {_SCORED}, {_CUM}, {_THR} SELECT task, doc_id FROM scored, (SELECT unnest(['diverse_qa', 'distill', 'extract', 'list']) AS task) t WHERE (SELECT count(*) FROM thr WHERE threshold <= score) IN (18, 19)")
def tok21(spark, sf_dir):
    """The four tasks for documents of the two best quality buckets."""
    tasks = F.explode(F.array(*map(F.lit, ("diverse_qa", "distill", "extract", "list"))))
    return A.bucketed(cut(scored(spark, sf_dir)), "score", "bytes", PERCENTS).where(F.col("bucket").isin(18, 19)).select(tasks.alias("task"), "doc_id")


@add("tok22_question_text", "SELECT question_id, 'Question: ' || question || chr(10) || 'Options:' || chr(10) || array_to_string(list_transform(options, lambda o, i: chr(CAST(64 + i AS INT)) || '. ' || o), chr(10)) || chr(10) || 'Answer: ' || answer AS said FROM benchmark_mcq")
def tok22(spark, sf_dir):
    return load(spark, sf_dir, "benchmark_mcq").select("question_id", P.question_text(F.col("question"), F.col("options"), F.col("answer")).alias("said"))


@add("tok23_generated_questions", "SELECT 'x_' || question_id || '_q' || (k - 1) AS id, options[k] AS question FROM (SELECT question_id, options, unnest(generate_series(1, len(options))) AS k FROM benchmark_mcq) t")
def tok23(spark, sf_dir):
    rows = load(spark, sf_dir, "benchmark_mcq").select("question_id", F.posexplode("options").alias("k", "question"))
    return rows.select(F.concat(F.lit("x_"), "question_id", F.lit("_q"), "k").alias("id"), "question")


@add("tok24_shuffled_choices", "SELECT question_id, list(o ORDER BY md5('7:' || question_id || ':' || o)) AS options, chr(CAST(65 + count(*) FILTER (WHERE md5('7:' || question_id || ':' || o) < md5('7:' || question_id || ':' || a)) AS INT)) AS answer FROM (SELECT question_id, unnest(options) AS o, options[answer_index + 1] AS a FROM benchmark_mcq) t GROUP BY question_id")
def tok24(spark, sf_dir):
    key = lambda o: F.md5(F.concat(F.lit("7:"), F.col("question_id"), F.lit(":"), o))
    rows = load(spark, sf_dir, "benchmark_mcq").select("question_id", F.element_at("options", F.col("answer_index") + 1).alias("a"), F.sort_array(F.transform("options", lambda o: F.struct(key(o).alias("k"), o.alias("o")))).alias("s"))
    mixed = rows.select("question_id", "a", F.transform("s", lambda x: x["o"]).alias("options"))
    return mixed.select("question_id", "options", F.char(F.lit(64) + F.array_position("options", F.col("a"))).alias("answer"))


@add("tok25_translated_questions", "SELECT question_id, upper(question) AS question, list_transform(options, lambda o: upper(o)) AS options, answer_index FROM benchmark_mcq")
def tok25(spark, sf_dir):
    q = load(spark, sf_dir, "benchmark_mcq").select("question_id", "question", "options", "answer_index")
    return Y.translated_questions(q, lambda texts: [t.upper() for t in texts])


@add("tok26_flattened_questions", "SELECT question_id, 'question' AS kind, 0 AS pos, question AS said FROM benchmark_mcq UNION ALL SELECT question_id, 'choice', CAST(k - 1 AS INT), options[k] FROM (SELECT question_id, options, unnest(generate_series(1, len(options))) AS k FROM benchmark_mcq) t")
def tok26(spark, sf_dir):
    return Y.flat_questions(load(spark, sf_dir, "benchmark_mcq"))


@add("tok27_generated_column", f"SELECT row_id, 'Re: ' || user_query AS made FROM {SFT} t WHERE user_query IS NOT NULL")
def tok27(spark, sf_dir):
    """A column of a text generator; this one is a stand-in that answers alike every time."""
    rows = sft(spark, sf_dir).where("user_query IS NOT NULL")
    return Y.generated(rows, "row_id", "user_query", lambda prompts: [f"Re: {p}" for p in prompts]).select("row_id", "made")


@add("tok28_translation_scores")
def tok28(spark, sf_dir):
    rows = pref(spark, sf_dir).where("response_a IS NOT NULL AND response_b IS NOT NULL")
    return rows.select("pref_id", Y.bleu("response_a", "response_b").alias("bleu"), Y.chrf("response_a", "response_b").alias("chrf"), Y.ter("response_a", "response_b").alias("ter"))


@add("tok29_hashed_embeddings")
def tok29(spark, sf_dir):
    return Y.hashed_embeddings(load(spark, sf_dir, "benchmark_mcq"), "question_id", "question", 256)


@add("tok30_quality_classifier")
def tok30(spark, sf_dir):
    """A logistic regression over vectors, fitted on the even ids; its scores for the odd ones."""
    e = load(spark, sf_dir, "embeddings").withColumn("y", (F.col("label") == 0).cast("double"))
    return Y.classified(e.where("vec_id % 2 = 0"), e.where("vec_id % 2 = 1"), "vec_id", "embedding", "y")


@add("tok31_tabular_model")
def tok31(spark, sf_dir):
    """Impute, encode, scale and regress; errors on held-out rows."""
    rows = load(spark, sf_dir, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_extendedprice", (F.col("l_orderkey") % 5 == 0).alias("held"))
    return Y.regressed(rows, ["l_quantity", "l_discount", "l_tax"], ["l_returnflag", "l_linestatus"], "l_extendedprice", "held")


@add("tok32_seed_prompts", "SELECT question_id, 'Subject: ' || coalesce(category, '-') || chr(10) || question || chr(10) || array_to_string(list_transform(options, lambda o, i: '(' || chr(CAST(64 + i AS INT)) || ') ' || o), chr(10)) AS prompt FROM benchmark_mcq")
def tok32(spark, sf_dir):
    return load(spark, sf_dir, "benchmark_mcq").select("question_id", Y.seed_prompt(F.col("category"), F.col("question"), F.col("options")).alias("prompt"))


@add("tok33_generator_chain", f"SELECT row_id, 'check: draft: ' || user_query AS checked FROM {SFT} t WHERE user_query IS NOT NULL")
def tok33(spark, sf_dir):
    """Columns that are made one from another."""
    rows = sft(spark, sf_dir).where("user_query IS NOT NULL").select("row_id", "user_query")
    draft = Y.generated(rows, "row_id", "user_query", lambda p: [f"draft: {x}" for x in p])
    return Y.generated(draft, "row_id", "made", lambda p: [f"check: {x}" for x in p], name="checked").select("row_id", "checked")


@add("tok34_sentence_chunks", r"SELECT doc_id, CAST(floor((k - 1) / 5) AS BIGINT) AS chunk, array_to_string(list(s ORDER BY k), ' ') AS said FROM (SELECT doc_id, s[k] AS s, k FROM (SELECT doc_id, s, unnest(generate_series(1, len(s))) AS k FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?]+[.!?]*') AS s FROM documents WHERE text IS NOT NULL) a) b) c GROUP BY ALL")
def tok34(spark, sf_dir):
    parts = F.regexp_extract_all("text", F.lit(r"[^.!?]+[.!?]*"), F.lit(0))
    cut = F.transform(F.sequence(F.lit(0), F.floor((F.size("s") - 1) / 5).cast("int")), lambda k: F.array_join(F.slice("s", k * 5 + 1, 5), " "))
    rows = load(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", parts.alias("s")).where("size(s) > 0")
    return rows.select("doc_id", F.posexplode(cut).alias("chunk", "said")).withColumn("chunk", F.col("chunk").cast("bigint"))


@add("tok34_bundles", "SELECT source_id, doc_id, CAST(floor((row_number() OVER (PARTITION BY source_id ORDER BY doc_id) - 1) / 3) AS BIGINT) AS bundle FROM documents")
def tok34_bundles(spark, sf_dir):
    w = Window.partitionBy("source_id").orderBy("doc_id")
    return load(spark, sf_dir, "documents").select("source_id", "doc_id", F.floor((F.row_number().over(w) - 1) / 3).alias("bundle"))


@add("tok36_json_lines_core", f"SELECT user_query AS input, assistant_response AS output FROM {SFT} t WHERE user_query IS NOT NULL AND assistant_response IS NOT NULL AND topic IS NOT NULL")
def tok36(spark, sf_dir):
    """Read, keep some rows, project, write as JSON lines, read again."""
    where = scratch(spark)
    P.project(sft(spark, sf_dir).where("topic IS NOT NULL"), input="user_query", output="assistant_response").write.json(where)
    return spark.read.schema("input string, output string").json(where)


@add("tok37_index_pipeline", f"SELECT count(*) AS sequences, CAST(sum(len(t)) AS BIGINT) AS tokens, CAST(sum(list_sum(t)) AS BIGINT) AS sum FROM {_SEQ} a")
def tok37(spark, sf_dir):
    where = scratch(spark)
    binidx.register(spark)
    _sequences(spark, sf_dir).select("t").write.format("binidx").mode("append").save(where)
    back = spark.read.format("binidx").load(where)
    return back.agg(F.count("*").alias("sequences"), F.sum(F.size("tokens")).alias("tokens"), F.sum(F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, x: a + x)).alias("sum"))


@add("tok18_long_sequences_cut", f"SELECT seq_id, t[1:3] AS t, len(t) > 3 AS cut FROM {_SEQ} a")
def tok18(spark, sf_dir):
    return _sequences(spark, sf_dir).select("seq_id", F.slice("t", 1, 3).alias("t"), (F.size("t") > 3).alias("cut"))


