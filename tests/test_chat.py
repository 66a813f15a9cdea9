from loamline.operators.chat import START, chunks, describe_tools, prompt, prompts, render, sequences

U, A, S = {"role": "user", "content": "u"}, {"role": "assistant", "content": "a"}, {"role": "system", "content": "s"}


def text(made):
    return "".join(t for _, t in made)


def test_plain_conversation():
    assert text(chunks([S, U, A])) == "<|im_start|>system\ns<|im_end|>\n<|im_start|>user\nu<|im_end|>\n<|im_start|>assistant\n<think></think>a<|im_end|>\n"
    assert text(chunks([U])).startswith("<|im_start|>system\n<|im_end|>\n<|im_start|>user")


def test_reasoning_gives_a_sequence_for_each_turn():
    thought = {"role": "assistant", "content": "a", "reasoning_content": "t"}
    made = sequences([S, U, thought, U, thought])
    assert [len(s) for s in made] == [3, 5]
    assert [[learn for *_, learn in s] for s in made] == [[False, False, True], [False, False, False, False, True]]
    assert "<think>\nt\n</think>\na" in made[0][2][1]
    assert made[1][2][1] == START + "assistant\n<think></think>\na<|im_end|>\n"  # earlier thoughts are left out
    assert [[learn for *_, learn in s] for s in sequences([S, U, A, U, A])] == [[False, False, True, False, True]]


def test_tools_calls_and_answers():
    tools = [{"function": {"name": "f", "description": " d ", "parameters": {"type": "object", "properties": {"x": {"type": "int", "description": "n", "enum": [1], "minimum": 0}}, "required": ["x"]}}}]
    said = describe_tools(tools)
    assert "<name>f</name>\n<description>d</description>\n<parameters>\n<parameter>\n<name>x</name>\n<type>int</type>\n<description>n</description>\n<enum>[1]</enum>\n<minimum>0</minimum>\n</parameter>" in said and "<required>" in said
    call = {"role": "assistant", "content": "", "tool_calls": [{"function": {"name": "f", "arguments": '{"x": 1, "y": {"z": 2}}'}}]}
    made = chunks([U, call, {"role": "tool", "content": "1"}, {"role": "tool", "content": "2"}, A], tools)
    assert [r for r, _ in made] == ["system", "user", "assistant", "tool", "assistant"]
    assert made[2][1] == START + 'assistant\n<think></think>\n<tool_call>\n<function=f>\n<parameter=x>\n1\n</parameter>\n<parameter=y>\n{"z": 2}\n</parameter>\n</function>\n</tool_call>\n<|im_end|>\n'
    assert made[3][1] == START + "user\n<tool_response>\n1\n</tool_response>\n<tool_response>\n2\n</tool_response>\n<|im_end|>\n"
    broken = {"role": "assistant", "content": "x", "tool_calls": [{"function": {"name": "f", "arguments": "{no json"}}]}
    assert "<function=f>\n</function>" in text(chunks([U, broken]))


def test_null_and_empty_conversations(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "id int, messages array<struct<role:string,content:string>>")
    assert render(df, "id", "messages").count() == 0


def test_every_conversation_is_rendered(spark, sf):
    from loamline.plans import q_tokens

    def said(r):
        answer = r["assistant_response"]
        answer = answer if "<think>" in answer or "</think>" in answer else "<think></think>" + answer
        return f"<|im_start|>system\n{r['persona'] or ''}<|im_end|>\n<|im_start|>user\n{r['user_query']}<|im_end|>\n<|im_start|>assistant\n{answer.strip()}<|im_end|>\n"

    rows = spark.read.parquet(f"{sf}/sft_default.parquet").where("user_query IS NOT NULL AND assistant_response IS NOT NULL").select("row_id", "persona", "topic", "user_query", "assistant_response").distinct().collect()
    got = sorted(tuple(r) for r in q_tokens.registry.queries["tok04_all_chats"](spark, sf).collect())
    assert got == sorted((r["row_id"], said(r)) for r in rows)
    assert any(not r["assistant_response"].isascii() for r in rows)


def test_options():
    thought = {"role": "assistant", "content": "a", "reasoning_content": "t"}
    kept, cut = chunks([U, thought, U], keep_thoughts=True), chunks([U, thought, U])
    assert kept[2][1] == START + "assistant\n<think>\nt\n</think>\na<|im_end|>\n" and cut[2][1] == START + "assistant\n<think></think>\na<|im_end|>\n"
    told = chunks([U, A, U], budget=512)
    assert told[3][1] == START + "user\nu\n\n{thinking token budget: 512}<|im_end|>\n" and "budget" not in told[1][1]
    assert chunks([U], generate=True)[-1] == ("generate", START + "assistant\n<think>\n")
    assert chunks([U], generate=True, think=False)[-1] == ("generate", START + "assistant\n<think></think>")


def test_prompts_are_what_the_answer_follows(spark):
    thought = {"role": "assistant", "content": "a", "reasoning_content": "t"}
    for messages in ([S, U, A], [U, A, U, A], [S, U, thought], [U, thought, U, thought]):
        assert text(chunks(messages)).startswith(prompt(messages)) and prompt(messages).endswith("<think>\n" if "reasoning_content" in messages[-1] else "<think></think>")
    assert prompt([S]) == "" and prompt([U]).endswith("<think>\n") and prompt([U, thought], think=False).endswith("<think></think>")
    df = spark.createDataFrame([(1, None), (2, [("user", "u")])], "id int, messages array<struct<role:string,content:string>>")
    assert {r["id"]: r["prompt"] for r in prompts(df, "id", "messages").collect()} == {1: None, 2: prompt([U])}
