"""Conversations as text for training: rendering, turns and loss masks.

A conversation is rendered straight into chunks of (role, text); the text of a conversation is its chunks
put together, and the loss is taken on assistant chunks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the chat format.
START, END = "<|im_start|>", "<|im_end|>\n"
THINK, NO_THOUGHT = ("<think>\n", "\n</think>\n"), "<think></think>"
#: Fixed value: what follows the list of tools.
TOOL_FORMAT = (
    "\n\nIf you choose to call a function ONLY reply in the following format with NO suffix:\n\n<tool_call>\n<function=example_function_name>\n<parameter=example_parameter_1>\nvalue_1\n</parameter>\n"
    "<parameter=example_parameter_2>\nThis is the value for the second parameter\nthat can span\nmultiple lines\n</parameter>\n</function>\n</tool_call>\n\n<IMPORTANT>\nReminder:\n"
    "- Function calls MUST follow the specified format: an inner <function=...></function> block must be nested within <tool_call></tool_call> XML tags\n- Required parameters MUST be specified\n"
    "- You may provide optional reasoning for your function call in natural language BEFORE the function call, but NOT after\n"
    "- If there is no function call available, answer the question like normal with your current knowledge and do not tell the user about function calls\n</IMPORTANT>"
)


def _plain(value) -> str:
    return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False) if isinstance(value, (dict, list)) else str(value)


def _tags(fields: dict, *known: str) -> str:
    return "".join(f"\n<{k}>{_plain(v)}</{k}>" for k, v in fields.items() if k not in known)


def describe_tools(tools: list[dict]) -> str:
    out = ["# Tools\n\nYou have access to the following functions:\n\n<tools>"]
    for tool in tools:
        f = tool.get("function", tool)
        params = f.get("parameters") or {}
        out.append(f"\n<function>\n<name>{f.get('name')}</name>" + (f"\n<description>{f['description'].strip()}</description>" if f.get("description") is not None else "") + "\n<parameters>")
        for name, p in (params.get("properties") or {}).items():
            out.append(f"\n<parameter>\n<name>{name}</name>")
            out.append(f"\n<type>{p['type']}</type>" if "type" in p else "")
            out.append(f"\n<description>{p['description'].strip()}</description>" if "description" in p else "")
            out.append(f"\n<enum>{json.dumps(p['enum'], ensure_ascii=False)}</enum>" if "enum" in p else "")
            out.append(_tags(p, "name", "type", "description", "enum") + "\n</parameter>")
        out.append(_tags(params, "type", "properties", "required"))
        out.append(f"\n<required>{json.dumps(params['required'], ensure_ascii=False)}</required>" if "required" in params else "")
        out.append("\n</parameters>" + _tags(f, "type", "name", "description", "parameters") + "\n</function>")
    return "".join(out) + "\n</tools>" + TOOL_FORMAT


def _arguments(call: dict) -> dict:
    said = call.get("arguments") or {}
    if isinstance(said, str):
        try:
            said = json.loads(said)
        except ValueError:
            said = {}
    return said if isinstance(said, dict) else {}


def _assistant(m: dict, past: bool) -> str:
    said, thought = m.get("content") or "", (m.get("reasoning_content") or "")
    if thought.strip():
        said = THINK[0] + thought + THINK[1] + said
    elif "<think>" not in said and "</think>" not in said:
        said = NO_THOUGHT + said
    calls = m.get("tool_calls") or []
    if past:  # thoughts before the last user turn are left out
        if "</think>" in said and (calls or "<think>" in said):
            said = NO_THOUGHT + (said.split("</think>")[-1].strip() if calls else said.split("</think>")[-1])
        elif calls and "<think>" in said:
            said = NO_THOUGHT + said.split("<think>")[0].strip()
        elif calls:
            said = NO_THOUGHT + said.strip()
    text = START + "assistant\n" + said.strip()
    if calls:
        text += "\n"
        for c in calls:
            f = c.get("function", c)
            text += f"<tool_call>\n<function={f['name']}>\n" + "".join(f"<parameter={k}>\n{_plain(v)}\n</parameter>\n" for k, v in _arguments(f).items()) + "</function>\n</tool_call>\n"
    return text + END


def generation_prompt(think: bool = True) -> str:
    """What an answer starts with when it is still to be made."""
    return START + "assistant\n" + (THINK[0] if think else NO_THOUGHT)


def chunks(messages: list[dict], tools: list[dict] | None = None, *, keep_thoughts: bool = False, budget: int | None = None, generate: bool = False, think: bool = True) -> list[tuple[str, str]]:
    """(role, text) of a conversation; a run of tool answers is one chunk of a user's.

    Thoughts before the last user turn are left out unless ``keep_thoughts``. ``budget`` tells the last user turn how many
    tokens a thought may take. With ``generate`` the start of the next answer follows, as a chunk of its own, open for a
    thought or (without ``think``) with an empty one.
    """
    system = (messages[0].get("content") or "") if messages and messages[0]["role"] == "system" else ""
    rest = messages[1:] if messages and messages[0]["role"] == "system" else messages
    head = START + "system\n" + system
    if tools:
        head += ("\n\n" if system else "") + describe_tools(tools)
    out = [("system", head + END)]
    last = max((i for i, m in enumerate(rest) if m["role"] == "user"), default=-1)
    for i, m in enumerate(rest):
        if m["role"] == "assistant":
            out.append(("assistant", _assistant(m, i < last and not keep_thoughts)))
        elif m["role"] == "tool":
            first = i == 0 or rest[i - 1]["role"] != "tool"
            final = i + 1 == len(rest) or rest[i + 1]["role"] != "tool"
            text = (START + "user\n" if first and i else "") + f"<tool_response>\n{m.get('content') or ''}\n</tool_response>\n" + (END if final else "")
            if first:
                out.append(("tool", text))
            else:
                out[-1] = ("tool", out[-1][1] + text)
        else:
            told = f"\n\n{{thinking token budget: {budget}}}" if budget is not None and i == last else ""
            out.append((m["role"], f"{START}{m['role']}\n{m.get('content') or ''}{told}{END}"))
    if generate:
        out.append(("generate", generation_prompt(think)))
    return out


def prompt(messages: list[dict], tools: list[dict] | None = None, think: bool = True) -> str:
    """A conversation up to its last user turn and the start of the answer to it; what comes after this is to be learnt.

    An answer that doesn't reason starts with an empty thought. Without a user turn there is no prompt.
    """
    last = max((i for i, m in enumerate(messages) if m["role"] == "user"), default=None)
    if last is None:
        return ""
    answer = messages[last + 1] if last + 1 < len(messages) else {}
    reasons = bool(answer.get("reasoning_content")) or not answer
    return "".join(t for _, t in chunks(messages[: last + 1], tools, generate=True, think=think and reasons))


def sequences(messages: list[dict], tools: list[dict] | None = None) -> list[list[tuple[str, str, bool]]]:
    """The training sequences of a conversation, as chunks of (role, text, learn).

    With reasoning anywhere there is one sequence for each user turn, up to the next one, which learns
    from what follows that turn only; without, one sequence learns from every assistant chunk.
    """
    users = [i for i, m in enumerate(messages) if m["role"] == "user"]
    if not any(m.get("reasoning_content") for m in messages):
        return [[(r, t, r == "assistant") for r, t in chunks(messages, tools)]]
    out = []
    for k, _ in enumerate(users):
        part = messages[: users[k + 1]] if k + 1 < len(users) else messages
        made = chunks(part, tools)
        start = max(i for i, (r, _) in enumerate(made) if r == "user")
        out.append([(r, t, r == "assistant" and i > start) for i, (r, t) in enumerate(made)])
    return out


def render(df: DataFrame, key: str, messages: str, tools: str | None = None) -> DataFrame:
    """(key, sequence, chunks): a row for each training sequence of each conversation. ``tools`` is a JSON text or null."""
    kind = df.schema[key].dataType.simpleString()
    chunk = pa.struct([("role", pa.string()), ("text", pa.string()), ("learn", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, number, made = [], [], []
            for i, (m, t) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                for n, s in enumerate(sequences(m, json.loads(t) if t else None) if m else []):
                    at.append(i)
                    number.append(n)
                    made.append([dict(zip(("role", "text", "learn"), c)) for c in s])
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(number, pa.int32()), pa.array(made, pa.list_(chunk))], names=[key, "sequence", "chunks"])

    said = F.col(tools) if tools else F.lit(None).cast("string")
    return df.select(key, messages, said.alias("__tools")).mapInArrow(run, f"`{key}` {kind}, sequence int, chunks array<struct<role:string,text:string,learn:boolean>>")


def prompts(df: DataFrame, key: str, messages: str, tools: str | None = None, think: bool = True) -> DataFrame:
    """(key, prompt): the text of each conversation up to where the answer to its last user turn is made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [prompt(m, json.loads(t) if t else None, think) if m else None for m, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(made, pa.string())], names=[key, "prompt"])

    said = F.col(tools) if tools else F.lit(None).cast("string")
    return df.select(key, messages, said.alias("__tools")).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, prompt string")


def turn_prefixes(messages: Column) -> Column:
    """For each user turn the messages up to the next one; the whole conversation if nothing in it reasons."""
    users = F.filter(F.transform(messages, lambda m, i: F.when(m["role"] == "user", i)), lambda i: i.isNotNull())
    ends = F.concat(F.slice(users, F.lit(2), F.greatest(F.size(users) - 1, F.lit(0))), F.array(F.size(messages)))
    reasons = F.exists(messages, lambda m: F.coalesce(m["reasoning_content"], F.lit("")) != "")
    return F.when(reasons, F.transform(ends, lambda e: F.slice(messages, F.lit(1), e))).otherwise(F.array(messages))


def shifted_mask(mask: Column) -> Column:
    """A mask for labels that are one token ahead: shifted left, 0 at the end."""
    return F.when(F.size(mask) > 0, F.concat(F.slice(mask, F.lit(2), F.size(mask) - 1), F.array(F.lit(0).cast("tinyint")))).otherwise(mask)
