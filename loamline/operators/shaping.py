"""Reshaping of records: projections that drop incomplete rows, chats, preferences, choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def project(df: DataFrame, optional: dict[str, str] | None = None, **required: str) -> DataFrame:
    """Renames columns (new=old); a row without one of the required values is dropped, an optional one may be null."""
    kept = df.where(F.lit(True))
    for old in required.values():
        kept = kept.where(F.col(old).isNotNull())
    return kept.select(*(F.col(old).alias(new) for new, old in required.items()), *(F.col(old).alias(new) for new, old in (optional or {}).items()))


def chat(user: Column, assistant: Column, system: Column | None = None) -> Column:
    """An array of (role, content); a null system text adds no message."""
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    turns = F.array(said("user", user), said("assistant", assistant))
    return turns if system is None else F.when(system.isNotNull(), F.concat(F.array(said("system", system)), turns)).otherwise(turns)


def shared_turns(messages: Column) -> Column:
    """(role, content) as (from, value), with human and gpt for user and assistant."""
    name = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    return F.transform(messages, lambda m: F.struct(name(m["role"]).alias("from"), m["content"].alias("value")))


def from_shared_turns(turns: Column) -> Column:
    name = lambda r: F.when(r.isin("human", "user"), "user").when(r.isin("gpt", "model", "assistant"), "assistant").otherwise(r)
    return F.transform(turns, lambda t: F.struct(name(t["from"]).alias("role"), t["value"].alias("content")))


def used_in(value: Column, wanted: str) -> Column:
    """Whether a comma-separated value names ``wanted``; null names nothing."""
    return F.coalesce(F.array_contains(F.transform(F.split(value, ","), lambda x: F.trim(x)), wanted), F.lit(False))


def tools_declared(messages: Column) -> Column:
    """False for a conversation that calls tools while no message declares any."""
    calls = F.exists(messages, lambda m: F.contains(F.coalesce(m["content"], F.lit("")), F.lit("<tool_call>")))
    declares = F.exists(messages, lambda m: F.contains(F.coalesce(m["content"], F.lit("")), F.lit("# Tools")))
    return ~calls | declares


def every_nth(df: DataFrame, part: str | Column, order: str, modulus: int, remainder: int) -> DataFrame:
    """The rows whose position within a part, counted from 0, leaves ``remainder``."""
    at = F.row_number().over(Window.partitionBy(part).orderBy(order)) - 1
    return df.withColumn("__at", at).where(F.pmod("__at", F.lit(modulus)) == remainder).drop("__at")


def first_rows(df: DataFrame, part: str, order: str, most: int | None) -> DataFrame:
    """At most ``most`` rows of each part; the limit counts rows that are left after all filters."""
    if not most:
        return df
    return df.withColumn("__at", F.row_number().over(Window.partitionBy(part).orderBy(order))).where(F.col("__at") <= most).drop("__at")


def first_user_text(messages: Column) -> Column:
    said = F.filter(messages, lambda m: (m["role"] == "user") & (F.trim(F.coalesce(m["content"], F.lit(""))) != ""))
    return F.try_element_at(said, F.lit(1))["content"]


def preference(prompt: Column, a: Column, b: Column, winner: Column) -> Column:
    """(prompt, chosen, rejected) by the winner, A or B; any other winner gives null."""
    w = F.upper(F.trim(winner))
    pair = lambda good, bad: F.struct(prompt.alias("prompt"), good.alias("chosen"), bad.alias("rejected"))
    return F.when(w == "A", pair(a, b)).when(w == "B", pair(b, a))


def fix_choices(choices: Column, answer: Column, wrong: Column) -> Column:
    """Distractors that are neither judged right, repeated nor the answer, after the answer itself."""
    kept = F.filter(F.arrays_zip(choices.alias("c"), wrong.alias("w")), lambda x: F.coalesce(x["w"], F.lit(False)) & (x["c"] != answer))
    return F.concat(F.array(answer), F.array_distinct(F.transform(kept, lambda x: x["c"])))


def answer_letter(response: Column) -> Column:
    """The letter of an answer, by three patterns; ``-`` where none fits."""
    found = [F.regexp_extract(response, p, 1) for p in (r"(?i)answer is:? ?\(?([A-J])\)?", r"(?i)answer: ?\(?([A-J])\)?", r"\(([A-J])\)")]
    return F.coalesce(*(F.nullif(x, F.lit("")) for x in found), F.lit("-"))


def window_pages(n: Column) -> Column:
    """How many pages a window holds for a document of ``n`` pages."""
    size = F.when(n <= 10, 2)
    for k in range(1, 6):
        size = size.when((n > 10 * k) & (n < 10 * (k + 1)), k + 2)
    return size.when(n > 60, 8).otherwise(2)


#: The parts of markup that a page reader gives: corners, text, corners, class.
BOX = r"<x_([0-9.]+)><y_([0-9.]+)>([\s\S]*?)<x_([0-9.]+)><y_([0-9.]+)><class_([^>]+)>"


def boxes(markup: Column) -> Column:
    """An array of (text, x1, y1, x2, y2, label) of a page reader's markup."""
    group = lambda k: F.regexp_extract_all(markup, F.lit(BOX), F.lit(k))
    zipped = F.arrays_zip(group(3).alias("t"), group(1).alias("a"), group(2).alias("b"), group(4).alias("c"), group(5).alias("d"), group(6).alias("k"))
    return F.transform(zipped, lambda z: F.struct(z["t"].alias("text"), z["a"].cast("double").alias("x1"), z["b"].cast("double").alias("y1"), z["c"].cast("double").alias("x2"), z["d"].cast("double").alias("y2"), z["k"].alias("label")))


def question_text(question: Column, choices: Column, answer: Column) -> Column:
    """A question with lettered options and its answer, as plain text."""
    lines = F.transform(choices, lambda c, i: F.concat(F.char(F.lit(65) + i), F.lit(". "), c))
    return F.concat(F.lit("Question: "), question, F.lit("\nOptions:\n"), F.array_join(lines, "\n"), F.lit("\nAnswer: "), answer)
