"""Column functions over text. Lengths are code points unless a name says bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def word_count(text: Column) -> Column:
    """Runs of non-blank characters."""
    return F.regexp_count(text, F.lit(r"\S+"))


def long_enough(text: Column, least: int | None) -> Column:
    """True where a text has ``least`` characters; 0 and None ask for nothing but a text."""
    return text.isNotNull() if not least else F.coalesce(F.char_length(text) >= least, F.lit(False))


def has_split(path: Column, split: str) -> Column:
    """Whether a whole part of a path is a split: ``train/…``, ``train-0001…``, ``train.parquet``; not ``training``."""
    return path.rlike(rf"(^|/){split}(-|/|\.|$)")


def format_of(path: Column) -> Column:
    """The format that a file name calls for; an unknown suffix gives null instead of a guess."""
    return F.when(path.rlike(r"(?i)\.jsonl?(\.(gz|zst))?$"), "json").when(path.rlike(r"(?i)\.parquet$"), "parquet").when(path.rlike(r"(?i)\.csv$"), "csv")


def stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*?)(\.[^./]*)?$", 1)


def file_identifier(paths: Column) -> Column:
    """One file: its stem. Several: a digest of the sorted paths."""
    return F.when(F.size(paths) == 1, stem(F.try_element_at(paths, F.lit(1)))).otherwise(F.substring(F.md5(F.array_join(F.sort_array(paths), "|")), 1, 16))


def windows_of(text: Column, width: int) -> Column:
    """Consecutive windows of ``width`` characters; a short rest is added to the last whole one.

    An array of (segment_id, segment, start, end). ``end`` is ``start + width`` even if a lone
    window is shorter, and covers the rest where one was added.
    """
    n = F.char_length(text)
    whole = F.greatest(F.floor(n / width), F.lit(1)).cast("int")
    last = lambda k: k == whole - 1
    return F.transform(
        F.sequence(F.lit(0), whole - 1),
        lambda k: F.struct(
            k.alias("segment_id"),
            F.when(last(k), F.substr(text, k * width + 1)).otherwise(F.substr(text, k * width + 1, F.lit(width))).alias("segment"),
            (k * width).alias("start"),
            F.when(last(k) & (n > (k + 1) * width), n).otherwise((k + 1) * width).alias("end"),
        ),
    )


def chunks_of(text: Column, width: int, overlap: int) -> Column:
    """Chunks of ``width`` characters, each of which repeats the last ``overlap`` of the one before."""
    if not 0 <= overlap < width:
        raise ValueError("the overlap must be smaller than the width")
    hop = width - overlap
    count = F.greatest(F.ceil((F.char_length(text) - overlap) / hop), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1), lambda k: F.substr(text, k * hop + 1, F.lit(width)))


def without_markdown(text: Column) -> Column:
    """Emphasis, headings, links and inline code marks are gone; what they hold stays."""
    out = F.regexp_replace(text, r"(?m)^#{1,6}\s+", "")
    out = F.regexp_replace(out, r"\[([^\]]*)\]\([^)]*\)", "$1")
    out = F.regexp_replace(out, r"\*\*([^*]+)\*\*|__([^_]+)__", "$1$2")
    return F.regexp_replace(out, r"`([^`]*)`", "$1")


def without_lines(text: Column, pattern: str) -> Column:
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~x.rlike(pattern)), "\n")


def after(text: Column, mark: str) -> Column:
    """What follows the first ``mark``, trimmed; the text itself where it has none."""
    at = F.instr(text, mark)
    return F.when(at > 0, F.trim(F.substr(text, at + len(mark)))).otherwise(text)


def without_quotes(text: Column) -> Column:
    return F.regexp_replace(F.trim(text), r'^"([\s\S]*)"$', "$1")


def json_part(text: Column) -> Column:
    """The JSON in an answer: of a fenced block, or else from the first brace to the last."""
    fenced = F.regexp_extract(text, r"```(?:json)?\s*([\s\S]*?)```", 1)
    inner = F.when(fenced != "", fenced).otherwise(text)
    return F.regexp_extract(inner, r"(\{[\s\S]*\})", 1)


def bytes_of(size: Column) -> Column:
    """``"1.5 GiB"`` as a number of bytes; units are powers of 1024, with or without an i or a B."""
    tidy = F.upper(F.trim(size))
    number = F.regexp_extract(tidy, r"^([0-9]+(?:\.[0-9]+)?)\s*([KMGTP]?)I?B?$", 1)
    unit = F.regexp_extract(tidy, r"^([0-9]+(?:\.[0-9]+)?)\s*([KMGTP]?)I?B?$", 2)
    power = F.when(unit == "", 0).otherwise(F.instr(F.lit("KMGTP"), unit))
    return F.when(number != "", F.floor(number.cast("double") * F.pow(F.lit(1024.0), power)).cast("bigint"))


def say(n: int, step: int, units: tuple[str, ...], last: str) -> str:
    """A number with the largest unit that keeps it at one or more; one digit after the point unless it is whole."""
    sign, size = ("-" if n < 0 else ""), float(abs(n))
    for unit in units:
        if size < step:
            return f"{sign}{int(size)}{unit}" if size == int(size) else f"{sign}{size:.1f}{unit}"
        size /= step
    return f"{sign}{size:.1f}{last}"


def _said(n: Column, step: int, units: tuple[str, ...], last: str) -> Column:
    # Built-in formats round halves up from the decimal form; the digits shown are those of the binary number.
    import pandas as pd

    def run(numbers: pd.Series) -> pd.Series:
        return numbers.map(lambda x: None if pd.isna(x) else say(int(x), step, units, last))

    run.__annotations__ = {"numbers": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "string")(n)


def said_bytes(n: Column) -> Column:
    """268435456 → ``256MB``, 1500000000 → ``1.4GB``."""
    return _said(n, 1024, ("B", "KB", "MB", "GB", "TB", "PB"), "EB")


def said_count(n: Column) -> Column:
    """1500 → ``1.5K``, 5600000000000 → ``5.6T``."""
    return _said(n, 1000, ("", "K", "M", "B", "T"), "T")


def shards_for(total: Column, target: Column) -> Column:
    return F.greatest(F.lit(1), F.ceil(total / target)).cast("bigint")


def snake(name: Column) -> Column:
    """``PlanStage`` → ``plan``, ``BinIdxWriteStage`` → ``bin_idx_write``."""
    parted = F.regexp_replace(F.regexp_replace(name, r"([a-z0-9])([A-Z])", "$1_$2"), r"([A-Z]+)([A-Z][a-z])", "$1_$2")
    return F.regexp_replace(F.lower(parted), r"_stage$", "")


def short_digest(text: Column, prefix: str = "", length: int = 16) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, length))


def recursive_chunks(text: str, width: int, overlap: int, separators: tuple[str, ...] = ("\n\n", "\n", " ", "")) -> list[str]:
    """A text in chunks of at most ``width`` characters, cut at the coarsest separator that will do.

    Parts that are short enough are put together again; a chunk starts with the last parts of the one before,
    up to ``overlap`` characters.
    """
    if len(text) <= width:
        return [text] if text.strip() else []
    mark = next((s for s in separators if s == "" or s in text), "")
    finer = separators[separators.index(mark) + 1 :] if mark else ()
    out: list[str] = []
    held: list[str] = []

    def size(parts: list[str]) -> int:
        return sum(map(len, parts)) + len(mark) * max(0, len(parts) - 1)

    def flush() -> None:
        said = mark.join(held).strip()
        if said:
            out.append(said)

    for part in text.split(mark) if mark else list(text):
        if len(part) > width:
            flush()
            held = []
            out += recursive_chunks(part, width, overlap, finer or ("",))
            continue
        if held and size([*held, part]) > width:
            flush()
            while held and (size(held) > overlap or size([*held, part]) > width):
                held.pop(0)
        held.append(part)
    flush()
    return out
