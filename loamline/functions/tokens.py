"""Tokenizers: a plain one of built-in functions, and those of files, loaded once in a worker."""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.session import spread

PLAIN = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\s]"
#: Fixed value: how the public byte-level vocabulary splits a text before merging.
PIECES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_loaded: dict[tuple[str, str], Callable[[str], list[int]]] = {}


def plain_tokens(text: Column) -> Column:
    """Runs of letters and digits, and single marks."""
    return F.regexp_extract_all(text, F.lit(PLAIN), F.lit(0))


def tokenizer(kind: str, path: str) -> Callable[[str], list[int]]:
    """text → ids, without special tokens, by a file of one of three libraries."""
    if (kind, path) not in _loaded:
        if kind == "tiktoken":
            import tiktoken

            with open(path, "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            _loaded[kind, path] = tiktoken.Encoding("file", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        elif kind == "sentencepiece":
            import sentencepiece

            _loaded[kind, path] = sentencepiece.SentencePieceProcessor(model_file=path).encode
        elif kind == "huggingface":
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            _loaded[kind, path] = lambda text: t.encode(text, add_special_tokens=False).ids
        else:
            raise ValueError(f"no tokenizer of kind {kind!r}")
    return _loaded[kind, path]


def tokenize(df: DataFrame, key: str, text: str, kind: str, path: str, end: int | None = None) -> DataFrame:
    """(key, tokens, error): a row that can't be tokenized has an error instead and doesn't stop the others.

    A null text has neither. ``end`` is added to each sequence.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(kind, path)
        tail = [] if end is None else [end]
        for b in batches:
            tokens, errors = [], []
            for t in b.column(1).to_pylist():
                try:
                    tokens.append(None if t is None else [*encode(t), *tail])
                    errors.append(None)
                except BaseException as e:  # a tokenizer's panic is no Exception
                    if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit)):
                        raise
                    tokens.append(None)
                    errors.append(str(e)[:200])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tokens, pa.list_(pa.int32())), pa.array(errors, pa.string())], names=[key, "tokens", "error"])

    return spread(df.select(key, text)).mapInArrow(run, f"`{key}` {df.schema[key].dataType.simpleString()}, tokens array<int>, error string")
