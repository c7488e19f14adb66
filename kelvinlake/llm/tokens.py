"""Token counts of whole texts under a public byte-level BPE tokenizer."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the ranks of the tokenizer lie on every executor; a parameter of every operator that counts tokens.
RANKS_PATH = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-tokenisation pattern that belongs to these ranks.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Texts longer than this are encoded in parts, which bounds the memory of one call.
PART_CHARS = 200_000
#: A single space between two letters or digits always begins a new part of the pattern, so cutting before it changes no token.
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


def load_encoding(path: str = RANKS_PATH):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("public_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count_tokens(encoding, text: str | None) -> int:
    """Tokens of the whole text; null and empty texts have none."""
    if not text:
        return 0
    total, at = 0, 0
    while len(text) - at > PART_CHARS and (cut := _CUT.search(text, at + PART_CHARS)):
        total += len(encoding.encode_ordinary(text[at : cut.start()]))
        at = cut.start()
    return total + len(encoding.encode_ordinary(text[at:]))


def token_counts(df: DataFrame, text_col: str, keep: list[str], ranks_path: str = RANKS_PATH) -> DataFrame:
    """``keep`` columns and n_tokens of each row; the text itself stays behind."""
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema.fields) + ", n_tokens long"
    names = [*keep, "n_tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(ranks_path)
        for batch in batches:
            counts = [count_tokens(encoding, t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(counts, pa.int64())], names=names)

    return df.select(F.col(text_col).alias("__text"), *keep).mapInArrow(run, schema)
