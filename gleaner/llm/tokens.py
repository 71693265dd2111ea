"""Sizes in tokens of a public tokenizer (byte-level BPE ranks)."""

from __future__ import annotations

import base64
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tokenizer:
    """folder: where the tokenizers' files are, on every executor. file: ranks, one base64 token and number a line."""

    folder: str = "/opt/tokenizers"
    file: str = "byte_bpe_50k.tiktoken"
    #: Fixed value: how this tokenizer parts a text before merging.
    pattern: str = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=2)
def encoding(tokenizer: Tokenizer):
    import tiktoken

    with open(f"{tokenizer.folder}/{tokenizer.file}", "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=tokenizer.pattern, mergeable_ranks=ranks, special_tokens={})


def with_token_count(df: DataFrame, column: str = "text", out: str = "n_tokens", tokenizer: Tokenizer = Tokenizer()) -> DataFrame:
    """df with the number of tokens of the whole text; null and empty texts have 0."""

    @F.pandas_udf("bigint")
    def count(texts: pd.Series) -> pd.Series:
        encode = encoding(tokenizer).encode_ordinary
        return texts.map(lambda t: len(encode(t)) if t else 0)

    return df.withColumn(out, count(F.col(column)))
