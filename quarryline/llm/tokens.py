"""Sizes of texts in tokens of a public tokenizer.

The tokenizer is a byte-level BPE over a rank file whose path is a parameter; it is read once per Python worker.
Null texts have 0 tokens; texts are counted whole.
"""

from __future__ import annotations

import base64
import functools

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The tokenizer named for packing and mixing: the byte-level BPE for many languages.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank file.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(4)
def encoding(path: str):
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("rank-file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_count(text: Column, path: str = TOKENIZER) -> Column:
    """The number of tokens of ``text``."""

    @F.pandas_udf(T.LongType())
    def count(texts: pd.Series) -> pd.Series:
        encode = encoding(path).encode_ordinary
        return pd.Series([len(encode(t)) if t else 0 for t in texts], dtype="int64")

    return count(text)
