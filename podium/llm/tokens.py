"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the tokenizer's ranks lie; every function takes another path.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern that splits text before the merges of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoding(path: str):
    """The tokenizer whose ranks are in the file ``path``, once per worker."""
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_sizes(documents: DataFrame, key: str, text: str, tokenizer: str = TOKENIZER, keep: tuple[str, ...] = ()) -> DataFrame:
    """``key``, the columns ``keep`` and ``n_tokens`` of every row; null and empty texts have 0 tokens.

    Whole texts are counted; only the sizes leave the Python worker.
    """
    columns = [key, *keep]
    rows = documents.select(*columns, F.col(text).alias("_text"))
    types = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = encoding(tokenizer).encode_ordinary
        for batch in batches:
            sizes = [len(count(t)) if t else 0 for t in batch.column(len(columns)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(columns))), pa.array(sizes, pa.int64())], names=[*columns, "n_tokens"])

    return rows.mapInArrow(run, ", ".join(f"`{c}` {types[c]}" for c in columns) + ", n_tokens bigint")
