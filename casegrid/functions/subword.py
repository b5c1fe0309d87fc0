"""F1 with a model's own tokens: middle truncation by a byte-level BPE vocabulary.

The vocabulary is a file of ranks (a token in base64 and its rank on each line), which
the driver reads once and broadcasts: such files have some tens of thousands of
lines, and ``MAX_RANKS`` bounds them. Texts are coded in Arrow batches, with one
encoder for each Python worker.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type

from casegrid import schemas as S

MAX_RANKS = 1 << 19

# Fixed value: how texts are split before the merges of these vocabularies.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> dict[bytes, int]:
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            token, rank = line.split()
            ranks[base64.b64decode(token)] = int(rank)
            if len(ranks) > MAX_RANKS:
                raise ValueError(f"{path} has more than {MAX_RANKS} tokens")
    return ranks


def encoding(ranks: dict[bytes, int], split: str = SPLIT):
    import tiktoken

    return tiktoken.Encoding("ranks", pat_str=split, mergeable_ranks=ranks, special_tokens={})


def shortened(codec, text: str, head: int, tail: int, placeholder: str) -> tuple[str, int]:
    """The text with its first ``head`` and last ``tail`` tokens if it has more, and its number of tokens.

    A character that a cut goes through becomes U+FFFD, as decoders write it."""
    tokens = codec.encode_ordinary(text)
    if len(tokens) <= head + tail:
        return text, len(tokens)
    return codec.decode(tokens[:head]) + placeholder + codec.decode(tokens[len(tokens) - tail :] if tail else []), len(tokens)


_SHORT = pa.struct([("text", pa.string()), ("n_tokens", pa.int32())])
_made: list = [None, None]


def truncate_middle(spark: SparkSession, text: Column, path: str, head: int = S.TRUNCATE_HEAD_TOKENS, tail: int = S.TRUNCATE_TAIL_TOKENS,
                    placeholder: str = S.TRUNCATE_PLACEHOLDER) -> Column:
    """A struct of ``text`` and ``n_tokens`` by the vocabulary of ``path``; null for a null text."""
    ranks = spark.sparkContext.broadcast(read_ranks(path))

    @F.arrow_udf(from_arrow_type(_SHORT))
    def shorten(texts: pa.Array) -> pa.Array:
        if _made[0] is not ranks.value:
            _made[:] = [ranks.value, encoding(ranks.value)]
        out = [None if t is None else shortened(_made[1], t, head, tail, placeholder) for t in texts.to_pylist()]
        return pa.array([None if x is None else {"text": x[0], "n_tokens": x[1]} for x in out], _SHORT)

    return shorten.asNondeterministic()(text)  # two uses of its result don't make Spark run it twice
