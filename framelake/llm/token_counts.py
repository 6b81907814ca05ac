"""Token counts of texts."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from framelake.llm import vocab, workers

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LIMIT = 4096


def _counts(texts: pa.Array, model: str) -> pa.Array:
    workers.begin("tokens")
    cache, out = vocab.lengths_of(model), np.zeros(len(texts), np.int64)
    for start, stop in vocab.byte_blocks(texts):
        block = [t or "" for t in texts[start:stop].to_pylist()]
        if len(block) > 1:
            out[start:stop] = [sum(v) for v in cache.each(block)]
            continue
        # A later part starts with the space the part before it ended at.
        for i, part in enumerate(vocab.windows(block[0])):
            out[start] += sum(sum(v) for v in cache.each([part[1:] if i else part]))
    return pa.array(out)


def n_tokens(text: Column, model: str = MODEL) -> Column:
    """Tokens of a text under a sentencepiece model; only lengths leave the Python worker.

    Null counts as empty, and an empty text has no tokens. Batches are cut by bytes, and
    a text longer than a block at spaces, where no token can cross.
    """
    def count(texts: pa.Array) -> pa.Array:
        return _counts(texts, model)

    return F.arrow_udf(count, T.LongType())(text)


def count_tokens(docs: DataFrame, text: str = "text", limit: int = LIMIT,
                 model: str = MODEL) -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit``.

    Columns of those names are replaced, all others kept. One row out per row in,
    without a shuffle; an empty table stays empty.
    """
    body = F.col(f"`{text}`")
    counted = (docs.withColumn("n_bytes", F.coalesce(F.octet_length(body), F.lit(0)).cast("long"))
               .withColumn("n_tokens", n_tokens(body, model)))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
