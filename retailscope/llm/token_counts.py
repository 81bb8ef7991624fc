"""Token counts: Arrow functions that encode distinct pieces in batches and return lengths only."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailscope.llm.common import only_named, whole_text, worker_state
from retailscope.llm.pieces import EncodedInBatches, cut, groups_by_bytes, vocabulary_path

VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 512


def length_cache(vocabulary: str) -> EncodedInBatches:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the unit of parallelism
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary_path(vocabulary))
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def lengths(pieces: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    return EncodedInBatches(lengths)


def count_tokens(
    docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = TOKEN_LIMIT,
    id_column: str = "doc_id", text_column: str = "text",
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per input row, in one pass without a shuffle.

    ``n_tokens`` is what the tokenizers library gives for the whole text without begin, end or padding
    tokens; strings of special tokens inside a text count as the library reads them. Null and empty
    texts have 0 bytes and 0 tokens. Repeated rows come out as often as they came in.
    """

    def lengths(texts: pa.Array) -> pa.Array:
        cache = worker_state("pieces", ("lengths", vocabulary), lambda: length_cache(vocabulary))
        totals = []
        for group in groups_by_bytes(texts.to_pylist()):
            split = [cut(text) for text in group]
            cache.learn(split)
            totals += [cache.first[p[0]] + sum(map(cache.known.__getitem__, p[1:])) for p in split]
            cache.forget_long()
        return pa.array(totals, pa.int64())

    rows = only_named(docs, doc_id=id_column, text=text_column).select("doc_id", whole_text().alias("text"))
    counted = F.arrow_udf(lengths, "bigint")(F.col("text"))
    return (
        rows.withColumn("n_tokens", counted)
        .select("doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), "n_tokens")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
