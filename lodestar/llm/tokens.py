"""Sizes of texts in tokens of a public tokenizer; the path of its vocabulary is a parameter."""

from __future__ import annotations

import base64
import os

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestar.runtime import cut_lineage, let_workers_import, parallelism, table

#: A byte-level vocabulary for many languages, in the form of ranks.
VOCABULARY = os.environ.get("LODESTAR_VOCABULARY", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")
#: How that vocabulary cuts text before it is encoded (its published pattern).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_LOADED: dict = {}


def encoding(path: str):
    """The tokenizer, loaded once in each process."""
    if path not in _LOADED:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        _LOADED[path] = tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path]


def with_token_counts(rows: DataFrame, text: str, path: str = VOCABULARY, name: str = "tokens") -> DataFrame:
    """Adds the number of tokens of a text column; null texts have none."""
    let_workers_import(rows.sparkSession)

    @F.pandas_udf(T.IntegerType())
    def count(texts: pd.Series) -> pd.Series:
        codec = encoding(path)
        return texts.map(lambda t: len(codec.encode_ordinary(t)) if t else 0).astype("int32")

    return rows.withColumn(name, count(F.col(text)))


def document_sizes(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, source, tokens) of all documents, sources in lower case with one spelling; encoded once."""
    source = F.regexp_replace(F.lower(F.trim("source")), r"[\s-]+", "_")
    rows = table(spark, root, "documents").select("doc_id", source.alias("source"), "text")
    rows = rows.repartition(max(parallelism(spark), 2 * spark.sparkContext.defaultParallelism))
    return cut_lineage(with_token_counts(rows, "text").select("doc_id", "source", "tokens"))
