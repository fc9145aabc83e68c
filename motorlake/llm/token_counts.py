"""Token counts from prefix tables.

For every text the exact token count of each of its prefixes follows by dynamic programming (``bpe.Encoder``), and
answers truncation and budget questions without encoding again. A count is the table's last entry.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from motorlake.llm.bpe import encoder


def count_tokens(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every whole text; null counts as empty (0 tokens).

    Narrow: no shuffle, one Arrow batch of texts in memory. Repeated rows and null keys give a row each.
    """
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(tokenizer)
        for texts in batches:
            yield pd.Series(enc.counts(texts.tolist()), dtype="int64")

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    counted = docs.select(
        F.col(f"`{key}`").alias("doc_id"), F.octet_length(whole).cast("bigint").alias("n_bytes"),
        F.pandas_udf(count, "bigint")(whole).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_tables(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, counts``: entry i is the token count of the first i characters, for i from 0 to the text's length."""
    def tables(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(tokenizer)
        for texts in batches:
            yield pd.Series([enc.prefix_counts(t) for t in texts])

    whole = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.pandas_udf(tables, "array<int>")(whole).alias("counts"))


def longest_prefix(tables: DataFrame, budget: int) -> DataFrame:
    """``doc_id, n_chars, n_tokens``: the longest prefix of at most ``budget`` tokens, from the table alone."""
    fits = F.expr(f"filter(sequence(0, size(counts) - 1), i -> counts[i] <= {int(budget)})")
    return tables.select("doc_id", "counts", F.array_max(fits).alias("n_chars")).select(
        "doc_id", "n_chars", F.expr("counts[n_chars]").alias("n_tokens"))
