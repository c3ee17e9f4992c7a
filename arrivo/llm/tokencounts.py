"""Operator 4, token counts from an exact length histogram.

Every document is encoded once; documents are then aggregated by encoded
length. The histogram is as long as there are different lengths, however
many documents there are. Its suffix sums answer, for any context limit, how
many documents and tokens are at least that long, what all documents hold
when cut to the limit, and which length is any quantile.

Null and empty texts have length 0 and are counted. Repeated rows count each
time. An empty table gives an empty histogram, whose answers are 0 or null.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivo.llm.common import load_ranks, running_sums, small_batches, table
from arrivo.session import cut_lineage

RANKS = "byte_bpe_50k.tiktoken"
#: Lengths that one window task sums.
LENGTHS_PER_BUCKET = 1024


def token_count(text: Column, ranks_path: str) -> Column:
    """Tokens of a whole text, special tokens' strings being plain text."""
    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                     mergeable_ranks=load_ranks(ranks_path), special_tokens={})
        for texts in batches:
            yield pd.Series([len(encoding.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")

    return run(text)


def length_histogram(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """n_tokens, docs, tokens: one row for each encoded length."""
    small_batches(docs.sparkSession)
    lengths = docs.select(token_count(F.col(text), ranks_path).alias("n_tokens"))
    return lengths.groupBy("n_tokens").agg(F.count("*").alias("docs"), F.sum("n_tokens").alias("tokens"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """The histogram with docs_at_least and tokens_at_least (its own length
    included), truncated_total (tokens left when every document is cut to
    n_tokens) and quantile (share of documents that are no longer)."""
    down = histogram.withColumn("from_top", -F.floor(F.col("n_tokens") / LENGTHS_PER_BUCKET))
    sums = running_sums(down, [], "from_top", [F.desc("n_tokens")],
                        {"docs": "docs_at_least", "tokens": "tokens_at_least"})
    all_docs, all_tokens = histogram.agg(F.sum("docs"), F.sum("tokens")).first()
    sums = sums.withColumns({"all_docs": F.lit(all_docs).cast("long"), "all_tokens": F.lit(all_tokens).cast("long")})
    n = F.col("n_tokens")
    return sums.select(
        "n_tokens", "docs", "tokens", "docs_at_least", "tokens_at_least",
        (F.col("all_tokens") - F.col("tokens_at_least") + n * F.col("docs_at_least")).alias("truncated_total"),
        ((F.col("all_docs") - F.col("docs_at_least") + F.col("docs")) / F.col("all_docs")).alias("quantile"))


def answer_limits(sums: DataFrame, limits: list[int]) -> dict[int, dict[str, int]]:
    """For each context limit, which need not be a length that occurs:
    documents longer than it, tokens they hold, tokens left after cutting."""
    longer = [F.max(F.when(F.col("n_tokens") > x, F.struct("docs_at_least", "tokens_at_least"))) for x in limits]
    everything = F.max(F.struct("docs_at_least", "tokens_at_least"))
    *rows, whole = sums.agg(*longer, everything).first()
    total = whole["tokens_at_least"] if whole else 0
    out = {}
    for x, r in zip(limits, rows):
        docs, tokens = (r["docs_at_least"], r["tokens_at_least"]) if r else (0, 0)
        out[x] = {"docs_longer": docs, "tokens_longer": tokens, "truncated_total": total - tokens + x * docs}
    return out


def quantiles(sums: DataFrame, shares: list[float]) -> list[int | None]:
    """Smallest length that at least each share of the documents does not
    exceed."""
    return list(sums.agg(*[F.min(F.when(F.col("quantile") >= s, F.col("n_tokens"))) for s in shares]).first())


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    histogram = cut_lineage(length_histogram(docs, public_tokenizers.path(RANKS)), "token-lengths")
    return suffix_sums(histogram)
