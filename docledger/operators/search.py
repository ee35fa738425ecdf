"""Full-text search over pages: an inverted index of folded tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docledger.functions import text as x


def token_index(pages: DataFrame) -> DataFrame:
    """token, document_id, page_number, tf; write it partitioned or sorted by token to prune by it."""
    tokens = F.filter(F.split(x.fold(F.coalesce("text", F.lit(""))), r"(?U)[^\p{L}\p{N}]+"), lambda t: t != "")
    return pages.select("document_id", "page_number", F.explode(tokens).alias("token")).groupBy("token", "document_id", "page_number").agg(F.count(F.lit(1)).alias("tf"))


def match(index: DataFrame, terms: list[str]) -> DataFrame:
    """document_id, page_number, hits: pages that hold all the terms, in any case and with or without accents."""
    wanted = sorted({x.folded(t) for t in terms})
    found = index.where(F.col("token").isin(wanted)).groupBy("document_id", "page_number").agg(F.count(F.lit(1)).alias("found"), F.sum("tf").alias("hits"))
    return found.where(F.col("found") == len(wanted)).select("document_id", "page_number", "hits")
