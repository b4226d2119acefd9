"""Exact token-length histogram of a corpus, and what any context limit leaves of it.

Documents are counted by encoded length, which is the only pass over the texts: the histogram is kept as a table and
every other figure follows from it by sums over the shorter and the longer lengths: totals, quantiles, and for a context
limit the documents and tokens it cuts. Running sums go over blocks of lengths first, so that no single task needs the
whole histogram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martworks.llm.scratch import Scratch, only
from martworks.llm.token_ids import PieceIds

BLOCK = 1024
# Usual context limits, and shares of all documents whose length is of interest.
CONTEXTS = tuple(1 << k for k in range(9, 18))
SHARES = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 0.999)


def lengths(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``n_tokens`` of each row; null and empty texts have none (0)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PieceIds.of_worker(tokenizer)
        for batch in batches:
            counts = [len(pieces.ids(t)) for t in batch.column(0).to_pylist()]
            yield pa.record_batch([pa.array(counts, pa.int64())], ["n_tokens"])

    return only(docs, text=text_col).mapInArrow(count, "n_tokens long")


def histogram(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``n_tokens, n_docs``: each encoded length and how many rows have it. Rows that repeat count each time.

    The rows are a table in the shared folder, so what reads them does not encode the corpus again.
    """
    counts = lengths(docs, text_col, tokenizer).groupBy("n_tokens").agg(F.count("*").alias("n_docs"))
    return Scratch(docs.sparkSession, "token-counts").keep("histogram", counts)


def limits(counts: DataFrame, also: Sequence[int] = ()) -> DataFrame:
    """For each length of a :func:`histogram` and the limits ``also``, what it leaves as a context limit.

    Columns: ``n_tokens, n_docs`` (0 for a limit that no document has as its length), ``docs_up_to, tokens_up_to`` (this
    length included), ``docs_longer, tokens_longer``, ``kept_tokens`` (total with every document cut to ``n_tokens``) and
    ``cut_tokens``. A length that occurs and is in ``also`` too has one row. An empty histogram gives a row of zeros for
    each limit in ``also`` and no others.
    """
    if also:
        more = counts.sparkSession.createDataFrame([(n, 0) for n in also], "n_tokens long, n_docs long")
        counts = counts.unionByName(more).groupBy("n_tokens").agg(F.sum("n_docs").alias("n_docs"))
    block = F.floor(F.col("n_tokens") / BLOCK)
    sized = counts.select("n_tokens", "n_docs", (F.col("n_tokens") * F.col("n_docs")).alias("tokens"),
                          block.alias("block"))
    blocks = sized.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block of lengths
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block", *(F.coalesce(F.sum(f"b_{c}").over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("docs", "tokens")),
        *(F.sum(f"b_{c}").over(whole).alias(f"{c}_all") for c in ("docs", "tokens")))
    within = Window.partitionBy("block").orderBy("n_tokens")
    up_to = lambda c, before: F.col(before) + F.sum(c).over(within)
    out = sized.join(blocks, "block").select(
        "n_tokens", "n_docs", up_to("n_docs", "docs_before").alias("docs_up_to"),
        up_to("tokens", "tokens_before").alias("tokens_up_to"), "docs_all", "tokens_all")
    longer = F.col("docs_all") - F.col("docs_up_to")
    kept = F.col("tokens_up_to") + F.col("n_tokens") * longer
    return out.select("n_tokens", "n_docs", "docs_up_to", "tokens_up_to", longer.alias("docs_longer"),
                      (F.col("tokens_all") - F.col("tokens_up_to")).alias("tokens_longer"), kept.alias("kept_tokens"),
                      (F.col("tokens_all") - kept).alias("cut_tokens"))


def quantile(table: DataFrame, share: float) -> Column:
    """Aggregate over :func:`limits`: the least length that at least ``share`` of all documents do not exceed."""
    total = F.col("docs_up_to") + F.col("docs_longer")
    return F.min(F.when(F.col("docs_up_to") >= F.lit(share) * total, F.col("n_tokens")))


def with_quantiles(table: DataFrame, shares: Sequence[float] = SHARES) -> DataFrame:
    """:func:`limits` with ``quantiles``: the ``shares`` of which the length is the quantile; empty for most lengths."""
    total = F.col("docs_up_to") + F.col("docs_longer")
    before = F.col("docs_up_to") - F.col("n_docs")
    least = [F.when((F.col("docs_up_to") >= F.lit(q) * total) & (before < F.lit(q) * total), F.lit(q)) for q in shares]
    return table.withColumn("quantiles", F.array_compact(F.array(*least)))


def truncated_total(counts: DataFrame, limit: int) -> DataFrame:
    """One row ``tokens``: the corpus total with every document cut to ``limit``, from the histogram alone."""
    return counts.agg(F.coalesce(F.sum(F.least("n_tokens", F.lit(limit)) * F.col("n_docs")), F.lit(0)).alias("tokens"))
