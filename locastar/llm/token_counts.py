"""Token counts from an exact length histogram (operator 7)."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from locastar.llm.common import texts_of, written
from locastar.llm.tokens import rest, word_encoder

#: Lengths in one block of the running sums.
BLOCK = 1024


def lengths(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens) of every row; a null or empty text has 0 tokens."""

    def run(batches):
        coder = word_encoder(path)
        for batch in batches:
            n = [len(coder.encode(t)) // 4 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64())], ["doc_id", "n_tokens"])
        rest(coder.words, coder.pieces)

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """(n_tokens, n_docs): exact, summed in each task before the shuffle."""
    return counted.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """One row for each length L that occurs, as a context limit:

    n_docs of that length; docs_longer and tokens_longer of the texts beyond
    L; docs_total, tokens_total; truncated_total = sum of min(length, L);
    quantile = share of the documents of at most L tokens. An empty
    histogram gives no rows. Sums run inside blocks of lengths and over the
    blocks' totals, so that no task gets the whole histogram.
    """
    h = written(hist, "histogram").withColumn("block", F.floor(F.col("n_tokens") / BLOCK).cast("long")) \
            .withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    above = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt")) \
        .select("block", F.coalesce(F.sum("bd").over(above), F.lit(0)).alias("above_docs"),
                F.coalesce(F.sum("bt").over(above), F.lit(0)).alias("above_tokens"),
                F.sum("bd").over(every).alias("docs_total"), F.sum("bt").over(every).alias("tokens_total"))
    later = Window.partitionBy("block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    longer = lambda c, base: (F.coalesce(F.sum(c).over(later), F.lit(0)) + F.col(base))
    out = h.join(blocks, "block").select(
        "n_tokens", "n_docs", longer("n_docs", "above_docs").alias("docs_longer"),
        longer("tokens", "above_tokens").alias("tokens_longer"), "docs_total", "tokens_total")
    return out.select(
        "n_tokens", "n_docs", "docs_longer", "tokens_longer", "docs_total", "tokens_total",
        (F.col("tokens_total") - F.col("tokens_longer") + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_total"),
        ((F.col("docs_total") - F.col("docs_longer")) / F.col("docs_total")).alias("quantile"))


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, tokens_kept, docs_cut) for any limits, from the histogram alone."""
    each = hist.withColumn("context_limit", F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])))
    return each.groupBy("context_limit").agg(
        F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("tokens_kept"),
        F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"))
