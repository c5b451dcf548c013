"""Token counts for every context limit from one exact histogram of encoded lengths."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_map, pieces
from tidemark.llm.token_ids import encoder, vocabulary_path

BLOCK = 1024


def token_lengths(docs: DataFrame, vocabulary: str | None = None, extra: int = 0, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Encoded length of every document, plus ``extra`` ids each. Null texts are empty."""
    path = vocabulary or vocabulary_path()

    def run(batches):
        encode = encoder(path).encode
        for batch in pieces(batches, text_column):
            yield {id_column: batch.column(0), "n_tokens": [len(x) + extra for x in encode(batch.column(1).to_pylist())]}

    return arrow_map(docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")), run, f"{id_column} long, n_tokens long")


def length_histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """Documents per exact length; null lengths are left out."""
    return lengths.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))


def suffix_table(histogram: DataFrame, block: int = BLOCK) -> DataFrame:
    """For each length L that occurs, what documents of at least L tokens add up to, and all totals at context limit L.

    ``docs_from`` and ``tokens_from`` are the suffix sums; ``truncated_tokens`` is the total when every document is cut
    to L tokens, ``docs_within`` and ``tokens_within`` the documents that fit whole. The sums run inside blocks of
    lengths, and over one row per block, so that no task orders the whole histogram.
    """
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / block)).withColumn("tokens", F.col("n_tokens") * F.col("n_docs"))
    sums = rows.groupBy("block").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
    after = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("long")
    sums = sums.select(
        "block", F.coalesce(F.sum("d").over(after), zero).alias("d_after"), F.coalesce(F.sum("t").over(after), zero).alias("t_after"),
        F.sum("d").over(everything).alias("d_all"), F.sum("t").over(everything).alias("t_all"),
    )
    inside = Window.partitionBy("block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    docs_from = F.sum("n_docs").over(inside) + F.col("d_after")
    tokens_from = F.sum("tokens").over(inside) + F.col("t_after")
    table = rows.join(sums, "block").select(
        "n_tokens", "n_docs", docs_from.alias("docs_from"), tokens_from.alias("tokens_from"), "d_all", "t_all",
    )
    return table.select(
        "n_tokens", "n_docs", "docs_from", "tokens_from",
        (F.col("t_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_tokens"),
        (F.col("d_all") - F.col("docs_from") + F.col("n_docs")).alias("docs_within"),
        (F.col("t_all") - F.col("tokens_from") + F.col("n_tokens") * F.col("n_docs")).alias("tokens_within"),
        F.col("d_all").alias("docs_total"), F.col("t_all").alias("tokens_total"),
    )


def truncated_totals(suffixes: DataFrame, limits: list[int]) -> DataFrame:
    """Total tokens when documents are cut to each given limit, whether or not a document has that length."""
    at = F.explode(F.array(*[F.lit(x).cast("long") for x in limits])).alias("context_limit")
    rows = suffixes.select("*", at)
    kept = F.least("n_tokens", "context_limit") * F.col("n_docs")
    return rows.groupBy("context_limit").agg(
        F.sum(kept).alias("truncated_tokens"), F.sum(F.when(F.col("n_tokens") > F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut")
    )


def length_quantiles(suffixes: DataFrame, probabilities: list[float]) -> DataFrame:
    """The smallest length that at least the given share of documents does not exceed."""
    at = F.explode(F.array(*[F.lit(float(p)) for p in probabilities])).alias("probability")
    rows = suffixes.select("n_tokens", "docs_within", "docs_total", at)
    return rows.where(F.col("docs_within") >= F.ceil(F.col("probability") * F.col("docs_total"))).groupBy("probability").agg(
        F.min("n_tokens").alias("n_tokens")
    )
