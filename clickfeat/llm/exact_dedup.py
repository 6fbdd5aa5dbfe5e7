"""Exact dedup by content sort.

Normalised texts are range-partitioned by sampled splitters, sorted externally, and neighbours are
compared in full (a window over the sorted text compares each row's whole text with the one before).
DataFrame functions only. The order is by leading characters, then a hash, then the whole text: so
equal texts are neighbours, a common opening is split by the hash, and the splitters that the driver
gathers are short however long texts are.

A text whose copies fill more than half a partition is hot. Its rows are dealt to several ranges by
a hash of their id, and the few winners of the ranges are compared in full once more. Hot texts are
found by a hash of the text, which only decides how rows are dealt, never what is equal.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import ascii_lower, keep, partitions, query, table


#: Characters of a text in a splitter.
PREFIX = 32


def _hot_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """Hash and number of ranges of each hot text: at most four rows for each shuffle partition."""
    sizes = keep(
        docs.select(_hash(text_col).alias("_h"), _bytes(text_col).alias("_b"))
        .groupBy("_h")
        .agg(F.sum("_b").alias("_b"), F.count("*").alias("_n")),
        "text-sizes",
    )
    share = 2.0 * partitions(docs.sparkSession)
    total_b, total_n = sizes.agg(F.sum("_b"), F.sum("_n")).first()
    parts = F.greatest(
        F.col("_b") / max(1.0, (total_b or 0) / share), F.col("_n") / max(1.0, (total_n or 0) / share)
    )
    return sizes.filter(parts > 1).select("_h", F.ceil(parts).alias("_ranges"))


def _hash(text_col: str):
    return F.xxhash64(F.lower(F.coalesce(F.col(text_col), F.lit(""))))


def _bytes(text_col: str):
    return F.octet_length(F.coalesce(F.col(text_col), F.lit(""))) + 16


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    largest: bool = False,
    carry: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical after lower-casing A-Z. Null text counts as empty. Of a group the
    row with the smallest id stays (``largest``: the largest); a null id stays only if no other is
    there; of rows with equal text and equal id exactly one stays. ``carry`` adds the input row as
    the struct ``row``, so that columns of any name pass unchanged. Empty tables give no rows.
    """
    identity = F.col(id_col)
    rows = docs.select(
        identity.alias("_id"),
        ascii_lower(F.coalesce(F.col(text_col), F.lit(""))).alias("_norm"),
        _hash(text_col).alias("_h"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
    )
    hot = F.broadcast(_hot_texts(docs, text_col))
    dealt = rows.join(hot, "_h", "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64("_id"), F.col("_ranges")), F.lit(0))
    )
    ranged = dealt.withColumn("_start", F.substring("_norm", 1, PREFIX)).repartitionByRange(
        "_start", "_h", "_salt"
    )
    order = F.col("_id").desc_nulls_last() if largest else F.col("_id").asc_nulls_last()
    group = Window.partitionBy("_start", "_h", "_salt", "_norm").orderBy(order)
    whole = group.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    salted = F.col("_ranges").isNotNull()
    sorted_rows = ranged.select(
        "*",
        F.row_number().over(group).alias("_rank"),
        F.first("_id").over(whole).alias("_best"),
        F.count(F.lit(1)).over(whole).alias("_n"),
    )
    local = keep(
        sorted_rows.select(
            "_id",
            F.sha2("_norm", 256).alias("text_sha256"),
            "_rank",
            "_best",
            "_n",
            salted.alias("_salted"),
            F.when(salted & (F.col("_rank") == 1), F.col("_norm")).alias("_winner"),
            *(["row"] if carry else []),
        ),
        "content-sorted",
    )
    # One winner per range of a hot text: compared in full, a few for each shuffle partition.
    best = F.max if largest else F.min
    merged = (
        local.filter(F.col("_winner").isNotNull())
        .groupBy("_winner")
        .agg(
            best("_best").alias("_all_best"),
            F.sum("_n").alias("_all_n"),
            F.first("text_sha256").alias("text_sha256"),
        )
        .select(F.lit(True).alias("_salted"), "text_sha256", "_all_best", "_all_n")
    )
    final = local.join(F.broadcast(merged), ["_salted", "text_sha256"], "left")
    keep_id = F.when(F.col("_salted"), F.col("_all_best")).otherwise(F.col("_best"))
    size = F.when(F.col("_salted"), F.col("_all_n")).otherwise(F.col("_n"))
    return final.select(
        F.col("_id").alias("doc_id"),
        keep_id.alias("keep_id"),
        size.cast("bigint").alias("group_size"),
        ((F.col("_rank") == 1) & F.col("_best").eqNullSafe(keep_id)).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def drop_copies(docs: DataFrame, largest: bool = False) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    kept = exact_dedup(docs, largest=largest, carry=True).filter("kept")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


@query("""
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                           'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), largest=True)
