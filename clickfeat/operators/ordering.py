"""Running totals over a whole table without a one-task window.

The table is range-partitioned and written in order with the number of the partition each row went
to. Totals per partition are few (bounded by the shuffle partition count), their running sum gives
each partition its start, and the window then runs inside partitions in parallel.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from clickfeat.workspace import small_table, store

BUCKET = "bucket"


def store_in_order(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str,
    buckets: int | None = None,
    path: str | None = None,
    by: str | None = None,
) -> DataFrame:
    """Write ``df`` range-partitioned by ``order``, with its ``bucket`` number.

    The order must be unique per row. Without ``buckets``, adaptive execution sizes them.
    """
    ranged = df.repartitionByRange(*([buckets] if buckets else []), *order)
    ordered = ranged.withColumn(BUCKET, F.spark_partition_id()).sortWithinPartitions(
        *([by] if by else []), *order
    )
    return store(ordered, name, path, by)


def bucket_totals(
    stored: DataFrame, measures: dict[str, Column], within: Sequence[str] = ()
) -> list[Row]:
    """The sum of every measure per bucket (and leading order values), in order.

    At most one row per bucket plus one per combination of leading values.
    """
    keys = [BUCKET, *within]
    sums = [F.coalesce(F.sum(m), F.lit(0)).cast("bigint").alias(n) for n, m in measures.items()]
    rows = stored.groupBy(*keys).agg(*sums).collect()
    return sorted(rows, key=lambda row: tuple(row[k] for k in keys))


def running_totals(
    stored: DataFrame,
    order: Sequence[Column | str],
    measures: dict[str, Column],
    within: Sequence[str] = (),
    restart: bool = False,
    totals: Sequence[Row] | None = None,
) -> DataFrame:
    """Add the inclusive running total of every measure, in the stored order.

    ``within`` names leading order columns that also split the windows, so that a filter on them
    reaches the scan; ``restart`` starts the totals anew for each of their values. ``totals``
    passes the :func:`bucket_totals` where they are known.
    """
    keys = [BUCKET, *within]
    if totals is None:
        totals = bucket_totals(stored, measures, within)
    starts, so_far = [], {}
    for row in totals:
        group = tuple(row[k] for k in within) if restart else ()
        before = so_far.get(group, (0,) * len(measures))
        starts.append((*[row[k] for k in keys], *before))
        so_far[group] = tuple(b + row[m] for b, m in zip(before, measures))

    kinds = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}
    start_of = {m: f"_start_{m}" for m in measures}
    start_table = small_table(
        stored.sparkSession,
        [*keys, *start_of.values()],
        [kinds[stored.schema[k].dataType.simpleString()] for k in keys]
        + [pa.int64()] * len(measures),
        starts,
    )
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    with_start = stored.join(F.broadcast(start_table), keys)
    return with_start.withColumns(
        {m: F.col(start_of[m]) + F.sum(v).over(window) for m, v in measures.items()}
    ).drop(*start_of.values())


def number_rows(stored: DataFrame, order: Sequence[Column | str], name: str, **kw) -> DataFrame:
    """Number the rows of a stored table from 0 in its order."""
    numbered = running_totals(stored, order, {name: F.lit(1)}, **kw)
    return numbered.withColumn(name, F.col(name) - 1)


FILE, POSITION = "file", "position"


def file_positions(df: DataFrame, name: str | None = None) -> DataFrame:
    """Rows read from files, with the file's name and the row's position in it, from 0.

    ``name`` adds the row's number over all files, in the order of their paths. Nothing is sorted or shuffled
    and no order key is needed: one pass counts the rows of each block of a file, and a block's start is
    broadcast (a row for each block that a task reads at once). The position does not depend on how files
    are cut into blocks. Where the second pass cuts them otherwise than the first, it fails rather than give wrong numbers.

    ``df`` must come straight from a reader, before any filter, with columns of its choice.
    """
    placed = df.select(
        *[F.col(f"`{c}`") for c in df.columns],
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__id"),
    )
    counts = (
        placed.groupBy("__path", "__block").agg(F.count(F.lit(1)).alias("n"), F.min("__id").alias("first")).collect()
    )
    starts, so_far, path, in_file = [], 0, None, 0
    for row in sorted(counts, key=lambda r: (r["__path"], r["__block"])):
        path, in_file = row["__path"], in_file if row["__path"] == path else 0
        starts.append((*row, in_file, so_far))
        in_file, so_far = in_file + row["n"], so_far + row["n"]
    names = ["__path", "__block", "__n", "__first", "__in_file", "__so_far"]
    kinds = [pa.string(), *[pa.int64()] * 5]
    table = small_table(df.sparkSession, names, kinds, starts)
    found = placed.join(F.broadcast(table), ["__path", "__block"], "left")
    within = F.col("__id") - F.col("__first")
    cut_otherwise = F.raise_error(F.lit("files were cut into other blocks than when they were counted"))
    within = F.when((within >= 0) & (within < F.col("__n")), within).otherwise(cut_otherwise)
    added = {FILE: F.regexp_extract("__path", "[^/]*$", 0), POSITION: F.col("__in_file") + within}
    if name is not None:
        added[name] = F.col("__so_far") + within
    return found.withColumns(added).drop(*names, "__id")
