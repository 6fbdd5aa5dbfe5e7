"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Each source has a token target. Document rates stay as near to one as the targets allow, in relative
entropy, and at most ``copies``: they are ``min(copies, exp(tilt * size))`` with one dual variable
``tilt`` per source, where the rates' tokens equal the target. The dual is convex and is solved by
Newton steps for all sources at once, on the histogram of sizes: documents of one source and size
have one rate, so an iteration reads a row per source and size, however many documents there are.
Steps that leave the bracket of the solution are replaced by bisection.

Rates are rounded into copies along the sizes of a source, longest first, so that the words left
over never exceed a document; what is still left is settled with the shortest documents. Which of
the equal documents get the odd copy is decided by a hash of their ids, so reruns agree.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickfeat.llm.common import WORD, keep, partitions, query, table
from clickfeat.operators.ordering import number_rows, store_in_order

WEIGHTS = (1, 2, 3)
COPIES = 3
#: Newton stops when every source's tokens are within this share of its target.
TOLERANCE = 1e-9
#: From this step on every other one halves the interval, so that each source settles in the end.
HALVING_FROM = 50


def word_count(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES):
    """``sizes`` (``_source, _size``) with ``weight`` and ``target``.

    Sources in code point order, null last, take the weights in turn and share all words in
    proportion. A target stops at ``copies`` times its source; the excess is shared again by weight
    until none is above. One row per source; each round is one aggregate over them.
    """
    # Flag first, so that the null source sorts last; an empty name is not a null.
    keyed = sizes.withColumn("_null", F.col("_source").isNull().cast("int"))
    order = ["_null", "_source"]
    ranked = number_rows(store_in_order(keyed, order, "sources"), order, "_rank")
    place = F.pmod("_rank", F.lit(len(weights))) + 1
    weighted = keep(
        ranked.select(
            "_source",
            "_size",
            F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place.cast("int")).alias("weight"),
        ),
        "weighted-sources",
    )
    most = copies * F.col("_size")
    level, total = 0.0, weighted.agg(F.sum("_size")).first()[0] or 0
    while True:  # the level rises in every round but the last
        full = most <= level * F.col("weight")
        used, share = weighted.agg(
            F.sum(F.when(full, most).otherwise(0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0))
        ).first()
        new = (total - (used or 0)) / share if share else level
        if new <= level:
            break
        level = new
    return weighted.withColumn("target", F.least(most.cast("double"), F.lit(level) * F.col("weight")))


def solve_tilts(histogram: DataFrame, targets: DataFrame, copies: int = COPIES) -> DataFrame:
    """``_source, _tilt``: the dual variables, rounded so that the order of sums can't show.

    ``histogram`` has ``_source, _words, _n`` (words above 0), ``targets`` ``_source, target``. Sizes are
    taken relative to the source's mean. Newton works on the logarithm of the tokens.
    """
    top = math.log(copies)
    size = F.col("_words").cast("double")
    stats = histogram.groupBy("_source").agg(
        (F.sum(size * F.col("_n")) / F.sum("_n")).alias("_mean"),
        F.sum(size * F.col("_n")).alias("_sum"),
        F.min(size).alias("_least"),
    )
    # At the upper end all rates are at the limit; at the lower end even the shortest are too few.
    state = keep(
        targets.select("_source", "target")
        .join(stats, "_source")
        .select(
            "_source",
            "target",
            "_mean",
            F.lit(0.0).alias("_tilt"),
            F.least(
                F.lit(0.0),
                F.log(F.col("target") / F.col("_sum")) * F.col("_mean") / F.col("_least"),
            ).alias("_low"),
            (F.lit(top) * F.col("_mean") / F.col("_least")).alias("_high"),
        ),
        "tilts",
    )
    for step in count():
        z = size / F.col("_mean")
        # Beyond these bounds the exponential is 0 or cut to the limit anyway.
        x = F.least(F.lit(top), F.greatest(F.lit(-700.0), F.col("_tilt") * z))
        tokens = F.col("_n") * size * F.exp(x)
        slope = F.when(F.col("_tilt") * z < top, tokens * z).otherwise(0.0)
        sums = (
            histogram.join(state, "_source")
            .groupBy("_source")
            .agg(
                F.sum(tokens).alias("_got"),
                F.sum(slope).alias("_slope"),
                *[F.first(c).alias(c) for c in ("target", "_mean", "_tilt", "_low", "_high")],
            )
        )
        over = F.col("_got") > F.col("target")
        low = F.when(over, F.col("_low")).otherwise(F.col("_tilt"))
        high = F.when(over, F.col("_tilt")).otherwise(F.col("_high"))
        gap = F.log(F.greatest(F.col("_got"), F.lit(1e-300)) / F.col("target"))
        newton = F.col("_tilt") - F.try_divide(gap * F.col("_got"), "_slope")
        inside = (F.col("_slope") > 0) & (newton > low) & (newton < high)
        if step >= HALVING_FROM and step % 2:
            inside = F.lit(False)
        off = F.abs(F.col("_got") - F.col("target")) / F.col("target")
        # At the limit there is nothing to gain; below the last digit kept there is nothing to solve.
        width = F.greatest(F.lit(1.0), F.abs(low), F.abs(high))
        done = (off <= TOLERANCE) | (high - low <= 1e-12 * width)
        state = keep(
            sums.select(
                "_source",
                "target",
                "_mean",
                F.when(done, F.col("_tilt"))
                .when(inside, newton)
                .otherwise((low + high) / 2)
                .alias("_tilt"),
                low.alias("_low"),
                high.alias("_high"),
                done.alias("_done"),
            ),
            "tilts",
        )
        if state.filter(~F.col("_done")).isEmpty():
            break
    return state.select("_source", "_mean", F.round("_tilt", 9).alias("_tilt"))


def copies_by_size(histogram: DataFrame, tilts: DataFrame, targets: DataFrame, copies: int):
    """Copies for each source and size: ``_source, _words, _n, _rate, _copies``.

    The windows run over the sizes of one source, not its documents.
    """
    exponent = F.col("_tilt") * F.col("_words") / F.col("_mean")
    rate = F.exp(F.least(F.lit(math.log(copies)), exponent))
    rated = histogram.join(tilts, "_source").join(targets.select("_source", "target"), "_source")
    rated = rated.withColumn("_rate", F.round(rate, 9))
    down = Window.partitionBy("_source").orderBy(F.col("_words").desc())
    running = down.rowsBetween(Window.unboundedPreceding, 0)
    mass = F.col("_rate") * F.col("_n")
    upto = F.floor(F.sum(mass).over(running) + 0.5)
    rounded = rated.withColumn("_upto", upto).withColumn(
        "_c", F.col("_upto") - F.coalesce(F.lag("_upto").over(down), F.lit(0))
    )
    rounded = rounded.withColumn("_c", F.least("_c", copies * F.col("_n")))
    whole = Window.partitionBy("_source")
    left = F.round(F.col("target")) - F.sum(F.col("_c") * F.col("_words")).over(whole)
    # Shortest first: add copies where words are missing, take some back where there are too many.
    room = F.when(F.col("_left") > 0, copies * F.col("_n") - F.col("_c")).otherwise(F.col("_c"))
    up = (
        Window.partitionBy("_source")
        .orderBy("_words")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum(F.col("_room") * F.col("_words")).over(up), F.lit(0))
    fit = F.floor((F.abs("_left") - F.col("_before")) / F.col("_words"))
    change = F.greatest(F.lit(0), F.least(F.col("_room"), fit)) * F.signum("_left")
    settled = (
        rounded.withColumn("_left", left)
        .withColumn("_room", room)
        .withColumn("_before", before)
        .withColumn("_copies", (F.col("_c") + change).cast("bigint"))
    )
    return settled.select("_source", "_words", "_n", "_rate", "_copies")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    copies: int = COPIES,
    carry: bool = False,
) -> DataFrame:
    """One row per input row: ``doc_id, size, source_size, target, copies, rate, taken``.

    ``size`` is in words, null text has 0; documents without words get no copy. A null source is a source
    of its own. No document gets more than ``copies``. Repeated rows are documents of their own, and of
    documents with equal size and id any may get the odd copy. ``carry`` adds the input row as the struct
    ``row``. Empty tables give no rows. The texts are read once here and not moved: shuffles carry id,
    source and size (with ``carry`` the row).
    """
    spark = docs.sparkSession
    slots = max(64, partitions(spark))
    named = F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(
        F.concat(F.lit("s"), F.col(source_col).cast("string"))
    )
    rows = keep(
        docs.select(
            F.col(id_col).alias("_id"),
            named.alias("_source"),
            word_count(F.col(text_col)).alias("_words"),
            F.xxhash64(F.col(id_col)).alias("_hash"),
            *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []),
        ),
        "sized",
    )
    slot = F.pmod("_hash", F.lit(slots)).alias("_slot")
    cells = keep(
        rows.groupBy("_source", "_words", slot).agg(F.count("*").alias("_in_slot")), "size-cells"
    )
    histogram = cells.groupBy("_source", "_words").agg(F.sum("_in_slot").alias("_n"))
    histogram = keep(histogram, "size-histogram")
    sizes = histogram.groupBy("_source").agg(F.sum(F.col("_words") * F.col("_n")).alias("_size"))
    real_name = F.when(F.col("_source") != "n", F.expr("substring(_source, 2)"))
    targets = source_targets(sizes.withColumn("_source", real_name), weights, copies)
    targets = keep(
        targets.withColumn(
            "_source", F.when(F.col("_source").isNull(), "n").otherwise(F.concat(F.lit("s"), "_source"))
        ),
        "targets",
    )
    some = histogram.filter("_words > 0")
    asked = targets.filter("target > 0")
    settled = copies_by_size(some, solve_tilts(some, asked, copies), asked, copies)
    # Each slot of equal documents gets its share of the copies, its documents then get theirs.
    along = (
        Window.partitionBy("_source", "_words")
        .orderBy("_slot")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    share = F.floor(F.col("_copies") * F.col("_upto") / F.col("_n"))
    before = F.floor(F.col("_copies") * (F.col("_upto") - F.col("_in_slot")) / F.col("_n"))
    per_slot = (
        cells.join(settled, ["_source", "_words"], "left")
        .withColumn("_upto", F.sum("_in_slot").over(along))
        .withColumn("_slot_copies", F.coalesce(share - before, F.lit(0)))
        .join(targets, "_source")
        .select(
            "_source", "_words", "_slot", "_in_slot", "_slot_copies", "_rate", "target",
            F.col("_size").alias("source_size"),
        )
    )
    keys = ["_source", "_words", "_slot"]
    joined = rows.withColumn("_slot", F.pmod("_hash", F.lit(slots))).join(per_slot, keys)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("_hash", "_id"))
    base = F.floor(F.col("_slot_copies") / F.col("_in_slot"))
    odd = F.col("_slot_copies") - base * F.col("_in_slot")
    got = (base + F.when(rank <= odd, 1).otherwise(0)).cast("bigint")
    return joined.select(
        F.col("_id").alias("doc_id"),
        F.col("_words").alias("size"),
        F.col("source_size").cast("bigint").alias("source_size"),
        "target",
        got.alias("copies"),
        F.coalesce("_rate", F.lit(0.0)).alias("rate"),
        (got * F.col("_words")).alias("taken"),
        *(["row"] if carry else []),
    )


def mixed(docs: DataFrame, weights: Sequence[float] = WEIGHTS, copies: int = COPIES) -> DataFrame:
    """The mix itself: every document as often as it is taken, with the columns of ``docs``."""
    taken = mix(docs, weights=weights, copies=copies, carry=True).filter("copies > 0")
    repeated = taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


@query()
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
