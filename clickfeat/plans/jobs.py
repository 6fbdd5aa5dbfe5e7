"""Whole jobs from files to files. Each function plans one Spark application's work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.functions.numeric import recode_label
from clickfeat.functions.text import cell_text
from clickfeat.models import logistic, sharded
from clickfeat.models.bayes import POOL_BELOW, NaiveBayes, scores_above
from clickfeat.models.evaluation import log_loss, precision_recall
from clickfeat.operators import assembling, encoding, scaling, splitting, summary
from clickfeat.operators.imputing import fill_column_mean, fill_values
from clickfeat.operators.levels import LevelTable, level_counts
from clickfeat.operators.ordering import file_positions
from clickfeat.plans.stages import EncodeTarget, FittedStages, Impute, Stages, default_stages
from clickfeat.sinks.text import csv_line, rate_line, sparse_line, vw_line, write_lines, write_parts
from clickfeat.sources.csv import (
    parse_labelled_dense,
    parse_nullable_integers,
    parse_numbers,
    parse_typed,
    read_lines,
    without_headers,
)
from clickfeat.workspace import store


def _typed(spark: SparkSession, source: str):
    """A typed CSV kept as parquet: for jobs that would otherwise parse the text many times."""
    df, roles = parse_typed(read_lines(spark, source))
    return store(df, "typed"), roles


def _nullable_integers(spark: SparkSession, source: str, **options):
    """The same for a nullable-integer CSV."""
    df, roles = parse_nullable_integers(read_lines(spark, source), **options)
    return store(df, "integers"), roles


def summarise_csv(spark: SparkSession, source: str, out: str | None = None) -> DataFrame:
    """Column summary of a typed CSV, saved as parquet if asked."""
    df, roles = parse_typed(read_lines(spark, source))
    table = summary.summarise(df, roles)
    if out:
        table.coalesce(1).write.parquet(out)  # one row per column
        return spark.read.parquet(out)
    return table


def count_levels(spark: SparkSession, source: str) -> DataFrame:
    """Distinct levels per categorical column of a nullable-integer CSV."""
    df, roles = parse_nullable_integers(read_lines(spark, source))
    return summary.level_cardinality(df, roles)


def csv_to_vw(
    spark: SparkSession, source: str, out: str, saved_summary: str | None = None,
    files: int | None = None,
) -> None:
    """Typed CSV to Vowpal Wabbit text with log min-max scaled numbers."""
    df, roles = parse_typed(read_lines(spark, source))
    if saved_summary:
        rows = spark.read.parquet(saved_summary).filter(F.col("col").isin(*roles.numeric)).collect()
        bounds = {r["col"]: (r["min"], r["max"]) for r in rows}
        missing = [c for c in roles.numeric if c not in bounds]
        if missing:
            raise ValueError(f"the saved summary has no statistics of {missing}")
    else:
        bounds = summary.bounds_of(df, roles.numeric)
    write_lines(scaling.scale_log_minmax(df, bounds), vw_line(roles), out, files)


def csv_to_sparse_text(
    spark: SparkSession, source: str, out_train: str, out_test: str, files: int | None = None,
    seed: int = 3334,
) -> int:
    """Default stages and sparse text of both parts of a split; gives the index size."""
    df, roles = _typed(spark, source)
    fitted = default_stages().fit(df, roles)
    assembled = assembling.assemble_sparse(fitted.transform(df), roles)
    line = sparse_line(F.col(roles.label), F.col(assembling.ENTRIES))
    part = splitting.part_of(F.col(roles.id), [0.75, 0.25], seed)
    write_parts(assembled, line, part, (out_train, out_test), files)
    return fitted.stages[-1].size


def fit_target_rates(spark: SparkSession, source: str, out: str, state: str) -> None:
    """Label mean of every level, as text and as saved state."""
    df, roles = parse_nullable_integers(read_lines(spark, source))
    fitted = Stages([EncodeTarget()]).fit(df, roles)
    _write_rates(fitted.stages[0].table, out)
    fitted.save(spark, state)


def _write_rates(rates: LevelTable, out: str) -> None:
    write_lines(rates.frame, rate_line(F.col("pos"), F.col("value"), F.col("rate")), out)


def apply_target_rates(spark: SparkSession, source: str, state: str, out: str) -> None:
    df, _ = parse_nullable_integers(read_lines(spark, source))
    encoded = FittedStages.load(spark, state).transform(df)
    write_lines(encoding.as_doubles(encoded), csv_line(df.columns), out)


def fill_means(spark: SparkSession, source: str, out: str) -> None:
    """Fill a headerless numeric CSV with column means. The longest line gives the columns."""
    lines = store(read_lines(spark, source), "lines")
    fields = F.size(F.split(F.rtrim("line", F.lit(",")), ",", -1))
    width = lines.agg(F.max(fields)).first()[0] or 0
    # Fields that a shorter line doesn't have are missing.
    padded = F.concat(F.rtrim("line", F.lit(",")), F.repeat(F.lit(",null"), F.lit(width) - fields))
    lines = lines.select(padded.alias("line"))
    df = parse_numbers(lines, [f"n{i}" for i in range(width)])
    write_lines(fill_column_mean(df), csv_line(df.columns), out)


def encode_and_fill(spark: SparkSession, source: str, out: str, rates_out: str) -> None:
    """Target encoding and column-mean fill in one job, to separate folders."""
    df, roles = _nullable_integers(spark, source)
    rates = encoding.fit_target_rates(df, roles)
    _write_rates(rates, rates_out)
    encoded = encoding.as_doubles(encoding.target_encode(df, roles, rates))
    numbers = [c for c in df.columns if c not in roles.categorical]
    means = {**summary.means_of(df, numbers), **encoding.rate_means(rates)}
    write_lines(fill_values(encoded, means), csv_line(df.columns), out)


def fit_imputer(spark: SparkSession, source: str, state: str) -> None:
    df, roles = _nullable_integers(spark, source, integer="bigint")
    Stages([Impute()]).fit(df, roles).save(spark, state)


def apply_imputer(spark: SparkSession, source: str, state: str, out: str) -> None:
    """Fill missing cells; present integers keep their text."""
    df, _ = parse_nullable_integers(read_lines(spark, source), integer="bigint")
    values = FittedStages.load(spark, state).stages[0].values
    cells = [
        F.coalesce(F.col(c).cast("string"), cell_text(F.lit(values.get(c)))) for c in df.columns
    ]
    write_lines(df, F.concat_ws(",", *cells), out)


def split_lines(
    spark: SparkSession, source: str, out_1: str, out_2: str, files: int | None = None,
    seed: int = 100,
) -> None:
    """Split a text file .85/.15 at random, line by line, without header lines."""
    lines = without_headers(file_positions(read_lines(spark, source)))
    write_parts(lines, F.col("line"), splitting.row_part([0.85, 0.15], seed), (out_1, out_2), files)


def _train(df: DataFrame, key: str, label: str, training, weights, seed):
    parts = splitting.split_hash(df, key, weights, seed)
    model = logistic.fit(parts[0], training, label=label)
    return model, parts


def train_and_score(spark: SparkSession, source: str) -> DataFrame:
    """Logistic regression on the first two numeric features; log loss of both parts."""
    df, roles = _typed(spark, source)
    columns = roles.numeric[:2]
    scaled = scaling.scale_minmax_filled(df, summary.bounds_of(df, columns))
    label = recode_label(F.col(roles.label), F.col(roles.label) > 0, 1.0, 0.0)
    rows = assembling.dense_features(scaled, columns).select(
        roles.id, label.alias("label"), logistic.dense_vector(F.col("features")).alias("features")
    )
    model, parts = _train(rows, roles.id, "label", logistic.SCALED, [0.8, 0.2], 1)
    losses = [
        logistic.score(part, model).agg(log_loss().alias("loss"), F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("part"), "rows", "loss")
        for name, part in zip(("train", "test"), parts)
    ]
    return losses[0].unionByName(losses[1])


def train_dictionary(
    spark: SparkSession, source: str, limit: int | None = None
) -> tuple[logistic.LogisticRegressionModel, DataFrame]:
    """Logistic regression on numbers and one-hot levels; precision and recall on the test part.

    ``limit`` leaves out columns of at least so many levels.
    """
    df, roles = _nullable_integers(spark, source)
    counts = LevelTable.keep(level_counts(df, roles, keep_missing=False))
    dictionary = counts.numbered(per_column=True)
    offsets = assembling.onehot_offsets(roles, dictionary.rows, limit)
    width = len(roles.numeric) + sum(dictionary.rows[c] for c in offsets)
    entries = assembling.assemble_onehot(df, roles, dictionary, limit)
    return _train_entries(entries, roles, width, logistic.NUMBERS)


def train_hashed(
    spark: SparkSession, source: str, bits: int = assembling.HASH_BITS
) -> tuple[sharded.ShardedModel, DataFrame]:
    """Logistic regression on hashed levels; precision and recall on the test part.

    The whole layout is trained: weights are a table of the slots that occur.
    """
    df, roles = _nullable_integers(spark, source)
    entries = assembling.hash_features(df, roles, bits=bits)
    label = recode_label(F.col(roles.label), F.col(roles.label) == 1, 1.0, 0.0)
    rows = entries.select(roles.id, label.alias("label"), assembling.ENTRIES)
    train, test = splitting.split_hash(rows, roles.id, [0.8, 0.2], 10)
    model = sharded.fit(train, logistic.HASHED, assembling.HASH_BASE + (1 << bits))
    return model, precision_recall(sharded.score(test, model), "p_class", "label")


def _train_entries(df, roles, width, training):
    label = recode_label(F.col(roles.label), F.col(roles.label) == 1, 1.0, 0.0)
    rows = df.select(
        roles.id,
        label.alias("label"),
        logistic.sparse_fields(F.col(assembling.ENTRIES), width).alias("features"),
    )
    rows = logistic.store_sparse(rows)
    model, (_, test) = _train(rows, roles.id, "label", training, [0.8, 0.2], 10)
    return model, precision_recall(logistic.score(test, model), "p_class", "label")


def train_indexed(spark: SparkSession, source: str, seed: int = 3334) -> DataFrame:
    """Logistic regression with L2 on the default stages' vectors; log loss of the test part."""
    df, roles = _typed(spark, source)
    fitted = default_stages().fit(df, roles)
    width = len(roles.numeric) + fitted.stages[-1].size
    entries = assembling.assemble_sparse(fitted.transform(df), roles)
    rows = entries.select(
        roles.id,
        recode_label(F.col(roles.label), F.col(roles.label) > 0, 1.0, 0.0).alias("label"),
        logistic.sparse_fields(F.col(assembling.ENTRIES), width).alias("features"),
    )
    rows = logistic.store_sparse(rows)
    model, (_, test) = _train(rows, roles.id, "label", logistic.INDEXED, [0.75, 0.25], seed)
    return logistic.score(test, model).agg(log_loss(eps=1e-5).alias("loss"))


def train_dense(spark: SparkSession, train: str, test: str) -> DataFrame:
    """Logistic regression on labelled dense files; log loss on the test file."""
    parts = [
        parse_labelled_dense(read_lines(spark, path)).withColumn(
            "features", logistic.dense_vector(F.col("features"))
        )
        for path in (train, test)
    ]
    model = logistic.fit(parts[0], logistic.DENSE)
    return logistic.score(parts[1], model).agg(log_loss(eps=1e-5).alias("loss"))


def naive_bayes_scores(
    spark: SparkSession, source: str, out: str, pool_below: int = POOL_BELOW,
    threshold: float = 0.01,
) -> None:
    """Naive Bayes scores above a threshold, with the ids they belong to."""
    df, roles = _typed(spark, source)
    model = NaiveBayes.fit(df, roles, pool_below)
    scored = scores_above(model.score(df), threshold)
    write_lines(scored, csv_line([roles.id, "p"]), out)


__all__ = [
    "apply_imputer",
    "apply_target_rates",
    "count_levels",
    "csv_to_sparse_text",
    "csv_to_vw",
    "encode_and_fill",
    "fill_means",
    "fit_imputer",
    "fit_target_rates",
    "naive_bayes_scores",
    "split_lines",
    "summarise_csv",
    "train_and_score",
    "train_dense",
    "train_dictionary",
    "train_hashed",
    "train_indexed",
]
