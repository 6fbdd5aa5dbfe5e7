"""Readers for line-oriented input.

Parsing works on a frame of lines (one string column, ``line``), so it serves files, tables and
streams of text alike; :func:`read_lines` is the only function that touches storage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.functions.text import (
    has_controls,
    hex_to_long,
    to_double,
    to_integer,
    trim_blanks,
)
from clickfeat.roles import CATEGORICAL, KindGuesser, Roles, guess_kind

HEADER_PREFIX = "Id"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def generated_range(spark: SparkSession, count: int = 100, slices: int = 10) -> DataFrame:
    """The integers from 0 to ``count - 1``."""
    return spark.range(0, count, 1, slices).select(F.col("id").alias("value"))


def header_of(lines: DataFrame) -> list[str]:
    """The column names of the first header line. Pass the header explicitly to save this job."""
    first = lines.filter(F.col("line").startswith(HEADER_PREFIX)).first()
    if first is None:
        raise ValueError(f"no header line (starting {HEADER_PREFIX!r}) in the input")
    return first["line"].rstrip(",").split(",")


def without_headers(lines: DataFrame) -> DataFrame:
    """Every part file may repeat the header; all of them go."""
    return lines.filter(~F.col("line").startswith(HEADER_PREFIX))


def _cells(lines: DataFrame, width: int, trim: bool = False) -> DataFrame:
    """Split each line once, then one text column per field; absent fields are blank."""
    controls = [has_controls(F.col("line")).alias("controls")] if trim else []
    split = lines.select(F.split("line", ",", -1).alias("f"), *controls)

    def cell(i):
        text = F.coalesce(F.get("f", F.lit(i)), F.lit(""))
        return (trim_blanks(text, F.col("controls")) if trim else text).alias(f"_{i}")

    return split.select(*[cell(i) for i in range(width)])


def parse_typed(
    lines: DataFrame, header: Sequence[str] | None = None, guess: KindGuesser = guess_kind
) -> tuple[DataFrame, Roles]:
    """Trimmed fields; categorical columns are base-16 longs, the others doubles."""
    header = list(header or header_of(lines))
    cells = _cells(without_headers(lines), len(header), trim=True)

    def typed(i, name):
        text = F.col(f"_{i}")
        parsed = hex_to_long(text) if guess(i, name) == CATEGORICAL else to_double(text)
        return parsed.alias(name)

    typed_cells = cells.select(*[typed(i, name) for i, name in enumerate(header)])
    return typed_cells, Roles.from_header(header, guess)


def parse_nullable_integers(
    lines: DataFrame, header: Sequence[str] | None = None, integer: str = "int"
) -> tuple[DataFrame, Roles]:
    """Untrimmed fields; names starting with ``C`` are base-16 longs, the others decimal integers.

    Unlike :func:`parse_typed` the first column is decimal. ``integer`` is ``int`` or ``bigint``.
    """
    header = list(header or header_of(lines))
    cells = _cells(without_headers(lines), len(header))

    def typed(i, name):
        text = F.col(f"_{i}")
        return (hex_to_long(text) if name.startswith("C") else to_integer(text, integer)).alias(name)

    typed_cells = cells.select(*[typed(i, name) for i, name in enumerate(header)])
    return typed_cells, Roles.from_header(header)


def _required(text: Column) -> Column:
    """A number that may not be blank."""
    return F.when(text == "", F.raise_error(F.lit("blank where a number is required"))).otherwise(
        to_double(text)
    )


def parse_numbers(lines: DataFrame, names: Sequence[str], missing: str = "null") -> DataFrame:
    """Headerless all-double lines where the text ``null`` is missing."""
    cells = _cells(lines, len(names))
    return cells.select(
        *[
            F.when(F.col(f"_{i}") != missing, _required(F.col(f"_{i}"))).alias(name)
            for i, name in enumerate(names)
        ]
    )


def parse_labelled_dense(lines: DataFrame) -> DataFrame:
    """Headerless lines: the label, then the features. Gives ``label`` and ``features``."""
    numbers = F.transform(F.split(F.rtrim(F.col("line"), F.lit(",")), ",", -1), _required)
    return lines.select(numbers.alias("n")).select(
        F.get("n", F.lit(0)).alias("label"),
        F.slice("n", F.lit(2), F.greatest(F.size("n") - 1, F.lit(0))).alias("features"),
    )
