"""Training text: CSV, Vowpal Wabbit and sparse ``index:value`` lines.

Each formatter gives one string column, so a line is built by expressions inside the scan stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickfeat.functions.numeric import recode_label
from clickfeat.functions.text import cell_text, long_to_hex
from clickfeat.roles import Roles


def csv_line(columns: Sequence[str], missing: str = "null") -> Column:
    """Comma-joined cells, no quoting; missing cells print as ``null``."""
    return F.concat_ws(",", *[cell_text(F.col(c), missing) for c in columns])


def rate_line(position: Column, value: Column, rate: Column) -> Column:
    """One line of an encoding table: column position, level, rate."""
    return F.concat_ws(",", position.cast("string"), value.cast("string"), rate.cast("string"))


def vw_line(roles: Roles) -> Column:
    """``<1.0|-1.0> '<hex id> |Num name:value ... |Cats _value ...``; missing cells are left out.

    Category features carry no column name, so equal values of two columns are one feature.
    """
    label = recode_label(F.col(roles.label), F.col(roles.label) > 0, "1.0", "-1.0")
    # A missing id prints as the id -1.
    tag = long_to_hex(F.coalesce(F.col(roles.id).cast("bigint"), F.lit(-1)))
    numbers = [F.concat(F.lit(f"{c}:"), F.col(c).cast("string")) for c in roles.numeric]
    levels = [F.concat(F.lit("_"), F.col(c).cast("string")) for c in roles.categorical]
    return F.concat(
        label,
        F.lit(" '"),
        tag,
        F.lit(" |Num "),
        F.concat_ws(" ", *numbers),
        F.lit(" |Cats "),
        F.concat_ws(" ", *levels),
    )


def sparse_line(label: Column, entries: Column) -> Column:
    """``<1|-1> | slot:value slot:value`` in ascending slot order."""
    # The text of the array is [{slot, value}, {slot, value}]; a lambda per entry costs twice as much.
    text = F.sort_array(entries).cast("string")
    pairs = F.replace(F.replace(text, F.lit("}, {"), F.lit(" ")), F.lit(", "), F.lit(":"))
    sign = recode_label(label, label > 0, "1", "-1")
    return F.concat(sign, F.lit(" | "), F.btrim(pairs, F.lit("[{}]")))


def write_lines(df: DataFrame, line: Column, path: str, files: int | None = None) -> None:
    """Write one text line per row. ``files`` asks for a fixed file count; default is parallel."""
    lines = df.select(line.alias("value"))
    (lines if files is None else lines.repartition(files)).write.text(path)


def write_parts(
    df: DataFrame, line: Column, part: Column, paths: Sequence[str], files: int | None = None,
    lines_per_file: int = 0,
) -> None:
    """Write the rows of part ``i`` to ``paths[i]``, all parts in one job that plans the input once.

    The job writes a folder for each part beside the first path; these are moved into place once all are whole.
    ``files`` asks for at most so many files a part, ``lines_per_file`` bounds a file's lines. Paths must be
    new and on one file system.
    """
    spark = df.sparkSession
    path_of, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    targets = [path_of(p) for p in paths]
    system = targets[0].getFileSystem(conf)
    taken = [p for p, target in zip(paths, targets) if system.exists(target)]
    if taken:
        raise FileExistsError(f"there already: {taken}")
    staging = f"{paths[0].rstrip('/')}.parts-{uuid.uuid4().hex}"
    lines = df.select(part.cast("int").alias("part"), line.alias("value"))
    lines = lines if files is None else lines.repartition(files)
    writer = lines.write.partitionBy("part")
    if lines_per_file:
        writer = writer.option("maxRecordsPerFile", lines_per_file)
    writer.text(staging)
    try:
        for i, target in enumerate(targets):
            made = path_of(f"{staging}/part={i}")
            if target.getParent() is not None:
                system.mkdirs(target.getParent())
            if not (system.rename(made, target) if system.exists(made) else system.mkdirs(target)):
                raise OSError(f"can't move part {i} to {paths[i]}")
            system.create(path_of(paths[i], "_SUCCESS"), True).close()
    finally:
        system.delete(path_of(staging), True)
