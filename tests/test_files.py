"""Rows by where they stand in their files, and all parts in one write."""

import pytest
from pyspark.sql import functions as F

from clickfeat.operators.ordering import file_positions
from clickfeat.operators.splitting import row_part
from clickfeat.sinks.text import write_parts
from clickfeat.sources.csv import read_lines, without_headers
from tests.conftest import rows_of


@pytest.fixture()
def lines(tmp_path):
    """Three files, one without lines, one line in two thirds of all places."""
    folder = tmp_path / "lines"
    folder.mkdir()
    texts = {
        f"f{k}.txt": ["same" if i % 3 else f"{k}-{i}" for i in range(n)]
        for k, n in enumerate((4000, 0, 2500))
    }
    for name, rows in texts.items():
        (folder / name).write_text("".join(r + "\n" for r in rows))
    return str(folder), texts


@pytest.fixture()
def small_blocks(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def _wanted(texts):
    number, want = 0, []
    for name, rows in sorted(texts.items()):
        for i, row in enumerate(rows):
            want.append((row, name, i, number))
            number += 1
    return sorted(want)


def test_positions_over_many_blocks(spark, lines, small_blocks):
    path, texts = lines
    read = read_lines(spark, path)
    assert read.rdd.getNumPartitions() > 5
    found = file_positions(read, "number")
    assert rows_of(found, "line", "file", "position", "number") == _wanted(texts)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan and "Sort" not in plan


def test_positions_do_not_depend_on_how_files_are_cut(spark, lines):
    path, texts = lines
    assert rows_of(file_positions(read_lines(spark, path), "number"), "line", "file", "position", "number") == _wanted(texts)


def test_other_blocks_than_counted_fail(spark, lines):
    path, _ = lines
    found = file_positions(read_lines(spark, path))
    assert found.count() == 6500
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        again = file_positions(read_lines(spark, path))
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        with pytest.raises(Exception, match="other blocks"):
            again.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_equal_rows_fall_by_the_weights(spark, lines, small_blocks):
    path, _ = lines
    part = row_part([0.8, 0.2], 1)
    parts = file_positions(read_lines(spark, path)).withColumn("part", part)
    same = {r["part"]: r["count"] for r in parts.filter("line = 'same'").groupBy("part").count().collect()}
    assert 0.75 < same[0] / sum(same.values()) < 0.85
    # The same on other blocks and for rows that are filtered after they were placed.
    kept = rows_of(parts.filter("line <> 'same'"), "line", "part")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    again = without_headers(file_positions(read_lines(spark, path))).withColumn("part", part)
    assert rows_of(again.filter("line <> 'same'"), "line", "part") == kept


def test_empty_input(spark, tmp_path):
    (tmp_path / "none").mkdir()
    assert file_positions(read_lines(spark, str(tmp_path / "none"))).count() == 0


def _jobs(spark, work):
    sc = spark.sparkContext
    sc.setJobGroup("write-parts", "")
    work()
    sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup("write-parts"))


def test_all_parts_in_one_job(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8)
    outs = [str(tmp_path / "a" / "x"), str(tmp_path / "b"), str(tmp_path / "empty")]
    part = F.when(F.col("id") % 10 == 0, 1).otherwise(0)
    text = F.col("id").cast("string")
    assert _jobs(spark, lambda: write_parts(df, text, part, outs, lines_per_file=50)) == 1
    read = lambda p: sorted(int(x) for f in p.glob("part-*") for x in f.read_text().split())
    assert read(tmp_path / "b") == list(range(0, 1000, 10))
    assert len(read(tmp_path / "a" / "x")) == 900 and read(tmp_path / "empty") == []
    assert max(len(f.read_text().split()) for f in (tmp_path / "a" / "x").glob("part-*")) <= 50
    assert {p.name for p in tmp_path.iterdir()} == {"a", "b", "empty"}
    assert all((tmp_path / p / "_SUCCESS").exists() for p in ("a/x", "b", "empty"))
    with pytest.raises(FileExistsError):
        write_parts(df, text, part, outs)
    more = [str(tmp_path / "c"), str(tmp_path / "d")]
    write_parts(df, text, part, more, files=2)
    assert all(len(list((tmp_path / p).glob("part-*"))) <= 2 for p in ("c", "d"))
