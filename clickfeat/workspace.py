"""Tables kept between Spark jobs, in the shared folder the cluster names.

Fitted level tables are used by many later queries, so they are written once as parquet and read
back. That cuts the lineage, lets every reader prune columns and row groups, and survives the
loss of executors.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_RUN = uuid.uuid4().hex


def shared_dir(spark: SparkSession) -> str:
    """The folder for kept tables: ``spark.checkpoint.dir``, or a fresh one in local mode."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="clickfeat-"))
        named = spark.sparkContext.getCheckpointDir()
    return f"{named.rstrip('/')}/clickfeat-{_RUN}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def store(
    df: DataFrame, name: str, path: str | None = None, by: str | None = None
) -> DataFrame:
    """Write ``df`` as parquet, in one folder per ``by`` value if asked, and return the table."""
    spark = df.sparkSession
    path = path or new_path(spark, name)
    df.write.parquet(path, partitionBy=by)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, names: Sequence[str], types: Sequence, rows) -> DataFrame:
    """A table of a few driver-side rows, as a local relation."""
    columns = zip(*rows) if rows else [[] for _ in names]
    arrays = [pa.array(list(values), type) for values, type in zip(columns, types)]
    return spark.createDataFrame(pa.table(arrays, names=list(names)))


_MARK = "committed.json"


def commit(spark: SparkSession, path: str, mark: dict) -> None:
    """Write the mark of a saved state: last, once all that it names is there. A newer one replaces it."""
    text = json.dumps({**mark, "end": True}).encode()
    file = spark._jvm.org.apache.hadoop.fs.Path(path, _MARK)
    out = file.getFileSystem(spark._jsc.hadoopConfiguration()).create(file, True)
    try:
        out.write(text)
    finally:
        out.close()


def committed(spark: SparkSession, path: str) -> dict:
    """The mark of a saved state. A state without a whole mark was not saved to the end."""
    rows = spark.read.text(f"{path}/{_MARK}", wholetext=True) if _has(spark, f"{path}/{_MARK}") else None
    text = rows.first()["value"] if rows is not None else ""
    try:
        mark = json.loads(text)
    except ValueError:
        mark = {}
    if not mark.get("end"):
        raise ValueError(f"{path} holds no state that was saved to the end")
    return mark


def _has(spark: SparkSession, path: str) -> bool:
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = file.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.exists(file) and system.getFileStatus(file).getLen() > 0


def delete(spark: SparkSession, path: str) -> None:
    """Delete one kept table. Frames that read it stop working."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Delete every table this process has kept. Frames that read them stop working."""
    delete(spark, shared_dir(spark))
