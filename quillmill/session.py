"""Session plumbing: shared scratch tables, worker packaging, table readers."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a session on one machine that names none gets a temporary one; a cluster must name it.
    """
    given = spark.conf.get("spark.checkpoint.dir", None)
    if not given:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        given = tempfile.mkdtemp(prefix="quillmill-")
        spark.conf.set("spark.checkpoint.dir", given)
    return given.rstrip("/")


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    Cuts the lineage; unlike a local checkpoint the rows survive lost executors.
    The table goes with :func:`discard`, or when the application ends.  Files shuffled
    for it go at once: Spark deletes them when the driver's garbage is collected.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillmill-{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    spark._jvm.System.gc()
    jpath, fs = _hadoop(spark, path)
    fs.deleteOnExit(jpath)
    out = spark.read.schema(df.schema).parquet(path)
    out._quillmill_path = path
    if _scratch:
        _scratch[-1].append(out)
    return out


_scratch: list[list[DataFrame]] = []


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """Discards the tables that are made inside it, except those taken off the list it gives."""
    made: list[DataFrame] = []
    _scratch.append(made)
    try:
        yield made
    finally:
        _scratch.pop()
        for t in made:
            discard(t)


def _hadoop(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def spread(df: DataFrame, *keys: str | Column) -> DataFrame:
    """``df`` dealt to all tasks by ``keys``, for steps whose work is large for their bytes; adaptive execution leaves the number alone."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *keys)


def occupied(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` itself if it has a partition for every task slot, as large tables do; a table of fewer files is dealt anew."""
    few = df._jdf.queryExecution().toRdd().getNumPartitions() < df.sparkSession.sparkContext.defaultParallelism
    return spread(df, *keys) if few else df


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`materialise`."""
    path = getattr(df, "_quillmill_path", None)
    if path:
        jpath, fs = _hadoop(df.sparkSession, path)
        fs.delete(jpath, True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers, wherever they run."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(base, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="quillmill-ship-"), "quillmill.zip")
    with open(path, "wb") as f:
        f.write(buf.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def broadcast_if_small(df: DataFrame, most_rows: int = 200_000, most_bytes: int = 8 << 20) -> DataFrame:
    """``df`` as a table, with a broadcast hint if both its rows and its bytes on disk are few; else it is left to shuffle.

    The table is written once, so that counting it costs no second run of its plan.
    """
    from pyspark.sql import functions as F

    held = df if getattr(df, "_quillmill_path", None) else materialise(df, "side")
    jpath, fs = _hadoop(df.sparkSession, held._quillmill_path)
    small = fs.getContentSummary(jpath).getLength() <= most_bytes and held.count() <= most_rows
    return F.broadcast(held) if small else held
