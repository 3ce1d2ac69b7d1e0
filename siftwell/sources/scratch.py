"""Tables written to the shared scratch folder, to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _remove_at_exit(spark, path: str) -> None:
    def remove() -> None:
        with contextlib.suppress(Exception):
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)

    atexit.register(remove)


@contextlib.contextmanager
def _exchanges_dropped(spark: SparkSession):
    """A table that is written within deletes the files of its exchanges as soon as it is there."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes a table under spark.checkpoint.dir, the folder that a cluster shares, and reads it back. Only where it
    is unset, in local mode, is a temporary folder taken. The table is removed when the application ends, or by release."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="siftwell-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/siftwell-{uuid.uuid4().hex}/{name}"
    _remove_at_exit(spark, path.rpartition("/")[0])
    with _exchanges_dropped(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def release(*tables: DataFrame) -> None:
    """Deletes tables of ``materialize`` whose every reader has been written itself, and has the driver look for
    exchanges that nothing refers to any more, whose files the executors then delete."""
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(table._scratch.rpartition("/")[0])
        path.getFileSystem(conf).delete(path, True)
    gc.collect()
    SparkSession.active()._jvm.System.gc()
