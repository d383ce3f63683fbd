"""Tables written to the folder that driver and executors share, and read back."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder of our own only in local mode, where the session names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def materialise(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage, and lost executors cost no recomputation. by: a column of few values that gives each its folder."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let shuffle files of finished jobs go: Spark deletes them once the driver's collector has seen that nothing refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete the folders of tables that materialise wrote and that nothing reads any more, and the shuffle files that they came from."""
    for df in tables:
        spark = df.sparkSession
        jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        for folder in {re.sub(r"(/[^/]+=[^/]*)*/[^/]+$", "", f) for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            if path.getParent().toUri().getPath() == jvm.org.apache.hadoop.fs.Path(shared_dir(spark)).toUri().getPath():
                path.getFileSystem(conf).delete(path, True)
    if tables:
        release(tables[0].sparkSession)
