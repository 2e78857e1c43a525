"""Intermediate tables in the shared checkpoint folder.

A written table cuts the lineage: a lost executor never forces the work
before it to run again, and its file size gives the planner a measured
size.  Tables stay until the folder's own retention removes them."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame

from quillstream.session import scratch_path


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under spark.checkpoint.dir and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    # frames of earlier steps are out of scope by now: a collection lets
    # Spark's cleaner drop their shuffle files before this step writes its own
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete tables of ``cut`` that no result reads any more; the others stay
    until the folder's own retention removes them."""
    for table in tables:
        session = table.sparkSession
        jvm = session.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(session.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(name: str, taken: list[str]) -> str:
    """``name`` with as many underscores before it as make it a new column
    (Spark compares names in lower case)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name
