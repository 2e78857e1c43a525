"""Table sinks (K1, K2, K8, K9).

Tables are parquet directories partitioned by ``topic`` under a namespace
root (the source system's database -> collection-per-topic layout).
Appends add files; updates go through ``operators.merge``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# news_items table schema (partition column ``topic`` added on write)
NEWS_ITEMS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("title", T.StringType()),
        T.StructField("date", T.TimestampType()),
        T.StructField("link", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("analyse", T.StringType()),
        T.StructField("topic", T.StringType()),
    ]
)

def table_path(root: str, namespace: str, table: str) -> str:
    """K2: the target namespace is a parameter of the same job."""
    return f"{root.rstrip('/')}/{namespace}/{table}"


def init_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: str | None = None) -> DataFrame:
    """K8: create the table if absent (an empty write records the schema)
    and return it."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        w = spark.createDataFrame([], schema).write.mode("append")
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(path)
        return spark.read.schema(schema).parquet(path)


def append(df: DataFrame, path: str, partition_by: str | None = "topic") -> None:
    """K1: append a batch; an empty batch writes nothing (K9)."""
    if df.isEmpty():
        return
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
