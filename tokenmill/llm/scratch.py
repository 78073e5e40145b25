"""Intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tokenmill.session import scratch_path

#: Stands for a null doc_id in joins; sorts after all others.
LAST_ID = (1 << 63) - 1


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the folder that ``spark.checkpoint.dir``
    names and read it back: later steps read finished files, so lost
    executors cost no recomputation of what came before.

    The step's shuffle files are of no more use then. Spark deletes them when
    the driver collects its garbage, which it may not do for half an hour, so
    it is asked to now; else a job of many steps keeps all their files."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)
