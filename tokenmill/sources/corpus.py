"""Corpus shard sources and sinks."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.functions.text import strip

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"      # what stands before the path of a URI


def _entries(spark: SparkSession, path: str, glob: str) -> list[str]:
    """Files and folders directly below ``path`` whose name matches ``glob``;
    as for Spark, names that begin with ``_`` or ``.`` are hidden."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [e.getPath() for e in fs.globStatus(hadoop.Path(p, glob)) or []] if fs.exists(p) else []
    return [e.toString() for e in found if e.getName()[0] not in "_."]


def scan_shards(spark: SparkSession, path: str, glob: str = "*.parquet",
                schema: T.StructType | None = None, legacy_path: str | None = None) -> DataFrame:
    """All parquet shards of a folder (``.tmp`` and other files ignored).

    A shard is a file, or a folder of part files as Spark writes it. Falls back
    to ``legacy_path`` when ``path`` holds no shard. Adds ``file_name``, the
    shard's name, ``part_name`` (the name of the file read) and ``row_index``
    from the hidden file metadata, so "order by file name, part, then row" is
    available without reading order.
    """
    found = _entries(spark, path, glob)
    if not found and legacy_path:
        path, found = legacy_path, _entries(spark, legacy_path, glob)
    r = spark.read.option("recursiveFileLookup", True) if found else spark.read.option("pathGlobFilter", glob)
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(*(found or [path]))
    name = part = F.col("_metadata.file_name")
    if found:  # shards are equally deep: what is deeper is a part, below its shard's name
        names = F.split(F.regexp_replace(F.col("_metadata.file_path"), HOST, ""), "/")
        deep = len(re.sub(HOST, "", found[0]).split("/"))
        name = F.when(F.size(names) > deep, F.get(names, F.lit(deep - 1))).otherwise(part)
    return df.select("*", name.alias("file_name"), part.alias("part_name"), F.col("_metadata.row_index").alias("row_index"))


def read_delimited_corpus(spark: SparkSession, path: str, sep: str = "\n\n---\n\n") -> DataFrame:
    """Split text files on ``sep``; strip; drop empty documents."""
    df = spark.read.option("lineSep", sep).option("wholetext", "false").text(path)
    return df.select(strip("value").alias("text")).filter(F.length("text") > 0)


def write_train_val(df: DataFrame, path: str, text_col: str = "text", rows_per_group: int = 1024) -> None:
    """Write the ``split`` column's train and val rows as separate shard
    folders (``split=train`` / ``split=val``), zstd, no dictionary. Adaptive
    execution splits a large split over many tasks and files."""
    (df.select("split", text_col).hint("rebalance", "split").write.mode("overwrite").partitionBy("split")
       .option("compression", "zstd").option("parquet.enable.dictionary", "false")
       .option("parquet.block.row.count.limit", rows_per_group).parquet(path))


def write_delimited_corpus(df: DataFrame, path: str, text_col: str = "text",
                           sep: str = "\n\n---\n\n") -> None:
    df.select(text_col).write.mode("overwrite").option("lineSep", sep).text(path)
