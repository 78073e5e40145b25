"""Line-oriented sources and sinks: JSONL, CSV, TSV, word lists.

All readers take explicit schemas (no inference) and keep bad input
visible: parse failures land in a ``reason`` column instead of failing
the job or vanishing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.functions.text import strip

MESSAGES = T.ArrayType(T.StructType([
    T.StructField("role", T.StringType()),
    T.StructField("content", T.StringType()),
]))


def read_conversations_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """One JSON array of ``{role, content}`` per line; blank lines skipped.

    Returns ``file_name``, ``messages`` and ``reason``
    ('not_json' when the line is not such an array); validation of roles is
    ``operators.conversations.validate_conversations``.
    """
    df = spark.read.text(path)
    extra = [c for c in df.columns if c != "value"]          # partition columns, if any
    raw = df.select(*extra, F.col("value").alias("line"), F.col("_metadata.file_name").alias("file_name"))
    raw = raw.withColumn("line", strip("line")).filter(F.length("line") > 0)
    msgs = F.from_json("line", MESSAGES, {"mode": "PERMISSIVE"})
    return raw.select(*extra, "file_name", msgs.alias("messages"),
                      F.when(msgs.isNull(), F.lit("not_json")).alias("reason"))


def write_jsonl(df: DataFrame, path: str, cols=None) -> None:
    """One JSON object per line, non-ASCII kept as is."""
    cols = cols or df.columns
    df.select(F.to_json(F.struct(*cols)).alias("value")).write.mode("overwrite").text(path)


def read_eval_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line with a fixed schema."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


def read_results_csv(spark: SparkSession, path: str, key: str, value: str | list[str]) -> DataFrame:
    """Header CSV -> key + floats. Values are trimmed; blank -> NULL; rows
    whose values do not parse are skipped (as the reference's reader)."""
    values = [value] if isinstance(value, str) else list(value)
    df = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True) \
        .option("ignoreTrailingWhiteSpace", True).csv(path)
    df = df.toDF(*[c.strip() for c in df.columns])
    out = df.select(strip(key).alias(key), *[strip(v).alias(v) for v in values])
    parsed = [F.when(F.col(v) == "", F.lit(None).cast("double")).otherwise(F.col(v).try_cast("double")).alias(v)
              for v in values]
    ok = F.lit(True)
    for v in values:
        ok = ok & ((F.col(v) == "") | F.col(v).isNull() | F.col(v).try_cast("double").isNotNull())
    return out.filter(ok & (F.col(key) != key)).select(key, *parsed)


def write_results_csv(results: DataFrame, path: str, task_col: str = "task", acc_col: str = "accuracy",
                      centered_col: str = "centered") -> DataFrame:
    """One row per task (6 decimals) plus a ``CORE`` row with blank accuracy
    and the mean centered value. Writes the CSV and returns its rows."""
    rows = results.select(F.col(task_col).alias("Task"),
                          F.format_string("%.6f", F.col(acc_col)).alias("Accuracy"),
                          F.round(F.col(centered_col), 6).alias("Centered"))
    total = results.agg(F.lit("CORE").alias("Task"), F.lit("").alias("Accuracy"),
                        F.round(F.avg(centered_col), 6).alias("Centered"))
    out = rows.unionByName(total)
    out.write.mode("overwrite").option("header", True).csv(path)
    return out


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, stripped."""
    return spark.read.text(path).select(strip("value").alias("word"))


def read_title_tsv(spark: SparkSession, path: str) -> DataFrame:
    """``id<TAB>title`` lines split on the first tab; lines without a tab skipped."""
    df = spark.read.text(path).filter(F.instr("value", "\t") > 0)
    return df.select(strip(F.substring_index("value", "\t", 1)).alias("id"),
                     strip(F.expr("substr(value, instr(value, '\t') + 1)")).alias("title"))


def title_lookup(ids: DataFrame, titles: DataFrame, prefix: str, id_col: str = "id") -> DataFrame:
    """Left join ids with titles; a missing title becomes ``prefix + id``."""
    j = ids.join(titles.select(F.col(id_col).alias("_tid"), F.col("title").alias("_t")),
                 F.col(id_col) == F.col("_tid"), "left")
    return j.withColumn("title", F.coalesce(F.col("_t"), F.concat(F.lit(prefix), F.col(id_col).cast("string")))) \
            .drop("_tid", "_t")


def unwrap_rows(df: DataFrame, struct_col: str) -> DataFrame:
    """Rows nested under one struct column become top-level columns."""
    return df.select(f"{struct_col}.*")


def append_missing(todo: DataFrame, done: DataFrame, keys) -> DataFrame:
    """Work items whose key is not in the results yet (left anti join)."""
    return todo.join(done.select(*keys).distinct(), list(keys), "left_anti")
