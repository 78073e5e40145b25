"""tokenmill: corpus, tokenizer, packing and evaluation jobs on Spark.

Subpackages
-----------
sources    readers and writers (parquet shards, JSONL, CSV, text)
functions  Column-expression builders (text, regex, arrays)
operators  DataFrame -> DataFrame jobs (cleaning, joins, aggregates,
           windows, ordering, mixtures, tokenizer, packing, scoring)
plans      session set-up, table catalog, derived fixture views, the
           query registry used by ``__spark_entry__``
streaming  Structured Streaming variants of the batch jobs
"""

from tokenmill.session import get_spark, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
