"""batch = stream, whatever the order of files, batches and Arrow chunks."""

from pyspark.sql import functions as F

from tokenmill.operators.packing import pack_plan
from tokenmill.plans.catalog import load
from tokenmill.plans.packing_report import byte_token_lengths
from tokenmill.plans.positions import global_position
from tokenmill.streaming import jobs as S

from conftest import SF_SMALL


def test_stream_pack_equals_batch(spark):
    lengths = byte_token_lengths(load(spark, SF_SMALL).documents)
    d = global_position(lengths, ["source", "doc_id"], ["split"], out="pos")
    stream = S.stream_pack(spark, d, 257, buffer_size=16, refill=4, group_docs=64)
    batch = pack_plan(d.withColumn("pack_group", F.floor(F.col("pos") / 64).cast("long")), "bestfit_crop", 257,
                      ["split"], buffer_size=16, refill=4)
    cols = ["split", "pack_group", "row_no", "doc_id", "dst", "take"]
    a = sorted(map(tuple, stream.select(*cols).collect()))
    b = sorted(map(tuple, batch.select(*cols).collect()))
    assert a == b and len(a) > 0


def test_stream_pack_equals_batch_in_small_chunks(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        test_stream_pack_equals_batch(spark)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_run_metrics_with_steps_out_of_order(spark):
    steps = [(r, i, 1.0 + i, 0.5, 2.0 - i / 100 if i % 5 == 0 else None) for r in (0, 1) for i in range(40)]
    schema = "run_id long, step long, loss double, dt double, val_bpb double"
    src, out, ck = S._paths(spark, "late")
    late = [x for x in steps if x[1] % 4 == 1] + [x for x in steps if x[1] == 7]  # one step twice
    for k, part in enumerate((late, [x for x in steps if x[1] % 4 != 1])):
        spark.createDataFrame(part, schema).selectExpr("*", f"{k} as bucket").coalesce(1).write.mode("append").partitionBy("bucket").parquet(src)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        got = sorted(map(tuple, S.run_metrics(spark, src, out, ck).collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [(r, i) for r, i, *_ in got] == [(r, i) for r in (0, 1) for i in range(40)]
    s = total = 0.0
    for i in range(40):
        s = 0.9 * s + 0.1 * (1.0 + i)
        total += 0.5 if i > 10 else 0.0
        assert abs(got[i][2] - s / (1 - 0.9 ** (i + 1))) < 1e-9 and got[i][4] == total
    assert got[39][3] == 2.0 - 35 / 100


def test_problem_split_over_files_counts_once(spark):
    rows = [("t", i, k, k == 1) for i in range(4) for k in range(2)]
    src, out, ck = S._paths(spark, "split")
    for k in range(2):
        part = spark.createDataFrame([r for r in rows if r[2] == k], "task string, idx long, k long, is_correct boolean")
        part.coalesce(1).write.mode("append").partitionBy("task").parquet(src)
    assert [tuple(r) for r in S.eval_progress(spark, src, out, ck).collect()] == [("t", 4, 4, 1.0)]
