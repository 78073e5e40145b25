"""Structured Streaming versions of the batch jobs.

Every job reads a file stream (new shard / result files as they land),
keeps exactly-once state in the checkpoint folder, and writes to a
parquet sink. ``run_to_completion`` drives a query with
``trigger(availableNow=True)`` so a finite input can be compared with the
batch job (batch = stream).

State:
* ST2 (packer) uses ``applyInPandasWithState`` keyed by pack group; the
  state is the carried buffer. Rows are taken in the order of their sequence
  number, whatever the order of files and Arrow chunks.
* ST4 (run metrics) uses ``transformWithStateInPandas`` keyed by run: one
  value state (EMA, best value, clock) and a map state of the steps that wait
  for earlier ones, so a batch touches only the steps that come or go.
* ST3 keeps per-problem results in a streaming aggregation; ST3 and ST5
  write with ``foreachBatch`` to ``.../batch_id=<n>`` with overwrite, so a
  replayed micro-batch replaces its own output.
"""

from __future__ import annotations

import json
import os
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.state import GroupStateTimeout

from tokenmill.operators.packers import _LengthBuffer
from tokenmill.session import scratch_path


# ------------------------------------------------------------- helpers --

def stage_by_key(df: DataFrame, path: str, key: str) -> None:
    """Write files by key value (``key=<v>/part-*.parquet``). Small keys give
    one file each; adaptive execution splits a large one over many tasks."""
    df.hint("rebalance", key).write.mode("overwrite").partitionBy(key).parquet(path)


def run_to_completion(writer):
    """Drive a query over all input that is there, however long it takes."""
    q = writer.trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def in_sequence(held: dict[int, list], expected: int, pdfs, position: str, columns: list[str]):
    """Merge a key's new chunks into the rows held so far and hand out those
    that continue the sequence: ``(rows, held, expected)``. Input files and
    Arrow chunks may come in any order; rows before ``expected`` are replays,
    rows after a gap wait until it closes."""
    for pdf in pdfs:
        for row in pdf[[position, *columns]].itertuples(index=False, name=None):
            if row[0] >= expected:
                held[int(row[0])] = [None if pd.isna(v) else v for v in row[1:]]
    rows = []
    while expected in held:
        rows.append((expected, *held.pop(expected)))
        expected += 1
    return rows, held, expected


def _plain(v):
    return v.item() if hasattr(v, "item") else v


def _paths(spark: SparkSession, name: str):
    base = scratch_path(spark, f"stream_{name}")
    return os.path.join(base, "in"), os.path.join(base, "out"), os.path.join(base, "ckpt")


# ----------------------------------------------------------------- ST1 --

def stream_shards(spark: SparkSession, docs: DataFrame, shard_col: str = "source",
                  max_files: int | None = None) -> DataFrame:
    """New shards are picked up as they land, ``max_files`` files (one per
    core, if not given) per micro-batch; per-shard docs, chars and
    UTF-8 bytes are appended per micro-batch."""
    src, out, ck = _paths(spark, "shards")
    stage_by_key(docs.select("doc_id", "text", shard_col), src, shard_col)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField(shard_col, T.StringType())])
    s = spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", max_files or spark.sparkContext.defaultParallelism).parquet(src)
    per = s.select(shard_col, F.length("text").alias("chars"), F.octet_length("text").alias("bytes"))
    w = (per.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck)
            .outputMode("append"))
    run_to_completion(w)
    return spark.read.parquet(out).groupBy(shard_col).agg(
        F.count("*").alias("docs"), F.sum("chars").alias("chars"), F.sum("bytes").alias("bytes"))


# ----------------------------------------------------------------- ST3 --

def stream_eval_progress(spark: SparkSession, outcomes: DataFrame) -> DataFrame:
    """Outcome files arrive one per trigger. A streaming aggregation keeps
    per-problem pass/fail in its state, so the samples of a problem may be
    spread over files and batches; every change is written by batch id, and
    running passed / total per task is read off the sink."""
    src, out, ck = _paths(spark, "eval")
    stage_by_key(outcomes.select("task", "idx", "k", "is_correct"), src, "task")
    return eval_progress(spark, src, out, ck)


def eval_progress(spark: SparkSession, src: str, out: str, ck: str) -> DataFrame:
    schema = "idx long, k long, is_correct boolean, task string"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    problems = s.groupBy("task", "idx").agg(F.bool_or("is_correct").alias("passed"))

    def per_batch(batch: DataFrame, batch_id: int):
        batch.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))

    run_to_completion(problems.writeStream.outputMode("update").foreachBatch(per_batch).option("checkpointLocation", ck))
    # a problem only ever turns from failed to passed
    p = spark.read.parquet(out).groupBy("task", "idx").agg(F.bool_or("passed").alias("passed"))
    return p.groupBy("task").agg(F.sum(F.col("passed").cast("long")).alias("passed"),
                                 F.count("*").alias("total"),
                                 F.avg(F.col("passed").cast("double")).alias("accuracy"))


# ----------------------------------------------------------------- ST5 --

def stream_validate(spark: SparkSession, lines: DataFrame, validate) -> DataFrame:
    """JSONL conversation files land, a few per trigger; each micro-batch is
    parsed and validated, good rows appended to ``good/``, bad ones to the
    dead-letter ``bad/`` with their reason. Returns counts per status."""
    from tokenmill.sources.files import MESSAGES
    src, out, ck = _paths(spark, "validate")
    lines.select("value").hint("rebalance").write.mode("overwrite").text(src)
    s = (spark.readStream.schema("value string")
              .option("maxFilesPerTrigger", spark.sparkContext.defaultParallelism).text(src))

    def per_batch(batch: DataFrame, batch_id: int):
        d = batch.select(F.get_json_object("value", "$.conv_id").cast("long").alias("conv_id"),
                         F.from_json(F.get_json_object("value", "$.messages"), MESSAGES).alias("messages"))
        v = validate(d)
        v.filter(F.col("reason").isNull()).write.mode("overwrite").parquet(
            os.path.join(out, "good", f"batch_id={batch_id}"))
        v.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(
            os.path.join(out, "bad", f"batch_id={batch_id}"))

    run_to_completion(s.writeStream.foreachBatch(per_batch).option("checkpointLocation", ck))
    good = spark.read.parquet(os.path.join(out, "good")).select(F.lit("good").alias("status"), "reason")
    bad = spark.read.parquet(os.path.join(out, "bad")).select(F.lit("bad").alias("status"), "reason")
    return good.unionByName(bad).groupBy("status", "reason").agg(F.count("*").alias("conversations"))


# ----------------------------------------------------------------- ST4 --

RUN_OUT = T.StructType([
    T.StructField("run_id", T.LongType()), T.StructField("step", T.LongType()),
    T.StructField("smooth_loss", T.DoubleType()), T.StructField("best_so_far", T.DoubleType()),
    T.StructField("total_time", T.DoubleType()), T.StructField("late", T.BooleanType()),
])
REORDER_STEPS = 1024


class RunMetrics(StatefulProcessor):
    """Running metrics of one run's steps, taken in ascending order.

    A step is taken when it is the next one. The others wait in a map state
    until (a) the steps before them come, (b) a step more than ``reorder``
    ahead of the next one comes, or (c) the run's end marker has come (null
    ``step``, ``rows`` = how many steps the run logged) and so have that many
    steps. After (b) and (c) the steps in between are a gap: rows go on after
    it, so a run that resumes at step 500 or lacks a step gives every row it
    has; of a run that never ends, at most ``reorder`` steps wait. A
    step that comes after its gap was passed is put out with ``late`` true and
    null metrics; a step that was taken before is a replay and ignored.
    """

    def __init__(self, beta: float, warmup: int, reorder: int = REORDER_STEPS):
        self.beta, self.warmup, self.reorder = beta, warmup, reorder

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.run = handle.getValueState(
            "run", "s double, best double, total double, next long, seen long, logged long, waiting long")
        self.held = handle.getMapState("held", "step long", "loss double, dt double, val_bpb double")
        self.gaps = handle.getMapState("gaps", "first long", "after long")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for next_step, s, best, total in initialState[["next_step", "smooth", "best", "total_time"]].itertuples(
                index=False, name=None):
            self.run.update((float(s), _value(best), float(total), int(next_step), 0, None, 0))

    def handleInputRows(self, key, rows, timerValues):
        run = list(self.run.get()) if self.run.exists() else [0.0, None, 0.0, 0, 0, None, 0]
        was_held = dict((k[0], v) for k, v in self.held.iterator()) if run[6] else {}
        held, out = dict(was_held), []
        for pdf in rows:
            for step, loss, dt, val, logged in pdf[["step", "loss", "dt", "val_bpb", "rows"]].itertuples(
                    index=False, name=None):
                if pd.isna(step):
                    run[5] = _value(logged, int)
                elif step >= run[3]:
                    held[int(step)] = (_value(loss), _value(dt), _value(val))
                elif self._pass_late(int(step)):
                    run[4] += 1
                    out.append((key[0], int(step), None, None, None, True))
        out += self._take(key[0], run, held)
        yield from self._leave(run, was_held, held, out)

    def _take(self, run_id, run, held) -> list:
        out = []
        complete = run[5] is not None and run[4] + len(held) >= run[5]
        last = max(held, default=0)
        for step in sorted(held):
            if step != run[3]:
                if not complete and last - run[3] <= self.reorder:
                    break
                self.gaps.updateValue((run[3],), (step,))
            loss, dt, val = held.pop(step)
            if loss is not None:
                run[0] = self.beta * run[0] + (1 - self.beta) * loss
            if val is not None:
                run[1] = val if run[1] is None else min(run[1], val)
            if step > self.warmup and dt is not None:
                run[2] += dt
            run[3], run[4] = step + 1, run[4] + 1
            out.append((run_id, step, run[0] / (1 - self.beta ** (step + 1)), run[1], run[2], False))
        return out

    def _pass_late(self, step: int) -> bool:
        """Whether the step is in a gap; the gap is split there, so that the
        same step is no late one twice."""
        for (first,), (after,) in list(self.gaps.iterator()):
            if first <= step < after:
                self.gaps.removeKey((first,))
                if first < step:
                    self.gaps.updateValue((first,), (step,))
                if step + 1 < after:
                    self.gaps.updateValue((step + 1,), (after,))
                return True
        return False

    def _leave(self, run, was_held, held, out):
        for step in was_held.keys() - held.keys():
            self.held.removeKey((step,))
        for step, row in held.items():
            if was_held.get(step) != row:
                self.held.updateValue((step,), row)
        run[6] = len(held)
        self.run.update(tuple(run))
        if out:
            frame = pd.DataFrame(out, columns=[f.name for f in RUN_OUT.fields])
            yield frame.astype({"smooth_loss": "float64", "best_so_far": "float64", "total_time": "float64"})

    def close(self) -> None:
        pass


def _value(v, kind=float):
    return None if v is None or pd.isna(v) else kind(v)


def stream_run_metrics(spark: SparkSession, steps: DataFrame, beta: float = 0.9,
                       warmup: int = 10) -> DataFrame:
    """EMA-debiased loss, best val so far and training clock per run as
    step logs arrive (state per run; steps may arrive in any order, a run
    may start at any step and lack some). A run's log ends with a marker that
    counts its steps."""
    src, out, ck = _paths(spark, "runs")
    logs = steps.select("run_id", F.col("step").cast("long").alias("step"), "loss", "dt", "val_bpb",
                        F.lit(None).cast("long").alias("rows"))
    ends = logs.groupBy("run_id").agg(F.count_distinct("step").alias("rows")).select(
        "run_id", *[F.lit(None).cast(logs.schema[c].dataType).alias(c) for c in ("step", "loss", "dt", "val_bpb")],
        "rows")
    logs.unionByName(ends).hint("rebalance").write.mode("overwrite").parquet(src)
    return run_metrics(spark, src, out, ck, beta, warmup, max_files=spark.sparkContext.defaultParallelism)


def run_metrics(spark: SparkSession, src: str, out: str, ck: str, beta: float = 0.9, warmup: int = 10,
                reorder: int = REORDER_STEPS, initial: DataFrame | None = None,
                max_files: int = 1) -> DataFrame:
    """The metrics of the logs in ``src``. ``initial`` (``run_id, next_step,
    smooth, best, total_time``) gives resumed runs what their checkpoint
    kept: the next step, the undebiased average, the best value and the clock."""
    schema = "run_id long, step long, loss double, dt double, val_bpb double, rows long"
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(src)
    started = None if initial is None else initial.select(
        "run_id", "next_step", "smooth", "best", "total_time").groupBy("run_id")
    res = s.groupBy("run_id").transformWithStateInPandas(
        RunMetrics(beta, warmup, reorder), RUN_OUT, "Append", "None", initialState=started)
    w = res.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append")
    with _rocksdb(spark):
        run_to_completion(w)
    return spark.read.schema(RUN_OUT).parquet(out)


@contextmanager
def _rocksdb(spark: SparkSession):
    """Map states need the RocksDB store, which a query keeps from its start."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


# ----------------------------------------------------------------- ST2 --

PLAN_OUT = T.StructType([
    T.StructField("split", T.StringType()), T.StructField("pack_group", T.LongType()),
    T.StructField("row_no", T.LongType()),
    T.StructField("doc_id", T.LongType()), T.StructField("dst", T.LongType()),
    T.StructField("take", T.LongType()),
])
PACK_STATE = T.StructType([T.StructField("blob", T.StringType())])


def _stream_bestfit(cap: int, buffer_size: int, refill: int, group_docs: int):
    """Best-fit crop with a carried buffer: picks happen only while enough
    input is known to do the same refills as the batch packer; an ``eos``
    row, the position after the last, flushes the rest (input exhausted)."""
    def fn(key, pdfs, state):
        st = json.loads(state.get[0]) if state.exists else {
            "pending": [], "buf": [], "row": 0, "cur": [], "pos": 0, "eos": False, "held": {},
            "next": int(key[1]) * group_docs}
        held = {int(k): v for k, v in st["held"].items()}
        rows, held, st["next"] = in_sequence(held, st["next"], pdfs, "pos", ["doc_id", "n_tokens", "eos"])
        st["held"] = {k: [_plain(x) for x in v] for k, v in held.items()}
        for _, doc, n, eos in rows:
            if eos:
                st["eos"] = True
            else:
                st["pending"].append([int(doc), int(n)])
        buf = _LengthBuffer()
        for d, n in st["buf"]:
            buf.add(n, d)
        pending, cur, pos, row = st["pending"], st["cur"], st["pos"], st["row"]
        out = []
        while True:
            while buf.count < buffer_size and pending:
                if len(pending) < refill and not st["eos"]:
                    break
                for d, n in pending[:refill]:
                    buf.add(n, d)
                pending = pending[refill:]
            if buf.count < buffer_size and not st["eos"]:
                break                                  # wait for more input
            if buf.count == 0:
                break
            room = cap - pos
            hit = buf.pop_largest_fitting(room)
            if hit is not None:
                d, n = hit
                cur.append([d, pos, n])
                pos += n
            else:
                d, _ = buf.pop_shortest()
                cur.append([d, pos, room])
                pos = cap
            if pos == cap:
                out.extend((key[0], key[1], row, d, dst, take) for d, dst, take in cur)
                row, cur, pos = row + 1, [], 0
        # buffer back to arrival order (ids are increasing stream positions of entry)
        rest = []
        for length, q in buf.by_len.items():
            rest.extend([d, length] for d in q)
        st.update(pending=pending, buf=rest, row=row, cur=cur, pos=pos)
        state.update((json.dumps(st),))
        if out:
            yield pd.DataFrame(out, columns=[f.name for f in PLAN_OUT.fields])
    return fn


def stream_pack(spark: SparkSession, docs: DataFrame, cap: int, buffer_size: int = 1000,
                refill: int = 128, shard_col: str = "source", group_docs: int = 100_000) -> DataFrame:
    """ST2: best-fit crop packing over a shard stream with the buffer kept
    in state per (split, pack group) - the same bounded groups as the batch
    packer. Rows carry their stream position, so shards may arrive in any
    order; an end marker per group flushes. All shards are staged by one
    write."""
    src, out, ck = _paths(spark, "pack")
    d = docs.withColumn("pack_group", F.floor(F.col("pos") / group_docs).cast("long"))
    marker = d.groupBy("split", "pack_group").agg(F.max("pos").alias("pos")).select(
        "split", "pack_group", (F.col("pos") + 1).alias("pos"), F.lit(-1).cast("long").alias("doc_id"),
        F.lit(0).cast("long").alias("n_tokens"), F.lit(True).alias("eos"), F.lit("~eos").alias(shard_col))
    body = d.select("split", "pack_group", "pos", "doc_id", "n_tokens", F.lit(False).alias("eos"), shard_col)
    stage_by_key(body.unionByName(marker), src, shard_col)
    schema = ("split string, pack_group long, pos long, doc_id long, n_tokens long, eos boolean, "
              + f"{shard_col} string")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    res = s.groupBy("split", "pack_group").applyInPandasWithState(
        _stream_bestfit(cap, buffer_size, refill, group_docs), PLAN_OUT, PACK_STATE, "append", GroupStateTimeout.NoTimeout)
    w = res.writeStream.format("parquet").option("path", out).option("checkpointLocation", ck).outputMode("append")
    run_to_completion(w)
    return spark.read.parquet(out)
