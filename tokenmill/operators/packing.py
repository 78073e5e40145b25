"""Packing jobs: token documents -> fixed-length training rows.

Layout of every packer job:

1. ``assign_pack_groups`` gives each document a dense position in stream
   order (two-pass prefix sum, no single-task window) and a bounded
   ``pack_group = pos div group_docs``. A hot shard or split is therefore
   split into many groups; a group never holds more than ``group_docs``
   documents.
2. ``pack_plan`` runs the sequential rule per group with
   ``groupBy(...).applyInPandas`` on ``(pos, doc_id, n_tokens)`` only, and
   packs what groups leave level by level.
3. ``pack_rows`` makes the rows themselves: a stream's lengths are packed as
   they are read, and rows are put together from the documents' first tokens.

``chunk_stream`` (cut the concatenated stream every ``cap`` tokens) is
fully relational. ``packing_stats`` reports utilisation, crop and pad.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain, groupby

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.operators.packers import pack, packed_rows
from tokenmill.plans.positions import global_position, prefix_sum
from tokenmill.session import scratch_path

GROUP_DOCS = 100_000        # documents that one task plans at a time
PLAN_BATCH = 1 << 14        # placements that a task sends at a time
LEVEL = 1 << 40             # groups of level k are numbered from k * LEVEL
PLAN_COLS = ["row_no", "doc_id", "dst", "src", "take", "n_tokens"]


def assign_pack_groups(docs: DataFrame, order_cols, group_cols=(),
                       group_docs: int = GROUP_DOCS, pos_col: str = "pos") -> DataFrame:
    """Add ``pos`` (stream position within ``group_cols``) and ``pack_group``."""
    out = global_position(docs, order_cols, group_cols, out=pos_col)
    return out.withColumn("pack_group", F.floor(F.col(pos_col) / F.lit(group_docs)).cast("long"))


def pack_plan(docs: DataFrame, packer: str, cap: int, group_cols=(),
              len_col: str = "n_tokens", pos_col: str = "pos", id_col: str = "doc_id",
              group_docs: int = GROUP_DOCS, **packer_args) -> DataFrame:
    """Placement plan per ``group_cols``.

    Output: group keys, ``pack_group, row_no, doc_id, dst, src, take, n_tokens``.
    """
    return pack_plans(docs, {packer: packer_args}, cap, group_cols, len_col, pos_col, id_col, group_docs).drop("packer")


def pack_plans(docs: DataFrame, packers: dict, cap: int, group_cols=(),
               len_col: str = "n_tokens", pos_col: str = "pos", id_col: str = "doc_id",
               group_docs: int = GROUP_DOCS) -> DataFrame:
    """Several packers over the same groups in one pass: one shuffle of the
    ``(pos, doc_id, n_tokens)`` rows, every rule run on the group while it
    is in the Python worker. Output = ``pack_plan`` columns + ``packer``.
    ``packers`` maps packer name -> keyword arguments.

    The groups of a stream are packed side by side. What a group leaves (its
    unfinished row and its buffer) is packed by the next level, in the order
    of the stream, in groups of the same size, until a stream has one group
    left; so one short row a stream is dropped or padded, however many groups
    there are. Groups of level ``k`` are numbered from ``k * LEVEL``. The
    groups' results and what they leave are written once per level."""
    stream = ["packer", *group_cols]
    flat = docs.select(*group_cols, "pack_group", F.col(pos_col).cast("long").alias("pos"), F.col(id_col).cast("long").alias("doc_id"),
                       F.col(len_col).cast("long").alias("n_tokens"))
    todo = flat
    n = flat.count()  # of a narrow scan; no stream holds more
    if n <= group_docs:
        return _plan_level(todo.withColumn("_last", F.lit(True)), packers, cap, group_cols).drop("pos")
    placed = None
    level = 0
    while True:
        by = stream if level else list(group_cols)
        whole = todo.groupBy(*by).agg((F.max("pack_group") == F.min("pack_group")).alias("_last"))
        if by:
            same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by])
            marked = todo.join(whole.select(*[F.col(c).alias(f"_{c}") for c in by], "_last"), same).drop(*[f"_{c}" for c in by])
        else:
            marked = todo.withColumn("_last", whole.select("_last").scalar())
        out = written(_plan_level(marked, packers, cap, group_cols, level), "pack-level")
        done = out.where("row_no is not null").withColumn("pack_group", F.col("pack_group") + level * LEVEL).drop("pos")
        placed = done if placed is None else placed.unionByName(done)
        left = out.where("row_no is null")
        n_left = left.count()
        if not n_left:
            return placed
        if level and n_left >= n:
            raise ValueError("group_docs is too small: a group leaves as many documents as it gets")
        n, level = n_left, level + 1
        todo = assign_pack_groups(left.select(*stream, "pos", "doc_id", "n_tokens"), ["pos"], stream, group_docs, "_p")
        todo = todo.withColumn("pos", F.col("_p")).drop("_p")


def _plan_level(docs: DataFrame, packers: dict, cap: int, group_cols, level: int = 0) -> DataFrame:
    """Plan rows of every group, and rows without ``row_no`` for documents
    that are left. In the first level a group is packed by every packer."""
    keys = [*(["packer"] if level else []), *group_cols, "pack_group"]
    fields = [docs.schema[k] for k in [*group_cols, "pack_group"]]
    schema = T.StructType([T.StructField("packer", T.StringType()), *fields, T.StructField("pos", T.LongType()),
                           *[T.StructField(c, T.LongType()) for c in PLAN_COLS]])
    names = schema.fieldNames()

    def plan_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", kind="stable")
        lengths, ids, pos, last = pdf["n_tokens"].to_numpy(), pdf["doc_id"].to_numpy(), pdf["pos"].to_numpy(), bool(pdf["_last"].iloc[0])
        outs = []
        for name in packers if not level else [key[0]]:
            (d, r, dst, src, take), left = pack(name, lengths, cap, last, **packers[name])
            outs.append(pd.DataFrame({"packer": name, "pos": pos[d], "row_no": pd.array(r, "Int64"), "doc_id": ids[d], "dst": pd.array(dst, "Int64"),
                                      "src": pd.array(src, "Int64"), "take": pd.array(take, "Int64"), "n_tokens": lengths[d]}))
            if len(left):
                outs.append(pd.DataFrame({"packer": name, "pos": pos[left], "row_no": pd.array([None] * len(left), "Int64"), "doc_id": ids[left],
                                          **{c: pd.array([None] * len(left), "Int64") for c in ("dst", "src", "take")}, "n_tokens": lengths[left]}))
        out = pd.concat(outs, ignore_index=True)
        for k, v in zip(keys, key):
            out[k] = v
        return out[names]

    return docs.groupBy(*keys).applyInPandas(plan_group, schema)


def rejected(docs: DataFrame, cap: int, len_col: str = "n_tokens") -> DataFrame:
    """Documents that a padding packer with ``oversize='reject'`` leaves out."""
    return docs.where(F.col(len_col) > cap)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack_rows(tokens: DataFrame, packer: str, cap: int, pad_id: int, order_cols, group_cols=(), id_col: str = "doc_id",
              ids_col: str = "ids", mask_col: str | None = None, group_tokens: int | None = None, **packer_args) -> DataFrame:
    """Rows of ``cap`` tokens from token documents.

    A packer takes at most a document's first ``cap`` tokens, so these are
    written once, with the document's length. The rule is sequential: a stream
    (one per ``group_cols``, in the order of the unique ``order_cols``) is packed
    whole, by one task that reads the sorted lengths and holds no more than the
    packer's buffer (buffered packers; the others hold all lengths). Its
    placements meet the tokens in a join, and a row is put together from its
    pieces.

    With ``group_tokens`` streams are cut into groups of so many tokens that are
    packed side by side. What groups leave goes to the next level as in
    ``pack_plans``, so one short row a stream is dropped or padded. Groups of
    level ``k`` are numbered from ``k * LEVEL``.

    Output: group columns, ``pack_group, row_no, tokens, n_content``, with
    ``mask`` if asked for (0 on padding), and ``docs`` / ``takes``: the
    documents of the row in order and how many tokens each gave."""
    group_cols, order_cols = list(group_cols), list(order_cols)
    docs = tokens.where(F.size(ids_col) > 0).select(
        *group_cols, *order_cols, F.col(id_col).cast("long").alias("_id"), F.monotonically_increasing_id().alias("_doc"), F.size(ids_col).cast("long").alias("_n"),
        F.slice(ids_col, 1, cap).cast("array<int>").alias("_ids"), *([F.slice(mask_col, 1, cap).alias("_mask")] if mask_col else []))
    docs = written(docs, "pack-tokens")
    stream = docs.select(*group_cols, *order_cols, "_doc", "_n")
    todo, placed, level, before = stream, None, 0, 0
    while True:
        grouped, groups, streams = _token_groups(todo, order_cols, group_cols, group_tokens)
        plan = _placements(grouped, packer, cap, order_cols, group_cols, level, packer_args)
        if groups > streams:
            plan = written(plan, "pack-level")
        done = plan.where("row_no is not null")
        placed = done if placed is None else placed.unionByName(done)
        if groups <= streams:
            return _rows_of(placed, docs, cap, pad_id, group_cols, bool(mask_col))
        if level and groups >= before:
            raise ValueError("group_tokens is too small: groups leave as much as they get")
        todo = stream.join(plan.where("row_no is null").select("_doc"), "_doc")
        level, before = level + 1, groups


def _token_groups(todo: DataFrame, order_cols, group_cols, group_tokens: int | None) -> tuple[DataFrame, int, int]:
    """``todo`` with the number of its group and whether its stream has no
    other; how many groups and streams there are (0 if a stream is one group)."""
    if group_tokens is None:
        return todo.withColumn("_g", F.lit(0).cast("long")).withColumn("_last", F.lit(True)), 0, 0
    at = prefix_sum(todo, [*order_cols, "_doc"], "_n", group_cols, out="_start")
    at = at.withColumn("_g", F.floor(F.col("_start") / group_tokens).cast("long")).drop("_start")
    whole = at.groupBy(*[F.col(c).alias(f"_{c}") for c in group_cols]).agg((F.max("_g") == 0).alias("_last"), F.countDistinct("_g").alias("_groups"))
    groups, streams = whole.agg(F.coalesce(F.sum("_groups"), F.lit(0)), F.count("*")).first()
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in group_cols], F.lit(True))
    return at.join(whole.drop("_groups"), same).drop(*[f"_{c}" for c in group_cols]), groups, streams


def _placements(grouped: DataFrame, packer: str, cap: int, order_cols, group_cols, level: int, packer_args: dict) -> DataFrame:
    """``pack_group, row_no, _doc, dst, take`` of every group; documents that
    are left have no ``row_no``. A task reads its sorted groups as they come."""
    by = [*group_cols, "_g"]
    kinds = T.StructType([*[grouped.schema[c] for c in group_cols], *[T.StructField(c, T.LongType()) for c in ("pack_group", "row_no", "_doc", "dst", "take")]])

    def runs(batches):
        for b in batches:
            if not b.num_rows:
                continue
            cut = np.zeros(b.num_rows - 1, bool)
            for c in by:
                x, y = b[c].slice(0, b.num_rows - 1), b[c].slice(1)
                differ = pc.fill_null(pc.not_equal(x, y), False)
                cut |= pc.or_(differ, pc.not_equal(x.is_null(), y.is_null())).to_numpy(zero_copy_only=False)
            ends = [0, *(np.flatnonzero(cut) + 1).tolist(), b.num_rows]
            names, lengths = b["_doc"].to_pylist(), b["_n"].to_pylist()
            for x, y in zip(ends[:-1], ends[1:]):
                yield (*[b[c][x].as_py() for c in by], b["_last"][x].as_py()), zip(names[x:y], lengths[x:y])

    def batch(types, key, rows):
        columns = [pa.array([v] * len(rows), t) for v, t in zip(key[:-2], types)]
        columns.append(pa.array([key[-2] + level * LEVEL] * len(rows), pa.int64()))
        return pa.RecordBatch.from_arrays([*columns, *[pa.array(c, pa.int64()) for c in zip(*rows)]], kinds.fieldNames())

    def plan(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        types = [first.schema.field(c).type for c in group_cols]
        for key, parts in groupby(runs(chain([first], batches)), key=lambda x: x[0]):
            left, out = [], []
            docs = chain.from_iterable(part for _, part in parts)
            for row_no, row in enumerate(packed_rows(packer, docs, cap, key[-1], left, **packer_args)):
                out += [(row_no, d, dst, take) for d, dst, take in row]
                if len(out) >= PLAN_BATCH:
                    yield batch(types, key, out)
                    out = []
            out += [(None, d, None, None) for d in left]
            if out:
                yield batch(types, key, out)

    rows = grouped.repartition(*by).sortWithinPartitions(*by, *order_cols, "_doc").select(*by, "_last", "_doc", "_n")
    return rows.mapInArrow(plan, kinds)


def _rows_of(placed: DataFrame, docs: DataFrame, cap: int, pad_id: int, group_cols, masked: bool) -> DataFrame:
    """Rows from placements and the documents' first tokens."""
    keys = [*group_cols, "pack_group", "row_no"]
    head = docs.select("_doc", "_id", "_ids", *([F.col("_mask").cast("array<tinyint>").alias("_mask")] if masked else []))
    # the tokens are never broadcast, whatever their files' size says
    seg = placed.join(head.hint("merge"), "_doc")
    parts = [F.col("dst"), F.slice("_ids", F.lit(1), F.col("take").cast("int")).alias("ids"), F.col("_id"), F.col("take")]
    if masked:
        parts.append(F.slice("_mask", F.lit(1), F.col("take").cast("int")).alias("mask"))
    rows = seg.select(*keys, F.struct(*parts).alias("_p")).groupBy(*keys).agg(F.array_sort(F.collect_list("_p")).alias("_p"))
    rows = rows.withColumn("tokens", F.flatten(F.col("_p.ids"))).withColumn("n_content", F.size("tokens"))
    room = F.lit(cap) - F.col("n_content")
    padded = [F.concat("tokens", F.array_repeat(F.lit(pad_id), room)).alias("tokens")]
    if masked:
        padded.append(F.concat(F.flatten(F.col("_p.mask")), F.array_repeat(F.lit(0).cast("tinyint"), room)).cast("array<int>").alias("mask"))
    return rows.select(*keys, *padded, "n_content", F.col("_p._id").alias("docs"), F.col("_p.take").alias("takes"))


def assemble_rows(plan: DataFrame, tokens: DataFrame, cap: int, pad_id: int,
                  group_cols=(), ids_col: str = "ids", mask_col: str | None = None,
                  id_col: str = "doc_id") -> DataFrame:
    """Build rows of ``cap`` tokens from a plan; short rows padded with ``pad_id``.

    Returns keys, ``row_no, tokens ARRAY<INT>, n_content INT`` and, when a mask
    column is given, ``mask ARRAY<INT>`` (0 on padding).
    """
    keys = [*group_cols, "pack_group", "row_no"]
    tok_cols = [id_col, ids_col] + ([mask_col] if mask_col else [])
    # the token side grows with the corpus and its size estimate (from the
    # text files) understates the int arrays: never broadcast it; hash the
    # placements (one small row per document) instead
    seg = plan.hint("shuffle_hash").join(tokens.select(*tok_cols), on=id_col, how="inner")
    start = F.col("src") + 1
    parts = [F.col("dst"), F.slice(ids_col, start, F.col("take")).alias("seg")]
    if mask_col:
        parts.append(F.slice(mask_col, start, F.col("take")).alias("mseg"))
    rows = (seg.select(*keys, F.struct(*parts).alias("p"))
               .groupBy(*keys)
               .agg(F.array_sort(F.collect_list("p")).alias("parts")))
    toks = F.flatten(F.transform("parts", lambda p: p["seg"]))
    rows = rows.withColumn("tokens", toks).withColumn("n_content", F.size("tokens"))
    pad_n = F.greatest(F.lit(cap) - F.col("n_content"), F.lit(0))
    out = rows.withColumn("tokens", F.concat("tokens", F.array_repeat(F.lit(pad_id), pad_n)))
    cols = [*keys, "tokens", "n_content"]
    if mask_col:
        m = F.flatten(F.transform("parts", lambda p: p["mseg"]))
        out = out.withColumn("mask", F.concat(m, F.array_repeat(F.lit(0), pad_n)))
        cols.append("mask")
    return out.select(*cols)


def chunk_plan(docs: DataFrame, cap: int, order_cols, group_cols=(),
               len_col: str = "n_tokens", id_col: str = "doc_id") -> DataFrame:
    """Plan of cutting the concatenated stream every ``cap`` tokens.

    Fully relational: stream offsets from a prefix sum, then each document
    is exploded over the rows it touches. Output has the same columns as
    ``pack_plan`` with ``pack_group = 0``.
    """
    offs = prefix_sum(docs.select(*group_cols, *order_cols, id_col, len_col)
                      if id_col not in order_cols else
                      docs.select(*group_cols, *order_cols, len_col),
                      order_cols, len_col, group_cols, out="start")
    end = F.col("start") + F.col(len_col)
    rowno = F.explode(F.sequence(F.floor(F.col("start") / cap).cast("long"),
                                 F.floor((end - 1) / cap).cast("long")))
    ex = offs.filter(F.col(len_col) > 0).select("*", rowno.alias("row_no"))
    s = F.greatest(F.col("start"), F.col("row_no") * cap)
    e = F.least(end, (F.col("row_no") + 1) * cap)
    return ex.select(*group_cols, F.lit(0).cast("long").alias("pack_group"),
                     "row_no", F.col(id_col).cast("long").alias("doc_id"),
                     (s - F.col("row_no") * cap).cast("long").alias("dst"),
                     (s - F.col("start")).cast("long").alias("src"),
                     (e - s).cast("long").alias("take"),
                     F.col(len_col).cast("long").alias("n_tokens"))


def packing_stats(plan: DataFrame, inputs: DataFrame, cap: int, group_cols=(),
                  len_col: str = "n_tokens") -> DataFrame:
    """Rows, capacity, used / input tokens, utilisation, crop % and pad %.

    ``inputs`` are the documents that entered the packer (one row each).
    Crop counts every input token that did not reach a row.
    """
    gc = list(group_cols)
    per_group = (plan.groupBy(*gc, "pack_group")
                     .agg((F.max("row_no") + 1).alias("rows"), F.sum("take").alias("used")))
    # plan side and input side meet in one aggregation (a union, not a join)
    zero = F.lit(0).cast("long")
    a = per_group.select(*gc, F.col("rows").cast("long").alias("rows"), F.col("used").cast("long").alias("used"),
                         zero.alias("input_tokens"), zero.alias("docs"))
    b = inputs.select(*gc, zero.alias("rows"), zero.alias("used"),
                      F.col(len_col).cast("long").alias("input_tokens"), F.lit(1).cast("long").alias("docs"))
    res = a.unionByName(b).groupBy(*gc).agg(*[F.sum(c).alias(c) for c in ("rows", "used", "input_tokens", "docs")])
    capacity = F.col("rows") * F.lit(cap)
    return res.select(
        *gc, F.col("docs").cast("long").alias("docs"),
        F.col("rows").cast("long").alias("rows"),
        F.col("input_tokens").cast("long").alias("input_tokens"),
        F.col("used").cast("long").alias("used_tokens"),
        F.round(F.col("used") * 100.0 / capacity, 6).alias("util_pct"),
        F.round((F.col("input_tokens") - F.col("used")) * 100.0 / F.col("input_tokens"), 6).alias("crop_pct"),
        F.round((capacity - F.col("used")) * 100.0 / capacity, 6).alias("pad_pct"),
    )


def shift_targets(rows: DataFrame, tokens_col: str = "tokens", mask_col: str | None = "mask",
                  n_content_col: str | None = "n_content") -> DataFrame:
    """inputs = row[:-1], targets = row[1:]; target -1 where the shifted mask is
    0 or the position is past the content (padding)."""
    n = F.size(tokens_col)
    inputs = F.slice(tokens_col, 1, n - 1)
    targets = F.slice(tokens_col, 2, n - 1)
    out = rows.withColumn("inputs", inputs)
    if mask_col:
        tm = F.slice(mask_col, 2, n - 1)
        targets = F.zip_with(targets, tm, lambda t, m: F.when(m == 0, F.lit(-1)).otherwise(t))
    if n_content_col:
        nc = F.col(n_content_col)
        kept = F.greatest(nc - 1, F.lit(0))
        targets = F.when(nc < n, F.concat(F.slice(targets, F.lit(1), kept), F.array_repeat(F.lit(-1), n - 1 - kept))).otherwise(targets)
    return out.withColumn("targets", targets)


def multi_epoch(df: DataFrame, n_epochs: int) -> DataFrame:
    """Replay the input ``n_epochs`` times with an ``epoch`` counter from 1;
    order by ``(epoch, <stream order>)`` downstream."""
    return df.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(n_epochs))))


def with_n_tokens(df: DataFrame, ids_col: str = "ids", out: str = "n_tokens") -> DataFrame:
    return df.withColumn(out, F.size(ids_col).cast("long"))


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x
