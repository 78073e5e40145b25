"""Registered rendering and packing queries."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.functions.grading import parse_tool_calls
from tokenmill.operators import packing as PK
from tokenmill.operators import render as RD
from tokenmill.operators.conversations import nest_conversations
from tokenmill.operators.corpus import split_last_shard
from tokenmill.operators.tokenizer import BOS, byte_tokens, byte_vocab, encode_bpe, special_id
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.packing_report import byte_token_lengths, packing_report
from tokenmill.plans.positions import global_position
from tokenmill.plans.q_tokenizer import trained_merges
from tokenmill.plans.registry import query

T_DOCS = 256          # row length T (rows hold T + 1 tokens) for corpus packing checks
T_CONVS = 2048        # row length for conversation packing


_HEX4 = np.array([f"{i:04X}" for i in range(1 << 16)], "S4")
_DIGEST_ROWS = 1 << 10  # lists whose digits a task holds at a time


@F.arrow_udf(T.StringType())
def _digest(ids: pa.Array) -> pa.Array:
    """md5 over ids as four hex digits each (the first four), -1 as FFFF."""
    out = []
    for lo in range(0, len(ids), _DIGEST_ROWS):
        part = ids.slice(lo, _DIGEST_ROWS)
        bounds = part.offsets.to_numpy()
        values = part.values.slice(bounds[0], bounds[-1] - bounds[0]).to_numpy()
        values = np.where(values < 0, 0xFFFF, values)
        while (wide := values > 0xFFFF).any():
            values = np.where(wide, values >> 4, values)
        digits = memoryview(_HEX4[values].tobytes())
        cuts = (4 * (bounds - bounds[0]).astype(np.int64)).tolist()
        out += [hashlib.md5(digits[x:y]).hexdigest() if given else None for x, y, given in zip(cuts[:-1], cuts[1:], part.is_valid().to_pylist())]
    return pa.array(out, pa.string())


# ids of byte tokens as four hex digits each: BOS is 0100
_HEX = "'0100' || regexp_replace(hex(encode(text)), '(..)', '00\\1', 'g')"


def _lengths(spark, sf_dir):
    return byte_token_lengths(load(spark, sf_dir).documents)


def _doc_tokens(spark, sf_dir):
    d = split_last_shard(load(spark, sf_dir).documents.select("doc_id", "source", "text"), "source")
    return d.select("doc_id", "source", "split", byte_tokens("text").alias("ids"))


_GREEDY_HEAD = """lens as (select doc_id, source, case when source = (select max(source) from documents) then 'val'
                 else 'train' end as split, octet_length(encode(text)) + 1 as n from documents),
d as (select split, n, row_number() over (partition by split order by source, doc_id) - 1 as i from lens)"""

_LEN_SQL = """lens as (select doc_id, source, case when source = (select max(source) from documents) then 'val' else 'train' end
                 as split, octet_length(encode(text)) + 1 as n from documents),
spans as (select *, cast(coalesce(sum(n) over (partition by split order by source, doc_id
                    rows between unbounded preceding and 1 preceding), 0) as bigint) as st from lens),
cut as (select split, doc_id, n, st, unnest(generate_series(st // {cap}, cast((st + n - 1) // {cap} as bigint))) as row_no
        from spans),
segs as (select split, row_no, doc_id, greatest(st, row_no * {cap}) as s, least(st + n, (row_no + 1) * {cap}) as e, st
         from cut)"""


@query("chunk_stream", oracle(f"""
with {_LEN_SQL.format(cap=T_DOCS + 1)}
select split, row_no, cast(sum(e - s) as bigint) as n_tokens, count(*) as n_docs,
       arg_min(doc_id, s) as first_doc, arg_min(s - st, s) as first_src
from segs group by split, row_no"""))
def q_chunk_stream(spark, sf_dir):
    plan = PK.chunk_plan(_lengths(spark, sf_dir), T_DOCS + 1, ["source", "doc_id"], ["split"])
    return plan.groupBy("split", "row_no").agg(
        F.sum("take").alias("n_tokens"), F.count("*").alias("n_docs"),
        F.min_by("doc_id", "dst").alias("first_doc"), F.min_by("src", "dst").alias("first_src"))


_CHUNK_ROWS_SQL = f"""
{_LEN_SQL.format(cap=T_DOCS + 1)},
hx as (select doc_id, {_HEX} as h from documents),
rows as (select split, row_no, sum(e - s) as n, string_agg(substr(h, cast(4 * (s - st) + 1 as bigint), cast(4 * (e - s) as bigint)), '' order by s) as h
         from segs join hx using (doc_id) group by split, row_no)"""


@query("chunk_stream_rows", oracle(f"""
with {_CHUNK_ROWS_SQL}
select split, row_no, cast(n as bigint) as n_content, md5(h || repeat('0100', cast({T_DOCS + 1} - n as bigint))) as tokens_md5 from rows"""))
def q_chunk_stream_rows(spark, sf_dir):
    plan = PK.chunk_plan(_lengths(spark, sf_dir), T_DOCS + 1, ["source", "doc_id"], ["split"])
    rows = PK.assemble_rows(plan, _doc_tokens(spark, sf_dir), T_DOCS + 1, BOS, ["split"])
    return rows.select("split", "row_no", F.col("n_content").cast("long").alias("n_content"), _digest("tokens").alias("tokens_md5"))


@query("shift_targets", oracle(f"""
with {_CHUNK_ROWS_SQL}
select split, row_no, cast({T_DOCS} as bigint) as n_inputs,
       cast(case when n < {T_DOCS + 1} then n - 1 else {T_DOCS} end as bigint) as n_targets,
       md5(substr(h || repeat('0100', cast({T_DOCS + 1} - n as bigint)), 1, {4 * T_DOCS})) as inputs_md5,
       md5(substr(h, 5) || repeat('FFFF', cast({T_DOCS + 1} - n as bigint))) as targets_md5
from rows"""))
def q_shift_targets(spark, sf_dir):
    """Chunked rows shifted to inputs / targets; targets past the content of
    a short (padded) row are -1."""
    plan = PK.chunk_plan(_lengths(spark, sf_dir), T_DOCS + 1, ["source", "doc_id"], ["split"])
    rows = PK.assemble_rows(plan, _doc_tokens(spark, sf_dir), T_DOCS + 1, BOS, ["split"])
    sh = PK.shift_targets(rows, mask_col=None)
    return sh.select("split", "row_no", F.size("inputs").cast("long").alias("n_inputs"),
                     F.size(F.filter("targets", lambda t: t >= 0)).cast("long").alias("n_targets"),
                     _digest("inputs").alias("inputs_md5"), _digest("targets").alias("targets_md5"))


@query("eval_token_budget", oracle(f"""
with {_LEN_SQL.format(cap=T_DOCS + 1)}
select split, row_no, cast(sum(e - s) as bigint) as n_tokens from segs
where row_no < (100000 // (4 * {T_DOCS})) * 4 group by split, row_no"""))
def q_eval_token_budget(spark, sf_dir):
    """Round a 100k-token budget down to whole steps (4 rows x T) and take
    that many rows per split."""
    budget, rows_per_step = 100_000, 4
    n_rows = (budget // (rows_per_step * T_DOCS)) * rows_per_step
    plan = PK.chunk_plan(_lengths(spark, sf_dir), T_DOCS + 1, ["source", "doc_id"], ["split"])
    return plan.filter(F.col("row_no") < n_rows).groupBy("split", "row_no").agg(F.sum("take").alias("n_tokens"))


def _plan(spark, sf_dir, packer, T=T_DOCS, **kw):
    lengths = _lengths(spark, sf_dir)
    grouped = PK.assign_pack_groups(lengths, ["source", "doc_id"], ["split"])
    return lengths, PK.pack_plan(grouped, packer, T + 1, ["split"], **kw)


_GREEDY_CROP_SQL = f"""
with recursive {_GREEDY_HEAD},
r(split, i, row_no, fill, take) as (
  select split, i, 0, least(n, {{cap}}), least(n, {{cap}}) from d where i = 0
  union all
  select d.split, d.i,
         case when r.fill = {{cap}} then r.row_no + 1 else r.row_no end,
         (case when r.fill = {{cap}} then 0 else r.fill end)
           + least(d.n, {{cap}} - case when r.fill = {{cap}} then 0 else r.fill end),
         least(d.n, {{cap}} - case when r.fill = {{cap}} then 0 else r.fill end)
  from r join d on d.split = r.split and d.i = r.i + 1),
full_rows as (select split, row_no from r group by split, row_no having max(fill) = {{cap}}),
st as (select r.split, count(distinct r.row_no) as rows, sum(r.take) as used from r
       join full_rows f on f.split = r.split and f.row_no = r.row_no group by r.split),
tin as (select split, count(*) as docs, sum(n) as input_tokens from d group by split)
select tin.split, tin.docs, cast(coalesce(st.rows, 0) as bigint) as rows, cast(tin.input_tokens as bigint) as input_tokens,
       cast(coalesce(st.used, 0) as bigint) as used_tokens,
       round(st.used * 100.0e0 / (st.rows * {{cap}}), 6) as util_pct,
       round((tin.input_tokens - st.used) * 100.0e0 / tin.input_tokens, 6) as crop_pct,
       round((st.rows * {{cap}} - st.used) * 100.0e0 / (st.rows * {{cap}}), 6) as pad_pct
from tin join st on st.split = tin.split"""

_GREEDY_PAD_SQL = f"""
with recursive {_GREEDY_HEAD},
r(split, i, row_no, fill, take) as (
  select split, i, 0, least(n, {{cap}}), least(n, {{cap}}) from d where i = 0
  union all
  select d.split, d.i,
         case when least(d.n, {{cap}}) > {{cap}} - r.fill then r.row_no + 1 else r.row_no end,
         case when least(d.n, {{cap}}) > {{cap}} - r.fill then least(d.n, {{cap}}) else r.fill + least(d.n, {{cap}}) end,
         least(d.n, {{cap}})
  from r join d on d.split = r.split and d.i = r.i + 1),
st as (select split, max(row_no) + 1 as rows, sum(take) as used from r group by split),
tin as (select split, count(*) as docs, sum(n) as input_tokens from d group by split)
select tin.split, tin.docs, cast(st.rows as bigint) as rows, cast(tin.input_tokens as bigint) as input_tokens,
       cast(st.used as bigint) as used_tokens,
       round(st.used * 100.0e0 / (st.rows * {{cap}}), 6) as util_pct,
       round((tin.input_tokens - st.used) * 100.0e0 / tin.input_tokens, 6) as crop_pct,
       round((st.rows * {{cap}} - st.used) * 100.0e0 / (st.rows * {{cap}}), 6) as pad_pct
from tin join st on st.split = tin.split"""


_BESTFIT_REFILL = "case when len(st.buf) < 1000 and st.nxt < docs.cnt then least(docs.cnt, st.nxt + 128 * cast(ceil((1000 - len(st.buf)) / 128.0) as bigint)) else st.nxt end"
_BESTFIT_CROP_SQL = f"""
with recursive {_GREEDY_HEAD},
docs as (select split, list(struct_pack(len := n, idx := i) order by i) as dl, count(*) as cnt from d group by split),
st(split, buf, nxt, pos, rows) as (
  select split, list_filter([struct_pack(len := 0::bigint, idx := 0::bigint)], lambda x: false), 0::bigint, 0::bigint,
         0::bigint from docs
  union all
  select split, list_filter(buf1, lambda x: x.idx <> pick_idx), rn,
         case when pos + take = {{cap}} then 0 else pos + take end,
         case when pos + take = {{cap}} then rows + 1 else rows end
  from (
    select *, coalesce(fit_len, {{cap}} - pos) as take,
              list_min(list_transform(list_filter(buf1, lambda x: x.len = coalesce(fit_len, short_len)),
                                      lambda x: x.idx)) as pick_idx
    from (
      select *, list_max(list_transform(list_filter(buf1, lambda x: x.len <= {{cap}} - pos), lambda x: x.len)) as fit_len,
                list_min(list_transform(buf1, lambda x: x.len)) as short_len
      from (
        select st.split, st.pos, st.rows, {_BESTFIT_REFILL} as rn,
               st.buf || docs.dl[st.nxt + 1:{_BESTFIT_REFILL}] as buf1
        from st join docs using (split)) a
      where len(buf1) > 0) b) c),
fin as (select split, max(rows) as rows from st group by split),
tin as (select split, count(*) as docs, sum(n) as input_tokens from d group by split)
select tin.split, tin.docs, cast(fin.rows as bigint) as rows, cast(tin.input_tokens as bigint) as input_tokens,
       cast(fin.rows * {{cap}} as bigint) as used_tokens, 100.0e0 as util_pct,
       round((tin.input_tokens - fin.rows * {{cap}}) * 100.0e0 / tin.input_tokens, 6) as crop_pct, 0.0e0 as pad_pct
from tin join fin using (split)"""


_BESTFIT_CROP_PLAN_SQL = f"""
with recursive {_GREEDY_HEAD},
docs as (select split, list(struct_pack(len := n, idx := i) order by i) as dl, count(*) as cnt from d group by split),
st(split, buf, nxt, pos, rows, p_row, p_dst, p_idx, p_take) as (
  select split, list_filter([struct_pack(len := 0::bigint, idx := 0::bigint)], lambda x: false), 0::bigint, 0::bigint,
         0::bigint, null::bigint, null::bigint, null::bigint, null::bigint from docs
  union all
  select split, list_filter(buf1, lambda x: x.idx <> pick_idx), rn,
         case when pos + take = {{cap}} then 0 else pos + take end,
         case when pos + take = {{cap}} then rows + 1 else rows end,
         rows, pos, pick_idx, take
  from (
    select *, coalesce(fit_len, {{cap}} - pos) as take,
              list_min(list_transform(list_filter(buf1, lambda x: x.len = coalesce(fit_len, short_len)),
                                      lambda x: x.idx)) as pick_idx
    from (
      select *, list_max(list_transform(list_filter(buf1, lambda x: x.len <= {{cap}} - pos), lambda x: x.len)) as fit_len,
                list_min(list_transform(buf1, lambda x: x.len)) as short_len
      from (
        select st.split, st.pos, st.rows, {_BESTFIT_REFILL} as rn,
               st.buf || docs.dl[st.nxt + 1:{_BESTFIT_REFILL}] as buf1
        from st join docs using (split)) a
      where len(buf1) > 0) b) c),
fin as (select split, max(rows) as rows from st group by split)
select st.split, st.p_row as row_no, st.p_dst as dst, st.p_idx as doc_pos, st.p_take as take
from st join fin using (split) where st.p_idx is not null and st.p_row < fin.rows"""


@query("pack_bestfit_crop_plan", oracle(_BESTFIT_CROP_PLAN_SQL.format(cap=T_DOCS + 1)))
def q_pack_bestfit_crop_plan(spark, sf_dir):
    """Exact best-fit crop placements: (row, offset, document stream
    position, tokens taken) for every complete row."""
    lengths = _lengths(spark, sf_dir)
    grouped = PK.assign_pack_groups(lengths, ["source", "doc_id"], ["split"])
    plan = PK.pack_plan(grouped, "bestfit_crop", T_DOCS + 1, ["split"], buffer_size=1000)
    j = plan.join(grouped.select("split", "doc_id", "pos"), ["split", "doc_id"])
    return j.select("split", "row_no", "dst", F.col("pos").alias("doc_pos"), "take")


@query("pack_bestfit_crop_rows", oracle(_BESTFIT_CROP_PLAN_SQL.format(cap=T_DOCS + 1).replace("with recursive", f"""with recursive hx as (
  select split, row_number() over (partition by split order by source, doc_id) - 1 as i, h from (
    select source, doc_id, case when source = (select max(source) from documents) then 'val' else 'train' end as split, {_HEX} as h from documents) t),
placed as (with recursive""", 1) + f"""),
rows as (select split, row_no, count(*) as n_docs, string_agg(substr(h, 1, cast(4 * take as bigint)), '' order by dst) as h
         from placed join hx using (split) where hx.i = placed.doc_pos group by split, row_no)
select split, cast(0 as bigint) as pack_group, row_no, n_docs, md5(substr(h, 1, {4 * T_DOCS})) as inputs_md5, md5(substr(h, 5)) as targets_md5 from rows"""))
def q_pack_bestfit_crop_rows(spark, sf_dir):
    """Best-fit crop rows of byte tokens, shifted to inputs and targets."""
    rows = PK.pack_rows(_doc_tokens(spark, sf_dir), "bestfit_crop", T_DOCS + 1, BOS, ["source", "doc_id"], ["split"], buffer_size=1000)
    return PK.shift_targets(rows, mask_col=None).select(
        "split", "pack_group", "row_no", F.size("docs").cast("long").alias("n_docs"),
        _digest("inputs").alias("inputs_md5"), _digest("targets").alias("targets_md5"))


@query("bpe_pack_rows")
def q_bpe_pack_rows(spark, sf_dir):
    """Pretraining rows end to end: all documents with BOS in the trained
    vocabulary, best-fit crop, inputs and targets."""
    merges = trained_merges(spark, sf_dir)
    docs = split_last_shard(load(spark, sf_dir).documents.select("doc_id", "source", "text"), "source")
    # written once: cuts and rows read the same ids
    ids = PK.written(encode_bpe(docs, merges, keep=("source", "split")), "bpe-ids")
    rows = PK.pack_rows(ids, "bestfit_crop", T_CONVS + 1, special_id("<|bos|>", len(merges)), ["source", "doc_id"], ["split"], buffer_size=1000)
    return PK.shift_targets(rows, mask_col=None).select("split", "pack_group", "row_no", "n_content", "docs", "takes", "inputs", "targets")


@query("pack_bestfit_crop", oracle(_BESTFIT_CROP_SQL.format(cap=T_DOCS + 1)))
def q_pack_bestfit_crop(spark, sf_dir):
    """Best-fit crop plan statistics (buffer 1000, refills of 128)."""
    lengths, plan = _plan(spark, sf_dir, "bestfit_crop", buffer_size=1000)
    return PK.packing_stats(plan, lengths, T_DOCS + 1, ["split"])


_FFD_SQL = f"""
with recursive {_GREEDY_HEAD},
o as (select split, least(n, {{cap}}) as l, row_number() over (partition by split order by least(n, {{cap}}) desc, i) as k
      from d),
f(split, k, fills) as (
  select split, 0::bigint, list_filter([0::bigint], lambda x: false) from (select distinct split from d) s
  union all
  select f.split, f.k + 1,
         case when list_position(list_transform(f.fills, lambda x: x + o.l <= {{cap}}), true) is null
              then list_append(f.fills, o.l)
              else list_transform(list_zip(f.fills, range(1, len(f.fills) + 1)), lambda z:
                     case when z[2] = list_position(list_transform(f.fills, lambda x: x + o.l <= {{cap}}), true)
                          then z[1] + o.l else z[1] end) end
  from f join o on o.split = f.split and o.k = f.k + 1),
fin as (select split, arg_max(len(fills), k) as rows from f group by split),
tin as (select split, count(*) as docs, sum(n) as input_tokens, sum(least(n, {{cap}})) as used from d group by split)
select tin.split, tin.docs, cast(fin.rows as bigint) as rows, cast(tin.input_tokens as bigint) as input_tokens,
       cast(tin.used as bigint) as used_tokens,
       round(tin.used * 100.0e0 / (fin.rows * {{cap}}), 6) as util_pct,
       round((tin.input_tokens - tin.used) * 100.0e0 / tin.input_tokens, 6) as crop_pct,
       round((fin.rows * {{cap}} - tin.used) * 100.0e0 / (fin.rows * {{cap}}), 6) as pad_pct
from tin join fin using (split)"""


@query("pack_greedy_crop", oracle(_GREEDY_CROP_SQL.format(cap=T_DOCS + 1)))
def q_pack_greedy_crop(spark, sf_dir):
    lengths, plan = _plan(spark, sf_dir, "greedy_crop")
    return PK.packing_stats(plan, lengths, T_DOCS + 1, ["split"])


@query("pack_greedy_pad", oracle(_GREEDY_PAD_SQL.format(cap=T_DOCS + 1)))
def q_pack_greedy_pad(spark, sf_dir):
    lengths, plan = _plan(spark, sf_dir, "greedy_pad")
    return PK.packing_stats(plan, lengths, T_DOCS + 1, ["split"])


@query("pack_ffd", oracle(_FFD_SQL.format(cap=T_DOCS + 1)))
def q_pack_ffd(spark, sf_dir):
    lengths, plan = _plan(spark, sf_dir, "ffd")
    return PK.packing_stats(plan, lengths, T_DOCS + 1, ["split"])


def _report_sql(cap: int) -> str:
    """The report's rows by the rules of the single packers."""
    chunk = f"""with {_LEN_SQL.format(cap=cap)},
tin as (select split, count(*) as docs, sum(n) as input_tokens, cast(ceil(sum(n) / {cap}.0e0) as bigint) as rows from lens group by split)
select split, docs, rows, cast(input_tokens as bigint) as input_tokens, cast(input_tokens as bigint) as used_tokens,
       round(input_tokens * 100.0e0 / (rows * {cap}), 6) as util_pct, 0.0e0 as crop_pct,
       round((rows * {cap} - input_tokens) * 100.0e0 / (rows * {cap}), 6) as pad_pct from tin"""
    parts = {"chunk": chunk, "bestfit_crop": _BESTFIT_CROP_SQL, "greedy_crop": _GREEDY_CROP_SQL, "greedy_pad": _GREEDY_PAD_SQL, "ffd": _FFD_SQL}
    return "\nunion all by name\n".join(f"select '{name}' as packer, * from ({sql if name == 'chunk' else sql.format(cap=cap)}) {name}" for name, sql in parts.items())


@query("packing_report", oracle(_report_sql(2049)))
def q_packing_report(spark, sf_dir):
    return packing_report(load(spark, sf_dir).documents)


# ------------------------------------------------------------ rendering --

def _rendered(spark, sf_dir, **kw):
    convs = nest_conversations(load(spark, sf_dir).conversations)
    return RD.render_conversations(convs, **kw)


_RENDER_SQL = """
c0 as (select conv_id, turn, role, octet_length(encode(text)) as len from conversations),
sys as (select conv_id, len as slen from c0 where turn = 0 and role = 'system'),
m as (select c0.conv_id, c0.turn, c0.role,
             c0.len + case when c0.turn = 1 and sys.slen is not null then sys.slen + 2 else 0 end as len
      from c0 left join sys on sys.conv_id = c0.conv_id
      where not (c0.turn = 0 and c0.role = 'system')),
seg as (select conv_id, turn, 0 as k, case when role = 'user' then len + 2 else 1 end as n, 0 as mask from m
        union all select conv_id, turn, 1, len + 1, 1 from m where role = 'assistant'),
pos as (select *, 1 + coalesce(sum(n) over (partition by conv_id order by turn, k
                  rows between unbounded preceding and 1 preceding), 0) as st from seg)"""


# ids as four hex digits each, and the mask as one digit each
_RENDER_IDS_SQL = f"""
t0 as (select conv_id, turn, role, text from conversations),
ts as (select conv_id, text as head from t0 where turn = 0 and role = 'system'),
tm as (select t0.conv_id, t0.turn, t0.role, case when t0.turn = 1 and ts.head is not null then ts.head || chr(10) || chr(10) || t0.text else t0.text end as text
       from t0 left join ts on ts.conv_id = t0.conv_id where not (t0.turn = 0 and t0.role = 'system')),
tx as (select conv_id, turn, role, regexp_replace(hex(encode(text)), '(..)', '00\\1', 'g') as h, octet_length(encode(text)) as n from tm),
rendered as (select conv_id,
    substr('0100' || string_agg(case when role = 'user' then '0101' || h || '0102' else '0103' || h || '0104' end, '' order by turn), 1, {4 * RD.MAX_TOKENS}) as h,
    substr('0' || string_agg(case when role = 'user' then repeat('0', n + 2) else '0' || repeat('1', n + 1) end, '' order by turn), 1, {RD.MAX_TOKENS}) as m
  from tx group by conv_id)"""


@query("render_conversation", oracle(f"""
with {_RENDER_IDS_SQL}
select conv_id, cast(length(m) as bigint) as n_tokens, cast(length(replace(m, '0', '')) as bigint) as mask_sum, md5(h) as ids_md5, md5(m) as mask_md5
from rendered"""))
def q_render_conversation(spark, sf_dir):
    r = _rendered(spark, sf_dir)
    return r.select("conv_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"),
                    _digest("ids").alias("ids_md5"), F.md5(F.array_join("mask", "")).alias("mask_md5"))


@query("render_for_completion", oracle(f"""
with c as (select conv_id, count(*) as n, arg_max(role, turn) as last_role from conversations group by conv_id),
c0 as (select conv_id, turn, role, octet_length(encode(text)) as len from conversations
       where (conv_id, turn) not in (select conv_id, n - 1 from c)),
sys as (select conv_id, len as slen from c0 where turn = 0 and role = 'system'),
m as (select c0.conv_id, c0.turn, c0.role,
             c0.len + case when c0.turn = 1 and sys.slen is not null then sys.slen + 2 else 0 end as len
      from c0 left join sys on sys.conv_id = c0.conv_id where not (c0.turn = 0 and c0.role = 'system'))
select c.conv_id, cast(case when c.last_role = 'assistant'
                         then least(1 + coalesce(sum(m.len + 2), 0), {RD.MAX_TOKENS}) + 1 end as bigint) as n_tokens
from c left join m on m.conv_id = c.conv_id group by c.conv_id, c.last_role"""))
def q_render_for_completion(spark, sf_dir):
    r = _rendered(spark, sf_dir, for_completion=True)
    return r.select("conv_id", F.size("ids").cast("long").alias("n_tokens"))


def _tool_convs(spark, sf_dir):
    t = load(spark, sf_dir).tool_text
    msgs = F.array(
        F.struct(F.lit("user").alias("role"),
                 F.array(F.struct(F.lit("text").alias("type"),
                                  F.concat(F.lit("Problem "), F.col("problem_id").cast("string")).alias("text")))
                 .alias("parts")),
        F.struct(F.lit("assistant").alias("role"), parse_tool_calls("answer").alias("parts")))
    return t.select(F.col("problem_id").alias("conv_id"), msgs.alias("messages"))


@query("render_tool_conversation", oracle("""
with p as (select problem_id, regexp_split_to_array(answer, '<<[^>]+>>') as texts,
                  regexp_extract_all(answer, '<<([^>]+)>>', 1) as tags from tool_text),
t as (select problem_id, unnest(texts) as text from p),
g as (select problem_id, unnest(tags) as tag from p),
tl as (select problem_id, sum(octet_length(encode(text))) as tlen from t group by problem_id),
gl as (select problem_id,
         sum(octet_length(encode(case when strpos(tag, '=') > 0 then regexp_extract(tag, '(?s)^(.*)=(.*)$', 1) else tag end)) + 2) as py,
         sum(octet_length(encode(case when strpos(tag, '=') > 0 then regexp_extract(tag, '(?s)^(.*)=(.*)$', 2) else '' end)) + 2) as outp
       from g group by problem_id)
select tl.problem_id as conv_id,
  cast(1 + (octet_length(encode('Problem ' || cast(tl.problem_id as varchar))) + 2) + 1 + tlen + coalesce(py, 0)
       + coalesce(outp, 0) + 1 as bigint) as n_tokens,
  cast(tlen + coalesce(py, 0) + 1 as bigint) as mask_sum
from tl left join gl using (problem_id)""", "tool_text"))
def q_render_tool_conversation(spark, sf_dir):
    r = RD.render_conversations(_tool_convs(spark, sf_dir), has_parts=True)
    return r.select("conv_id", F.size("ids").cast("long").alias("n_tokens"),
                    F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))


@query("drop_unusable_examples", oracle(f"""
with {_RENDER_SQL},
lens as (select conv_id, cast(least(1 + sum(n), {RD.MAX_TOKENS}) as bigint) as n_tokens,
                cast(sum(case when mask = 1 then greatest(0, least(st + n, {RD.MAX_TOKENS}) - st) else 0 end) as bigint)
                  as mask_sum
         from pos group by conv_id)
select conv_id, n_tokens from lens where n_tokens >= 4 and mask_sum > 0"""))
def q_drop_unusable_examples(spark, sf_dir):
    """All conversations, and the first message of each on its own, which has
    no answer to learn from and must go."""
    d = load(spark, sf_dir).conversations
    alone = d.filter("turn = 0").withColumn("conv_id", -F.col("conv_id") - 1)
    r = RD.render_conversations(nest_conversations(d.unionByName(alone)))
    return RD.drop_unusable_examples(r.filter(F.col("reason").isNull())).select(
        "conv_id", F.size("ids").cast("long").alias("n_tokens"))


@query("mask_breakdown", oracle(f"""
with {_RENDER_IDS_SQL},
p as (select conv_id, h, m, unnest(range(0, cast(length(m) as bigint))) as pos from rendered),
k as (select conv_id, pos, cast('0x' || substr(h, cast(4 * pos + 1 as bigint), 4) as int) as token_id, cast(substr(m, cast(pos + 1 as bigint), 1) as int) as mask,
             substr(h, cast(4 * pos + 3 as bigint), 2) as low from p)
select token_id, conv_id, cast(pos as int) as pos, mask, case when token_id < 256 then low end as token_hex from k"""))
def q_mask_breakdown(spark, sf_dir):
    return RD.mask_breakdown(_rendered(spark, sf_dir).filter(F.col("reason").isNull()), byte_vocab(spark))


@query("pad_right", oracle(f"""
with {_RENDER_SQL},
lens as (select conv_id, cast(least(1 + sum(n), {RD.MAX_TOKENS}) as bigint) as n_tokens,
                cast(sum(case when mask = 1 then greatest(0, least(st + n, {RD.MAX_TOKENS}) - st) else 0 end) as bigint)
                  as mask_sum
         from pos group by conv_id),
b as (select *, (row_number() over (order by conv_id) - 1) // 8 as batch from lens)
select conv_id, cast(batch as bigint) as batch, max(n_tokens) over (partition by batch) as n_tokens, mask_sum from b"""))
def q_pad_right(spark, sf_dir):
    # written once: positions, lengths and rows read the same ids
    r = PK.written(_rendered(spark, sf_dir).filter(F.col("reason").isNull()), "rendered")
    at = global_position(r.select(F.col("conv_id").alias("_id")), ["_id"], (), out="row_id")
    r = r.join(at.hint("shuffle_hash"), F.col("conv_id").eqNullSafe(F.col("_id")))
    p = RD.pad_batches(r, 8, BOS)
    return p.select("conv_id", F.col("batch").cast("long").alias("batch"), F.size("ids").cast("long").alias("n_tokens"),
                    F.aggregate("mask", F.lit(0).cast("long"), lambda a, x: a + x).alias("mask_sum"))


_PAD_REFILL = ("case when len(st.buf) < 100 and st.nxt < docs.cnt "
               "then least(docs.cnt, st.nxt + 100 - len(st.buf)) else st.nxt end")
_BESTFIT_PAD_SQL = f"""
with recursive {_RENDER_SQL},
lens as (select conv_id, cast(least(1 + sum(n), {RD.MAX_TOKENS}) as bigint) as n from pos group by conv_id),
d as (select 'train' as split, n, row_number() over (order by conv_id) - 1 as i from lens),
docs as (select split, list(struct_pack(len := least(n, {T_CONVS + 1}), idx := i) order by i) as dl,
                count(*) as cnt from d group by split),
st(split, k, buf, nxt, pos, rows) as (
  select split, 0::bigint, list_filter([struct_pack(len := 0::bigint, idx := 0::bigint)], lambda x: false),
         0::bigint, 0::bigint, 0::bigint from docs
  union all
  select split, k + 1, case when fit_len is null then buf1 else list_filter(buf1, lambda x: x.idx <> pick_idx) end, rn,
         case when fit_len is null or pos + fit_len = {T_CONVS + 1} then 0 else pos + fit_len end,
         case when fit_len is null or pos + fit_len = {T_CONVS + 1} then rows + 1 else rows end
  from (
    select *, list_min(list_transform(list_filter(buf1, lambda x: x.len = fit_len), lambda x: x.idx)) as pick_idx
    from (
      select *, list_max(list_transform(list_filter(buf1, lambda x: x.len <= {T_CONVS + 1} - pos),
                                        lambda x: x.len)) as fit_len
      from (
        select st.split, st.k, st.pos, st.rows, {_PAD_REFILL} as rn,
               st.buf || docs.dl[st.nxt + 1:{_PAD_REFILL}] as buf1
        from st join docs using (split)) a
      where len(buf1) > 0) b) c),
fin as (select split, arg_max(rows + case when pos > 0 then 1 else 0 end, k) as rows from st group by split),
tin as (select split, count(*) as docs, sum(n) as input_tokens, sum(least(n, {T_CONVS + 1})) as used from d group by split)
select tin.split, tin.docs, cast(fin.rows as bigint) as rows, cast(tin.input_tokens as bigint) as input_tokens,
       cast(tin.used as bigint) as used_tokens,
       round(tin.used * 100.0e0 / (fin.rows * {T_CONVS + 1}), 6) as util_pct,
       round((tin.input_tokens - tin.used) * 100.0e0 / tin.input_tokens, 6) as crop_pct,
       round((fin.rows * {T_CONVS + 1} - tin.used) * 100.0e0 / (fin.rows * {T_CONVS + 1}), 6) as pad_pct
from tin join fin using (split)"""


@query("pack_bestfit_pad", oracle(_BESTFIT_PAD_SQL))
def q_pack_bestfit_pad(spark, sf_dir):
    """Best-fit pad plan statistics over rendered conversations (T=2048,
    buffer 100, oversize conversations truncated to a row)."""
    r = _rendered(spark, sf_dir).filter(F.col("reason").isNull())
    r = r.select(F.col("conv_id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
                 F.lit("train").alias("split"))
    g = PK.assign_pack_groups(r, ["doc_id"], ["split"])
    plan = PK.pack_plan(g, "bestfit_pad", T_CONVS + 1, ["split"], buffer_size=100, oversize="truncate")
    return PK.packing_stats(plan, r, T_CONVS + 1, ["split"])


_BESTFIT_PAD_ROWS_SQL = f"""
with recursive {_RENDER_IDS_SQL},
d as (select h, m, cast(length(m) as bigint) as n, row_number() over (order by conv_id) - 1 as i from rendered),
docs as (select list(struct_pack(len := n, idx := i) order by i) as dl, count(*) as cnt from d),
st(k, buf, nxt, pos, rows, p_row, p_dst, p_idx) as (
  select 0::bigint, list_filter([struct_pack(len := 0::bigint, idx := 0::bigint)], lambda x: false),
         0::bigint, 0::bigint, 0::bigint, null::bigint, null::bigint, null::bigint from docs
  union all
  select k + 1, case when fit_len is null then buf1 else list_filter(buf1, lambda x: x.idx <> pick_idx) end, rn,
         case when fit_len is null or pos + fit_len = {T_CONVS + 1} then 0 else pos + fit_len end,
         case when fit_len is null or pos + fit_len = {T_CONVS + 1} then rows + 1 else rows end,
         case when fit_len is not null then rows end, pos, case when fit_len is not null then pick_idx end
  from (
    select *, list_min(list_transform(list_filter(buf1, lambda x: x.len = fit_len), lambda x: x.idx)) as pick_idx
    from (
      select *, list_max(list_transform(list_filter(buf1, lambda x: x.len <= {T_CONVS + 1} - pos), lambda x: x.len)) as fit_len
      from (
        select st.k, st.pos, st.rows, {_PAD_REFILL} as rn, st.buf || docs.dl[st.nxt + 1:{_PAD_REFILL}] as buf1
        from st, docs) a
      where len(buf1) > 0) b) c),
packed as (select p_row as row_no, count(*) as n_docs, sum(n) as n_content, string_agg(h, '' order by p_dst) as h, string_agg(m, '' order by p_dst) as m
           from st join d on d.i = st.p_idx group by p_row),
padded as (select row_no, n_docs, n_content, h || repeat('0100', cast({T_CONVS + 1} - n_content as bigint)) as h,
                  m || repeat('0', cast({T_CONVS + 1} - n_content as bigint)) as m from packed)
select 'train' as split, cast(0 as bigint) as pack_group, row_no, n_docs, cast(n_content as bigint) as n_content, md5(substr(h, 1, {4 * T_CONVS})) as inputs_md5,
       md5(array_to_string(list_transform(range(2, {T_CONVS + 2}), lambda p: case when substr(m, p, 1) = '1' then substr(h, 4 * p - 3, 4) else 'FFFF' end), '')) as targets_md5
from padded"""


def _sft_rows(rendered, pad_id):
    """Rendered conversations as best-fit padded rows of inputs and targets."""
    r = rendered.filter(F.col("reason").isNull()).withColumn("split", F.lit("train"))
    return PK.shift_targets(PK.pack_rows(r, "bestfit_pad", T_CONVS + 1, pad_id, ["conv_id"], ["split"], id_col="conv_id",
                                         mask_col="mask", buffer_size=100, oversize="truncate"))


@query("pack_bestfit_pad_rows", oracle(_BESTFIT_PAD_ROWS_SQL))
def q_pack_bestfit_pad_rows(spark, sf_dir):
    return _sft_rows(_rendered(spark, sf_dir), BOS).select(
        "split", "pack_group", "row_no", F.size("docs").cast("long").alias("n_docs"), F.col("n_content").cast("long").alias("n_content"),
        _digest("inputs").alias("inputs_md5"), _digest("targets").alias("targets_md5"))


@query("bpe_sft_rows")
def q_bpe_sft_rows(spark, sf_dir):
    """Chat training rows end to end: conversations rendered in the trained
    vocabulary with their loss mask, packed, padded and shifted."""
    merges = trained_merges(spark, sf_dir)
    rendered = PK.written(_rendered(spark, sf_dir, merges=merges), "bpe-rendered")
    rows = _sft_rows(rendered, special_id("<|bos|>", len(merges)))
    return rows.select("split", "pack_group", "row_no", "n_content", "docs", "takes", "inputs", "targets")
