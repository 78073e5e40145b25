"""Registered builder queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.operators import synth as SY
from tokenmill.operators.conversations import validate_conversations
from tokenmill.operators.corpus import clean_transcript
from tokenmill.operators.packing import written
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.registry import query

WS = r"[\t\n\x{0B}\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _sql_list(xs):
    return "[" + ", ".join("'" + x.replace("'", "''") + "'" for x in xs) + "]"


def _d(seed: str, salt: str) -> str:
    return f"cast(('0x' || substr(md5(cast({seed} as varchar) || ':{salt}'), 1, 8)) as bigint)"


def _u(seed, salt):
    return f"({_d(seed, salt)} / 4294967296.0e0)"


def _nl(s: str) -> str:
    """A Python string as a DuckDB expression (newlines via chr(10))."""
    parts = s.split("\n")
    return " || chr(10) || ".join("'" + p.replace("'", "''") + "'" for p in parts)


_SQL_T = _sql_list(SY.SPELLING_TEMPLATES)
_SPELL_SQL = f"""
w as (select word, row_number() over (order by word) - 1 as wpos from (select distinct word from words) x),
n as (select count(*) as n from w),
i0 as (select w0.word as idx from w w0),
idx as (select r.i as idx, r.i as seed from (select unnest(generate_series(0, (select n from n) - 1)) as i) r),
a as (select idx, seed, w.word from idx join w on w.wpos = {_d('seed', 'word')} % (select n from n)),
b as (select *, case when {_u('seed', 'letter_source')} < 0.9e0
                     then substr(word, cast({_d('seed', 'letter')} % length(word) + 1 as bigint), 1)
                     else substr('{SY.LETTERS}', cast({_d('seed', 'letter')} % 26 + 1 as bigint), 1) end as letter
      from a),
c as (select *, cast(length(word) - length(replace(word, letter, '')) as bigint) as count,
             {_SQL_T} [cast({_d('seed', 'template')} % {len(SY.SPELLING_TEMPLATES)} + 1 as bigint)] as t0,
             ['', '''', '"'][cast({_d('seed', 'letter_quote')} % 3 + 1 as bigint)] as lq,
             ['', '''', '"'][cast({_d('seed', 'word_quote')} % 3 + 1 as bigint)] as wq
      from b),
d as (select *, case when {_u('seed', 'lower')} < 0.3e0 then lower(t0) else t0 end as tmpl from c)
select idx, word, letter, count,
  replace(replace(tmpl, '{{letter}}', lq || letter || lq), '{{word}}', wq || word || wq)
    || case when {_u('seed', 'question')} < 0.5e0 then '?' else '' end as user_msg,
  md5(replace(replace(replace({_nl(SY.SPELL_INTRO)}, '{{letter}}', letter), '{{word}}', word),
              '{{spelled}}', array_to_string(string_split(word, ''), ','))
      || array_to_string(list_transform(range(1, length(word) + 1), lambda i:
           cast(i as varchar) || ':' || substr(word, i, 1)
           || case when substr(word, i, 1) = letter
                   then ' hit! count=' || cast(length(substr(word, 1, i)) - length(replace(substr(word, 1, i), letter, '')) as varchar)
                   else '' end || chr(10)), '')
      || replace({_nl(SY.SPELL_OUTRO)}, '{{count}}', cast(count as varchar))) as manual_md5
from d"""


@query("spelling_bee_rows", oracle("with " + _SPELL_SQL.replace("i0 as (select w0.word as idx from w w0),\n", ""),
                                   "words"))
def q_spelling_bee_rows(spark, sf_dir):
    # written once: counts, samples and positions read the words, not the texts
    words = written(load(spark, sf_dir).words.select("word").distinct(), "words")
    n = words.count()
    rows = SY.spelling_bee_rows(spark.range(n).withColumnRenamed("id", "idx"), words)
    return rows.select("idx", "word", "letter", "count", "user_msg",
                       F.md5(F.get(F.col("assistant_parts"), 0)["text"]).alias("manual_md5"))


_TRANSCRIPT_SQL = rf"""
cl as (select id, title, case when length(t) < 100 then '' else t end as text from (
         select id, title, regexp_replace(regexp_replace(regexp_replace(text, '\[.*?\]', '', 'g'),
                  '{WS}+', ' ', 'g'), '^{WS}+|{WS}+$', '', 'g') as t from transcripts) a),
sp as (select id, string_split(regexp_replace(text, '([।.!?]){WS}+', '\1' || chr(1), 'g'), chr(1)) as parts from cl),
s as (select id, unnest(parts) as sent, unnest(generate_series(1, len(parts))) as i from sp),
r(id, i, chunk_no, acc) as (
  select id, i, 0, length(sent) from s where i = 1
  union all
  select s.id, s.i, case when r.acc > 400 then r.chunk_no + 1 else r.chunk_no end,
         case when r.acc > 400 then length(s.sent) else r.acc + length(s.sent) end
  from r join s on s.id = r.id and s.i = r.i + 1),
ch as (select s.id, r.chunk_no, string_agg(s.sent, ' ' order by s.i) as chunk
       from s join r on r.id = s.id and r.i = s.i group by s.id, r.chunk_no),
topic as (select id, trim(split_part(trim(split_part(title, '|', 1)), ':', 1)) as topic from cl)"""


@query("transcript_conversations", oracle(f"""
with recursive {_TRANSCRIPT_SQL}
select id, 0 as part, 'What does the video "' || title || '" talk about?' as user_msg,
       md5(substr(text, 1, 800) || case when length(text) > 800 then '...' else '' end) as assistant_md5
from cl where length(text) > 200
union all
select ch.id, ch.chunk_no + 1, 'Tell me about ' || topic.topic || ' - part ' || cast(ch.chunk_no + 1 as varchar),
       md5(ch.chunk)
from ch join topic using (id) where ch.chunk_no < 6 and length(ch.chunk) >= 80""", "transcripts"))
def q_transcript_conversations(spark, sf_dir):
    t = clean_transcript(load(spark, sf_dir).transcripts).select("id", "title", F.col("clean").alias("text"))
    c = SY.transcript_conversations(t)
    return c.select("id", F.col("part").cast("int").alias("part"), "user_msg",
                    F.md5("assistant_msg").alias("assistant_md5"))


def _elements(spark, sf_dir):
    cat = load(spark, sf_dir)
    topics = cat.part.select(F.split("p_type", " ").getItem(0).alias("category"), F.col("p_name").alias("topic"))
    personas = cat.customer.join(cat.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.concat("c_mktsegment", F.lit(" customer from "), "n_name").alias("persona"))
    dynamics = cat.orders.select(F.col("o_orderpriority").alias("dynamic"))
    openers = cat.documents.select(F.col("lang").alias("category"),
                                   F.split("text", r"\.").getItem(0).alias("text"))
    index = cat.responses.select("idx")
    return SY.sample_diversity(index, topics, personas, dynamics, openers)


_ELEM_SQL = f"""
tp as (select distinct split_part(p_type, ' ', 1) as category, p_name as topic from part),
cats as (select list_sort(list(distinct category)) as cl, count(distinct category) as n from tp),
tpos as (select *, row_number() over (partition by category order by topic) - 1 as pos,
                count(*) over (partition by category) as tn from tp),
pe as (select persona, row_number() over (order by persona) - 1 as pos, count(*) over () as n from (
         select distinct c_mktsegment || ' customer from ' || n_name as persona from customer join nation on c_nationkey = n_nationkey) x),
dy as (select dynamic, row_number() over (order by dynamic) - 1 as pos, count(*) over () as n from (
         select distinct o_orderpriority as dynamic from orders) x),
op as (select distinct lang as category, split_part(text, '.', 1) as text from documents),
opos as (select *, row_number() over (partition by category order by text) - 1 as pos,
                count(*) over (partition by category) as n from op),
ocats as (select list_sort(list(distinct category)) as cl from op),
ix as (select idx, cats.cl[cast({_d('idx', 'category')} % cats.n + 1 as bigint)] as category from responses, cats),
el as (select ix.idx, ix.category, t.topic, p.persona, d.dynamic from ix
       join (select category, max(tn) as tn from tpos group by category) tn on tn.category = ix.category
       join tpos t on t.category = ix.category and t.pos = {_d('ix.idx', 'topic')} % tn.tn
       join pe p on p.pos = {_d('ix.idx', 'persona')} % p.n
       join dy d on d.pos = {_d('ix.idx', 'dynamic')} % d.n),
oc as (select idx, unnest(list_transform(list_sort(list_transform(ocats.cl, lambda c:
             md5(cast(idx as varchar) || ':opener_category:' || c) || '|' || c)), lambda s: split_part(s, '|', 2))[1:3]) as category,
             unnest(generate_series(0, 2)) as slot
      from responses, ocats),
ox as (select oc.idx, oc.slot, o.text from oc
       join (select category, max(n) as n from opos group by category) m on m.category = oc.category
       join opos o on o.category = oc.category
        and o.pos = {_d("cast(oc.idx as varchar) || ':' || oc.category", 'opener')} % m.n),
ex as (select idx, string_agg('- ' || text, chr(10) order by slot) as first_message_examples from ox group by idx)"""


@query("sample_diversity", oracle(f"""
with {_ELEM_SQL}
select el.idx, el.category, el.topic, el.persona, el.dynamic, md5(ex.first_message_examples) as examples_md5
from el join ex using (idx)""", "responses"))
def q_sample_diversity(spark, sf_dir):
    e = _elements(spark, sf_dir)
    return e.select("idx", "category", "topic", "persona", "dynamic",
                    F.md5("first_message_examples").alias("examples_md5"))


@query("synthetic_prompts", oracle(f"""
with {_ELEM_SQL},
pr as (select el.idx, {_nl(SY.PROMPT_TEMPLATE)} as t, el.topic, el.persona,
              el.dynamic, ex.first_message_examples from el join ex using (idx)),
rs as (select idx, body, json_valid(body) and starts_with(body, '{{') as is_obj from responses),
m as (select idx, is_obj, case when is_obj then json_extract_string(body, '$.error') end as err,
             case when is_obj then cast(json_extract(body, '$.messages') as json[]) end as msgs from rs),
v as (select idx, case when not is_obj then 'not_json' when err is not null then 'api_error'
                       when msgs is null or len(msgs) < 2 then 'too_short'
                       when list_bool_or(list_transform(range(len(msgs)), lambda i:
                              (msgs[i + 1] ->> '$.role') <> case when i % 2 = 0 then 'user' else 'assistant' end)) then 'bad_role'
                       when list_bool_or(list_transform(msgs, lambda x: trim(x ->> '$.content') = '')) then 'empty_content'
                  end as reason from m)
select pr.idx, md5(replace(replace(replace(replace(t, '{{topic}}', topic), '{{persona}}', persona), '{{dynamic}}', dynamic),
                   '{{first_message_examples}}', first_message_examples)) as prompt_md5, v.reason
from pr join v using (idx)""", "responses"))
def q_synthetic_prompts(spark, sf_dir):
    e = SY.synthetic_prompts(_elements(spark, sf_dir))
    resp = SY.parse_responses(load(spark, sf_dir).responses, lambda d: validate_conversations(d, "nonblank"))
    j = e.join(resp.select("idx", "reason"), "idx")
    return j.select("idx", F.md5("prompt").alias("prompt_md5"), "reason")
