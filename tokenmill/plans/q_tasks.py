"""Registered task-builder and grading queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tokenmill.functions import grading as G
from tokenmill.plans.catalog import load, oracle
from tokenmill.plans.positions import global_position, seeded_int, seeded_key
from tokenmill.plans.registry import query

# DuckDB spelling of F1 (RE2 lacks nothing needed here)
_EXTRACT = "case when regexp_matches({c}, '#### (-?[0-9.,]+)') then replace(regexp_extract({c}, '#### (-?[0-9.,]+)', 1), ',', '') end"
_LAST_TEXT = "regexp_split_to_array(answer, '<<[^>]+>>')[-1]"


@query("extract_answer", oracle(f"""
select problem_id, k, {_EXTRACT.format(c='completion')} as pred from completions""", "completions"))
def q_extract_answer(spark, sf_dir):
    d = load(spark, sf_dir).completions
    return d.select("problem_id", "k", G.extract_answer("completion").alias("pred"))


@query("grade_numeric", oracle(f"""
select problem_id, k, ref, pred, ref is not distinct from pred as is_correct,
       case when ref is not distinct from pred then 1.0e0 else 0.0e0 end as reward
from (select problem_id, k, {_EXTRACT.format(c=_LAST_TEXT)} as ref, {_EXTRACT.format(c='completion')} as pred
      from completions) t""", "completions"))
def q_grade_numeric(spark, sf_dir):
    d = load(spark, sf_dir).completions
    ref = G.extract_answer(G.last_text_part("answer"))
    pred = G.extract_answer("completion")
    ok = ref.eqNullSafe(pred)
    return d.select("problem_id", "k", ref.alias("ref"), pred.alias("pred"), ok.alias("is_correct"),
                    F.when(ok, 1.0).otherwise(0.0).alias("reward"))


_PARTS_SQL = """
p as (select problem_id, regexp_split_to_array(answer, '<<[^>]+>>') as texts,
             regexp_extract_all(answer, '<<([^>]+)>>', 1) as tags from tool_text),
t as (select problem_id, unnest(texts) as text, unnest(generate_series(0, len(texts) - 1)) as i from p),
g as (select problem_id, unnest(tags) as tag, unnest(generate_series(0, len(tags) - 1)) as i from p),
parts as (
  select problem_id, 3 * i as part_no, 'text' as type, text from t
  union all
  select problem_id, 3 * i + 1, 'python',
         case when strpos(tag, '=') > 0 then regexp_extract(tag, '(?s)^(.*)=(.*)$', 1) else tag end from g
  union all
  select problem_id, 3 * i + 2, 'python_output',
         case when strpos(tag, '=') > 0 then regexp_extract(tag, '(?s)^(.*)=(.*)$', 2) else '' end from g)"""


@query("parse_tool_calls", oracle(f"""
with {_PARTS_SQL}
select problem_id, cast(part_no as bigint) as part_no, type, text from parts""", "tool_text"))
def q_parse_tool_calls(spark, sf_dir):
    d = load(spark, sf_dir).tool_text
    p = d.select("problem_id", F.posexplode(G.parse_tool_calls("answer")).alias("part_no", "part"))
    return p.select("problem_id", F.col("part_no").cast("long").alias("part_no"),
                    F.col("part.type").alias("type"), F.col("part.text").alias("text"))


@query("verify_tool_calls", oracle(f"""
with {_PARTS_SQL},
calls as (select c.problem_id, c.part_no, replace(c.text, ',', '') as expr, o.text as expected
          from parts c join parts o on o.problem_id = c.problem_id and o.part_no = c.part_no + 1
          where c.type = 'python'),
ev as (select *, case
  when regexp_matches(expr, '^[0-9]+\\*[0-9]+$') then cast(cast(split_part(expr, '*', 1) as bigint) * cast(split_part(expr, '*', 2) as bigint) as varchar)
  when regexp_matches(expr, '^[0-9]+\\+[0-9]+$') then cast(cast(split_part(expr, '+', 1) as bigint) + cast(split_part(expr, '+', 2) as bigint) as varchar)
  when regexp_matches(expr, '^[0-9]+$') then cast(cast(expr as bigint) as varchar)
  when regexp_matches(expr, '^''[a-z]*''\\.count\\(''[a-z]+''\\)$') then cast(
       (length(regexp_extract(expr, '^''([a-z]*)''', 1)) - length(replace(regexp_extract(expr, '^''([a-z]*)''', 1),
         regexp_extract(expr, '\\(''([a-z]+)''\\)$', 1), ''))) // length(regexp_extract(expr, '\\(''([a-z]+)''\\)$', 1)) as varchar)
  end as computed from calls)
select problem_id, cast((part_no - 1) / 3 as bigint) as call_no, expr, expected, computed,
       coalesce(computed = expected, false) as ok
from ev""", "tool_text"))
def q_verify_tool_calls(spark, sf_dir):
    d = load(spark, sf_dir).tool_text.select("problem_id", G.parse_tool_calls("answer").alias("parts"))
    # a call and its result stand next to each other in the same array
    steps = F.transform("parts", lambda p, i: F.struct(i.alias("part_no"), p["type"].alias("type"), p["text"].alias("text"),
                                                       F.get("parts", i + 1)["text"].alias("expected")))
    calls = d.select("problem_id", F.explode(F.filter(steps, lambda s: s["type"] == "python")).alias("call")).select(
        "problem_id", F.col("call.part_no").alias("part_no"),
        F.replace(F.col("call.text"), F.lit(","), F.lit("")).alias("expr"), F.col("call.expected").alias("expected"))
    computed = G.calc_eval(F.col("expr"))
    return calls.select("problem_id", ((F.col("part_no") - 1) / 3).cast("long").alias("call_no"), "expr",
                        "expected", computed.alias("computed"),
                        F.coalesce(computed == F.col("expected"), F.lit(False)).alias("ok"))


@query("mc_conversation", oracle("""
select item_id, subject,
  md5('Multiple Choice question: ' || question || chr(10) || '- ' || c0 || '=A' || chr(10) || '- ' || c1 || '=B' || chr(10)
      || '- ' || c2 || '=C' || chr(10) || '- ' || c3 || '=D' || chr(10) || chr(10)
      || 'Respond only with the letter of the correct answer.') as user_md5,
  ['A', 'B', 'C', 'D'][answer + 1] as assistant
from mc_items""", "mc_items"))
def q_mc_conversation(spark, sf_dir):
    d = load(spark, sf_dir).mc_items
    user = G.render_mc("question", F.array("c0", "c1", "c2", "c3"), G.mc_letters())
    return d.select("item_id", "subject", F.md5(user).alias("user_md5"),
                    F.get(G.mc_letters(), F.col("answer")).alias("assistant"))


#: Choice items of three to five choices with letters or digits; some rows
#: are faulty, as a scraped table may have them.
_CHOICES = """select p_partkey as item_id, 'Which label fits ' || p_name || '?' as question,
  case p_partkey % 3 when 0 then array(p_name, p_brand, p_type, cast(p_size as string), 'none') when 1 then array(p_brand, p_type, cast(p_size as string)) else array(p_name, p_brand, p_type, cast(p_size as string)) end as choices,
  case when p_partkey % 23 = 0 then array('A', 'B') when p_partkey % 29 = 0 then array('A', 'A', 'C', 'D', 'E') when p_partkey % 3 = 0 then array('A', 'B', 'C', 'D', 'E')
       when p_partkey % 3 = 1 then array('1', '2', '3') else array('A', 'B', 'C', 'D') end as letters,
  case when p_partkey % 31 = 0 then null when p_partkey % 3 = 1 then cast(p_partkey % 4 as string) else 'B' end as answer from part"""


@query("choice_conversation", oracle(f"""
with i as ({_CHOICES.replace('array(', 'list_value(').replace('as string', 'as varchar')}),
r as (select *, case when len(choices) <> len(letters) then 'letters_do_not_match_choices' when len(list_distinct(letters)) < len(letters) then 'repeated_letter'
                     when answer is null or not list_contains(letters, answer) then 'answer_not_a_letter' end as reason from i)
select item_id, reason, case when reason is null then answer end as assistant, case when reason is null then len(letters) end as n_letters,
  case when reason is null then md5('Multiple Choice question: ' || question || chr(10)
    || array_to_string(list_transform(list_zip(choices, letters), lambda z: '- ' || z[1] || '=' || z[2] || chr(10)), '')
    || chr(10) || 'Respond only with the letter of the correct answer.') end as user_md5 from r"""))
def q_choice_conversation(spark, sf_dir):
    """Choices of any number with the row's own letters; refused rows come
    out with their reason."""
    load(spark, sf_dir).part.createOrReplaceTempView("part")
    good, bad = G.choice_conversations(spark.sql(_CHOICES), "question", "choices", "letters", "answer")
    text = lambda i: F.get("messages", F.lit(i))["content"]
    return good.select("item_id", F.lit(None).cast("string").alias("reason"), text(1).alias("assistant"),
                       F.size("letters").cast("long").alias("n_letters"), F.md5(text(0)).alias("user_md5")).unionByName(
        bad.select("item_id", "reason"), allowMissingColumns=True)


@query("code_conversation", oracle("""
select item_id, md5(prompt) as user_md5, md5(prompt || chr(10) || canonical_solution) as assistant_md5,
       entry_point, md5(test) as test_md5
from code_items""", "code_items"))
def q_code_conversation(spark, sf_dir):
    d = load(spark, sf_dir).code_items
    return d.select("item_id", F.md5("prompt").alias("user_md5"),
                    F.md5(F.concat("prompt", F.lit("\n"), "canonical_solution")).alias("assistant_md5"),
                    "entry_point", F.md5("test").alias("test_md5"))


_PROGRAM = ("case when regexp_matches(completion, '(?s)```(?:python)?\\s*\\n(.*?)\\n```') "
            "then trim(regexp_extract(completion, '(?s)```(?:python)?\\s*\\n(.*?)\\n```', 1), ' ' || chr(9) || chr(10) || chr(13)) "
            "else trim(completion, ' ' || chr(9) || chr(10) || chr(13)) end")


@query("extract_program", oracle(f"""
select problem_id, k, {_PROGRAM} as program from completions""", "completions"))
def q_extract_program(spark, sf_dir):
    d = load(spark, sf_dir).completions
    return d.select("problem_id", "k", G.extract_program("completion").alias("program"))


_IMPORTS = """(select array_to_string(list_filter(
     case when pos > 0 then lines[1:pos - 1] else lines end,
     lambda s: starts_with(s, 'import ') or starts_with(s, 'from ')), chr(10))
   from (select lines, list_position(list_transform(lines, lambda s:
           not (starts_with(s, 'import ') or starts_with(s, 'from ')) and length(s) > 0 and not starts_with(s, '#')), true) as pos
         from (select list_transform(string_split(prompt, chr(10)), lambda s: trim(s, ' ' || chr(9) || chr(13))) as lines) a) b)"""


@query("extract_imports", oracle(f"""
select item_id, coalesce({_IMPORTS}, '') as imports from code_items""", "code_items"))
def q_extract_imports(spark, sf_dir):
    d = load(spark, sf_dir).code_items
    return d.select("item_id", G.extract_imports("prompt").alias("imports"))


@query("assemble_program", oracle(f"""
select c.problem_id, c.k,
  md5(coalesce({_IMPORTS}, '') || chr(10) || chr(10) || {_PROGRAM} || chr(10) || chr(10) || i.test || chr(10)
      || 'check(' || i.entry_point || ')') as program_md5
from completions c join code_items i on i.item_id = c.problem_id""", "completions", "code_items"))
def q_assemble_program(spark, sf_dir):
    cat = load(spark, sf_dir)
    j = cat.completions.join(cat.code_items, F.col("item_id") == F.col("problem_id"))
    prog = G.assemble_program(G.extract_imports("prompt"), G.extract_program("completion"), "test", "entry_point")
    return j.select("problem_id", "k", F.md5(prog).alias("program_md5"))


@query("simple_spelling_rows", oracle("""
with w as (select word, row_number() over (order by md5('42:' || word), word) - 1 as wpos from words),
n as (select count(*) as n from w),
idx as (select i, cast(('0x' || substr(md5('0:' || cast(i as varchar)), 1, 8)) as bigint) % (select n from n) as pick
        from (select unnest(generate_series(0, (select n from n) - 1)) as i) r)
select idx.i as idx, w.word, 'Spell the word: ' || w.word as user_msg,
       w.word || ':' || array_to_string(string_split(w.word, ''), ',') as assistant_msg
from idx join w on w.wpos = idx.pick""", "words"))
def q_simple_spelling_rows(spark, sf_dir):
    words = load(spark, sf_dir).words
    w = global_position(words.withColumn("_k", seeded_key(42, "word")), ["_k", "word"], (), out="wpos",
                        block=F.substring("_k", 1, 4))
    n = words.count()                      # one scalar; the index range is distributed
    idx = spark.range(n).withColumnRenamed("id", "idx")
    idx = idx.withColumn("pick", F.pmod(seeded_int(0, "idx"), F.lit(n)))
    j = idx.join(w, w.wpos == idx.pick)
    return j.select("idx", "word", F.concat(F.lit("Spell the word: "), "word").alias("user_msg"),
                    F.concat("word", F.lit(":"), G.spell_out("word")).alias("assistant_msg"))
