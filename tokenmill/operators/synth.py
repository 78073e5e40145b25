"""Task and data builders from tables.

Random choices are seeded hash draws (``md5(seed:salt)``, one salt per
draw), so every row is built independently and DuckDB can replay it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenmill.functions.grading import spell_out
from tokenmill.functions.text import strip
from tokenmill.plans.positions import global_position

TEST_SEED_OFFSET = 10_000_000
LETTERS = "abcdefghijklmnopqrstuvwxyz"
QUOTES = ["", "'", '"']

# fixed values: user message templates of the letter-counting task, in order
SPELLING_TEMPLATES = [
    "How many {letter} are in the word {word}",
    "How many {letter} are in {word}",
    "Count the number of {letter} in {word}",
    "How many times does {letter} appear in {word}",
    "What's the count of {letter} in {word}",
    "In the word {word}, how many {letter} are there",
    "How many letter {letter} are in the word {word}",
    "Count how many {letter} appear in {word}",
    "Tell me the number of {letter} in {word}",
    "How many occurrences of {letter} are in {word}",
    "Find the count of {letter} in {word}",
    "Can you count the {letter} letters in {word}",
    "What is the frequency of {letter} in {word}",
    "How many {letter}s are in {word}",
    "How many {letter}'s are in {word}",
    "Count all the {letter} in {word}",
    "How many times is {letter} in {word}",
    "Number of {letter} in {word}",
    "Total count of {letter} in {word}",
    "How many {letter} does {word} have",
    "How many {letter} does {word} contain",
    "What's the number of {letter} in {word}",
    "{word} has how many {letter}",
    "In {word}, count the {letter}",
    "How many {letter} appear in {word}",
    "Count the {letter} in {word}",
    "Give me the count of {letter} in {word}",
    "How many instances of {letter} in {word}",
    "Show me how many {letter} are in {word}",
    "Calculate the number of {letter} in {word}",
    "¿Cuántas {letter} hay en {word}?",
    "¿Cuántas veces aparece {letter} en {word}?",
    "Cuenta las {letter} en {word}",
    "¿Cuántas letras {letter} tiene {word}?",
    "{word}中有多少个{letter}",
    "{word}里有几个{letter}",
    "数一下{word}中的{letter}",
    "{word}这个词里有多少{letter}",
    "{word}에 {letter}가 몇 개 있나요",
    "{word}에서 {letter}의 개수는",
    "{word}에 {letter}가 몇 번 나오나요",
    "{word}라는 단어에 {letter}가 몇 개",
    "Combien de {letter} dans {word}",
    "Combien de fois {letter} apparaît dans {word}",
    "Compte les {letter} dans {word}",
    "Wie viele {letter} sind in {word}",
    "Wie oft kommt {letter} in {word} vor",
    "Zähle die {letter} in {word}",
    "{word}に{letter}は何個ありますか",
    "{word}の中に{letter}がいくつ",
    "{word}に{letter}が何回出てくる",
]
# fixed values: the worked answer's text pieces
SPELL_INTRO = "We are asked to find the number '{letter}' in the word '{word}'. Let me try a manual approach first.\n\nFirst spell the word out:\n{word}:{spelled}\n\nThen count the occurrences of '{letter}':\n"
SPELL_OUTRO = "\nThis gives us {count}."
SPELL_CHECK = "\n\nLet me double check this using Python:\n\n"
SPELL_FINAL = "\n\nPython gives us {count}.\n\nMy final answer is:\n\n#### {count}"
# transcript conversations
SUMMARY_MIN_CHARS, SUMMARY_MAX_CHARS = 200, 800
CHUNK_FLUSH_CHARS, CHUNK_MIN_CHARS, MAX_CHUNKS = 400, 80, 6


def draw(seed: Column, salt: str) -> Column:
    """32-bit deterministic draw for (seed, salt)."""
    key = F.md5(F.concat(seed.cast("string"), F.lit(":" + salt)))
    return F.conv(F.substring(key, 1, 8), 16, 10).cast("long")


def uniform(seed: Column, salt: str) -> Column:
    return draw(seed, salt) / F.lit(4294967296.0)


def _fill(template: str, **cols) -> Column:
    """Python ``str.format`` with column values for ``{name}`` fields."""
    out = F.lit(template)
    for k, v in cols.items():
        out = F.replace(out, F.lit("{" + k + "}"), v)
    return out


# ------------------------------------------------------------ F11 --

def spelling_bee_rows(index: DataFrame, words: DataFrame, split: str = "train",
                      idx_col: str = "idx", word_col: str = "word") -> DataFrame:
    """Letter-counting conversations, one per index.

    Word by draw over the word list (list order = word order), letter from
    the word (90%) or any letter, template (30% lower-cased), quote style for
    letter and word, '?' (50%); the assistant message has the spelled-out
    word, running ``hit! count=`` lines, a python check and ``#### n``.
    """
    w = global_position(words.select(word_col).distinct(), [word_col], (), out="_wpos")
    n = words.select(F.countDistinct(word_col)).scalar()
    seed = F.col(idx_col) + (TEST_SEED_OFFSET if split == "test" else 0)
    d = index.select(idx_col, seed.alias("_seed"))
    d = d.withColumn("_wpos", F.pmod(draw(F.col("_seed"), "word"), n)).join(w, "_wpos")
    word = F.col(word_col)
    from_word = uniform(F.col("_seed"), "letter_source") < 0.9
    letter = F.when(from_word, F.substring(word, (F.pmod(draw(F.col("_seed"), "letter"), F.length(word)) + 1)
                                           .cast("int"), 1)) \
              .otherwise(F.substring(F.lit(LETTERS), (F.pmod(draw(F.col("_seed"), "letter"), F.lit(26)) + 1)
                                     .cast("int"), 1))
    d = d.withColumn("letter", letter)
    count = (F.length(word) - F.length(F.replace(word, F.col("letter"), F.lit("")))).cast("long")
    d = d.withColumn("count", count)
    tmpl = F.element_at(F.array(*[F.lit(t) for t in SPELLING_TEMPLATES]),
                        (F.pmod(draw(F.col("_seed"), "template"), F.lit(len(SPELLING_TEMPLATES))) + 1).cast("int"))
    tmpl = F.when(uniform(F.col("_seed"), "lower") < 0.3, F.lower(tmpl)).otherwise(tmpl)
    quotes = F.array(*[F.lit(q) for q in QUOTES])
    lq = F.element_at(quotes, (F.pmod(draw(F.col("_seed"), "letter_quote"), F.lit(3)) + 1).cast("int"))
    wq = F.element_at(quotes, (F.pmod(draw(F.col("_seed"), "word_quote"), F.lit(3)) + 1).cast("int"))
    user = F.concat(F.replace(F.replace(tmpl, F.lit("{letter}"), F.concat(lq, F.col("letter"), lq)),
                              F.lit("{word}"), F.concat(wq, word, wq)),
                    F.when(uniform(F.col("_seed"), "question") < 0.5, F.lit("?")).otherwise(F.lit("")))

    def line(i):
        c = F.substring(word, i, 1)
        upto = F.substring(word, 1, i)
        rc = F.length(upto) - F.length(F.replace(upto, F.col("letter"), F.lit("")))
        return F.when(c == F.col("letter"),
                      F.concat(i.cast("string"), F.lit(":"), c, F.lit(" hit! count="), rc.cast("string"), F.lit("\n"))
                      ).otherwise(F.concat(i.cast("string"), F.lit(":"), c, F.lit("\n")))

    lines = F.array_join(F.transform(F.sequence(F.lit(1), F.length(word)), line), "")
    manual = F.concat(_fill(SPELL_INTRO, letter=F.col("letter"), word=word, spelled=spell_out(word)), lines,
                      _fill(SPELL_OUTRO, count=F.col("count").cast("string")))

    def part(t, x):
        return F.struct(F.lit(t).alias("type"), x.alias("text"))

    parts = F.array(part("text", manual), part("text", F.lit(SPELL_CHECK)),
                    part("python", F.concat(F.lit("'"), word, F.lit("'.count('"), F.col("letter"), F.lit("')"))),
                    part("python_output", F.col("count").cast("string")),
                    part("text", _fill(SPELL_FINAL, count=F.col("count").cast("string"))))
    return d.select(idx_col, word_col, "letter", "count", user.alias("user_msg"), parts.alias("assistant_parts"))


# ------------------------------------------------------------ F13 --

def transcript_conversations(df: DataFrame, title_col: str = "title", text_col: str = "text",
                             summary_question: str = 'What does the video "{title}" talk about?') -> DataFrame:
    """Summary pair (text > 200 chars: first 800 + '...') and up to 6 chunk
    Q&A pairs per transcript. Sentences split after ``।.!?`` + whitespace; a
    chunk is flushed once its summed sentence length exceeds 400; chunks
    under 80 chars are skipped without renumbering. Output
    ``(id, part, user_msg, assistant_msg)`` with part 0 = summary."""
    text = F.col(text_col)
    sents = F.split(text, r"(?U)(?<=[।.!?])\s+", -1)
    init = F.struct(F.array().cast("array<string>").alias("chunks"), F.array().cast("array<string>").alias("cur"),
                    F.lit(0).alias("n"))

    def step(acc, s):
        cur = F.array_append(acc["cur"], s)
        n = acc["n"] + F.length(s)
        flush = n > CHUNK_FLUSH_CHARS
        return F.struct(F.when(flush, F.array_append(acc["chunks"], F.array_join(cur, " "))).otherwise(acc["chunks"])
                        .alias("chunks"),
                        F.when(flush, F.array().cast("array<string>")).otherwise(cur).alias("cur"),
                        F.when(flush, F.lit(0)).otherwise(n).alias("n"))

    chunks = F.aggregate(sents, init, step, lambda acc: F.when(
        F.size(acc["cur"]) > 0, F.array_append(acc["chunks"], F.array_join(acc["cur"], " "))).otherwise(acc["chunks"]))
    topic = strip(F.substring_index(strip(F.substring_index(F.col(title_col), "|", 1)), ":", 1))

    def conv(part, user, assistant):
        return F.struct(part.cast("int").alias("part"), user.alias("user_msg"), assistant.alias("assistant_msg"))

    summary = F.when(F.length(text) > SUMMARY_MIN_CHARS, F.array(conv(
        F.lit(0), _fill(summary_question, title=F.col(title_col)),
        F.concat(F.substring(text, 1, SUMMARY_MAX_CHARS),
                 F.when(F.length(text) > SUMMARY_MAX_CHARS, F.lit("...")).otherwise(F.lit("")))))
                     ).otherwise(F.array().cast("array<struct<part:int,user_msg:string,assistant_msg:string>>"))
    numbered = F.transform(F.slice(chunks, 1, MAX_CHUNKS), lambda c, i: conv(
        i + 1, F.concat(F.lit("Tell me about "), topic, F.lit(" - part "), (i + 1).cast("string")), c))
    kept = F.filter(numbered, lambda x: F.length(x["assistant_msg"]) >= CHUNK_MIN_CHARS)
    # one pass per transcript: summary + numbered chunk pairs, exploded once
    out = df.select("id", F.explode(F.concat(summary, kept)).alias("_c"))
    return out.select("id", "_c.part", "_c.user_msg", "_c.assistant_msg")


# ---------------------------------------------------------- O6 / F14 --

PROMPT_TEMPLATE = ("Write a realistic conversation.\nTopic: {topic}\nUser persona: {persona}\n"
                   "Conversation dynamic: {dynamic}\nExample first messages:\n{first_message_examples}\n")


def _indexed(df: DataFrame, cols, group=None, out="_pos"):
    g = [group] if group else []
    return global_position(df.select(*g, *cols).distinct(), cols, g, out=out)


def sample_diversity(index: DataFrame, topics: DataFrame, personas: DataFrame, dynamics: DataFrame,
                     openers: DataFrame, idx_col: str = "idx", n_openers: int = 3) -> DataFrame:
    """Per index: a topic category then a topic in it, a persona, a dynamic
    and ``n_openers`` distinct opener categories with one opener each.

    The element tables are small and bounded (vocabularies of choices); the
    draws are per-row hashes and the picks are equi-joins on dense positions.
    """
    cats = topics.select("category").distinct()
    cat_list = cats.select(F.array_sort(F.collect_list("category"))).scalar()
    n_cats = cats.select(F.count("*")).scalar()
    t = _indexed(topics, ["topic"], "category")
    t_n = topics.select("category", "topic").distinct().groupBy("category").agg(F.count("*").alias("_tn"))
    p = _indexed(personas, ["persona"])
    d_ = _indexed(dynamics, ["dynamic"])
    o = _indexed(openers, ["text"], "category")
    o_n = openers.select("category", "text").distinct().groupBy("category").agg(F.count("*").alias("_on"))
    # opener categories: a vocabulary of choices, one array for the ranking below
    ocats = openers.select("category").distinct().select(F.array_sort(F.collect_list("category"))).scalar()
    seed = F.col(idx_col)
    d = index.select(idx_col)
    d = d.withColumn("category", F.element_at(cat_list, (F.pmod(draw(seed, "category"), n_cats) + 1).cast("int")))
    d = d.join(t_n, "category").withColumn("_pos", F.pmod(draw(seed, "topic"), F.col("_tn")))
    d = d.join(t, ["category", "_pos"]).drop("_pos", "_tn")
    d = d.withColumn("_pos", F.pmod(draw(seed, "persona"), p.select(F.count("*")).scalar())).join(p, "_pos").drop("_pos")
    d = d.withColumn("_pos", F.pmod(draw(seed, "dynamic"), d_.select(F.count("*")).scalar())).join(d_, "_pos") \
         .drop("_pos")
    ranked = F.array_sort(F.transform("_ocats", lambda c: F.struct(
        F.md5(F.concat(seed.cast("string"), F.lit(":opener_category:"), c)).alias("k"), c.alias("c"))))
    chosen = F.transform(F.slice(ranked, 1, n_openers), lambda x: x["c"])
    ex = d.withColumn("_ocats", ocats).select(idx_col, F.posexplode(chosen).alias("slot", "category"))
    ex = ex.join(o_n, "category").withColumn(
        "_pos", F.pmod(draw(F.concat(seed.cast("string"), F.lit(":"), F.col("category")), "opener"), F.col("_on")))
    ex = ex.join(o, ["category", "_pos"]).groupBy(idx_col).agg(
        F.array_sort(F.collect_list(F.struct("slot", "text"))).alias("_o"))
    examples = F.array_join(F.transform("_o", lambda x: F.concat(F.lit("- "), x["text"])), "\n")
    return d.join(ex.select(idx_col, examples.alias("first_message_examples")), idx_col)


def synthetic_prompts(elements: DataFrame) -> DataFrame:
    return elements.withColumn("prompt", _fill(PROMPT_TEMPLATE, topic=F.col("topic"), persona=F.col("persona"),
                                               dynamic=F.col("dynamic"),
                                               first_message_examples=F.col("first_message_examples")))


def parse_responses(responses: DataFrame, validate, idx_col: str = "idx", body_col: str = "body") -> DataFrame:
    """Returned bodies -> ``messages`` + ``reason`` ('not_json', 'api_error',
    or the conversation check's reason)."""
    from tokenmill.sources.files import MESSAGES
    body = F.col(body_col)
    is_obj = F.get_json_object(body, "$").isNotNull() & body.startswith("{")
    err = F.get_json_object(body, "$.error")
    msgs = F.from_json(F.get_json_object(body, "$.messages"), MESSAGES)
    d = responses.select(idx_col, msgs.alias("messages"),
                         F.when(~is_obj, F.lit("not_json")).when(err.isNotNull(), F.lit("api_error"))
                         .alias("_pre"))
    v = validate(d)
    return v.withColumn("reason", F.coalesce("_pre", "reason")).drop("_pre")
