"""Task builders and graders as Column expressions.

All of these stay inside Catalyst except longer arithmetic in
``calc_eval`` (the safe calculator), which an Arrow-batched pandas UDF
evaluates - expressions are never passed to ``eval``.
"""

from __future__ import annotations

import operator
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tokenmill.functions.text import col, strip

# fixed values of the reference tasks
ANSWER_PATTERN = r"#### (-?[0-9.,]+)"
TOOL_TAG = r"<<[^>]+>>"
MC_LETTERS = ("A", "B", "C", "D")
MC_HEADER = "Multiple Choice question: "
MC_FOOTER = "\nRespond only with the letter of the correct answer."
CODE_FENCE = r"(?s)```(?:python)?(?U:\s)*\n(.*?)\n```"
CALC_MATH_CHARS = "0123456789*+-/.() "
CALC_STRING_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789'\"()._ "
CALC_BLOCKED = ("__", "import", "exec", "eval", "compile", "open", "file", "input", "raw_input",
                "globals", "locals", "vars", "dir", "getattr", "setattr", "delattr", "hasattr")


# ------------------------------------------------------------ answers --

def extract_answer(c) -> Column:
    """First ``#### <number>``, commas dropped; NULL when absent. A trailing
    dot is kept, so ``12.`` and ``12`` differ (as in the reference)."""
    c = col(c)
    return F.when(c.rlike(ANSWER_PATTERN),
                  F.replace(F.regexp_extract(c, ANSWER_PATTERN, 1), F.lit(","), F.lit("")))


def last_text_part(answer) -> Column:
    """Text after the last ``<<...>>`` tool call (the whole text if none)."""
    return F.element_at(F.split(col(answer), TOOL_TAG, -1), -1)


def grade_numeric(reference, completion) -> Column:
    """Correct when the extracted answers are equal; both NULL counts as equal."""
    return extract_answer(reference).eqNullSafe(extract_answer(completion))


# --------------------------------------------------------- tool calls --

def parse_tool_calls(answer) -> Column:
    """``ARRAY<STRUCT<type, text>>``: text pieces (empty ones kept) around
    ``<<expr=result>>`` tags; a tag gives a ``python`` part (before the last
    ``=``) and a ``python_output`` part (after it, ``''`` without ``=``)."""
    a = col(answer)
    texts = F.split(a, TOOL_TAG, -1)
    tags = F.regexp_extract_all(a, F.lit(r"<<([^>]+)>>"), 1)

    def part(t, x):
        return F.struct(F.lit(t).alias("type"), x.alias("text"))

    def at(i):
        tag = F.get(tags, i)
        has_eq = F.instr(tag, "=") > 0
        expr = F.when(has_eq, F.regexp_extract(tag, r"(?s)^(.*)=(.*)$", 1)).otherwise(tag)
        res = F.when(has_eq, F.regexp_extract(tag, r"(?s)^(.*)=(.*)$", 2)).otherwise(F.lit(""))
        return F.when(i < F.size(tags),
                      F.array(part("text", F.get(texts, i)), part("python", expr), part("python_output", res))
                      ).otherwise(F.array(part("text", F.get(texts, i))))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(tags)), at))


_TOKEN = re.compile(r"\s*(?:(\d+\.?\d*|\.\d+)|(//|[-+*/()]))")


class _Arithmetic:
    """Precedence climbing over numbers, + - * / //, signs and brackets."""

    LEVEL = {"+": 1, "-": 1, "*": 2, "/": 2, "//": 2}
    APPLY = {"+": operator.add, "-": operator.sub, "*": operator.mul, "/": operator.truediv, "//": operator.floordiv}

    def __init__(self, text: str):
        self.tokens, at, text = [], 0, text.rstrip()
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise ValueError("not a number or an operator")
            self.tokens.append(m.group(1) or m.group(2))
            at = m.end()
        self.tokens.reverse()

    def result(self):
        value = self.climb(1)
        if self.tokens:
            raise ValueError("something follows the expression")
        return value

    def climb(self, level: int):
        value = self.operand()
        while self.tokens and self.LEVEL.get(self.tokens[-1], 0) >= level:
            op = self.tokens.pop()
            value = self.APPLY[op](value, self.climb(self.LEVEL[op] + 1))
        return value

    def operand(self):
        token = self.tokens.pop()
        if token in "+-":
            value = self.operand()
            return -value if token == "-" else value
        if token == "(":
            value = self.climb(1)
            if self.tokens.pop() != ")":
                raise ValueError("bracket not closed")
            return value
        if "." in token:
            return float(token)
        if token != "0" and token.startswith("0") and token.strip("0"):
            raise ValueError("leading zero")
        return int(token)


def evaluate(text: str | None) -> str | None:
    """An arithmetic expression's value as Python prints it; None for what is
    none, for a division by zero and for numbers too long to print."""
    try:
        return None if text is None else str(_Arithmetic(text).result())
    except (ValueError, ArithmeticError, IndexError, KeyError, TypeError, RecursionError):
        return None


@F.pandas_udf(T.StringType())
def _evaluated(texts: pd.Series) -> pd.Series:
    return pd.Series([evaluate(x) for x in texts], dtype=object)


def calc_eval(expr) -> Column:
    """Calculator result as text, NULL when refused. One operation on short
    integers and ``'text'.count('part')`` are column rules; only other
    arithmetic goes to the evaluator, an Arrow-batched UDF."""
    e = F.replace(col(expr), F.lit(","), F.lit(""))
    simple = r"^ *([0-9]{1,9}) *([-+*]) *([0-9]{1,9}) *$"
    canonical = r"^ *(0|[1-9][0-9]*) *[-+*] *(0|[1-9][0-9]*) *$"
    a, op, b = (F.regexp_extract(e, simple, i) for i in (1, 2, 3))
    a, b = a.try_cast("long"), b.try_cast("long")
    short = F.when(op == "+", a + b).when(op == "-", a - b).otherwise(a * b).cast("string")
    count = r"""^ *(['"])([^'"]*)\1\.count\((['"])([^'"]*)\3\) *$"""
    text, part = F.regexp_extract(e, count, 2), F.regexp_extract(e, count, 4)
    times = F.when(part == "", F.length(text) + 1).otherwise(
        ((F.length(text) - F.length(F.replace(text, part, F.lit("")))) / F.length(part)).cast("int"))
    is_math = e.rlike("^[" + re.escape(CALC_MATH_CHARS) + "]*$") & ~e.contains("**")
    is_short = e.rlike(simple) & e.rlike(canonical)
    is_count = (~e.rlike("^[" + re.escape(CALC_MATH_CHARS) + "]*$") & e.rlike("^[" + re.escape(CALC_STRING_CHARS) + "]*$")
                & ~F.lower(e).rlike("|".join(map(re.escape, CALC_BLOCKED))) & e.rlike(count))
    rest = _evaluated(F.when(is_math & ~is_short, e))
    return F.when(is_short, short).when(is_count, times.cast("string")).when(is_math, rest)


# ---------------------------------------------------- multiple choice --

def render_mc(question, choices: Column, letters: Column) -> Column:
    """``Multiple Choice question: q\\n- choice=L\\n...\\nRespond only ...``"""
    lines = F.zip_with(choices, letters, lambda c, l: F.concat(F.lit("- "), c, F.lit("="), l, F.lit("\n")))
    return F.concat(F.lit(MC_HEADER), col(question), F.lit("\n"), F.array_join(lines, ""), F.lit(MC_FOOTER))


def mc_letters() -> Column:
    return F.array(*[F.lit(x) for x in MC_LETTERS])


def choice_fault(question, choices: Column, letters: Column, answer) -> Column:
    """Why a row can't be a choice conversation, or NULL: any number of
    choices is fine, with the row's own letters, one of which is the answer."""
    q, a = col(question), col(answer)
    return (F.when(q.isNull(), F.lit("no_question"))
             .when(choices.isNull() | letters.isNull() | (F.size(choices) == 0), F.lit("no_choices"))
             .when(F.size(choices) != F.size(letters), F.lit("letters_do_not_match_choices"))
             .when(F.exists(choices, lambda c: c.isNull()) | F.exists(letters, lambda x: x.isNull()), F.lit("null_choice"))
             .when(F.size(F.array_distinct(letters)) < F.size(letters), F.lit("repeated_letter"))
             .when(a.isNull() | ~F.coalesce(F.array_contains(letters, a), F.lit(False)), F.lit("answer_not_a_letter")))


def choice_conversations(items: DataFrame, question: str, choices: str, letters: str, answer: str) -> tuple[DataFrame, DataFrame]:
    """Conversations (``messages`` and the row's ``letters``, to which an
    evaluation clamps its prediction), and the refused rows with a reason."""
    d = items.withColumn("reason", choice_fault(question, F.col(choices), F.col(letters), answer))
    message = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    good = d.where("reason is null").drop("reason")
    good = good.withColumn("messages", F.array(message("user", render_mc(question, F.col(choices), F.col(letters))), message("assistant", F.col(answer))))
    return good, d.where("reason is not null")


# --------------------------------------------------------------- code --

def extract_program(completion) -> Column:
    """First fenced block (```python or ```), stripped; else the whole text stripped."""
    c = col(completion)
    return F.when(c.rlike(CODE_FENCE), strip(F.regexp_extract(c, CODE_FENCE, 1))).otherwise(strip(c))


def extract_imports(prompt) -> Column:
    """Leading ``import`` / ``from`` lines (stripped), skipping blank and
    ``#`` lines, stopping at the first other line; joined by newlines."""
    lines = F.transform(F.split(col(prompt), "\n", -1), lambda s: strip(s))

    def is_import(s):
        return s.startswith("import ") | s.startswith("from ")

    stop = F.array_position(F.transform(lines, lambda s: ~is_import(s) & (F.length(s) > 0) & ~s.startswith("#")),
                            True)
    head = F.when(stop > 0, F.slice(lines, 1, stop - 1)).otherwise(lines)
    return F.array_join(F.filter(head, is_import), "\n")


def assemble_program(imports, code, test, entry_point) -> Column:
    return F.concat(col(imports), F.lit("\n\n"), col(code), F.lit("\n\n"), col(test), F.lit("\n"),
                    F.lit("check("), col(entry_point), F.lit(")"))


# ----------------------------------------------------------- spelling --

def spell_out(word) -> Column:
    """``w,o,r,d``"""
    return F.array_join(F.split(col(word), "", -1), ",")
