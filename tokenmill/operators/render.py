"""Conversation rendering to token ids + loss mask.

A conversation is one row with its messages in order, so rendering is a
per-row map: every message part becomes a segment ``(ids, mask)`` with its
special-token wrappers and the segments are concatenated with
higher-order functions - no explode, shuffle or regrouping. Text is
tokenised with a Column function (byte ids by default), so the whole job
stays in Catalyst; a conversation is the largest unit held in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tokenmill.functions.text import utf8_byte_ids
from tokenmill.operators.conversations import drop_last_assistant, merge_system_message
from tokenmill.operators.tokenizer import encode_nested, pretokenize, special_id

MAX_TOKENS = 2048


def as_parts(messages: Column) -> Column:
    """Normalise messages to ``STRUCT<role, parts ARRAY<STRUCT<type, text>>>``;
    a plain string content is one ``text`` part."""
    return F.transform(messages, lambda m: F.struct(
        m["role"].alias("role"),
        F.array(F.struct(F.lit("text").alias("type"), m["content"].alias("text"))).alias("parts")))


def merge_system_parts(d: DataFrame) -> DataFrame:
    """A leading system message in part form goes in front of the first part
    of the user message after it; without one the row is refused."""
    first, second = F.get("messages", F.lit(0)), F.get("messages", F.lit(1))
    system = F.coalesce(first["role"] == "system", F.lit(False))
    text = F.array_join(F.transform(first["parts"], lambda p: p["text"]), "")
    opening = F.transform(second["parts"], lambda p, j: F.struct(
        p["type"].alias("type"), F.when(j == 0, F.concat(text, F.lit("\n\n"), p["text"])).otherwise(p["text"]).alias("text")))
    merged = F.concat(F.array(F.struct(second["role"].alias("role"), opening.alias("parts"))), F.slice("messages", 3, F.greatest(F.size("messages") - 2, F.lit(0))))
    ok = second["role"] == "user"
    return (d.withColumn("reason", F.when(system & ~F.coalesce(ok, F.lit(False)), F.lit("system_not_followed_by_user")))
             .withColumn("messages", F.when(system & F.coalesce(ok, F.lit(False)), merged).otherwise(
                 F.transform("messages", lambda m: F.struct(m["role"].alias("role"), F.transform(m["parts"], lambda p: F.struct(
                     p["type"].alias("type"), p["text"].alias("text"))).alias("parts"))))))


def render_conversations(convs: DataFrame, id_col: str = "conv_id", messages_col: str = "messages",
                         max_tokens: int = MAX_TOKENS, tokenize=utf8_byte_ids, n_merges: int = 0,
                         has_parts: bool = False, for_completion: bool = False, merges=None) -> DataFrame:
    """``(conv_id, ids ARRAY<INT>, mask ARRAY<INT>, reason)``.

    Mask 1: assistant text, python calls with their start/end tokens, and
    assistant_end. Mask 0: BOS, user turns, assistant_start, tool outputs and
    their markers. A leading system message is merged into the first user
    message; roles must alternate user/assistant (else ``reason`` is set and
    ids are NULL). ``for_completion`` drops the final assistant message and
    appends assistant_start (no truncation, as the reference). ``tokenize``
    is a column function; with ``merges`` all texts of a conversation are
    encoded by these instead, in one Arrow call a batch.
    """
    if merges is not None:
        n_merges = len(merges)
    sid = {n: special_id(n, n_merges) for n in
           ("<|bos|>", "<|user_start|>", "<|user_end|>", "<|assistant_start|>", "<|assistant_end|>",
            "<|python_start|>", "<|python_end|>", "<|output_start|>", "<|output_end|>")}
    d = convs.select(id_col, F.col(messages_col).alias("messages"))
    if for_completion:
        d = drop_last_assistant(d).withColumnRenamed("reason", "_r0")
    else:
        d = d.withColumn("_r0", F.lit(None).cast("string"))
    if not has_parts:
        d = d.withColumn("messages", F.transform("messages", lambda m: F.struct(
            m["role"].alias("role"), m["content"].alias("content"))))
        d = merge_system_message(d).withColumn("messages", as_parts(F.col("messages")))
    else:
        d = merge_system_parts(d)
    # before the texts have ids: a filter on the reason goes below them
    bad_role = F.exists(F.sequence(F.lit(0), F.greatest(F.size("messages") - 1, F.lit(0))),
                        lambda i: F.get(F.col("messages"), i)["role"] !=
                        F.when(i % 2 == 0, F.lit("user")).otherwise(F.lit("assistant")))
    d = d.withColumn("reason", F.coalesce("_r0", "reason",
                                          F.when(F.size("messages") < 1, F.lit("empty"))
                                           .when(bad_role, F.lit("bad_role_order")))).drop("_r0")
    # every part gets its ids here, so that the segments below only join them
    if merges is not None:
        pieces = F.transform("messages", lambda m: F.transform(m["parts"], lambda p: F.coalesce(pretokenize(p["text"]), F.array().cast("array<string>"))))
        d = d.withColumn("_ids", encode_nested(d.sparkSession, merges)(pieces))
        part_ids = lambda p, i, j: F.get(F.get(F.col("_ids"), i), j)
    else:
        part_ids = lambda p, i, j: tokenize(p["text"])
    d = d.withColumn("messages", F.transform("messages", lambda m, i: F.struct(m["role"].alias("role"), F.transform(
        m["parts"], lambda p, j: F.struct(p["type"].alias("type"), part_ids(p, i, j).alias("ids"))).alias("parts"))))
    def seg(ids: Column, mask: int, pre=None, post=None) -> Column:
        out = ids
        if pre is not None:
            out = F.concat(F.array(F.lit(sid[pre])), out)
        if post is not None:
            out = F.concat(out, F.array(F.lit(sid[post])))
        return F.struct(out.alias("ids"), F.array_repeat(F.lit(mask), F.size(out)).alias("mask"))

    def single(token: str, mask: int) -> Column:
        return F.struct(F.array(F.lit(sid[token])).alias("ids"), F.array(F.lit(mask)).alias("mask"))

    def part_seg(p: Column) -> Column:
        ids = p["ids"]
        return (F.when(p["type"] == "python", seg(ids, 1, "<|python_start|>", "<|python_end|>"))
                 .when(p["type"] == "python_output", seg(ids, 0, "<|output_start|>", "<|output_end|>"))
                 .otherwise(seg(ids, 1)))

    def message_segs(m: Column) -> Column:
        user = F.transform(m["parts"], lambda p: seg(p["ids"], 0, "<|user_start|>", "<|user_end|>"))
        asst = F.concat(F.array(single("<|assistant_start|>", 0)), F.transform(m["parts"], part_seg),
                        F.array(single("<|assistant_end|>", 1)))
        return F.when(m["role"] == "user", user).otherwise(asst)

    # the conversation is one row with its messages in order: segments are
    # built and concatenated per row, no explode / shuffle / regroup
    ok = F.col("reason").isNull()
    segs = d.withColumn("_segs", F.when(ok, F.flatten(F.transform("messages", message_segs))))
    flat_ids = F.concat(F.array(F.lit(sid["<|bos|>"])), F.flatten(F.transform("_segs", lambda x: x["ids"])))
    flat_mask = F.concat(F.array(F.lit(0)), F.flatten(F.transform("_segs", lambda x: x["mask"])))
    out_ids, out_mask = F.slice(flat_ids, 1, max_tokens), F.slice(flat_mask, 1, max_tokens)
    if for_completion:
        out_ids = F.concat(out_ids, F.array(F.lit(sid["<|assistant_start|>"])))
        out_mask = F.concat(out_mask, F.array(F.lit(0)))
    return segs.select(id_col, F.when(ok, out_ids).alias("ids"), F.when(ok, out_mask).alias("mask"), "reason")


def drop_unusable_examples(rendered: DataFrame, min_tokens: int = 4) -> DataFrame:
    """Keep rows with >= ``min_tokens`` ids and a supervised target after the shift."""
    has_target = F.exists(F.slice("mask", 2, F.size("mask")), lambda m: m == 1)
    # a filter does not go below the generator, where it would make ids and mask
    # once more for each mention
    made = rendered.select(*[c for c in rendered.columns if c not in ("ids", "mask")], F.inline(F.array(F.struct("ids", "mask"))))
    return made.filter((F.size("ids") >= min_tokens) & has_target).select(*rendered.columns)


def pad_batches(rendered: DataFrame, batch_size: int, pad_id: int, row_col: str = "row_id") -> DataFrame:
    """Pad every row of a batch (``row_id div batch_size``) to the batch's
    longest row with ``pad_id``; padded mask positions are 0."""
    d = rendered.withColumn("batch", F.floor(F.col(row_col) / batch_size))
    # the lengths alone meet per batch; a row then gets its batch's by its own
    # key, hashed: rows of ids are not sorted
    w = Window.partitionBy("batch")
    lens = d.select("batch", F.col(row_col).alias("_row"), F.size("ids").alias("_n"))
    lens = lens.select("_row", F.max("_n").over(w).alias("_len")).hint("shuffle_hash")
    d = d.join(lens, F.col(row_col) == F.col("_row")).drop("_row")
    pad = F.col("_len") - F.size("ids")
    return d.withColumns({"ids": F.concat("ids", F.array_repeat(F.lit(pad_id), pad)),
                          "mask": F.concat("mask", F.array_repeat(F.lit(0), pad))}).drop("_len")


def mask_breakdown(rendered: DataFrame, vocab: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Long table ``(conv_id, pos, token_id, token_hex, mask)`` for inspection."""
    ex = rendered.select(id_col, F.posexplode(F.arrays_zip("ids", "mask")).alias("pos", "z"))
    ex = ex.select(id_col, "pos", F.col("z.ids").alias("token_id"), F.col("z.mask").alias("mask"))
    return ex.join(vocab.select("token_id", F.col("hex").alias("token_hex")), "token_id", "left")
