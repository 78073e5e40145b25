"""Corpus jobs: splits, striding, cropping, budgets, cleaning, profiles.

Documents carry an explicit stream order (shard, position in shard);
Spark rows are unordered, so every order-dependent rule here takes the
order columns as arguments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenmill.functions.text import collapse_ws, strip
from tokenmill.plans.positions import global_position, prefix_sum, seeded_key

ROW_GROUP = 1024          # documents per parquet row group in corpus shards
DOC_CAP = 10_000          # characters kept per document for tokenizer training
MIN_CHARS = 100           # shortest document / transcript kept


def split_last_shard(docs: DataFrame, shard_col: str = "shard", out: str = "split") -> DataFrame:
    """``val`` for rows of the last shard (max shard name), ``train`` otherwise.

    The last shard is a scalar subquery (partial + final max), never a
    single-task window.
    """
    last = docs.select(F.max(shard_col)).scalar()
    return docs.withColumn(out, F.when(F.col(shard_col) == last, "val").otherwise("train"))


def with_row_groups(docs: DataFrame, pos_col: str = "pos", rows_per_group: int = ROW_GROUP,
                    out: str = "rg_idx") -> DataFrame:
    return docs.withColumn(out, F.floor(F.col(pos_col) / rows_per_group).cast("long"))


def rank_stride(docs: DataFrame, world: int, rg_col: str = "rg_idx", out: str = "rank") -> DataFrame:
    """Row group ``g`` of each shard goes to consumer ``g % world``."""
    return docs.withColumn(out, F.pmod(F.col(rg_col), F.lit(world)).cast("int"))


def resume_after(docs: DataFrame, pq_idx: int, rg_idx: int, world: int, rank: int,
                 shard_no_col: str = "shard_no", rg_col: str = "rg_idx") -> DataFrame:
    """Rows a consumer reads after resuming at ``(pq_idx, rg_idx)`` (first pass).

    The partly read group is skipped: the first group read in the resumed
    shard is ``(rg_idx // world + 1) * world + rank``; later shards start at
    ``rank``. Every group read satisfies ``g % world == rank``.
    """
    first = (rg_idx // world + 1) * world + rank
    mine = F.pmod(F.col(rg_col), F.lit(world)) == rank
    cond = ((F.col(shard_no_col) > pq_idx) & mine) | (
        (F.col(shard_no_col) == pq_idx) & (F.col(rg_col) >= first) & mine)
    return docs.filter(cond)


def crop_document(docs: DataFrame, cap: int = DOC_CAP, text_col: str = "text") -> DataFrame:
    """First ``cap`` characters (code points) of each document."""
    return docs.withColumn(text_col, F.substring(text_col, 1, cap))


def char_budget_prefix(docs: DataFrame, budget: int, order_cols, text_col: str = "text",
                       cap: int | None = DOC_CAP) -> DataFrame:
    """Cropped documents in order until the running total exceeds ``budget``.

    The crossing document is kept: a row survives when the characters of
    all earlier rows sum to at most ``budget``. The sums run over order keys
    and lengths; texts after the last survivor stay where they are read.
    """
    d = crop_document(docs, cap, text_col) if cap else docs
    lengths = d.select(*order_cols, F.length(text_col).alias("_n"))
    kept = prefix_sum(lengths, order_cols, "_n", (), out="chars_before").filter(F.col("chars_before") <= budget)
    kept = kept.select(F.struct(*order_cols).alias("_k"), "chars_before")
    d = d.withColumn("_k", F.struct(*order_cols))
    return d.filter(F.col("_k") <= kept.select(F.max("_k")).scalar()).join(kept, "_k").drop("_k")


def min_length_filter(docs: DataFrame, min_chars: int = MIN_CHARS, text_col: str = "text") -> DataFrame:
    return docs.filter(F.length(text_col) >= min_chars)


def clean_transcript(df: DataFrame, text_col: str = "text", out: str = "clean",
                     min_chars: int = MIN_CHARS) -> DataFrame:
    """Drop ``[...]`` tags, collapse whitespace, strip; ``''`` if under 100 chars."""
    no_tags = F.regexp_replace(F.col(text_col), r"(?d)\[.*?\]", "")
    t = strip(collapse_ws(no_tags))
    return df.withColumn(out, F.when(F.length(t) < min_chars, F.lit("")).otherwise(t))


def repeat_rows(df: DataFrame, n, out: str = "copy") -> DataFrame:
    """``n`` copies of every row (``n`` may be a column); ``copy`` from 1."""
    n = F.lit(n) if isinstance(n, int) else n
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), n)))


def corpus_multiplier(docs: DataFrame, text_col: str = "text", target_chars: int = 500_000):
    """``max(1, target // total_chars)`` as a scalar-subquery column."""
    total = docs.select(F.sum(F.length(text_col))).scalar()
    return F.greatest(F.lit(1), F.floor(F.lit(target_chars) / F.greatest(total, F.lit(1)))).cast("int")


def corpus_profile(docs: DataFrame, group_cols=("lang", "source"), text_col: str = "text") -> DataFrame:
    """Docs, characters and ``chars // 4`` token estimate, with rollup subtotals."""
    chars = F.sum(F.length(text_col))
    return (docs.rollup(*group_cols)
                .agg(F.count("*").alias("docs"), chars.alias("chars"),
                     F.floor(chars / 4).cast("long").alias("approx_tokens")))


def length_histogram(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Exact count per document length (characters)."""
    return docs.groupBy(F.length(text_col).alias("length")).agg(F.count("*").alias("docs"))


def seeded_shuffle(df: DataFrame, seed, id_col: str, out: str = "shuffle_pos") -> DataFrame:
    """Dense position in the seeded order ``md5(seed:id), id`` (two-pass)."""
    d = df.withColumn("_sk", seeded_key(seed, id_col))
    return global_position(d, ["_sk", id_col], (), out=out, block=F.substring("_sk", 1, 4)).drop("_sk")


def pretrain_text(df: DataFrame, title_col: str = "title", text_col: str = "text",
                  out: str = "document") -> DataFrame:
    """``# {title}\\n\\n{text}``."""
    return df.withColumn(out, F.concat(F.lit("# "), F.col(title_col), F.lit("\n\n"), F.col(text_col)))


def train_val_docs(docs: DataFrame, order_cols, text_col: str = "text") -> DataFrame:
    """Split stripped, non-empty docs: val = last doc; with <= 2 docs train is
    the first and val the second (or the same one). ``order_cols`` are unique.
    Train rows are repeated ``max(1, 500000 // total_chars)`` times. Adds ``split`` and ``copy``."""
    d = docs.withColumn(text_col, strip(text_col)).filter(F.length(text_col) > 0)
    key = F.struct(*order_cols)
    # the last document is known by its key, so that no text is moved to find it
    n, last = d.select(F.count("*")).scalar(), d.select(F.max(key)).scalar()
    mult = corpus_multiplier(d, text_col)
    is_val = key.eqNullSafe(last)
    is_train = ~is_val | (n == 1)
    train = d.filter(is_train).withColumn("split", F.lit("train"))
    train = train.withColumn("copy", F.explode(F.sequence(F.lit(1), mult)))
    val = d.filter(is_val).withColumn("split", F.lit("val")).withColumn("copy", F.lit(1))
    return train.unionByName(val)
