"""Order-dependent building blocks: prefix sums and dense positions.

Running totals over a whole table (or over one group that may hold a
large share of it) must not go through a ``Window`` that puts the group
into one task. ``prefix_sum`` works on *blocks* instead:

* every row gets a block number: how many *splitters* its order key (all
  order columns together) has reached. Splitters are quantiles of a sample of
  about ``SAMPLE_PER_BLOCK`` keys per block, taken by a hash of the key, so
  outliers, ids with a common prefix, time stamps and a hot leading key all
  give blocks of about ``rows_per_block`` rows. They are values in the plan:
  a block is a function of the row alone, and a recomputed task after an
  executor loss gets the same block - nothing depends on shuffle order or
  partition ids;
* one grouped aggregation gives the total per block (small table);
  a window over that table, of at most ``max_blocks`` rows per group, gives
  each block its starting offset;
* a window partitioned by (group, block) adds the local running sum.

A table of no more than ``rows_per_block`` rows is one block. Counting the
rows and drawing the sample are two jobs while the plan is built (one for a
small table); they read the order columns only. Callers whose keys are spread
evenly by themselves (md5 keys) pass their own ``block`` column instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_BLOCK = 1 << 16
MAX_BLOCKS = 1 << 12
SAMPLE_PER_BLOCK = 32
CELLS = 1 << 12             # first three digits of a seeded key
SEEDED_ROWS = 1 << 18       # rows of a block in seeded order


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _order_key(order_cols) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(_cols(order_cols))])


def quantile_block(df: DataFrame, order_cols, rows_per_block: int = ROWS_PER_BLOCK,
                   max_blocks: int = MAX_BLOCKS) -> Column | None:
    """Block number of a row of ``df``, non-decreasing in ``order_cols`` order
    (nulls first); None if the whole table is one block."""
    return _quantile_blocks(df, order_cols, rows_per_block, max_blocks)[0]


def _quantile_blocks(df: DataFrame, order_cols, rows_per_block: int, max_blocks: int) -> tuple[Column | None, int]:
    """``quantile_block`` and how many blocks there are."""
    cuts, n = _quantile_cuts(df, order_cols, rows_per_block, max_blocks)
    return (_reached(cuts, n, _order_key(order_cols)) if n else None), n + 1


def _quantile_cuts(df: DataFrame, order_cols, rows_per_block: int, max_blocks: int) -> tuple[Column | None, int]:
    """The order keys that blocks after the first begin with, ascending, and
    how many they are."""
    n = df.count()
    blocks = min(max_blocks, -(-n // rows_per_block))
    if blocks <= 1:
        return None, 0
    share = min(1.0, SAMPLE_PER_BLOCK * blocks / n)
    drawn = F.pmod(F.xxhash64(*_cols(order_cols)), F.lit(1 << 40)) < F.lit(int(share * (1 << 40)) + 1)
    sample = df.filter(drawn).select(_order_key(order_cols).alias("k"))
    # as JSON, the one form in which keys of any type are a literal of the plan
    keys = [r.j for r in sample.sort("k").select(F.to_json(F.struct("k")).alias("j")).collect()]
    cuts = sorted({i * len(keys) // blocks for i in range(1, blocks)}) if keys else []
    if not cuts:
        return None, 0
    parsed = F.from_json(F.lit("[" + ",".join(keys[i] for i in cuts) + "]"), T.ArrayType(sample.schema))
    return parsed["k"], len(cuts)


def _reached(cuts: Column, n: int, key: Column) -> Column:
    """How many of the ``n`` ascending ``cuts`` are at most ``key``."""
    def halve(r, _):
        mid = F.floor((r["lo"] + r["hi"]) / 2).cast("int")
        return (F.when(r["lo"] >= r["hi"], r)
                 .when(F.get(r["cuts"], mid) <= r["key"], F.struct((mid + 1).alias("lo"), r["hi"].alias("hi"),
                                                                  r["cuts"].alias("cuts"), r["key"].alias("key")))
                 .otherwise(F.struct(r["lo"].alias("lo"), mid.alias("hi"), r["cuts"].alias("cuts"),
                                     r["key"].alias("key"))))

    start = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"), cuts.alias("cuts"), key.alias("key"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(n.bit_length() + 1)), start, halve)["lo"]


def _with_reached(df: DataFrame, order_cols, cuts: Column, n: int, out: str) -> DataFrame:
    """``_reached`` as a column ``out``, by compiled code: a projection for
    each halving, and comparisons of plain values, column by column."""
    keys = [f"_tm_o{i}" for i in range(len(order_cols))]
    d = df.withColumns(dict(zip(keys, _cols(order_cols)))).withColumn(out, F.lit(0))
    step = 1 << (n.bit_length() - 1)
    while step:
        reached = None
        for i in reversed(range(len(keys))):
            # in Spark's order: nulls are before all else
            cut, key = F.get(cuts[f"o{i}"], F.col(out) + F.lit(step - 1)), F.col(keys[i])
            if reached is None:
                reached = cut.isNull() | (key.isNotNull() & (cut <= key))
            else:
                reached = (key.isNotNull() & (cut.isNull() | (cut < key))) | (cut.eqNullSafe(key) & reached)
        # places beyond the last cut are none of the cuts
        reached = (F.col(out) + F.lit(step) <= F.lit(n)) & reached
        d = d.withColumn(out, F.col(out) + F.when(reached, F.lit(step)).otherwise(F.lit(0)))
        step //= 2
    return d.drop(*keys)


def prefix_sum(df: DataFrame, order_cols, value: str | Column | None = None,
               group_cols=(), out: str = "cum_before", block: Column | None = None,
               rows_per_block: int = ROWS_PER_BLOCK, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Add ``out`` = sum of ``value`` over earlier rows of the same group.

    ``value=None`` counts rows, so ``out`` is the 0-based position. The
    order key must be unique within a group. ``block`` (optional) must be
    non-decreasing in the order within a group.
    """
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    v = F.lit(1).cast("long") if value is None else (
        F.col(value) if isinstance(value, str) else value).cast("long")
    blocks, keyed = 0, df
    if block is None:
        cuts, n_cuts = _quantile_cuts(df, order_cols, rows_per_block, max_blocks)
        if n_cuts:
            keyed = _with_reached(df, order_cols, cuts, n_cuts, "_tm_b")
            block, blocks = F.col("_tm_b"), n_cuts + 1
    if block is None:
        w = (Window.partitionBy(*_cols(group_cols)).orderBy(*_cols(order_cols))
             .rowsBetween(Window.unboundedPreceding, -1))
        return df.withColumn(out, F.coalesce(F.sum(v).over(w), F.lit(0)).cast("long"))
    d = _with_key(keyed, group_cols, block).withColumn("_tm_v", v)
    sums = d.groupBy("_tm_k").agg(F.sum("_tm_v").alias("_tm_s"))
    w_off = _blocks_before(group_cols)
    offsets = sums.select("_tm_k", F.coalesce(F.sum("_tm_s").over(w_off), F.lit(0)).alias("_tm_off"))
    w_loc = (Window.partitionBy("_tm_k").orderBy(*_cols(order_cols))
             .rowsBetween(Window.unboundedPreceding, -1))
    # what is made of the rows next may be many times as many, in the same task:
    # a task gets a few blocks, however small their rows are
    d = d.repartition(blocks, "_tm_k") if blocks else d
    local = d.withColumn("_tm_loc", F.coalesce(F.sum("_tm_v").over(w_loc), F.lit(0)))
    joined = local.join(offsets, on="_tm_k", how="inner")
    return (joined.withColumn(out, (F.col("_tm_off") + F.col("_tm_loc")).cast("long"))
                  .select(*df.columns, out))


def _with_key(df: DataFrame, group_cols, block: Column) -> DataFrame:
    """The block key as one struct: nulls in it are equal to each other, in
    windows as in joins, so a null group is a group like any other."""
    parts = [F.col(c).alias(f"g{i}") for i, c in enumerate(group_cols)]
    return df.withColumn("_tm_k", F.struct(*parts, block.alias("b")))


def _blocks_before(group_cols):
    groups = [F.col(f"_tm_k.g{i}") for i in range(len(group_cols))]
    return Window.partitionBy(*groups).orderBy(F.col("_tm_k.b")).rowsBetween(Window.unboundedPreceding, -1)


def prefix_extreme(df: DataFrame, order_cols, value: str, group_cols=(), out: str = "min_before",
                   kind: str = "min", block: Column | None = None,
                   rows_per_block: int = ROWS_PER_BLOCK, max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """Add ``out`` = min (or max) of ``value`` over earlier rows of the group
    (NULL for the first row). Same block scheme as ``prefix_sum``: the
    extreme of all earlier blocks comes from a window over the small block
    table, the in-block part from a window bounded by one block."""
    group_cols = list(group_cols)
    order_cols = list(order_cols)
    fn = F.min if kind == "min" else F.max
    comb = F.least if kind == "min" else F.greatest
    if block is None:
        block = quantile_block(df, order_cols, rows_per_block, max_blocks)
    if block is None:
        w = (Window.partitionBy(*_cols(group_cols)).orderBy(*_cols(order_cols))
             .rowsBetween(Window.unboundedPreceding, -1))
        return df.withColumn(out, fn(value).over(w))
    d = _with_key(df, group_cols, block)
    ext = d.groupBy("_tm_k").agg(fn(value).alias("_tm_e"))
    offsets = ext.select("_tm_k", fn("_tm_e").over(_blocks_before(group_cols)).alias("_tm_off"))
    w_loc = (Window.partitionBy("_tm_k").orderBy(*_cols(order_cols))
             .rowsBetween(Window.unboundedPreceding, -1))
    local = d.withColumn("_tm_loc", fn(value).over(w_loc))
    joined = local.join(offsets, on="_tm_k", how="inner")
    return joined.withColumn(out, comb("_tm_off", "_tm_loc")).select(*df.columns, out)


def global_position(df: DataFrame, order_cols, group_cols=(), out: str = "pos",
                    block: Column | None = None) -> DataFrame:
    """Dense 0-based position in ``order_cols`` order within ``group_cols``."""
    return prefix_sum(df, order_cols, None, group_cols, out, block)


def seeded_key(seed, *id_cols) -> Column:
    """Sort key of the seeded order: ``md5(seed || ':' || id)``.

    The same expression runs in DuckDB, so oracles can replay the order.
    """
    parts = [F.lit(str(seed)), F.lit(":")]
    for i, c in enumerate(id_cols):
        if i:
            parts.append(F.lit(":"))
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.md5(F.concat(*parts))


def seeded_position(df: DataFrame, seed, id_cols, out: str = "pos", rows_per_block: int = SEEDED_ROWS) -> DataFrame:
    """Dense 0-based position in the order of ``seeded_key``, then of the ids,
    which are unique together and without nulls.

    Digests are spread evenly, so no sample is needed: a block is a range of
    their first three digits and one task sorts a whole block. What comes before
    a block is a value in the plan, from one count by these digits, so ``df`` is
    read twice. As a task has all rows of its block in one order, a recomputed
    one gives them the same positions."""
    key = seeded_key(seed, *id_cols)
    cell = F.substring(key, 1, 3)
    counts = {int(c, 16): n for c, n in df.groupBy(cell.alias("c")).count().collect()}
    blocks = max(1, min(CELLS, -(-sum(counts.values()) // rows_per_block)))
    before = [0] * (blocks + 1)
    for c, n in counts.items():
        before[c * blocks // CELLS + 1] += n
    for b in range(blocks):
        before[b + 1] += before[b]
    # as bytes, so that Spark compares the first eight at once
    d = df.withColumns({"_tm_k": F.unhex(key), "_tm_b": F.floor(F.conv(cell, 16, 10).cast("int") * F.lit(blocks) / F.lit(CELLS)).cast("int")})
    d = d.repartitionById(blocks, "_tm_b").sortWithinPartitions("_tm_k", *id_cols)
    starts = F.from_json(F.lit(str(before)), "array<bigint>")
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))  # the row's place in its task
    return d.withColumn(out, F.get(starts, "_tm_b") + place).drop("_tm_k", "_tm_b")


def seeded_int(seed, *id_cols) -> Column:
    """Deterministic 32-bit draw from ``md5(seed:ids)`` (first 8 hex digits).

    DuckDB replays it as ``cast('0x' || substr(md5(...), 1, 8) as bigint)``.
    """
    return F.conv(F.substring(seeded_key(seed, *id_cols), 1, 8), 16, 10).cast("long")
