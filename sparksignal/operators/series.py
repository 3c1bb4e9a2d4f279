"""Ordered-series operators.

The reference orders every window by ``date`` with no partition key, which Spark runs as one sorted
partition.  ``partition_by`` runs independent series (e.g. one per symbol) in parallel.  A single series of any
length runs in blocks: ``in_blocks`` numbers the rows by prefix sums over calendar blocks, cuts the numbers into blocks
of equal size, and gives each block copies of the few rows beside it that its windows look at; ``own_rows``
drops the copies again.  Running sums add prefix sums over the blocks' totals.  What meets in one place is one row per
calendar block.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _window(order: str | Sequence[str], partition_by: Sequence[str] | None = None):
    order_cols = [order] if isinstance(order, str) else list(order)
    w = Window.orderBy(*order_cols)
    if partition_by:
        w = Window.partitionBy(*partition_by).orderBy(*order_cols)
    return w


def _r(c: Column, digits: int | None) -> Column:
    return F.round(c, digits) if digits is not None else c


BLOCK_ROWS, BLOCK_DAYS = 4096, 1024
BLOCK, OWN = "_block", "_own"
_NULLS_FIRST = -(1 << 40)  # calendar block of rows without a date


def _calendar_block(order: str, days: int) -> Column:
    day = F.datediff(F.col(order).cast("date"), F.lit("1970-01-01").cast("date"))
    return F.coalesce(F.floor(day / days), F.lit(_NULLS_FIRST)).cast("long")


def _before_blocks(df: DataFrame, block: str, **totals: Column) -> Column:
    """Map from block to the sums of ``totals`` over all blocks before it: a scalar subquery over one row per block."""
    each = df.groupBy(block).agg(*[t.alias(n) for n, t in totals.items()])
    w = Window.orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    sums = F.struct(*[F.coalesce(F.sum(n).over(w), F.lit(0)).alias(n) for n in totals])
    placed = each.select(F.struct(F.col(block), sums.alias("sums")).alias("e"))
    return placed.agg(F.map_from_entries(F.collect_list("e"))).scalar()


def in_blocks(df: DataFrame, before: int, after: int = 0, order: str = "date", rows: int = BLOCK_ROWS, days: int = BLOCK_DAYS) -> DataFrame:
    """``df`` with ``BLOCK`` to partition windows by and ``OWN``, false for copies of neighbouring rows.

    A window over up to ``before`` rows before and ``after`` rows after its row gives the same value for a
    block's own rows as over the whole series.
    """
    if max(before, after) >= rows:
        raise ValueError("a block must be longer than what its windows look at")
    numbered = df.withColumn("_c", _calendar_block(order, days))
    base = _before_blocks(numbered, "_c", n=F.count(F.lit(1)))
    inside = F.row_number().over(Window.partitionBy("_c").orderBy(order))
    at = F.try_element_at(base, F.col("_c"))["n"] + inside - 1
    numbered = numbered.withColumn("_at", at).drop("_c")
    block, place = F.floor(F.col("_at") / rows).cast("long"), F.col("_at") % rows
    homes = F.array_compact(F.array(block, F.when(place >= rows - before, block + 1), F.when(place < after, block - 1)))
    out = numbered.select(*df.columns, "_at", F.explode(homes).alias(BLOCK))
    return out.withColumn(OWN, F.floor(F.col("_at") / rows) == F.col(BLOCK)).drop("_at")


def own_rows(df: DataFrame) -> DataFrame:
    return df.where(OWN).drop(BLOCK, OWN)


def rolling_mean(df: DataFrame, col: str, n: int, out: str, order: str = "date",
                 partition_by: Sequence[str] | None = None, digits: int | None = 4) -> DataFrame:
    """Mean of the last ``n`` rows (current included); partial windows allowed."""
    w = _window(order, partition_by).rowsBetween(-(n - 1), 0)
    return df.withColumn(out, _r(F.avg(col).over(w), digits))


def delta(df: DataFrame, col: str, out: str, order: str = "date",
          partition_by: Sequence[str] | None = None, digits: int | None = 4) -> DataFrame:
    """``x - lag(x)``; null on the first row."""
    w = _window(order, partition_by)
    return df.withColumn(out, _r(F.col(col) - F.lag(col, 1).over(w), digits))


def next_day_label(df: DataFrame, col: str = "close", out: str = "price_direction",
                   order: str = "date", partition_by: Sequence[str] | None = None,
                   null_last: bool = False, keep_next: str | None = None) -> DataFrame:
    """1 when the next row's value is higher, else 0.

    The reference maps a missing next value to 0, so the last day is "Down"
    (T4); ``null_last=True`` gives null there instead.
    """
    w = _window(order, partition_by)
    nxt = F.lead(col, 1).over(w)
    label = F.when(nxt > F.col(col), F.lit(1))
    label = label.when(nxt.isNull(), F.lit(None)) if null_last else label
    out_df = df.withColumn(out, label.otherwise(F.lit(0)).cast("int"))
    if keep_next:
        out_df = out_df.withColumn(keep_next, nxt)
    return out_df


def shift(df: DataFrame, col: str, out: str, offset: int = -1, order: str = "date",
          partition_by: Sequence[str] | None = None) -> DataFrame:
    """pandas-style ``shift(offset)``: -1 is the next row's value (W7), 1 the previous."""
    w = _window(order, partition_by)
    expr = F.lead(col, -offset).over(w) if offset < 0 else F.lag(col, offset).over(w)
    return df.withColumn(out, expr)


def running_mean(df: DataFrame, col: str, out: str, order: str = "date",
                 partition_by: Sequence[str] | None = None, digits: int | None = 4) -> DataFrame:
    """Mean of all rows up to the current one.

    Without ``partition_by``: the running sum inside a calendar block, plus the prefix sums of the blocks before.
    """
    if partition_by:
        w = _window(order, partition_by).rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumn(out, _r(F.avg(col).over(w), digits))
    blocked = df.withColumn("_c", _calendar_block(order, BLOCK_DAYS))
    value = F.col(col).cast("double")
    base = F.try_element_at(_before_blocks(blocked, "_c", total=F.coalesce(F.sum(value), F.lit(0.0)), n=F.count(col)), F.col("_c"))
    w = Window.partitionBy("_c").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    total = base["total"] + F.coalesce(F.sum(value).over(w), F.lit(0.0))
    return blocked.withColumn(out, _r(F.try_divide(total, base["n"] + F.count(col).over(w)), digits)).drop("_c")


def recent_vs_previous(df: DataFrame, col: str, out: str, n: int = 3, order: str = "date",
                       partition_by: Sequence[str] | None = None) -> DataFrame:
    """Per row: mean of the last ``n`` rows minus mean of the ``n`` before.

    With fewer than ``2n`` rows so far: current minus first if there are at
    least 2 rows, else 0.0 -- the reference's rule evaluated at every row.
    """
    w = _window(order, partition_by)
    recent = F.avg(col).over(w.rowsBetween(-(n - 1), 0))
    before = F.avg(col).over(w.rowsBetween(-(2 * n - 1), -n))
    first = F.first(col).over(w.rowsBetween(Window.unboundedPreceding, 0))
    idx = F.row_number().over(w)
    expr = (F.when(idx >= 2 * n, recent - before)
            .when(idx >= 2, F.col(col) - first).otherwise(F.lit(0.0)))
    return df.withColumn(out, expr)


def minmax_scale(df: DataFrame, cols: Sequence[tuple[str, str]], fill: dict | None = None,
                 negate: Sequence[str] = (),
                 partition_by: Sequence[str] | None = None) -> DataFrame:
    """Whole-column min-max scaling to [-1, 1]; 0.0 for a constant column.

    Column min/max come from one aggregate evaluated as scalar subqueries
    (``DataFrame.scalar()``): Spark runs it once and inlines the values, so
    there is neither a single-partition window nor a cross join.  ``negate``
    flips a signal; ``+ 0.0`` turns the resulting -0.0 into 0.0 (T10).
    With ``partition_by`` each series has its own min/max, from an aggregate per series joined back: a series
    with most of the rows is not gathered in one task.
    """
    fill = fill or {}
    src = {c: F.coalesce(F.col(c), F.lit(fill[c])) if c in fill else F.col(c) for c, _ in cols}
    ends = [F.min(src[c]) for c, _ in cols], [F.max(src[c]) for c, _ in cols]
    names = [[f"_{side}{i}" for i in range(len(cols))] for side in ("mn", "mx")]
    stats = [e.alias(n) for ns, es in zip(names, ends) for n, e in zip(ns, es)]
    if partition_by:
        each = df.groupBy(*partition_by).agg(*stats)  # one row per series
        keys = [F.col(k).alias(f"_k{i}") for i, k in enumerate(partition_by)]
        each = each.select(*keys, *[n for ns in names for n in ns])
        match = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(partition_by)]
        joined = df.join(each, reduce(lambda x, y: x & y, match)).drop(*[f"_k{i}" for i in range(len(keys))])
        ends = [[F.col(n) for n in ns] for ns in names]
    else:
        joined, row = df, df.agg(F.struct(*stats)).scalar()
        ends = [[row[n] for n in ns] for ns in names]
    out = joined
    for (c, name), mn, mx in zip(cols, *ends):
        scaled = F.when(mx == mn, F.lit(0.0)).otherwise(
            F.lit(2.0) * (src[c] - mn) / (mx - mn) - F.lit(1.0))
        if name in negate:
            scaled = -scaled + F.lit(0.0)
        out = out.withColumn(name, scaled)
    return out.drop(*[n for ns in names for n in ns])
