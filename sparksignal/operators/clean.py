"""Clean layer: normalise, drop incomplete rows, deduplicate, union feeds.

Dedup is a keyed aggregate (``min_by`` of the whole row by an explicit order),
not ``row_number`` over a window: the aggregate combines map-side, so a key
holding a third of all rows collapses to one row per task before the shuffle,
and the kept row is deterministic (``dropDuplicates`` keeps an arbitrary one).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal import schemas
from sparksignal.functions import text


def to_date_safe(c: str | Column, fmt: str | None = None) -> Column:
    """``try_to_date``: unparseable -> null instead of an ANSI error."""
    x = F.col(c) if isinstance(c, str) else c
    return F.try_to_date(x) if fmt is None else F.try_to_date(x, fmt)


def to_timestamp_safe(c: str | Column, fmt: str | None = None) -> Column:
    """Error-tolerant timestamp parse (``errors="coerce"``): junk -> null."""
    x = F.col(c) if isinstance(c, str) else c
    return F.try_to_timestamp(x) if fmt is None else F.try_to_timestamp(x, F.lit(fmt))


def normalise(df: DataFrame, date_col: str = "date", trim_cols: Sequence[str] = ()) -> DataFrame:
    """Date string -> DATE, trimmed text columns."""
    out = df
    if dict(df.dtypes).get(date_col) == "string":
        out = out.withColumn(date_col, to_date_safe(date_col))
    for c in trim_cols:
        out = out.withColumn(c, F.trim(F.col(c)))
    return out


def drop_incomplete(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Drop rows where any required column is null or NaN."""
    return df.dropna(subset=list(required))


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column],
               descending: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``.

    Implemented as ``groupBy(keys).agg(min_by(row, order))`` so partial
    aggregation collapses hot keys before the shuffle.
    """
    cols = df.columns
    key_exprs = [F.col(k) if isinstance(k, str) else k for k in keys]
    key_names = [f"__k{i}" for i in range(len(key_exprs))]
    ordering = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    row = F.struct(*[F.col(c) for c in cols])
    pick = F.max_by(row, ordering) if descending else F.min_by(row, ordering)
    grouped = (df.select(*[e.alias(n) for e, n in zip(key_exprs, key_names)], *cols)
               .groupBy(*key_names).agg(pick.alias("__row")))
    return grouped.select("__row.*")


def key_digest(*cols: str | Column) -> Column:
    """SHA-256 of a key's values; lengths keep neighbours apart, a null differs from an empty text."""
    parts = []
    for c in cols:
        x = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(x).cast("string"), F.lit(":"), x), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def keep_first_values(df: DataFrame, keys: Sequence[str | Column], order: str, values: Sequence[str],
                      descending: bool = False) -> DataFrame:
    """Keys, ``order`` and fixed-width ``values`` of the first (or last) row of each key (D1, narrow).

    With numbers, flags or dates as values and order the aggregate is a hash aggregate: no row is
    sorted.  A text belongs into ``keys`` as its digest (``key_digest``), not as itself.
    """
    pick, end = (F.max_by, F.max) if descending else (F.min_by, F.min)
    return df.groupBy(*keys).agg(*[pick(v, order).alias(v) for v in values], end(order).alias(order))


def keep_first_rows(df: DataFrame, keys: Sequence[str | Column], row_id: str, order: Sequence[str | Column] = (),
                    descending: bool = False) -> DataFrame:
    """Whole rows, the first (or last) of each key (D1): texts are only fetched for the winners.

    The winner of a key comes from an aggregate over the key's digest and ``row_id`` alone, a
    whole number unique to the row: a hash aggregate, no text in any sort or group key.  The rows are then
    fetched by a semi-join on ``row_id``.  Without ``order`` the row id itself decides; otherwise ``order``,
    whose texts should be short (or digests), then the row id.  ``df`` is read twice, so ``row_id`` must be
    stored with the rows, not generated by the plan.
    """
    best = F.max if descending else F.min
    narrow = df.select(key_digest(*keys).alias("key"), F.col(row_id).alias("id"),
                       *([F.struct(*order, row_id).alias("ord")] if order else []))
    pick = (F.max_by if descending else F.min_by)("id", "ord") if order else best("id")
    winners = narrow.groupBy("key").agg(pick.alias("winner")).select("winner")
    return df.join(winners, F.col(row_id) == F.col("winner"), "left_semi")


def clean_source(df: DataFrame, source: str, order: Sequence[str | Column],
                 descending: bool = False, required: Sequence[str] | None = None,
                 row_id: str | None = None) -> DataFrame:
    """Full clean step of one landed source: P1, P2, P3, D1.

    With ``row_id`` (a stored number unique to the row) the dedup fetches whole rows only for the
    winners (``keep_first_rows``).  ``required`` overrides the source's null-checked columns (default
    ``schemas.REQUIRED``), e.g. to skip a test on a column computed in-row
    that can never be null.
    """
    trim_cols = [] if source == "prices" else ["title"]
    out = normalise(df, "date", trim_cols)
    out = drop_incomplete(out, schemas.REQUIRED[source] if required is None else required)
    if row_id is not None:
        return keep_first_rows(out, schemas.DEDUP_KEYS[source], row_id, order, descending)
    return keep_first(out, schemas.DEDUP_KEYS[source], order, descending)


def union_feeds(frames: Sequence[DataFrame], feed_col: str = "feed_ord") -> DataFrame:
    """Union of feeds in declared order, tagging each row with its feed ordinal (V1)."""
    out = None
    for i, f in enumerate(frames):
        tagged = f.withColumn(feed_col, F.lit(i))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    return out


def first_seen(df: DataFrame, title_col: str = "title",
               order: Sequence[str] = ("feed_ord", "entry_ord"),
               within: Sequence[str] = ()) -> DataFrame:
    """First-seen-wins dedup on the stripped, lower-cased title (D2; with ``within`` = D3)."""
    keys: list[str | Column] = [*within, text.title_key(title_col)]
    return keep_first(df, keys, list(order))


def add_defaults(df: DataFrame, defaults: Mapping[str, tuple[object, T.DataType]]) -> DataFrame:
    """Add absent columns as typed literals, so the output schema is fixed (P5)."""
    out = df
    for name, (value, dtype) in defaults.items():
        if name not in out.columns:
            out = out.withColumn(name, F.lit(value).cast(dtype))
    return out


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Per-column null fill (P6) with ``coalesce`` so column types never change."""
    return df.select(*[
        F.coalesce(F.col(c), F.lit(values[c]).cast(t)).alias(c) if c in values else F.col(c)
        for c, t in df.dtypes
    ])
