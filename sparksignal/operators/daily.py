"""Per-day and whole-table aggregates.

All are hash aggregates with a map-side partial step: a day (or key) holding a
third of the rows costs one partial row per task, not a hot reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparksignal.functions.text import credibility_weight


def daily_mean(df: DataFrame, value: str, out: str, by: Sequence[str] = ("date",)) -> DataFrame:
    """Mean per day (A1)."""
    return df.groupBy(*by).agg(F.avg(value).alias(out))


def weighted_daily_mean(df: DataFrame, value: str, out: str, weight: Column | None = None,
                        by: Sequence[str] = ("date",)) -> DataFrame:
    """Credibility-weighted mean ``sum(x*w)/sum(w)`` per day (A2, F2)."""
    w = credibility_weight("source") if weight is None else weight
    return df.groupBy(*by).agg((F.sum(F.col(value) * w) / F.sum(w)).alias(out))


def favor_ratio(favor: str | Column, against: str | Column, digits: int = 4) -> Column:
    """``favor / (favor + against)``, 0.5 when both are 0 (A5)."""
    f = F.col(favor) if isinstance(favor, str) else favor
    a = F.col(against) if isinstance(against, str) else against
    return F.round(F.when(f + a > 0, f / (f + a)).otherwise(F.lit(0.5)), digits)


def stance_daily(df: DataFrame, value: str = "sentiment_compound",
                 by: Sequence[str] = ("date",)) -> DataFrame:
    """Conflict-news day: weighted sentiment, article count, favor/against counts, ratio (A2-A5)."""
    w = credibility_weight("source")
    agg = df.groupBy(*by).agg(
        (F.sum(F.col(value) * w) / F.sum(w)).alias("war_sentiment_avg"),
        F.count(F.lit(1)).alias("war_article_count"),
        F.count_if(F.col("stance") == "favor").alias("favor_count"),
        F.count_if(F.col("stance") == "against").alias("against_count"),
    )
    return agg.withColumn("favor_ratio", favor_ratio("favor_count", "against_count"))


def tension_daily(df: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """Tension-news day: count(title), mean sentiment, escalation share, spillover share."""
    flag = F.when(F.lower(F.col("iran_spillover").cast("string")) == "true", 1.0).otherwise(0.0)
    return df.groupBy(*by).agg(
        F.count("title").alias("article_count"),
        F.avg("sentiment_compound").alias("avg_sentiment"),
        F.avg(F.when(F.col("escalation") == "escalation", 1.0).otherwise(0.0)).alias(
            "escalation_pct"),
        F.avg(flag).alias("iran_pct"),
    )


def value_counts(df: DataFrame, col: str, top: int | None = 10) -> DataFrame:
    """Counts per value, most frequent first, value as tie-break (A10)."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    out = out.orderBy(F.desc("count"), F.asc_nulls_last(col))
    return out.limit(top) if top else out


def describe(df: DataFrame, col: str) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75% (exact, interpolated), max."""
    q = quantiles(df, col, [0.25, 0.5, 0.75]).scalar()
    return df.agg(
        F.count(col).alias("count"), F.avg(col).alias("mean"),
        F.stddev_samp(col).alias("std"), F.min(col).alias("min"), F.max(col).alias("max"),
    ).select("count", "mean", "std", "min", q[0].alias("p25"), q[1].alias("p50"),
             q[2].alias("p75"), "max")


def quantiles(df: DataFrame, col: str, shares: Sequence[float], ranges: int = 256) -> DataFrame:
    """One row, one array column: exact quantiles, linearly interpolated between neighbours.

    Rows are counted per value with map-side combine; all else reads that one exchange.
    Approximate quantiles of the distinct values (a sketch of bounded size) only cut them into
    ``ranges`` ranges; places are prefix sums inside each range, after those over the ranges'
    totals, so no task holds all distinct values.  Nulls do not count; without values the
    quantiles are null.
    """
    values = df.where(F.col(col).isNotNull()).select(F.col(col).cast("double").alias("v"))
    marks = [i / ranges for i in range(1, ranges)]
    counts = values.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    cuts = counts.agg(F.percentile_approx(F.when(F.col("n") > 0, F.col("v")), marks, 100 * ranges)).scalar()
    each = counts.withColumn(
        # a value's place among the cuts; a lambda could not hold the scalar subquery
        "part", F.coalesce(F.array_position(F.sort_array(F.array_append(cuts, F.col("v"))), F.col("v")), F.lit(0)))
    sums = each.groupBy("part").agg(F.sum("n").alias("total"))  # one row per range
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("upto", F.sum("n").over(inside)).join(sums, "part").select(
        "v", (F.col("base") + F.col("upto")).alias("end"), "n")  # places end - n .. end - 1
    last = counts.agg(F.sum("n") - F.lit(1)).scalar()

    def at(place: Column) -> Column:
        return F.max(F.when((place < F.col("end")) & (place >= F.col("end") - F.col("n")), F.col("v")))

    found = []
    for s in shares:
        place = F.lit(float(s)) * last
        low, high = F.floor(place), F.ceil(place)
        found.append(F.struct(at(low).alias("low"), at(high).alias("high"),
                              F.max(place - low).alias("part")))
    out = placed.agg(F.array(*found).alias("found"))
    return out.select(F.transform("found", lambda x: F.when(x["low"] == x["high"], x["low"]).otherwise(
        x["low"] * (1 - x["part"]) + x["high"] * x["part"])).alias("quantiles"))


def date_span(df: DataFrame, col: str = "date", by: Sequence[str] = ()) -> DataFrame:
    """Rows and min/max date, overall or per group."""
    g = df.groupBy(*by) if by else df.groupBy()
    return g.agg(F.count(F.lit(1)).alias("n_rows"), F.min(col).alias("min_date"),
                 F.max(col).alias("max_date"))


def table_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """``(table, n_rows)`` for several tables, one global count each."""
    out = None
    for name, f in frames.items():
        row = f.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows")
        out = row if out is None else out.unionByName(row)
    return out
