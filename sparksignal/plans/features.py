"""Feature table (M1) and daily summary.

Plan shape: each event source is first aggregated to one row per day (partial
aggregation before the shuffle), its rolling columns are computed on that
day-grain frame (rows present in that source, T6), and only then joined to the
price days.  The joined sides are day-grain, so AQE broadcasts them at run
time when small and falls back to a sort-merge join beyond the threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal import schemas
from sparksignal.functions import classify
from sparksignal.functions.text import credibility_weight
from sparksignal.operators import clean, daily, series

# fixed values (columns and defaults of the reference's feature table)
FEATURE_DEFAULTS: dict[str, tuple[object, T.DataType]] = {
    "reddit_sentiment_avg": (0.0, T.DoubleType()),
    "sentiment_rolling_3d": (0.0, T.DoubleType()),
    "news_sentiment": (0.0, T.DoubleType()),
    "trump_sentiment_avg": (0.0, T.DoubleType()),
    "trump_sentiment_rolling_3d": (0.0, T.DoubleType()),
    "war_sentiment_avg": (0.0, T.DoubleType()),
    "war_article_count": (0, T.LongType()),
    "favor_count": (0, T.LongType()),
    "against_count": (0, T.LongType()),
    "favor_ratio": (0.5, T.DoubleType()),
    "base_war_sentiment": (0.0, T.DoubleType()),
    "base_sentiment_rolling_7d": (0.0, T.DoubleType()),
}
# rolling_avg_7d is not filled; price_delta is.
FEATURE_FILLS = {**{k: v for k, (v, _) in FEATURE_DEFAULTS.items()}, "price_delta": 0.0}

FEATURE_COLUMNS = [f.name for f in schemas.FEATURES.fields]


def price_features(prices: DataFrame, partition_by: Sequence[str] | None = None,
                   null_last_label: bool = False) -> DataFrame:
    """7-row rolling close, day-over-day delta, next-day direction.

    One series without ``partition_by`` runs in blocks of rows, several run each for itself.
    """
    if not partition_by:
        blocked = price_features(series.in_blocks(prices, before=6, after=1), [series.BLOCK], null_last_label)
        return series.own_rows(blocked)
    out = series.rolling_mean(prices, "close", 7, "rolling_avg_7d", partition_by=partition_by)
    out = series.delta(out, "close", "price_delta", partition_by=partition_by)
    return series.next_day_label(out, "close", "price_direction", partition_by=partition_by,
                                 null_last=null_last_label)


def posts_daily(posts: DataFrame) -> DataFrame:
    """Daily mean post sentiment + 3-row rolling mean."""
    d = daily.daily_mean(posts, "sentiment_compound", "reddit_sentiment_avg")
    return series.rolling_mean(d, "reddit_sentiment_avg", 3, "sentiment_rolling_3d")


def base_segment_daily(posts: DataFrame, group: str = "base", topic: str = "war") -> DataFrame:
    """Base-group posts tagged with the topic (substring test, T15), daily + 7-row rolling."""
    seg = posts.where((F.col("subreddit_group") == group) & F.col("topic").contains(topic))
    d = daily.daily_mean(seg, "sentiment_compound", "base_war_sentiment")
    return series.rolling_mean(d, "base_war_sentiment", 7, "base_sentiment_rolling_7d")


def posts_side(posts: DataFrame, group: str = "base", topic: str = "war", segment: Column | None = None) -> DataFrame:
    """Both post-derived daily sides from ONE pass over the posts.

    One day-grain aggregate gives the all-posts mean and the segment mean (only
    segment rows, T15).  The two rolling means count different rows (all post
    days vs. segment days, T6), so the day rows are stacked as two series and a
    single window partitioned by series computes both; a day-grain pivot puts
    them back side by side.  Everything after the aggregate is day-grain.  ``segment`` is the
    segment's condition when the posts carry it otherwise than by group and topic.
    """
    seg = (F.col("subreddit_group") == group) & F.col("topic").contains(topic) if segment is None else segment
    d = posts.groupBy("date").agg(
        F.avg("sentiment_compound").alias("_all"),
        F.avg(F.when(seg, F.col("sentiment_compound"))).alias("_seg"),
        F.count_if(seg).alias("_n_seg"),
    )
    entries = F.array(
        F.struct(F.lit("all").alias("series"), F.col("_all").alias("v")),
        F.when(F.col("_n_seg") > 0, F.struct(F.lit("seg").alias("series"),
                                             F.col("_seg").alias("v"))),
    )
    stacked = (d.select("date", F.explode(entries).alias("e")).where(F.col("e").isNotNull())
               .select("date", "e.series", "e.v"))
    stacked = series.rolling_mean(stacked, "v", 3, "r3", partition_by=["series"])
    stacked = series.rolling_mean(stacked, "v", 7, "r7", partition_by=["series"])
    is_all, is_seg = F.col("series") == "all", F.col("series") == "seg"
    return stacked.groupBy("date").agg(
        F.max(F.when(is_all, F.col("v"))).alias("reddit_sentiment_avg"),
        F.max(F.when(is_all, F.col("r3"))).alias("sentiment_rolling_3d"),
        F.max(F.when(is_seg, F.col("v"))).alias("base_war_sentiment"),
        F.max(F.when(is_seg, F.col("r7"))).alias("base_sentiment_rolling_7d"),
    )


def news_daily(news: DataFrame) -> DataFrame:
    """Credibility-weighted daily news sentiment (A2)."""
    return daily.weighted_daily_mean(news, "sentiment_compound", "news_sentiment")


def statements_daily(statements: DataFrame) -> DataFrame:
    """Daily statement sentiment + 3-row rolling mean."""
    d = daily.daily_mean(statements, "sentiment_compound", "trump_sentiment_avg")
    return series.rolling_mean(d, "trump_sentiment_avg", 3, "trump_sentiment_rolling_3d")


def conflict_daily(conflict: DataFrame) -> DataFrame:
    """Weighted sentiment, counts and favor ratio per day (A2-A5)."""
    return daily.stance_daily(conflict)


def side_sums(articles: DataFrame, news: Column | None = None, statements: Column | None = None,
              conflict: Column | None = None, stance: Column | None = None) -> DataFrame:
    """Per day and side the sums that its measures come from: ``date, side, vw, w, n, favor, against``.

    A row becomes an entry (day, side, value, weight) for each side whose condition holds (all
    sides by default), inside the scan's own stage; one aggregate with a map-side step adds them up.
    """
    always, weight, one = F.lit(True), credibility_weight("source"), F.lit(1.0)
    conditions = [("news", news, weight), ("statements", statements, one), ("conflict", conflict, weight)]
    entries = F.array_compact(F.array(*[
        F.when(always if cond is None else cond, F.struct(F.lit(name).alias("side"), w.alias("w"))) for name, cond, w in conditions]))
    stance = classify.stance("sentiment_compound") if stance is None else stance
    rows = articles.select("date", F.col("sentiment_compound").alias("v"), stance.alias("stance"), F.explode(entries).alias("e"))
    return rows.groupBy("date", F.col("e.side").alias("side")).agg(
        F.sum(F.col("v") * F.col("e.w")).alias("vw"), F.sum("e.w").alias("w"), F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("stance") == "favor").alias("favor"), F.count_if(F.col("stance") == "against").alias("against"))


def sides_from_sums(sums: DataFrame) -> DataFrame:
    """One row per day with the measures of all sides.

    The rolling mean runs on the stacked day rows with the side as partition key, over the days present in that side.
    """
    d = sums.withColumn("mean", F.col("vw") / F.col("w"))
    d = series.rolling_mean(d, "mean", 3, "r3", partition_by=["side"])

    def of(side: str, col: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col(col)))

    out = d.groupBy("date").agg(
        of("news", "mean").alias("news_sentiment"), of("statements", "mean").alias("trump_sentiment_avg"),
        of("statements", "r3").alias("trump_sentiment_rolling_3d"), of("conflict", "mean").alias("war_sentiment_avg"),
        of("conflict", "n").alias("war_article_count"), of("conflict", "favor").alias("favor_count"),
        of("conflict", "against").alias("against_count"))
    return out.withColumn("favor_ratio", daily.favor_ratio("favor_count", "against_count"))


def article_sides(articles: DataFrame, news: Column | None = None, statements: Column | None = None,
                  conflict: Column | None = None, stance: Column | None = None) -> DataFrame:
    """All daily sides of one deduplicated article table, in one pass."""
    return sides_from_sums(side_sums(articles, news, statements, conflict, stance))


def feature_table(prices: DataFrame, posts: DataFrame | None = None,
                  news: DataFrame | None = None, statements: DataFrame | None = None,
                  conflict: DataFrame | None = None,
                  null_last_label: bool = False,
                  partition_by: Sequence[str] = (),
                  articles: DataFrame | None = None, segment: Column | None = None) -> DataFrame:
    """One row per price day with 21 columns (M1).  Absent sources -> typed defaults.

    ``articles`` stands for ``news``, ``statements`` and ``conflict`` where one deduplicated table holds
    them all (``article_sides``); ``segment`` goes to ``posts_side``.

    ``partition_by`` names the series of ``prices`` (e.g. a symbol): each has its own
    windows and label, leads the columns, and meets the day-grain sides by date.
    """
    f = price_features(prices, partition_by=partition_by, null_last_label=null_last_label)
    sides: list[DataFrame] = []
    if posts is not None:
        sides.append(posts_side(posts, segment=segment))
    if articles is not None:
        sides.append(article_sides(articles))
    if news is not None:
        sides.append(news_daily(news))
    if statements is not None:
        sides.append(statements_daily(statements))
    if conflict is not None:
        sides.append(conflict_daily(conflict))
    for side in sides:
        f = f.join(side, "date", "left")
    f = clean.add_defaults(f, FEATURE_DEFAULTS)
    f = f.select(*partition_by, *FEATURE_COLUMNS)
    return clean.fill_nulls(f, FEATURE_FILLS)


def daily_summary(features: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Roll features up to one row per date (and series) with the reference's rounding."""
    r = F.round
    return features.groupBy(*partition_by, "date").agg(
        r(F.avg("close"), 2).alias("avg_price"),
        r(F.min("low"), 2).alias("min_price"),
        r(F.max("high"), 2).alias("max_price"),
        r(F.avg("reddit_sentiment_avg"), 4).alias("avg_reddit_sentiment"),
        r(F.avg("news_sentiment"), 4).alias("avg_news_sentiment"),
        r(F.avg("rolling_avg_7d"), 2).alias("rolling_avg_7d"),
        r(F.avg("price_delta"), 4).alias("avg_price_delta"),
        r(F.avg("trump_sentiment_avg"), 4).alias("avg_trump_sentiment"),
        r(F.avg("trump_sentiment_rolling_3d"), 4).alias("trump_sentiment_rolling_3d"),
        r(F.avg("war_sentiment_avg"), 4).alias("avg_war_sentiment"),
        F.sum("favor_count").alias("favor_count"),
        F.sum("against_count").alias("against_count"),
        r(F.avg("favor_ratio"), 4).alias("favor_ratio"),
        r(F.avg("base_war_sentiment"), 4).alias("base_war_sentiment"),
        r(F.avg("base_sentiment_rolling_7d"), 4).alias("base_sentiment_rolling_7d"),
        F.max("price_direction").alias("price_direction"),
    )


def last_n(df: DataFrame, n: int = 30, order: str = "date") -> DataFrame:
    """Last ``n`` rows by ``order`` (rows, not calendar days), ascending (K3, O3).

    ``orderBy(desc).limit(n)`` plans as TakeOrderedAndProject: each task keeps
    its own top ``n``; only ``n`` rows per task reach the final merge.
    """
    return df.orderBy(F.desc(order)).limit(n).orderBy(order)
