"""Fixed schemas of the raw landing files and of the derived tables.

Raw landing files are read with an explicit schema applied by position (the CSV
header is skipped, not matched).  Every field is nullable; ``date`` lands as a
string and is converted with ``try_to_date``.  Sentiment is read as DOUBLE (a
FLOAT column would widen 0.1 to 0.10000000149 on the way to double).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, D, L, I = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_PRICES = _struct(("date", S), ("open", D), ("high", D), ("low", D), ("close", D),
                     ("volume", L))

RAW_POSTS = _struct(("date", S), ("subreddit", S), ("subreddit_group", S), ("title", S),
                    ("score", I), ("sentiment_compound", D), ("topic", S))

_NEWS = [("date", S), ("source", S), ("title", S), ("published_date", S), ("summary", S),
         ("sentiment_compound", D)]

RAW_NEWS = _struct(*_NEWS)

RAW_STATEMENTS = _struct(("date", S), ("source", S), ("query", S), ("title", S),
                         ("published_date", S), ("summary", S), ("sentiment_compound", D),
                         ("topic_tags", S))

RAW_CONFLICT_NEWS = _struct(*_NEWS, ("stance", S))

RAW_TENSION_NEWS = _struct(*_NEWS, ("escalation", S), ("iran_spillover", S))

RAW = {
    "prices": RAW_PRICES,
    "posts": RAW_POSTS,
    "news": RAW_NEWS,
    "statements": RAW_STATEMENTS,
    "conflict_news": RAW_CONFLICT_NEWS,
    "tension_news": RAW_TENSION_NEWS,
}

# Dedup keys of the clean layer (one row kept per key).
DEDUP_KEYS = {
    "prices": ["date"],
    "posts": ["date", "subreddit", "title"],
    "news": ["date", "source", "title"],
    "statements": ["date", "source", "title"],
    "conflict_news": ["date", "source", "title"],
    "tension_news": ["date", "source", "title"],
}

# Rows are dropped when any of these is null (or NaN).
REQUIRED = {
    "prices": ["date", "close"],
    "posts": ["date", "sentiment_compound"],
    "news": ["date", "sentiment_compound"],
    "statements": ["date", "sentiment_compound"],
    "conflict_news": ["date", "sentiment_compound"],
    "tension_news": ["date", "sentiment_compound"],
}

FEATURES = _struct(
    ("date", T.DateType()), ("open", D), ("high", D), ("low", D), ("close", D), ("volume", L),
    ("rolling_avg_7d", D), ("price_delta", D), ("reddit_sentiment_avg", D),
    ("sentiment_rolling_3d", D), ("news_sentiment", D), ("trump_sentiment_avg", D),
    ("trump_sentiment_rolling_3d", D), ("war_sentiment_avg", D), ("war_article_count", L),
    ("favor_count", L), ("against_count", L), ("favor_ratio", D), ("base_war_sentiment", D),
    ("base_sentiment_rolling_7d", D), ("price_direction", I),
)

DAILY_SUMMARY_COLUMNS = [
    "date", "avg_price", "min_price", "max_price", "avg_reddit_sentiment",
    "avg_news_sentiment", "rolling_avg_7d", "avg_price_delta", "avg_trump_sentiment",
    "trump_sentiment_rolling_3d", "avg_war_sentiment", "favor_count", "against_count",
    "favor_ratio", "base_war_sentiment", "base_sentiment_rolling_7d", "price_direction",
]

PREDICTION = _struct(("date", S), ("prediction", S), ("prediction_numeric", I),
                     ("confidence", D))

PRESSURE = _struct(("date", S), ("exit_probability", D), ("pressure_index", D),
                   ("base_sentiment_trend", S), ("base_sentiment_current", D),
                   ("favor_ratio", D), ("war_sentiment_avg", D))
