"""Feed ingest: landed RSS feeds -> rows of the news-like sources (S6, F3-F6, F8-F11,
F16, P7, V1, D2, D3).

Three feed kinds, as in the reference:

* ``headline`` feeds carry "Headline - Source" titles: the source is split off
  (default: the feed's name) and the title keeps the part before the last " - ";
* ``filtered`` feeds (a general world feed) keep only entries whose
  ``title + ' ' + summary`` matches a keyword pattern and get a fixed source;
* ``plain`` feeds (business news) use the feed's name as source, no dedup.

Sentiment, tags and flags are computed on the whole ``title + ' ' + summary``.
Feeds are unioned in declared order and deduplicated first-seen on
the stripped, lower-cased title across feeds; statement feeds first drop repeats of the
raw title inside each feed.  All steps are row-local projections plus one keyed
aggregate (the dedup), which combines map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksignal.functions import classify, sentiment, text
from sparksignal.operators import clean


@dataclass(frozen=True)
class Feed:
    name: str
    entries: DataFrame            # output of ``files.read_feed_xml``
    kind: str = "headline"        # "headline", "filtered" or "plain"
    pattern: str | None = None    # keyword filter of a "filtered" feed
    source: str | None = None     # fixed source of a "filtered" feed


def feed_rows(feed: Feed, feed_ord: int, as_of: Column, title_max: int | None = None,
              summary_max: int | None = None,
              lexicon: Mapping[str, float] = sentiment.DEFAULT_LEXICON) -> DataFrame:
    """One feed's entries as source rows with ``feed_ord`` / ``entry_ord`` for ordering.

    ``summary_max=1000`` reproduces the reference's stored-summary length; the
    default keeps the whole summary.  Scores always use the whole text.
    """
    e = feed.entries
    raw = F.col("title")
    if feed.kind == "filtered":
        e = e.where(text.keyword_flag(text.joined_text("title", "summary"), feed.pattern or ""))
        source, title = F.lit(feed.source or feed.name), raw
    elif feed.kind == "plain":
        source, title = F.lit(feed.name), raw
    else:
        source, title = text.split_source(raw, feed.name), text.strip_source(raw)
    e = e.select("feed_file", "entry_ord", raw.alias("raw_title"), title.alias("title"),
                 source.alias("source"), "summary", "published")
    body = text.joined_text("title", "summary")
    t = text.truncate("title", title_max) if title_max else F.col("title")
    s = text.truncate("summary", summary_max) if summary_max else F.col("summary")
    return e.select(
        text.rfc822_date("published", as_of).alias("date"),
        "source", t.alias("title"), F.col("published").alias("published_date"),
        s.alias("summary"),
        sentiment.lexicon_compound(body, lexicon).alias("sentiment_compound"),
        F.lit(feed_ord).alias("feed_ord"), "feed_file", "entry_ord", "raw_title",
        body.alias("_text"),
    )


def _collect(feeds: Sequence[Feed], as_of: Column, within_feed_raw: bool = False,
             **kw) -> DataFrame:
    rows = clean.union_feeds([feed_rows(f, i, as_of, **kw).drop("feed_ord")
                              for i, f in enumerate(feeds)])
    order = ["feed_ord", "feed_file", "entry_ord"]
    if within_feed_raw:  # D3: repeats of the raw title inside one feed
        rows = clean.first_seen(rows, "raw_title", order, within=["feed_ord"])
    return clean.first_seen(rows, "title", order)  # D2 across feeds


def conflict_news(feeds: Sequence[Feed], as_of: Column, **kw) -> DataFrame:
    """Conflict-news rows with stance."""
    r = _collect(feeds, as_of, **kw)
    return r.select("date", "source", "title", "published_date", "summary",
                    "sentiment_compound", classify.stance("sentiment_compound").alias("stance"))


def tension_news(feeds: Sequence[Feed], as_of: Column,
                 spillover: str = text.SPILLOVER_PATTERN, **kw) -> DataFrame:
    """Tension-news rows with escalation and the spillover flag as "True"/"False" (F9, F11)."""
    r = _collect(feeds, as_of, **kw)
    flag = text.keyword_flag("_text", spillover)
    return r.select("date", "source", "title", "published_date", "summary",
                    "sentiment_compound",
                    classify.escalation("sentiment_compound").alias("escalation"),
                    F.when(flag, F.lit("True")).otherwise(F.lit("False")).alias("iran_spillover"))


def statements(feeds: Sequence[Feed], as_of: Column,
               topics: Sequence[tuple[str, str]] = text.STATEMENT_TOPICS, **kw) -> DataFrame:
    """Statement rows: query name, topic tags; raw-title dedup inside each feed first (D3, F8)."""
    r = _collect(feeds, as_of, within_feed_raw=True, **kw)
    names = F.create_map(*[F.lit(x) for i, f in enumerate(feeds) for x in (i, f.name)])
    return r.select("date", "source", names[F.col("feed_ord")].alias("query"), "title",
                    "published_date", "summary", "sentiment_compound",
                    text.topic_tags("_text", topics).alias("topic_tags"))


def business_news(feeds: Sequence[Feed], as_of: Column, **kw) -> DataFrame:
    """Business-news rows: every entry of every feed, source = feed name."""
    rows = clean.union_feeds([feed_rows(f, i, as_of, **kw).drop("feed_ord")
                              for i, f in enumerate(feeds)])
    return rows.select("date", "source", "title", "published_date", "summary",
                       "sentiment_compound")


def posts_from_listings(posts: DataFrame, as_of: Column,
                        groups: Sequence[tuple[str, str]] = text.SUBREDDIT_GROUPS,
                        topics: Sequence[tuple[str, str]] = text.POST_TOPICS,
                        title_max: int | None = None,
                        lexicon: Mapping[str, float] = sentiment.DEFAULT_LEXICON) -> DataFrame:
    """Listing children (``files.read_listings``) -> post rows.

    Day = UTC day of ``created_utc`` (``as_of`` when 0/missing); sentiment and
    topic tags use the whole ``title + ' ' + selftext``; the group comes from the
    subreddit map.
    """
    body = text.joined_text("title", "selftext")
    title = text.safe_text("title")
    return posts.select(
        text.epoch_date("created_utc", as_of).alias("date"),
        "subreddit",
        text.subreddit_group("subreddit", groups).alias("subreddit_group"),
        (text.truncate(title, title_max) if title_max else title).alias("title"),
        F.coalesce(F.col("score"), F.lit(0)).alias("score"),
        sentiment.lexicon_compound(body, lexicon).alias("sentiment_compound"),
        text.topic_tags(body, topics).alias("topic"),
    )
