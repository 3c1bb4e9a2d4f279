"""Row-local text expressions (all JVM-side, no UDF).

Each helper returns a ``Column``; they compose inside one projection so a
whole clean step stays in a single whole-stage-codegen span.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's patterns and names) -----------
# Topic patterns for social posts, in declared order.
POST_TOPICS = [
    ("trump", r"\b(trump|maga|truth.?social|potus)\b"),
    ("oil", r"\b(oil|crude|opec|barrel|brent|wti|petroleum|energy)\b"),
    ("war", r"\b(iran|israel|war|conflict|houthi|hormuz|yemen|military|"
            r"hezbollah|hamas|gaza|missile|attack|sanction)\b"),
]
# Topic patterns for statement news, in declared order.
STATEMENT_TOPICS = [
    ("oil", r"\b(oil|crude|barrel|opec|brent|wti|petroleum|energy)\b"),
    ("iran", r"\b(iran|tehran|khamenei|rouhani|persian)\b"),
    ("israel", r"\b(israel|netanyahu|idf|gaza|hamas|hezbollah)\b"),
    ("hormuz", r"\b(hormuz|strait|naval|blockade)\b"),
    ("war", r"\b(war|conflict|military|strike|attack|bomb|missile)\b"),
    ("sanctions", r"\b(sanction|tariff|embargo|trade.?war|ban)\b"),
    ("truth_social", r"\b(truth.?social|tweet|post|truth)\b"),
]
# Relevance filter for the general world feed (conflict news).
CONFLICT_FILTER = (r"\b(oil|crude|opec|iran|israel|houthi|hormuz|yemen|war|conflict|"
                   r"sanction|missile|attack|military|barrel|brent|wti|energy|petroleum|"
                   r"hezbollah|hamas|gaza|idf|naval)\b")
# Relevance filter for the general world feed (tension news).
TENSION_FILTER = (r"\b(taiwan|taipei|tsmc|semiconductor|china\s+military|chinese\s+navy|"
                  r"pla|south\s+china\s+sea|strait|xi\s+jinping|reunification|"
                  r"blockade|invasion|drills?|exercises?|warship|fighter\s+jet|"
                  r"pacific\s+fleet|aukus|indo-?pacific)\b")
# Spillover flag keywords.
SPILLOVER_PATTERN = r"\b(iran|tehran|hezbollah|houthi|hormuz|gulf|missile|nuclear)\b"
# Sources that get the credibility weight.
CREDIBLE_SOURCES = "wall street|wsj|reuters|bloomberg"
CREDIBLE_WEIGHT = 1.25
# Subreddit -> group.
SUBREDDIT_GROUPS = [
    ("geopolitics", "general"), ("economy", "general"), ("worldnews", "general"),
    ("energy", "general"), ("oil", "general"), ("politics", "base"),
    ("conservative", "base"),
]
# Month names of a feed stamp, short or long.
MONTHS = ("jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
          "sep(?:tember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?")
TWO_DIGIT_PIVOT = 68  # two-digit years up to this one belong to the 2000s
# -----------------------------------------------------------------------------


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ci(pattern: str) -> str:
    """Case-insensitive form of a Java regex."""
    return pattern if pattern.startswith("(?i)") else "(?i)" + pattern


def safe_text(c: str | Column) -> Column:
    """``x or ""``."""
    return F.coalesce(col_(c), F.lit(""))


def joined_text(*cols: str | Column) -> Column:
    """``f"{a} {b}"`` with nulls as empty strings."""
    return F.concat_ws(" ", *[safe_text(c) for c in cols])


def truncate(c: str | Column, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(col_(c), 1, n)


def topic_tags(text: str | Column, topics: Sequence[tuple[str, str]] = POST_TOPICS,
               default: str = "general") -> Column:
    """Comma-joined tags in declared order, ``default`` when none match (F8)."""
    t = col_(text)
    parts = [F.when(t.rlike(ci(p)), F.lit(tag)) for tag, p in topics]
    joined = F.concat_ws(",", *parts)  # referenced once: each regex runs once per row
    return F.coalesce(F.nullif(joined, F.lit("")), F.lit(default))


def keyword_flag(text: str | Column, pattern: str) -> Column:
    """Case-insensitive regex search as a boolean (F9, P7); null text -> false."""
    return F.coalesce(col_(text).rlike(ci(pattern)), F.lit(False))


def strip(c: str | Column) -> Column:
    """Text without white space of any kind at both ends (``trim`` removes spaces only)."""
    return F.regexp_replace(col_(c), r"(?U)^\s+|\s+$", "")


def split_source(title: str | Column, default: str | Column = "unknown") -> Column:
    """Source after the last ``" - "`` of a headline, else ``default``."""
    t = col_(title)
    d = F.lit(default) if isinstance(default, str) else default
    return F.when(t.contains(" - "), strip(F.substring_index(t, " - ", -1))).otherwise(d)


def strip_source(title: str | Column) -> Column:
    """Headline without its trailing ``" - Source"``."""
    t = col_(title)
    head = F.regexp_replace(t, r"(?s)^(.*) - .*$", "$1")
    return F.when(t.contains(" - "), strip(head)).otherwise(t)


def title_key(title: str | Column) -> Column:
    """Dedup key ``lower(strip(title))``."""
    return F.lower(strip(title))


def rfc822_date(stamp: str | Column, fallback: Column | None = None) -> Column:
    """Calendar day written in an RFC-822 stamp, in the stamp's own offset.

    ``'Tue, 03 Jun 2025 23:10:00 -0400'`` -> 2025-06-03; so do ``03 June 2025``,
    ``03-Jun-25`` and ``3 jun 25``.  Unparseable or missing stamps give ``fallback``
    (the caller's ``as_of`` day).
    """
    pattern = rf"(?i)\b(\d{{1,2}})[ -]+({MONTHS})[ -]+(\d{{4}}|\d{{2}})\b"
    day, month, year = (F.regexp_extract(col_(stamp), pattern, i) for i in (1, 2, 3))
    century = F.when(F.length(year) == 4, F.lit("")).when(
        year > F.lit(str(TWO_DIGIT_PIVOT)), F.lit("19")).otherwise(F.lit("20"))
    parsed = F.try_to_date(
        F.concat_ws(" ", day, F.initcap(F.substring(month, 1, 3)), F.concat(century, year)),
        "d MMM yyyy")
    return parsed if fallback is None else F.coalesce(parsed, fallback)


def epoch_date(seconds: str | Column, fallback: Column | None = None) -> Column:
    """UTC day of epoch seconds; 0 or null -> ``fallback``."""
    # whole days since the epoch: the UTC day whatever the session time zone
    s = F.nullif(col_(seconds).cast("double"), F.lit(0.0))
    d = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(s / 86400).cast("int"))
    return d if fallback is None else F.coalesce(d, fallback)


def credibility_weight(source: str | Column, pattern: str = CREDIBLE_SOURCES,
                       weight: float = CREDIBLE_WEIGHT) -> Column:
    """1.25 for sources matching the credibility pattern, else 1.0 (F2)."""
    hit = F.lower(col_(source)).rlike(pattern)
    return F.when(hit, F.lit(weight)).otherwise(F.lit(1.0))


def subreddit_group(name: str | Column,
                    groups: Sequence[tuple[str, str]] = SUBREDDIT_GROUPS) -> Column:
    """Group of a subreddit (F15); unknown names -> null."""
    m = F.create_map(*[F.lit(x) for kv in groups for x in kv])
    return m[col_(name)]
