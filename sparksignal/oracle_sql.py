"""DuckDB SQL for the logical inputs, used by the oracle of every query.

``compose(body)`` prefixes a query with the CTEs it references (transitively),
so each oracle statement is self-contained SQL over the driver's tables.
The definitions mirror ``sparksignal.sources.views``.
"""

from __future__ import annotations

import re

from sparksignal.functions.sentiment import DEFAULT_LEXICON
from sparksignal.sources import views


def java_words(pattern: str) -> str:
    r"""Rewrite ``\b`` so RE2 treats non-ASCII letters as word characters, as Java does."""
    p = pattern.replace(r"\b(", r"(^|[^\pL\p{Nd}_])(", 1)
    return p[:-2] + r"([^\pL\p{Nd}_]|$)" if p.endswith(r")\b") else p


def rx(pattern: str) -> str:
    """Case-insensitive SQL regex literal with Java word boundaries."""
    return "'(?i)" + java_words(pattern).replace("'", "''") + "'"


def tags_sql(text: str, topics) -> str:
    parts = ", ".join(f"CASE WHEN regexp_matches({text}, {rx(p)}) THEN '{t}' END"
                      for t, p in topics)
    j = f"concat_ws(',', {parts})"
    return f"(CASE WHEN {j} = '' THEN 'general' ELSE {j} END)"


def sround(x: str, digits: int) -> str:
    """Spark's ``round`` on a double: HALF_UP on the shortest decimal form of the value."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


def text_sql(value: str) -> str:
    """SQL literal of a text."""
    return "'" + value.replace("'", "''") + "'"


def line_sql(template: str, *args: str) -> str:
    """A sentence template filled with SQL text expressions, as ``reports.line`` fills it with columns."""
    parts = template.split("%s")
    out = [text_sql(parts[0])]
    for arg, rest in zip(args, parts[1:], strict=True):
        out += [arg, text_sql(rest)]
    return "(" + " || ".join(out) + ")"


def cases_sql(*cases: tuple[str, str], otherwise: str) -> str:
    whens = " ".join(f"WHEN {cond} THEN {text_sql(value)}" for cond, value in cases)
    return f"CASE {whens} ELSE {text_sql(otherwise)} END"


def pct_sql(x: str) -> str:
    return f"(CAST(round({x} * 100, 0) AS BIGINT) || '%')"


def day_sql(id_col: str) -> str:
    return f"(DATE '{views.EPOCH}' + CAST({id_col} % {views.N_DAYS} AS INTEGER))"


def stance_sql(x: str) -> str:
    return (f"(CASE WHEN {x} > 0.05 THEN 'favor' WHEN {x} < -0.05 THEN 'against' "
            f"ELSE 'neutral' END)")


def escalation_sql(x: str) -> str:
    return (f"(CASE WHEN {x} > 0.1 THEN 'de-escalation' WHEN {x} < -0.1 THEN 'escalation' "
            f"ELSE 'neutral' END)")


def cred_sql(source: str) -> str:
    return (f"(CASE WHEN regexp_matches(lower({source}), 'wall street|wsj|reuters|bloomberg') "
            f"THEN 1.25::DOUBLE ELSE 1.0::DOUBLE END)")


def _lexicon_values(lexicon) -> str:
    return ", ".join(f"('{k}', {float(v)!r}::DOUBLE)" for k, v in sorted(lexicon.items()))



_DOC_COLS = (
    "date, source, title, published_date, summary, sentiment_compound, src_id"
)


def _landed_docs() -> str:
    return f"""
  SELECT {day_sql('d.doc_id')} AS date,
         d.source || CASE WHEN d.lang = 'en' THEN '{views.VIEW_AGENCY}' ELSE '' END AS source,
         trim(regexp_replace(d.text, '\\s+', ' ', 'g')) AS title,
         strftime({day_sql('d.doc_id')}, '%a, %d %b %Y') || ' 12:00:00 +0000' AS published_date,
         d.text AS summary,
         round(coalesce(s.vs, 0.0) / sqrt(coalesce(s.vs, 0.0) * coalesce(s.vs, 0.0) + 15.0), 4)
           AS sentiment_compound,
         d.doc_id AS src_id
  FROM documents d LEFT JOIN doc_valence s ON s.doc_id = d.doc_id"""


def _clean(landed: str, keys: str, required: str = "sentiment_compound") -> str:
    return f"""
  SELECT * FROM {landed}
  WHERE date IS NOT NULL AND {required} IS NOT NULL AND NOT isnan({required})
  QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY src_id) = 1"""


CTES: list[tuple[str, str]] = [
    ("lexicon", f"SELECT * FROM (VALUES {_lexicon_values(DEFAULT_LEXICON)}) AS t(token, valence)"),
    ("post_lexicon",
     f"SELECT * FROM (VALUES {_lexicon_values(views.VIEW_POST_LEXICON)}) AS t(token, valence)"),
    ("doc_valence", """
  SELECT t.doc_id, sum(l.valence) AS vs
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z]+')) AS token
        FROM documents) t
  JOIN lexicon l ON l.token = t.token
  GROUP BY t.doc_id"""),
    ("prices", """
  SELECT CAST(o_orderdate AS DATE) AS date,
         arg_min(o_totalprice, o_orderkey) AS open,
         max(o_totalprice) AS high,
         min(o_totalprice) AS low,
         arg_max(o_totalprice, o_orderkey) AS close,
         count(*) AS volume
  FROM orders GROUP BY 1"""),
    ("landed_posts", f"""
  SELECT {day_sql('event_id')} AS date,
         event_type AS subreddit,
         CASE WHEN event_type IN {tuple(views.VIEW_BASE_TYPES)!r} THEN 'base' ELSE 'general' END
           AS subreddit_group,
         event_type || ' by user ' || CAST(user_id AS VARCHAR) || ' #' || CAST(event_id AS VARCHAR)
           AS title,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS score,
         ((CAST(json_extract_string(props, '$.k') AS INTEGER) - 50) / 10.0::DOUBLE)
           / sqrt(((CAST(json_extract_string(props, '$.k') AS INTEGER) - 50) / 10.0::DOUBLE)
                  * ((CAST(json_extract_string(props, '$.k') AS INTEGER) - 50) / 10.0::DOUBLE)
                  + 15.0) AS sentiment_compound,
         {tags_sql("event_type || ' by user ' || CAST(user_id AS VARCHAR)",
                   views.VIEW_POST_TOPICS)} AS topic,
         event_id AS src_id
  FROM events"""),
    ("posts", _clean("landed_posts", "date, subreddit, title")),
    ("landed_news", _landed_docs()),
    ("news", _clean("landed_news", "date, source, title")),
    ("landed_statements", f"""
  SELECT date, source, 'q' || CAST(src_id % 3 AS VARCHAR) AS query, title, published_date,
         summary, sentiment_compound, {tags_sql('summary', views.VIEW_STATEMENT_TOPICS)}
         AS topic_tags, src_id
  FROM ({_landed_docs()})"""),
    ("statements", _clean("landed_statements", "date, source, title")),
    ("landed_conflict", f"""
  SELECT {_DOC_COLS.replace('src_id', stance_sql('sentiment_compound') + ' AS stance, src_id')}
  FROM ({_landed_docs()})"""),
    ("conflict", _clean("landed_conflict", "date, source, title")),
    ("landed_tension", f"""
  SELECT {_DOC_COLS.replace('src_id', escalation_sql('sentiment_compound') + ' AS escalation, '
                            "CASE WHEN regexp_matches(summary, " + rx(views.VIEW_SPILLOVER)
                            + ") THEN 'True' ELSE 'False' END AS iran_spillover, src_id")}
  FROM ({_landed_docs()})"""),
    ("tension", _clean("landed_tension", "date, source, title")),
    ("predictions", """
  SELECT date + 1 AS date,
         CASE WHEN CAST(dayofyear(date) % 2 AS INTEGER) = 1 THEN 'Up' ELSE 'Down' END AS prediction,
         CAST(dayofyear(date) % 2 AS INTEGER) AS prediction_numeric,
         round(0.5 + (volume % 50) / 100.0::DOUBLE, 4) AS confidence
  FROM prices"""),
    ("price_feat", """
  SELECT date, open, high, low, close, volume,
         round(avg(close) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4)
           AS rolling_avg_7d,
         round(close - lag(close) OVER (ORDER BY date), 4) AS price_delta,
         CAST(CASE WHEN lead(close) OVER (ORDER BY date) > close THEN 1 ELSE 0 END AS INTEGER)
           AS price_direction
  FROM prices"""),
    ("posts_daily", """
  SELECT date, reddit_sentiment_avg,
         round(avg(reddit_sentiment_avg) OVER (ORDER BY date ROWS BETWEEN 2 PRECEDING
               AND CURRENT ROW), 4) AS sentiment_rolling_3d
  FROM (SELECT date, avg(sentiment_compound) AS reddit_sentiment_avg FROM posts GROUP BY date)"""),
    ("base_daily", """
  SELECT date, base_war_sentiment,
         round(avg(base_war_sentiment) OVER (ORDER BY date ROWS BETWEEN 6 PRECEDING
               AND CURRENT ROW), 4) AS base_sentiment_rolling_7d
  FROM (SELECT date, avg(sentiment_compound) AS base_war_sentiment FROM posts
        WHERE subreddit_group = 'base' AND contains(topic, 'war') GROUP BY date)"""),
    ("news_daily", f"""
  SELECT date, sum(sentiment_compound * {cred_sql('source')}) / sum({cred_sql('source')})
           AS news_sentiment
  FROM news GROUP BY date"""),
    ("statements_daily", """
  SELECT date, trump_sentiment_avg,
         round(avg(trump_sentiment_avg) OVER (ORDER BY date ROWS BETWEEN 2 PRECEDING
               AND CURRENT ROW), 4) AS trump_sentiment_rolling_3d
  FROM (SELECT date, avg(sentiment_compound) AS trump_sentiment_avg FROM statements
        GROUP BY date)"""),
    ("conflict_daily", f"""
  SELECT *, round(CASE WHEN favor_count + against_count > 0
                       THEN favor_count / (favor_count + against_count) ELSE 0.5 END, 4)
              AS favor_ratio
  FROM (SELECT date,
               sum(sentiment_compound * {cred_sql('source')}) / sum({cred_sql('source')})
                 AS war_sentiment_avg,
               count(*) AS war_article_count,
               CAST(count_if(stance = 'favor') AS BIGINT) AS favor_count,
               CAST(count_if(stance = 'against') AS BIGINT) AS against_count
        FROM conflict GROUP BY date)"""),
    ("features", """
  SELECT p.date, p.open, p.high, p.low, p.close, p.volume, p.rolling_avg_7d,
         coalesce(p.price_delta, 0.0) AS price_delta,
         coalesce(r.reddit_sentiment_avg, 0.0) AS reddit_sentiment_avg,
         coalesce(r.sentiment_rolling_3d, 0.0) AS sentiment_rolling_3d,
         coalesce(n.news_sentiment, 0.0) AS news_sentiment,
         coalesce(t.trump_sentiment_avg, 0.0) AS trump_sentiment_avg,
         coalesce(t.trump_sentiment_rolling_3d, 0.0) AS trump_sentiment_rolling_3d,
         coalesce(w.war_sentiment_avg, 0.0) AS war_sentiment_avg,
         coalesce(w.war_article_count, 0) AS war_article_count,
         coalesce(w.favor_count, 0) AS favor_count,
         coalesce(w.against_count, 0) AS against_count,
         coalesce(w.favor_ratio, 0.5) AS favor_ratio,
         coalesce(b.base_war_sentiment, 0.0) AS base_war_sentiment,
         coalesce(b.base_sentiment_rolling_7d, 0.0) AS base_sentiment_rolling_7d,
         p.price_direction
  FROM price_feat p
  LEFT JOIN posts_daily r ON r.date = p.date
  LEFT JOIN base_daily b ON b.date = p.date
  LEFT JOIN news_daily n ON n.date = p.date
  LEFT JOIN statements_daily t ON t.date = p.date
  LEFT JOIN conflict_daily w ON w.date = p.date"""),
    ("daily_sum", """
  SELECT date,
         round(avg(close), 2) AS avg_price,
         round(min(low), 2) AS min_price,
         round(max(high), 2) AS max_price,
         round(avg(reddit_sentiment_avg), 4) AS avg_reddit_sentiment,
         round(avg(news_sentiment), 4) AS avg_news_sentiment,
         round(avg(rolling_avg_7d), 2) AS rolling_avg_7d,
         round(avg(price_delta), 4) AS avg_price_delta,
         round(avg(trump_sentiment_avg), 4) AS avg_trump_sentiment,
         round(avg(trump_sentiment_rolling_3d), 4) AS trump_sentiment_rolling_3d,
         round(avg(war_sentiment_avg), 4) AS avg_war_sentiment,
         CAST(sum(favor_count) AS BIGINT) AS favor_count,
         CAST(sum(against_count) AS BIGINT) AS against_count,
         round(avg(favor_ratio), 4) AS favor_ratio,
         round(avg(base_war_sentiment), 4) AS base_war_sentiment,
         round(avg(base_sentiment_rolling_7d), 4) AS base_sentiment_rolling_7d,
         max(price_direction) AS price_direction
  FROM features GROUP BY date"""),
]


_SIG = [  # (name, source column, fill, inverted, weight, label)
    ("sig_momentum", "avg_price_delta", "0.0", False, "0.25", "Price Momentum"),
    ("sig_news", "avg_news_sentiment", "0.0", False, "0.20", "News Sentiment"),
    ("sig_reddit", "avg_reddit_sentiment", "0.0", False, "0.15", "Reddit Sentiment"),
    ("sig_trump", "avg_trump_sentiment", "0.0", False, "0.15", "Trump Sentiment"),
    ("sig_war", "avg_war_sentiment", "0.0", True, "0.15", "War Escalation"),
    ("sig_favor", "favor_ratio", "0.5", True, "0.10", "War Stance"),
]


def _scaled(name: str, inverted: bool) -> str:
    x, mn, mx = f"x_{name}", f"mn_{name}", f"mx_{name}"
    e = (f"(CASE WHEN {mx} = {mn} THEN 0.0::DOUBLE "
         f"ELSE 2.0::DOUBLE * ({x} - {mn}) / ({mx} - {mn}) - 1.0::DOUBLE END)")
    return f"(-{e} + 0.0::DOUBLE)" if inverted else e


_SIG_INPUTS = ", ".join(f"coalesce({src}, {fill}::DOUBLE) AS x_{n}"
                        for n, src, fill, _, _, _ in _SIG)
_SIG_STATS = ", ".join(f"min(x_{n}) AS mn_{n}, max(x_{n}) AS mx_{n}" for n, *_ in _SIG)
_SIG_COLS = ", ".join(f"{_scaled(n, inv)} AS {n}" for n, _, _, inv, _, _ in _SIG)
_COMPOSITE = " + ".join(f"{w}::DOUBLE * {n}" for n, _, _, _, w, _ in _SIG)
_CONTRIB = "\n    UNION ALL ".join(
    f"SELECT date, {i} AS o, '{label}' AS l, {n} * {w}::DOUBLE AS v FROM sig_scored"
    for i, (n, _, _, _, w, label) in enumerate(_SIG))

CTES += [
    ("doc_scores", """
  SELECT d.doc_id, d.lang, d.source,
         round(coalesce(s.vs, 0.0) / sqrt(coalesce(s.vs, 0.0) * coalesce(s.vs, 0.0) + 15.0), 4)
           AS compound
  FROM documents d LEFT JOIN doc_valence s ON s.doc_id = d.doc_id"""),
    ("tension_days", """
  SELECT *, greatest(0.05::DOUBLE, least(0.95::DOUBLE,
           0.20::DOUBLE + escalation_pct * 0.30::DOUBLE - avg_sentiment * 0.15::DOUBLE
           + iran_pct * 0.10::DOUBLE + least(article_count / 200.0::DOUBLE, 0.15::DOUBLE)))
           AS war_probability
  FROM (SELECT date, count(title) AS article_count, avg(sentiment_compound) AS avg_sentiment,
               avg(CASE WHEN escalation = 'escalation' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
                 AS escalation_pct,
               avg(CASE WHEN lower(iran_spillover) = 'true' THEN 1.0::DOUBLE
                        ELSE 0.0::DOUBLE END) AS iran_pct
        FROM tension GROUP BY date)"""),
    ("pressure_terms", f"""
  SELECT date, b7, p, favor_ratio, war_sentiment_avg, {sround('raw_pressure', 4)} AS pressure_index
  FROM (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE,
           0.35::DOUBLE * greatest(0.0::DOUBLE, least(1.0::DOUBLE, (0.0::DOUBLE - b7 + 0.5::DOUBLE) / 1.0::DOUBLE))
           + 0.30::DOUBLE * greatest(0.0::DOUBLE, least(1.0::DOUBLE, 1.0::DOUBLE - favor_ratio))
           + 0.20::DOUBLE * greatest(0.0::DOUBLE, least(1.0::DOUBLE, (0.0::DOUBLE - war_sentiment_avg + 0.5::DOUBLE) / 1.0::DOUBLE))
           + 0.15::DOUBLE * greatest(0.0::DOUBLE, least(1.0::DOUBLE,
               (-(CASE WHEN p != 0.0 THEN b7 - p ELSE 0.0::DOUBLE END) + 0.1::DOUBLE) / 0.2::DOUBLE))))
           AS raw_pressure
        FROM (SELECT date, base_sentiment_rolling_7d AS b7,
                     lag(base_sentiment_rolling_7d) OVER (ORDER BY date) AS p,
                     favor_ratio, war_sentiment_avg FROM features))"""),
    ("pressure", """
  SELECT date,
         round(1.0::DOUBLE / (1.0::DOUBLE + exp(-((pressure_index - 0.5::DOUBLE) * 6.0::DOUBLE))), 4)
           AS exit_probability,
         pressure_index,
         CASE WHEN b7 < p - 0.01 THEN 'declining' WHEN b7 > p + 0.01 THEN 'improving'
              ELSE 'stable' END AS base_sentiment_trend,
         round(b7, 4) AS base_sentiment_current,
         round(favor_ratio, 4) AS favor_ratio,
         round(war_sentiment_avg, 4) AS war_sentiment_avg
  FROM pressure_terms"""),
    ("sig_in", f"SELECT *, {_SIG_INPUTS} FROM daily_sum"),
    ("sig_stats", f"SELECT {_SIG_STATS} FROM sig_in"),
    ("sig_scored", f"""
  SELECT *, {_SIG_COLS} FROM sig_in, sig_stats"""),
    ("sig_contrib", _CONTRIB),
    ("sig_reason", """
  SELECT date, string_agg(l || ' ' || CASE WHEN v > 0 THEN '↑' ELSE '↓' END, ' + ' ORDER BY rk)
           AS reason
  FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY abs(v) DESC, o) AS rk
        FROM sig_contrib)
  WHERE rk <= 2 GROUP BY date"""),
    ("signals", f"""
  SELECT *,
         CASE WHEN signal IN ('BUY', 'SELL') AND next_day_direction IS NOT NULL
              THEN CAST(signal_numeric = next_day_direction AS DOUBLE) END AS correct
  FROM (SELECT s.*, r.reason,
               lead(s.price_direction) OVER (ORDER BY s.date) AS next_day_direction,
               CASE s.signal WHEN 'BUY' THEN 1 WHEN 'SELL' THEN 0 END AS signal_numeric
        FROM (SELECT *, CASE WHEN composite_score > 0.12 THEN 'BUY'
                             WHEN composite_score < -0.12 THEN 'SELL' ELSE 'HOLD' END AS signal,
                        least(abs(composite_score), 1.0::DOUBLE) AS signal_strength
              FROM (SELECT *, {_COMPOSITE} AS composite_score FROM sig_scored)) s
        JOIN sig_reason r ON r.date = s.date)"""),
    ("evaluation", """
  SELECT p.date AS pred_date,
         CASE WHEN p.prediction_numeric = 1 THEN 'Up' ELSE 'Down' END AS predicted,
         CASE WHEN f.price_direction = 1 THEN 'Up' WHEN f.price_direction = 0 THEN 'Down'
              ELSE 'pending' END AS actual,
         CAST(CASE WHEN f.price_direction IS NOT NULL
                   THEN CAST(p.prediction_numeric = f.price_direction AS INTEGER) END AS INTEGER)
           AS correct,
         round(p.confidence, 4) AS confidence,
         CASE WHEN f.price_direction IS NULL THEN 'pending'
              WHEN p.prediction_numeric = f.price_direction THEN 'correct'
              ELSE 'incorrect' END AS status
  FROM predictions p LEFT JOIN features f ON f.date = p.date"""),
]


def _per_symbol(name: str, *changes: tuple[str, str]) -> tuple[str, str]:
    """The CTE ``name`` with one series per symbol."""
    sql = dict(CTES)[name]
    for old, new in changes:
        if old not in sql:
            raise ValueError(f"{name} has no {old}")
        sql = sql.replace(old, new)
    return f"{name}_by_symbol", sql


_OVER = ("OVER (ORDER BY", "OVER (PARTITION BY symbol ORDER BY")
_SYMBOL_SCALES = ", ".join(f"min(x_{n}) OVER (PARTITION BY symbol) AS mn_{n}, "
                           f"max(x_{n}) OVER (PARTITION BY symbol) AS mx_{n}" for n, *_ in _SIG)

CTES += [
    _per_symbol("prices", ("SELECT CAST(", "SELECT o_orderpriority AS symbol, CAST("),
                ("GROUP BY 1", "GROUP BY 1, 2")),
    _per_symbol("price_feat", ("SELECT date", "SELECT symbol, date"), _OVER,
                ("FROM prices", "FROM prices_by_symbol")),
    _per_symbol("features", ("SELECT p.date", "SELECT p.symbol, p.date"),
                ("FROM price_feat p", "FROM price_feat_by_symbol p")),
    _per_symbol("daily_sum", ("SELECT date", "SELECT symbol, date"),
                ("FROM features GROUP BY date", "FROM features_by_symbol GROUP BY symbol, date")),
    _per_symbol("pressure_terms", ("SELECT date", "SELECT symbol, date"), _OVER,
                ("FROM features", "FROM features_by_symbol")),
    _per_symbol("pressure", ("SELECT date", "SELECT symbol, date"),
                ("FROM pressure_terms", "FROM pressure_terms_by_symbol")),
    ("sig_in_by_symbol", f"""
  SELECT *, {_SYMBOL_SCALES} FROM (SELECT *, {_SIG_INPUTS} FROM daily_sum_by_symbol)"""),
    ("sig_scored_by_symbol", f"SELECT *, {_SIG_COLS} FROM sig_in_by_symbol"),
    ("sig_contrib_by_symbol", _CONTRIB.replace("SELECT date", "SELECT symbol, date")
     .replace("FROM sig_scored", "FROM sig_scored_by_symbol")),
]
CTES += [
    _per_symbol("sig_reason", ("SELECT date", "SELECT symbol, date"),
                ("PARTITION BY date", "PARTITION BY symbol, date"),
                ("GROUP BY date", "GROUP BY symbol, date"),
                ("FROM sig_contrib", "FROM sig_contrib_by_symbol")),
    _per_symbol("signals", ("OVER (ORDER BY", "OVER (PARTITION BY s.symbol ORDER BY"),
                ("FROM sig_scored", "FROM sig_scored_by_symbol"),
                ("JOIN sig_reason r ON r.date = s.date",
                 "JOIN sig_reason_by_symbol r ON r.symbol = s.symbol AND r.date = s.date")),
]

_NAMES = [n for n, _ in CTES]


def compose(body: str) -> str:
    """``WITH <needed ctes> <body>``; dependencies found by name."""
    needed: set[str] = set()
    texts = {n: s for n, s in CTES}

    def visit(sql: str) -> None:
        for n in _NAMES:
            if n not in needed and re.search(rf"\b{n}\b", sql):
                needed.add(n)
                visit(texts[n])

    visit(body)
    parts = [f"{n} AS ({texts[n]}\n)" for n in _NAMES if n in needed]
    if not parts:
        return body
    head = "WITH " + ",\n".join(parts)
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":
        return head + ",\n" + stripped[5:]
    return head + "\n" + body
