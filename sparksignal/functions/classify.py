"""Threshold classifiers and value decoders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparksignal.functions.text import col_

# --- fixed values (thresholds and labels of the reference) -------------------
STANCE_FAVOR = 0.05
STANCE_AGAINST = -0.05
ESCALATION_LOW = -0.1
ESCALATION_HIGH = 0.1
BADGE_BAND = 0.05
STRIKE_RISK_BANDS = (0.55, 0.30)
TENSION_RISK_BANDS = (0.60, 0.35)
BASE_TREND_BAND = 0.01
TENSION_TREND_BAND = 0.02
# -----------------------------------------------------------------------------


def three_way(x: str | Column, high: float, low: float, above: str, below: str,
              middle: str = "neutral") -> Column:
    """``> high`` -> above, ``< low`` -> below, else middle (strict bounds)."""
    v = col_(x)
    return (F.when(v > high, F.lit(above)).when(v < low, F.lit(below))
            .otherwise(F.lit(middle)))


def stance(compound: str | Column) -> Column:
    """favor / against / neutral at +-0.05."""
    return three_way(compound, STANCE_FAVOR, STANCE_AGAINST, "favor", "against")


def escalation(compound: str | Column) -> Column:
    """escalation below -0.1, de-escalation above 0.1."""
    return three_way(compound, ESCALATION_HIGH, ESCALATION_LOW, "de-escalation",
                     "escalation")


def badge(compound: str | Column) -> Column:
    """Headline badge positive / negative / neutral at +-0.05."""
    return three_way(compound, BADGE_BAND, -BADGE_BAND, "positive", "negative")


def risk_label(p: str | Column, bands: tuple[float, float] = STRIKE_RISK_BANDS) -> Column:
    """HIGH / MODERATE / LOW with inclusive lower bounds."""
    v = col_(p)
    hi, mid = bands
    return (F.when(v >= hi, F.lit("HIGH")).when(v >= mid, F.lit("MODERATE"))
            .otherwise(F.lit("LOW")))


def base_trend(current: str | Column, previous: str | Column,
               band: float = BASE_TREND_BAND) -> Column:
    """declining / improving / stable around the previous value."""
    c, p = col_(current), col_(previous)
    return (F.when(c < p - band, F.lit("declining")).when(c > p + band, F.lit("improving"))
            .otherwise(F.lit("stable")))


def delta_trend(delta: str | Column, band: float = TENSION_TREND_BAND) -> Column:
    """rising / falling / stable for a difference."""
    return three_way(delta, band, -band, "rising", "falling", "stable")


def arrow(x: str | Column) -> Column:
    """Up arrow when strictly positive, else down arrow."""
    return F.when(col_(x) > 0, F.lit("↑")).otherwise(F.lit("↓"))


def direction_label(x: str | Column, up: str = "Up", down: str = "Down",
                    missing: str | None = None) -> Column:
    """1 -> Up, 0 -> Down, other/null -> ``missing``."""
    v = col_(x)
    out = F.when(v == 1, F.lit(up)).when(v == 0, F.lit(down))
    return out.otherwise(F.lit(missing)) if missing is not None else out


def signal_numeric(signal: str | Column) -> Column:
    """BUY -> 1, SELL -> 0, HOLD -> null."""
    s = col_(signal)
    return F.when(s == "BUY", F.lit(1)).when(s == "SELL", F.lit(0))
