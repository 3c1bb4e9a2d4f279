"""Quality rules: a decision list learned by sequential covering; DataFrame functions only.

Statistics of every whole text come from built-in functions.  The list is learned from labelled
documents: a rule is a conjunction of thresholds, grown on two thirds of the sample by the information
gain of each added condition and pruned on the rest; documents that it covers are set aside, and the
next rule is learned, until a rule is not precise enough.  Gains come from histograms: one aggregate
per step over (feature, quantile bin), of which the driver sees ``features x bins`` rows.  The list is
emitted as an ordered conditional expression: first rule that holds, else keep.

The sample is the documented bound of learning, ``max_labelled`` rows by hash of the id; statistics and verdicts cover
all rows.

Cases: a null or empty text has no words and fails the base rule; repeated rows each get their
verdict; labels with null ids or null classes are not used; without labels there are no rules; a
constant statistic gives no condition; an empty table gives an empty result; the other columns come back in ``row``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparksignal.llm.chunks import row_of, write_table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SHARES = 10_000  # features are whole numbers, in ten-thousandths where they are shares
FEATURES = ("n_words", "mean_word", "symbols", "dup_lines", "repeat_words", "distinct_words", "digits", "capitals")
MAX_LABELLED, BINS, MAX_RULES, MAX_CONDITIONS = 20_000, 24, 8, 4
MIN_PRECISION, MIN_COVER, SEED = 0.95, 5, 3


def statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``row`` (struct of the other columns), ``text`` and one column per statistic."""
    out = docs.select(row_of(docs, text_col), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    text = F.col("text")
    out = out.withColumn("words", F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""))
    out = out.withColumn("n_words", F.size("words").cast("long"))
    pair = F.zip_with("words", F.slice("words", 2, F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    three = F.zip_with(pair, F.slice("words", 3, F.greatest(F.size("words"), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    out = out.withColumn("windows", F.when(F.size("words") >= 3, F.slice(three, 1, F.size("words") - 2)).otherwise(F.array().cast("array<string>")))
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    out = out.withColumn("sorted", F.when(repeated, F.array_sort(F.transform("windows", lambda w, i: F.struct(w.alias("w"), i.alias("i")))))
                         .otherwise(F.array().cast("array<struct<w:string,i:int>>")))
    twins = F.zip_with("sorted", F.slice("sorted", 2, F.greatest(F.size("sorted"), F.lit(1))), lambda a, b: F.when(
        a["w"] == b["w"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    out = out.withColumn("lines", lines)
    return out.select(
        "row", "text", "n_words", F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(F.flatten(F.array_compact(twins)))).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"), F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        (F.length(text) - F.length(F.translate(text, "0123456789", ""))).cast("long").alias("n_digits"),
        (F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))).cast("long").alias("n_capitals"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def features() -> dict[str, Column]:
    """Whole numbers that the learned conditions test."""
    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.floor(F.try_divide(F.col(part) * SHARES, F.col(whole))), F.lit(0)).cast("long")

    cols = (F.col("n_words"), share("word_chars", "n_words"), share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"),
            share("n_repeat_words", "n_words"), share("n_distinct", "n_words"), share("n_digits", "word_chars"),
            share("n_capitals", "word_chars"))
    return dict(zip(FEATURES, cols))


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: int

    def holds(self, cols: dict[str, Column]) -> Column:
        c = cols[self.feature]
        return c > self.threshold if self.above else c <= self.threshold


Rule = tuple[Condition, ...]


def holds(rule: Rule, cols: dict[str, Column]) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.holds(cols)
    return out


def decision_list(rules: list[Rule], cols: dict[str, Column]) -> Column:
    """Number of the first rule that holds (from 1); null if none does."""
    out = None
    for i, r in enumerate(rules, 1):
        out = F.when(holds(r, cols), i) if out is None else out.when(holds(r, cols), i)
    return F.lit(None).cast("int") if out is None else out


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information that a condition adds on the rejected documents it still covers."""
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0


def _grow(part: DataFrame, cuts: dict[str, list[int]], cols: dict[str, Column]) -> Rule:
    """Add the condition of the highest gain until no kept document is covered."""
    rule: list[Condition] = []
    while len(rule) < MAX_CONDITIONS:
        bins = F.array(*[F.struct(F.lit(f).alias("f"), F.size(F.filter(F.array(*[F.lit(t) for t in ts]), _below(cols[f]))).alias("bin"))
                         for f, ts in cuts.items()])
        rows = part.where(holds(tuple(rule), cols)).select("bad", F.explode(bins).alias("b")).groupBy("b.f", "b.bin").agg(
            F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n")).collect()  # features x bins rows
        at = {(r["f"], r["bin"]): (r["p"], r["n"]) for r in rows}
        first = next(iter(cuts))
        p0, n0 = (sum(at.get((first, i), (0, 0))[k] for i in range(len(cuts[first]) + 1)) for k in (0, 1))
        if not p0 or not n0:
            break
        best, top = None, 0.0
        for f, ts in cuts.items():
            low_p = low_n = 0
            for i, t in enumerate(ts):  # bin i holds values over i thresholds
                p, n = at.get((f, i), (0, 0))
                low_p, low_n = low_p + p, low_n + n
                for above, q, m in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                    g = _gain(q, m, p0, n0)
                    if q >= MIN_COVER and g > top + 1e-9:
                        best, top = Condition(f, above, t), g
        if best is None:
            break
        value = F.col(best.feature)  # the threshold moves to the middle of the gap it lies in
        gap = part.where(holds(tuple(rule), cols)).agg(F.max(F.when(value <= best.threshold, value)).alias("lo"),
                                                       F.min(F.when(value > best.threshold, value)).alias("hi")).first()
        middle = (gap["lo"] + gap["hi"] - 1) // 2 if gap["lo"] is not None and gap["hi"] is not None else best.threshold
        rule.append(Condition(best.feature, best.above, middle))
    return tuple(rule)


def _below(c: Column):
    return lambda t: t < c


def _prune(part: DataFrame, rule: Rule, cols: dict[str, Column]) -> tuple[Rule, float, int]:
    """The leading conditions that are most precise on documents the rule was not grown on."""
    aggs = []
    for k in range(1, len(rule) + 1):
        hit = holds(rule[:k], cols)
        aggs += [F.count_if(hit & F.col("bad")), F.count_if(hit & ~F.col("bad"))]
    got = part.agg(*aggs).first()
    scored = [((got[2 * k] - got[2 * k + 1]) / max(1, got[2 * k] + got[2 * k + 1]), -k) for k in range(len(rule))]
    k = -max(scored)[1]
    p, n = got[2 * k], got[2 * k + 1]
    return rule[:k + 1], p / max(1, p + n), p


def learn(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", class_col: str = "quality",
          max_labelled: int = MAX_LABELLED) -> list[Rule]:
    """Rules that reject documents of class 0, in order."""
    labels = labels.where(F.col(id_col).isNotNull() & F.col(class_col).isNotNull()).select(
        F.col(id_col).alias("label_id"), (F.col(class_col) == 0).alias("bad"))
    n = labels.count()
    keep = F.pmod(F.xxhash64("label_id", F.lit(SEED)), F.lit(1 << 20)) < math.floor((1 << 20) * min(1.0, max_labelled / max(1, n)))
    cols = features()
    sample = stats.where(~base_failed()).join(labels.where(keep), F.col(f"row.`{id_col}`") == F.col("label_id")).select(
        "bad", (F.pmod(F.xxhash64("label_id", F.lit(SEED + 1)), F.lit(3)) < 2).alias("grow"), *[c.alias(f) for f, c in cols.items()])
    sample = write_table(sample.repartition(4), "labelled")  # a shuffle of the bounded sample: the scan keeps its own tasks
    cols = {f: F.col(f) for f in FEATURES}
    marks = [i / BINS for i in range(1, BINS)]
    got = sample.agg(*[F.percentile_approx(f, marks, 10_000).alias(f) for f in FEATURES],
                     *[F.percentile_approx(F.when(F.col("bad"), F.col(f)), marks, 10_000).alias(f"{f}_bad") for f in FEATURES]).first()
    cuts = {f: sorted({*(got[f] or []), *(got[f"{f}_bad"] or [])}) for f in FEATURES}
    cuts = {f: ts for f, ts in cuts.items() if ts}
    rules: list[Rule] = []
    while cuts and len(rules) < MAX_RULES:
        left = sample.where(decision_list(rules, cols).isNull())
        rule = _grow(left.where("grow"), cuts, cols)
        if not rule:
            break
        rule, precision, cover = _prune(left.where("not grow"), rule, cols)
        if precision < MIN_PRECISION or cover < MIN_COVER:
            break
        rules.append(rule)
    return rules


def assess(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with ``base_failed``, ``rule`` (number of the rejecting rule or null) and ``kept``."""
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", decision_list(rules, features()))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
