"""Lexicon sentiment (F16) and the token x lexicon join.

Sentence score = sum of the valences of its tokens found in a lexicon, squashed
to [-1, 1] with ``s / sqrt(s*s + alpha)`` (alpha = 15, the normalisation
published with VADER by Hutto & Gilbert, 2014).  Negation/booster rules of that
library are not reproduced.  The lexicon is a parameter; the default is the
small fixed word list below.

Two plans compute the same number:

* ``lexicon_compound`` -- a narrow expression: tokens are looked up in a
  literal two-level table inside the row's own projection (``filter`` + ``transform`` + ``aggregate``).
  No explode, no join, no shuffle; its size is bounded by the word list.
* ``lexicon_join_scores`` -- the relational form for a caller-supplied
  lexicon *table* of any size: explode tokens, keep those that a Bloom filter of the
  lexicon lets pass, count them per document, join the lexicon on the token, aggregate
  per document.  Stop words and texts never cross the network.  Join strategy is left to
  AQE (broadcast when the lexicon's runtime size is under the threshold, sort-merge beyond it).
"""

from __future__ import annotations

import zlib
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.functions.text import col_

ALPHA = 15.0
TOKEN_PATTERN = "[a-z]+"

# --- fixed values: default lexicon (word -> valence on a -4..+4 scale) -------
DEFAULT_LEXICON: dict[str, float] = {
    "agree": 1.5, "benefit": 1.6, "best": 3.2, "better": 1.9, "calm": 1.3,
    "ceasefire": 1.5, "confident": 2.2, "deal": 0.8, "excellent": 2.7, "gain": 1.6,
    "good": 1.9, "great": 3.1, "growth": 1.4, "happy": 2.7, "hope": 1.9,
    "improve": 1.9, "love": 3.2, "peace": 2.5, "recovery": 1.4, "safe": 1.9,
    "strong": 2.3, "success": 2.7, "support": 1.7, "win": 2.8,
    "attack": -2.1, "bad": -2.5, "bomb": -2.2, "conflict": -1.3, "crisis": -3.1,
    "death": -2.9, "decline": -1.1, "fail": -2.5, "fear": -2.2, "hate": -2.7,
    "idiot": -2.3, "kill": -3.7, "loser": -2.4, "loss": -1.3, "missile": -1.4,
    "moron": -2.2, "no": -1.2, "pathetic": -2.2, "sanction": -1.4, "stupid": -2.4,
    "terrible": -2.5, "threat": -2.4, "trash": -1.6, "war": -2.9, "weak": -1.9,
    "worst": -3.1, "worthless": -1.9,
}
# -----------------------------------------------------------------------------


def tokens(text: str | Column, pattern: str = TOKEN_PATTERN) -> Column:
    """Lower-cased word tokens of the whole text."""
    return F.regexp_extract_all(F.lower(F.coalesce(col_(text), F.lit(""))), F.lit(pattern), 0)


def normalise(score: str | Column, alpha: float = ALPHA) -> Column:
    s = col_(score)
    return s / F.sqrt(s * s + F.lit(alpha))


def _table(lexicon: Mapping[str, float]) -> tuple[Column, int]:
    """The lexicon as a literal array of small maps, a word's place being CRC-32 modulo the number of maps."""
    places = 1 << len(lexicon).bit_length()  # about one word in two maps
    maps: list[list[str]] = [[] for _ in range(places)]
    for word in sorted(lexicon):
        quoted = word.replace("\\", "\\\\").replace("'", "\\'")
        maps[zlib.crc32(word.encode()) % places].append(f"'{quoted}', {float(lexicon[word])!r}D")
    none = "cast(map() as map<string, double>)"
    return F.expr("array(" + ", ".join(f"map({', '.join(m)})" if m else none for m in maps) + ")"), places


def _valences(text: str | Column, lexicon: Mapping[str, float]) -> Column:
    """Valence of each token that is a word of the lexicon, in order: the token's hash picks a map of a word or two.

    Other words, most of a text, only pass a hash set; their valence of 0 would not change a sum.
    """
    table, places = _table(lexicon)

    def valence(t: Column) -> Column:
        place = F.pmod(F.crc32(t.cast("binary")), F.lit(places)).cast("int")
        return F.coalesce(F.try_element_at(F.get(table, place), t), F.lit(0.0))

    return F.transform(F.filter(tokens(text), lambda t: t.isin(*sorted(lexicon))), valence)


def lexicon_compound(text: str | Column, lexicon: Mapping[str, float] = DEFAULT_LEXICON,
                     digits: int | None = 4) -> Column:
    """Compound score in [-1, 1] of the whole text (F16).

    The literal table has two levels, so a token costs the same in a list of fifty words and in one of
    thousands; the plan carries the words, so score a table beyond that with ``lexicon_join_scores``.

    The squash runs as the fold's finish step, so the token pass happens once
    per row even where expressions are not deduplicated.
    """
    c = F.aggregate(_valences(text, lexicon), F.lit(0.0), lambda acc, x: acc + x,
                    lambda s: s / F.sqrt(s * s + F.lit(ALPHA)))
    return F.round(c, digits) if digits is not None else c


def lexicon_frame(spark: SparkSession,
                  lexicon: Mapping[str, float] = DEFAULT_LEXICON) -> DataFrame:
    """The lexicon as a (token, valence) table."""
    schema = T.StructType([T.StructField("token", T.StringType(), False),
                           T.StructField("valence", T.DoubleType(), False)])
    return spark.createDataFrame([(k, float(v)) for k, v in sorted(lexicon.items())], schema)


BLOOM_BITS, BLOOM_MOST = 12, 1 << 27  # bits a word, and bits of a filter at most (32 MB as numbers of 32 bits)
_SEEDS, _WORD, _BLOCK = (0, 1, 2, 3), 32, 1024  # a block is 1024 numbers of 32 bits


def _places(token: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(token, F.lit(seed)), F.lit(bits).cast("long")) for seed in _SEEDS]


def _div(c: Column, n: int) -> Column:
    return F.floor(c / n).cast("long")


def bloom_filter(words: DataFrame, col: str = "token") -> tuple[DataFrame, int]:
    """One row ``bloom`` (blocks of numbers of 32 bits) of the words, and its number of bits.

    Bits are set by a hash aggregate per number and filled up per block; only the finished blocks meet in one row, of
    ``BLOOM_MOST`` bits at most, whatever the number of words (more words than that only let more tokens pass).
    """
    block_bits = _WORD * _BLOCK
    bits = min(BLOOM_MOST, -(-max(1, words.count()) * BLOOM_BITS // block_bits) * block_bits)
    p = F.col("p")
    numbers = (words.where(F.col(col).isNotNull()).select(F.explode(F.array(*_places(F.col(col), bits))).alias("p"))
               .groupBy(_div(p, _WORD).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(p % {_WORD} as int))")).alias("number")))
    numbers = numbers.unionByName(words.sparkSession.range(bits // block_bits).select(
        (F.col("id") * _BLOCK).alias("at"), F.lit(0).cast("long").alias("number")))  # every block occurs
    by_place = F.map_from_entries(F.collect_list(F.struct((F.col("at") % _BLOCK).cast("int"), "number")))
    numbers = numbers.groupBy("at").agg(F.bit_or("number").alias("number"))
    blocks = numbers.groupBy(_div(F.col("at"), _BLOCK).alias("block")).agg(by_place.alias("m"))
    filled = F.transform(F.sequence(F.lit(0), F.lit(_BLOCK - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long")))
    blocks = blocks.select("block", filled.alias("numbers"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "numbers")))
    return blocks.agg(ordered.getField("numbers").alias("bloom")), bits


def might_contain(bloom: Column, bits: int, token: Column) -> Column:
    """Whether the filter's bits of ``token`` are all set: true for every word in it, seldom for another."""
    out = F.lit(True)
    for place in _places(token, bits):
        number = F.get(F.get(bloom, _div(place, _WORD * _BLOCK).cast("int")), (_div(place, _WORD) % _BLOCK).cast("int"))
        out = out & (F.call_function("shiftright", number, (place % _WORD).cast("int")).bitwiseAND(F.lit(1)) == 1)
    return out


def lexicon_candidates(docs: DataFrame, id_col: str, text_col: str, lexicon: DataFrame | None = None,
                       pattern: str = TOKEN_PATTERN) -> DataFrame:
    """``id_col, token, n_tokens``: each document's tokens that may be in the lexicon, and one row that carries its token count.

    With a ``lexicon`` its Bloom filter drops all other tokens in the scan's own stage.  The row with the count has
    a token of its own (a zero character and the id), so that such rows spread over all partitions.
    """
    mark = F.concat(F.lit("\0"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    found = docs.select(id_col, tokens(text_col, pattern).alias("tokens"))
    count = F.struct(mark.alias("token"), F.size("tokens").cast("long").alias("n_tokens"))
    words = F.transform("tokens", lambda t: F.struct(t.alias("token"), F.lit(0).cast("long").alias("n_tokens")))
    rows = found.select(id_col, F.explode(F.concat(F.array(count), words)).alias("t")).select(id_col, "t.token", "t.n_tokens")
    if lexicon is None:
        return rows
    bloom, bits = bloom_filter(lexicon)
    return rows.where(F.col("token").startswith("\0") | might_contain(bloom.scalar(), bits, F.col("token")))


def lexicon_join_scores(docs: DataFrame, id_col: str, text_col: str,
                        lexicon: DataFrame, broadcast_lexicon: bool = False,
                        pattern: str = TOKEN_PATTERN) -> DataFrame:
    """Per document: token count, lexicon hits, valence sum, compound (J4 + F16).

    Tokens are counted per document before they meet the lexicon, and tokens that no lexicon word can be never
    reach an exchange.  ``broadcast_lexicon`` may be set only by callers that know the lexicon's size (e.g.
    built from a fixed word list): it then goes to all tasks and needs no filter.
    """
    lex = lexicon.select("token", "valence")
    if broadcast_lexicon:
        each = docs.select(id_col, F.explode_outer(tokens(text_col, pattern)).alias("token"))
        scored = each.join(F.broadcast(lex), "token", "left").select(
            id_col, "valence", F.lit(1).alias("c"), F.when(F.col("token").isNotNull(), 1).otherwise(0).alias("n_tokens"))
    else:
        each = lexicon_candidates(docs, id_col, text_col, lex, pattern)
        pairs = each.groupBy(id_col, "token").agg(F.sum("n_tokens").alias("n_tokens"), F.count(F.lit(1)).alias("c"))
        scored = pairs.join(lex, "token", "left")
    agg = scored.groupBy(id_col).agg(
        F.sum("n_tokens").cast("long").alias("n_tokens"),
        F.coalesce(F.sum(F.when(F.col("valence").isNotNull(), F.col("c"))), F.lit(0)).cast("long").alias("n_hits"),
        F.coalesce(F.sum(F.col("valence") * F.col("c")), F.lit(0.0)).alias("valence_sum"),
    )
    return agg.withColumn("compound", F.round(normalise("valence_sum"), 4))
