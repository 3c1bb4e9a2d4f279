"""Secret scans over an incremental ledger of content-addressed texts; DataFrame functions only.

A text is a blob, named by the SHA-256 of its bytes; a row of the table is a path to a blob (a
historical version of a document is one more path).  The ledger records which rule versions have
scanned which blobs, with the findings.  A call scans only the blob and rule-version pairs that
the ledger lacks, each blob once however many paths it has, appends them, and joins the findings back to all
paths.  A hot blob is one row after map-side dedup.

Rules: a kind, a version, a Java pattern, and the least length of the match (or of one of its
groups).  Matches are found leftmost and without overlap, then failing ones are dropped.  Places come
from the pieces between the matches, in code points, end exclusive.

Cases: a null or empty text is the empty blob and has no findings; equal texts share findings, repeated
rows each get them; an empty table gives an empty result; a path may be of any type and null; the other
columns come back in ``row`` untouched; a text with very many matches costs time in proportion to them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparksignal.llm.chunks import row_of, write_table
from sparksignal.session import scratch_path

# fixed values: the base rules, in the order their kinds are listed
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = r"AKIA[A-Z0-9]{14,}"  # a run is maximal, so least lengths inside the pattern drop the same matches
HEX = r"[0-9a-f]{16,}"


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1
    words: tuple[str, ...] = ()  # lower-case words, one of which a matching text holds in either case


BASE_RULES = (Rule("assign", 1, ASSIGN, 2, 12, ASSIGN_WORDS), Rule("access", 1, ACCESS, words=("akia",)), Rule("hex", 1, HEX))

SALTS, BLOCK, CHUNK = 16, 128, 4096
LEDGER = "blob string, kind string, version int, spans array<struct<begin:int,end:int>>"


def _any(text: Column, words: tuple[str, ...]) -> Column:
    low, out = F.lower(text), F.lit(False)
    for w in words:
        out = out | F.contains(low, F.lit(w))
    return out


def _blocks(items: Column, size: int = BLOCK) -> Column:
    """An array as an array of consecutive parts of ``size`` items; one empty part for an empty array."""
    def cut(whole: Column) -> Column:
        last = F.floor(F.greatest(F.size(whole) - 1, F.lit(0)) / size).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(whole, b * size + 1, F.lit(size)))

    return F.get(F.transform(F.array(items), cut), F.lit(0))  # an array of one: ``items`` is computed once


def spans(text: Column, rule: Rule) -> Column:
    """Array of (begin, end) of the rule's matches.

    The text is split at the matches; piece lengths and match lengths in turn give the places."""
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all(text, pattern, F.lit(0))
    part = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else whole
    step = F.arrays_zip(F.transform(F.split(text, rule.pattern), F.length).alias("gap"),
                        F.transform(whole, F.length).alias("size"), F.transform(part, F.length).alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<begin:int,end:int>>").alias("found"))

    def walk(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["gap"]
        one = F.array(F.struct(begin.alias("begin"), (begin + x["size"]).alias("end")))
        return F.struct((begin + F.coalesce(x["size"], F.lit(0))).alias("at"),
                        F.when(x["part"] >= rule.least, F.concat(acc["found"], one)).otherwise(acc["found"]).alias("found"))

    # an append copies the array: within blocks, then the blocks with their starts, the copies stay few
    parts = F.transform(_blocks(step), lambda part: F.aggregate(part, start, walk))

    def place(acc: Column, x: Column) -> Column:
        moved = F.transform(x["found"], lambda f: F.struct((f["begin"] + acc["at"]).alias("begin"), (f["end"] + acc["at"]).alias("end")))
        return F.struct((acc["at"] + x["at"]).alias("at"), F.concat(acc["lists"], F.array(moved)).alias("lists"))

    none = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<struct<begin:int,end:int>>>").alias("lists"))
    found = F.aggregate(parts, none, place, lambda acc: F.flatten(acc["lists"]))
    has = F.regexp_like(text, pattern)
    if rule.words:
        has = _any(text, rule.words) & has
    return F.when(has, found).otherwise(F.array().cast("array<struct<begin:int,end:int>>"))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's rows so far; an empty table if there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], LEDGER)


def scan(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE_RULES,
         ledger: str | None = None) -> DataFrame:
    """``row`` (struct of the other columns), ``text``, its ``blob``, and ``found``: array of (begin, kind
    number, end, kind), sorted.  ``ledger`` is the folder of the ledger; a new one in the shared folder if None.

    Spans may overlap between kinds.  Several jobs should not append to one ledger at the same time."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    blob = F.sha2(text.cast("binary"), 256)
    ledger = ledger or scratch_path(spark, "ledger")
    order = {r.kind: i for i, r in enumerate(rules)}
    want = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])

    known = write_table(read_ledger(spark, ledger).select("blob", "kind", "version"), "scanned")
    done = known.groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("done"))  # one entry a rule version
    blobs = docs.select(blob.alias("blob"), text.alias("text")).dropDuplicates(["blob"])
    unseen = blobs.join(done, "blob", "left").withColumn(
        "todo", F.when(F.col("done").isNull(), want).otherwise(F.array_except(want, "done"))).where(F.size("todo") > 0)
    pair = {r: F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules}
    found = F.array(*[F.struct(pair[r]["kind"].alias("kind"), pair[r]["version"].alias("version"),
                               F.when(F.array_contains("todo", pair[r]), spans(F.col("text"), r)).alias("spans")) for r in rules])
    new = unseen.select("blob", F.explode(F.filter(found, lambda x: x["spans"].isNotNull())).alias("f"))
    new.select("blob", "f.kind", "f.version", "f.spans").write.mode("append").option("compression", "zstd").parquet(ledger)

    current = F.lit(False)
    for r in rules:
        current = current | ((F.col("kind") == r.kind) & (F.col("version") == r.version))
    number = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    hits = (read_ledger(spark, ledger).where(current & (F.size("spans") > 0))
            .select("blob", F.explode("spans").alias("s"), "kind").distinct()
            .groupBy("blob").agg(F.array_sort(F.collect_list(F.struct(  # a blob's own findings
                F.col("s.begin").alias("begin"), number[F.col("kind")].alias("number"), F.col("s.end").alias("end"), "kind"))).alias("found")))
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    salt = F.pmod(F.xxhash64(*rest), F.lit(SALTS)) if rest else F.lit(0).cast("long")
    paths = docs.select(row_of(docs, text_col), F.col(f"`{text_col}`").alias("text"), blob.alias("blob"), salt.alias("salt"))
    # a blob with findings meets its paths in SALTS places, so a blob that most paths share is not one task
    hits = hits.select("blob", "found", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).alias("salt"))
    none = F.array().cast(hits.schema["found"].dataType)
    return paths.join(hits, ["blob", "salt"], "left").select("row", "text", "blob", F.coalesce("found", none).alias("found"))


def joined(found: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["begin"].cast("string"), x["end"].cast("string"))), ",")


def masked(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch covered by spans replaced by ``mark``; a fold over blocks of the sorted spans.

    The text is cut into chunks once; a block joins the few that hold its stretch, so all further cuts are short.
    """
    def edge(acc: Column, part: Column) -> Column:
        end = F.aggregate(part, acc["at"], lambda m, x: F.greatest(m, x["end"]))
        return F.struct(end.alias("at"), F.concat(acc["parts"], F.array(
            F.struct(acc["at"].alias("from"), end.alias("to"), part.alias("part")))).alias("parts"))

    kind = "array<struct<from:int,to:int,part:array<struct<begin:int,number:int,end:int,kind:string>>>>"
    edges = F.aggregate(_blocks(found), F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("parts")), edge)

    def cut(p: Column, chunks: Column) -> Column:
        def walk(acc: Column, x: Column, stretch: Column) -> Column:
            gap = F.substring(stretch, acc["at"] - p["from"] + 1, x["begin"] - acc["at"])
            out = F.when(x["begin"] > acc["at"], F.concat(acc["out"], F.array(gap, F.lit(mark)))).when(
                (acc["at"] == 0) | (x["begin"] == acc["at"]), F.concat(acc["out"], F.array(F.lit(mark)))).otherwise(acc["out"])
            return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

        start = F.struct(p["from"].alias("at"), F.array().cast("array<string>").alias("out"))
        first = F.floor(p["from"] / CHUNK).cast("int")
        near = F.array_join(F.slice(chunks, first + 1, F.floor(p["to"] / CHUNK).cast("int") - first + 1), "")
        stretches = F.array(F.substring(near, p["from"] % CHUNK + 1, p["to"] - p["from"]))  # an array of one: evaluated once
        return F.array_join(F.transform(stretches, lambda s: F.array_join(
            F.aggregate(p["part"], start, lambda acc, x: walk(acc, x, s), lambda acc: acc["out"]), "")), "")

    def close(e: Column) -> Column:
        chunks = F.array(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)))
        cuts = F.transform(chunks, lambda c: F.array_join(F.transform(e["parts"], lambda p: cut(p, c)), ""))
        return F.concat(F.get(cuts, F.lit(0)), F.substring(text, e["at"] + 1, F.length(text)))

    whole = F.transform(F.array(edges), close)  # an array of one: the edges are computed once
    return F.when(F.size(found) > 0, F.get(whole, F.lit(0))).otherwise(text)
