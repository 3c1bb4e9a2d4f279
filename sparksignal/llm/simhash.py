"""SimHash near-dedup: fingerprints that differ in few bits, found with BK-trees.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes of a text's word
shingles.  Distinct fingerprints are sharded so that any two within ``radius`` bits meet in a
shard: the 64 bits are cut into ``radius + k`` blocks, of which such a pair shares ``k`` at
least; a shard holds the fingerprints that agree in the leading bits of one choice of ``k``
blocks.  Each shard builds a BK-tree (children keyed by their Hamming distance to the parent) and follows
only edges within the radius.  A tree is sent to the fingerprints of its own shard alone, since a
broadcast of all trees has no size bound.

A shard of over ``CROWD`` fingerprints is split by a second choice of blocks: its fingerprints agree in the
whole blocks of the first choice (pairs that don't, meet under another choice), and the bits that vary among
them are cut into ``radius + AGAIN`` blocks, of which ``AGAIN`` at least agree.  Bits that all of them share don't
count, so fingerprints with long common parts are split as well as others.

Only connectivity is needed, so a shard returns a spanning forest, never all pairs: everything within
the radius of a node is one component with it, and the search between such subtrees is skipped.

Cases: null or empty texts and texts without words have fingerprint zero and link like any
other; fewer words than a shingle give one shingle; repeated rows are separate documents of one
component; a null id takes part but does not name a component unless all ids there are null; an
empty table gives an empty result; the other columns are not touched.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparksignal.llm import chunks as ch
from sparksignal.llm.components import components

SHINGLE, RADIUS, SEED = 4, 4, 42
SHARD_POINTS = 2048
CROWD, AGAIN = 4 * SHARD_POINTS, 2
LEAF = 128


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash; ``bytes.lower`` and ``bytes.split`` are ASCII only, as the words ask for."""
    words = text.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.concatenate([np.flatnonzero(np.frombuffer(line, np.uint8) == 32), [len(line)]])
    k = min(shingle, len(words))
    stops = ends[k - 1:].tolist()
    starts = [0, *(ends[:len(stops) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(line[a:b], SEED) for a, b in zip(starts, stops)], "<u8")
    ones = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):  # a long text needs no more memory than this many hashes
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``row`` (struct of all columns but the text), ``fp`` (64 bits as a long)."""
    src = docs.select(ch.row_of(docs, text_col), F.col(f"`{text_col}`").cast("binary").alias("t"))
    schema = T.StructType([src.schema["row"], T.StructField("fp", T.LongType())])

    def run(batches):
        for b in batches:
            fps = np.array([fingerprint(t.as_py() or b"", shingle) for t in b.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps.view(np.int64))], ["row", "fp"])

    return src.mapInArrow(run, schema)


class Forest:
    """Union-find over the points of one shard."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.find(i), self.find(j)
        if i != j:
            self.up[max(i, j)] = min(i, j)


def bk_tree(points: np.ndarray, ids: np.ndarray):
    """(root id, {distance: subtree}); few points are kept as a flat leaf (None, ids)."""
    if len(ids) <= LEAF:
        return None, ids
    d = np.bitwise_count(points[ids[1:]] ^ points[ids[0]])
    order = np.argsort(d, kind="stable")
    cuts = np.flatnonzero(np.diff(d[order])) + 1
    return int(ids[0]), {int(d[g[0]]): bk_tree(points, ids[1:][g]) for g in np.split(order, cuts)}


def _members(tree):
    root, rest = tree
    if root is None:
        return rest
    return np.concatenate([[root], *(_members(t) for t in rest.values())])


def _meet(points: np.ndarray, tree, q: np.ndarray, radius: int, forest: Forest, one: bool) -> np.ndarray:
    """Link the points ``q`` to the points of ``tree`` within the radius.  ``one``: the tree is one
    component already, so a point needs one link only.  Returns the points without a link."""
    root, rest = tree
    if root is None:
        close = np.bitwise_count(points[q][:, None] ^ points[rest][None, :]) <= radius
        hit = close.any(1)
        if one:
            pairs = zip(q[hit].tolist(), rest[close[hit].argmax(1)].tolist())
        else:
            at = np.nonzero(close)
            pairs = zip(q[at[0]].tolist(), rest[at[1]].tolist())
        for i, j in pairs:
            forest.join(i, j)
        return q[~hit] if one else q
    d = np.bitwise_count(points[q] ^ points[root]).astype(np.int64)
    hit = d <= radius
    for j in q[hit].tolist():
        forest.join(root, j)
    if one:
        q, d = q[~hit], d[~hit]
        hit = hit[~hit]
    done = np.zeros(len(q), bool)
    for e, child in rest.items():
        near = (np.abs(d - e) <= radius) & ~(hit & (e <= radius)) & ~done  # a hit is already linked with the root's ball
        if near.any():
            at = np.flatnonzero(near)
            ball = one or e <= radius
            left = _meet(points, child, q[at], radius, forest, ball)
            if ball:
                linked = ~np.isin(q[at], left)
                if one:
                    done[at[linked]] = True
                else:
                    hit[at[linked]] = True  # with the root's ball: skip its other subtrees
    return q[~done]


def link_shard(points: np.ndarray, radius: int) -> np.ndarray:
    """Smallest index of each point's component among distinct ``points`` linked at ``radius`` or fewer bits."""
    forest = Forest(len(points))

    def inside(tree):
        root, rest = tree
        if root is None:
            d = np.bitwise_count(points[rest][:, None] ^ points[rest][None, :])
            for i, j in zip(*np.nonzero(np.triu(d <= radius, 1))):
                forest.join(int(rest[i]), int(rest[j]))
            return
        edges = sorted(rest)
        for k, e in enumerate(edges):
            members = _members(rest[e])
            if e <= radius:
                for j in members.tolist():
                    forest.join(root, j)
            else:
                inside(rest[e])
            left = members  # against nearer subtrees; the root's ball (edges within the radius) is one component
            for f in edges[:k]:
                if e - f > radius or e <= radius:
                    continue
                unlinked = _meet(points, rest[f], left if f <= radius else members, radius, forest, f <= radius)
                if f <= radius:
                    left = unlinked

    inside(bk_tree(points, np.arange(len(points))))
    return np.array([forest.find(i) for i in range(len(points))], np.int64)


def second_masks(whole: int, varying: int, radius: int) -> list[int]:
    """The bits of each second choice: the first choice's ``whole`` blocks and ``AGAIN`` blocks of the other varying bits."""
    bits = [1 << b for b in range(64) if (varying & ~whole) >> b & 1]
    parts = [sum(bits[len(bits) * i // (radius + AGAIN):len(bits) * (i + 1) // (radius + AGAIN)]) for i in range(radius + AGAIN)]
    return [whole | sum(c) for c in combinations(parts, AGAIN)]


def split_crowds(shards: DataFrame, whole: list[int], radius: int, crowd: int = CROWD) -> DataFrame:
    """``fp, pick, part`` with ``again, rest``: a second choice and its bits, in crowded shards only (-1 and 0 in others)."""
    def masks(batches):
        for b in batches:
            rows = b.to_pylist()
            found = [second_masks(whole[r["pick"]], r["varying"] % (1 << 64), radius) for r in rows]
            found = [np.array(m, np.uint64).view(np.int64).tolist() for m in found]
            yield pa.RecordBatch.from_arrays([pa.array([r["pick"] for r in rows], pa.int32()), pa.array([r["part"] for r in rows], pa.int64()),
                                              pa.array(found, pa.list_(pa.int64()))], ["pick", "part", "masks"])

    varying = F.bit_or("fp").bitwiseXOR(F.bit_and("fp")).alias("varying")
    crowded = shards.groupBy("pick", "part").agg(F.count("*").alias("n"), varying).where(F.col("n") > crowd)
    told = shards.join(crowded.mapInArrow(masks, "pick int, part long, masks array<long>"), ["pick", "part"], "left")
    choices = F.coalesce("masks", F.array(F.lit(None).cast("long")))
    told = told.select("fp", "pick", "part", F.posexplode(choices).alias("again", "mask"))
    return told.select("fp", "pick", "part", F.when(F.col("mask").isNull(), -1).otherwise(F.col("again")).alias("again"),
                       F.coalesce(F.col("fp").bitwiseAND(F.col("mask")), F.lit(0).cast("long")).alias("rest"))


def links(fps: DataFrame, n: int, radius: int = RADIUS) -> DataFrame:
    """Spanning links ``a, b`` (fingerprints as longs) of distinct fingerprints ``fp``."""
    share, want = 1, max(1, int(np.ceil(np.log2(max(2, n) / SHARD_POINTS))))
    while share * 64 // (radius + share) < want and share < 4:
        share += 1
    blocks = radius + share
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    keys = []
    for pick in combinations(range(blocks), share):
        key, room = F.lit(0).cast("long"), want
        for b in pick:
            width = min(cuts[b + 1] - cuts[b], -(-room // (share - pick.index(b))))
            part = F.shiftrightunsigned("fp", cuts[b + 1] - width).bitwiseAND((1 << width) - 1)
            key, room = F.shiftleft(key, width).bitwiseOR(part), room - width
        keys.append(key)
    shards = fps.select("fp", F.posexplode(F.array(*keys)).alias("pick", "part"))
    whole = [sum((1 << cuts[b + 1]) - (1 << cuts[b]) for b in pick) for pick in combinations(range(blocks), share)]

    def link(key, got):
        fp = np.sort(got["fp"].to_numpy().view(np.uint64))
        root = link_shard(fp, radius)
        far = np.flatnonzero(root != np.arange(len(fp)))
        return pa.table({"a": pa.array(fp[far].view(np.int64)), "b": pa.array(fp[root[far]].view(np.int64))})

    return split_crowds(shards, whole, radius).groupBy("pick", "part", "again", "rest").applyInArrow(link, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """``row`` (struct of the other columns), ``uid`` (a row number of this call), ``fp`` (long),
    ``component_id`` (smallest id reachable), ``first_uid`` (the row that stands for the component: the
    smallest id, then the smallest uid)."""
    table = ch.write_table(fingerprints(docs, text_col, shingle).withColumn("uid", F.monotonically_increasing_id()), "fingerprints")
    row_id = F.col(f"row.`{id_col}`")
    nodes = ch.write_table(table.groupBy("fp").agg(F.min(F.struct(row_id.isNull().alias("none"), row_id.alias("id"), "uid")).alias("low")), "nodes")
    parts = components(links(nodes.select("fp"), nodes.count(), radius))
    rooted = nodes.join(parts, nodes.fp == parts.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "low")
    lows = rooted.groupBy("root").agg(F.min("low").alias("low"))
    named = rooted.select("fp", "root").join(lows, "root").select(
        "fp", F.col("low.id").alias("component_id"), F.col("low.uid").alias("first_uid"))
    return table.join(named, "fp")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stand for their components, with all their columns."""
    whole = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.struct("*").alias("doc"))
    out = near_duplicates(whole, "id", "text", shingle, radius)
    return out.where(F.col("uid") == F.col("first_uid")).select("row.doc.*")
