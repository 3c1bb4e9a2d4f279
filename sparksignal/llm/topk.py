"""Exact top-k by integer inner product: KD-trees per shard, searched best first.

The top levels of one KD-tree, fitted on a sample of ``SAMPLE_ROWS`` rows (about; by the hash of the row
number), deal all vectors to regions; a region over ``shard_rows`` is dealt on by hash, so that a vector repeated
a million times fills many shards and no large one.  A shard is one KD-tree (median splits, tight boxes).  The queries
of a shard search their own shard first; the kth score and id they find there are the bound they carry.
Then blocks of queries meet blocks of shards' outer boxes, and a query goes on to those shards only whose
box can reach its kth hit: queries move to trees, and a tree moves once for ``SLICE_BYTES`` of queries in all.
In a shard a query visits nodes best first by the highest score its box allows, and stops when no box can
reach the kth score; equal scores are followed, as ties go to the smaller id.  A shard returns ``k`` rows a
query at most.

The query set is stated (ids divisible by ``every``); blocks of it against all shards is the whole
search.  A task holds one tree and one slice of the queries.

Cases: vectors that are null, empty, or hold null or non-finite components take no part, nor do rows with
a null id; vectors of other dimensions than the query's are no candidates; repeated rows are vectors of their own
(a query skips only its own row); fewer than k candidates give fewer rows; an empty table gives an
empty result.  A score beyond 64 bits is an error.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from sparksignal.llm.chunks import write_table

K, EVERY, SCALE = 5, 50, 256
SHARD_ROWS, QUERY_ROWS, LEAF_ROWS = 8192, 2048, 256
SAMPLE_ROWS, LEAST_SAMPLE = 16_384, 16  # rows that place the regions; of these in a region at least
BOX_SHARDS, SLICE_BYTES = 256, 64 << 20
EXACT = float(1 << 53)
TREE = ("part long, dim int, ids binary, uids binary, points binary, lo binary, hi binary, children binary, "
        "spans binary, least binary, asked binary")
HIT = "query_id long, query_uid long, vec_id long, score long"
FLOOR = "array<struct<kth:long,id:long>>"  # a query's kth hit so far; null with fewer than k
ASK = f"part long, dim int, block int, ids binary, uids binary, points binary, floor {FLOOR}"


def usable(vector: Column) -> Column:
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(ok, F.lit(False))


def _matrix(got: pa.Table, dim: int) -> np.ndarray:
    flat = got["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(SCALE * flat).reshape(-1, dim)


def build_tree(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
    """Order of the points and, by node: lo, hi, (left, right) or (-1, -1), (begin, end), smallest id."""
    order, lo, hi, children, spans, least = np.arange(len(points)), [], [], [], [], []

    def add(a: int, z: int) -> int:
        at, own = len(lo), points[order[a:z]]
        lo.append(own.min(0))
        hi.append(own.max(0))
        children.append((-1, -1))
        spans.append((a, z))
        least.append(ids[order[a:z]].min())
        width = hi[at] - lo[at]
        if z - a > leaf and width.max() > 0:
            mid = (z - a) // 2
            order[a:z] = order[a:z][np.argpartition(own[:, int(width.argmax())], mid)]
            children[at] = add(a, a + mid), add(a + mid, z)
        return at

    add(0, len(points))
    return order, np.array(lo), np.array(hi), np.array(children, "<i4"), np.array(spans, "<i4"), np.array(least, "<i8")


def top_splits(sample: np.ndarray, regions: int) -> tuple[np.ndarray, ...]:
    """The top of a KD-tree over ``sample`` with ``regions`` leaves at most: by node axis (-1: leaf), cut, left, right, region."""
    nodes: list[list] = []

    def add(points: np.ndarray, want: int) -> int:
        at, width = len(nodes), np.ptp(points, axis=0) if len(points) else np.zeros(1)
        nodes.append([-1, 0.0, 0, 0, at])
        if want > 1 and len(points) >= 2 * LEAST_SAMPLE and width.max() > 0:
            axis = int(width.argmax())
            cut = np.median(points[:, axis])
            low = points[:, axis] < cut
            if not low.any():
                low = points[:, axis] <= cut
                cut = np.nextafter(cut, np.inf)
            nodes[at][:4] = axis, cut, add(points[low], want // 2), add(points[~low], want - want // 2)
        return at

    add(sample, regions)
    return tuple(np.array(c) for c in zip(*nodes))


def regions_of(splits: tuple[np.ndarray, ...], points: np.ndarray) -> np.ndarray:
    axis, cut, left, right, region = splits
    at = np.zeros(len(points), np.int64)
    inner = axis[at] >= 0
    while inner.any():
        go = points[np.flatnonzero(inner), axis[at[inner]]] < cut[at[inner]]
        at[inner] = np.where(go, left[at[inner]], right[at[inner]])
        inner = axis[at] >= 0
    return region[at].astype(np.int64)


def box_bounds(queries: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The highest score each query can reach in each box."""
    return np.maximum(queries, 0) @ hi.T + np.minimum(queries, 0) @ lo.T


def _exact(*points: np.ndarray) -> bool:
    """Are sums of products of the first with the others whole numbers without rounding?"""
    most = [np.abs(p).max(initial=0) for p in points]
    return most[0] * max(most[1:]) * max(1, points[0].shape[1]) < EXACT


def search(tree: dict, queries: np.ndarray, own: np.ndarray, floor: list, k: int):
    """For each query the (score, id, uid) of its best ``k`` rows that reach ``floor`` (score, -id), its own row left out."""
    pts, ids, uids = tree["points"], tree["ids"], tree["uids"]
    if not _exact(queries, pts):  # sums of doubles would round: whole numbers of any size
        whole = np.vectorize(int, otypes=[object])
        pts, queries, lo, hi = (whole(x) for x in (pts, queries, tree["lo"], tree["hi"]))
    else:
        lo, hi = tree["lo"], tree["hi"]
    bounds = box_bounds(queries, lo, hi)
    children, spans, least = tree["children"], tree["spans"], tree["least"]
    for q in range(len(queries)):
        best: list[tuple] = []  # heap of (score, -id, uid): the worst first
        bar = floor[q]
        todo = [(-bounds[q][0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            if (-bound, -least[node]) < bar:
                if -bound < bar[0]:
                    break
                continue
            left, right = children[node]
            if left >= 0:
                for c in (left, right):
                    if (bounds[q][c], -least[c]) >= bar:
                        heapq.heappush(todo, (-bounds[q][c], int(c)))
                continue
            a, z = spans[node]
            scores = pts[a:z] @ queries[q]
            for i in np.flatnonzero(scores >= bar[0]).tolist():
                if uids[a + i] == own[q]:
                    continue
                item = (int(scores[i]), -int(ids[a + i]), int(uids[a + i]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
                if len(best) == k:
                    bar = max(bar, (best[0][0], best[0][1]))
        yield [(s, -i, u) for s, i, u in sorted(best, reverse=True)]


def _unpack(row: dict, tree: bool = True) -> dict:
    dim = row["dim"]
    out = {"ids": np.frombuffer(row["ids"], "<i8"), "uids": np.frombuffer(row["uids"], "<i8"),
           "points": np.frombuffer(row["points"], "<f8").reshape(-1, dim)}
    if tree:
        out |= {"lo": np.frombuffer(row["lo"], "<f8").reshape(-1, dim), "hi": np.frombuffer(row["hi"], "<f8").reshape(-1, dim),
                "children": np.frombuffer(row["children"], "<i4").reshape(-1, 2), "asked": np.frombuffer(row["asked"], "<i4"),
                "spans": np.frombuffer(row["spans"], "<i4").reshape(-1, 2), "least": np.frombuffer(row["least"], "<i8")}
    return out


def _rows(batches):
    """Row by row, as rows hold whole blocks."""
    for b in batches:
        for i in range(len(b)):
            yield b.slice(i, 1).to_pylist()[0]


def _bars(floor: list) -> list[tuple]:
    return [(f["kth"], -f["id"]) if f else (-np.inf, -np.inf) for f in floor]


def _hits(tree: dict, ids: np.ndarray, uids: np.ndarray, points: np.ndarray, floor: list, k: int) -> list[tuple]:
    return [(int(ids[j]), int(uids[j]), i, _long(s))
            for j, found in enumerate(search(tree, points, uids, _bars(floor), k)) for s, i, _ in found]


def _hit_table(hits: list[tuple]) -> pa.Table:
    return pa.table([pa.array([h[c] for h in hits], pa.int64()) for c in range(4)], ["query_id", "query_uid", "vec_id", "score"])


def _long(score: int) -> int:
    if not -(1 << 63) <= score < 1 << 63:
        raise OverflowError("a score is over 64 bits")
    return score


def dealt(rows: DataFrame, n: int, shard_rows: int) -> DataFrame:
    """``rows`` with their shard: column ``part``."""
    some = rows.where(F.pmod(F.xxhash64("uid"), F.lit(n)) < SAMPLE_ROWS) if n > SAMPLE_ROWS else rows
    sample = some.select("dim", "vector").toArrow()
    share, splits = n / max(1, len(sample)), {}
    for dim in set(sample["dim"].to_pylist()):
        points = _matrix(sample.filter(pc.equal(sample["dim"], dim)), dim)
        splits[dim] = top_splits(points, max(1, round(len(points) * share / shard_rows)))

    def route(batches):
        for b in batches:
            t = pa.Table.from_batches([b])
            region = np.zeros(len(b), np.int64)  # all rows of a dimension that the sample lacks
            dims = t["dim"].to_numpy()
            for dim in set(dims.tolist()) & set(splits):
                at = np.flatnonzero(dims == dim)
                region[at] = regions_of(splits[dim], _matrix(t.take(at), dim))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(region)], [*b.schema.names, "region"])

    routed = rows.mapInArrow(route, T.StructType([*rows.schema.fields, T.StructField("region", T.LongType())]))
    parts = routed.groupBy("dim", "region").agg(F.ceil(F.count("*") / shard_rows).alias("shares"))
    part = F.shiftleft("region", 32).bitwiseOR(F.pmod(F.xxhash64("uid"), F.col("shares")))
    return routed.join(parts, ["dim", "region"]).withColumn("part", part).drop("region", "shares")


def top_k(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, every: int = EVERY,
          shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` of every row whose id is divisible by ``every``."""
    vec = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vector")).where(
        F.col("id").isNotNull() & usable(F.col("vector")))
    rows = write_table(rows.withColumn("dim", F.size("vector")).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.when(F.col("id") % every == 0, F.col("dim") * 8)), F.lit(0)).alias("asked")).first()
    slices = size["asked"] // SLICE_BYTES + 1

    def build(key, got):
        got = got.sort_by("uid")
        part, dim = (x.as_py() for x in key)
        points, ids, uids = _matrix(got, dim), got["id"].to_numpy(), got["uid"].to_numpy()
        order, *arrays = build_tree(points, ids)
        asked = np.flatnonzero(ids[order] % every == 0).astype("<i4")
        packed = [ids[order].astype("<i8"), uids[order].astype("<i8"), points[order].astype("<f8"), *arrays, asked]
        return pa.table([pa.array([part], pa.int64()), pa.array([dim], pa.int32()), *(pa.array([x.tobytes()], pa.binary()) for x in packed)],
                        [c.split()[0] for c in TREE.split(", ")])

    trees = write_table(dealt(rows, size["n"], shard_rows).groupBy("part", "dim").applyInArrow(build, TREE), "trees")

    def at_home(batches):
        """The queries of a shard against the shard: blocks with the bounds and hits found."""
        for row in _rows(batches):
            tree = _unpack(row)
            for block, lo in enumerate(range(0, len(tree["asked"]), query_rows)):
                at = tree["asked"][lo:lo + query_rows]
                ids, uids, points = (tree[c][at] for c in ("ids", "uids", "points"))
                floor, hits = [None] * len(at), []
                for j, found in enumerate(search(tree, points, uids, _bars(floor), k)):
                    if len(found) == k:
                        floor[j] = {"kth": _long(found[-1][0]), "id": found[-1][1]}
                    hits += [{"query_id": int(ids[j]), "query_uid": int(uids[j]), "vec_id": i, "score": _long(s)} for s, i, _ in found]
                yield pa.RecordBatch.from_pylist([{
                    "part": row["part"], "dim": row["dim"], "block": block, "ids": ids.tobytes(), "uids": uids.tobytes(),
                    "points": points.tobytes(), "floor": floor, "hits": hits}], ask_type)

    ask_type = to_arrow_schema(T.StructType.fromDDL(f"{ASK}, hits array<struct<query_id:long,query_uid:long,vec_id:long,score:long>>"))
    asks = write_table(trees.mapInArrow(at_home, from_arrow_schema(ask_type)), "queries")
    first = asks.select(F.inline("hits"))

    # blocks of boxes, in as many copies as there are slices of the queries, so that no task meets all queries
    box = F.struct("part", F.expr("substring(lo, 1, dim * 8)").alias("lo"), F.expr("substring(hi, 1, dim * 8)").alias("hi"),
                   F.expr("substring(least, 1, 8)").alias("least"))
    groups = F.lit(trees.count() // BOX_SHARDS + 1)
    numbers = [F.sequence(F.lit(0).cast("long"), x.cast("long") - 1) for x in (groups, F.lit(slices))]
    boxes = (trees.select("dim", F.pmod(F.xxhash64("part"), groups).alias("group"), box.alias("box"))
             .groupBy("dim", "group").agg(F.collect_list("box").alias("boxes")).withColumn("slice", F.explode(numbers[1])))
    asking = asks.drop("hits").withColumn("slice", F.pmod(F.xxhash64("part", "block"), F.lit(slices)))
    met = asking.withColumn("group", F.explode(numbers[0])).join(boxes, ["dim", "group", "slice"])

    def reach(batches):
        """For each shard that can better a query's kth hit: the queries it must answer."""
        for row in _rows(batches):
            q = _unpack(row, False)
            others = [b for b in row["boxes"] if b["part"] != row["part"]]
            if not others:
                continue
            lo, hi = (np.frombuffer(b"".join(b[c] for b in others), "<f8").reshape(-1, row["dim"]) for c in ("lo", "hi"))
            if _exact(q["points"], lo, hi):
                bars = np.array(_bars(row["floor"]), float)
                bounds = box_bounds(q["points"], lo, hi)
                go = bounds >= bars[:, :1]
            else:
                go = np.ones((len(q["ids"]), len(others)), bool)
            for b, at in zip(others, (np.flatnonzero(g) for g in go.T)):
                if len(at):
                    yield pa.RecordBatch.from_pylist([{
                        "part": b["part"], "dim": row["dim"], "block": row["block"], "ids": q["ids"][at].tobytes(), "uids": q["uids"][at].tobytes(),
                        "points": q["points"][at].tobytes(), "floor": [row["floor"][i] for i in at], "slice": row["slice"]}], sent_type)

    sent_type = to_arrow_schema(T.StructType.fromDDL(f"{ASK}, slice long"))
    sent = met.mapInArrow(reach, from_arrow_schema(sent_type))

    def answer(key, asks, trees):
        if not len(asks) or not len(trees):
            return _hit_table([])
        tree, hits = _unpack(trees.to_pylist()[0]), []
        for row in asks.sort_by("block").to_pylist():
            q = _unpack(row, False)
            hits += _hits(tree, q["ids"], q["uids"], q["points"], row["floor"], k)
        return _hit_table(hits)

    by = ["part", "dim", "slice"]
    rest = sent.groupBy(*by).cogroup(trees.withColumn("slice", F.explode(numbers[1])).groupBy(*by)).applyInArrow(answer, HIT)
    best = first.unionByName(rest).withColumn("rank", F.expr(
        "row_number() OVER (PARTITION BY query_uid ORDER BY score DESC, vec_id)"))
    return best.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
