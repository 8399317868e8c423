"""Approximate nearest neighbours by cosine: stable projections in a kd-tree, verified until a chi-square test holds.

Vectors of length one lie as near as their cosine is large. A Gaussian (2-stable) matrix
takes them to ``width`` dimensions, where the squared distance of a pair, divided by its
true squared distance, is chi-square distributed with ``width`` degrees of freedom. A
query's projected neighbours are verified nearest first (a leaf of the tree at a time) by
exact cosines; it may stop once the next projected distance is one that a vector as near
as its k-th best so far would exceed with a probability of 1 - ``confidence`` only.

The tree has two levels. Its upper splits (at most ``MAX_CELLS`` cells, medians of a
sample of about ``SAMPLE`` vectors) deal all vectors into cells; a cell's vectors are dealt
into blocks of about ``BLOCK``, and each block is split down to leaves in its own task. A
query first searches its home cell; the distance of its k-th best then bounds the cells,
and in them the leaves, that the test can still ask for. Every other one is left out.

Equal vectors are one class that carries its k + 1 smallest ids, which is all that k
nearest can need: a vector that stands very often costs no more than one that stands once.
Queries are searched by class, too, and a class takes its ids' own rows off at the end.

Defined results: a null, empty or zero vector, and one with null or non-finite components,
takes no part; vectors of different length are no neighbours; a null vec_id is no query,
and as a candidate it sorts first; repeated rows are rows of their own, so a query's twin
under the same id is a neighbour; queries without any candidate, and an empty table, give
no rows; further columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeflux.llm.work import NULL_ID, id_back, materialise, sorted_groups

#: Vectors that the upper splits are fitted on, about; every vector is indexed.
SAMPLE = 20_000
MAX_CELLS = 1024
#: Vectors of a cell, of a block and of a leaf; queries that a block takes at a time.
CELL, BLOCK, LEAF, QUERIES = 16_384, 4096, 64, 2048


def chi_square_quantile(p: float, k: int) -> float:
    """The value that a chi-square variable of k degrees of freedom stays below with probability p."""

    def below(x: float) -> float:  # series of the regularised lower incomplete gamma function
        a, x = k / 2, x / 2
        term = total = math.exp(a * math.log(x) - x - math.lgamma(a + 1))
        n = 0
        while term > total * 1e-16:
            n += 1
            term *= x / (a + n)
            total += term
        return total

    lo, hi = 0.0, 1.0
    while below(hi) < p:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def projection(dim: int, width: int, seed: int) -> np.ndarray:
    """(dim, width) Gaussian matrix, the same in every task."""
    return np.random.default_rng([seed, dim]).standard_normal((dim, width))


class Splits:
    """The upper kd-tree of vectors of one length: a complete binary tree of median splits."""

    def __init__(self, points: np.ndarray, cells: int):
        self.depth = max(0, cells - 1).bit_length()
        n, width = (1 << self.depth) - 1, points.shape[1]
        self.dim, self.at = np.zeros(n, np.int64), np.zeros(n)
        lo, hi = np.full((1, width), -np.inf), np.full((1, width), np.inf)
        groups = [points]
        for level in range(self.depth):
            first, below = (1 << level) - 1, []
            lo, hi = np.repeat(lo, 2, 0), np.repeat(hi, 2, 0)
            for j, p in enumerate(groups):
                d = int(np.ptp(p, axis=0).argmax()) if len(p) else 0
                at = float(np.median(p[:, d])) if len(p) else 0.0
                self.dim[first + j], self.at[first + j] = d, at
                hi[2 * j, d], lo[2 * j + 1, d] = min(at, hi[2 * j, d]), max(at, lo[2 * j + 1, d])
                below += [p[p[:, d] < at], p[p[:, d] >= at]]
            groups = below
        self.lo, self.hi = lo, hi

    def cell(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        for _ in range(self.depth):
            node = 2 * node + 1 + (points[rows, self.dim[node]] >= self.at[node])
        return node - ((1 << self.depth) - 1)

    def distances(self, points: np.ndarray) -> np.ndarray:
        """Squared distances (points, cells) to the cells' boxes."""
        return _box_distances(points, self.lo, self.hi)


def _box_distances(points: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    out = np.zeros((len(points), len(lo)))
    for d in range(points.shape[1]):
        x = points[:, d, None]
        gap = np.maximum(np.maximum(lo[None, :, d] - x, x - hi[None, :, d]), 0)
        out += gap * gap
    return out


def leaves(points: np.ndarray, size: int = LEAF) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree, split at the median of the widest dimension."""
    todo, out = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        d = int(np.ptp(points[rows], axis=0).argmax())
        order = rows[np.argpartition(points[rows, d], len(rows) // 2)]
        todo += [order[: len(rows) // 2], order[len(rows) // 2 :]]
    return out


def search_block(points, vectors, first_id, q_points, q_vectors, bound, k: int, factor: float):
    """The k best classes of a block for each query: row numbers (-1: none) and cosines.

    bound: a cosine that each query's k-th best is known to reach (-inf: none known yet). Only rows that
    reach it are returned. All queries take their next leaf in the same step; one whose next leaf lies
    beyond what the test allows is done.
    """
    parts = leaves(points)
    width = max(map(len, parts))
    table = np.full((len(parts), width), -1)
    for i, rows in enumerate(parts):
        table[i, : len(rows)] = rows
    lo = np.stack([points[r].min(0) for r in parts])
    hi = np.stack([points[r].max(0) for r in parts])
    box = _box_distances(q_points, lo, hi)
    order = np.argsort(box, axis=1, kind="stable")
    norms, q_norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors)), np.sqrt(np.einsum("ij,ij->i", q_vectors, q_vectors))
    n = len(q_points)
    best, cosines, ids = np.full((n, k), -1), np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
    known = np.maximum(bound, -1.0)
    limit = np.where(np.isneginf(bound), np.inf, factor * np.maximum(2 - 2 * known, 1e-15))
    active = np.arange(n)
    for step in range(len(parts)):
        leaf = order[active, step]
        go = box[active, leaf] <= limit[active]
        active, leaf = active[go], leaf[go]
        if not len(active):
            break
        rows = table[leaf]
        gap = points[rows] - q_points[active][:, None]
        near = (np.einsum("qlw,qlw->ql", gap, gap) <= limit[active][:, None]) & (rows >= 0)
        i, j = near.nonzero()
        rows = rows[i, j]
        q = active[i]
        found = np.full(near.shape, -np.inf)
        found[i, j] = np.einsum("ij,ij->i", vectors[rows], q_vectors[q]) / (norms[rows] * q_norms[q])
        found[found < bound[active][:, None]] = -np.inf
        every = np.concatenate([cosines[active], found], axis=1)
        which = np.concatenate([best[active], table[leaf]], axis=1)
        its_id = np.concatenate([ids[active], first_id[table[leaf]]], axis=1)
        top = np.lexsort((its_id, -every), axis=1)[:, :k]
        cosines[active] = np.take_along_axis(every, top, 1)
        best[active] = np.take_along_axis(which, top, 1)
        ids[active] = np.take_along_axis(its_id, top, 1)
        kth = np.maximum(cosines[active, k - 1], bound[active])
        limit[active] = np.where(np.isneginf(kth), np.inf, factor * np.maximum(2 - 2 * kth, 1e-15))
    best[np.isneginf(cosines)] = -1
    return best, cosines


def _usable() -> Column:
    e = F.col("embedding")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce((F.size(e) > 0) & fine & F.exists(e, lambda v: v != 0), F.lit(False))


def _matrix(lists: pa.Array, rows: np.ndarray, dim: int) -> np.ndarray:
    at = lists.offsets.to_numpy()
    return lists.values.to_numpy()[(at[rows][:, None] + np.arange(dim)).ravel()].reshape(len(rows), dim)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))


def _project(classes: DataFrame, width: int, seed: int) -> DataFrame:
    """(cls, cls2, ids, dim, vector, point): vectors scaled by a power of two, and their projections."""

    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            size = np.diff(lists.offsets.to_numpy())
            for dim in np.unique(size).tolist():
                rows = np.flatnonzero(size == dim)
                x = _matrix(lists, rows, dim).astype(np.float64)
                x = np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])  # exact; no norm can overflow
                points = (x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]) @ projection(dim, width, seed)
                take = pa.array(rows)
                own = [batch.column(c).take(take) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(len(rows), dim, np.int32)), _lists(x), _lists(points)], ["cls", "cls2", "ids", "dim", "vector", "point"])

    return classes.select("cls", "cls2", "ids", "embedding").mapInArrow(run, "cls long, cls2 long, ids array<long>, dim int, vector array<double>, point array<double>")


def _split_all(classes: DataFrame) -> dict[int, Splits]:
    """The upper tree of each length; a length that the sample lacks has one cell."""
    counts = {r.dim: r.n for r in classes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = max(1, sum(counts.values()))
    share = F.pmod(F.xxhash64("cls", F.lit(1)), F.lit(1 << 30)) < int(min(1.0, SAMPLE / total) * (1 << 30))
    drawn: dict[int, list] = {}
    for r in classes.where(share).select("dim", "point").collect():
        drawn.setdefault(r.dim, []).append(r.point)
    return {d: Splits(np.array(p), min(MAX_CELLS, -(-counts[d] // CELL), len(p))) for d, p in drawn.items()}


def _visits(frame: DataFrame, trees: dict[int, Splits], factor: float, home: bool) -> DataFrame:
    """The frame's rows with the cells to visit: the home cell, or (with a column bound) all others that the test can ask for."""
    spark, names = frame.sparkSession, frame.columns
    shared = spark.sparkContext.broadcast(trees)  # at most MAX_CELLS cells a length
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields)

    def run(batches):
        for batch in batches:
            dims, lists = batch.column(names.index("dim")).to_numpy(), batch.column(names.index("point"))
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                tree = shared.value.get(dim)
                width = lists.offsets[1].as_py() - lists.offsets[0].as_py()
                points = _matrix(lists, rows, width)
                own = tree.cell(points) if tree else np.zeros(len(rows), np.int64)
                if home:
                    at, cell = np.arange(len(rows)), own
                else:
                    bound = batch.column(names.index("bound")).to_numpy()[rows]
                    limit = np.where(np.isneginf(bound), np.inf, factor * np.maximum(2 - 2 * bound, 1e-15))
                    asked = tree.distances(points) <= limit[:, None] if tree else np.zeros((len(rows), 1), bool)
                    asked[np.arange(len(rows)), own] = False
                    at, cell = asked.nonzero()
                for a in range(0, len(at), 4096):
                    take = pa.array(rows[at[a : a + 4096]])
                    yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in range(len(names))), pa.array(cell[a : a + 4096].astype(np.int32))], [*names, "cell"])

    return frame.mapInArrow(run, fields + ", cell int")


def _search(points: DataFrame, visits: DataFrame, k: int, factor: float) -> DataFrame:
    """(cls, cls2, score, ids) of the best classes in each block that a query class visits."""
    keys = ["dim", "cell", "block", "part"]
    blocks = points.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    parts = visits.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("parts"))
    sizes = blocks.join(parts, ["dim", "cell"])
    spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n, salt: F.pmod(F.xxhash64("cls", F.lit(salt)), F.col(n)).cast("int")
    none = F.lit(float("-inf"))
    data = points.join(sizes, ["dim", "cell"]).withColumns({"block": deal("blocks", 2), "part": spread("parts")})
    data = data.select(*keys, F.lit(0).alias("side"), "cls", "cls2", none.alias("bound"), "ids", "vector", "point")
    asks = visits.join(sizes, ["dim", "cell"]).withColumns({"block": spread("blocks"), "part": deal("parts", 3)})
    asks = asks.select(*keys, F.lit(1).alias("side"), "cls", "cls2", "bound", F.array().cast("array<long>").alias("ids"), "vector", "point")
    both = data.union(asks).repartition(*keys).sortWithinPartitions(*keys, "side")

    def run(batches):
        for g in sorted_groups(batches, len(keys)):
            side = g.column("side").to_numpy()
            own, ask = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(own) or not len(ask):
                continue
            dim = int(g.column("dim")[0].as_py())
            width = len(g.column("point")[0])
            points, vectors, ids = g.column("point"), g.column("vector"), g.column("ids")
            first = ids.values.to_numpy()[ids.offsets.to_numpy()[own]]
            best, cosines = search_block(
                _matrix(points, own, width), _matrix(vectors, own, dim), first, _matrix(points, ask, width), _matrix(vectors, ask, dim), g.column("bound").to_numpy()[ask], k, factor
            )
            q, r = (best >= 0).nonzero()
            if len(q):
                rows, hit = pa.array(ask[q]), pa.array(own[best[q, r]])
                cols = [g.column("cls").take(rows), g.column("cls2").take(rows), pa.array(cosines[q, r]), g.column("cls").take(hit), g.column("cls2").take(hit), ids.take(hit)]
                yield pa.RecordBatch.from_arrays(cols, ["cls", "cls2", "score", "hit", "hit2", "ids"])

    return both.mapInArrow(run, "cls long, cls2 long, score double, hit long, hit2 long, ids array<long>")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query class; Spark keeps k a class in each task before it shuffles."""
    order = Window.partitionBy("cls", "cls2").orderBy(F.col("score").desc(), F.col("ids")[0])
    return found.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k)


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5, width: int = 16, confidence: float = 0.97, seed: int = 13) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row of (vec_id, embedding), nearest first.

    is_query is a condition on vec_id. width and confidence: dimensions and level of the stopping test.
    """
    factor, top = chi_square_quantile(confidence, width), k + 1
    vec = F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID))
    usable = embeddings.where(_usable()).select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    rows = usable.select(
        vec.alias("vec"),
        F.coalesce(is_query & F.col("vec_id").isNotNull(), F.lit(False)).alias("asked"),
        # 0.0 and -0.0 are one value
        F.transform("embedding", lambda v: v + F.lit(0.0)).alias("embedding"),
    ).withColumns({"cls": F.xxhash64("embedding"), "cls2": F.xxhash64(F.lit(7), "embedding")})
    rows = materialise(rows, "vectors")
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("cls", "cls2").orderBy("vec"))).where(F.col("r") <= top)
    classes = ranked.groupBy("cls", "cls2").agg(F.array_sort(F.collect_list("vec")).alias("ids"), F.first("embedding").alias("embedding"))
    classes = materialise(_project(classes, width, seed), "classes")
    trees = _split_all(classes)
    points = materialise(_visits(classes, trees, factor, True), "points")
    queries = rows.where("asked").select("cls", "cls2", "vec")
    asked = queries.select("cls", "cls2").distinct()
    none = F.lit(float("-inf"))
    at_home = points.join(asked, ["cls", "cls2"], "left_semi").withColumn("bound", none)
    first = materialise(_best(_search(points, at_home, top, factor), top), "near-home")
    kth = first.where(F.col("r") == top).select("cls", "cls2", F.col("score").alias("kth"))
    on = at_home.drop("bound", "cell").join(kth, ["cls", "cls2"], "left").withColumn("bound", F.coalesce("kth", none)).drop("kth")
    second = _search(points, _visits(on, trees, factor, False), top, factor)
    best = _best(first.drop("r").unionByName(second), top)
    own = (F.col("cls") == F.col("hit")) & (F.col("cls2") == F.col("hit2"))
    entry = F.transform("ids", lambda i: F.struct((-F.col("score")).alias("far"), i.alias("vec"), own.alias("own")))
    lists = best.groupBy("cls", "cls2").agg(F.array_sort(F.flatten(F.collect_list(entry))).alias("near"))  # at most top * top
    joined = queries.join(lists, ["cls", "cls2"])
    mine = F.array_position(F.transform("near", lambda e: F.when(e["own"] & (e["vec"] == F.col("vec")), 1).otherwise(0)), 1)
    near = joined.withColumn("mine", mine).withColumn("near", F.filter("near", lambda e, i: i + 1 != F.col("mine")))
    out = near.select("vec", F.posexplode(F.slice("near", 1, k)).alias("pos", "e"))
    return out.select(F.col("vec").alias("query_id"), (F.col("pos") + 1).cast("int").alias("rank"), id_back("e.vec").alias("vec_id"), (-F.col("e.far")).alias("score"))
