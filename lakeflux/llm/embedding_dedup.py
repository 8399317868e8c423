"""Near-duplicate embeddings by cross-polytope hashing after fast Hadamard rotations.

A vector is rotated three times (random signs, then a fast Hadamard transform); its code
in a table is its largest coordinate, sign included, of each of ``functions`` rotations.
Multiprobe: a vector also stands in the buckets that the second largest coordinate of
one function gives. Vectors with equal labels that share a bucket are candidates, and
every candidate pair is verified by its exact cosine.

Equal vectors of one label are one class from the start. A bucket's classes are dealt into
blocks of ``BLOCK`` and block pairs are compared by matrix products in tasks of their own;
a pair is counted in the first bucket that both share. Tasks emit counts and spanning
links, never the pairs of a group.

Defined results: null, empty and zero vectors, vectors with null or non-finite components,
and null labels link with nothing; vectors of different length do not link; repeated rows
are vectors of their own that link with each other; a null vec_id links as any other and
sorts first (component_id is null where it is the smallest); an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.llm.components import components
from lakeflux.llm.work import NULL_ID, id_back, materialise

BLOCK = 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of every row; the width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def bucket_codes(x: np.ndarray, tables: int, functions: int, seed: int) -> np.ndarray:
    """(rows, tables * (1 + functions)) codes of unit vectors: own bucket and probes of every table."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :dim] = x
    signs = np.random.default_rng(seed).choice([-1.0, 1.0], size=(tables, functions, 3, d))
    out = []
    for t in range(tables):
        best, second = [], []
        for f in range(functions):
            y = padded
            for s in signs[t, f]:
                y = hadamard(y * s)
            size = np.abs(y)
            top = np.argpartition(size, d - 2, axis=1)[:, d - 2 :] if d > 2 else np.tile(np.arange(2), (n, 1))
            high = np.take_along_axis(size, top, 1).argmax(1)
            rows = np.arange(n)
            for which, into in ((high, best), (1 - high, second)):
                at = top[rows, which]
                into.append(2 * at + (y[rows, at] < 0))
        for probe in range(functions + 1):
            code = np.full(n, t, np.uint64)
            for f in range(functions):
                code = T.mix(code * np.uint64(0x9E3779B1) + (second if probe == f + 1 else best)[f].astype(np.uint64) + np.uint64(f + 1))
            out.append(code)
    return np.stack(out, 1)


def _valid():
    e = F.col("embedding")
    fine = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col("label").isNotNull() & (F.size(e) > 0) & fine & F.exists(e, lambda v: v != 0), F.lit(False))


def _classes(rows: DataFrame, tables: int, functions: int, seed: int) -> DataFrame:
    """(cls, n, unit, codes): classes with their number of rows, unit vector and buckets; label and length are part of a code."""
    once = rows.groupBy("cls", "cls2").agg(F.count(F.lit(1)).alias("n"), F.first("embedding").alias("e"), F.first("label").alias("label"))
    salted = once.select("cls", "n", "e", F.xxhash64(F.col("label").cast("string"), F.size("e")).alias("salt"))

    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            size = np.diff(lists.offsets.to_numpy())
            flat, at = lists.flatten().to_numpy().astype(np.float64), np.append(0, np.cumsum(size))
            for dim in np.unique(size).tolist():
                some = np.flatnonzero(size == dim)
                x = flat[(at[some][:, None] + np.arange(dim)).ravel()].reshape(len(some), dim)
                x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the norm
                x = x / np.linalg.norm(x, axis=1, keepdims=True)
                codes = T.mix(bucket_codes(x, tables, functions, seed) ^ batch.column(3).to_numpy()[some].view(np.uint64)[:, None])
                cut = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel()))
                take = pa.array(some)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), cut(x), cut(T.signed(codes))], ["cls", "n", "unit", "codes"])

    return salted.mapInArrow(run, "cls long, n long, unit array<double>, codes array<long>")


def _compare(rows: DataFrame, threshold: float) -> DataFrame:
    """Counts and spanning links of the pairs of each (code, b1, b2), rows sorted by them in each task."""

    def one(code, two_blocks, side, cls, n, x, codes):
        own, other = (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        if two_blocks:
            i, j = np.nonzero(x[own] @ x[other].T >= threshold)
            i, j = own[i], other[j]
        else:
            i, j = np.nonzero(np.triu(x[own] @ x[own].T >= threshold, 1))
            i, j = own[i], own[j]
        if not len(i):
            return None
        root = np.arange(len(cls))
        while True:  # components of this comparison, by the smallest class
            least = np.minimum(root[i], root[j])
            new = root.copy()
            np.minimum.at(new, i, least)
            np.minimum.at(new, j, least)
            new = new[new]
            if (new == root).all():
                break
            root = new
        first = np.ones(len(i), bool)  # is this the first bucket that both share?
        for a in range(0, len(i), 4096):
            p, q = codes[i[a : a + 4096]], codes[j[a : a + 4096]]
            both = (p[:, :, None] == q[:, None, :]).any(2)
            first[a : a + 4096] = np.where(both, p, np.iinfo(np.int64).max).min(1) == code
        count = np.bincount(i[first], n[j[first]], len(cls)) + np.bincount(j[first], n[i[first]], len(cls))
        some = np.flatnonzero((count > 0) | (root != np.arange(len(cls))))
        return cls[some], count[some].astype(np.int64), cls[root[some]]

    def run(batches):
        held = None
        for batch in _with_end(batches):
            if batch is not None:
                table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
                held = None
                if not table.num_rows:
                    continue
                batch = table.to_batches()[0]
                key = np.stack([batch.column(k).to_numpy() for k in range(3)])
                begin = np.flatnonzero(np.append(True, (key[:, 1:] != key[:, :-1]).any(0)))
                held = batch.slice(int(begin[-1]))  # may go on
                stops = begin[1:]
            elif held is not None:
                batch, held = held, None
                begin, stops = np.array([0]), np.array([batch.num_rows])
            else:
                break
            code, b1, b2, side, cls, n = (batch.column(k).to_numpy() for k in range(6))
            units, codes = batch.column(6), batch.column(7)
            at, flat = units.offsets.to_numpy(), units.values.to_numpy()
            width = len(codes[0]) if batch.num_rows else 0
            codes = codes.flatten().to_numpy().reshape(-1, width)
            out = []
            for a, b in zip(begin.tolist(), stops.tolist()):
                if b - a > 1 and len(set(np.diff(at[a : b + 1]).tolist())) == 1:
                    if (found := one(code[a], b1[a] != b2[a], side[a:b], cls[a:b], n[a:b], flat[at[a] : at[b]].reshape(b - a, -1), codes[a:b])) is not None:
                        out.append(found)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["cls", "n_links", "root"])

    return rows.mapInArrow(run, "cls long, n_links long, root long")


def _with_end(batches):
    """The batches, then None."""
    yield from batches
    yield None


def near_duplicates(embeddings: DataFrame, threshold: float = 0.93, tables: int = 6, functions: int = 2, seed: int = 7) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row (vec_id, embedding, label)."""
    rows = materialise(
        embeddings.select(
            F.coalesce(F.col("vec_id").cast("long"), F.lit(NULL_ID)).alias("vec"),
            F.col("embedding").cast("array<double>").alias("embedding"),
            F.col("label"),
        ).select("vec", "embedding", "label", _valid().alias("valid"), F.xxhash64("label", "embedding").alias("cls"), F.xxhash64("embedding", F.lit(1), "label").alias("cls2")),
        "vectors",
    )
    valid = rows.where("valid")
    classes = materialise(_classes(valid, tables, functions, seed), "classes")
    places = classes.select("cls", F.explode("codes").alias("code")).distinct()
    shared = places.groupBy("code").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > 1)
    dealt = places.join(shared, "code").select("code", "cls", F.ceil(F.col("m") / BLOCK).cast("int").alias("k"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("cls", F.lit(3)), F.col("k")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    keys = ["code", F.least("own", "other").alias("b1"), F.greatest("own", "other").alias("b2"), (F.col("own") > F.col("other")).cast("int").alias("side")]
    blocks = dealt.select(*keys, "cls").join(classes, "cls").select("code", "b1", "b2", "side", "cls", "n", "unit", "codes")
    blocks = blocks.repartition("code", "b1", "b2").sortWithinPartitions("code", "b1", "b2")
    found = materialise(_compare(blocks, threshold), "found")
    counts = found.groupBy("cls").agg(F.sum("n_links").alias("n_links"))
    labels = components(found.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    sizes = classes.select("cls", "n").join(counts, "cls", "left").join(labels, F.col("cls") == F.col("node"), "left")
    sizes = sizes.select("cls", (F.col("n") - 1 + F.coalesce("n_links", F.lit(0))).alias("n_links"), F.coalesce("component", "cls").alias("comp"))
    linked = valid.select("vec", "cls").join(sizes, "cls")
    least = linked.groupBy("comp").agg(F.min("vec").alias("least"))
    alone = rows.where("not valid").select("vec", F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("least"))
    out = linked.join(least, "comp").select("vec", "n_links", "least").union(alone)
    return out.select(id_back("vec").alias("vec_id"), "n_links", id_back("least").alias("component_id"), (F.col("vec") == F.col("least")).alias("kept"))
