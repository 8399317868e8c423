"""Jaccard self-join of documents on word n-grams, by grouped prefix join.

1. Documents with equal shingle sets are one class; classes of equal size and equal
   prefix are one group. The prefix is the first ``n - ceil(t * n) + l`` shingles in one
   order for all: two sets of similarity t share at least ``l`` shingles of both prefixes
   (see ``shared_least``). Shingles that a bounded sample finds frequent come last in the
   order, which changes no result.
2. Prefix shingles are sorted by range, so that a hot shingle is spread over tasks; a group
   with fewer than ``l`` shingles that others have, too, is linked with nothing. Each
   shingle's hub is its group whose shingles are the most widely shared; each group goes to
   the hub it shares most with, and every class is verified against its hub's: one pair a
   class, not all pairs.
3. The groups of one hub are a cluster. Of its prefix shingles each group leaves out the most
   widely shared ones, as many as it can without losing a link (see ``_rarest``), and shingles
   held by the same clusters are joined as one. Clusters meet at the rarest ones only, a pair
   once however many it shares. Pairs of clusters that are not one component yet, meet in size
   and share enough (see ``_pair_least``) are expanded to members, dealt into blocks, and
   verified by matrix products in the tasks, which emit spanning links only: no link between
   components is lost, and no group's pairs are ever rows.

Defined results: null and empty texts have an empty set and stand alone; with fewer words
than n the whole sequence is the one shingle; rows alike in id are in one component; a null
doc_id sorts before all others and gives a null component where it is the smallest; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.llm.components import components
from lakeflux.llm.work import attach, id_back, keyed, materialise, maybe_in, released, sorted_groups

#: The sample that finds frequent shingles, and how many of them the order knows; results do not depend on either.
ORDER_SAMPLE_DOCS = 4000
ORDER_SHINGLES = 100_000
#: Classes of a cluster that one task compares with as many of another.
BLOCK = 256
#: Runs of this many clusters or more are long; of a cluster's, so many are looked at so that a pair is made but once.
LONG_RUN = 8
LONG_RUNS = 64
#: Rows with whole shingle sets that pass between Spark and a task at once.
BATCH_ROWS = 1024


def shingle_sets(buf: np.ndarray, offs: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of the distinct shingles, ordered by document and hash."""
    low = T.lower_ascii(buf)
    starts, ends, doc = T.words(low, offs, T.NON_SPACE)
    h = T.span_hash(T.prefix_sums(low), starts, ends)
    count = np.bincount(doc, minlength=len(offs) - 1)
    codes, owners = [], []
    for k in range(1, n + 1):
        g, at = T.gram_hash(h, doc, k)
        if k < n:
            some = count[doc[at]] == k
            g, at = g[some], at[some]
        codes.append(g)
        owners.append(doc[at])
    g, d = np.concatenate(codes), np.concatenate(owners)
    order = np.lexsort((g, d))
    g, d = g[order], d[order]
    new = np.append(True, (g[1:] != g[:-1]) | (d[1:] != d[:-1])) if len(g) else np.zeros(0, bool)
    return g[new], d[new]


def _frequent(docs: DataFrame, n: int) -> np.ndarray:
    """Hashes of shingles that stand in 3 or more documents of a bounded sample, at most ORDER_SHINGLES."""
    rows = docs.count()
    part = docs.where(F.pmod(F.xxhash64("doc"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, ORDER_SAMPLE_DOCS / max(rows, 1))))

    def run(batches):
        for batch in batches:
            for _, _, buf, offs in T.blocks(batch.column(0)):
                u, c = np.unique(shingle_sets(buf, offs, n)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(T.signed(u)), pa.array(c)], ["h", "n"])

    counts = part.select("text").mapInArrow(released(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= 3)
    top = counts.orderBy(F.desc("n"), "h").limit(ORDER_SHINGLES).select("h").toArrow()
    return np.sort(top.column(0).to_numpy().view(np.uint64))


def _need(size, percent: int):
    """Shingles that a set must share with any set it is linked to."""
    return (size * percent + 99) // 100


def shared_least(size, percent: int):
    """l, the prefix shingles that two linked sets share, where the smaller has this size: half as many again as a plain prefix has."""
    need = _need(size, percent)
    return np.minimum(3 * (size - need + 1) // 2, need)


_SETS = "doc long, tkey long, size int, code long, prefix array<long>"


def _prefixes(docs: DataFrame, n: int, percent: int, frequent: np.ndarray) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(frequent)  # at most ORDER_SHINGLES codes

    def run(batches):
        late = shared.value
        for batch in batches:
            for lo, hi, buf, offs in T.blocks(batch.column(2)):
                g, d = shingle_sets(buf, offs, n)
                m = hi - lo
                size = np.bincount(d, minlength=m)
                at = np.minimum(np.searchsorted(late, g), max(len(late) - 1, 0))
                last = late[at] == g if len(late) else np.zeros(len(g), bool)
                order = np.lexsort((g, last, d))
                cut = np.append(0, np.cumsum(size))
                place = np.arange(len(g)) - cut[d]
                first = place < (size - _need(size, percent) + shared_least(size, percent))[d]
                code = np.zeros(m, np.uint64)
                np.add.at(code, d, T.mix(g ^ np.uint64(0xA0761D6478BD642F)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, m),
                        batch.column(1).slice(lo, m),
                        pa.array(size, pa.int32()),
                        pa.array(T.signed(code)),
                        T.list_array(np.append(0, np.cumsum(np.bincount(d[first], minlength=m))), T.signed(g[order][first]), pa.int64()),
                    ],
                    ["doc", "tkey", "size", "code", "prefix"],
                )

    return docs.mapInArrow(released(run), _SETS)


def _runs(rows: DataFrame) -> DataFrame:
    """Rows (h, gid, size), sorted by h in each task, whose h has another row.

    A run that touches either end of its task may go on in another one, and so is kept.
    """

    def run(batches):
        held, start = None, True  # the run that is not over yet; whether it is the task's first
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks()
            rows = table.to_batches()[0]
            h = rows.column(0).to_numpy()
            begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            size = np.diff(np.append(begin, len(h)))
            keep = size > 1
            keep[0] |= start
            if len(begin) == 1 and size[0] > 1:  # long enough to be passed on as it comes; its last row stays
                yield rows.slice(0, len(h) - 1)
                held, start = rows.slice(len(h) - 1), True
                continue
            over = np.repeat(keep[:-1], size[:-1])
            if over.any():
                yield rows.slice(0, int(begin[-1])).filter(pa.array(over))
            held = rows.slice(int(begin[-1]))
            start = start and len(begin) == 1
        if held is not None:
            yield held

    return rows.mapInArrow(released(run), "h long, gid long, size int")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes whose sets are similar enough; sets: (rep, shingles)."""
    rows = pairs.join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y")), "b"
    )

    def run(batches):
        for batch in batches:
            xs, ys = batch.column(2), batch.column(3)
            good = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = xs[i].values.to_numpy(), ys[i].values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(good)) for k in (0, 1)], ["a", "b"])

    return rows.select("a", "b", "x", "y").mapInArrow(released(run), "a long, b long")


def overlaps(xs: list[np.ndarray], ys: list[np.ndarray], width: int = 4096) -> np.ndarray:
    """Sizes of the intersections of every x with every y, by products of their incidence matrices, so many shingles at a time."""
    x, y = np.concatenate(xs), np.concatenate(ys)
    common = np.intersect1d(x, y)
    out = np.zeros((len(xs), len(ys)), np.int64)  # whole numbers, however long the texts
    places = []
    for sets, flat in ((xs, x), (ys, y)):
        own = np.repeat(np.arange(len(sets)), [len(v) for v in sets])
        at = np.searchsorted(common, flat)
        held = common[np.minimum(at, max(len(common) - 1, 0))] == flat if len(common) else np.zeros(len(flat), bool)
        order = np.argsort(at[held], kind="stable")
        places.append((own[held][order], at[held][order]))
    for lo in range(0, len(common), width):
        parts = []
        for sets, (own, at) in zip((xs, ys), places):
            a, b = np.searchsorted(at, [lo, lo + width])
            m = np.zeros((len(sets), width), np.float32)
            m[own[a:b], at[a:b] - lo] = 1
            parts.append(m)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def _between_clusters(pairs: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Spanning links (a, b) between components that have similar classes in pairs (c1, c2) of clusters.

    members: (cluster, rep, comp). Clusters are dealt into blocks of about ``BLOCK`` classes.
    """
    blocks = members.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"))
    dealt = members.join(blocks, "cluster").select("cluster", "rep", "comp", "k", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("k")).cast("int").alias("own"))
    counts = blocks.select(F.col("cluster").alias("other"), F.col("k").alias("other_k"))
    sides = []
    for side, (mine, theirs) in enumerate((("c1", "c2"), ("c2", "c1"))):
        rows = pairs.join(dealt, F.col(mine) == F.col("cluster")).join(counts, F.col(theirs) == F.col("other"))
        rows = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("other_k") - 1)))
        b1, b2 = ("own", "block") if side == 0 else ("block", "own")
        sides.append(rows.select("c1", "c2", F.col(b1).alias("b1"), F.col(b2).alias("b2"), F.lit(side).alias("side"), "rep", "comp"))
    keys = ["c1", "c2", "b1", "b2"]
    filled = sides[0].union(sides[1]).join(sets, "rep").select(*keys, "side", "rep", "comp", "shingles")
    filled = filled.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches):
        for group in sorted_groups(batches, len(keys)):
            side, rep, comp = (group.column(k).to_numpy() for k in (4, 5, 6))
            lists = group.column(7)
            shingles = [lists[i].values.to_numpy() for i in range(group.num_rows)]
            first, second = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(first) or not len(second):
                continue
            size = np.array([len(x) for x in shingles])
            both = overlaps([shingles[i] for i in first], [shingles[i] for i in second])
            near = 100 * both >= percent * (size[first][:, None] + size[second][None, :] - both)
            i, j = np.nonzero(near & (comp[first][:, None] != comp[second][None, :]))
            if len(i):
                names, at = np.unique(np.concatenate([comp[first[i]], comp[second[j]]]), return_inverse=True)
                a, b = at[: len(i)], at[len(i) :]
                root = np.arange(len(names))
                while True:  # each component's smallest one in reach, here
                    least, new = np.minimum(root[a], root[b]), root.copy()
                    np.minimum.at(new, a, least)
                    np.minimum.at(new, b, least)
                    new = new[new]
                    if (new == root).all():
                        break
                    root = new
                some = np.flatnonzero(root != np.arange(len(names)))
                yield pa.RecordBatch.from_arrays([pa.array(names[some]), pa.array(names[root[some]])], ["a", "b"])

    return filled.mapInArrow(released(run), "a long, b long")


def _sets_of(docs: DataFrame, reps: DataFrame, n: int) -> DataFrame:
    """(rep, shingles) of the documents that stand for classes reps(rep, doc, tkey)."""
    few = maybe_in(docs, "doc", reps, "doc").join(reps, ["doc", "tkey"]).dropDuplicates(["rep"])

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in T.blocks(batch.column(1)):
                g, d = shingle_sets(buf, offs, n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), T.list_array(T.slices(g, d, hi - lo), T.signed(g), pa.int64())],
                    ["rep", "shingles"],
                )

    return few.select("rep", "text").mapInArrow(released(run), "rep long, shingles array<long>")


def jaccard_components(documents: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc, tkey, size, component, comp) of every row: its number of distinct shingles, the smallest
    doc it reaches over pairs with 100 * intersection >= percent * union, and the component itself:
    several may have the same smallest doc. Rows without shingles have a null comp."""
    docs = keyed(documents)
    all_sets = materialise(_prefixes(docs, n, percent, _frequent(docs, n)), "prefixes", BATCH_ROWS)
    filled = all_sets.where("size > 0")
    # prefixes are shuffled once, and those of group leaders only go on
    classes = filled.select("doc", "tkey", "size", "code", F.xxhash64("prefix").alias("front")).groupBy("size", "code").agg(
        F.min(F.struct("doc", "tkey")).alias("who"), F.first("front").alias("front")
    ).select("size", "code", F.xxhash64("size", "code").alias("rep"), "who", "front")
    groups = classes.groupBy("size", "front").agg(F.min("rep").alias("gid"))
    grouped = materialise(classes.join(groups, ["size", "front"]), "classes")
    leaders = grouped.where(F.col("rep") == F.col("gid")).select("who.doc", "who.tkey", "gid", "size")
    one = filled.groupBy("doc", "tkey").agg(F.first("prefix").alias("prefix"))
    rows = one.join(leaders, ["doc", "tkey"]).select(F.explode("prefix").alias("h"), "gid", "size")
    shared = materialise(_runs(rows.repartitionByRange("h", "gid").sortWithinPartitions("h", "gid")), "shared")
    members = grouped.select("gid", "rep", "size", "who")

    near = lambda a, b: (F.col(a) * 100 >= F.col(b) * percent) & (F.col(b) * 100 >= F.col(a) * percent)
    shared = materialise(_candidates(shared, percent), "shared")
    # hubs: of each run, the group whose shingles are the most widely shared
    spread = shared.join(shared.groupBy("h").agg(F.count(F.lit(1)).alias("k")), "h").groupBy("gid", "size").agg(F.avg("k").alias("reach"))
    hubs = shared.join(spread.select("gid", "reach"), "gid").groupBy("h").agg(F.max_by(F.struct("gid", "size"), F.struct("reach", "gid")).alias("hub"))
    # each group's: the one it shares most prefix shingles with
    of = shared.join(hubs, "h").select("gid", "size", F.col("hub.gid").alias("hub"), F.col("hub.size").alias("hub_size"))
    of = of.where((F.col("gid") != F.col("hub")) & near("size", "hub_size")).groupBy("gid", "hub").agg(F.count(F.lit(1)).alias("n"))
    best = materialise(of.groupBy("gid").agg(F.max_by("hub", F.struct("n", "hub")).alias("hub")), "hubs")
    stars = members.join(best, "gid").select(F.col("rep").alias("a"), F.col("hub").alias("b")).union(
        members.where(F.col("rep") != F.col("gid")).select(F.col("rep").alias("a"), F.col("gid").alias("b"))
    )
    # every class that is in a pair at all, now or later
    in_pairs = shared.select("gid").union(members.where(F.col("rep") != F.col("gid")).select("gid")).distinct()
    candidates = materialise(members.join(in_pairs, "gid"), "candidates")
    sets = materialise(_sets_of(docs, candidates.select("rep", F.col("who.doc").alias("doc"), F.col("who.tkey").alias("tkey")), n), "sets", BATCH_ROWS)
    links = materialise(_verified(stars, sets, percent), "links", BATCH_ROWS)
    labels = components(links)
    placed = materialise(
        candidates.join(labels, candidates["rep"] == labels["node"], "left")
        .select("gid", "rep", "size", F.coalesce("component", "rep").alias("comp"))
        .join(best, "gid", "left")
        .select("gid", "rep", "size", "comp", F.coalesce("hub", "gid").alias("cluster")),
        "placed",
    )
    clusters = materialise(
        placed.groupBy("cluster").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("size").alias("least"), F.max("size").alias("most")
        ),
        "clusters",
    )
    across = _cluster_pairs(_rarest(shared, percent), placed, clusters, percent)
    inside = clusters.where(F.col("lo") != F.col("hi")).select(F.col("cluster").alias("c1"), F.col("cluster").alias("c2"))
    more = materialise(_between_clusters(across.union(inside), placed.select("cluster", "rep", "comp"), sets, percent), "links", BATCH_ROWS)
    merged = components(more).select(F.col("node").alias("comp"), F.col("component").alias("whole"))
    by_class = classes_with(grouped, labels).join(merged, "comp", "left").select("size", "code", F.coalesce("whole", "comp").alias("comp"))
    out = filled.join(by_class, ["size", "code"]).select("doc", "tkey", "size", "comp")
    least = out.groupBy("comp").agg(F.min("doc").alias("component"))
    linked = out.join(least, "comp").select("doc", "tkey", "size", "component", "comp")
    return linked.union(all_sets.where("size = 0").select("doc", "tkey", "size", F.col("doc").alias("component"), F.lit(None).cast("long").alias("comp")))


def _least_shared(size: Column, percent: int) -> Column:
    """shared_least of a column."""
    need = F.floor((size * percent + 99) / 100)
    return F.least(F.floor((size - need + 1) * 3 / 2), need)


def _kept_least(size: Column, percent: int) -> Column:
    """Shingles that two linked groups share among those that ``_rarest`` keeps, where the smaller has this size: half of
    what the smallest set that may be linked to it must share."""
    return F.ceil(_least_shared(F.floor((size * percent + 99) / 100), percent) / 2)


def _rarest(shared: DataFrame, percent: int) -> DataFrame:
    """Rows (h, gid, first) of each group without its most widely shared shingles.

    Linked groups have ``l`` rows in common; in one order for all, rarest first, each may leave out the last ``l - j``
    of its own and they still have ``j`` in common. first: those for which ``j`` is 1.
    """
    runs = shared.groupBy("h").agg(F.count(F.lit(1)).alias("k"))
    own = Window.partitionBy("gid")  # a document's prefix
    least = _least_shared(F.floor((F.col("size") * percent + 99) / 100), percent)
    ranked = shared.join(runs, "h").select(
        "h", "gid", "size", F.row_number().over(own.orderBy("k", "h")).alias("place"), F.count(F.lit(1)).over(own).alias("n")
    )
    first = F.col("place") <= F.col("n") - least + 1
    return ranked.where(F.col("place") <= F.col("n") - least + _kept_least(F.col("size"), percent)).select("h", "gid", first.alias("first"))


def _open_runs(kept: DataFrame, placed: DataFrame, clusters: DataFrame) -> DataFrame:
    """Rows (h, m, k, cluster, first, lo, hi, least, most) of clusters whose shingle h is not all in one component.

    Shingles that the same clusters hold are one row with their number m: a passage is joined once, not once a shingle.
    k: clusters that have it among their first ones.
    """
    own = kept.join(placed.select("gid", "cluster").distinct(), "gid")
    at = own.groupBy("h", "cluster").agg(F.max("first").alias("first")).join(clusters, "cluster")
    held = at.groupBy("h").agg(
        F.min("lo").alias("a"),
        F.max("hi").alias("b"),
        F.sum(F.col("first").cast("int")).alias("k"),
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("cluster", "first", F.lit(1))).alias("x"),
        F.sum(F.xxhash64("cluster", "first", F.lit(2)).cast("decimal(38,0)")).alias("s"),
    )
    alike = held.where(F.col("a") != F.col("b")).groupBy("k", "n", "x", "s").agg(F.min("h").alias("h"), F.count(F.lit(1)).alias("m"))
    return at.join(alike.select("h", "m", "k"), "h").select("h", "m", "k", "cluster", "first", "lo", "hi", "least", "most")


def _meetings(runs: DataFrame, percent: int) -> DataFrame:
    """Pairs (c1, c2, least, most, least2, most2) of clusters that have one of their first shingles in common, meet in size and
    are not all one component.

    A pair is made at the longest run that both are in, and at a later one only where it is missing from ``LONG_RUNS``.
    """
    place = lambda k, h: F.struct((-k).alias("k"), h.alias("h"))  # noqa: E731  the longest run first
    firsts = runs.where("first")
    long = firsts.where(F.col("k") >= LONG_RUN).groupBy("cluster").agg(
        F.slice(F.sort_array(F.collect_list(place(F.col("k"), F.col("h")))), 1, LONG_RUNS).alias("long")
    )
    earlier = F.transform(F.filter("long", lambda x: x < place(F.col("k"), F.col("h"))), lambda x: x["h"])
    left = firsts.join(long, "cluster", "left").select(
        "h", F.col("cluster").alias("c1"), "lo", "hi", "least", "most", F.coalesce(earlier, F.array().cast("array<long>")).alias("before")
    )
    right = left.select("h", F.col("c1").alias("c2"), *[F.col(c).alias(f"{c}2") for c in ("lo", "hi", "least", "most", "before")])
    apart = (F.col("lo") != F.col("hi")) | (F.col("lo2") != F.col("hi2")) | (F.col("lo") != F.col("lo2"))
    sizes_meet = (F.col("most") * 100 >= F.col("least2") * percent) & (F.col("most2") * 100 >= F.col("least") * percent)
    once = ~F.arrays_overlap("before", "before2")
    met = left.join(right, "h").where((F.col("c1") < F.col("c2")) & apart & sizes_meet & once)
    return met.select("c1", "c2", "least", "most", "least2", "most2")


def _pair_least(percent: int) -> Column:
    """Shingles, times 200, that two linked groups share among those that ``_rarest`` keeps, where their sizes a and b are at
    least least and least2 and at most most and most2.

    They have o = percent * (a + b) / (100 + percent) shingles or more in common. A prefix leaves out need - l shingles of its
    set and ``_rarest`` some more, both from the end of an order for all: so in either step the two miss no more than the
    larger of the two numbers.
    """
    up = lambda c: F.floor((F.col(c) * percent + 99) / 100)
    down = lambda c: F.floor(F.col(c) * 100 / percent)
    small = F.greatest(F.col("least"), up("least2")) + F.greatest(F.col("least2"), up("least"))
    large = F.greatest(F.least(F.col("most"), down("most2")), F.least(F.col("most2"), down("most")))
    both = F.ceil(small * percent / (100 + percent))
    left_out = _least_shared(F.floor((large * percent + 99) / 100), percent) - _kept_least(large, percent)
    # l - need is at least (1.5 * (100 - percent) - percent) / 100 * size - 1.5, or 0
    return both * 200 + large * min(0, 3 * (100 - percent) - 2 * percent) - 300 - left_out * 200


def _cluster_pairs(kept: DataFrame, placed: DataFrame, clusters: DataFrame, percent: int) -> DataFrame:
    """(c1, c2) of clusters that share enough shingles, meet in size and are not all one component."""
    runs = materialise(_open_runs(kept, placed, clusters), "runs")
    met = materialise(_meetings(runs, percent).distinct(), "meetings")
    least = F.greatest(_pair_least(percent), _kept_least(F.least("least", "least2"), percent) * 200)
    lists = runs.groupBy("cluster").agg(F.collect_list(F.struct("h", "m")).alias("held"))
    rows = met.select("c1", "c2", least.cast("long").alias("least"))
    for k in (1, 2):
        side = lists.select(F.col("cluster").alias(f"c{k}"), F.col("held.h").alias(f"h{k}"), F.col("held.m").alias(f"m{k}"))
        rows = rows.join(side, f"c{k}")

    def run(batches):
        for batch in batches:
            h1, m1, h2 = (batch.column(k) for k in (3, 4, 5))
            n = np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                held = np.isin(h1[i].values.to_numpy(), h2[i].values.to_numpy(), assume_unique=True)
                n[i] = m1[i].values.to_numpy()[held].sum()
            good = pa.array(n * 200 >= batch.column(2).to_numpy())
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(good) for k in (0, 1)], ["c1", "c2"])

    found = rows.select("c1", "c2", "least", "h1", "m1", "h2").mapInArrow(released(run), "c1 long, c2 long")
    return materialise(found, "across", BATCH_ROWS)


def _candidates(shared: DataFrame, percent: int) -> DataFrame:
    """Rows of groups that have enough shingles in common with others: as many as with the
    smallest set that they may be linked to. The second time only with each other."""
    enough = F.count(F.lit(1)) >= _least_shared(F.floor((F.first("size") * percent + 99) / 100), percent)
    for _ in range(2):
        keep = shared.groupBy("gid").agg(enough.alias("keep")).where("keep").select("gid")
        shared = shared.join(keep, "gid")
        several = shared.groupBy("h").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h")
        shared = shared.join(several, "h")
    return shared.select("h", "gid", "size")


def classes_with(grouped: DataFrame, labels: DataFrame) -> DataFrame:
    """(size, code, comp) of every class; a class without links is its own component."""
    return grouped.select("size", "code", "rep").join(labels, grouped["rep"] == labels["node"], "left").select("size", "code", F.coalesce("component", "rep").alias("comp"))


def similar_documents(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    out = jaccard_components(docs, n, percent)
    return out.select(id_back("doc").alias("doc_id"), F.col("size").cast("long").alias("n_shingles"), id_back("component").alias("component_id"))


def keep_first_of_component(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """docs with one document of each component: that of the smallest doc_id (rows alike in id and text all stay)."""
    found = jaccard_components(docs, n, percent).where("size > 0")
    first = found.groupBy("comp").agg(F.min(F.struct("doc", "tkey")).alias("f"))
    extra = found.join(first, "comp").where((F.col("doc") != F.col("f.doc")) | (F.col("tkey") != F.col("f.tkey"))).select("doc", "tkey").distinct()
    return attach(docs, extra, "left_anti").drop("__llm_key_doc", "__llm_key_tkey")
