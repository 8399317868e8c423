"""Clusters that meet in the n-gram Jaccard join, on sets made here."""

from __future__ import annotations

import random
from itertools import combinations

from pyspark.sql import functions as F

from lakeflux.llm import ngram_join


def need(size, percent):
    return (size * percent + 99) // 100


def tables(spark, sets, percent):
    """What is kept of the prefixes, and each set as a cluster of its own."""
    rows = []
    for gid, s in enumerate(sets):
        n = len(s)
        rows += [(h, gid, n) for h in sorted(s)[: n - need(n, percent) + int(ngram_join.shared_least(n, percent))]]
    shared = ngram_join._candidates(spark.createDataFrame(rows, "h long, gid long, size int"), percent)
    placed = spark.createDataFrame([(g, g, len(s), g, g) for g, s in enumerate(sets)], "gid long, rep long, size int, comp long, cluster long")
    clusters = placed.select("cluster", F.col("comp").alias("lo"), F.col("comp").alias("hi"), F.col("size").alias("least"), F.col("size").alias("most"))
    return ngram_join._rarest(shared, percent), placed, clusters


def test_clusters_that_share_too_little_for_their_sizes_are_no_pair(spark):
    r, percent = random.Random(11), 80
    hot = [set(r.sample(range(36), 32)) | {10_000 * (k + 1) + i for i in range(68)} for k in range(40)]  # alike in a third
    near = []
    for family in range(12):
        own = [10**6 * (family + 1) + i for i in range(r.randint(30, 120))]
        near += [set(own) - set(r.sample(own, r.randint(0, len(own) // 12))) | {-1000 * len(near) - i for i in range(1 + k)} for k in range(3)]
    sets = hot + near
    linked = {
        (a, b) for a, b in combinations(range(len(sets)), 2) if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    }
    assert len(linked) >= 12
    found = {(x.c1, x.c2) for x in ngram_join._cluster_pairs(*tables(spark, sets, percent), percent).collect()}
    assert linked <= found
    assert not [p for p in found if p[1] < len(hot)]


def test_a_pair_of_clusters_is_made_once(spark):
    r, percent = random.Random(12), 80
    sets = [set(r.sample(range(45), 40)) | {10_000 * (k + 1) + i for i in range(60)} for k in range(40)]
    runs = ngram_join._open_runs(*tables(spark, sets, percent))
    firsts = [(x.h, x.cluster) for x in runs.where("first").collect()]
    in_runs = sum(a[0] == b[0] for a, b in combinations(firsts, 2))
    met = [(x.c1, x.c2) for x in ngram_join._meetings(runs, percent).collect()]
    pairs = {tuple(sorted((a[1], b[1]))) for a, b in combinations(firsts, 2) if a[0] == b[0]}
    assert set(met) == pairs and in_runs > 2 * len(pairs)
    assert len(met) <= len(pairs) + sum(1 for h, _ in firsts if sum(h == g for g, _ in firsts) < ngram_join.LONG_RUN) * ngram_join.LONG_RUN
