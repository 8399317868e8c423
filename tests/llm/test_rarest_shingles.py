"""The shingles that groups of the n-gram Jaccard join leave out, on sets made here."""

from __future__ import annotations

import random
from itertools import combinations

from lakeflux.llm import ngram_join


def need(size, percent):
    return (size * percent + 99) // 100


def test_rarest_rows_keep_links_and_leave_hot_shingles_out(spark):
    r, percent = random.Random(4), 80
    sets = []
    for family in range(12):
        own = [1000 * (family + 1) + i for i in range(60)]
        for _ in range(3):
            s = set(own) | set(range(40))  # 40 shingles that all have
            s -= set(r.sample(sorted(s), r.randint(0, 8)))
            sets.append(sorted(s | {10**6 + 100 * len(sets) + i for i in range(r.randint(0, 4))}))
    # prefixes: hot shingles stand first in the order
    rows, prefix = [], []
    for gid, s in enumerate(sets):
        n = len(s)
        prefix.append(set(s[: n - need(n, percent) + int(ngram_join.shared_least(n, percent))]))
        rows += [(h, gid, n) for h in prefix[-1]]
    shared = ngram_join._candidates(spark.createDataFrame(rows, "h long, gid long, size int"), percent)
    kept = {}
    for x in ngram_join._rarest(shared, percent).collect():
        kept.setdefault(x.gid, set()).add(x.h)
    links = 0
    for a, b in combinations(range(len(sets)), 2):
        both = len(set(sets[a]) & set(sets[b]))
        if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            links += 1
            least = need(min(len(sets[a]), len(sets[b])), percent)
            least = int(ngram_join.shared_least(least, percent))
            assert len(kept[a] & kept[b]) >= (least + 1) // 2
    assert links >= 12
    run = lambda groups: max(sum(h in g for g in groups) for h in range(40))
    assert sum(map(len, kept.values())) < shared.count() and run(kept.values()) < run(prefix)
