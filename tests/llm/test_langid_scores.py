"""Language scores against Python sets: the Bloom table may only add its (corrected) false positives."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

from lakeflux.llm import langid, queries
from tests.llm.cases import frame, with_clashes

SF = "/root/testdata/sf0.001"


def grams(text):
    """4 bytes in a row, letters in lower case, all else one separator, with less than two separators."""
    b = [c if 0x61 <= c <= 0x7A or c >= 0x80 else 32 for c in (text or "").lower().encode()]
    return [tuple(b[i : i + 4]) for i in range(len(b) - 3) if b[i : i + 4].count(32) < 2]


def learned(rows):
    """lang -> its n-grams, and the languages by how much text they have."""
    counts = defaultdict(Counter)
    for text, lang in rows:
        if lang is not None and text is not None:
            counts[lang].update(grams(text))
    total = {k: sum(c.values()) for k, c in counts.items()}
    best = Counter()
    for k, c in counts.items():
        for g, n in c.items():
            best[g] = max(best[g], n / total[k])
    sets = {k: {g for g, n in c.items() if n >= 3 and n / total[k] >= 0.1 * best[g]} for k, c in counts.items()}
    return sets, sorted(total, key=lambda k: (-total[k], k))


def plain_scores(text, sets, order):
    found = grams(text)
    return [sum(g in sets[k] for g in found) / max(1, len(found)) for k in order]


@pytest.fixture(scope="module")
def rows(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]


def test_scores_are_those_of_plain_sets(spark, rows):
    import zlib

    train = [(t, lang) for d, t, lang in rows if zlib.crc32(str(d).encode()) % 4 != 2]
    sets, order = learned(train)
    assert all(len(s) < 30_000 for s in sets.values())  # no set is cut at this size
    got = {r.doc_id: r for r in queries.op3_language_id(spark, SF).collect()}
    assert len(got) == len(rows)
    for d, text, _ in rows:
        want = plain_scores(text, sets, order)
        if got[d].lang_pred == "und":
            assert not any(c.isalpha() for c in text or "")
            continue
        assert abs(got[d].score - max(want)) < 0.03
        first, second = sorted(want, reverse=True)[:2]
        if first - second > 0.06:
            assert got[d].lang_pred == order[want.index(first)]


def test_equal_scores_and_repeated_rows(spark):
    """Texts that two languages score alike go to the one with more text; repeated rows get equal results."""
    shared, only = "abcd efgh ijkl " * 6, "mnop qrst " * 4
    data = [(i, shared + (only if i % 2 else ""), "long" if i % 2 else "short", "s", 1) for i in range(12)]
    filters = langid.fit(frame(spark, data))
    assert filters.langs == ["long", "short"]
    asked = [(50, "abcd efgh", None, "s", 1), (50, "abcd efgh", None, "s", 1), (51, "abcd efgh", None, "s", 1), (52, "zzzz yyyy", None, "s", 1)]
    out = langid.identify(with_clashes(spark, asked), filters).collect()
    assert [x.lang_pred for x in out if x.doc_id != 52] == ["long"] * 3 and len({x.score for x in out if x.doc_id != 52}) == 1
    assert [(x.lang_pred, x.score) for x in out if x.doc_id == 52] == [("long", 0.0)]
