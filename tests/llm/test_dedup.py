"""Suffix-array, line, substring and n-gram dedup against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from lakeflux.llm import linededup, ngram_join, substring_dedup, suffix_dedup
from tests.llm.cases import corpus, frame, odd_rows, prose, rows_of, union_find, with_clashes

NULL = -(1 << 63)


def brute_suffix(rows, length=100):
    """By definition: a byte goes if a string of that length over it also starts earlier."""
    texts = sorted({(NULL if d is None else d, t or "") for d, t, *_ in rows}, key=lambda x: (x[0], ""))
    first, out = {}, {}
    for d, t in texts:
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            s = b[i : i + length]
            if s in first:
                gone[i : i + length] = b"\1" * length
            else:
                first[s] = (d, i)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed", range(4))
def test_suffix_dedup_is_the_definition(spark, seed):
    rows = corpus(seed, 60)
    want = brute_suffix(rows)
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(frame(spark, rows)).drop("starts", "ends").collect()}
    assert got == want
    assert sum(v[1] for v in want.values()) > 1000


def test_suffix_dedup_periodic_and_long_texts(spark):
    rows = [(0, "ab" * 400, None, None, 0), (1, "b" + "ab" * 99, None, None, 0), (2, "x" * 99, None, None, 0), (3, "x" * 250, None, None, 0)]
    rows += [(4, prose_of(3, 9000), None, None, 0), (5, prose_of(3, 9000)[5000:9000], None, None, 0)]
    got = {r[0]: tuple(r)[1:] for r in suffix_dedup.suffix_dedup(frame(spark, rows)).drop("starts", "ends").collect()}
    assert got == brute_suffix(rows)


def prose_of(seed, words):
    import random

    return prose(random.Random(seed), words)


def test_suffix_dedup_odd_rows(spark):
    rows = [r for r in odd_rows() if r[0] != 104]
    got = suffix_dedup.suffix_dedup(frame(spark, rows)).drop("starts", "ends").collect()
    # a null id stands for two texts here: the empty one keeps nothing, the other is the first of all
    want = brute_suffix([r for r in rows if r[0] is not None or r[1]])
    assert len(got) == len(rows)
    for r in got:
        if r[0] is None and r[1] == 0:
            assert tuple(r)[1:4] == (0, 0, 0)
        else:
            assert tuple(r)[1:] == want[NULL if r[0] is None else r[0]]
    clashing = suffix_dedup.suffix_dedup(with_clashes(spark, odd_rows()))
    assert clashing.count() == len(odd_rows())
    assert suffix_dedup.suffix_dedup(frame(spark, [])).count() == 0


def brute_runs(rows, window, min_words):
    docs = {}
    for d, t, *_ in rows:
        docs[d] = [(m.start(), m.group().strip(), len(m.group().split())) for m in re.finditer(r"[^\n]+", t or "") if m.group().strip()]
    return docs


def _text_without(text, spans):
    b, out, at = text.encode(), b"", 0
    for a, z in spans:
        out += b[at:a]
        at = z
    return (out + b[at:]).decode()


def test_line_dedup_finds_runs_and_keeps_first(spark):
    r1, r2, r3 = prose_of(1, 120), prose_of(2, 120), prose_of(3, 48)
    rows = [
        (1, f"{r1}\n{r3}", "en", "s", 1),
        (2, f"{r2}\n{r3}\ntail", "en", "s", 1),
        (3, r1, "en", "s", 1),
        (4, "short line here", "en", "s", 1),
        (5, "short line here\nand more", "en", "s", 1),
    ]
    df = frame(spark, rows)
    spans = defaultdict(list)
    for d, a, b in rows_of(linededup.deleted_spans(df)):
        spans[d].append((a, b))
    b2 = rows[1][1].encode()
    assert dict(spans) == {2: [(b2.index(r3.encode()), b2.index(b"tail"))], 3: [(0, len(r1.encode()))]}
    kept = {r.doc_id: r.text for r in linededup.dedup_lines(df).collect()}
    assert kept == {d: _text_without(t, spans.get(d, [])) for d, t, *_ in rows}
    assert sorted(r.doc_id for r in linededup.dedup_lines(df, drop_emptied=True).collect()) == [1, 2, 4, 5]


@pytest.mark.parametrize("seed", range(3))
def test_line_runs_against_brute_force(spark, seed):
    """Every fingerprint's first place, extended both ways, by plain loops."""
    rows = corpus(seed, 60)
    window, min_words = 2, 30
    docs = brute_runs(rows, window, min_words)
    import numpy as np

    from lakeflux.llm import textblocks as T

    def code(line):
        b = np.frombuffer(line.encode(), np.uint8)
        return int(T.span_hash(T.prefix_sums(b), np.array([0]), np.array([len(b)]))[0])

    hashes = {d: [code(x[1]) for x in lines] for d, lines in docs.items()}
    picks = {}
    for d, h in hashes.items():
        own = {i for i, x in enumerate(docs[d]) if x[2] >= min_words}
        if len(h) < window:
            own |= set(range(len(h)))
        for i in range(len(h) - window + 1):
            own.add(max(range(i, i + window), key=lambda j: (-h[j], j)))
        picks[d] = own
    first = {}
    for d in sorted(picks):
        for i in sorted(picks[d]):
            first.setdefault(hashes[d][i], (d, i))
    gone = defaultdict(set)
    for d in picks:
        for i in picks[d]:
            sd, si = first[hashes[d][i]]
            if (sd, si) == (d, i):
                continue
            lo = hi = 0
            while i + lo - 1 >= 0 and si + lo - 1 >= 0 and hashes[d][i + lo - 1] == hashes[sd][si + lo - 1]:
                lo -= 1
            while i + hi + 1 < len(hashes[d]) and si + hi + 1 < len(hashes[sd]) and hashes[d][i + hi + 1] == hashes[sd][si + hi + 1]:
                hi += 1
            if sum(docs[d][k][2] for k in range(i + lo, i + hi + 1)) >= min_words:
                gone[d] |= set(range(i + lo, i + hi + 1))
    got = defaultdict(set)
    for r in linededup.repeated_runs(frame(spark, rows), window, min_words).collect():
        got[r.doc] |= set(range(r.first_line, r.first_line + r.n_lines))
    assert dict(got) == {d: g for d, g in gone.items() if g}
    assert got


def brute_earlier_lines(rows, min_words):
    """By definition: a line goes if a run of min_words words over it stands at any earlier place, too."""
    docs = brute_runs(rows, 2, min_words)
    flat = [(d, i, x[1], x[2]) for d in sorted(docs) for i, x in enumerate(docs[d])]
    gone = defaultdict(set)
    for a in range(len(flat)):
        for b in range(a):  # flat[b] stands before flat[a]; take equal runs from their first line only
            starts = lambda k: k == 0 or flat[k - 1][0] != flat[k][0]
            if flat[a][2] != flat[b][2] or not (starts(a) or starts(b) or flat[a - 1][2] != flat[b - 1][2]):
                continue
            n = words = 0
            while a + n < len(flat) and flat[a + n][0] == flat[a][0] and flat[b + n][0] == flat[b][0] and flat[a + n][2] == flat[b + n][2]:
                words += flat[a + n][3]
                n += 1
            if words >= min_words:
                gone[flat[a][0]] |= set(range(flat[a][1], flat[a][1] + n))
    return dict(gone)


def _found_lines(spark, rows):
    got = defaultdict(set)
    for r in linededup.repeated_runs(frame(spark, rows), whole=True).collect():
        got[r.doc] |= set(range(r.first_line, r.first_line + r.n_lines))
    return dict(got)


def test_line_runs_of_frequent_lines_against_all_earlier_places(spark):
    """Lines under 30 words that stand first in other contexts."""
    import random

    r = random.Random(17)
    lines = [f"line{k} " + prose(r, n, 99) for k, n in enumerate([4, 9, 13, 15, 15, 15, 17, 20, 28, 32])]
    rows = [(i, "\n".join(r.choice(lines) for _ in range(r.randint(1, 9))), None, None, 0) for i in range(70)]
    want = brute_earlier_lines(rows, 30)
    assert _found_lines(spark, rows) == want and len(want) > 20
    rows = corpus(2, 60)
    assert _found_lines(spark, rows) == brute_earlier_lines(rows, 30)
    # whichever of two lines of 16 words has the smaller hash, it stands first next to another line
    for first, other in ((3, 4), (4, 3)):
        x, y, z = (f"{k} " + prose_of(40 + k, 15).replace("\n", " ") for k in (first, other, 5))
        rows = [(1, f"{x}\n{z}", None, None, 0), (2, f"{x}\n{y}", None, None, 0), (3, f"{x}\n{y}", None, None, 0)]
        assert _found_lines(spark, rows) == {3: {0, 1}}
        assert [r.doc_id for r in linededup.deleted_spans(frame(spark, rows)).collect()] == [3]


def test_winnowing_guarantee():
    import numpy as np

    from lakeflux.llm.linededup import winnow

    rng = np.random.default_rng(0)
    for w in (1, 2, 3, 5):
        h = rng.integers(0, 6, 200).astype(np.uint64)
        doc = np.sort(rng.integers(0, 6, 200))
        picked = winnow(h, doc, w)
        for d in range(6):
            at = np.flatnonzero(doc == d)
            for i in range(len(at) - w + 1):
                assert picked[at[i : i + w]].any()


def test_line_dedup_odd_rows(spark):
    rows = odd_rows()
    df = with_clashes(spark, rows)
    out = linededup.dedup_lines(df)
    assert out.columns == df.columns and out.count() == len(rows)
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert (None, None) in kept and (101, "") in kept and (103, "") in kept
    assert linededup.dedup_lines(frame(spark, [])).count() == 0


@pytest.mark.parametrize("unit", ["line", "paragraph"])
def test_substring_dedup_against_brute_force(spark, unit):
    sep = {"line": "\n", "paragraph": "\n\n"}[unit]
    rows = [(d, (t or "").replace("\n", "\n\n") if unit == "paragraph" else t, *x) for d, t, *x in corpus(3, 60)]
    first, want = {}, []
    for d, t, *_ in rows:
        at, parts = 0, t.split(sep)
        for k, p in enumerate(parts):
            size = len(p.encode()) + (len(sep) if k + 1 < len(parts) else 0)
            plain = " ".join(p.split()).lower()
            if len(plain.split()) >= 8:
                if plain in first:
                    want.append((d, unit, k, at, size, *first[plain]))
                else:
                    first[plain] = (d, k)
            at += size
    got = rows_of(substring_dedup.removed_units(frame(spark, rows), unit, 8))
    assert got == sorted(want, key=repr) and got
    kept = {r.doc_id: r.text for r in substring_dedup.dedup_units(frame(spark, rows), unit, 8).collect()}
    spans = defaultdict(list)
    for d, _, _, a, n, *_ in sorted(want):
        spans[d].append((a, a + n))
    assert kept == {d: _text_without(t, spans[d]) for d, t, *_ in rows}


def plain_pieces(text, least, reach):
    """By the definition, word by word."""
    words = [(m.start(), m.group().decode().lower()) for m in re.finditer(rb"[^ \t-\r]+", text.encode())]
    p = [hashlib.md5(f"{a[1]} {b[1]}".encode()).hexdigest()[:16] for a, b in zip(words, words[1:])]
    cut = [i for i in range(1, len(p)) if all(p[i] < x for x in p[max(0, i - reach) : i]) and all(p[i] <= x for x in p[i + 1 : i + reach + 1])]
    edges = [0, *cut, len(words)]
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        if b - a >= least:
            yield k, words[a][0], words[b][0] if b < len(words) else len(text.encode()), " ".join(w for _, w in words[a:b])


def test_substring_dedup_pieces_against_brute_force(spark):
    rows = corpus(6, 60) + [(900, " Lead  word\tand " + prose_of(2, 90) + " \n", None, None, 0), (901, "x", None, None, 0), (902, "same " * 400, None, None, 0), (903, prose_of(2, 60000), None, None, 0)]
    first, want = {}, []
    for d, t, *_ in rows:
        for k, a, b, plain in plain_pieces(t, 12, 8):
            if plain in first:
                want.append((d, "piece", k, a, b - a, *first[plain]))
            else:
                first[plain] = (d, k)
    got = substring_dedup.removed_units(frame(spark, rows), "line", 10**9, 12)
    assert rows_of(got) == sorted(want, key=repr) and len(want) > 20


def test_substring_dedup_finds_passages_wherever_they_stand(spark):
    """Passages of 60 words inside lines, in other lines than before, are found; documents without any are left alone."""
    passage = prose_of(70, 60).replace("\n", " ")
    words = passage.split()
    rows = [(i, f"{prose_of(100 + i, 30)} tail{i} {passage if i % 2 else ''} head{i} {prose_of(200 + i, 30)}", None, None, 0) for i in range(60)]
    rows += [(100 + i, f"{prose_of(300 + i, 20)} x{i} {chr(10).join(' '.join(words[j : j + 4 + i]) for j in range(0, len(words), 4 + i))} y{i}", None, None, 0) for i in range(10)]
    found = {r.doc_id for r in substring_dedup.removed_units(frame(spark, rows), "line", 20, 12).collect()}
    holders = {i for i in range(3, 60, 2)} | {100 + i for i in range(10)}
    assert len(found & holders) >= 0.95 * len(holders) and not found - holders


def test_substring_dedup_odd_rows(spark):
    rows = odd_rows()
    df = with_clashes(spark, rows)
    out = substring_dedup.dedup_units(df, "line", 8)
    assert out.columns == df.columns and out.count() == len(rows)
    assert substring_dedup.removed_units(frame(spark, [])).count() == 0
    assert substring_dedup.dedup_units(df, "line", 8, piece_words=8).count() == len(rows)
    assert substring_dedup.removed_units(frame(spark, []), piece_words=8).count() == 0


def _shingles(text, n):
    w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode()))
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1))


def brute_components(rows, n, percent):
    sets = {d: _shingles(t, n) for d, t, *_ in rows}
    ids = sorted(sets)
    links = [
        (a, b)
        for i, a in enumerate(ids)
        for b in ids[i + 1 :]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    root = union_find(ids, links)
    return sorted((d, len(sets[d]), root[d]) for d in ids)


@pytest.mark.parametrize("n,percent", [(3, 90), (5, 80), (2, 50)])
def test_jaccard_components_against_brute_force(spark, n, percent):
    rows = corpus(11, 90)
    # a chain of near copies, each near the next one only
    r = prose_of(8, 150).split(" ")
    for k in range(12):
        r[k * 9 : k * 9 + 2] = [f"new{k}", f"word{k}"]
        rows.append((200 + k, " ".join(r), None, None, 0))
    rows += [(300 + k, t, None, None, 0) for k, t in enumerate(["a b", "A  b", "a b c", "", "one", "one ", "é à", "É à"])]
    got = sorted(tuple(x) for x in ngram_join.similar_documents(frame(spark, rows, 5), n, percent).collect())
    want = brute_components(rows, n, percent)
    assert got == want
    assert any(c != d for d, _, c in want)


def test_jaccard_hot_shingles_and_large_groups(spark):
    """One passage in a third of the documents, and a group of many near copies."""
    import random

    r = random.Random(4)
    passage = prose(r, 40, 50)
    base = prose(r, 120).split(" ")
    rows = []
    for i in range(150):
        if i % 3 == 0:
            text = f"{passage} {prose(r, r.choice([2, 4, 60]))}"
        elif i % 3 == 1:
            words = list(base)
            for _ in range(r.randint(0, 3)):
                words[r.randrange(len(words))] = "edit" + str(r.randrange(9))
            text = " ".join(words)
        else:
            text = prose(r, 50)
        rows.append((i, text, None, None, 0))
    got = sorted(tuple(x) for x in ngram_join.similar_documents(frame(spark, rows, 7), 3, 90).collect())
    assert got == brute_components(rows, 3, 90)


def test_jaccard_odd_rows(spark):
    rows = odd_rows()
    got = ngram_join.similar_documents(with_clashes(spark, rows), 3, 90).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 104)}
    assert by[100].n_shingles == by[101].n_shingles == by[102].n_shingles == 0
    assert [by[k].component_id for k in (100, 101, 102)] == [100, 101, 102]
    assert by[106].component_id == 105 and by[103].component_id is None  # the null id has the same text
    kept = ngram_join.keep_first_of_component(with_clashes(spark, rows), 5, 80)
    assert kept.columns == with_clashes(spark, rows).columns
    assert ngram_join.similar_documents(frame(spark, [])).count() == 0


def test_keep_first_tells_components_of_one_id_apart(spark):
    """Dissimilar texts with null or repeated ids all stay; of each similar group one does."""
    t = [prose_of(20 + k, 60) for k in range(8)]
    near = t[3].split(" ")
    near[-1] = "edited"
    rows = [
        (None, t[0]), (None, t[1]), (None, t[2]), (None, ""),
        (5, t[1]),  # alike to a null id: the null id stays
        (6, t[3]), (6, t[4]), (7, " ".join(near)), (8, t[4]),
        (9, t[5]), (9, t[6]), (10, t[7]),
    ]
    df = frame(spark, [(*r, "en", "s", 1) for r in rows])
    kept = {(r.doc_id, r.text) for r in ngram_join.keep_first_of_component(df, 5, 80).collect()}
    assert kept == set(rows) - {(5, t[1]), (7, " ".join(near)), (8, t[4])}
