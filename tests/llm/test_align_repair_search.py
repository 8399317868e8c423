"""Conversation repair, tokenizer alignment and nearest neighbours, against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeflux.llm import alignment, conversation_repair as C, projection_search as P, queries
from tests.llm.cases import DOCS, corpus, frame, odd_rows, with_clashes

# conversation repair

TURNS = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        out.append(1 if not bare else 2 if (role, text) in seen else 3 if bare[-1] not in ".!?" else 0)
        seen.add((role, text))
    return out


def apply_edits(audit, rows, choice):
    """Rows after the edits; choice gives the role of each R and I."""
    out, i, choice = [], 0, list(choice)
    for e in audit:
        if e == "I":
            out.append((choice.pop(0), ""))
            continue
        if e == "K":
            out.append(rows[i])
        elif e == "R":
            out.append((choice.pop(0), rows[i][1]))
        i += 1
    return out


def every_repair(rows):
    """All edit sequences with at most two inserts a place, tried one by one: (cost, audit, repaired)."""
    faults, best = faults_of(rows), None
    for ops in itertools.product("KRD", repeat=len(rows)):
        if any(o != "D" and f in (1, 2) for o, f in zip(ops, faults)):
            continue
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "".join("I" * g + o for g, o in zip(gaps, ops)) + "I" * gaps[-1]
            cost = sum({"K": 0, "R": 2, "D": 3, "I": 2}[e] for e in audit) + sum(o != "D" and f == 3 for o, f in zip(ops, faults))
            if best and (cost, audit) >= best[:2]:
                continue
            for choice in itertools.product(["user", "assistant"], repeat=sum(e in "RI" for e in audit)):
                made = apply_edits(audit, rows, choice)
                if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "?" for r, _ in made)):
                    best = (cost, audit, "\n".join(f"{r}:{t}" for r, t in made))
                    break
    return best


def plain_repair(rows):
    """The same by a recursion over (row, state), from the end."""
    faults = faults_of(rows)
    due, best = {0: 2, 1: 2, 2: 3, 3: 2}, {}
    for i in range(len(rows), -1, -1):
        here = {}
        for s in range(4):
            found = [(0, "")] if i == len(rows) and s in (0, 3) else []
            if i < len(rows):
                role, f = rows[i][0][:1], faults[i]
                step = lambda cost, e, to: found.append((cost + best[i + 1, to][0], e + best[i + 1, to][1]))  # noqa: E731, B023
                step(3, "D", s)
                if f not in (1, 2):
                    if (role == "s" and s == 0) or (role == "u" and s != 2) or (role == "a" and s == 2):
                        step(f == 3, "K", 1 if role == "s" else due[s])
                    step(2 + (f == 3), "R", due[s])
            here[s] = found
        for _ in range(2):  # inserts
            for s in range(4):
                here[s] = [min(here[s])] if here[s] else []
            more = {s: [(c + 2, "I" + a) for c, a in here[due[s]]] for s in range(4)}
            for s in range(4):
                here[s] = here[s] + more[s]
        for s in range(4):
            best[i, s] = min(here[s])
    cost, audit = best[0, 0]
    return cost, audit, "\n".join(C.repaired_rows(audit.encode(), [r for r, _ in rows], [t for _, t in rows], 0))


def solve(rows):
    code = np.array([{"s": 1, "u": 2, "a": 3}.get(r[:1], 0) for r, _ in rows], int)
    fault = np.array(faults_of(rows), int)
    paths = C.Paths(np.array([0, len(rows)]), code, (fault == 1) | (fault == 2), fault == 3, C.AT_END[None], np.ones(1, bool))
    audit = paths.audits(4 * paths.first)[0]
    return int(paths.cost[0, 0]), audit.decode(), "\n".join(C.repaired_rows(audit, [r for r, _ in rows], [t for _, t in rows], 0))


def random_rows(r, n):
    return [(r.choice(["system", "user", "assistant", "assistant", "user", "tool", "", " "]), r.choice(["a.", "b!", "c", "d?", "e. ", "f\n", "", " \t", "g", "h.", "é."])) for _ in range(n)]


def test_repair_of_every_small_conversation():
    r = random.Random(4)
    for n in (0, 1, 2, 2, 3, 3, 3, 4, 4):
        for _ in range(12):
            rows = random_rows(r, n)
            assert solve(rows) == every_repair(rows) == plain_repair(rows), rows


def test_repair_of_long_conversations():
    r = random.Random(5)
    for n in (1, 2, 7, 8, 9, 63, 64, 200):
        for _ in range(6):
            rows = random_rows(r, n)
            assert solve(rows) == plain_repair(rows)


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
    return out


def expected(rows):
    conv = defaultdict(list)
    for c, turn, role, text in damaged(rows):
        conv[c].append((turn is not None, turn or 0, role, hashlib.sha256(text.encode()).hexdigest(), text))
    out = {}
    for c in {x[0] for x in rows}:
        own = sorted(conv.get(c, []))
        turns = {t for has, t, *_ in own if has}
        seq = [(role, text) for *_, role, _, text in own]
        f = faults_of(seq)
        cost, audit, text = plain_repair(seq) if seq else (0, "", "")
        pairs = ["".join((a[0][:1], b[0][:1])) for a, b in zip(seq, seq[1:])]
        out[c] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0, f.count(1), f.count(2), f.count(3),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )
    return out


def repaired(rows, spark, parts=3, **extra):
    df = spark.createDataFrame([(*r, *extra.values()) for r in rows], TURNS + "".join(f", {k} string" for k in extra)).repartition(parts)
    got = C.repair(C.damage(df), df).collect()
    assert len({x.conv_id for x in got}) == len(got)
    return {x.conv_id: tuple(x)[1:] for x in got}


def turn_rows(seed=1, convs=60, most=9):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        roles = (["system"] if r.random() < 0.3 else []) + ["user", "assistant"] * most
        rows += [(c, t, roles[t], r.choice(["a.", "b!", "some text.", "no end", "é\n漢 fin?"])) for t in range(r.randint(1, most))]
    return rows


ODD_TURNS = [
    (None, None, None, None), (None, 1, "user", "x."), (None, 2, "assistant", "y."), (900, None, "user", "a."), (900, None, "user", "a."), (900, 5, "assistant", None),
    (901, 1, "user", "same."), (901, 1, "user", "same."), (901, 1, "assistant", "tie."), (902, 3, "", ""), (903, 2, "umpire", "kept."), (903, 9, "a", "kept."), (904, 0, "user", "w " * 200_000 + "."), (904, 1, "assistant", "."),
]


def test_repair_query_form_matches_brute_force(spark):
    rows = turn_rows() + ODD_TURNS
    assert repaired(rows, spark, code="c", fault="f", seg="s", conv="v") == expected(rows)
    assert repaired([], spark) == {}


def test_repair_of_conversations_that_many_tasks_share(spark, monkeypatch):
    """One conversation holds most rows; segments are short, so states are followed through many of them."""
    r = random.Random(8)
    rows = turn_rows(2, 20) + [(7000, t, r.choice(["user", "assistant", "assistant", "system", "tool"]), f"{r.randint(0, 400)}{r.choice('.!? x')}") for t in range(900)]
    want = expected(rows)
    assert repaired(rows, spark) == want
    tables, segment = C._pieces, 7
    monkeypatch.setattr(C, "_pieces", lambda texts, lo, hi: ((x, min(x + segment, hi)) for x in range(lo, hi, segment)))
    assert repaired(rows, spark) == want
    monkeypatch.setattr(C, "_pieces", tables)


def test_repair_query_on_the_table(spark):
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {x.conv_id: tuple(x)[1:] for x in queries.op11_conversation_repair(spark, "/root/testdata/sf0.001").collect()}
    assert got == expected(rows)


# tokenizer alignment


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.ByteLevel(queries.tokenizer_path()), alignment.Pieces(queries.tokenizer_path(queries.PIECES))


def plain_alignment(rows, tokenizers):
    """By the definition, token by token, with the files' own libraries."""
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECES))
    letters, vocab = alignment.byte_letters(), {i: t for t, i in tok.get_vocab().items()}
    spell_a = lambda i: bytes(letters[c] for c in vocab[i])
    spell_b = lambda i: bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
    docs, count = [], Counter()
    for doc, text in rows:
        want = b" " + (text or "").encode()
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        if not text or b"".join(map(spell_a, a)) != want or b"".join(map(spell_b, b)) != want:
            docs.append((doc, 0, 0, 0, [], ""))
            continue
        ends_a, ends_b = np.cumsum([len(spell_a(i)) for i in a]).tolist(), np.cumsum([len(spell_b(i)) for i in b]).tolist()
        links, j = [], 0
        for i, e in enumerate(ends_a):
            s = ends_a[i - 1] if i else 0
            while ends_b[j] <= s:
                j += 1
            k = j
            while k < len(b) and (ends_b[k - 1] if k else 0) < e:
                links.append((a[i], b[k]))
                k += 1
        common = sorted(set(ends_a) & set(ends_b))
        group_of = lambda ends: np.searchsorted(common, ends, "left").tolist()  # noqa: E731, B023
        in_group = [([], []) for _ in common]
        for side, (ids, ends) in enumerate(((a, ends_a), (b, ends_b))):
            for i, g in zip(ids, group_of(ends)):
                in_group[g][side].append(str(i))
        sha = hashlib.sha256(";".join("|".join(map(",".join, g)) for g in in_group).encode()).hexdigest()
        docs.append((doc, len(a), len(b), len(common), links, sha))
        count.update(links)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    return [(d, na, nb, g, len(x), sum(count[p] == top[p[1]] for p in x), sum(count[p] for p in x), sha) for d, na, nb, g, x, sha in docs]


ODD_TEXTS = ["", " ", "  x", "a▁b", "<|endoftext|> <s></s> <0x0A> <unk>", "tab\tnew\n\nline\r\n", "漢字 é ß 🙂🙂", "\x00nul", "x" * 3000, "can't we'll", "Trailing ", "1234567 and 12", "<|endoftext|><|endoftext|>", " nbsp　"]


def aligned(spark, df):
    first, second = queries.tokenizer_path(), queries.tokenizer_path(queries.PIECES)
    return alignment.align(df, lambda: alignment.ByteLevel(first), lambda: alignment.Pieces(second))


def same(got, want):
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_alignment_matches_the_definition(spark, tokenizers):
    rows = corpus(n=30) + odd_rows() + [(500 + i, t, "en", "s", 1) for i, t in enumerate(ODD_TEXTS)] + [(600, "long words and words " * 20_000, "en", "s", 1)]
    want = plain_alignment([(r[0], r[1]) for r in rows], tokenizers)
    same(aligned(spark, frame(spark, rows, 4)).collect(), want)
    same(aligned(spark, with_clashes(spark, rows)).collect(), want)
    assert aligned(spark, frame(spark, [])).count() == 0
    assert any(w[1] == 0 and r[1] == "a▁b" for w, r in zip(want, rows))


def test_alignment_by_small_blocks(spark, tokenizers, monkeypatch):
    """Blocks of a few texts, and lists of pairs beyond two bytes, change nothing."""
    rows = corpus(n=20) + odd_rows()
    want = plain_alignment([(r[0], r[1]) for r in rows], tokenizers)
    block = alignment.Aligner(*tokenizers)
    texts = [(r[1] or "").encode() for r in rows]
    whole = block.block(np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts])))
    assert [int(x) for x in whole["n_links"]] == [w[4] for w in want] and whole["ns"].sum() == sum(w[4] for w in want)
    assert whole["groups_sha256"] == [w[-1] for w in want]


def test_byte_level_falls_back_to_the_files_own_library(tmp_path, tokenizers):
    import json

    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    assert tokenizers[0].fast is not None
    merges = spec["model"]["merges"]
    merges[0], merges[1] = merges[1], merges[0]
    (tmp_path / "other.json").write_text(json.dumps(spec))
    other = alignment.ByteLevel(str(tmp_path / "other.json"))
    assert other.fast is None
    assert [x.tolist() for x in tokenizers[0](ODD_TEXTS)] == [tokenizers[0].own.encode(" " + t, add_special_tokens=False).ids for t in ODD_TEXTS]


# nearest neighbours

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_nearest(rows, k, modulus):
    fine = [(i, np.array(v, float)) for i, v, *_ in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, v) in enumerate(fine):
        if i is None or i % modulus:
            continue
        near = [(-float(v / np.abs(v).max() @ (w / np.abs(w).max()) / np.linalg.norm(v / np.abs(v).max()) / np.linalg.norm(w / np.abs(w).max())), j) for b, (j, w) in enumerate(fine) if b != a and len(w) == len(v)]
        near.sort(key=lambda x: (round(x[0], 12), -(1 << 63) if x[1] is None else x[1]))
        out += [(i, r, j, -s) for r, (s, j) in enumerate(near[:k], 1)]
    return out


def close(got, want):
    key = lambda x: (x[0], x[1], -(1 << 63) if x[2] is None else x[2])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-9 for g, w in zip(got, want))


def vectors(n=300, dim=8, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, x.tolist(), int(i % 3)) for i, x in enumerate(rng.standard_normal((n, dim)))]


def test_nearest_with_a_sure_test_is_exact(spark):
    """With a confidence of one in 10^12 the stopping test lets nothing go: equal to brute force, odd rows included."""
    rows = vectors() + [
        (None, [1.0] * 8, 1), (1000, None, 1), (1050, [], 1), (1100, [0.0] * 8, 1), (1150, [float("nan")] * 8, 1), (1200, [None] + [1.0] * 7, 1), (1250, [float("inf")] * 8, 1),
        (1300, [1.0, 2.0], 1), (1350, [1.0, 2.0, 3.0], 1), (1301, [2.0, 4.1], 1), (1400, [2.0**1000] * 8, 1), (1450, [-(2.0**-1000)] * 8, None), (1500, [1.0] * 8, 2), (1500, [1.0] * 8, 2),
    ] + [(2000 + i, [0.5, -0.5] * 4, 1) for i in range(40)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS + ", cls string, point int").repartition(4)
    close(P.nearest(df, F.col("vec_id") % 50 == 0, 5, confidence=1 - 1e-12).collect(), brute_nearest(rows, 5, 50))
    empty = spark.createDataFrame([], VECTORS)
    assert P.nearest(empty, F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 1.0], 1)], VECTORS)
    assert P.nearest(one, F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_over_many_cells_and_blocks(spark, monkeypatch):
    for name, value in (("CELL", 64), ("BLOCK", 32), ("LEAF", 8), ("QUERIES", 4), ("SAMPLE", 200)):
        monkeypatch.setattr(P, name, value)
    rows = vectors(500, 16, 3)
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    got = P.nearest(df, F.col("vec_id") % 10 == 0, 5, confidence=1 - 1e-12).collect()
    close(got, brute_nearest(rows, 5, 10))


def test_nearest_recall_on_the_table(spark):
    rows = [tuple(x) for x in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = queries.op13_nearest_neighbours(spark, "/root/testdata/sf0.1").collect()
    want = brute_nearest(rows, 5, 50)
    score = {(w[0], w[2]): w[3] for w in want}
    found = [x for x in got if (x.query_id, x.vec_id) in score]
    assert len(got) == len(want) and len(found) >= 0.95 * len(want)
    assert all(abs(x.score - score[x.query_id, x.vec_id]) < 1e-12 for x in found)


def test_chi_square_quantiles():
    """Tabled values."""
    for p, k, want in ((0.95, 1, 3.841459), (0.95, 10, 18.307038), (0.99, 16, 31.999927), (0.5, 2, 1.386294)):
        assert abs(P.chi_square_quantile(p, k) - want) < 1e-5


def test_search_block_leaves_out_what_the_test_allows():
    """A far cluster is not verified once near vectors are known."""
    rng = np.random.default_rng(1)
    x = np.concatenate([np.eye(16)[0] + 0.01 * rng.standard_normal((200, 16)), -np.eye(16)[0] + 0.01 * rng.standard_normal((200, 16))])
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    points = unit @ P.projection(16, 8, 1)
    best, cosines = P.search_block(points, x, np.arange(400), points[:5], x[:5], np.full(5, -np.inf), 6, P.chi_square_quantile(0.97, 8))
    assert (best < 200).all() and (best[:, 0] == np.arange(5)).all() and (np.diff(cosines, axis=1) <= 0).all()


# earlier operators on odd input


def test_decontamination_items_of_one_id_or_none(spark):
    """Different texts under one item_id are items of their own, and a null item_id is one, too."""
    from lakeflux.llm import decontaminate

    a, b, c = (" ".join(f"{p}{i}" for i in range(n)) for p, n in (("alpha", 40), ("beta", 9), ("gamma", 25)))
    bench = spark.createDataFrame([(1, a), (1, b), (1, b), (None, c), (None, None), (None, "")], "item_id long, text string")
    rows = [(10, f"x {a} y", "en", "s", 1), (11, f"x y {b}", "en", "s", 1), (12, c, "en", "s", 1), (13, "clean words only here " * 9, "en", "s", 1), (None, f"{b} {c}", "en", "s", 1)]
    got = sorted(((r.doc_id, r.item_id, r.coverage) for r in decontaminate.leaked_items(frame(spark, rows), bench).collect()), key=repr)
    assert got == sorted([(10, 1, 1.0), (11, 1, 1.0), (12, None, 1.0), (None, 1, 1.0), (None, None, 1.0)], key=repr)
    assert [r.doc_id for r in decontaminate.decontaminate(frame(spark, rows), bench).collect()] == [13]


def test_decontamination_of_repetitive_and_long_texts(spark):
    from lakeflux.llm import decontaminate

    item = "again and " * 30
    rows = [(1, "again and " * 400, "en", "s", 1), (2, "again or " * 400, "en", "s", 1), (3, " ".join(f"w{i}" for i in range(60_000)) + " " + item, "en", "s", 1)]
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r.doc_id: (r.coverage, r.tiles) for r in decontaminate.leaked_items(frame(spark, rows), bench).collect()}
    assert got == {1: (1.0, 1), 3: (1.0, 1)}


def test_license_places_of_very_many_phrases():
    """Word places come from one running count, whatever the number of phrases."""
    import time

    from lakeflux.llm import license

    scanner = license.Scanner(license.BASE_PHRASES, license.MORE_PHRASES)
    r = random.Random(2)
    words = [w for _ in range(3000) for w in r.choice([["cc", "by"], ["all", "rights", "reserved"], ["general", "public", "license"], ["x"], ["mit", "license"]])]
    phrases = [p.split() for p in license.BASE_PHRASES]
    want = sorted(i for i in range(len(words)) for p in phrases if words[i : i + len(p)] == p)
    assert sorted(scanner.scan(" ".join(words))[1]) == want and len(want) > 1000
    began = time.time()
    assert len(scanner.scan("all rights reserved " * 200_000)[1]) == 200_000
    assert time.time() - began < 20


def test_ngram_overlaps_are_whole_numbers():
    from lakeflux.llm import ngram_join

    n = 1_000_003
    both = ngram_join.overlaps([np.arange(n)], [np.arange(n + 5)])
    assert both.dtype == np.int64 and 100 * int(both[0, 0]) == 100_000_300
