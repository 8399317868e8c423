"""Language ID, licences, embeddings, language model, decontamination, packing and the pipeline."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakeflux.llm import decontaminate, embedding_dedup, langid, license, lm_scoring, packing, queries
from lakeflux.llm import textblocks as T
from tests.llm.cases import corpus, frame, odd_rows, prose, rows_of, union_find, with_clashes

SF = "/root/testdata/sf0.001"
TOKENIZER = queries.tokenizer_path()


def crc(doc_id, n):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % n == 2


# language ID


def test_langid_held_out_accuracy(spark):
    out = queries.op3_language_id(spark, SF)
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").where("held_out and lang is not null").collect()
    assert len(rows) > 20 and sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_langid_many_languages_and_odd_rows(spark):
    """More languages than bits of one word, and every odd text."""
    r = random.Random(1)
    letters = "bcdfghjklmnpqrstvwxz"
    alphabet = {f"l{k}": [letters[k % 20] + v + letters[k // 4] for v in "aeiou"] for k in range(70)}
    rows = [(i, " ".join(r.choice(alphabet[f"l{i % 70}"]) * r.randint(1, 2) for _ in range(60)), f"l{i % 70}", "s", 1) for i in range(420)]
    filters = langid.fit(frame(spark, rows))
    assert len(filters.langs) == 70 and filters.bits.shape[1] == 2
    out = langid.identify(with_clashes(spark, rows), filters)
    assert sum(x.lang_pred == x.lang for x in out.collect()) == len(rows)
    odd = langid.identify(with_clashes(spark, odd_rows()), filters)
    assert odd.count() == len(odd_rows())
    for x in odd.collect():
        has_letter = bool(re.search(r"[^\W\d_]", x.text or ""))
        assert (x.lang_pred == "und") == (not has_letter) and (has_letter or x.score == 0)
    none = langid.identify(frame(spark, odd_rows()), langid.fit(frame(spark, [])))
    assert {x.lang_pred for x in none.collect()} == {"und"}
    assert langid.identify(frame(spark, []), filters).count() == 0


def test_langid_sample_keeps_rare_languages(spark):
    """A bounded sample learns a language of few documents as well as one of many."""
    r = random.Random(3)
    rows = [(i, " ".join(r.choice(["bade", "dabe", "gedab", "abged"]) for _ in range(20)), "big", "s", 1) for i in range(600)]
    rows += [(None, " ".join(r.choice(["жизо", "зожи", "ожизо", "изожи"]) for _ in range(20)), "rare", "s", 1) for i in range(6)]
    filters = langid.fit(frame(spark, rows), max_train_docs=40)
    assert filters.langs == ["big", "rare"]  # the more frequent first, as in all documents
    out = langid.identify(frame(spark, rows), filters).collect()
    assert all(x.lang_pred == x.lang and x.score > 0.9 for x in out)
    for counts in ({"a": 1_000_000, "b": 30, "c": 7}, {"a": 5}, {str(k): 50 for k in range(100)}, {}):
        shares = langid.sample_shares(counts, 200)
        assert all(0 < shares[k] <= 1 for k in counts) and sum(shares[k] * n for k, n in counts.items()) <= 200 + 1e-6
    assert langid.sample_shares({"a": 1_000_000, "b": 30, "c": 7}, 200) == {"a": 163 / 1_000_000, "b": 1.0, "c": 1.0}


def test_bloom_returns_all_languages():
    rng = np.random.default_rng(0)
    sets = [rng.integers(0, 1 << 32, 5000).astype(np.int64) for _ in range(3)]
    f = langid.Filters(["a", "b", "c"], sets)
    for k, own in enumerate(sets):
        share = f.shares(own.view(np.uint64), np.zeros(len(own), np.int64), 1)[0]
        assert share[k] == pytest.approx(1) and all(share[j] < 0.01 for j in range(3) if j != k)


# licences


def test_license_places_against_brute_force(spark):
    r = random.Random(2)
    bits = ["CC", "by", "General", "public", "LICENSE", "all", "rights", "reserved", "é", "x1", "MIT license", "(c)", "cc-by", "SPDX-License-Identifier: MIT OR (Apache-2.0 AND GPL-2.0-only WITH Classpath-exception-2.0)\n"]
    rows = [(i, "".join(r.choice(bits) + r.choice([" ", "-", "\n", ", ", ""]) for _ in range(60)), "en", "s", 1) for i in range(50)]
    got = {x.doc_id: x for x in license.scan_licenses(frame(spark, rows)).collect()}
    for d, text, *_ in rows:
        low = re.sub(r"[A-Z]", lambda m: m.group().lower(), text).encode()
        words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for phrase, label in license.BASE_PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.encode().split()]
        assert got[d].n_words == len(words)
        assert got[d].base_places == sorted(p for p, _ in places)
        assert got[d].base_labels == sorted({x for _, x in places})
        assert set(got[d].base_labels) <= set(got[d].labels) and got[d].labels == sorted(set(got[d].labels))


def test_license_expressions():
    p = lambda s: None if (x := license.parse_expression(s)) is None else sorted(" and ".join(sorted(y)) for y in x)
    assert p(" MIT */") == ["mit"]
    assert p("MIT OR Apache-2.0") == ["apache-2.0", "mit"]
    assert p("MIT AND (BSD-3-Clause OR Zlib)") == ["bsd-3-clause and mit", "mit and zlib"]
    assert p("GPL-2.0-only WITH Classpath-exception-2.0 OR MIT") == ["gpl-2.0-only with classpath-exception-2.0", "mit"]
    assert p("A or B and C") == ["a", "b and c"]
    for bad in ("", "OR MIT", "MIT AND", "(MIT", "(MIT OR GPL) WITH X", "()"):
        assert p(bad) is None, bad


def test_license_expression_of_many_alternatives():
    """Nine pairs, 512 alternatives: all labels, and the expression as it is."""
    scanner = license.Scanner(license.BASE_PHRASES, license.MORE_PHRASES)
    pairs = " AND ".join(f"(L{k} OR M{k})" for k in range(9))
    *_, labels, options = scanner.scan(f"# SPDX-License-Identifier: {pairs} */\n")
    assert labels == {f"spdx:{c}{k}" for c in "lm" for k in range(9)}
    assert options == [[pairs.lower()]]
    eight = " AND ".join(f"(L{k} OR M{k})" for k in range(8))
    assert len(license.parse_expression(eight)) == 256 and len(scanner.scan(f"SPDX-License-Identifier: {eight}")[4][0]) == 256
    *_, labels, options = scanner.scan(f"SPDX-License-Identifier: {pairs} AND\n")
    assert not labels and not options  # malformed


def test_license_odd_rows(spark):
    rows = license.scan_licenses(with_clashes(spark, odd_rows())).collect()
    assert len(rows) == len(odd_rows())
    assert all((x.score == 0) == (not x.labels) for x in rows)
    assert license.scan_licenses(frame(spark, [])).count() == 0
    sql = spark.read.parquet(f"{SF}/documents.parquet").where("lower(text) like '%all rights reserved%'").count()
    assert queries.op5_license_scan(spark, SF).where("base_labels like '%reserved%'").count() >= sql


# embeddings


EMB = "vec_id long, embedding array<float>, label int"


def brute_embeddings(rows, threshold=0.93):
    fine = {i: (label, np.array(v, float)) for i, v, label in rows if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    links = set()
    ids = sorted(fine)
    for k, a in enumerate(ids):
        la, x = fine[a]
        for b in ids[k + 1 :]:
            lb, y = fine[b]
            if la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links.add((a, b))
    return links, union_find([r[0] for r in rows], links)


def test_embedding_links_recall_and_precision(spark):
    rng = np.random.default_rng(3)
    rows, k = [], 0
    for c in range(30):
        base = rng.normal(size=24)
        for _ in range(rng.integers(1, 12)):
            rows.append((k, [float(np.float32(v)) for v in base + rng.normal(size=24) * 0.16], int(c % 3)))
            k += 1
    links, root = brute_embeddings(rows)
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, EMB).repartition(4)).collect()}
    want = Counter(x for pair in links for x in pair)
    assert all(got[i].n_links <= want[i] for i in got)
    assert sum(r.n_links for r in got.values()) >= 0.95 * sum(want.values()) > 100
    assert sum(got[i].component_id == root[i] for i in got) >= 0.95 * len(got)
    assert all(r.kept == (r.component_id == r.vec_id) for r in got.values())


def test_embedding_blocks_count_each_pair_once(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 7)
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    rows = [(i, [float(np.float32(v)) for v in base + rng.normal(size=16) * 0.02], 1) for i in range(60)]
    rows += [(100 + i, rows[0][1], 1) for i in range(5)] + [(200, rows[0][1], 2)]
    got = {r.vec_id: r for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, EMB)).collect()}
    assert all(got[r[0]].n_links == 64 and got[r[0]].component_id == 0 for r in rows[:-1])
    assert got[200].n_links == 0 and got[200].kept


def test_embedding_odd_rows(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, None), (5, None, 1), (6, [0.0, 0.0, 0.0], 1), (7, [1.0, None, 3.0], 1)]
    rows += [(8, [1.0, float("nan"), 3.0], 1), (9, [1.0, float("inf"), 3.0], 1), (10, [], 1), (11, [1.0, 2.0, 3.0, 0.0], 1), (None, [-1.0, -2.0, -3.0], 1), (12, [3e38, 3e38, 3e38], 7)]
    df = spark.createDataFrame(rows, EMB).withColumn("cls", F.lit("x")).withColumn("unit", F.lit(1))
    got = embedding_dedup.near_duplicates(df).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.vec_id].append((r.n_links, r.component_id))
    assert by[1] == [(3, 1)] and by[2] == [(3, 1)] * 2 and by[3] == [(3, 1)] and by[None] == [(0, None)]
    assert all(by[k] == [(0, k)] for k in range(4, 13))
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], EMB)).count() == 0


# language model


def _tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())) + [None]


def test_lm_counts_and_base_score_are_exact(spark):
    rows = corpus(6, 70) + [(900, None, None, None, None), (901, "", None, None, 0), (902, "zzzz unseen Word", None, None, 0)]
    fits = ~F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    counts = Counter(t for d, x, *_ in rows if not crc(d, 7) for t in _tokens(x))
    n, v = sum(counts.values()), len(counts)
    for head in (20, 100_000):
        got = lm_scoring.score_documents(frame(spark, rows), fits, top_words=10, head_words=head).collect()
        assert len(got) == len(rows)
        texts = {d: x for d, x, *_ in rows}
        for r in got:
            tok = _tokens(texts[r.doc_id])
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(r.doc_id, 7), len(tok), sum(counts[t] > 0 for t in tok), n)
            assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tok))
            assert r.score < 0


def test_lm_normalised_and_better_than_base():
    rng = np.random.default_rng(0)
    m = 60
    truth = rng.dirichlet(np.full(m, 0.05), m)
    start = rng.dirichlet(np.full(m, 1.0)) * 20000
    counts = np.round(truth * start[:, None])
    log_p = lm_scoring.train(counts, dim=24)
    assert np.allclose(np.exp(log_p).sum(1), 1)
    unigram = np.log(counts.sum(0) + 1) - np.log(counts.sum() + m)
    assert (counts * log_p).sum() > (counts * unigram).sum() + 0.5 * counts.sum()


def test_lm_words_of_a_class_sum_to_one(spark):
    """Any text's score is a product of probabilities: over all known words and one unseen word of each bucket they sum to one."""
    rows = [(i, "aa bb cc dd ee aa bb aa", None, None, 0) for i in range(5)]
    vocab = ["aa", "bb", "cc", "dd", "ee"]
    tests = [(100 + i, w, None, None, 0) for i, w in enumerate(vocab)] + [(200, "", None, None, 0)]
    unseen = {}
    for a in range(97, 123):
        for b in range(97, 123):
            for c in range(97, 123):
                w = chr(c) + chr(a) + chr(b)
                unseen.setdefault(T_bucket(w), w)
    others = [unseen[b] for b in sorted(unseen)]
    tests += [(300 + i, w, None, None, 0) for i, w in enumerate(others)]
    fits = F.col("doc_id") < 100
    got = {r.doc_id: r for r in lm_scoring.score_documents(frame(spark, rows + tests), fits, top_words=2).collect()}
    # a one-word text scores P(word | start) * P(end | class of word), no more than P(word | start)
    single = {w: got[100 + i].score for i, w in enumerate(vocab)} | {w: got[300 + i].score for i, w in enumerate(others)}
    total = 10 ** got[200].score + sum(10**s for s in single.values())
    assert 0 < total <= 1 + 1e-6


def T_tokens(ws):
    a = pa.array([" ".join(ws)])
    _, _, buf, offs = next(T.blocks(a))
    return lm_scoring.tokens(buf, offs)


def T_bucket(w):
    return int(T_tokens([w])[1][0])


def test_lm_beats_base_on_held_out(spark):
    rows = queries.op7_lm_scoring(spark, SF).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_lm_odd_rows(spark):
    got = lm_scoring.score_documents(with_clashes(spark, odd_rows()), F.col("doc_id").isNotNull()).collect()
    assert len(got) == len(odd_rows())
    assert lm_scoring.score_documents(frame(spark, odd_rows()), F.lit(False)).count() == len(odd_rows())
    assert lm_scoring.score_documents(frame(spark, []), F.lit(True)).count() == 0


# decontamination


def brute_tiles(doc, item, size):
    """Greedy string tiling by its definition."""
    used_d, used_i, tiles = set(), set(), []
    while True:
        best = None
        for a in range(len(doc)):
            for b in range(len(item)):
                n = 0
                while a + n < len(doc) and b + n < len(item) and doc[a + n] == item[b + n] and a + n not in used_d and b + n not in used_i:
                    n += 1
                if n >= size and (best is None or n > best[2]):
                    best = (a, b, n)
        if best is None:
            return tiles
        tiles.append(best)
        used_d |= set(range(best[0], best[0] + best[2]))
        used_i |= set(range(best[1], best[1] + best[2]))


def test_tiling_against_brute_force():
    r = random.Random(3)
    for _ in range(60):
        item = [r.choice("abcdef") for _ in range(r.randint(3, 25))]
        doc = [r.choice("abcdef") for _ in range(10)] + item[8:] + [r.choice("abc")] + item[:12] + item[3:9]
        size = 3
        at = [(a, b) for a in range(len(doc) - size + 1) for b in range(len(item) - size + 1) if doc[a : a + size] == item[b : b + size]]
        at = np.array(at, np.int64).reshape(-1, 2)
        assert decontaminate.tile(at[:, 0], at[:, 1], size, len(item)) == brute_tiles(doc, item, size)


def test_decontamination_catches_reordered_passages(spark):
    r = random.Random(7)
    items = [(k, prose(r, n, 100)) for k, n in ((0, 40), (1, 30), (2, 3), (3, 60), (4, 0))] + [(5, None), (None, "a b c d e f")]
    w = [t.split() for _, t in items[:4]]
    text = prose(r, 200)
    rows = [
        (0, f"{text} {' '.join(w[0]).upper()}, {text}", "en", "s", 1),
        (1, " ".join(w[1][15:] + ["x"] + w[1][:15]), "en", "s", 1),
        (2, text, "en", "s", 1),
        (3, "zz " + " ".join(w[2]) + " zz", "en", "s", 1),
        (4, " ".join(w[3][:40]), "en", "s", 1),
        (5, " ".join(x for k in range(0, 60, 4) for x in w[3][k : k + 4] + ["y"]), "en", "s", 1),
        (6, " ".join(w[3][:50]) + " q " + " ".join(w[0][:36]), "en", "s", 1),
        *odd_rows()[:4],
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = rows_of(decontaminate.leaked_items(with_clashes(spark, rows), bench).select("doc_id", "item_id"))
    assert got == [(0, 0), (1, 1), (3, 2), (6, 0), (6, 3)]
    kept = decontaminate.decontaminate(with_clashes(spark, rows), bench)
    assert kept.columns == with_clashes(spark, rows).columns and kept.count() == len(rows) - 4
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.decontaminate(frame(spark, rows), empty).count() == len(rows)
    assert decontaminate.leaked_items(frame(spark, []), bench).count() == 0


# packing


def test_block_encoder_equals_the_library():
    enc = packing.BlockEncoder(TOKENIZER)
    odd = ["a  b", "x\n\ny", " lead", "", "trail ", "don't it's I'll", "tab\there", "é à ñ.", "<|endoftext|> a<|endoftext|>", "a b c", "nul\0 x", "1234 a1b2,c.", "x\r\ny z"]
    odd += ["Ġx y", "a_b c-d ...", "\U0001f600 \U0001f600\U0001f600 x", " ", "\n", "it’s “q” x", "a b", "a　b c", " ", "ok\u0085go", "a\x1cb", "w " * 5000 + "w"]
    odd += [t for _, t, *_ in corpus(2, 60)]
    for _ in range(2):  # the second time from the table
        got = []
        for _, _, buf, offs in T.blocks(pa.array(odd), 4000):
            ids, cut = enc.encode(buf, offs)
            got += [ids[a:b].tolist() for a, b in zip(cut, cut[1:])]
        assert got == [enc.tok.encode(t, add_special_tokens=False).ids for t in odd]


def test_block_encoder_equals_the_file_as_loaded():
    """Added tokens keep their own ids, as the contract's add_special_tokens=False has them."""
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(TOKENIZER)
    texts = ["x <|endoftext|> y", "<|endoftext|>", "plain words here", "a<|endoftext|>b c", "x <|endoftext", "|> y", "a  b <|endoftext|>", ""]
    enc = packing.BlockEncoder(TOKENIZER)
    for _ in range(2):
        got = []
        for _, _, buf, offs in T.blocks(pa.array(texts), 4000):
            ids, cut = enc.encode(buf, offs)
            got += [ids[a:b].tolist() for a, b in zip(cut, cut[1:])]
        assert got == [fresh.encode(t, add_special_tokens=False).ids for t in texts]
        assert got[0] == [87, 220, 50256, 331]


def test_packing_round_trip(spark):
    rows = corpus(4, 50) + odd_rows() + [(500, prose(random.Random(1), 4000), None, None, 0)]
    for max_len in (64, 1024):
        got = packing.pack(with_clashes(spark, rows).repartition(5), TOKENIZER, max_len, 2, with_ids=True).collect()
        places = defaultdict(list)
        for r in got:
            assert 1 <= r.length <= max_len and r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
            places[r.sequence_id].append((r.offset, r.length))
        for p in places.values():
            p.sort()
            assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and sum(n for _, n in p) <= max_len
        enc = packing.BlockEncoder(TOKENIZER)
        want = Counter(tuple(enc.tok.encode(t or "", add_special_tokens=False).ids + [2]) for _, t, *_ in rows)
        pieces = defaultdict(list)
        for r in got:
            if r.doc_id not in (None, 103, 104):
                pieces[r.doc_id].append((r.piece, r.start, np.frombuffer(r.ids, "<u4").tolist()))
        for own in pieces.values():
            own.sort()
            ids = [x for _, _, p in own for x in p]
            assert want[tuple(ids)] > 0
            assert all(len(p) == max_len for k, _, p in own if k) and own[0][1] == 0
            assert all(s == sum(len(q) for _, _, q in own[:k]) for k, s, _ in own)
        total = sum(r.length for r in got)
        assert total == sum(len(k) * n for k, n in want.items())
        assert len(places) <= -(-total // max_len) * 11 / 10 + 1
    assert packing.pack(frame(spark, []), TOKENIZER).count() == 0


def brute_best_fit(lengths, max_len):
    room = []
    for n in sorted(lengths, reverse=True):
        fit = [k for k, r in enumerate(room) if r >= n]
        if fit:
            k = min(fit, key=lambda k: room[k])
            room[k] -= n
        else:
            room.append(max_len - n)
    return len(room)


def test_plan_is_best_fit():
    r = random.Random(5)
    for _ in range(30):
        lengths = [r.randint(1, 50) for _ in range(r.randint(0, 300))]
        plan = packing.plan_slots(dict(Counter(lengths)), 50)
        used = defaultdict(list)
        seen = Counter()
        for p in plan.itertuples():
            seen[p.length] += p.n
            for k in range(p.n):
                used[p.sequence + k].append((p.offset, p.length))
        assert dict(seen) == dict(Counter(lengths))
        for own in used.values():
            own.sort()
            assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(n for _, n in own) <= 50
        assert len(used) == brute_best_fit(lengths, 50)


# pipeline


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    sizes = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        # each stage reads what the one before has written
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), "test")
        if k < 4:
            assert docs.columns == names
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] >= sizes[3] > 0
    assert corpus_pipeline.run(spark, SF).count() == sizes[4]


def test_pipeline_language_id_keeps_what_it_cannot_judge(spark):
    """Texts with too few n-grams, and labels that were not learned, stay; no letter, or n-grams of no language, goes."""
    r = random.Random(6)
    rows = [(i, prose(r, 80), "en", "s", 1) for i in range(60)]
    short = [(1001, "Re.", "en", "s", 1), (1002, "A.", None, "s", 1), (1003, "De.", "en", "s", 1)]
    alone = [(1004, "щука " + " ".join("жзклмщ"[k % 6] * 5 for k in range(40)), "ru", "s", 1)]
    gone = [(1005, "12 34 --", "en", "s", 1), (1006, "qxzvk wjqxz " * 20, "en", "s", 1), (1007, "qxzvk wjqxz " * 20, None, "s", 1)]
    fit = queries.fit_langid
    corpus_pipeline.fit_langid = lambda docs: fit(docs.where("doc_id < 1000"))
    try:
        out = corpus_pipeline.language_id(spark, frame(spark, rows + short + alone + gone), SF)
        assert sorted(x.doc_id for x in out.collect()) == [*range(60), 1001, 1002, 1003, 1004]
    finally:
        corpus_pipeline.fit_langid = fit


def test_pipeline_on_odd_rows(spark):
    docs = with_clashes(spark, odd_rows() + corpus(1, 20))
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        names = docs.columns
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), "test")
        if k < 4:  # every column stays, and what it holds
            assert docs.columns == names
            assert docs.where("score is not null or lang_pred is not null or doc is not null").count() == 0
    assert docs.count() > 0
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
