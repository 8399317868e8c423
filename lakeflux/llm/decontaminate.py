"""Benchmark decontamination by greedy string tiling.

Seeds are runs of ``min_match`` words that a document shares with a benchmark item,
found by a join on their running Karp-Rabin hashes. For each document and item the
longest matches that overlap no tile yet are marked again and again, each at least
``min_match`` words; the tiles' share of the item's words is its coverage. An item is
leaked where coverage reaches ``min_coverage``, in whatever order its passages stand.

Words are runs of digits, letters (A-Z in lower case) and non-ASCII characters, so that
case and punctuation hide nothing.

The join never lets all of a corpus's word runs be shuffled: a bitmap of the benchmark's
seed hashes, 1 MB whatever its size, first drops those that no item has.

Defined results: null and empty texts match nothing; an item of fewer than ``min_match``
words matches where all its words stand in a row (its coverage is then 1); items without
words match nothing; rows alike in id and text count once; different texts under one item_id
are items of their own, each with a row; a null item_id is an item like others; an empty table
on either side gives no rows; of equally long matches the one first in the document, then
first in the item, is marked. What repeats in a document or an item is shuffled as lists of
places, never as pairs of them.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.llm.work import FILTER_BITS, NULL_ID, attach, id_back, key_bitmap, keyed, materialise, text_key


def _word_hashes(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = T.lower_ascii(buf)
    starts, ends, doc = T.words(low, offs, T.ALNUM)
    return T.span_hash(T.prefix_sums(low), starts, ends), doc


def _grams(h: np.ndarray, doc: np.ndarray, sizes: list[int]):
    """Hashes of runs of each of these sizes, with the place of their first word."""
    for n in sizes:
        g, at = T.gram_hash(h, doc, n)
        yield n, g, at


def _seed_rows(items: DataFrame, min_match: int) -> DataFrame:
    """(item, ikey, n_words, size, h, ipos) of every seed of the benchmark; short items are one seed."""

    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in T.blocks(batch.column(2)):
                h, doc = _word_hashes(buf, offs)
                count = np.bincount(doc, minlength=hi - lo)
                first = np.searchsorted(doc, np.arange(hi - lo))
                items_of, texts_of = (batch.column(c).slice(lo, hi - lo).to_numpy() for c in (0, 1))
                for n, g, at in _grams(h, doc, list(range(1, min_match + 1))):
                    own = doc[at]
                    take = count[own] == n if n < min_match else count[own] >= n
                    g, at, own = g[take], at[take], own[take]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(items_of[own]), pa.array(texts_of[own]), pa.array(count[own], pa.int32()), pa.array(np.full(len(g), n), pa.int32()), pa.array(T.signed(g)), pa.array(at - first[own], pa.int32())],
                        ["item", "ikey", "n_words", "size", "h", "ipos"],
                    )

    rows = items.where(F.col("text").isNotNull()).select(F.coalesce(F.col("item_id").cast("long"), F.lit(NULL_ID)).alias("item"), text_key().alias("ikey"), F.col("text").cast("string"))
    return rows.dropDuplicates(["item", "ikey"]).mapInArrow(run, "item long, ikey long, n_words int, size int, h long, ipos int")


def tile(dpos: np.ndarray, ipos: np.ndarray, size: int, n_item: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from seeds (document place, item place): tiles (document place, item place, length).

    Seeds on one diagonal at consecutive places are one match; the heap gives the longest.
    A match that a tile has cut into comes back with what is left of it.
    """
    order = np.lexsort((dpos, dpos - ipos))
    d, i = dpos[order].astype(np.int64), ipos[order].astype(np.int64)
    begin = np.flatnonzero(np.append(True, (np.diff(d - i) != 0) | (np.diff(d) > 1))) if len(d) else np.zeros(0, np.int64)
    end = np.append(begin[1:], len(d))
    heap = [(-(int(d[b - 1]) - int(d[a]) + size), int(d[a]), int(i[a])) for a, b in zip(begin.tolist(), end.tolist())]
    heapq.heapify(heap)
    used_d: set[int] = set()
    used_i = bytearray(n_item)
    tiles = []
    while heap:
        minus, a, b = heapq.heappop(heap)
        free = [not used_i[b + k] and a + k not in used_d for k in range(-minus)]
        if all(free):
            tiles.append((a, b, -minus))
            used_d.update(range(a, a - minus))
            used_i[b : b - minus] = b"\1" * -minus
            continue
        k = 0
        while k < len(free):
            if free[k]:
                stop = k
                while stop < len(free) and free[stop]:
                    stop += 1
                if stop - k >= size:
                    heapq.heappush(heap, (k - stop, a + k, b + k))
                k = stop
            else:
                k += 1
    return tiles


def leaks(docs: DataFrame, items: DataFrame, min_match: int = 5, min_coverage: float = 0.8) -> DataFrame:
    """(doc, tkey, item, ikey, coverage, tiles, first_word): documents that hold an item, with the tiles' number and first place."""
    seeds = materialise(_seed_rows(items, min_match), "seeds")
    sizes = [r["size"] for r in seeds.select("size").distinct().collect()]  # at most min_match rows
    bits = docs.sparkSession.sparkContext.broadcast(key_bitmap(seeds, "h", hashed=True))

    def run(batches):
        have = bits.value
        for batch in batches:
            for lo, hi, buf, offs in T.blocks(batch.column(2)):
                h, doc = _word_hashes(buf, offs)
                first = np.searchsorted(doc, np.arange(hi - lo))
                ids, keys = (batch.column(c).slice(lo, hi - lo).to_numpy() for c in (0, 1))
                for n, g, at in _grams(h, doc, sizes):
                    s = (g & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)
                    some = np.flatnonzero((have[s >> 3] >> (s & 7).astype(np.uint8)) & 1)
                    g, at = g[some], at[some]
                    own = doc[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[own]), pa.array(keys[own]), pa.array(np.full(len(g), n), pa.int32()), pa.array(T.signed(g)), pa.array(at - first[own], pa.int32())],
                        ["doc", "tkey", "size", "h", "dpos"],
                    )

    found = keyed(docs).mapInArrow(run, "doc long, tkey long, size int, h long, dpos int")
    hits = found.groupBy("doc", "tkey", "size", "h").agg(F.collect_set("dpos").alias("d"))
    places = seeds.groupBy("item", "ikey", "n_words", "size", "h").agg(F.collect_list("ipos").alias("i"))
    # what one item shares with one document, as lists of places: no more than their words
    pairs = hits.join(places, ["h", "size"]).groupBy("doc", "tkey", "item", "ikey").agg(
        F.first("n_words").alias("n_words"), F.first("size").alias("size"), F.collect_list(F.struct("d", "i")).alias("at"), F.sum(F.size("i")).alias("seeds"),
    ).where(F.col("seeds") * F.col("size") >= min_coverage * F.col("n_words")).drop("seeds")

    def verify(batches):
        for part in (b.slice(i, 1024) for b in batches for i in range(0, b.num_rows, 1024)):
            out = []
            for r in part.to_pylist():
                dpos = np.concatenate([np.repeat(x["d"], len(x["i"])) for x in r["at"]]).astype(np.int64)
                ipos = np.concatenate([np.tile(x["i"], len(x["d"])) for x in r["at"]]).astype(np.int64)
                tiles = tile(dpos, ipos, r["size"], r["n_words"])
                coverage = sum(t[2] for t in tiles) / r["n_words"]
                if coverage >= min_coverage:
                    out.append((r["doc"], r["tkey"], r["item"], r["ikey"], coverage, len(tiles), min(t[0] for t in tiles)))
            cols = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc", "tkey", "item", "ikey", "coverage", "tiles", "first_word"])

    return pairs.mapInArrow(verify, "doc long, tkey long, item long, ikey long, coverage double, tiles int, first_word long")


def leaked_items(docs: DataFrame, items: DataFrame, min_match: int = 5, min_coverage: float = 0.8) -> DataFrame:
    """(doc_id, item_id, coverage, tiles, first_word) of every leaked item of every document."""
    out = leaks(docs, items, min_match, min_coverage)
    return out.select(id_back("doc").alias("doc_id"), id_back("item").alias("item_id"), "coverage", "tiles", "first_word")


def decontaminate(docs: DataFrame, items: DataFrame, min_match: int = 5, min_coverage: float = 0.8) -> DataFrame:
    """docs without the documents that hold a benchmark item; all columns as they are."""
    found = leaks(docs, items, min_match, min_coverage).select("doc", "tkey").distinct()
    return attach(docs, found, "left_anti").drop("__llm_key_doc", "__llm_key_tkey")
