"""Suffix-array dedup: removes every byte of a ``length``-byte string that also starts earlier.

A full suffix array of a corpus has a row a byte. Here only text that may repeat comes to
the suffix sort, and the sort needs no order beyond equal prefixes:

1. Every window of ``length`` bytes is owned by the smallest hash among its ``GRAM``-byte
   strings. Windows in a row with one owner are one row: owner, hash of the whole context,
   place. Contexts that stand in an earlier place, too, are removed at once, whole; a
   context that is the only one of its owner cannot repeat at all.
2. What is left are the first places of contexts that share an owner but differ: the edges
   of repeats. Their windows are cut down to those that share 80 bytes around the owner.
3. These go through the difference-cover algorithm modulo 3. Names of sampled positions
   (1 and 2 modulo 3) are those of triples of 11-byte symbols; the recursion names triples
   of names, 33 bytes apart; the remaining positions are merged in by the bytes before the
   next sampled position and that position's name. Names are 64-bit codes of what they
   stand for, not ranks, so naming needs no shuffle; the sort of the names brings equal
   prefixes together in the order of their places, and each is compared with the one
   before it.

Defined results: null and empty texts, and texts shorter than ``length``, keep all their
bytes; rows alike in doc_id and text are one document and get the same result; of different
texts under one doc_id the one with the smaller text hash comes first; a null doc_id sorts
first; an empty table gives no rows. Work and memory of a task follow its longest text.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.llm.work import id_back, keyed, materialise, maybe_in

#: Bytes that choose a window's owner.
GRAM = 20
#: Windows of one owner are told apart in steps of so many bytes.
STEP = 20
_SYMBOL = 11
#: Of a gram's 64 bits these give way to its place: no text is longer.
_PLACE_BITS = 31


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Smallest value of every ``width`` neighbours, by doubling."""
    n = 1
    while 2 * n <= width:
        a = np.minimum(a[:-n], a[n:])
        n *= 2
    return np.minimum(a[: len(a) - (width - n)], a[width - n :]) if width > n else a


def owners(sums: np.ndarray, n: int, length: int) -> np.ndarray:
    """Place of each window's owner: the first of its grams that are smallest in the upper bits of their hash."""
    at = np.arange(n - GRAM + 1)
    h = T.span_hash(sums, at, at + GRAM)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    return (sliding_min(h & ~low | at.astype(np.uint64), length - GRAM + 1) & low).astype(np.int64)


def owner_runs(buf: np.ndarray, offs: np.ndarray, length: int):
    """Runs of windows of one document with one owner: first and last window, owner, context hash, document."""
    n = len(buf)
    if n < length:
        return (np.zeros(0, np.int64),) * 5
    sums = T.prefix_sums(buf)
    own = owners(sums, n, length)
    doc = np.repeat(np.arange(len(offs) - 1, dtype=np.int32), np.diff(offs))
    inside = doc[: len(own)] == doc[length - 1 :]
    turn = np.append(True, own[1:] != own[:-1])
    first = np.flatnonzero(inside & (turn | np.append(True, ~inside[:-1])))
    last = np.flatnonzero(inside & np.append(turn[1:] | ~inside[1:], True))
    own = own[first]
    # the context and the owner's place in it
    context = T.mix(T.span_hash(sums, first, last + length) + (own - first).astype(np.uint64))
    return first, last, T.span_hash(sums, own, own + GRAM), context, doc[first].astype(np.int64)


_CONTEXTS = "owner long, context long, doc long, sub int, first int, last int, seen boolean"


def _contexts(docs: DataFrame, length: int) -> DataFrame:
    """Owner runs of all documents. Of those alike in one batch only the first goes by its owner;
    the others are known to repeat (seen) and go by their document."""

    def run(batches):
        for batch in batches:
            ids, subs = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = []
            for lo, hi, buf, offs in T.blocks(batch.column(2)):
                first, last, owner, context, d = owner_runs(buf, offs, length)
                parts.append((T.signed(owner.view(np.uint64)), T.signed(context.view(np.uint64)), d + lo, first - offs[d], last - offs[d]))
            if not parts:
                continue
            owner, context, d, first, last = (np.concatenate(c) for c in zip(*parts))
            order = np.lexsort((first, subs[d], ids[d], context, owner))
            new = np.append(True, (np.diff(owner[order]) != 0) | (np.diff(context[order]) != 0))[: len(order)]
            seen = np.zeros(len(order), bool)
            seen[order] = ~new
            owner = np.where(seen, T.signed(T.mix(ids[d].view(np.uint64))), owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owner), pa.array(context), pa.array(ids[d]), pa.array(subs[d], pa.int32()), pa.array(first, pa.int32()), pa.array(last, pa.int32()), pa.array(seen)],
                ["owner", "context", "doc", "sub", "first", "last", "seen"],
            )

    return docs.select("doc", "sub", "text").mapInArrow(run, _CONTEXTS)


def _first_of_context(rows: DataFrame) -> DataFrame:
    """(doc, sub, first, last, again): again, windows that stand earlier, too; else those of the first
    places of contexts whose owner has another context. Rows are sorted by owner, context and place."""

    def out(c, rows, again):
        return pa.RecordBatch.from_arrays(
            [pa.array(c[2][rows]), pa.array(c[3][rows], pa.int32()), pa.array(c[4][rows], pa.int32()), pa.array(c[5][rows], pa.int32()), pa.array(np.full(len(rows), again))],
            ["doc", "sub", "first", "last", "again"],
        )

    def run(batches):
        open_row, owner, context, several = None, None, None, False  # the last first place, not yet known to have company
        for batch in batches:
            c = [x.to_numpy(zero_copy_only=False) for x in batch.columns]
            if (at := np.flatnonzero(c[6])).size:
                yield out(c, at, True)
            c = [x[~c[6].astype(bool)] for x in c]
            if not len(c[0]):
                continue
            if open_row is not None:
                c = [np.concatenate([a, b]) for a, b in zip(open_row, c)]
            new_owner = np.append(True, c[0][1:] != c[0][:-1])
            new = new_owner | np.append(True, c[1][1:] != c[1][:-1])
            lead = np.flatnonzero(new)
            if (at := np.flatnonzero(~new)).size:
                yield out(c, at, True)
            left = ~new_owner[lead]
            left[0] = several  # the open row stands for those before it
            right = np.append(left[1:], False)
            share = left | right
            share[-1] = False  # open
            if share.any():
                yield out(c, lead[share], False)
            several = bool(left[-1])
            open_row = [x[lead[-1] : lead[-1] + 1] for x in c]
        if open_row is not None and several:
            yield out(open_row, np.array([0]), False)

    return rows.mapInArrow(run, "doc long, sub int, first int, last int, again boolean")


def _windows(first: list, last: list, start: int) -> np.ndarray:
    """All windows of the (merged) ranges of one document that begins at start."""
    a, b = np.array(first, np.int64), np.array(last, np.int64)
    flag = np.zeros(int(b.max()) + 2, np.int32)
    np.add.at(flag, a, 1)
    np.add.at(flag, b + 1, -1)
    return np.flatnonzero(np.cumsum(flag)[:-1] > 0) + start


def _edges(rows: DataFrame, length: int) -> DataFrame:
    """(code, doc, sub, first, last): windows by 80 bytes around their owner that they have in common if they are equal."""
    core = length - STEP

    def run(batches):
        for batch in batches:
            firsts, lasts = batch.column(3), batch.column(4)
            for lo, hi, buf, offs in T.blocks(batch.column(2)):
                if len(buf) < length:
                    continue
                sums = T.prefix_sums(buf)
                owner = owners(sums, len(buf), length)
                w = [_windows(firsts[lo + k].values.to_numpy(), lasts[lo + k].values.to_numpy(), int(offs[k])) for k in range(hi - lo)]
                d = np.repeat(np.arange(hi - lo), [len(x) for x in w])
                w = np.concatenate(w)
                step = (owner[w] - w) // STEP
                begin = owner[w] - step * STEP
                turn = np.flatnonzero(np.append(True, (np.diff(begin) != 0) | (np.diff(step) != 0) | (np.diff(w) != 1) | (np.diff(d) != 0)))
                stop = np.append(turn[1:], len(w)) - 1
                code = T.mix(T.span_hash(sums, begin[turn], begin[turn] + core) + step[turn].astype(np.uint64))
                own = d[turn]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(T.signed(code)),
                        batch.column(0).slice(lo, hi - lo).take(pa.array(own)),
                        batch.column(1).slice(lo, hi - lo).take(pa.array(own)),
                        pa.array(w[turn] - offs[own], pa.int32()),
                        pa.array(w[stop] - offs[own], pa.int32()),
                    ],
                    ["code", "doc", "sub", "first", "last"],
                )

    return rows.mapInArrow(run, "code long, doc long, sub int, first int, last int")


def cover_names(buf: np.ndarray, w: np.ndarray, at: np.ndarray, length: int):
    """(name, index of the window) of the windows that start at w, at[i] their place in their document.

    Difference cover {1, 2} modulo 3: two windows are equal just if they share a name.
    """
    sums = T.prefix_sums(buf)
    m = _SYMBOL
    power = np.array([0xD1342543DE82EF95, 0xAF251AF3B0F025B5, 0x2545F4914F6CDD1D], np.uint64)

    def triple(p, symbol, apart, tag):
        """Name of three symbols, ``apart`` positions from one another."""
        h = np.full(len(p), tag, np.uint64)
        for k in range(3):
            h += symbol(p + k * apart) * power[k]
        return T.mix(h)

    def symbol(p):
        return T.span_hash(sums, p, p + m)

    def name(p):  # of the triple of symbols at a sampled position
        return triple(p, symbol, m, 1)

    def prefix(p, n):  # of the n bytes at a sampled position: a triple of names (two where n is short), and the bytes beyond
        reach = 3 * m
        if n >= 3 * reach:
            whole, done = triple(p, name, reach, 2), 3 * reach
        else:
            whole, done = T.mix(name(p) + name(p + reach) * power[1]), 2 * reach
        return T.mix(whole + T.span_hash(sums, p + done, p + n) * power[2] + np.uint64(n))

    names, rows = [], []
    residue = at % 3
    for before, kinds in ((0, (1, 2)), (1, (0, 1)), (2, (0, 2))):
        # windows whose position ``before`` bytes on is sampled, for pairs that have that distance in common
        i = np.flatnonzero(np.isin(residue, kinds))
        p = w[i]
        names.append(T.mix(prefix(p + before, length - before) + T.span_hash(sums, p, p + before) * power[0] + np.uint64(before)))
        rows.append(i)
    return np.concatenate(names), np.concatenate(rows)


def _names(rows: DataFrame, length: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            firsts, lasts = batch.column(3), batch.column(4)
            for lo, hi, buf, offs in T.blocks(batch.column(2)):
                w = [_windows(firsts[lo + k].values.to_numpy(), lasts[lo + k].values.to_numpy(), int(offs[k])) for k in range(hi - lo)]
                own = np.repeat(np.arange(hi - lo), [len(x) for x in w])
                w = np.concatenate(w)
                code, i = cover_names(buf, w, w - offs[own], length)
                ids, subs = (batch.column(k).slice(lo, hi - lo).to_numpy() for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(T.signed(code)), pa.array(ids[own[i]]), pa.array(subs[own[i]]), pa.array((w - offs[own])[i], pa.int32())], ["name", "doc", "sub", "at"]
                )

    return rows.mapInArrow(run, "name long, doc long, sub int, at int")


def _compared(names: DataFrame) -> DataFrame:
    """(doc, sub, first, last) of the windows whose name the row before has, too."""

    def run(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            name = batch.column(0).to_numpy()
            same = np.append(last is not None and name[0] == last, name[1:] == name[:-1])
            last = name[-1]
            take = pa.array(np.flatnonzero(same))
            yield pa.RecordBatch.from_arrays([batch.column(k).take(take) for k in (1, 2, 3, 3)], ["doc", "sub", "first", "last"])

    return names.mapInArrow(run, "doc long, sub int, first int, last int")


def _documents(docs: DataFrame) -> DataFrame:
    """(doc, sub, text): sub tells different texts under one doc_id apart, 0 but for them; rows alike in both once."""
    rows = keyed(docs)
    each = rows.groupBy("doc").agg(F.count(F.lit(1)).alias("n"), F.min("tkey").alias("a"), F.max("tkey").alias("b"))
    double, different = each.agg(F.coalesce(F.max("n") > 1, F.lit(False)), F.coalesce(F.max(F.col("a") != F.col("b")), F.lit(False))).first()
    if double:
        rows = rows.dropDuplicates(["doc", "tkey"])
    if different:
        order = Window.partitionBy("doc").orderBy("tkey")
        subs = rows.select("doc", "tkey").withColumn("sub", F.row_number().over(order) - 1)
        return rows.join(subs, ["doc", "tkey"]).select("doc", "sub", "tkey", "text")
    return rows.select("doc", F.lit(0).alias("sub"), "tkey", "text")


def _with_text(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """(doc, sub, text, firsts, lasts) of the documents that have ranges."""
    lists = ranges.groupBy("doc", "sub").agg(F.collect_list(F.struct("first", "last")).alias("r"))
    text = maybe_in(docs.select("doc", "sub", "text"), "doc", lists, "doc")
    return text.join(lists, ["doc", "sub"]).select("doc", "sub", "text", F.col("r.first").alias("firsts"), F.col("r.last").alias("lasts"))


def repeated_windows(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc, sub, first, last): ranges of windows of documents (doc, sub, text) that also start earlier."""
    order = ["owner", "context", "doc", "sub", "first"]
    contexts = _contexts(docs, length).repartition("owner").sortWithinPartitions(*order)
    found = materialise(_first_of_context(contexts), "contexts")
    edge = found.where("not again")
    pieces = materialise(_edges(_with_text(docs, edge), length), "edges")
    common = pieces.groupBy("code").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("code")
    left = materialise(pieces.join(common, "code").select("doc", "sub", "first", "last"), "left")
    names = _names(_with_text(docs, left), length).repartition("name").sortWithinPartitions("name", "doc", "sub", "at")
    same = materialise(_compared(names), "compared")
    return found.where("again").select("doc", "sub", "first", "last").union(same)


_RESULT = "doc long, sub int, n_bytes long, n_removed long, n_spans long, starts array<long>, ends array<long>, kept_sha256 string"


def removed_spans(docs: DataFrame, length: int = 100, documents: DataFrame | None = None) -> DataFrame:
    """(doc, sub, n_bytes, n_removed, n_spans, starts, ends, kept_sha256) of the documents that lose bytes."""
    texts = documents if documents is not None else _documents(docs)

    def run(batches):
        for batch in batches:
            firsts, lasts = batch.column(3), batch.column(4)
            for lo, hi, buf, offs in T.blocks(batch.column(2)):
                rows = []
                for k in range(hi - lo):
                    own = buf[offs[k] : offs[k + 1]]
                    edge = np.zeros(len(own) + 1, np.int32)
                    np.add.at(edge, firsts[lo + k].values.to_numpy(), 1)
                    np.add.at(edge, lasts[lo + k].values.to_numpy().astype(np.int64) + length, -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    step = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
                    starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                    rows.append((len(own), int(gone.sum()), len(starts), starts.tolist(), ends.tolist(), hashlib.sha256(own[~gone].tobytes()).hexdigest()))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), batch.column(1).slice(lo, hi - lo), *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]],
                    ["doc", "sub", "n_bytes", "n_removed", "n_spans", "starts", "ends", "kept_sha256"],
                )

    return _with_text(texts, repeated_windows(texts, length)).mapInArrow(run, _RESULT)


def suffix_dedup(docs: DataFrame, length: int = 100) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, starts, ends, kept_sha256) of every row."""
    texts = _documents(docs)
    lost = removed_spans(docs, length, texts).select(
        F.col("doc").alias("d"), F.col("sub").alias("s"), "n_removed", "n_spans", "starts", "ends", "kept_sha256"
    )
    whole = F.col("text").cast("binary")
    every = texts.select("doc", "sub", "tkey", F.octet_length(whole).cast("long").alias("n_bytes"), F.sha2(whole, 256).alias("all_sha256"))
    none = F.array().cast("array<long>")
    done = every.join(lost, (F.col("doc") == F.col("d")) & (F.col("sub") == F.col("s")), "left").select(
        "doc",
        "tkey",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("starts", none).alias("starts"),
        F.coalesce("ends", none).alias("ends"),
        F.coalesce("kept_sha256", "all_sha256").alias("kept_sha256"),
    )
    rows = keyed(docs).select(F.col("doc").alias("d"), F.col("tkey").alias("t"))
    out = rows.join(done, (F.col("d") == F.col("doc")) & (F.col("t") == F.col("tkey")))
    return out.select(id_back("doc").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "starts", "ends", "kept_sha256")
