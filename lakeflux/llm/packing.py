"""Best-fit packing of tokenised documents into sequences of at most ``max_len`` tokens.

Method: length-histogram planning. Spark tokenises and counts pieces by length;
best fit runs over those counts (at most ``max_len`` numbers, whatever the
corpus), which yields slots "pieces of length L with ranks a..b stand in sequences
s.. at offset o"; the pieces then take their slots by their rank within their length.

Defined results: a null text is an empty text and so the end token alone; repeated
rows are documents of their own; an empty table gives no rows; a null doc_id stays
null; further columns are ignored. Equal lengths take slots in any order.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.llm.work import materialise, released

#: Slots of a task's table of encoded words; a word whose slot is taken is encoded each time it comes.
TABLE_BITS = 20
#: Ids that the table's words may hold together; then new words are encoded each time they come.
POOL_IDS = 1 << 22


class BlockEncoder:
    """Token ids of whole texts by a byte-level BPE file.

    The vocabulary's pre-tokeniser never joins text across a single space or line end
    between two non-space characters. Texts with no other white space are therefore
    encoded word by word: a block's words are hashed and looked up together, and its
    unknown words go through one call of a faster encoder that is given the same
    vocabulary. All other texts, and those that hold an added token of the file, go
    whole through the file's own library, as loaded. Tests hold the two equal.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        # the file spells bytes by letters: those that print, then 256, 257, ... for the others
        printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in set(printable)]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}
        assert set(byte_of) == set(pre_tokenizers.ByteLevel.alphabet())
        special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        self.marks = [t.encode() for t in special if t]
        ranks = {bytes(byte_of[c] for c in t): i for t, i in self.tok.get_vocab().items() if t not in special}
        # the pre-tokeniser's fixed pattern
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.fast = tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.begins = np.zeros(max(ranks.values()) + 1, bool)
        self.begins[[i for t, i in ranks.items() if t[:1] in (b" ", b"\n")]] = True
        self.key = np.zeros(1 << TABLE_BITS, np.uint64)  # 0: free
        self.first = np.zeros(1 << TABLE_BITS, np.int64)  # place in the pool of ids
        self.count = np.zeros(1 << TABLE_BITS, np.int32)
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0

    @staticmethod
    def _odd(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Which texts hold white space other than single spaces and line ends between other characters."""
        n, odd = len(buf), np.zeros(len(offs), bool)
        kind = _SPACE[buf]
        at = [np.flatnonzero(kind == 2)]
        lead = np.flatnonzero(kind == 3)
        if len(lead):  # white space of two or three bytes
            padded = np.concatenate([buf, np.zeros(2, np.uint8)]).astype(np.int32)
            two = padded[lead] << 8 | padded[lead + 1]
            at.append(lead[np.isin(two, _SPACE_2) | np.isin(two << 8 | padded[lead + 2], _SPACE_3)])
        white = np.flatnonzero(kind == 1)
        full = np.flatnonzero(np.diff(offs))
        edge = np.zeros(n + 1, bool)
        edge[offs[:-1][full]] = True
        edge[n] = True
        gap = np.zeros(n + 1, bool)
        gap[white] = True
        gap[n] = True
        at.append(white[edge[white] | edge[white + 1] | gap[white + 1]])
        odd[np.searchsorted(offs, np.concatenate(at), "right") - 1] = True
        return odd[:-1]

    def _marked(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        """Which texts hold what an added token stands for."""
        marked, data = np.zeros(len(offs) - 1, bool), buf.tobytes()
        for mark in self.marks:
            at = data.find(mark)
            while at >= 0:
                marked[np.searchsorted(offs, at, "right") - 1] = True
                at = data.find(mark, at + 1)
        return marked

    def _unknown(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, line: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of these words in one array, and the offsets that cut it."""
        data = buf.tobytes()
        text = b"".join([(b"\n" if nl else b" ") + data[a:b] for a, b, nl in zip(starts.tolist(), ends.tolist(), line.tolist())])
        ids = np.array(self.fast.encode_ordinary(text.decode("utf-8")), np.uint32)
        return ids, np.append(np.flatnonzero(self.begins[ids]), len(ids))

    def _room(self, n: int) -> None:
        if self.used + n > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(n, len(self.pool)), np.uint32)])

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the block's texts in one array, and the offsets that cut it into texts."""
        odd = self._odd(buf, offs) | self._marked(buf, offs)
        starts, ends, doc = T.words(buf, offs, ~(_SPACE == 1))
        plain = ~odd[doc]
        starts, ends, doc = starts[plain], ends[plain], doc[plain]
        head = starts == offs[doc]  # the first word: encoded as after a line end, whose token is dropped
        line = head | (buf[np.maximum(starts - 1, 0)] == 10)
        h = T.span_hash(T.prefix_sums(buf), starts, ends) ^ (line.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        h[h == 0] = 1
        slot = (h >> np.uint64(64 - TABLE_BITS)).astype(np.int64)
        hit = self.key[slot] == h
        where, count = self.first[slot], self.count[slot]
        miss = np.flatnonzero(~hit)
        keep = self.used
        if len(miss):
            u, one, back = np.unique(h[miss], return_index=True, return_inverse=True)
            some = miss[one]
            ids, cut = self._unknown(buf, starts[some], ends[some], line[some])
            self._room(len(ids))
            self.pool[keep : keep + len(ids)] = ids
            where[miss], count[miss] = (keep + cut[:-1])[back], np.diff(cut)[back]
            # words that get a slot stay in the pool: these first
            _, lead = np.unique(slot[some], return_index=True)
            new = lead[self.key[slot[some[lead]]] == 0]
            self.key[slot[some[new]]], self.count[slot[some[new]]] = u[new], np.diff(cut)[new]
            self.first[slot[some[new]]] = keep + cut[:-1][new]
            self.used += len(ids) if len(new) * 4 > len(u) and keep + len(ids) <= POOL_IDS else 0
            if not self.used > keep and len(new):
                self.key[slot[some[new]]] = 0  # too few to keep their ids
        size = np.bincount(doc, count, minlength=len(offs) - 1).astype(np.int64) - (np.diff(offs) > 0) * ~odd
        total = np.cumsum(count)
        at = np.arange(total[-1] if len(total) else 0) + np.repeat(where - (total - count), count)
        drop = (total - count)[head]  # the line end's token
        out = self.pool[np.delete(at, drop)]
        whole = np.flatnonzero(odd)
        if len(whole):
            data = buf.tobytes()
            parts, a, ends_plain = [], 0, np.cumsum(size)
            for d in whole.tolist():
                b = int(ends_plain[d])
                ids = np.array(self.tok.encode(data[offs[d] : offs[d + 1]].decode("utf-8"), add_special_tokens=False).ids, np.uint32)
                parts += [out[a:b], ids]
                size[d] = len(ids)
                a = b
            out = np.concatenate([*parts, out[a:]])
        return out, np.append(0, np.cumsum(size))


# fixed values: Unicode white space in UTF-8; 1: space and line end, 2: others of one byte, 3: may begin one of several bytes
_SPACE = np.zeros(256, np.uint8)
_SPACE[[0x20, 0x0A]] = 1
_SPACE[[0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F]] = 2
_SPACE[[0xC2, 0xE1, 0xE2, 0xE3]] = 3
_SPACE_2 = np.array([0xC285, 0xC2A0])
_SPACE_3 = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])

_PIECES = "part_rank long, doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, max_len: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """One row a piece; part_rank is its rank among the pieces of its length in its task."""
    schema = _PIECES + (", ids binary" if with_ids else "")
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches):
        encoder, seen = BlockEncoder(tokenizer_path), np.zeros(max_len + 1, np.int64)  # a task's own: no worker keeps it
        for batch in batches:
            doc_ids = batch.column(0)
            for lo, hi, buf, offs in T.blocks(batch.column(1)):
                ids, cut = encoder.encode(buf, offs)
                data, rows = ids.astype("<u4").tobytes(), []
                for doc_id, a, b in zip(doc_ids[lo:hi].to_pylist(), (cut * 4).tolist(), (cut[1:] * 4).tolist()):
                    code = data[a:b] + end
                    n = len(code) // 4
                    first = n % max_len or max_len
                    start = 0
                    for k in range(-(-n // max_len)):
                        stop = first + k * max_len
                        own = code[4 * start : 4 * stop]
                        rows.append((int(seen[stop - start]), doc_id, k, start, stop - start, zlib.crc32(own), own))
                        seen[stop - start] += 1
                        start = stop
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                names = ["part_rank", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
                k = len(names) if with_ids else len(names) - 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:k], kinds[:k])], names[:k])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(released(run), schema)


def plan_slots(counts: dict[int, int], max_len: int) -> pd.DataFrame:
    """Best fit, longest first, over counts by length.

    Rows (length, rank, n, sequence, offset): the n pieces of that length from that rank on
    stand in sequences sequence, sequence + 1, ... at that offset.
    """
    room: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs of sequences (first, how many)
    free: list[int] = []  # its keys, ascending
    out, next_seq = [], 0

    def put(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in room:
                room[space] = []
                insort(free, space)
            room[space].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(free, length)
            if at == len(free):
                per = max_len // length
                space, first, n = max_len, next_seq, -(-left // per)
                next_seq += n
            else:
                space = free[at]
                first, n = room[space].pop()
                if not room[space]:
                    del room[space], free[at]
                per = space // length
            full = min(n, left // per)
            for j in range(per):
                if full:
                    out.append((length, rank, full, first, max_len - space + j * length))
                    rank += full
            left -= full * per
            put(space - per * length, first, full)
            if full < n:  # the next one takes what is left, fewer than per; the others stay as they are
                for j in range(left):
                    out.append((length, rank, 1, first + full, max_len - space + j * length))
                    rank += 1
                put(space - left * length, first + full, 1)
                put(space, first + full + 1, n - full - 1)
                left = 0
    return pd.DataFrame(out, columns=["length", "rank", "n", "sequence", "offset"]).astype("int64")


def pack(docs: DataFrame, tokenizer_path: str, max_len: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset (and the ids, as little-endian unsigned 32 bit, if with_ids).

    Only documents longer than max_len are cut; the first piece takes the remainder.
    """
    pieces = materialise(tokenize_pieces(docs, tokenizer_path, max_len, end_id, with_ids).withColumn("part", F.spark_partition_id()), "pieces")
    by_part = pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    # at most max_len rows reach the driver, whatever the corpus
    counts = {int(r.length): int(r.n) for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_slots(counts, max_len).sort_values(["length", "rank"])
    before = by_part.select(
        "part", "length", F.expr("sum(n) over (partition by length order by part rows between unbounded preceding and 1 preceding)").alias("before")
    )
    ranked = pieces.join(before, ["part", "length"], "left").withColumn("rank", F.col("part_rank") + F.coalesce("before", F.lit(0)))
    key_of = lambda length, rank: length * np.int64(1 << 50) + rank
    keys = key_of(plan.length.to_numpy(), plan["rank"].to_numpy())
    rank0, seq0, off0 = (plan[c].to_numpy() for c in ("rank", "sequence", "offset"))
    kept = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "") + ", sequence_id long, offset long"

    def place(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            i = np.searchsorted(keys, key_of(length, rank), "right") - 1
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in kept] + [pa.array(seq0[i] + rank - rank0[i]), pa.array(off0[i])], [*kept, "sequence_id", "offset"]
            )

    return ranked.select(*kept, "rank").mapInArrow(place, schema)
