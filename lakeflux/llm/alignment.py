"""Cross-tokenizer alignment: which tokens of two tokenizers stand for the same bytes, and how often corpus-wide.

Inside a task everything is Arrow: the id lists of a block of texts are flattened, their
parent indices name the document, and segmented cumulative sums of token lengths give each
token's end. The key (document, end) is one number, the end's place in the block. An Acero
hash join (full outer) of both tokenizers' keys gives the alignment: where both end, a
group ends; and every key that either has is one link, as the pieces between neighbouring
ends lie in exactly one token of each side. ``Table.group_by`` counts a block's id pairs,
and Spark merges these partial counts.

A second pass adds up, for each document, the corpus-wide counts of its links. A block has
written its links as ordinals in its own list of distinct pairs (two bytes a link, four
where the list is longer), so that only these lists are joined with the counts; they meet
their block's documents again by the block's number.

Defined results: a null or empty text, and one whose tokens do not spell it (byte by byte,
for either tokenizer), has no tokens: zeros, and '' for its groups; repeated rows are
documents of their own; a null doc_id stays null; an empty table gives no rows; further
columns are ignored. A task holds one block: about ``BLOCK_BYTES`` of text, or one longer text.
"""

from __future__ import annotations

import functools
import hashlib
import json
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.llm.work import materialise, released

BLOCK_BYTES = 1 << 20
#: A pair is one long: the first tokenizer's id times this, plus the second's.
SHIFT = 1 << 31
_LETTERS = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: bytes that print, then 256, 257, ... for the others."""
    rest = [b for b in range(256) if b not in set(_LETTERS)]
    return {chr(b): b for b in _LETTERS} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteLevel:
    """A byte-level BPE file: ids of `` text``, and the bytes of each id.

    Where the file's pre-tokeniser is the plain byte-level one and its merges make the ids in
    their order, a faster library that is given the same vocabulary encodes; else the file's own.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        vocab = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        byte_of = byte_letters()
        spelled = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()} | {i: t.encode() for t, i in special.items()}
        self.spelling = pa.array([spelled.get(i, b"") for i in range(max(spelled) + 1)], pa.binary())
        self.fast = self._fast(spec, vocab, {t: i for i, t in spelled.items() if i not in special.values()})

    @functools.cached_property
    def own(self):
        """The file as its own library reads it."""
        from tokenizers import Tokenizer

        own = Tokenizer.from_file(self.path)
        own.encode_special_tokens = True  # their strings in a text are plain text
        return own

    @staticmethod
    def _fast(spec: dict, vocab: dict[str, int], ranks: dict[bytes, int]):
        import tiktoken

        pre, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not spec.get("normalizer")
        extra = any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocab.get("".join(m), -1) for m in merges]
        in_order = made == sorted(set(made)) and len(made) + 256 == len(ranks) and (not made or made[0] >= 256)
        if not plain or extra or not in_order:
            return None
        # the pre-tokeniser's fixed pattern
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, texts: list[str]) -> list:
        if self.fast is not None:
            return [self.fast.encode_to_numpy(" " + t, disallowed_special=()) for t in texts]
        return [np.array(self.own.encode(" " + t, add_special_tokens=False).ids, np.uint32) for t in texts]


class Pieces:
    """A sentence-piece model, which adds the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        m = self.model
        spelled = [bytes([int(m.id_to_piece(i)[3:-1], 16)]) if m.is_byte(i) else m.id_to_piece(i).replace("▁", " ").encode() for i in range(m.get_piece_size())]
        self.spelling = pa.array(spelled, pa.binary())

    def __call__(self, texts: list[str]) -> list:
        return self.model.encode(texts, num_threads=1)


def id_lists(encoded: list) -> pa.ListArray:
    """One list of ids a document."""
    sizes = np.fromiter(map(len, encoded), np.int64, len(encoded))
    flat = np.concatenate([np.asarray(e, np.int32) for e in encoded]) if len(encoded) else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(flat, pa.int32()))


class Side:
    """The tokens of one tokenizer in a block: flat ids, their documents, their ends within the document."""

    def __init__(self, lists: pa.ListArray, spelling: pa.Array, sizes: np.ndarray):
        self.n_docs, self.spelling = len(lists), spelling
        self.ids = pc.list_flatten(lists)
        self.doc = pc.list_parent_indices(lists)
        self.length = pc.take(sizes, self.ids)
        total = pc.cumulative_sum(self.length) if len(self.ids) else self.length
        # segmented: each document's sums start at its first token
        at = lists.offsets.to_numpy()
        running = np.append(0, total.to_numpy(zero_copy_only=False))
        self.doc_bytes = running[at[1:]] - running[at[:-1]]
        self.end = pc.subtract(total, pc.take(pa.array(running[at[:-1]]), self.doc)) if len(self.ids) else total

    def bytes(self) -> np.ndarray:
        """What all tokens spell."""
        spelled = pc.take(self.spelling, self.ids)
        at = np.frombuffer(spelled.buffers()[1], np.int32)[spelled.offset : spelled.offset + len(spelled) + 1]
        return np.frombuffer(spelled.buffers()[2] or b"", np.uint8)[at[0] : at[-1]] if len(spelled) else np.zeros(0, np.uint8)


def misspelt(side: Side, want: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which documents' tokens do not spell their bytes (want, cut by starts)."""
    wrong = side.doc_bytes != np.diff(starts)
    got, at = side.bytes(), np.append(0, np.cumsum(side.doc_bytes))
    if not wrong.any():
        bad = np.flatnonzero(got != want)
        wrong[np.unique(np.searchsorted(starts, bad, "right") - 1)] = True
        return wrong
    for d in np.flatnonzero(~wrong).tolist():  # lengths differ somewhere: document by document
        wrong[d] = not np.array_equal(got[at[d] : at[d + 1]], want[starts[d] : starts[d + 1]])
    return wrong


class Aligned:
    """Links and groups of a block whose tokens spell their texts. starts: the documents' places in the block, and its end."""

    def __init__(self, a: Side, b: Side, starts: np.ndarray):
        base = pa.array(starts[:-1])
        tables = []
        for side, name in ((a, "a"), (b, "b")):
            key = pc.add(side.end, pc.take(base, side.doc))  # (document, end) as the end's place in the block
            tables.append(pa.table({"key": key, name: pa.array(np.arange(len(side.ids), dtype=np.int32))}))
        both = tables[0].join(tables[1], keys="key", join_type="full outer", use_threads=False).sort_by("key")
        place = {}
        for name in "ab":  # a piece of text lies in the first token that ends at its end or after it
            col = both[name].combine_chunks()
            at = col.fill_null(np.iinfo(np.int32).max).to_numpy()
            place[name] = np.minimum.accumulate(at[::-1])[::-1]
        self.a, self.b = place["a"], place["b"]
        self.ends_group = pc.and_(both["a"].is_valid(), both["b"].is_valid()).combine_chunks().to_numpy(zero_copy_only=False)
        self.doc = a.doc.to_numpy()[self.a] if len(self.a) else np.zeros(0, np.int64)
        self.pair = a.ids.to_numpy()[self.a].astype(np.int64) * SHIFT + b.ids.to_numpy()[self.b]


def pair_counts(pairs: np.ndarray) -> pa.Table:
    """(pair, n) of a block, most frequent first."""
    table = pa.table({"pair": pa.array(pairs, pa.int64())})
    return table.group_by("pair", use_threads=False).aggregate([([], "count_all")]).rename_columns(["pair", "n"]).sort_by([("n", "descending"), ("pair", "ascending")])


def group_texts(a: Side, b: Side, links: Aligned, numerals: pa.Array, n_ids: int) -> tuple[np.ndarray, np.ndarray]:
    """``a1,a2|b1;a3|b2,b3`` of all documents in one byte array, and the offsets that cut it.

    numerals: each id as a decimal with "," behind it, then with "|", ";" and nothing.
    """
    done = np.cumsum(links.ends_group) - links.ends_group  # the group of each link
    group_a, group_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
    group_a[links.a], group_b[links.b] = done, done
    ids = np.concatenate([a.ids.to_numpy(), b.ids.to_numpy()])
    doc = np.concatenate([a.doc.to_numpy(), b.doc.to_numpy()])
    slot = np.concatenate([2 * group_a, 2 * group_b + 1])
    order = np.argsort(slot, kind="stable")
    slot, ids, doc = slot[order], ids[order], doc[order]
    last = np.append(slot[1:] != slot[:-1], True) if len(slot) else np.zeros(0, bool)
    ends = np.append(doc[1:] != doc[:-1], True) if len(doc) else last
    mark = np.where(ends, 3, np.where(last, 1 + (slot & 1), 0))
    text = pc.take(numerals, pa.array(mark * n_ids + ids))
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8) if len(text) else np.zeros(0, np.uint8)
    at = np.frombuffer(text.buffers()[1], np.int32)[: len(text) + 1] if len(text) else np.zeros(1, np.int32)
    return data, at[np.searchsorted(doc, np.arange(a.n_docs + 1))]


class Aligner:
    """Both tokenizers and what is looked up in them, for one task."""

    def __init__(self, first: Callable, second: Callable):
        self.first, self.second = first, second
        self.sizes = [pc.binary_length(t.spelling).cast(pa.int64()) for t in (first, second)]
        self.n_ids = max(len(first.spelling), len(second.spelling))
        self.numerals = pa.array([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(self.n_ids)], pa.binary())

    def _sides(self, texts: list[str]) -> tuple[Side, Side]:
        return tuple(Side(id_lists(t(texts)), t.spelling, n) for t, n in zip((self.first, self.second), self.sizes))

    def block(self, data: np.ndarray, offs: np.ndarray) -> dict:
        """Columns of a block's documents, and its list of pairs."""
        n = len(offs) - 1
        zero, none = np.zeros(n, np.int64), [None] * n
        out = {"n_a": zero, "n_b": zero, "n_groups": zero, "n_links": zero, "groups_sha256": [""] * n, "links": none, "pairs": np.zeros(0, np.int64), "ns": np.zeros(0, np.int64)}
        rows = np.flatnonzero(np.diff(offs))
        if not len(rows):
            return out
        raw = data.tobytes()
        texts = [raw[offs[r] : offs[r + 1]].decode("utf-8") for r in rows.tolist()]
        sides = self._sides(texts)
        while True:
            want = np.frombuffer(b"".join(b" " + t.encode() for t in texts), np.uint8)
            starts = np.append(0, np.cumsum([offs[r + 1] - offs[r] + 1 for r in rows.tolist()])).astype(np.int64)
            wrong = misspelt(sides[0], want, starts) | misspelt(sides[1], want, starts)
            if not wrong.any():
                break
            rows, texts = rows[~wrong], [t for t, w in zip(texts, wrong) if not w]
            if not len(rows):
                return out
            sides = self._sides(texts)
        a, b = sides
        links = Aligned(a, b, starts)
        counts = pair_counts(links.pair)
        ordinal = pc.index_in(pa.array(links.pair), value_set=counts["pair"].combine_chunks()).to_numpy()
        code = ordinal.astype("<u2" if len(counts) <= 1 << 16 else "<u4")
        cut = np.searchsorted(links.doc, np.arange(len(rows) + 1)).tolist()
        text, at = group_texts(a, b, links, self.numerals, self.n_ids)
        for k, v in (("n_a", a.doc), ("n_b", b.doc), ("n_groups", links.doc[links.ends_group]), ("n_links", links.doc)):
            out[k] = zero.copy()
            out[k][rows] = np.bincount(np.asarray(v), minlength=len(rows))
        sha, held = [""] * n, [None] * n
        for i, r in enumerate(rows.tolist()):
            sha[r] = hashlib.sha256(text[at[i] : at[i + 1]].tobytes()).hexdigest()
            held[r] = code[cut[i] : cut[i + 1]].tobytes()
        return out | {"groups_sha256": sha, "links": held, "pairs": counts["pair"].to_numpy(), "ns": counts["n"].to_numpy()}


_BLOCKS = "block long, kind int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary, pairs array<long>, ns array<long>"
_KINDS = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
_NAMES = [f.split(" ")[0] for f in _BLOCKS.split(", ")]


def align_blocks(docs: DataFrame, first: Callable[[], Callable], second: Callable[[], Callable]) -> DataFrame:
    """Rows of documents (kind 1) and, one a block, of its distinct pairs and their counts (kind 0)."""

    def run(batches):
        aligner, number = Aligner(first(), second()), 0  # a task's own: no worker keeps them
        part = TaskContext.get().partitionId() << 32
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, offs in T.blocks(batch.column(1), BLOCK_BYTES):
                out, n, block = aligner.block(data, offs), hi - lo, part + number
                number += 1
                head = [[block], [0], *[[None]] * 7, [out["pairs"]], [out["ns"]]]
                rest = [np.full(n, block), np.ones(n, np.int32), ids[lo:hi], *(out[k] for k in _NAMES[3:9]), [None] * n, [None] * n]
                for cols in (head, rest):
                    yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, _KINDS)], _NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(released(run), _BLOCKS)


def pair_table(places: DataFrame) -> DataFrame:
    """(pair, count, best) corpus-wide; best: no pair of its second id is counted more often."""
    counts = places.groupBy("pair").agg(F.sum("n").alias("count"))
    second = F.col("pair") % SHIFT
    top = counts.groupBy(second.alias("second")).agg(F.max("count").alias("top"))
    return counts.join(top, second == F.col("second")).select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def _add_up(blocks: DataFrame) -> DataFrame:
    """Rows sorted by (block, kind) in each task: a block's counts and flags, then its documents."""
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def run(batches):
        counts = best = None
        for batch in batches:
            kind = batch.column("kind").to_numpy()
            edges = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])).tolist() + [len(kind)]
            for lo, hi in zip(edges, edges[1:]):
                if kind[lo] == 0:
                    counts = batch.column("counts")[lo].values.to_numpy()
                    best = batch.column("bests")[lo].values.to_numpy(zero_copy_only=False)
                    continue
                rows = batch.slice(lo, hi - lo)
                n_best, total = np.zeros(hi - lo, np.int64), np.zeros(hi - lo, np.int64)
                for i, links in enumerate(rows.column("links")):
                    if links.is_valid:
                        at = np.frombuffer(links.as_buffer(), "<u2" if len(counts) <= 1 << 16 else "<u4")
                        n_best[i], total[i] = best[at].sum(), counts[at].sum()
                cols = [rows.column(c) for c in kept] + [pa.array(n_best), pa.array(total), rows.column("groups_sha256")]
                yield pa.RecordBatch.from_arrays(cols, [*kept, "n_best", "count_sum", "groups_sha256"])

    return blocks.mapInArrow(released(run), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align(docs: DataFrame, first: Callable[[], Callable], second: Callable[[], Callable]) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every document.

    first, second: make a tokenizer in a task, such as ``ByteLevel`` or ``Pieces`` of a file's path.
    """
    blocks = materialise(align_blocks(docs, first, second), "blocks")
    each = blocks.where(F.col("kind") == 0).select("block", F.posexplode(F.arrays_zip("pairs", "ns")).alias("ord", "p"))
    places = each.select("block", "ord", F.col("p.pairs").alias("pair"), F.col("p.ns").alias("n"))
    table = materialise(pair_table(places), "pairs")
    back = places.join(table, "pair").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("ord", "count", "best"))).alias("v"))
    # a block without any links has no list; its documents need none
    heads = back.select("block", F.lit(0).alias("kind"), F.col("v.count").alias("counts"), F.col("v.best").alias("bests"))
    rows = blocks.where(F.col("kind") == 1).drop("pairs", "ns")
    both = rows.unionByName(heads, allowMissingColumns=True)
    return _add_up(both.repartition("block").sortWithinPartitions("block", "kind"))
