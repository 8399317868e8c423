"""Substring dedup by hashing lines or paragraphs, and the pieces that content cuts them into.

Every unit is normalised (white space runs to one blank, trimmed, lower case), digested
with SHA-256 and grouped over the whole corpus; the occurrence ranked first (smallest
doc_id, then place) stays, and all later ones of units long enough go. Every unit keeps
its byte offsets in the original text.

A line or a paragraph is a unit where its separators put it, so a passage that begins or
ends inside one is in no equal unit. Pieces are units that passages share wherever they
stand: a text's words are cut where the hash of a word and its successor is the least
(the first of equals) of the ``reach`` ones before and behind it. Such a cut depends on the
words around it alone, so two copies of a passage have the same cuts but near their ends.

The first occurrence of a digest comes from an aggregate that combines in the map tasks,
so a unit of very many copies is no hot group; the join back is one that Spark splits.

Defined results: null and empty texts have no units; shorter and blank units are never
removed; rows alike in id and text count as one document; of different texts under one
doc_id the one with the smaller text hash ranks first; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.llm.linededup import delete_spans, merged
from lakeflux.llm.work import id_back, keyed, materialise, released

SEPARATORS = {"line": b"\n", "paragraph": b"\n\n"}
#: Words of the shortest piece that is removed, and the reach of a cut: pieces have 2 * reach + 1 words on average.
PIECE_WORDS, REACH = 12, 8
_BLANKS = re.compile(rb"[ \t-\r]+")
_WORD = re.compile(rb"[^ \t-\r]+")
_UNITS = "doc long, tkey long, kind string, unit int, start int, end int, digest binary"


def lines(data: bytes, unit: str, min_words: int) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(kind, number, start, end, digest) of the lines or paragraphs of enough words; the separator after a unit belongs to it."""
    sep, start = SEPARATORS[unit], 0
    for k, piece in enumerate(data.split(sep)):
        end = min(start + len(piece) + len(sep), len(data))
        plain = _BLANKS.sub(b" ", piece).strip(b" ")
        if plain and plain.count(b" ") + 1 >= min_words:
            yield unit, k, start, end, hashlib.sha256(plain.decode("utf-8").lower().encode()).digest()
        start = end


def cuts(words: list[bytes], reach: int) -> list[int]:
    """The words (but the first) that begin a piece."""
    if len(words) < 2:
        return []
    code = np.frombuffer(b"".join([hashlib.md5(a + b" " + b).digest()[:8] for a, b in zip(words, words[1:])]), ">u8")
    least = np.ones(len(code), bool)
    for k in range(1, min(reach, len(code) - 1) + 1):
        least[k:] &= code[k:] < code[:-k]
        least[:-k] &= code[:-k] <= code[k:]
    return [i for i in np.flatnonzero(least).tolist() if i]


def pieces(data: bytes, min_words: int = PIECE_WORDS, reach: int = REACH) -> Iterator[tuple[str, int, int, int, bytes]]:
    """(kind, number, start, end, digest) of the pieces of enough words, each up to the next one's first word."""
    low = data.decode("utf-8").lower().encode()
    words, starts = _WORD.findall(low), [m.start() for m in _WORD.finditer(data)]
    edges = [0, *cuts(words, reach), len(words)] if words else []
    for k, (a, b) in enumerate(zip(edges, edges[1:])):
        if b - a >= min_words:
            yield "piece", k, starts[a], starts[b] if b < len(words) else len(data), hashlib.sha256(b" ".join(words[a:b])).digest()


def units(docs: DataFrame, unit: str = "line", min_words: int = 20, piece_words: int | None = None, reach: int = REACH) -> DataFrame:
    """(doc, tkey, kind, unit, start, end, digest) of the units that are long enough to be removed; piece_words: pieces, too, of so many words."""

    def run(batches):
        for part in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for doc, tkey, text in zip(*(c.to_pylist() for c in part.columns)):
                data = text.encode("utf-8")
                out += [(doc, tkey, *u) for u in lines(data, unit, min_words)]
                if piece_words is not None:
                    out += [(doc, tkey, *u) for u in pieces(data, piece_words, reach)]
            cols = list(zip(*out)) or [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["doc", "tkey", "kind", "unit", "start", "end", "digest"])

    return keyed(docs).mapInArrow(released(run), _UNITS)


def repeated_units(docs: DataFrame, unit: str = "line", min_words: int = 20, piece_words: int | None = None, reach: int = REACH) -> DataFrame:
    """(doc, tkey, kind, unit, start, end, digest, first_doc, first_unit): every unit but the first occurrence of its digest among its kind."""
    rows = materialise(units(docs, unit, min_words, piece_words, reach), "units")
    first = rows.groupBy("kind", "digest").agg(F.min(F.struct("doc", "tkey", "unit")).alias("f"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    later = (F.col("doc") != F.col("f.doc")) | (F.col("tkey") != F.col("f.tkey")) | (F.col("unit") != F.col("f.unit"))
    return rows.join(first, ["kind", "digest"]).where(later).select(
        "doc", "tkey", "kind", "unit", "start", "end", "digest", F.col("f.doc").alias("first_doc"), F.col("f.unit").alias("first_unit")
    )


def removed_units(docs: DataFrame, unit: str = "line", min_words: int = 20, piece_words: int | None = None, reach: int = REACH) -> DataFrame:
    """(doc_id, kind, unit, start, length, first_doc_id, first_unit) of every removed unit; start and length in bytes of the original text."""
    out = repeated_units(docs, unit, min_words, piece_words, reach)
    return out.select(
        id_back("doc").alias("doc_id"),
        "kind",
        "unit",
        F.col("start").cast("long").alias("start"),
        (F.col("end") - F.col("start")).cast("long").alias("length"),
        id_back("first_doc").alias("first_doc_id"),
        "first_unit",
    )


def dedup_units(docs: DataFrame, unit: str = "line", min_words: int = 20, drop_emptied: bool = False, piece_words: int | None = None, reach: int = REACH) -> DataFrame:
    """docs without later occurrences of repeated units."""
    return delete_spans(docs, merged(repeated_units(docs, unit, min_words, piece_words, reach)), drop_emptied)
