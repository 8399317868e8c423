"""Line dedup by winnowing over line hashes.

A document is its sequence of non-blank lines, each trimmed and hashed. Of every
``window`` lines in a row the one with the smallest hash is a fingerprint, as is each
line of ``min_words`` words or more and, for deletion, the hash of every shortest run of lines that
reaches ``min_words``, from its first line on or from its last line back. Every
occurrence of a fingerprint is joined with its first one (smallest doc_id, then place;
never with all others, so a line or run of g copies makes g - 1 links), the match is
extended both ways over equal lines, and a run of at least ``min_words`` words is deleted
at its later place.

No such run is left in then: each of its lines lies in a shortest run within it, which stands
earlier, too, so its first place is an earlier one, whatever the context there.

Defined results: null and empty texts have no lines and nothing to delete; rows alike
in doc_id and text count as one document and lose the same runs; of different texts
under one doc_id the one with the smaller text hash comes first; an empty table gives
no rows. Deletion keeps every column and row, with text without the deleted lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.llm.work import attach, id_back, keyed, materialise

_LINE = np.ones(256, bool)
_LINE[10] = False


def lines_of(buf: np.ndarray, offs: np.ndarray):
    """Trimmed start and end, document, and number of words of every non-blank line."""
    starts, ends, doc = T.words(buf, offs, _LINE)
    solid = np.flatnonzero(T.NON_SPACE[buf])
    if not len(starts) or not len(solid):
        z = np.zeros(0, np.int64)
        return z, z, z, z
    first, last = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    some = first < last
    starts, ends, doc = solid[first[some]], solid[last[some] - 1] + 1, doc[some]
    begin = T.words(buf, offs, T.NON_SPACE)[0]
    return starts, ends, doc, np.searchsorted(begin, ends) - np.searchsorted(begin, starts)


def winnow(h: np.ndarray, doc: np.ndarray, window: int) -> np.ndarray:
    """Which codes are the smallest (the last of equals) of some window of their document; all of documents shorter than a window."""
    n = len(h)
    picked = np.zeros(n, bool)
    if not n:
        return picked
    sizes = np.bincount(doc)
    picked[sizes[doc] < window] = True
    m = n - window + 1
    if m > 0:
        whole = doc[:m] == doc[window - 1 :]
        turned = np.stack([h[i : i + m] for i in range(window - 1, -1, -1)])
        at = np.arange(m) + window - 1 - turned.argmin(0)
        picked[at[whole]] = True
    return picked


def shortest_runs(h: np.ndarray, n_words: np.ndarray, cut: np.ndarray, doc: np.ndarray, min_words: int):
    """First line and hash of the runs of two lines or more that reach min_words and, without their
    last line or without their first, do not; in order. cut: the documents' first lines, and the end."""
    total = np.append(0, np.cumsum(n_words))
    line = np.arange(len(h))
    end = np.searchsorted(total, total[:-1] + min_words)
    begin = np.searchsorted(total, total[1:] - min_words, "right") - 1
    down, up = end <= cut[doc + 1], begin >= cut[doc]
    runs = np.unique(np.stack([np.append(line[down], begin[up]), np.append(end[down], line[up] + 1)]), axis=1)
    a, b = runs[:, runs[1] - runs[0] > 1]
    return a, T.span_hash(T.prefix_sums(h), a, b)


_LINES = (
    "doc long, tkey long, hashes array<long>, words array<int>, starts array<int>, picks array<int>, "
    "run_hashes array<long>, run_picks array<int>, n_bytes int"
)


def line_table(docs: DataFrame, window: int, min_words: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for lo, hi, buf, offs in T.blocks(batch.column(2)):
                starts, ends, doc, n_words = lines_of(buf, offs)
                h = T.span_hash(T.prefix_sums(buf), starts, ends)
                cut = T.slices(h, doc, hi - lo)
                picks = np.flatnonzero(winnow(h, doc, window) | (n_words >= min_words))
                runs, run_h = shortest_runs(h, n_words, cut, doc, min_words)
                run_cut = np.searchsorted(runs, cut)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        T.list_array(cut, T.signed(h), pa.int64()),
                        T.list_array(cut, n_words, pa.int32()),
                        T.list_array(cut, starts - offs[doc], pa.int32()),
                        T.list_array(np.searchsorted(picks, cut), picks - cut[doc[picks]], pa.int32()),
                        T.list_array(run_cut, T.signed(run_h), pa.int64()),
                        T.list_array(run_cut, runs - cut[doc[runs]], pa.int32()),
                        pa.array(np.diff(offs), pa.int32()),
                    ],
                    ["doc", "tkey", "hashes", "words", "starts", "picks", "run_hashes", "run_picks", "n_bytes"],
                )

    return keyed(docs).mapInArrow(run, _LINES)


_RUNS = "doc long, tkey long, first_line int, n_lines int, n_words int, start int, end int, source_doc long, source_line int"


def repeated_runs(docs: DataFrame, window: int = 2, min_words: int = 30, whole: bool = False) -> DataFrame:
    """(doc, tkey, first_line, n_lines, n_words, start, end, source_doc, source_line): runs of lines that stand
    at an earlier place, too; start and end are byte offsets, end that of the next line. whole: all of them,
    by the hashes of shortest runs, too; else those that the fingerprints of single lines lead to."""
    table = materialise(line_table(docs, window, min_words), "lines")
    lines = F.transform("picks", lambda at: F.struct(F.element_at("hashes", at + 1).alias("h"), at.alias("at")))
    runs = F.arrays_zip(F.col("run_hashes").alias("h"), F.col("run_picks").alias("at"))
    prints = table.select("doc", "tkey", F.explode(F.concat(lines, runs) if whole else lines).alias("p")).select("p.h", "doc", "tkey", "p.at")
    first = prints.groupBy("h").agg(F.min(F.struct("doc", "tkey", "at")).alias("f"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    links = (
        prints.join(first, "h")
        .where((F.col("doc") != F.col("f.doc")) | (F.col("tkey") != F.col("f.tkey")) | (F.col("at") != F.col("f.at")))
        .groupBy("doc", "tkey", F.col("f.doc").alias("sdoc"), F.col("f.tkey").alias("stkey"), (F.col("at") - F.col("f.at")).alias("shift"))
        .agg(F.collect_set("at").alias("at"))
    )
    one = table.dropDuplicates(["doc", "tkey"])
    sources = one.select(F.col("doc").alias("sdoc"), F.col("tkey").alias("stkey"), F.col("hashes").alias("shashes"))
    rows = links.join(sources, ["sdoc", "stkey"]).join(one.drop("picks", "run_hashes", "run_picks"), ["doc", "tkey"])

    def extend(batches):
        for part in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            out = []
            for r in part.to_pylist():
                b, a, s = np.array(r["hashes"], np.int64), np.array(r["shashes"], np.int64), r["shift"]
                lo, hi = max(0, s), min(len(b), len(a) + s)
                same = np.zeros(hi - lo + 2, np.int8)
                same[1:-1] = b[lo:hi] == a[lo - s : hi - s]
                step = np.diff(same)
                begin, end = np.flatnonzero(step == 1) + lo, np.flatnonzero(step == -1) + lo
                for k in np.unique(np.searchsorted(begin, np.array(r["at"]), "right") - 1).tolist():
                    i, j = int(begin[k]), int(end[k])
                    n = sum(r["words"][i:j])
                    if n >= min_words:
                        stop = r["starts"][j] if j < len(b) else r["n_bytes"]
                        out.append((r["doc"], r["tkey"], i, j - i, n, r["starts"][i], stop, r["sdoc"], i - s))
            cols = list(zip(*out)) or [[]] * 9
            kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.int64(), pa.int32()]
            names = ["doc", "tkey", "first_line", "n_lines", "n_words", "start", "end", "source_doc", "source_line"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names)

    return rows.select("doc", "tkey", "hashes", "words", "starts", "n_bytes", "shift", "at", "shashes", "sdoc").mapInArrow(extend, _RUNS)


def merged(runs: DataFrame) -> DataFrame:
    """(doc, tkey, spans): the runs of a document as disjoint spans (start, end), in order."""
    ordered = F.array_sort(F.collect_set(F.struct("start", "end")))
    fold = F.aggregate(
        ordered,
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["start"]),
            F.concat(
                F.slice(acc, F.lit(1), F.size(acc) - 1),
                F.array(F.struct(F.try_element_at(acc, F.lit(-1))["start"].alias("start"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], x["end"]).alias("end"))),
            ),
        ).otherwise(F.concat(acc, F.array(x))),
    )
    return runs.groupBy("doc", "tkey").agg(fold.alias("spans"))


def delete_spans(docs: DataFrame, spans: DataFrame, drop_emptied: bool = False) -> DataFrame:
    """docs without the bytes of spans(doc, tkey, spans); drop_emptied: without documents that lose all but white space."""
    rows = attach(docs, spans)
    whole = F.col("text").cast("string").cast("binary")
    gone = F.col("__llm_spans")
    starts = F.concat(F.array(F.lit(0)), F.transform(gone, lambda x: x["end"]))
    ends = F.concat(F.transform(gone, lambda x: x["start"]), F.array(F.octet_length(whole)))
    parts = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda x: F.substring(whole, x["a"] + 1, x["b"] - x["a"]))
    kept = F.decode(F.aggregate(parts, F.lit(b""), lambda acc, x: F.concat(acc, x)), "utf-8")
    out = rows.select(*[F.when(gone.isNull(), F.col(c)).otherwise(kept).alias(c) if c.lower() == "text" else docs[c] for c in docs.columns], gone.isNotNull().alias("__llm_cut"))
    if drop_emptied:
        out = out.where(~F.col("__llm_cut") | F.col("text").rlike(r"\S"))
    return out.drop("__llm_cut")


def dedup_lines(docs: DataFrame, window: int = 2, min_words: int = 30, drop_emptied: bool = False) -> DataFrame:
    """docs without later repeated runs of lines."""
    return delete_spans(docs, merged(repeated_runs(docs, window, min_words, whole=True)), drop_emptied)


def deleted_spans(docs: DataFrame, window: int = 2, min_words: int = 30) -> DataFrame:
    """(doc_id, start, end): the deleted byte spans of each document."""
    out = merged(repeated_runs(docs, window, min_words, whole=True)).select(id_back("doc").alias("doc_id"), F.explode("spans").alias("s"))
    return out.select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"))
