"""Language identification with bit-sliced Bloom filters over byte n-grams.

One table of slots serves all languages: bit L of a slot belongs to language L's
Bloom filter, so that one look-up of an n-gram (the AND of its slots) returns every
language that contains it. A text's score for a language is the share of its n-grams
that the filter holds, corrected for the filter's false positives; the best decides.

The filters are fitted on about ``max_train_docs`` labelled documents at most, chosen within
each language by a hash of id and text: languages share the places equally, and those with
fewer documents than their share give all. Each keeps its ``top_grams`` most frequent n-grams.

Defined results: a null text, or one without any letter, is ``und`` with score 0; a
text with letters but no known n-gram gets the most frequent learned language and
score 0; equal scores go to the more frequent language; repeated rows get equal
results; with no labelled row at all every text is ``und``; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lakeflux.llm import textblocks as T
from lakeflux.llm.work import released

GRAM = 4
#: Bytes of text, and rows, that are worked on at a time.
BLOCK_BYTES, ROWS = 1 << 18, 1024
SLOT_BITS = 20
HASHES = 2


def _codes(texts: pa.Array):
    """Per block: first row, end row, hashes of the n-grams, their documents. Letters in lower case; all else is one separator."""
    texts = pc.utf8_lower(texts.fill_null(""))
    for lo, hi, buf, offs in T.blocks(texts, BLOCK_BYTES):
        b = np.where(_LETTER[buf], buf, np.uint8(32)).astype(np.uint64)
        doc = np.repeat(np.arange(hi - lo), np.diff(offs))
        m = len(b) - GRAM + 1
        if m <= 0:
            yield lo, hi, np.zeros(0, np.uint64), np.zeros(0, np.int64)
            continue
        g = np.zeros(m, np.uint64)
        for i in range(GRAM):
            g |= b[i : i + m] << np.uint64(8 * i)
        # inside one document, and not across more than one separator
        gap = (b == 32).astype(np.int8)
        gaps = np.zeros(m, np.int8)
        for i in range(GRAM):
            gaps += gap[i : i + m]
        at = np.flatnonzero((doc[:m] == doc[GRAM - 1 :]) & (gaps < 2))
        yield lo, hi, g[at], doc[at]


def gram_counts(docs: DataFrame, label: str = "lang") -> DataFrame:
    """(label, gram, n): n-gram counts by label, summed a task's batch at a time before they are shuffled."""

    def run(batches):
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            codes, names = batch.column(0).dictionary_encode(), None
            names, which = codes.dictionary, codes.indices.to_numpy(zero_copy_only=False)
            for lo, hi, g, doc in _codes(batch.column(1)):
                lab = which[lo:hi][doc]
                for k in np.unique(lab):
                    u, n = np.unique(g[lab == k], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[int(k)].as_py()] * len(u), pa.string()), pa.array(u.view(np.int64)), pa.array(n)], ["label", "gram", "n"]
                    )

    rows = docs.select(F.col(label).cast("string"), F.col("text").cast("string")).mapInArrow(released(run), "label string, gram long, n long")
    return rows.groupBy("label", "gram").agg(F.sum("n").alias("n"))


def _slots(g: np.ndarray) -> list[np.ndarray]:
    h = T.mix(g)
    return [((h >> np.uint64(SLOT_BITS * k)) & np.uint64((1 << SLOT_BITS) - 1)).astype(np.int64) for k in range(HASHES)]


class Filters:
    """The bit-sliced table: ``bits[slot]`` has bit L where language L's Bloom filter has that slot."""

    def __init__(self, langs: list[str], grams: list[np.ndarray]):
        self.langs = langs  # the most frequent first
        self.bits = np.zeros((1 << SLOT_BITS, -(-max(1, len(langs)) // 64)), np.uint64)
        for k, g in enumerate(grams):
            for s in _slots(g.view(np.uint64)):
                self.bits[s, k // 64] |= np.uint64(1 << (k % 64))
        filled = [((self.bits[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(langs))]
        self.false_rate = np.array(filled) ** HASHES

    def shares(self, g: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
        """(documents, languages): share of the n-grams that each filter holds, less false positives."""
        slots = _slots(g)
        total = np.maximum(np.bincount(doc, minlength=n_docs), 1)
        out = np.zeros((n_docs, len(self.langs)))
        for word in range(self.bits.shape[1]):
            held = self.bits[slots[0], word]
            for s in slots[1:]:
                held = held & self.bits[s, word]
            for k in range(word * 64, min(len(self.langs), word * 64 + 64)):
                bit = ((held >> np.uint64(k % 64)) & np.uint64(1)).astype(np.float64)
                out[:, k] = np.bincount(doc, bit, minlength=n_docs) / total
        return np.clip((out - self.false_rate) / (1 - self.false_rate), 0, 1)


def sample_shares(counts: dict[str, int], most: int) -> dict[str, float]:
    """Share of each language's documents to sample, so that the samples hold ``most`` together at
    most (but one of each language): what small languages leave of their equal part goes to the larger ones."""
    part, left, out = most, len(counts), {}
    for lang, n in sorted(counts.items(), key=lambda x: (x[1], x[0])):
        take = max(1, min(n, part // left))
        out[lang] = take / n
        part, left = max(0, part - take), left - 1
    return out


def fit(docs: DataFrame, max_train_docs: int = 20_000, top_grams: int = 30_000, min_ratio: float = 0.1, min_count: int = 3) -> Filters:
    """Filters from labelled documents (doc_id, text, lang).

    An n-gram belongs to each language in which its relative frequency is at least
    min_ratio of its highest: quotations from another language stay out.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("lang", F.col("lang").cast("string"))
    shares = sample_shares({r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}, max_train_docs)  # a row a language
    cut = {lang: int((1 << 30) * share) for lang, share in shares.items() if share < 1}
    if cut:
        place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text").cast("string")), F.lit(1 << 30))
        least = F.create_map(*[F.lit(x) for item in cut.items() for x in item])
        known = known.where(place < F.coalesce(F.try_element_at(least, F.col("lang")), F.lit(1 << 30)))
    counts = gram_counts(known)
    total = counts.groupBy("label").agg(F.sum("n").alias("total"))
    share = counts.join(F.broadcast(total), "label").withColumn("share", F.col("n") / F.col("total"))
    best = share.groupBy("gram").agg(F.max("share").alias("best"))
    held = share.join(best, "gram").where((F.col("share") >= min_ratio * F.col("best")) & (F.col("n") >= min_count))
    # bounded: top_grams rows a language
    ranked = held.withColumn("r", F.expr("row_number() over (partition by label order by n desc, gram)")).where(F.col("r") <= top_grams)
    rows = ranked.select("label", "gram", "total").toArrow().to_pandas()
    # as frequent as in all documents, not in the sample
    langs = rows.groupby("label").total.first().sort_index()
    langs = (langs / [shares[lang] for lang in langs.index]).sort_values(ascending=False, kind="stable").index.tolist()
    return Filters(langs, [rows.gram[rows.label == lang].to_numpy(np.int64) for lang in langs])


def identify(docs: DataFrame, filters: Filters, names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The documents with their language and score added, under these names in place of
    columns that have them; under a third name also the number of n-grams that the score
    rests on. No other column is read than text."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {n.lower() for n in names}])
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # fixed size: 2**SLOT_BITS slots
    rows = docs.withColumn("__llm_letter", F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)))
    at = rows.columns.index(next(c for c in rows.columns if c.lower() == "text"))
    names_out = [*docs.columns, *names]
    added = [StructField(n, t) for n, t in zip(names, (StringType(), DoubleType(), LongType()))]
    schema = StructType([*docs.schema.fields, *added])

    def run(batches):
        f = shared.value
        for batch in (b.slice(i, ROWS) for b in batches for i in range(0, b.num_rows, ROWS)):
            n = batch.num_rows
            best, score, grams = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, np.int64)
            if f.langs:
                for lo, hi, g, doc in _codes(batch.column(at).cast(pa.string())):
                    grams[lo:hi] = np.bincount(doc, minlength=hi - lo)
                    s = f.shares(g, doc, hi - lo)
                    best[lo:hi] = s.argmax(1)
                    score[lo:hi] = s.max(1)
            letter = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(bool)
            langs = [f.langs[k] if ok and f.langs else "und" for k, ok in zip(best, letter)]
            found = [pa.array(langs, pa.string()), pa.array(np.where(letter, score, 0.0)), pa.array(grams)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *found[: len(names)]], names_out)

    return rows.mapInArrow(released(run), schema)


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True
