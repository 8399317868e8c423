"""Language-model scoring with a log-bilinear neural model.

Words fall into classes: each of the ``top_words`` most frequent is a class of its own, the
end of a text is one, and the others share ``BUCKETS`` classes by their last two bytes.
The model gives P(class | class before) from vectors learned in numpy,

    log P(w | c) = q[w] . (A r[c]) + b[w] - log Z(c),

and P(word | class) from the word's count, add-one with a place for unseen words. A text's
score is the sum over its words and end; the probabilities of all words sum to one.

Training is noise-contrastive estimation against ``NOISE`` samples a word from the
class frequencies. Spark counts every pair of neighbours of the training corpus into a
table of class pairs, whose size the number of classes bounds, and the expected objective
over those counts is climbed by Adam with batched matrix products. Scoring reads normalised
log-probabilities from one product of all contexts with all classes.

Token counts stay distributed: the ``head_words`` most frequent are resolved in the map
tasks, all others by a join on the word's hash.

Defined results: a null or empty text is its end token alone; without training rows every
count is 0 and the model knows only the end and the classes of its prior; repeated rows get
equal rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeflux.llm import textblocks as T
from lakeflux.llm.work import materialise

BUCKETS = 256
NOISE = 10
#: Tokens that a task adds up at a time.
COUNTED_TOGETHER = 3_000_000
END = np.uint64(0x8C58_0E57_1B1D_0A2F)


def tokens(buf: np.ndarray, offs: np.ndarray):
    """Hash, bucket and document of every token of a block, texts in order, each closed by its end token (bucket -1)."""
    low = T.lower_ascii(buf)
    starts, ends, doc = T.words(low, offs, T.NON_SPACE)
    h = T.span_hash(T.prefix_sums(low), starts, ends)
    two = low[ends - 1].astype(np.int64) * 31 + np.where(ends - starts > 1, low[np.maximum(ends - 2, 0)], 0) * 7
    n = len(offs) - 1
    count = np.bincount(doc, minlength=n)
    stop = np.cumsum(count + 1) - 1
    codes, bucket, owner = np.empty(len(h) + n, np.uint64), np.empty(len(h) + n, np.int64), np.repeat(np.arange(n), count + 1)
    word = np.ones(len(codes), bool)
    word[stop] = False
    codes[word], codes[stop] = h, END
    bucket[word], bucket[stop] = two % BUCKETS, -1
    return codes, bucket, owner


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, bucket, n) of the tokens of all texts; a task adds up what it has read before it is shuffled."""

    def added(parts):
        h, bucket = (np.concatenate(c) for c in zip(*parts))
        u, at, n = np.unique(h, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(T.signed(u)), pa.array(bucket[at], pa.int32()), pa.array(n)], ["h", "bucket", "n"])

    def run(batches):
        parts, held = [], 0
        for batch in batches:
            for _, _, buf, offs in T.blocks(batch.column(0)):
                h, bucket, _ = tokens(buf, offs)
                parts.append((h, bucket.astype(np.int16)))
                held += len(h)
                if held >= COUNTED_TOGETHER:
                    yield added(parts)
                    parts, held = [], 0
        if parts:
            yield added(parts)

    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit(""))).mapInArrow(run, "h long, bucket int, n long")
    return rows.groupBy("h", "bucket").agg(F.sum("n").alias("n"))


class Classes:
    """Class of every token: the most frequent words' own, then the end's, then the buckets'."""

    def __init__(self, top: np.ndarray):
        top = top[top != END]
        self.words, self.index = np.sort(top), np.argsort(top, kind="stable")
        self.end = len(top)
        self.number = len(top) + 1 + BUCKETS

    def of(self, h: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        out = np.where(bucket < 0, self.end, self.end + 1 + bucket)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
            out = np.where(self.words[at] == h, self.index[at], out)
        return out

    def contexts(self, c: np.ndarray) -> np.ndarray:
        """Class before each token; the end's before the first of a text."""
        return np.append(self.end, c[:-1])


def pair_counts(docs: DataFrame, classes: Classes) -> np.ndarray:
    """(context, class) counts over all texts: classes.number squared numbers, whatever the corpus."""
    m = classes.number

    def run(batches):
        total = np.zeros(m * m, np.int64)
        for batch in batches:
            for _, _, buf, offs in T.blocks(batch.column(0)):
                h, bucket, _ = tokens(buf, offs)
                c = classes.of(h, bucket)
                total += np.bincount(classes.contexts(c) * m + c, minlength=m * m)
        some = np.flatnonzero(total)
        for a in range(0, len(some), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(some[a : a + (1 << 16)]), pa.array(total[some[a : a + (1 << 16)]])], ["pair", "n"])

    rows = docs.select(F.coalesce(F.col("text").cast("string"), F.lit(""))).mapInArrow(run, "pair long, n long")
    table = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(m * m)
    out[table.column(0).to_numpy()] = table.column(1).to_numpy()
    return out.reshape(m, m)


def train(counts: np.ndarray, dim: int = 24, steps: int = 200, rate: float = 0.03, prior: float = 10.0, seed: int = 11) -> np.ndarray:
    """Normalised natural log P(class | context) of a log-bilinear model fitted by noise-contrastive estimation.

    prior: precision of the Gaussian prior of the vectors, in counted pairs; it matters for small corpora.
    """
    m = len(counts)
    rng = np.random.default_rng(seed)
    noise = (counts.sum(0) + 0.5) / (counts.sum() + 0.5 * m)
    given = counts.sum(1, keepdims=True)
    weight = 1.0 / max(counts.sum(), 1.0)
    data = (counts * weight).astype(np.float32)
    against = (NOISE * given * weight * noise).astype(np.float32)
    shift = np.log(NOISE * noise).astype(np.float32)
    p = {
        "r": rng.normal(0, 0.1, (m, dim)).astype(np.float32),
        "a": np.eye(dim, dtype=np.float32),
        "q": rng.normal(0, 0.1, (m, dim)).astype(np.float32),
        "b": np.log(noise).astype(np.float32),
    }
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()}
    for step in range(1, steps + 1):
        ra = p["r"] @ p["a"]
        # a pair is data rather than noise with this probability
        held = 1 / (1 + np.exp(np.clip(shift - p["b"] - ra @ p["q"].T, -30, 30)))
        g = data * (1 - held) - against * held
        gq = g @ p["q"]
        grads = {"r": gq @ p["a"].T, "a": p["r"].T @ gq, "q": g.T @ ra, "b": g.sum(0)}
        for k, v in grads.items():
            if k in "rq":
                v = v - np.float32(prior * weight) * p[k]
            first, second = moments[k]
            first += 0.1 * (v - first)
            second += 0.01 * (v * v - second)
            p[k] += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    s = (p["r"] @ p["a"]) @ p["q"].T + p["b"]
    s = s.astype(np.float64)
    top = s.max(1, keepdims=True)
    return s - top - np.log(np.exp(s - top).sum(1, keepdims=True))


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, known long, model double, counted double, tail array<long>, tail_n array<int>"


def score_documents(docs: DataFrame, training, top_words: int = 1000, head_words: int = 150_000) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    training: a condition on the rows of docs; the model and all counts come from those that meet it.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), training.alias("fits"))
    learn = rows.where("fits").select("text")
    counts = materialise(token_counts(learn), "counts")
    n_all, v_all = (int(x or 0) for x in counts.agg(F.sum("n"), F.count(F.lit(1))).first())
    head = counts.orderBy(F.desc("n"), "h").limit(head_words).select("h", "n").toArrow()  # at most head_words rows
    head_h, head_n = head.column(0).to_numpy().view(np.uint64), head.column(1).to_numpy()
    classes = Classes(head_h[: top_words + 1][head_h[: top_words + 1] != END][:top_words])
    log_p = (train(pair_counts(learn, classes)) / np.log(10)).astype(np.float32)
    # words of each bucket class: all their tokens, and how many are distinct
    own = np.sort(classes.words)
    top = counts.where(F.col("h").isin([int(x) for x in T.signed(own)])).groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    every = counts.where("bucket >= 0").groupBy("bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    size = np.zeros((2, BUCKETS))
    for sign, table in ((1, every), (-1, top)):
        for r in table.collect():  # at most BUCKETS rows
            size[:, r.bucket] += sign * np.array([r.n, r.v])
    in_class = np.log10(size[0] + size[1] + 1)
    order = np.argsort(head_h)
    shared = docs.sparkSession.sparkContext.broadcast((head_h[order], np.log10(head_n[order] + 1.0), classes, log_p, in_class))

    def run(batches):
        words, logs, classes, log_p, in_class = shared.value
        for batch in batches:
            for lo, hi, buf, offs in T.blocks(batch.column(3)):
                h, bucket, d = tokens(buf, offs)
                m = hi - lo
                c = classes.of(h, bucket)
                at = np.minimum(np.searchsorted(words, h), max(len(words) - 1, 0))
                known = words[at] == h if len(words) else np.zeros(len(h), bool)
                counted = np.where(known, logs[at], 0.0) if len(words) else np.zeros(len(h))
                grouped = c > classes.end
                model = log_p[classes.contexts(c), c].astype(np.float64) + np.where(grouped, -in_class[np.maximum(bucket, 0)], 0.0)
                # a word of a bucket class adds log10(c + 1); one of its own class adds nothing
                model += np.where(grouped, counted, 0.0)
                rest = np.flatnonzero(~known)
                key = np.lexsort((h[rest], d[rest]))
                th, td = h[rest][key], d[rest][key]
                new = np.flatnonzero(np.append(True, (th[1:] != th[:-1]) | (td[1:] != td[:-1]))) if len(th) else np.zeros(0, np.int64)
                times = np.diff(np.append(new, len(th)))
                cut = T.slices(th, td[new], m)
                per = lambda x: np.bincount(d, x, m)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).slice(lo, m) for k in range(3)],
                        pa.array(np.bincount(d, minlength=m)),
                        pa.array(per(known).astype(np.int64)),
                        pa.array(per(model)),
                        pa.array(per(counted)),
                        T.list_array(cut, T.signed(th[new]), pa.int64()),
                        T.list_array(cut, times, pa.int32()),
                    ],
                    ["row", "doc_id", "held_out", "n_tokens", "known", "model", "counted", "tail", "tail_n"],
                )

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", (~F.col("fits")).alias("held_out"), "text")
    scored = materialise(numbered.mapInArrow(run, _SCORED), "scored")
    tail = scored.select("row", F.explode(F.arrays_zip("tail", "tail_n")).alias("x")).select("row", F.col("x.tail").alias("h"), F.col("x.tail_n").alias("times"))
    found = (
        tail.join(counts.select("h", "n"), "h")
        .groupBy("row")
        .agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("sum"))
    )
    out = scored.drop("tail", "tail_n").join(found, "row", "left")
    more, extra = F.coalesce("more", F.lit(0)), F.coalesce("sum", F.lit(0.0))
    norm = float(np.log10(n_all + v_all + 1))
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + more).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("counted") + extra - F.col("n_tokens") * norm).alias("base_score"),
        (F.col("model") + extra).alias("score"),
    )
