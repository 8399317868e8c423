"""Files read by several tasks each: record arrays (S2) and heads of JSON lines (L1).

Spark's text reader cuts a file into byte ranges (splits) and gives each line to one of
them; what a line means can depend on all that stands before it. Both readers here first
reduce every split to one small row, add these rows up along each file, and then let every
split work on its own, from the state or the line number that it begins with.

Record arrays. Lines end at ``}``, as a record does. Whether a ``}`` ends one depends on the
quotes and brackets before it: a split's row says, for either case at its start (outside or
inside a string), in which case it ends and how far the bracket depth moves. Composed along a
file these rows give each split's true start, so records, and their positions in the file,
come out as if it had been read whole. Only records that reach over a split's end are put
together by a shuffle. A task holds a split's lines, or one record; there is no limit of size.

Splits and tasks are counted apart: a task reads as many splits as make up the session's
``spark.sql.files.maxPartitionBytes``, one after the other, so that small splits of a large
input are not as many tasks, each with files and messages of its own.
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeflux.session import work_dir
from lakeflux.sources import store
from lakeflux.sources.files import FILE_COL, POS_COL, unread_files

#: Split rows that are sent to every task; more are joined by a shuffle.
MAX_BROADCAST_SPLITS = 100_000
#: Splits of a small input are dealt over so many tasks a core, if there are as many.
SMALL_TASKS_PER_CORE = 4
#: What Spark takes where the session sets no size.
DEFAULT_PARTITION_BYTES = 128 << 20
NOT_RECORDS = "not an array of records"
_CORRUPT = "__corrupt"


@contextlib.contextmanager
def fixed_splits(spark: SparkSession, split_bytes: int | None = None, total: int | None = None):
    """Splits stay the same from pass to pass, whatever executors come and go meanwhile.

    total: bytes of the input. With it, splits of split_bytes share tasks, and grow where there would be more of
    them than half of MAX_BROADCAST_SPLITS; without, each is a task.
    """
    conf = {"spark.sql.files.minPartitionNum": spark.conf.get("spark.sql.files.minPartitionNum", None) or str(spark.sparkContext.defaultParallelism)}
    if split_bytes:
        if total is not None:
            split_bytes = max(split_bytes, -(-total // (MAX_BROADCAST_SPLITS // 2)))
            conf["spark.sql.files.maxPartitionNum"] = spark.conf.get("spark.sql.files.maxPartitionNum", None) or str(_tasks(spark, total))
        conf |= {"spark.sql.files.maxPartitionBytes": str(split_bytes), "spark.sql.files.openCostInBytes": str(split_bytes)}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _tasks(spark: SparkSession, total: int) -> int:
    """Tasks that read so many bytes: of the session's partition size, and some a core at least."""
    text = str(spark.conf.get("spark.sql.files.maxPartitionBytes", None) or DEFAULT_PARTITION_BYTES).strip().lower()
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)(?:i?b)?", text).groups()
    size = int(number) << (10 * " kmgtp".index(unit or " "))
    return max(-(-total // max(size, 1)), SMALL_TASKS_PER_CORE * spark.sparkContext.defaultParallelism)


def _input_bytes(spark: SparkSession, path: str, glob: str | None, recursive: bool) -> int:
    return store.list_files(spark, path, glob, recursive).agg(F.sum("bytes")).first()[0] or 0


def split_lines(spark: SparkSession, path: str, glob: str | None, recursive: bool, line_sep: str | None = None) -> DataFrame:
    """(file, start, row, value): lines with the first byte of their split; row ascends within a split."""
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if line_sep:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias(FILE_COL), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"), "value"
    )


def _along(frame: DataFrame, rows: DataFrame) -> DataFrame:
    """Lines with their split's row, a split's lines together and in order."""
    on = [FILE_COL, "start"]
    if rows.count() <= MAX_BROADCAST_SPLITS:
        return frame.join(F.broadcast(rows), on)  # keeps the order in which a task reads
    return frame.join(rows, on).repartition(*on).sortWithinPartitions(*on, "row")


# structure of JSON text


class Structure:
    """Quotes and brackets of a run of lines that each ended at a ``}``, for either case at the start of the first.

    odd: lines that turn the case (inside or outside a string) around; moves: (2, lines), how far each moves the
    depth if it begins outside or inside a string, without the ``}`` behind it.
    """

    def __init__(self, values: pa.Array):
        offs = np.frombuffer(values.buffers()[1], np.int32)[values.offset : values.offset + len(values) + 1].astype(np.int64)
        data = values.buffers()[2]
        buf = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
        offs = offs - offs[0]
        at = np.flatnonzero((buf == 34) | (buf == 91) | (buf == 93) | (buf == 123))
        line = np.searchsorted(offs, at, "right") - 1
        kind = buf[at]
        # a quote behind an odd number of backslashes is a character of its string
        plain = np.maximum.accumulate(np.where(buf == 92, -1, np.arange(len(buf)))) if len(buf) else buf
        before = np.where(at > 0, plain[at - 1], -1) if len(at) else at
        escapes = at - 1 - np.maximum(before, offs[line] - 1)
        quote = (kind == 34) & (escapes % 2 == 0)
        total = np.append(0, np.cumsum(quote))
        first = np.searchsorted(at, offs)
        count = total[first[1:]] - total[first[:-1]]
        inside = (total[:-1] - total[first[line]]) % 2 if len(at) else at
        step = np.where((kind == 91) | (kind == 123), 1, np.where(kind == 93, -1, 0))
        n = len(values)
        self.odd = count % 2 == 1
        self.moves = np.stack([np.bincount(line, step * (inside == case), n) for case in (0, 1)]).astype(np.int64) if len(at) else np.zeros((2, n), np.int64)

    def follow(self, inside: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """From this start: case and depth at the end of each line, before its ``}``."""
        turned = np.cumsum(self.odd) + inside
        case = turned % 2
        move = np.where((turned - self.odd) % 2 == 1, self.moves[1], self.moves[0])
        closed = np.append(0, np.cumsum(case == 0)[:-1])
        return case, depth + np.cumsum(move) - closed


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Rows lo..hi of a batch that are of one split."""
    n = batch.num_rows
    if not n:
        return
    file, start = batch.column(0).dictionary_encode().indices.to_numpy(), batch.column(1).to_numpy()
    edge = np.flatnonzero(np.append(True, (file[1:] != file[:-1]) | (start[1:] != start[:-1]))).tolist() + [n]
    yield from zip(edge, edge[1:])


def _split_rows(lines: DataFrame) -> DataFrame:
    """(file, start, n, inside, depth0, depth1): lines of each split, its case at the end if it begins outside a
    string (the other one if not), and its depth there for both cases, with all of its ``}``."""
    names = [FILE_COL, "start", "n", "inside", "depth0", "depth1"]

    def run(batches):
        held = None  # file, start, n, inside, depth0, depth1
        for batch in batches:
            out = []
            for lo, hi in _runs(batch):
                key = (batch.column(0)[lo].as_py(), batch.column(1)[lo].as_py())
                if held is None or held[:2] != key:
                    if held is not None:
                        out.append(held)
                    held = (*key, 0, 0, 0, 0)
                s = Structure(batch.column(2).slice(lo, hi - lo))
                _, _, n, inside, *depth = held
                ends = [s.follow(inside ^ case, d) for case, d in enumerate(depth)]
                held = (*key, n + hi - lo, int(ends[0][0][-1]), *(int(d[-1]) - int(c[-1] == 0) for c, d in ends))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names)
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array([c]) for c in held], names)

    return lines.select(FILE_COL, "start", "value").mapInArrow(run, "file string, start long, n long, inside long, depth0 long, depth1 long")


def _starts(rows: DataFrame) -> DataFrame:
    """(file, start, n, in0, in_depth): the case and depth that each split begins with, from the file's first one on."""

    def run(batches):
        file, case, depth = None, 0, 0
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if r[FILE_COL] != file:
                    file, case, depth = r[FILE_COL], 0, 0
                out.append((file, r["start"], r["n"], case, depth))
                depth += r["depth1"] if case else r["depth0"]
                case ^= r["inside"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], [FILE_COL, "start", "n", "in0", "in_depth"])

    return rows.repartition(FILE_COL).sortWithinPartitions(FILE_COL, "start").mapInArrow(run, "file string, start long, n long, in0 long, in_depth long")


_ENDS = "file string, start long, ends long"
_PARTS = "file string, record long, whole boolean, start long, seq int, text string"


def _record_ends(batch_case, batch_depth, is_last):
    """Lines whose ``}`` ends a record: outside strings, back to the depth of the array; a file's last line has no ``}``."""
    return (batch_case == 0) & (batch_depth == 2) & ~is_last


def _follow_splits(batches, use):
    """Per run of a split in a batch: (lo, hi, record ends) to ``use``, with the state carried over batches."""
    key, seen, case, depth = None, 0, 0, 0
    for batch in batches:
        names = batch.schema.names
        col = {c: batch.column(names.index(c)) for c in ("n", "in0", "in_depth", "last")}
        for lo, hi in _runs(batch):
            now = (batch.column(0)[lo].as_py(), batch.column(1)[lo].as_py())
            if now != key:
                key, seen, case, depth = now, 0, col["in0"][lo].as_py(), col["in_depth"][lo].as_py()
            c, d = Structure(batch.column(names.index("value")).slice(lo, hi - lo)).follow(case, depth)
            is_last = np.zeros(hi - lo, bool)
            if col["last"][lo].as_py() and seen + hi - lo == col["n"][lo].as_py():
                is_last[-1] = True
            yield from use(batch, lo, hi, seen, _record_ends(c, d, is_last), is_last)
            seen += hi - lo
            case, depth = int(c[-1]), int(d[-1]) - int(c[-1] == 0)
        yield from use(None, 0, 0, 0, None, None)
    yield from use(None, 0, 0, -1, None, None)


def _count_ends(lines: DataFrame) -> DataFrame:
    """(file, start, ends): records that end in each split."""

    def run(batches):
        out = {}

        def use(batch, lo, hi, seen, ends, is_last):
            if batch is not None:
                key = (batch.column(0)[lo].as_py(), batch.column(1)[lo].as_py())
                out[key] = out.get(key, 0) + int(ends.sum())
            elif seen < 0 and out:
                cols = [[k[0] for k in out], [k[1] for k in out], list(out.values())]
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64())], [FILE_COL, "start", "ends"])

        yield from _follow_splits(batches, use)

    return lines.select(FILE_COL, "start", "value", "n", "in0", "in_depth", "last").mapInArrow(run, _ENDS)


def _texts(lines: DataFrame) -> DataFrame:
    """Records that lie within a split (whole), and parts of others. record: the position in the file; that of
    what follows the last record is their number."""
    fields = pa.schema([(FILE_COL, pa.string()), ("record", pa.int64()), ("whole", pa.bool_()), ("start", pa.int64()), ("seq", pa.int32()), ("text", pa.string())])

    def run(batches):
        out, text = [], []
        key, record, begun = None, 0, False  # begun: the split's first record end has been seen

        def part():
            if text:
                out.append((key[0], record, False, key[1], int(begun), "".join(text)))
                text.clear()

        def use(batch, lo, hi, seen, ends, is_last):
            nonlocal key, record, begun
            if batch is None:
                if seen < 0:
                    part()
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), fields)], schema=fields)
                    out.clear()
                return
            now = (batch.column(0)[lo].as_py(), batch.column(1)[lo].as_py())
            if now != key:
                part()
                key, begun, record = now, False, batch.column(batch.schema.names.index("before"))[lo].as_py()
            for value, end, last in zip(batch.column(batch.schema.names.index("value"))[lo:hi].to_pylist(), ends.tolist(), is_last.tolist()):
                text.append(value if last else value + "}")
                if end:
                    if begun:
                        out.append((key[0], record, True, key[1], 0, "".join(text)))
                        text.clear()
                    else:
                        part()
                    begun, record = True, record + 1

        yield from _follow_splits(batches, use)

    return lines.select(FILE_COL, "start", "value", "n", "in0", "in_depth", "last", "before").mapInArrow(run, _PARTS)


def split_record_files(
    spark: SparkSession, path: str, schema: StructType, glob: str | None = "*.json", recursive: bool = True, split_bytes: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Record files read by several tasks each: (file, pos, fields) of all well-formed files, and (file, reason) of the others.

    A file is well-formed if it is one JSON array of objects that all parse with the schema. Anything else, an
    empty file too, is rejected whole. The records' text is written once, to the shared work folder.
    split_bytes: size of a split at least, else the session's.
    """
    with fixed_splits(spark, split_bytes, _input_bytes(spark, path, glob, recursive)):
        texts_path, counted = _write_texts(spark, path, glob, recursive)
    texts = spark.read.parquet(texts_path)
    return _parsed(texts, counted, unread_files(spark, path, glob, recursive), schema)


def _write_texts(spark: SparkSession, path: str, glob: str | None, recursive: bool) -> tuple[str, DataFrame]:
    """Folder of the records' texts and parts, and (file, start, ends, before) of the splits."""
    lines = split_lines(spark, path, glob, recursive, "}")
    splits = work_dir(spark, "splits")
    _starts(_split_rows(lines)).write.parquet(splits)
    starts = spark.read.parquet(splits)
    last = starts.groupBy(FILE_COL).agg(F.max("start").alias("at"))
    starts = starts.join(last, FILE_COL).withColumn("last", F.col("start") == F.col("at")).drop("at")
    ends_path = work_dir(spark, "split-ends")
    _count_ends(_along(lines, starts)).write.parquet(ends_path)
    order = Window.partitionBy(FILE_COL).orderBy("start")  # a row a split
    counted = spark.read.parquet(ends_path).withColumn("before", F.sum("ends").over(order) - F.col("ends"))
    numbered = starts.join(counted, [FILE_COL, "start"])
    texts_path = work_dir(spark, "records")
    _texts(_along(lines, numbered)).write.parquet(texts_path)
    return texts_path, counted


def _parsed(texts: DataFrame, counted: DataFrame, empty: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    parts = texts.where(~F.col("whole")).groupBy(FILE_COL, "record").agg(F.array_sort(F.collect_list(F.struct("start", "seq", "text"))).alias("p"))
    joined = parts.select(FILE_COL, "record", F.array_join(F.transform("p", lambda x: x["text"]), "").alias("text"))
    every = texts.where("whole").select(FILE_COL, "record", "text").union(joined)
    totals = counted.groupBy(FILE_COL).agg(F.sum("ends").alias("total"))
    every = every.join(totals, FILE_COL)
    lead = F.regexp_extract("text", r"^[ \t\n\r]*([\[,]?)[ \t\n\r]*", 0)
    body = F.expr("substring(text, length(lead) + 1)")
    known = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    read = every.withColumn("lead", lead).withColumn("body", body).withColumn("r", F.from_json("body", known, {"columnNameOfCorruptRecord": _CORRUPT}))
    mark = F.trim("lead", F.lit(" \t\n\r")) == F.when(F.col("record") == 0, "[").otherwise(",")
    fine_record = mark & F.col("body").startswith("{") & F.col("r").isNotNull() & F.col(f"r.{_CORRUPT}").isNull()
    closing = F.regexp_replace("text", r"[ \t\n\r]+", "")
    fine_end = closing == F.when(F.col("total") == 0, "[]").otherwise("]")
    is_end = F.col("record") == F.col("total")
    broken = read.where(F.when(is_end, ~fine_end).otherwise(~fine_record)).select(FILE_COL)
    ended = every.where(is_end).select(FILE_COL)
    files = counted.select(FILE_COL).distinct()
    rejected = files.join(ended, FILE_COL, "left_anti").union(broken).union(empty.select(FILE_COL)).distinct().select(FILE_COL, F.lit(NOT_RECORDS).alias("reason"))
    records = read.where(~is_end).join(rejected, FILE_COL, "left_anti").select(FILE_COL, F.col("record").cast("int").alias(POS_COL), *[F.col(f"r.`{f.name}`") for f in schema.fields])
    return records, rejected


def read_record_arrays_split(
    spark: SparkSession, path: str, schema: StructType, glob: str | None = "*.json", recursive: bool = True, on_bad: str = "fail", split_bytes: int | None = None
) -> DataFrame:
    """``file, pos, <fields>`` as ``read_record_arrays``, for files of any size. A broken file raises (``fail``) or is left out (``reject``)."""
    if on_bad not in ("fail", "reject"):
        raise ValueError("on_bad is fail or reject")
    records, rejected = split_record_files(spark, path, schema, glob, recursive, split_bytes)
    if on_bad == "fail" and (bad := rejected.first()) is not None:
        raise ValueError(f"broken record file {bad[FILE_COL]}: {bad.reason}")
    return records


def line_heads(
    spark: SparkSession, path: str, schema: StructType, n: int = 5, glob: str | None = "*.json", recursive: bool = True, split_bytes: int | None = None
) -> DataFrame:
    """``file, pos, <fields>`` of the first n lines of every JSON-lines file (L1), in file order.

    A split's line count, added up along its file, is its first line's number; splits that begin beyond line n are
    joined away before anything is parsed. Blank lines are no records. A line that does not parse raises. The
    lines found, n a file, are written to the shared work folder. split_bytes: size of a split at least, else the session's.
    """
    heads_path = work_dir(spark, "line-heads")
    with fixed_splits(spark, split_bytes, _input_bytes(spark, path, glob, recursive)):
        lines = split_lines(spark, path, glob, recursive).where(F.trim("value", F.lit(" \t\n\r")) != "")
        counts_path = work_dir(spark, "line-counts")
        lines.groupBy(FILE_COL, "start").agg(F.count(F.lit(1)).alias("n")).write.parquet(counts_path)
        order = Window.partitionBy(FILE_COL).orderBy("start")  # a row a split
        before = spark.read.parquet(counts_path).withColumn("before", F.sum("n").over(order) - F.col("n")).where(F.col("before") < n).drop("n")
        near = lines.join(before, [FILE_COL, "start"])
        place = F.row_number().over(Window.partitionBy(FILE_COL, "start").orderBy("row"))  # Spark keeps n rows of a split in each task
        head = near.withColumn("place", place).where(F.col("place") <= n).withColumn(POS_COL, (F.col("before") + F.col("place") - 1).cast("int"))
        head.where(F.col(POS_COL) < n).select(FILE_COL, POS_COL, "value").write.parquet(heads_path)
    r = F.from_json("value", schema, {"mode": "FAILFAST"}).alias("r")
    return spark.read.schema(f"{FILE_COL} string, {POS_COL} int, value string").parquet(heads_path).select(FILE_COL, POS_COL, r).select(FILE_COL, POS_COL, "r.*")
