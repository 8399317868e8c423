"""Conversation structure repair: the cheapest edits that give a conversation the roles ``(s?(ua)+)?``, and their audit.

Rows are edited in order of turn (nulls first; equal turns by role, then by a digest of
the text): Keep costs 0, Rerole to user or assistant 2, Delete 3 (required for blank and
duplicate rows), Insert of an empty user or assistant row anywhere 2; a truncated row that
stays adds 1. The audit is the edits' initials; of all cheapest ones the ASCII-least counts.

Method. A node is a place between rows and a state: nothing yet (0), after the system row
(1), a user row awaits its answer (2), complete (3). A backward pass finds each node's
cost to the end. Optimal arcs are those that lose none of it; a node's arcs bear different
letters (D, I, K, R), and what a letter does to the state is fixed, so ranking audits of
length one settles each node's arc. Prefix doubling then ranks whole audits: the rank for
length 2k orders pairs of (rank for k, rank for k of the node that k letters lead to), and
pointers double with it. A start's path is read through the doubled pointers, once for all
starts of one rank, as they have one audit.

Distribution. Rows are range partitioned by (conversation, turn, ...), so a conversation
of any length is spread over tasks. One that lies inside a task's rows is solved there,
many at a time. One that reaches a task's edge, or has more than ``SEGMENT`` rows, is cut
into segments: each segment's 4 x 4 cost table (state in, state out) is made in parallel,
a running product from the last segment back gives the cost beyond each, all segments are
then solved in parallel for their four entry states, and a last pass follows the states
through the segments and hashes. That pass streams, as a digest of one text must; it holds
a segment and the audit, which is a result cell.

Defined results: a null role, text, conversation or turn counts as one space where its
text is used; a null conv_id is a conversation of its own; repeated rows are rows of their
own (the later ones duplicates); an empty table gives no rows; further columns are ignored;
a role is judged by its initial alone, and one without any, or with another one, can only be
reroled or deleted.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeflux.llm.work import NULL_ID, id_back, materialise

#: Rows, and bytes of text, of a segment (at least one row).
SEGMENT, SEGMENT_BYTES = 4096, 8 << 20
INF = 1 << 40
SPACE = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: The state after a user row or its answer, whichever is due; of a rerole or insert.
DUE = np.array([2, 2, 3, 2])
LETTERS = np.frombuffer(b" DIKR", np.uint8)


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with known faults, by crc32 of ``conv_id:turn`` modulo 20: 0 drops the row,
    1 empties its text, 2 takes its ``.!?``, 3 repeats it, 4 makes its role user; nulls are one space."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select("conv_id", "turn", some("role").alias("role"), some("text").alias("text"), (F.crc32(F.concat(some("conv_id"), F.lit(":"), some("turn")).cast("binary")) % 20).alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.where(F.col("kind") != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


# the DP and the ranks, in numpy


def least_costs(begin: np.ndarray, code: np.ndarray, must: np.ndarray, cut: np.ndarray, beyond: np.ndarray, last: np.ndarray) -> np.ndarray:
    """(places, 4) cost from each node to the end; a run of n rows has n + 1 places.

    begin cuts the rows into runs; code: initial of each row's role (1 s, 2 u, 3 a, 0 other); must: has to go;
    cut: truncated; beyond: (runs, 4) costs behind a run; last: nothing follows, so inserts may stand at its end.
    """
    n = np.diff(begin)
    runs = len(n)
    out = np.full((len(code) + runs, 4), INF)
    end = begin[1:] + np.arange(runs)  # the run's last place
    out[end] = np.where(last[:, None], _with_inserts(beyond), beyond)
    order = np.argsort(-n, kind="stable")
    some = np.searchsorted(-n[order], -np.arange(1, (n.max() if runs else 0) + 1), "right")  # runs of at least j rows
    for j, k in enumerate(some.tolist(), 1):
        at = end[order[:k]] - j
        row = begin[1:][order[:k]] - j
        out[at] = _with_inserts(np.minimum(_by_delete(out[at + 1]), np.minimum(_by_keep(out[at + 1], code[row], must[row], cut[row]), _by_rerole(out[at + 1], must[row], cut[row]))))
    return out


def _with_inserts(base: np.ndarray) -> np.ndarray:
    once = base[:, DUE] + INSERT
    return np.minimum(base, np.minimum(once, base[:, DUE[DUE]] + 2 * INSERT))


def _by_delete(then: np.ndarray) -> np.ndarray:
    return then + DELETE


def _kept_state(code: np.ndarray) -> np.ndarray:
    """(rows, 4): the state that a kept row leads to, -1 where it may not be kept."""
    out = np.full((len(code), 4), -1)
    out[code == 1, 0] = 1
    user = code == 2
    out[user, 0] = out[user, 1] = out[user, 3] = 2
    out[code == 3, 2] = 3
    return out


def _by_keep(then: np.ndarray, code: np.ndarray, must: np.ndarray, cut: np.ndarray) -> np.ndarray:
    to = _kept_state(code)
    cost = np.take_along_axis(then, np.maximum(to, 0), 1) + KEEP + TRUNCATED * cut[:, None]
    return np.where((to >= 0) & ~must[:, None], cost, INF)


def _by_rerole(then: np.ndarray, must: np.ndarray, cut: np.ndarray) -> np.ndarray:
    return np.where(must[:, None], INF, then[:, DUE] + REROLE + TRUNCATED * cut[:, None])


class Paths:
    """Least optimal paths of all nodes of some runs (see least_costs); node = 4 * place + state."""

    def __init__(self, begin, code, must, cut, beyond, last):
        self.cost = cost = least_costs(begin, code, must, cut, beyond, last)
        runs, places = len(begin) - 1, len(cost)
        self.first = begin[:-1] + np.arange(runs)  # each run's first place
        end = begin[1:] + np.arange(runs)
        inner = np.ones(places, bool)
        inner[end] = False
        at = np.flatnonzero(inner)  # the place before each row
        letter = np.zeros((places, 4), np.int64)
        target = np.arange(4 * places).reshape(places, 4)
        # optimal arcs, the ASCII-greatest first, so that the least one stays
        then, to = cost[at + 1], _kept_state(code)
        for mark, costs, state in ((4, _by_rerole(then, must, cut), DUE), (3, _by_keep(then, code, must, cut), np.maximum(to, 0)), (2, None, DUE), (1, _by_delete(then), np.arange(4))):
            if mark == 2:
                optimal = cost[:, DUE] + INSERT == cost
                optimal[end[~last]] = False
                letter[optimal], target[optimal] = mark, (4 * np.arange(places)[:, None] + DUE)[optimal]
            else:
                optimal = costs == cost[at]
                goes = 4 * (at[:, None] + 1) + state
                l, t = letter[at], target[at]
                l[optimal], t[optimal] = mark, np.broadcast_to(goes, optimal.shape)[optimal]
                letter[at], target[at] = l, t
        self.letter, pointer = letter.ravel(), target.ravel()
        # prefix doubling: ranks and pointers for audits of 1, 2, 4, ... letters
        self.rank, self.length, self.jumps = self.letter, (self.letter > 0).astype(np.int64), [pointer]
        while (self.letter[pointer] > 0).any():
            self.rank = np.unique(self.rank * (int(self.rank.max()) + 1) + self.rank[pointer], return_inverse=True)[1]
            self.length = self.length + self.length[pointer]
            pointer = pointer[pointer]
            self.jumps.append(pointer)
        self.end = pointer

    def audits(self, nodes: np.ndarray) -> list[bytes]:
        """The least audit of each node; nodes of one rank share one."""
        _, one, back = np.unique(self.rank[nodes], return_index=True, return_inverse=True)
        starts = nodes[one]
        size = self.length[starts]
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        node = np.repeat(starts, size)
        for j, pointer in enumerate(self.jumps):
            go = (step >> j) & 1 == 1
            node[go] = pointer[node[go]]
        text, at = LETTERS[self.letter[node]].tobytes(), np.append(0, np.cumsum(size)).tolist()
        each = [text[a:b] for a, b in zip(at, at[1:])]
        return [each[i] for i in back.tolist()]


#: Costs behind a conversation's end: it may end empty or complete.
AT_END = np.array([0, INF, INF, 0])


def repaired_rows(audit: bytes, roles: list[str], texts: list[str], state: int):
    """The rows ``role:text`` that the audit makes of these rows, from that state on."""
    i = 0
    for letter in audit:
        if letter == 68:  # D
            i += 1
            continue
        due = int(DUE[state])
        if letter == 75:  # K
            yield f"{roles[i]}:{texts[i]}"
            state = 1 if roles[i][:1] == "s" else due
        else:
            yield ("user:" if due == 2 else "assistant:") + (texts[i] if letter == 82 else "")
            state = due
        i += letter != 73


# Spark


def _flagged(rows: DataFrame) -> DataFrame:
    """Rows with their order, their role's code and their first fault (1 blank, 2 duplicate, 3 truncated, 0 none)."""
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    turn = F.col("turn").cast("long")
    keyed = rows.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("conv"),
        turn.isNotNull().cast("int").alias("has"),
        F.coalesce(turn, F.lit(0)).alias("turn"),
        some("role").alias("role"),
        some("text").alias("text"),
        F.sha2(some("text"), 256).alias("sha"),
        F.monotonically_increasing_id().alias("row"),
    )
    keyed = materialise(keyed, "turns")  # fixes row, which tells repeated rows apart
    place = F.struct("has", "turn", "row")
    first = keyed.groupBy("conv", "role", "sha").agg(F.min(place).alias("first"))
    bare = F.rtrim("text", F.lit(SPACE))
    fault = (
        F.when(bare == "", 1)
        .when((F.col("first.has") != F.col("has")) | (F.col("first.turn") != F.col("turn")) | (F.col("first.row") != F.col("row")), 2)
        .when(~F.substring(bare, -1, 1).isin(".", "!", "?"), 3)
        .otherwise(0)
    )
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    return keyed.join(first, ["conv", "role", "sha"]).select(*ORDER, "text", code.alias("code"), fault.alias("fault"))


ORDER = ["conv", "has", "turn", "role", "sha", "row"]
_STAGE = "conv long, done boolean, part long, seg long, illegal long, cost long, audit string, repaired_sha256 string, codes binary, faults binary, roles array<string>, texts array<string>"


def _illegal(code: np.ndarray) -> np.ndarray:
    """Whether each neighbouring pair of roles is not su, ua or au."""
    pair = code[:-1] * 4 + code[1:]
    return ~np.isin(pair, [1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2])


def _pieces(texts: pa.Array, lo: int, hi: int):
    """Cuts rows lo..hi into segments."""
    size = pc.binary_length(texts[lo:hi]).to_numpy(zero_copy_only=False)
    start, held = lo, 0
    for i in range(lo, hi):
        if i > start and (i - start >= SEGMENT or held + size[i - lo] > SEGMENT_BYTES):
            yield start, i
            start, held = i, 0
        held += int(size[i - lo])
    yield start, hi


def _stage(rows: DataFrame) -> DataFrame:
    """Sorted rows to results of whole conversations (done) and segments of the others."""
    names = [f.split(" ")[0] for f in _STAGE.split(", ")]
    kinds = [pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.string(), pa.string(), pa.binary(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.string())]
    record = lambda out: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    def whole(b, groups):
        """Results of conversations that lie in rows lo..hi of the batch."""
        begin = np.append(0, np.cumsum([hi - lo for lo, hi in groups]))
        take = np.concatenate([np.arange(lo, hi) for lo, hi in groups])
        code, fault = b.column("code").to_numpy()[take], b.column("fault").to_numpy()[take]
        n = len(groups)
        paths = Paths(begin, code, (fault == 1) | (fault == 2), fault == 3, np.tile(AT_END, (n, 1)), np.ones(n, bool))
        starts = 4 * paths.first
        wrong = np.append(0, np.cumsum(_illegal(code)))
        out = []
        for g, ((lo, hi), audit) in enumerate(zip(groups, paths.audits(starts))):
            roles, texts = b.column("role")[lo:hi].to_pylist(), b.column("text")[lo:hi].to_pylist()
            digest = hashlib.sha256("\n".join(repaired_rows(audit, roles, texts, 0)).encode()).hexdigest()
            illegal = int(wrong[begin[g + 1] - 1] - wrong[begin[g]])
            out.append((b.column("conv")[lo].as_py(), True, None, None, illegal, int(paths.cost[paths.first[g], 0]), audit.decode(), digest, None, None, None, None))
        return record(out)

    def run(batches):
        part, seg, held, is_open = TaskContext.get().partitionId(), 0, None, None

        def segments(b, lo, hi):
            nonlocal seg
            for x, y in _pieces(b.column("text"), lo, hi):
                code, fault = (b.column(c).to_numpy()[x:y].astype(np.uint8).tobytes() for c in ("code", "fault"))
                yield record([(b.column("conv")[x].as_py(), False, part, seg, None, None, None, None, code, fault, b.column("role")[x:y].to_pylist(), b.column("text")[x:y].to_pylist())])
                seg += 1

        fresh = True  # the next group is the task's first one
        for batch in _and_none(batches):
            if batch is not None:
                held = pa.Table.from_batches([batch] if held is None else [held, batch]).combine_chunks().to_batches()
                held = held[0] if held else None
            if held is None or not held.num_rows:
                continue
            conv = held.column("conv").to_numpy()
            edge = np.flatnonzero(np.append(True, conv[1:] != conv[:-1])).tolist() + [len(conv)]
            groups = list(zip(edge, edge[1:]))
            tail = groups.pop()
            closed = []
            for lo, hi in groups:
                if fresh or conv[lo] == is_open:
                    yield from segments(held, lo, hi)
                elif hi - lo > SEGMENT:
                    yield from segments(held, lo, hi)
                else:
                    closed.append((lo, hi))
                fresh = False
            if closed:
                yield whole(held, closed)
            lo, hi = tail
            if batch is None or hi - lo > SEGMENT or held.slice(lo).nbytes > SEGMENT_BYTES:
                yield from segments(held, lo, hi)
                is_open, fresh, held = conv[lo], False, None
            else:
                held = held.slice(lo)

    return rows.mapInArrow(run, _STAGE)


def _and_none(batches):
    """The batches, then None."""
    yield from batches
    yield None


def _segment_arrays(codes: bytes, faults: bytes):
    code, fault = np.frombuffer(codes, np.uint8).astype(np.int64), np.frombuffer(faults, np.uint8)
    return code, (fault == 1) | (fault == 2), fault == 3


def _tables(segments: DataFrame) -> DataFrame:
    """(conv, part, seg, m): each segment's costs by state in and state out, a flat 4 x 4 table."""

    def run(batches):
        for batch in batches:
            out = []
            for codes, faults in zip(batch.column("codes").to_pylist(), batch.column("faults").to_pylist()):
                code, must, cut = _segment_arrays(codes, faults)
                n = len(code)
                beyond = np.where(np.eye(4, dtype=bool), 0, INF)
                cost = least_costs(np.arange(5) * n, np.tile(code, 4), np.tile(must, 4), np.tile(cut, 4), beyond, np.zeros(4, bool))
                out.append(np.minimum(cost[np.arange(4) * (n + 1)].T, INF).ravel().tolist())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "part", "seg")), pa.array(out, pa.list_(pa.int64()))], ["conv", "part", "seg", "m"])

    return segments.select("conv", "part", "seg", "codes", "faults").mapInArrow(run, "conv long, part long, seg long, m array<long>")


def _beyond(tables: DataFrame) -> DataFrame:
    """(conv, part, seg, beyond, last): the costs behind each segment, from a product that runs from the last one back."""

    def run(batches):
        conv, costs = None, None
        for batch in batches:
            beyond, last = [], []
            for c, m in zip(batch.column("conv").to_pylist(), batch.column("m").to_pylist()):
                at_end = c != conv
                if at_end:
                    conv, costs = c, AT_END
                beyond.append(costs.tolist())
                last.append(at_end)
                then = _with_inserts(costs[None])[0] if at_end else costs
                costs = np.minimum((np.array(m).reshape(4, 4) + then[None]).min(1), INF)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv", "part", "seg")), pa.array(beyond, pa.list_(pa.int64())), pa.array(last)], ["conv", "part", "seg", "beyond", "last"])

    back = [F.col("conv"), F.col("part").desc(), F.col("seg").desc()]
    return tables.repartition("conv").sortWithinPartitions(*back).mapInArrow(run, "conv long, part long, seg long, beyond array<long>, last boolean")


def _solved(segments: DataFrame) -> DataFrame:
    """Segments with cost, audit and state out for each state in."""
    kept = ["conv", "part", "seg", "codes", "roles", "texts"]

    def run(batches):
        for batch in batches:
            costs, audits, out = [], [], []
            for codes, faults, beyond, last in zip(*(batch.column(c).to_pylist() for c in ("codes", "faults", "beyond", "last"))):
                code, must, cut = _segment_arrays(codes, faults)
                paths = Paths(np.array([0, len(code)]), code, must, cut, np.array([beyond]), np.array([last]))
                starts = np.arange(4)
                costs.append(paths.cost[0].tolist())
                audits.append([a.decode() for a in paths.audits(starts)])
                out.append((paths.end[starts] & 3).tolist())
            cols = [batch.column(c) for c in kept] + [pa.array(costs, pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string())), pa.array(out, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(cols, [*kept, "costs", "audits", "out"])

    return segments.mapInArrow(run, "conv long, part long, seg long, codes binary, roles array<string>, texts array<string>, costs array<long>, audits array<string>, out array<int>")


def _followed(solved: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit, repaired_sha256): states followed through each conversation's segments, in order."""

    def run(batches):
        conv = state = illegal = cost = digest = empty = before = None
        audit: list[str] = []
        done = lambda: pa.RecordBatch.from_arrays([pa.array([x]) for x in (conv, illegal, cost, "".join(audit), digest.hexdigest())], ["conv", "illegal", "cost", "audit", "repaired_sha256"])
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                if row["conv"] != conv:
                    if digest is not None:
                        yield done()
                    conv, state, illegal, cost, digest, empty, before, audit = row["conv"], 0, 0, row["costs"][0], hashlib.sha256(), True, None, []
                code = np.frombuffer(row["codes"], np.uint8).astype(np.int64)
                illegal += int(_illegal(code if before is None else np.append(before, code)).sum())
                before = code[-1]
                own = row["audits"][state]
                audit.append(own)
                for text in repaired_rows(own.encode(), row["roles"], row["texts"], state):
                    digest.update(text.encode() if empty else b"\n" + text.encode())
                    empty = False
                state = row["out"][state]
        if digest is not None:
            yield done()

    ordered = solved.repartition("conv").sortWithinPartitions("conv", "part", "seg")
    return ordered.mapInArrow(run, "conv long, illegal long, cost long, audit string, repaired_sha256 string")


def repair(rows: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """One row a conversation of (conv_id, turn, role, text): conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256. ids: a table whose conv_id are reported even if they have no row."""
    flagged = materialise(_flagged(rows), "flagged")
    kinds = {1: "blank", 2: "duplicate", 3: "truncated"}
    by_turn = flagged.groupBy("conv", "has", "turn").agg(*[F.count_if(F.col("fault") == k).alias(n) for k, n in kinds.items()])
    held = F.when(F.col("has") == 1, F.col("turn"))
    totals = by_turn.groupBy("conv").agg(
        F.coalesce(F.max(held) - F.min(held) + 1 - F.count(held), F.lit(0)).alias("gaps"), *[F.sum(n).alias(n) for n in kinds.values()]
    )
    staged = materialise(_stage(flagged.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)), "staged")
    results = ["conv", "illegal", "cost", "audit", "repaired_sha256"]
    segments = staged.where(~F.col("done"))
    beyond = _beyond(_tables(segments))
    solved = _solved(segments.join(beyond, ["conv", "part", "seg"]).select("conv", "part", "seg", "codes", "faults", "roles", "texts", "beyond", "last"))
    every = staged.where("done").select(*results).union(_followed(solved).select(*results))
    conv: Column = F.coalesce(F.col("conv_id").cast("long"), F.lit(NULL_ID)).alias("conv")
    named = (rows if ids is None else ids).select(conv).distinct()
    out = named.join(totals, "conv", "left").join(every, "conv", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return out.select(
        id_back("conv").alias("conv_id"), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
