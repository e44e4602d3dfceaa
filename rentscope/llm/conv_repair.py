"""Conversation structure repair: cheapest edits by prefix-doubling path ranking.

A row may be kept, given the role user or assistant (``R``), or deleted, and
empty rows of these roles may be inserted, until the roles' initials read
``(s?(ua)+)?``.  The states of that pattern are 0 (nothing yet), 1 (after s),
2 (after u) and 3 (after a); a node is a place between two rows and a state.
Inserted and changed rows can only take the role that the state asks for, so
an edit leads from a node to one other.

1. Rows are sorted by range over (conversation, turn, role, hash of the text),
   so that one long conversation lies in many partitions.  Faults are marked
   there; a repeated row is one that is not the first of its (conversation,
   role, text), found by a partial aggregate.
2. Blocks of at most 4096 consecutive rows are worked on.  A
   conversation's part of a block is a segment; the costs from each state
   before it to each state behind it are a 4 x 4 table, from a cost DP.
3. A conversation's tables, one per segment, give the cheapest remaining cost
   behind each segment (from the last one back).
4. With these the DP of every segment runs again and keeps its optimal arcs.
   Nodes are ranked by the first letter of their least audit, then by 2, 4, 8
   ... letters: the rank of twice the length is that of the pair (rank, rank of
   the node that the pointer of this length leads to), and the pointers double
   along.  Bits of a step's number pick the pointers that lead to it, which
   reads off a segment's least audit for each state before it.
5. The segments' audits are linked from state 0 on, and a stream over the
   sorted rows applies them and hashes the repaired text.

Memory is bounded by blocks; a conversation meets in one task as one row per
segment, as its audit (one value of the result), and as a stream of rows for
its hash, which SHA-256 reads in order.

Defined cases: a null role or text counts as one space; null turns come first;
equal turns are ordered by role, then by the SHA-256 of the text, and identical
rows are alike, so any order of theirs gives the same result; an initial other
than s, u and a can only be changed or deleted; a null conversation id is a
conversation of its own; extra columns are ignored whatever their names; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_arrow

BLOCK_BITS = 12              # 4096 rows to a block
BATCH_BLOCKS = 4             # blocks' rows worked on at once, at least
WHITE = " \t\n\x0b\x0c\r"
# Costs and letters of the edits.
DELETE, CHANGE, INSERT, TRUNCATED = 3, 2, 2, 1
LETTERS = np.frombuffer(b"DIKR", np.uint8)
FAR = 1 << 60
ASKED = np.array([2, 2, 3, 2])             # state after an inserted or changed row, by state
KEPT = np.array([[1, 4, 4, 4],             # state after a kept row, by initial (s, u, a, other) and state; 4: not allowed
                 [2, 2, 4, 2],
                 [4, 4, 3, 4],
                 [4, 4, 4, 4]])


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text): rows damaged by crc32("conv:turn") % 20."""
    space = F.lit(" ")
    rows = turns.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
                        F.coalesce(F.col(f"`{role}`"), space).alias("role"), F.coalesce(F.col(f"`{text}`"), space).alias("text"))
    name = F.concat(F.coalesce(F.col("conv").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(name.cast("binary")) % 20
    return rows.withColumn("kind", kind).where("kind <> 0").select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text")).alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


# ------------------------------------------------------------------ costs

def insertions(c: np.ndarray) -> None:
    """Adds the insertions at one place to the remaining costs c[..., state]."""
    user, assistant = c[..., 2].copy(), c[..., 3].copy()
    c[..., 2] = np.minimum(user, assistant + INSERT)
    c[..., 3] = np.minimum(assistant, user + INSERT)
    for q in (0, 1):
        c[..., q] = np.minimum(c[..., q], c[..., 2] + INSERT)


def edits(after: np.ndarray, initial: np.ndarray, must_go: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Costs (segment, edit D K R, ..., state) of editing one row of each segment,
    given the costs behind it."""
    wide = np.concatenate([after, np.full((*after.shape[:-1], 1), FAR)], axis=-1)
    to = KEPT[initial]                                            # (segment, state)
    index = to.reshape(len(to), *([1] * (after.ndim - 2)), 4)
    stay = np.where(must_go, FAR, TRUNCATED * cut).reshape(-1, *([1] * (after.ndim - 1)))
    keep = np.take_along_axis(wide, np.broadcast_to(index, after.shape), axis=-1) + stay
    return np.minimum(np.stack([after + DELETE, keep, after[..., ASKED] + CHANGE + stay], axis=1), FAR)


def end_costs() -> np.ndarray:
    """Remaining costs behind a conversation's last row."""
    c = np.array([0, FAR, FAR, 0])
    insertions(c)
    return c


class Segments:
    """Segments of sorted rows: ``first`` and ``size`` index the row arrays."""

    def __init__(self, first: np.ndarray, size: np.ndarray, initial: np.ndarray, must_go: np.ndarray, cut: np.ndarray):
        self.first, self.size = first, size
        self.rows = (initial, must_go, cut)

    def backwards(self, c: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Runs the DP over all segments at once, from their last rows back: changes ``c``
        (segment, ..., state) and yields (segments, their rows, costs of D, K and R)."""
        order = np.argsort(-self.size, kind="stable")
        sizes = self.size[order]
        for back in range(int(sizes[0]) if len(sizes) else 0):
            now = order[:np.searchsorted(-sizes, -back, side="left")]      # segments with more than ``back`` rows
            row = self.first[now] + self.size[now] - 1 - back
            costs = edits(c[now], *(x[row] for x in self.rows))
            best = costs.min(axis=1)
            insertions(best)
            c[now] = np.minimum(best, FAR)
            yield now, row, costs

    def tables(self) -> np.ndarray:
        """(segment, state behind, state before) -> least cost."""
        c = np.tile(np.where(np.eye(4, dtype=bool), 0, FAR), (len(self.first), 1, 1))
        for _ in self.backwards(c):
            pass
        return c

    def audits(self, behind: np.ndarray, last: np.ndarray, wanted: np.ndarray) -> list[tuple[int, int, int, str]]:
        """(segment, state before, state behind, least audit) for the wanted pairs.

        ``behind`` holds the remaining costs after each segment; a segment that
        is its conversation's last has the closing insertions in its audit."""
        n_rows, n = len(self.rows[0]), len(self.first)
        place = np.arange(n_rows) + np.repeat(np.arange(n), self.size)     # a segment has a place more than rows
        end = self.first + np.arange(n) + self.size
        nodes = 4 * (n_rows + n)
        tight, goes = np.zeros((4, nodes), bool), np.zeros((4, nodes), np.int64)   # arcs by letter, D I K R
        states = np.arange(4)
        c = behind.copy()
        close = end[last][:, None] * 4
        tight[1, close + [1, 2]] = True
        goes[1, close + 1], goes[1, close + 2] = close + 2, close + 3
        for now, row, costs in self.backwards(c):
            here, best = place[row][:, None] * 4, c[now]
            to = here + 4
            kept = np.minimum(KEPT[self.rows[0][row]], 3)
            tight[:, here + states] = [costs[:, 0] == best, best[:, ASKED] + INSERT == best, costs[:, 1] == best, costs[:, 2] == best]
            goes[:, here + states] = [to + states, here + ASKED, to + kept, to + ASKED]
        rank = audit_ranks(tight, goes)
        label, after = least_arcs(tight, goes, rank)
        pointers, steps = [after], (label > 0).astype(np.int64)
        while (label[pointers[-1]] > 0).any():
            steps = steps + steps[pointers[-1]]
            pointers.append(pointers[-1][pointers[-1]])
        seg, q = wanted[:, 0], wanted[:, 1]
        start = (self.first + np.arange(n))[seg] * 4 + q
        length = steps[start]
        path = np.repeat(np.arange(len(start)), length)
        step = np.arange(len(path)) - np.repeat(np.cumsum(length) - length, length)
        node = start[path]
        for k, pointer in enumerate(pointers):
            node = np.where(step >> k & 1, pointer[node], node)
        text = LETTERS[label[node] - 1].tobytes().decode()
        at = np.concatenate([[0], np.cumsum(length)])
        stop = pointers[-1][start] % 4 if len(start) else start
        return [(int(s), int(a), int(b), text[i:j]) for s, a, b, i, j in zip(seg, q, stop, at[:-1], at[1:])]


def least_arcs(tight: np.ndarray, goes: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(letter number, node behind) of each node's arc of least (letter, rank
    behind); letter 0 at an end, which leads to itself."""
    key = np.where(tight, np.arange(1, 5)[:, None] * (rank.max() + 1) + rank[goes], FAR)
    pick, some = key.argmin(axis=0), tight.any(axis=0)
    nodes = np.arange(len(rank))
    return np.where(some, pick + 1, 0), np.where(some, goes[pick, nodes], nodes)


def audit_ranks(tight: np.ndarray, goes: np.ndarray) -> np.ndarray:
    """Ranks of the nodes by their least audits.

    The first round compares one letter, each further round twice as many: the
    rank of a pair (rank, rank of the node that many letters on).  The letters
    that leave a node differ, so its first one leads to a single next node and
    pointers double as the ranks do.  Ends rank before all."""
    rank, here = least_arcs(tight, goes, np.zeros(tight.shape[1], np.int64))
    letters = rank
    while True:
        _, rank = np.unique(rank * (len(rank) + 5) + rank[here], return_inverse=True)
        if not (letters[here] > 0).any():
            return rank
        here = here[here]


# ------------------------------------------------------------------ on Spark

def _initial(role: Column) -> Column:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3).cast("int")


def ordered_rows(rows: DataFrame) -> DataFrame:
    """Rows with ``at``, a number that rises in (conversation, turn, role, text) order."""
    keyed = rows.withColumn("hash", F.sha2("text", 256)).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(4096)))
    by = ["conv", F.col("turn").asc_nulls_first(), "role", "hash", "salt"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keyed.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id()) \
        .drop("salt")


def faults(ordered: DataFrame) -> DataFrame:
    """(conv, at, initial, blank, duplicate, truncated): each row's first fault."""
    seen = ordered.groupBy("conv", "role", "hash").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("is_first"))
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    blank = shown == ""
    slim = ordered.select("conv", "at", _initial(F.col("role")).alias("initial"), blank.alias("blank"),
                          (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("open"))
    again = F.col("is_first").isNull() & ~F.col("blank")
    return slim.join(seen, "at", "left").select(
        "conv", "at", "initial", "blank", again.alias("duplicate"), (F.col("open") & ~F.col("blank") & ~again).alias("truncated"))


def _by_block(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.Table]:
    """Tables of whole blocks from rows sorted by their block."""
    held: list[pa.RecordBatch] = []
    n = 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n < BATCH_BLOCKS << bits:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        block = t.column("at").to_numpy() >> bits
        whole = int(np.searchsorted(block, block[-1], side="left"))
        if whole:
            yield t.slice(0, whole)
            rest = t.slice(whole).combine_chunks().to_batches()
            held, n = rest, sum(x.num_rows for x in rest)
    if n:
        yield pa.Table.from_batches(held).combine_chunks()


def _segments(t: pa.Table, bits: int) -> tuple[Segments, list, np.ndarray]:
    """Segments of a table (conv, at, initial, blank, duplicate, truncated), their conversations and blocks."""
    conv = t.column("conv").to_pylist()
    block = t.column("at").to_numpy() >> bits
    first = np.array([k for k in range(len(conv)) if not k or conv[k] != conv[k - 1] or block[k] != block[k - 1]], np.int64)
    size = np.diff(np.append(first, len(conv)))
    flag = {c: t.column(c).to_numpy().astype(bool) for c in ("blank", "duplicate", "truncated")}
    found = Segments(first, size, t.column("initial").to_numpy(), flag["blank"] | flag["duplicate"], flag["truncated"].astype(np.int64))
    return found, [conv[k] for k in first.tolist()], block[first]


def segment_tables(marked: DataFrame, conv_type: str, bits: int = BLOCK_BITS) -> DataFrame:
    """Per segment: its faults, roles that do not follow each other, first and last initial, and the cost table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_block(batches, bits):
            segs, conv, block = _segments(t, bits)
            initial = segs.rows[0]
            pair = initial[:-1] * 4 + initial[1:]
            wrong = np.append(~np.isin(pair, (1, 6, 9)), False)            # s-u, u-a, a-u
            wrong[segs.first + segs.size - 1] = False
            sums = [np.add.reduceat(x.astype(np.int64), segs.first) for x in (
                *(t.column(c).to_numpy() for c in ("blank", "duplicate", "truncated")), wrong)]
            cols = [pa.array(conv, t.column("conv").type), pa.array(block), *[pa.array(x) for x in sums],
                    pa.array(initial[segs.first]), pa.array(initial[segs.first + segs.size - 1]),
                    pa.array(list(segs.tables().reshape(-1, 16)), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, names=["conv", "block", "blank", "duplicate", "truncated", "illegal",
                                                          "head", "tail", "costs"])

    parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = marked.repartition(parts, F.shiftright("at", bits)).sortWithinPartitions("at")
    return map_arrow(rows, run, f"conv {conv_type}, block bigint, blank bigint, duplicate bigint, truncated bigint, "
                     "illegal bigint, head int, tail int, costs array<bigint>")


def chain_back(tables: DataFrame, conv_type: str) -> DataFrame:
    """Per conversation and segment: the remaining costs behind it, and on the first one the sums of the conversation."""
    grouped = tables.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        F.sort_array(F.collect_list(F.struct("block", "head", "tail", "costs"))).alias("segs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                segs, behind = r["segs"], end_costs()
                illegal = r["illegal"] + sum(x["tail"] * 4 + y["head"] not in (1, 6, 9) for x, y in zip(segs, segs[1:]))
                rows = []
                for k, s in reversed(list(enumerate(segs))):
                    rows.append((r["conv"], s["block"], k == 0, k == len(segs) - 1, behind.tolist()))
                    behind = np.minimum(np.array(s["costs"]).reshape(4, 4) + behind[:, None], FAR).min(axis=0)
                totals = (r["blank"], r["duplicate"], r["truncated"], illegal, int(behind[0]))
                out += [(*x, *(totals if x[2] else (None,) * 5)) for x in rows]
            if out:
                types = [b.schema.field(0).type, pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.int64())] + [pa.int64()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=[
                    "conv", "block", "is_first", "is_last", "behind", "blank", "duplicate", "truncated", "illegal", "cost"])

    return map_arrow(grouped, run, f"conv {conv_type}, block bigint, is_first boolean, is_last boolean, behind array<bigint>, "
                     "blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint")


def segment_audits(marked: DataFrame, chained: DataFrame, conv_type: str, bits: int = BLOCK_BITS) -> DataFrame:
    """(conv, block, before, behind, audit): a segment's least audits, by the state before it."""
    # the costs ride along on a row of their own, before the segment's first row
    extra = chained.select("conv", F.shiftleft("block", bits).alias("at"), "is_first", "is_last", "behind")
    rows = marked.select("conv", "at", "initial", "blank", "duplicate", "truncated").unionByName(extra, allowMissingColumns=True)
    by = F.shiftright("at", bits)
    parts = int(marked.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, by).sortWithinPartitions(by, F.col("behind").isNull(), "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _by_block(batches, bits):
            is_row = pc.is_null(t.column("behind"))
            told = {(r["conv"], r["at"] >> bits): r for r in t.filter(pc.invert(is_row))
                    .select(["conv", "at", "is_first", "is_last", "behind"]).to_pylist()}
            segs, conv, block = _segments(t.filter(is_row).combine_chunks(), bits)
            facts = [told[k] for k in zip(conv, block.tolist())]
            wanted = [(k, q) for k, f in enumerate(facts) for q in ((0,) if f["is_first"] else range(4))]
            found = segs.audits(np.array([f["behind"] for f in facts]), np.array([f["is_last"] for f in facts]),
                                np.array(wanted, np.int64))
            cols = zip(*[(conv[s], int(block[s]), a, z, text) for s, a, z, text in found])
            types = [t.column("conv").type, pa.int64(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, types)],
                                             names=["conv", "block", "before", "behind", "audit"])

    return map_arrow(rows, run, f"conv {conv_type}, block bigint, `before` int, behind int, audit string")


def chain_audits(parts: DataFrame, conv_type: str) -> DataFrame:
    """(conv, audit): the segments' audits linked from state 0 on."""
    grouped = parts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("block", "before", "behind", "audit"))).alias("segs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            audits = []
            for segs in b.column(1).to_pylist():
                state, block, text = 0, None, []
                for s in segs:
                    if s["block"] != block and s["before"] == state:
                        block, state = s["block"], s["behind"]
                        text.append(s["audit"])
                audits.append("".join(text))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(audits, pa.string())], names=["conv", "audit"])

    return map_arrow(grouped, run, f"conv {conv_type}, audit string")


def repaired_hashes(ordered: DataFrame, audits: DataFrame, conv_type: str) -> DataFrame:
    """(conv, audit, repaired_sha256), by a stream over the rows of sorted conversations."""
    rows = ordered.select("conv", "at", "role", "text") \
        .unionByName(audits.select("conv", F.lit(-1).cast("bigint").alias("at"), "audit"), allowMissingColumns=True)
    parts = int(ordered.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "conv").sortWithinPartitions("conv", "at").select("conv", "at", "role", "text", "audit")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Repair | None = None
        for b in batches:
            done = []
            for conv, at, role, text, audit in zip(*(b.column(k).to_pylist() for k in range(5))):
                if at == -1:
                    if now is not None:
                        done.append(now.finish())
                    now = _Repair(conv, audit)
                else:
                    now.row(role, text)
            yield _batch(done, b.schema.field(0).type)
            conv_arrow = b.schema.field(0).type
        if now is not None:
            yield _batch([now.finish()], conv_arrow)

    return map_arrow(rows, run, f"conv {conv_type}, audit string, repaired_sha256 string")


def _batch(done: list[tuple], conv: pa.DataType) -> pa.RecordBatch:
    cols = list(zip(*done)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(cols[0], conv), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.string())],
                                      names=["conv", "audit", "repaired_sha256"])


class _Repair:
    """Applies an audit to a conversation's rows as they come by."""

    def __init__(self, conv, audit: str):
        self.conv, self.audit, self.at, self.state = conv, audit, 0, 0
        self.sha, self.begun = hashlib.sha256(), False

    def _write(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.begun else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.begun = True

    def _asked(self, text: str) -> None:
        self.state = int(ASKED[self.state])
        self._write("user" if self.state == 2 else "assistant", text)

    def _insertions(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.at += 1
            self._asked("")

    def row(self, role: str, text: str) -> None:
        self._insertions()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            self._asked(text)
        elif edit == "K":
            self.state = int(KEPT["sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3][self.state])
            self._write(role, text)

    def finish(self) -> tuple:
        self._insertions()
        return self.conv, self.audit, self.sha.hexdigest()


def repair(rows: DataFrame, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(conv, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of rows (conv, turn, role, text) without null roles and texts."""
    conv_type = rows.schema["conv"].dataType.simpleString()
    ordered = materialize(ordered_rows(rows.select("conv", "turn", "role", "text")), "turns")
    marked = materialize(faults(ordered), "faults")
    chained = materialize(chain_back(segment_tables(marked, conv_type, block_bits), conv_type), "costs")
    audits = chain_audits(segment_audits(marked, chained, conv_type, block_bits), conv_type)
    hashes = repaired_hashes(ordered, audits, conv_type)
    gaps = ordered.groupBy("conv").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("bigint").alias("gaps"))
    sums = chained.where("is_first").select("conv", "blank", "duplicate", "truncated", "illegal", "cost")
    return _join(_join(gaps, sums), hashes)


def _join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    b = b.withColumnRenamed("conv", "_other")
    return a.join(b, F.col("conv").eqNullSafe(F.col("_other")), how).drop("_other")


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                         text: str = "text", block_bits: int = BLOCK_BITS) -> DataFrame:
    """Damages the rows of a conversation table, then repairs them: a row per
    original conversation, also where no row is left."""
    every = turns.select(F.col(f"`{conv}`").alias("conv")).distinct()
    found = _join(every, repair(damage(turns, conv, turn, role, text), block_bits), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(F.col("conv").alias(conv), *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
                        F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
