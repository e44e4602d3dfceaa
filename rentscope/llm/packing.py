"""Best-fit packing by linear grouping.

1. Texts are encoded in Arrow batches and cut into pieces of at most
   ``capacity`` tokens; the piece table (numbers only) is written once to the
   shared folder, each piece with its rank among the pieces of its length in
   its task.
2. Only the histogram of lengths (``capacity`` rows at most) reaches the
   driver.  ``plan_sequences`` works on it: large lengths are cut into groups
   of equal cardinality and rounded up to the group's largest; few-size
   configurations are filled by subset sums; actual lengths replace the
   rounded ones; small lengths go best-fit into what is left.
3. The plan says, for each length, which ranks go to which sequences; its size
   depends on ``capacity`` and ``groups``, not on the number of documents.
   Global ranks come from small per-task counts; the assignment is a lookup.

Defined cases: null and empty texts are the end token alone; repeated rows are
packed each; ties in length are told apart by rank; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import map_arrow
from .encode import END_ID, WordEncoder

CAPACITY = 4096
GROUPS = 1024     # sizes left after rounding the large lengths up
SMALL_SHARE = 8   # lengths up to capacity / 8 are small


def pieces(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
           with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, crc, task, local[, ids]): the documents cut to the capacity."""
    end = END_ID.to_bytes(4, "little")
    schema = "id bigint, piece int, start bigint, length bigint, crc bigint, task int, local bigint"
    if with_ids:
        schema += ", ids array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = WordEncoder.of(tokenizer)
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for b in batches:
            out: list[tuple] = []
            ids: list[np.ndarray] = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                raw = enc.encode(t) + end
                for k, at in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[at:at + 4 * capacity]
                    n = len(part) // 4
                    out.append((doc, k, at // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
            if out:
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
                cols = [pa.array(c, t) for c, t in zip(zip(*out), types)]
                names = ["id", "piece", "start", "length", "crc", "task", "local"]
                if with_ids:
                    cols.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    return map_arrow(src, run, schema)


# ------------------------------------------------------------------ the plan

class Plan:
    """Lookup of (length, rank) -> (sequence, offset): rows of (length, first
    rank, count, first sequence, offset), one piece per sequence in a row."""

    def __init__(self) -> None:
        self.rows: list[tuple[int, int, int, int, int]] = []
        self.sequences = 0

    def put(self, length: int, rank: int, count: int, sequence: int, offset: int) -> None:
        self.rows.append((length, rank, count, sequence, offset))

    def arrays(self) -> list[np.ndarray]:
        return [np.array(c, np.int64) for c in zip(*sorted(self.rows))] if self.rows else [np.zeros(0, np.int64)] * 5


def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Large lengths in descending order, cut into groups of equal cardinality:
    (rounded size, [[length, first rank, count], ...]) per group."""
    total = sum(counts.values())
    if not total:
        return []
    target = -(-total // groups)
    out: list[tuple[int, list[list[int]]]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            if not room:
                if not out or out[-1][0] != length:
                    out.append((length, []))
                room = target
            take = min(room, left)
            out[-1][1].append([length, rank, take])
            rank, left, room = rank + take, left - take, room - take
    return out


def _fullest(sizes: list[int], left: list[int], first: int, room: int) -> list[int]:
    """Indexes (with repeats) of sizes from ``first`` on whose sum is the largest
    within ``room``, respecting the counts left: subset sums as bits of an integer."""
    limit = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for k in range(first, len(sizes)):
        s = sizes[k]
        for _ in range(min(left[k], room // s) if s <= room else 0):
            wider = (reach | reach << s) & limit
            if wider == reach:
                break
            steps.append((k, reach))
            reach = wider
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, []
    for k, before in reversed(steps):
        if not before >> total & 1:
            chosen.append(k)
            total -= sizes[k]
    return chosen


def plan_sequences(counts: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> Plan:
    """Sequences for a histogram {length: pieces} (lengths 1 to ``capacity``)."""
    plan = Plan()
    small_max = capacity // SMALL_SHARE
    grouped = linear_groups({k: v for k, v in counts.items() if v and k > small_max}, groups)
    sizes = [g[0] for g in grouped]
    left = [sum(seg[2] for seg in g[1]) for g in grouped]
    free: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first sequence, count)
    open_rooms = 0  # bit r: some sequence has r tokens of room

    def offer(room: int, sequence: int, count: int) -> None:
        nonlocal open_rooms
        if room:
            free[room].append((sequence, count))
            open_rooms |= 1 << room

    # configurations of few sizes, each used as often as the counts allow
    first = 0
    while first < len(sizes):
        if not left[first]:
            first += 1
            continue
        left[first] -= 1
        slots = [first, *_fullest(sizes, left, first, capacity - sizes[first])]
        left[first] += 1
        need = {k: slots.count(k) for k in slots}
        times = min(left[k] // n for k, n in need.items())
        for k, n in need.items():
            left[k] -= n * times
        # actual lengths replace the rounded sizes: runs of sequences with equal contents
        drawn = []
        for k in slots:
            want, segments = times, []
            while want:
                seg = grouped[k][1][0]
                take = min(want, seg[2])
                segments.append([seg[0], seg[1], take])
                seg[1], seg[2], want = seg[1] + take, seg[2] - take, want - take
                if not seg[2]:
                    grouped[k][1].pop(0)
            drawn.append(segments)
        done = 0
        while done < times:
            run = min(segments[0][2] for segments in drawn)
            offset = 0
            for segments in drawn:
                seg = segments[0]
                plan.put(seg[0], seg[1], run, plan.sequences + done, offset)
                offset += seg[0]
                seg[1], seg[2] = seg[1] + run, seg[2] - run
                if not seg[2]:
                    segments.pop(0)
            offer(capacity - offset, plan.sequences + done, run)
            done += run
        plan.sequences += times

    # small lengths, longest first, into the tightest room that holds them
    for length in sorted((k for k, v in counts.items() if v and k <= small_max), reverse=True):
        rank, n = 0, counts[length]
        while n:
            fits = open_rooms >> length
            if fits:
                room = length + (fits & -fits).bit_length() - 1
                sequence, count = free[room].pop()
                if not free[room]:
                    open_rooms &= ~(1 << room)
                take = min(n, count)
                if take < count:
                    offer(room, sequence + take, count - take)
            else:
                per = capacity // length
                take, room, sequence = max(1, n // per), capacity, plan.sequences
                plan.sequences += take
            plan.put(length, rank, take, sequence, capacity - room)
            offer(room - length, sequence, take)
            rank, n = rank + take, n - take
    return plan


# ------------------------------------------------------------------ on Spark

def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         groups: int = GROUPS, with_ids: bool = False) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset[, ids]), a row per piece."""
    cut = materialize(pieces(docs, tokenizer, id_col, text, capacity, with_ids), "pieces")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = plan_sequences(counts, capacity, groups)
    length, rank, _, sequence, offset = plan.arrays()
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["length", "task"]) \
        .select("id", "piece", "start", "length", "crc", (F.col("base") + F.col("local")).alias("rank"),
                *(["ids"] if with_ids else []))
    top = int(max(counts.values(), default=0)) + 1
    sent = docs.sparkSession.sparkContext.broadcast((length * top + rank, rank, sequence, offset))
    schema = "id bigint, piece int, start bigint, length bigint, crc bigint, sequence_id bigint, offset bigint"
    if with_ids:
        schema += ", ids array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ranks, sequences, offsets = sent.value
        for b in batches:
            n, r = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(key, n * top + r, side="right") - 1
            cols = [b.column(k) for k in range(5)] + [pa.array(sequences[at] + r - ranks[at]), pa.array(offsets[at])]
            names = ["id", "piece", "start", "length", "crc", "sequence_id", "offset"]
            if with_ids:
                cols.append(b.column(6))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return ranked.mapInArrow(run, schema).withColumnRenamed("id", id_col).withColumnRenamed("crc", "ids_crc32")
