"""Packing by shortest-pack-first over the length histogram, with free cuts.

1. Texts are encoded once (Arrow batches); a document's ids, with an end id,
   are cut into segments of at most ``capacity`` ids.  Segments are written to
   the shared folder, each with its rank among those of its length in its task.
2. Only the histogram of segment lengths (``capacity`` rows at most) reaches
   the driver.  ``plan_packs`` places the lengths, longest first, into the
   shortest pack, that is the one with most room: a run of segments of one
   length goes to a run of packs with the same pattern, so each step updates
   the counts of two patterns, whatever the number of documents.  A pack is
   opened where no open one has room, while there are packs left: as many as
   the tokens fill, and one of each power of two that makes up the remainder.
   Afterwards a segment that fits nowhere is cut: its first ids fill the
   shortest pack, and the rest waits for the turn of its length.  The packs hold as
   many tokens as there are, so at the end every one is full: no padding.
3. The patterns come back to the documents by rank: global ranks are a task's
   rank plus the counts of the tasks before, and the plan maps ranges of ranks
   to sequences.

The plan's size depends on ``capacity`` alone.  Defined cases: null and empty
texts are the end id alone; repeated rows are packed each; equal lengths are
told apart by rank; a very long text fills sequences of its own and its tail is
packed; extra columns are ignored whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import os
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

CAPACITY = 2048
END_ID = 1
BROADCAST_ROWS = 200_000   # rows of (length, task, base) that may be sent to every executor, some 20 MB



class ByteEncoder:
    """Ids of texts by the byte-level BPE of a ``tokenizers`` file.

    Where the same vocabulary lies beside the file as ranks (``.tiktoken``),
    texts are encoded from it, five times as fast; ``tests/llm`` compares the
    two on every character and on adversarial texts."""

    _held: dict[str, ByteEncoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.fast = None
        ranks = os.path.splitext(path)[0] + ".tiktoken"
        if os.path.exists(ranks):
            import tiktoken
            from public_tokenizers import PATTERN
            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            marks = {t.content: k for k, t in self.tok.get_added_tokens_decoder().items()}
            self.fast = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=table, special_tokens=marks)

    @classmethod
    def of(cls, path: str) -> ByteEncoder:
        """One encoder per worker process and tokenizer file."""
        if path not in cls._held:
            cls._held[path] = cls(path)
        return cls._held[path]

    def encode(self, text: str | None) -> list[int]:
        """The ids of a text; null is empty."""
        if not text:
            return []
        if self.fast is not None:
            return self.fast.encode(text, allowed_special="all")
        return self.tok.encode(text, add_special_tokens=False).ids


def segments(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text",
             capacity: int = CAPACITY) -> DataFrame:
    """(id, start, length, total, task, local, ids): documents cut to the capacity.

    ``ids`` are unsigned little-endian 32-bit values in bytes, ``local`` is the
    rank among the task's segments of that length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = ByteEncoder.of(tokenizer)
        task = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for b in batches:
            out: list[tuple] = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = np.array([*enc.encode(t), END_ID], "<u4")
                for at in range(0, len(ids), capacity):
                    part = ids[at:at + capacity]
                    n = len(part)
                    out.append((doc, at, n, len(ids), task, seen[n], part.tobytes()))
                    seen[n] += 1
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 names=["id", "start", "length", "total", "task", "local", "ids"])

    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text}`").cast("string").alias("t"))
    return map_arrow(src, run, "id bigint, start bigint, length bigint, total bigint, task int, local bigint, ids binary")


# ------------------------------------------------------------------ the plan

class Plan:
    """Where the segments go.  ``levels[k]`` lists the k-th pieces of segments
    as (length, first rank, count, start, piece length, first sequence, offset):
    segments of that length and those ranks, one to a sequence."""

    def __init__(self) -> None:
        self.levels: list[list[tuple[int, int, int, int, int, int, int]]] = []
        self.sequences = 0

    def put(self, level: int, row: tuple[int, int, int, int, int, int, int]) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(row)

    def arrays(self) -> list[list[np.ndarray]]:
        return [[np.array(c, np.int64) for c in zip(*sorted(rows))] for rows in self.levels]


def plan_packs(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Shortest-pack-first for a histogram {length: segments} (lengths 1 to ``capacity``)."""
    plan = Plan()
    closed, rest = divmod(sum(n * c for n, c in counts.items()), capacity)   # packs not opened yet; the remainder
    packs: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]  # by room: (first sequence, count, filled)
    rooms = 0  # bit r: some pack has r tokens of room

    def offer(room: int, sequence: int, count: int, filled: int) -> None:
        nonlocal rooms
        if room:
            packs[room].append((sequence, count, filled))
            rooms |= 1 << room

    for k in range(capacity.bit_length()):
        if rest >> k & 1:
            offer(1 << k, plan.sequences, 1, 0)
            plan.sequences += 1

    # by length left: runs (segment length, first rank, count, start of the part left, pieces cut before)
    waiting: list[list[tuple[int, int, int, int, int]]] = [[] for _ in range(capacity + 1)]
    for n, c in counts.items():
        if c:
            waiting[n].append((n, 0, c, 0, 0))
    for n in range(capacity, 0, -1):
        for length, rank, count, start, level in waiting[n]:
            while count:
                room = rooms.bit_length() - 1
                if room < n and closed:
                    opened = min(closed, max(1, count // (capacity // n)))
                    offer(capacity, plan.sequences, opened, 0)
                    plan.sequences, closed, room = plan.sequences + opened, closed - opened, capacity
                sequence, alike, filled = packs[room].pop()
                if not packs[room]:
                    rooms &= ~(1 << room)
                take, part = min(count, alike), min(n, room)
                plan.put(level, (length, rank, take, start, part, sequence, filled))
                if take < alike:
                    offer(room, sequence + take, alike - take, filled)
                offer(room - part, sequence, take, filled + part)
                if part < n:
                    waiting[n - part].append((length, rank, take, start + part, level + 1))
                rank, count = rank + take, count - take
    return plan


# ------------------------------------------------------------------ on Spark

def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
         with_ids: bool = False) -> DataFrame:
    """(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset[, ids]), a row per piece.

    ``start`` counts the document's ids before the piece, ``offset`` the
    sequence's; sequences hold ``capacity`` ids or a power of two."""
    cut = materialize(segments(docs, tokenizer, id_col, text, capacity), "segments")
    per_task = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    found = per_task.groupBy("length").agg(F.sum("n").alias("n"), F.count("*").alias("tasks")).collect()
    counts = {r["length"]: r["n"] for r in found}
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    if sum(r["tasks"] for r in found) <= BROADCAST_ROWS:  # else the segments are shuffled to it
        base = F.broadcast(base)
    ranked = cut.join(base, ["length", "task"]).select(
        "id", "start", "length", "total", (F.col("base") + F.col("local")).alias("rank"), "ids")
    top = max(counts.values(), default=0) + 1
    sent = docs.sparkSession.sparkContext.broadcast(
        [(a[0] * top + a[1], *a[1:]) for a in plan_packs(counts, capacity).arrays()])
    names = ["id", "start", "length", "crc", "total", "sequence_id", "offset"]
    schema = ", ".join(f"{c} bigint" for c in names) + (", ids array<bigint>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, length, total, rank = (b.column(k).to_numpy() for k in (1, 2, 3, 4))
            raw = b.column(5).to_pylist()
            row, parts, level = np.arange(b.num_rows), [], 0
            while row.size:
                key, first, _, cut_at, part, sequence, offset = sent.value[level]
                at = np.searchsorted(key, length[row] * top + rank[row], side="right") - 1
                parts.append((row, cut_at[at], part[at], sequence[at] + rank[row] - first[at], offset[at]))
                row, level = row[cut_at[at] + part[at] < length[row]], level + 1
            if not parts:
                continue
            row, at, n, sequence, offset = (np.concatenate(c) for c in zip(*parts))
            ids = [raw[i][4 * a:4 * (a + k)] for i, a, k in zip(row.tolist(), at.tolist(), n.tolist())]
            cols = [b.column(0).take(pa.array(row)), pa.array(start[row] + at), pa.array(n),
                    pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array(total[row]), pa.array(sequence),
                    pa.array(offset)]
            if with_ids:
                cols.append(pa.array([np.frombuffer(x, "<u4").astype(np.int64) for x in ids], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(cols, names=names + ["ids"] * with_ids)

    return map_arrow(ranked, run, schema).withColumnsRenamed(
        {"id": id_col, "crc": "ids_crc32", "total": "doc_tokens"})
