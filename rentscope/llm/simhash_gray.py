"""SimHash near-dedup over a Gray-order hierarchical index.

1. ``fingerprints``: one 64-bit SimHash per text, in Arrow batches.
2. ``gray_index``: the distinct fingerprints are sorted by Gray rank with a range
   partitioning and cut into ranges of neighbours.  Neighbours in this order
   share most of their leading bits, and often others: a range's node is the
   mask of the bits that all of its members share, and their value.
3. ``range_pairs``: upper nodes factor the bits that several ranges share.
   From the root down, every range meets the nodes; differences on shared bits
   accumulate, and a node goes with all below it once they exceed the limit.
   With b shared leading bits about C(b, 0) + ... + C(b, 3) of 2^b ranges stay.
4. Each pair of ranges that stays is one unit of work: inside, the same walk goes
   on over groups of fingerprints, down to single ones (``_walk``).
5. A unit reports a spanning forest of its links (not all pairs); the star
   rounds of ``components`` join the forests.

The nodes of ranges are the only thing that every task holds: ranges grow with
the table once there are ``MAX_RANGES`` of them, so that this is 48 MB at most.
Equal fingerprints are one node throughout, so groups of copies of any size
cost one row.  Only fingerprints and ids are shuffled, never texts.

Defined cases: null and empty texts have fingerprint zero and link like any
other; texts of fewer words than the shingle length are one shingle; repeated
rows keep a row each; extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_arrow
from .components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
RANGES = 64             # ranges of a small table,
RANGE_ROWS = 512, 1 << 16   # ... least and usual largest number of fingerprints in one
MAX_RANGES = 1 << 21    # above this number ranges grow
LEAF = 16            # fingerprints in a lowest group
FAN = 8              # groups under an upper node
HASH_SEED = 42
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# --------------------------------------------------------------- fingerprints

def simhash(text: bytes | None, shingle: int = SHINGLE_WORDS) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text; a bit is set if more than half
    of the shingles' XXH64 values have it."""
    import xxhash
    words = (text or b"").translate(_LOWER).split()  # bytes.split: U+0009-U+000D and space
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(line, HASH_SEED)]
    else:
        lens = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lens + 1) - 1
        starts = (ends - lens)[:len(words) - shingle + 1].tolist()
        h = xxhash.xxh64_intdigest
        hashes = [h(line[s:e], HASH_SEED) for s, e in zip(starts, ends[shingle - 1:].tolist())]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[at:at + (1 << 15)], "<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(b) for b in np.flatnonzero(2 * ones > len(hashes))))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
                 shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(id, fp): the id column and the fingerprint as a signed bigint, a row per row."""
    src = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"),
                      F.col(f"`{text}`").cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], names=["id", "fp"])

    return map_arrow(src, run, "id bigint, fp bigint")


def fingerprint_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# ------------------------------------------------------- Gray-order hierarchy

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each value in the Gray code sequence (prefix parity)."""
    r = x.astype(np.uint64).copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


def _grouped(mask: np.ndarray, value: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(shared mask, value) of every ``size`` neighbouring nodes."""
    cuts = np.arange(0, len(mask), size)
    all_ones = np.bitwise_and.reduceat(value, cuts)
    any_ones = np.bitwise_or.reduceat(value | ~mask, cuts)      # a bit that a member leaves open is not shared
    shared = np.bitwise_and.reduceat(mask, cuts) & ~(all_ones ^ any_ones)
    return shared, all_ones & shared


def _levels(mask: np.ndarray, value: np.ndarray, size: int, least: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    """Nodes over ``size``, then ``FAN`` neighbours at a time: lowest groups first,
    root last; ``least`` levels at least."""
    out = [_grouped(mask, value, size)]
    while len(out[-1][0]) > 1 or len(out) < least:
        out.append(_grouped(*out[-1], FAN))
    return out


def _groups(x: np.ndarray, least: int = 1) -> list[tuple[np.ndarray, np.ndarray]]:
    return _levels(np.full(len(x), ~np.uint64(0)), x, LEAF, least)


def _children(a: np.ndarray, b: np.ndarray, fan: int, n_a: int, n_b: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of children of the node pairs: parent index, left, right; of one tree with itself, each pair once."""
    i = np.repeat(np.arange(fan), fan)
    j = np.tile(np.arange(fan), fan)
    left, right = a[:, None] * fan + i, b[:, None] * fan + j
    ok = (left < n_a) & (right < n_b)
    if same:
        ok &= (a != b)[:, None] | (i <= j)
    return np.repeat(np.arange(len(a)), ok.sum(axis=1)), left[ok], right[ok]


def _merge(labels: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Union by smallest label, in place, for the links (u, v)."""
    while len(u):
        lu, lv = labels[u], labels[v]
        open_ = lu != lv
        if not open_.any():
            return
        u, v, lu, lv = u[open_], v[open_], lu[open_], lv[open_]
        np.minimum.at(labels, np.maximum(lu, lv), np.minimum(lu, lv))
        while True:
            up = labels[labels]
            if (up == labels).all():
                break
            labels[:] = up


def _walk(xa: np.ndarray, xb: np.ndarray, same: bool, max_bits: int, seen: dict | None = None) \
        -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links (left, right) of at most ``max_bits`` between two ranges in Gray order, or within one.

    ``seen`` counts node pairs judged and pruned."""
    depth = max(len(_groups(xa)), len(_groups(xb)))
    ta, tb = _groups(xa, depth), _groups(xb, depth)
    none = np.zeros(1, np.int64)
    todo = [(depth - 1, none, none, none, np.zeros(1, np.uint64))]
    while todo:
        level, a, b, spent, judged = todo.pop()
        if len(a) > 4096:  # bounded work arrays: split and come back
            half = len(a) // 2
            todo.append((level, a[half:], b[half:], spent[half:], judged[half:]))
            todo.append((level, a[:half], b[:half], spent[:half], judged[:half]))
            continue
        # differences on bits that both groups share and no upper pair has judged
        both = ta[level][0][a] & tb[level][0][b]
        spent = spent + np.bitwise_count((ta[level][1][a] ^ tb[level][1][b]) & both & ~judged)
        near = spent <= max_bits
        if seen is not None:
            seen["judged"] = seen.get("judged", 0) + len(a)
            seen["pruned"] = seen.get("pruned", 0) + int(len(a) - near.sum())
        if not near.any():
            continue
        a, b, spent, judged = a[near], b[near], spent[near], both[near]
        if level:
            p, left, right = _children(a, b, FAN, len(ta[level - 1][0]), len(tb[level - 1][0]), same)
            todo.append((level - 1, left, right, spent[p], judged[p]))
        else:
            p, left, right = _children(a, b, LEAF, len(xa), len(xb), same)
            rest = (xa[left] ^ xb[right]) & ~judged[p]
            hit = spent[p] + np.bitwise_count(rest) <= max_bits
            yield left[hit], right[hit]


def gray_links(x: np.ndarray, max_bits: int = MAX_BITS, seen: dict | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of ``x`` by Gray rank, and for each element in that order the
    first element of its component under links of at most ``max_bits``."""
    order = np.argsort(gray_rank(x), kind="stable")
    x = x[order]
    labels = np.arange(len(x))
    for left, right in _walk(x, x, True, max_bits, seen):
        _merge(labels, left, right)
    return order, labels


def cross_forest(xa: np.ndarray, xb: np.ndarray, same: bool, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest (u, v) of the links between two ranges, or within one;
    members of the second are numbered after those of the first."""
    labels = np.arange(len(xa) if same else len(xa) + len(xb))
    for left, right in _walk(xa, xb, same, max_bits):
        _merge(labels, left, right if same else right + len(xa))
    tied = np.flatnonzero(labels != np.arange(len(labels)))
    return tied, labels[tied]


# ------------------------------------------------------------ links on Spark

def gray_order(fp: Column) -> Column:
    """The Gray rank as a signed bigint of the same order."""
    r = fp
    for k in (1, 2, 4, 8, 16, 32):
        r = r.bitwiseXOR(F.shiftrightunsigned(r, k))
    return r.bitwiseXOR(F.lit(-(1 << 63)))


def range_rows(n: int) -> int:
    """Fingerprints of a range in a table of ``n``."""
    least, usual = RANGE_ROWS
    return max(min(max(-(-n // RANGES), least), usual), -(-n // MAX_RANGES))


def gray_index(nodes: DataFrame, rows: int | None = None) -> DataFrame:
    """(range, mask, value, fps, ids): the ranges of ``nodes`` (id, fp; distinct
    fp) in Gray order, with their members packed, written to the shared folder."""
    n = nodes.count()
    rows = rows or range_rows(n)
    by = gray_order(F.col("fp"))
    laid = nodes.select("id", "fp").repartitionByRange(max(1, -(-n // rows)), by).sortWithinPartitions(by)

    def packed(ids: np.ndarray, fps: np.ndarray, at: int) -> tuple:
        x = fps.view(np.uint64)
        mask, value = _grouped(np.full(len(x), ~np.uint64(0)), x, len(x))
        return at, int(mask.view(np.int64)[0]), int(value.view(np.int64)[0]), fps.tobytes(), ids.tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out() -> pa.RecordBatch:
            ids, fps = (np.concatenate(c) for c in zip(*held))
            types = [pa.int64()] * 3 + [pa.binary()] * 2
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(packed(ids, fps, at), types)],
                                              names=["range", "mask", "value", "fps", "ids"])

        for b in batches:
            if b.num_rows:
                held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
            if sum(len(h[0]) for h in held) >= 2 * rows:      # a partition larger than asked for: several ranges
                yield out()
                held, at = [], at + 1
        if held:
            yield out()

    return materialize(map_arrow(laid, run, "range bigint, mask bigint, value bigint, fps binary, ids binary"), "gray-index")


def range_pairs(index: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(a, b): pairs of ranges, a <= b, that may hold a link.  The upper nodes
    (``MAX_RANGES`` at most) are sent to the tasks, which share out the ranges."""
    found = sorted(tuple(r) for r in index.select("range", "mask", "value").toLocalIterator())
    ranges, mask, value = (np.array(c, np.int64) for c in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
    mask, value = mask.view(np.uint64), value.view(np.uint64)
    levels = [(mask, value), *_levels(mask, value, FAN)] if found else []
    sent = index.sparkSession.sparkContext.broadcast((ranges, levels))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranges, levels = sent.value
        for batch in batches:
            own, m, v = (batch.column(k).to_numpy() for k in range(3))
            m, v = m.view(np.uint64), v.view(np.uint64)
            for k in range(len(own)):         # a range against the tree: what stays is a small part of it
                node = np.zeros(1, np.int64)
                for level in range(len(levels) - 1, -1, -1):
                    lm, lv = levels[level]
                    # a node's mask holds those above it, so its differences include theirs
                    near = np.bitwise_count((lv[node] ^ v[k]) & lm[node] & m[k]) <= max_bits
                    node = node[near]
                    if level:
                        node = (node[:, None] * FAN + np.arange(FAN)).ravel()
                        node = node[node < len(levels[level - 1][0])]
                other = ranges[node]
                other = other[other >= own[k]]
                if len(other):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(other), own[k])), pa.array(other)], names=["a", "b"])

    parts = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return map_arrow(index.select("range", "mask", "value").repartition(parts, "range"), run, "a bigint, b bigint")


def link_forest(nodes: DataFrame, max_bits: int = MAX_BITS, rows: int | None = None) -> DataFrame:
    """(u, v): links between ids of ``nodes`` (id, fp; distinct fp) whose
    components are those of all links of at most ``max_bits`` bits."""
    index = gray_index(nodes, rows)
    pairs = materialize(range_pairs(index, max_bits), "range-pairs")
    members = index.select("range", "fps", "ids")
    met = pairs.join(members.withColumnsRenamed({"range": "a", "fps": "fa", "ids": "ia"}), "a") \
        .join(members.withColumnsRenamed({"range": "b", "fps": "fb", "ids": "ib"}), "b") \
        .select((F.col("a") == F.col("b")).alias("same"), "fa", "ia", "fb", "ib")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for same, fa, ia, fb, ib in zip(*(b.column(k) for k in range(5))):
                same = same.as_py()
                xa, xb = (np.frombuffer(c.as_buffer(), np.uint64) for c in (fa, fb))
                ids = np.concatenate([np.frombuffer(c.as_buffer(), np.int64) for c in ((ia,) if same else (ia, ib))])
                u, v = cross_forest(xa, xb, same, max_bits)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(ids[u]), pa.array(ids[v])], names=["u", "v"])

    # a row holds two ranges: few rows to an Arrow batch, for this job alone
    conf, key = nodes.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = conf.get(key)
    conf.set(key, "16")
    try:
        return materialize(met.mapInArrow(run, "u bigint, v bigint"), "simhash-links")
    finally:
        conf.set(key, usual)


def near_dup_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """(id_col, fp, component_id), a row per row of ``docs``; the component is
    named by its smallest id.  Fingerprints are written once to the shared
    folder, since routing and the final lookup both read them."""
    fps = materialize(fingerprints(docs, id_col, text, shingle), "simhash")
    nodes = fps.groupBy("fp").agg(F.min("id").alias("id"))
    joined = components(link_forest(nodes.where("id is not null"), max_bits))
    named = nodes.join(joined, nodes.id == joined.node, "left") \
        .select(nodes.fp, F.coalesce(joined.component, nodes.id).alias("component_id"))
    return fps.join(named, "fp").select(F.col("id").alias(id_col), "fp", "component_id")
