"""Benchmark decontamination: an FM-index per shard of training documents.

Words of the benchmark get numbers; a document is a sequence of those numbers.
A window can only occur inside a run of benchmark words that is at least as
long as the shortest window, so a shard's text is the concatenation of such
runs, each closed by a separator of its own.  Per shard (``SHARD_SYMBOLS``
symbols, whole documents):

* suffix array by prefix doubling, and from it the Burrows-Wheeler transform;
* a wavelet matrix over the transform answers ``rank(symbol, row)``;
* all windows are searched backwards at once, one symbol a step;
* occurrences are located by walking the last-to-first mapping to a sampled
  suffix position (every ``SAMPLE``-th position and each run start);
* spans of occurrences are merged per document.

The job is one map over the documents: texts are never shuffled, and hot
sources or copies stay where they are read.  The benchmark is sent to the
tasks in blocks of at most ``BLOCK_BYTES`` text bytes (measured first), as
word numbers and window positions, some 20 bytes a word; more blocks mean more
passes, whose spans are merged per document.

Defined cases: null or wordless texts have ``n_words`` 0 and are clean; items
without a word match nothing; items with equal windows all count; items
without an id cause hits but are not listed; repeated documents keep a row
each; extra columns are ignored; empty tables give no hits or no rows.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator
from itertools import repeat
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import map_arrow

WINDOW = 13
SHARD_SYMBOLS = 1 << 20
SAMPLE = 8
BLOCK_BYTES = 32 << 20
SEARCH_ROWS = 1 << 16
# A-Z to a-z; every ASCII character outside 0-9 and a-z is a word boundary.
_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def words_of_bytes(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


class WaveletMatrix:
    """rank(symbol, position) over an integer sequence, vectorised."""

    def __init__(self, seq: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for k in range(self.bits - 1, -1, -1):
            bit = (seq >> k) & 1
            count = np.zeros(len(seq) + 1, np.int32)
            np.cumsum(bit, out=count[1:])
            self.ones.append(count)
            self.zeros.append(len(seq) - int(count[-1]))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of ``symbol`` before position ``at``, pairwise."""
        lo, hi = np.zeros_like(at), at
        for level, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            one = ((symbol >> (self.bits - 1 - level)) & 1).astype(bool)
            l1, h1 = ones[lo], ones[hi]
            lo = np.where(one, zeros + l1, lo - l1)
            hi = np.where(one, zeros + h1, hi - h1)
        return hi - lo


class FMIndex:
    """Backward search and location over runs of symbols >= 1, each followed by a 0."""

    def __init__(self, text: np.ndarray, n_symbols: int, sample: int = SAMPLE):
        n = len(text)
        sa = self._suffixes(text)
        before = text[sa - 1]  # the transform; row of suffix 0 wraps to the closing 0
        self.before = before
        self.tree = WaveletMatrix(before, n_symbols)
        counts = np.bincount(text, minlength=n_symbols + 2)
        self.first = np.concatenate([[0], np.cumsum(counts)])[:-1].astype(np.int64)
        self.n = n
        kept = (sa % sample == 0) | (before == 0)
        self.kept = kept
        self.kept_rank = np.concatenate([[0], np.cumsum(kept)])
        self.samples = sa[kept]

    @staticmethod
    def _suffixes(text: np.ndarray) -> np.ndarray:
        """Suffix array; zeros are distinct and smaller than all else, by position."""
        n = len(text)
        ends = text == 0
        n_ends = int(ends.sum())
        rank = np.where(ends, np.cumsum(ends) - 1, text.astype(np.int64) + n_ends)
        k = 1
        while True:
            after = np.zeros(n, np.int64)
            after[:n - k] = rank[k:] + 1
            key = rank * (int(rank.max()) + 2) + after
            order = np.argsort(key, kind="stable")
            sorted_key = key[order]
            new = np.empty(n, np.int64)
            new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
            rank = new
            if int(rank.max()) == n - 1 or k >= n:
                return order
            k *= 2

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [lo, hi) of the suffixes that start with each phrase (one per row)."""
        p = len(phrases)
        lo, hi = np.zeros(p, np.int64), np.full(p, self.n, np.int64)
        live = np.arange(p)
        for k in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, k].astype(np.int64)
            low = self.first[c] + self.tree.rank(c, lo[live])
            high = self.first[c] + self.tree.rank(c, hi[live])
            lo[live], hi[live] = low, high
            live = live[high > low]
            if not len(live):
                break
        found = np.zeros(p, bool)
        found[live] = True
        hi[~found] = lo[~found]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, by steps back to a sampled suffix."""
        out = np.empty(len(rows), np.int64)
        at, steps, who = rows.copy(), np.zeros(len(rows), np.int64), np.arange(len(rows))
        while len(who):
            done = self.kept[at]
            out[who[done]] = self.samples[self.kept_rank[at[done]]] + steps[done]
            at, steps, who = at[~done], steps[~done] + 1, who[~done]
            if len(who):
                c = self.before[at].astype(np.int64)
                at = self.first[c] + self.tree.rank(c, at)
        return out


class Windows(NamedTuple):
    """The distinct windows of one length: where each begins in ``Phrases.codes``, and the items that hold it."""

    length: int
    starts: np.ndarray
    owner_at: np.ndarray  # of window w: owners[owner_at[w]:owner_at[w + 1]]
    owners: np.ndarray    # places in ``Phrases.ids``


class Phrases:
    """The windows of a block of items, as positions in one sequence of word numbers.

    Built once on the driver and sent as arrays; a worker keeps what it was
    sent, and makes the word lookup once for all its tasks."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int = WINDOW):
        vocab: dict[bytes, int] = {}
        codes, lens = array("i"), []
        for _, text in items:
            words = words_of_bytes(text)
            lens.append(len(words))
            codes.extend([vocab.setdefault(w, len(vocab) + 1) for w in words])
        self.words = b" ".join(vocab)
        self.n_words = len(vocab)
        self.codes = np.array(codes, np.int32)
        self.ids = np.array([-1 if item is None else item for item, _ in items], np.int64)
        named = np.array([item is not None for item, _ in items], bool)
        lens = np.array(lens, np.int64)
        self.groups = self._groups(lens, np.minimum(lens, window), named)
        self.shortest = min((g.length for g in self.groups), default=0)
        self._vocab: dict[bytes, int] | None = None

    def _groups(self, lens: np.ndarray, sizes: np.ndarray, named: np.ndarray) -> list[Windows]:
        """Equal windows are found by ranks of twice the length from step to step:
        a window of p to 2p - 1 words is its first and its last p words."""
        begins = np.cumsum(lens) - lens
        rank, p = self.codes.astype(np.int64), 1
        out = []
        for size in np.unique(sizes[sizes > 0]).tolist():
            while 2 * p <= size:
                after = np.zeros_like(rank)
                after[:-p] = rank[p:] + 1
                rank = np.unique(rank * (int(rank.max()) + 2) + after, return_inverse=True)[1]
                p *= 2
            own = np.flatnonzero(sizes == size)
            n = lens[own] - size + 1
            starts = np.repeat(begins[own] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            item = np.repeat(own, n)
            _, first, window = np.unique(rank[starts] * (int(rank.max()) + 1) + rank[starts + size - p],
                                         return_index=True, return_inverse=True)
            pairs = np.unique((window * len(lens) + item)[named[item]])
            owner_at = np.searchsorted(pairs, np.arange(len(first) + 1) * len(lens))
            out.append(Windows(size, starts[first].astype(np.int32), owner_at.astype(np.int32),
                               (pairs % len(lens)).astype(np.int32)))
        return out

    def __getstate__(self) -> dict:
        return {**self.__dict__, "_vocab": None}

    @property
    def vocab(self) -> dict[bytes, int]:
        if self._vocab is None:
            self._vocab = {w: k for k, w in enumerate(self.words.split(), 1)}
        return self._vocab

    def possible(self, g: Windows, text: np.ndarray) -> np.ndarray:
        """The windows all of whose words occur in ``text``."""
        present = np.zeros(self.n_words + 1, bool)
        present[text] = True
        absent = np.zeros(len(self.codes) + 1, np.int32)
        np.cumsum(~present[self.codes], out=absent[1:])
        return np.flatnonzero(absent[g.starts + g.length] == absent[g.starts])

    def items_of(self, g: Windows, windows: np.ndarray) -> set[int]:
        return {i for w in windows.tolist() for i in self.ids[g.owners[g.owner_at[w]:g.owner_at[w + 1]]].tolist()}


def _merged(starts: np.ndarray, ends: np.ndarray) -> tuple[list[int], list[int]]:
    order = np.argsort(starts, kind="stable")
    s, e = starts[order], np.maximum.accumulate(ends[order])
    new = np.concatenate([[True], s[1:] > e[:-1]])
    at = np.flatnonzero(new)
    return s[at].tolist(), e[np.concatenate([at[1:] - 1, [len(s) - 1]])].tolist()


class _Shard:
    """Documents' runs of benchmark words until the shard is full."""

    def __init__(self, phrases: Phrases):
        self.p = phrases
        self.rows: list[tuple] = []   # carried values and word count
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.symbols = 0

    def add(self, carried: list[tuple], texts: list[bytes | None]) -> None:
        base = len(self.rows)
        words: list[bytes] = []
        lens = []
        for t in texts:
            w = words_of_bytes(t)
            lens.append(len(w))
            words += w
        self.rows += [(*c, n) for c, n in zip(carried, lens)]
        if not self.p.shortest or not words:
            return
        codes = np.fromiter(map(self.p.vocab.get, words, repeat(0)), np.int32, len(words))
        lens = np.array(lens)
        doc_start = np.cumsum(lens) - lens
        known = codes != 0
        opens = known.copy()
        opens[1:] &= ~known[:-1]
        starts_doc = np.zeros(len(codes), bool)
        starts_doc[doc_start[lens > 0]] = True
        opens |= known & starts_doc
        closes = known.copy()
        closes[:-1] &= ~known[1:] | starts_doc[1:]
        begin, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        long = end - begin >= self.p.shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            return
        size = end - begin
        # run symbols with a 0 after each run
        at = np.repeat(begin - (np.cumsum(size + 1) - size - 1), size + 1) + np.arange(int((size + 1).sum()))
        text = codes[np.minimum(at, len(codes) - 1)]
        text[np.cumsum(size + 1) - 1] = 0
        full = np.flatnonzero(lens > 0)
        doc = full[np.searchsorted(doc_start[full], begin, side="right") - 1]
        self.runs.append((text, doc + base, begin - doc_start[doc], size))
        self.symbols += len(text)

    def close(self) -> tuple[list[tuple], dict[int, tuple[list[int], list[int], list[int]]]]:
        """The rows, and by row number (span starts, span ends, item ids)."""
        hits: dict[int, list] = {}
        if self.symbols:
            text = np.concatenate([r[0] for r in self.runs]).astype(np.int64)
            doc = np.concatenate([r[1] for r in self.runs])
            word = np.concatenate([r[2] for r in self.runs])
            size = np.concatenate([r[3] for r in self.runs])
            run_at = np.cumsum(size + 1) - size - 1
            index = FMIndex(text, self.p.n_words)
            for g in self.p.groups:
                which, pos = self._occurrences(index, g, self.p.possible(g, text))
                if not len(pos):
                    continue
                run = np.searchsorted(run_at, pos, side="right") - 1
                first = word[run] + pos - run_at[run]
                d = doc[run]
                order = np.argsort(d, kind="stable")
                cuts = np.flatnonzero(np.concatenate([[True], d[order][1:] != d[order][:-1]]))
                for part in np.split(order, cuts[1:]):
                    h = hits.setdefault(int(d[part[0]]), [[], [], set()])
                    h[0].append(first[part])
                    h[1].append(first[part] + g.length)
                    h[2] |= self.p.items_of(g, np.unique(which[part]))
        return self.rows, {r: (*_merged(np.concatenate(h[0]), np.concatenate(h[1])), sorted(h[2]))
                           for r, h in hits.items()}


    def _occurrences(self, index: FMIndex, g: Windows, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, text position) of every occurrence; windows are looked up ``SEARCH_ROWS`` at a time.

        Windows of one length never share a position, so the occurrences are at most the shard's symbols."""
        which, pos = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k in range(0, len(windows), SEARCH_ROWS):
            some = windows[k:k + SEARCH_ROWS]
            lo, hi = index.search(self.p.codes[g.starts[some][:, None] + np.arange(g.length)])
            n = hi - lo
            rows = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            which.append(np.repeat(some, n))
            pos.append(index.locate(rows))
        return np.concatenate(which), np.concatenate(pos)


def _spans_of_block(docs: DataFrame, items: list[tuple[int | None, bytes | None]], window: int,
                    shard_symbols: int) -> tuple[DataFrame, Broadcast]:
    """docs (id, h, t) -> (id, h, n_words, starts, ends, items), and what was sent for it."""
    sent = docs.sparkSession.sparkContext.broadcast(Phrases(items, window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = sent.value

        def out(shard: _Shard) -> pa.RecordBatch:
            rows, hits = shard.close()
            found = [hits.get(k, ((), (), ())) for k in range(len(rows))]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int64()), pa.array([f[0] for f in found], pa.list_(pa.int64())),
                 pa.array([f[1] for f in found], pa.list_(pa.int64())),
                 pa.array([f[2] for f in found], pa.list_(pa.int64()))],
                names=["id", "h", "n_words", "starts", "ends", "items"])

        shard = _Shard(phrases)
        for b in batches:
            ids, hs, texts = (b.column(k).to_pylist() for k in range(3))
            shard.add(list(zip(ids, hs)), texts)
            if shard.symbols >= shard_symbols or len(shard.rows) >= 1 << 16:
                yield out(shard)
                shard = _Shard(phrases)
        if shard.rows:
            yield out(shard)

    return map_arrow(docs, run, "id bigint, h bigint, n_words bigint, starts array<bigint>, ends array<bigint>, "
                                "items array<bigint>"), sent


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES, shard_symbols: int = SHARD_SYMBOLS) -> DataFrame:
    """(id_col, text_hash, n_words, spans, n_hit, items, n_items, items_sha256, contaminated), a row per document.

    ``text_hash`` is Spark's ``xxhash64`` of the text, to tell apart rows of
    one id.  ``spans`` are the merged word ranges [start, end) that benchmark windows
    cover, ``items`` the ids found.  A document is contaminated if at least
    one word in twenty is covered."""
    bench = benchmark.select(F.col(f"`{item_col}`").cast("bigint").alias("item"),
                             F.col(f"`{item_text}`").cast("binary").alias("t"))
    size = bench.agg(F.sum(F.length("t") + 64)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    src = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("h"),
        F.col(f"`{text}`").cast("binary").alias("t"))
    parts = []
    for k in range(blocks):
        mine = bench if blocks == 1 else bench.where(F.pmod(F.xxhash64("item", "t"), F.lit(blocks)) == k)
        items = [(r["item"], None if r["t"] is None else bytes(r["t"])) for r in mine.collect()]
        spans, sent = _spans_of_block(src, items, window, shard_symbols)
        if blocks > 1:  # one block at a time in the memory of driver and tasks
            spans = materialize(spans, "block-spans")
            sent.unpersist()
        parts.append(spans)
    found = parts[0]
    if blocks > 1:  # one row per document again; equal rows are counted and laid out anew
        for p in parts[1:]:
            found = found.union(p)
        found = _merge_blocks(found, blocks)
    spans = F.transform(F.arrays_zip("starts", "ends"),
                        lambda x: F.struct(x["starts"].alias("start"), x["ends"].alias("end")))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    listed = F.array_join(F.sort_array(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(F.col("id").alias(id_col), F.col("h").alias("text_hash"), "n_words", spans.alias("spans"), "items") \
        .withColumn("n_hit", n_hit) \
        .withColumn("n_items", F.size("items").cast("bigint")) \
        .withColumn("items_sha256", F.sha2(listed, 256)) \
        .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def _merge_blocks(found: DataFrame, blocks: int) -> DataFrame:
    """The passes' rows of a document as one, its spans swept into disjoint ones.

    Rows of equal id and text have equal spans; they are grouped and laid out
    again as often as they came."""
    pair = F.transform(F.arrays_zip("starts", "ends"),
                       lambda x: F.struct(x["starts"].alias("start"), x["ends"].alias("end")))
    one = found.withColumn("pairs", pair).groupBy("id", "h", "n_words").agg(
        F.sort_array(F.array_distinct(F.flatten(F.collect_list("pairs")))).alias("pairs"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
        (F.count("*") / blocks).cast("int").alias("copies"))
    start = F.struct(F.array().cast("array<struct<start:bigint,end:bigint>>").alias("out"),
                     F.lit(0).cast("bigint").alias("reach"))
    swept = F.aggregate(
        "pairs", start,
        lambda a, x: F.struct(
            F.when(x["end"] > a["reach"],
                   F.concat(a["out"], F.array(F.struct(F.greatest(x["start"], a["reach"]).alias("start"),
                                                       x["end"].alias("end"))))).otherwise(a["out"]).alias("out"),
            F.greatest(a["reach"], x["end"]).alias("reach")),
        lambda a: a["out"])
    return one.withColumn("spans", swept).select(
        "id", "h", "n_words", F.transform("spans", lambda x: x["start"]).alias("starts"),
        F.transform("spans", lambda x: x["end"]).alias("ends"), "items",
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).drop("copy")
