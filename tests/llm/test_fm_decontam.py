import hashlib
import pickle
import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from rentscope.llm import fm_decontam as D


def words(x):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), x or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items):
    windows = {}
    for item, t in items:
        w = words(t)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + k]), set()).add(item)
    out = []
    for doc, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(x) for x in windows}:
            for i in range(len(w) - k + 1):
                own = windows.get(tuple(w[i:i + k]))
                if own is not None:
                    found |= own
                    hit.update(range(i, i + k))
        found.discard(None)
        sha = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=6),
       st.lists(st.lists(st.integers(1, 4), min_size=2, max_size=2), min_size=1, max_size=4))
def test_index_finds_every_occurrence(runs, phrases):
    text = np.array([x for r in runs for x in [*r, 0]], np.int64)
    index = D.FMIndex(text, 4, sample=3)
    pats = np.array(phrases, np.int64)
    lo, hi = index.search(pats)
    for p, a, b in zip(phrases, lo, hi):
        want = [i for i in range(len(text) - 1) if text[i] == p[0] and text[i + 1] == p[1]]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_wavelet_rank():
    rng = np.random.default_rng(1)
    seq = rng.integers(0, 11, 200)
    tree = D.WaveletMatrix(seq, 10)
    sym, at = rng.integers(0, 11, 100), rng.integers(0, 201, 100)
    assert tree.rank(sym, at).tolist() == [int((seq[:a] == s).sum()) for s, a in zip(sym, at)]


def test_documents_equal_brute_force(spark, make_docs, prose):
    rng = random.Random(7)
    items = [(i, prose(100 + i, 40)) for i in range(6)] + [(6, "short one"), (7, ""), (8, None), (9, prose(100, 40)), (None, prose(103, 20)), (10, "!!!")]
    docs = [(0, None), (1, ""), (2, "..."), (3, prose(200, 300))]
    for k in range(12):
        t = prose(300 + k, 120).split()
        p = prose(100 + k % 6, 40).split()
        cut = rng.randint(0, 20)
        docs.append((10 + k, " ".join(t[:50] + [w.upper() for w in p[cut:cut + 8 + 2 * k]] + t[50:])))
    docs += [(30, " ".join([prose(101, 40)] * 30)), (31, "a short one, Short-One"), (10, docs[4][1]), (10, docs[4][1])]
    table = make_docs(docs)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(brute(docs, items))
    cols = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    # one block and shard; many blocks of items and small shards
    for kw in ({}, {"block_bytes": 400, "shard_symbols": 60}):
        assert sorted(tuple(r) for r in D.decontaminate(table, bench, **kw).select(cols).collect()) == want


def test_spans_and_empty_tables(spark, make_docs):
    item = " ".join(f"w{k}" for k in range(15))
    docs = make_docs([(1, f"x y {item} z {item}"), (2, "nothing here")])
    bench = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in D.decontaminate(docs, bench).collect()}
    assert got == {1: [(2, 17), (18, 33)], 2: []}
    assert D.decontaminate(docs.limit(0), bench).count() == 0
    assert D.decontaminate(docs, bench.limit(0)).where("n_hit > 0 or contaminated").count() == 0


def test_windows_are_whole_and_small(prose):
    """Windows and owners equal a dictionary of them; the arrays stay within 20 bytes a word and the ids."""
    items = [(i, prose(i % 9, 5 + 3 * i).encode()) for i in range(30)]
    items += [(30, items[29][1]), (None, prose(50, 20).encode()), (31, b"a b"), (32, b"a b"), (33, None), (34, b"")]
    p = D.Phrases(items)
    want = {}
    for item, t in items:
        w = D.words_of_bytes(t)
        k = min(13, len(w))
        for s in range(len(w) - k + 1 if w else 0):
            want.setdefault(tuple(w[s:s + k]), set()).update([] if item is None else [item])
    back = {v: k for k, v in p.vocab.items()}
    got = {}
    for g in p.groups:
        for w, s in enumerate(g.starts.tolist()):
            key = tuple(back[c] for c in p.codes[s:s + g.length].tolist())
            assert key not in got
            got[key] = p.items_of(g, np.array([w]))
    assert got == want
    size = p.codes.nbytes + sum(g.starts.nbytes + g.owner_at.nbytes + g.owners.nbytes - 4 for g in p.groups)
    assert size <= 20 * len(p.codes)
    assert pickle.loads(pickle.dumps(p)).vocab == p.vocab
