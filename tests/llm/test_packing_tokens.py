import math
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from rentscope.llm import packing as K
from rentscope.llm import token_counts as C
from rentscope.llm.encode import WordEncoder

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    from tokenizers import Tokenizer
    if not hasattr(ids_of, "tok"):
        ids_of.tok = Tokenizer.from_file(PATH)
    return ids_of.tok.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAé É\n\t'sß*<|>endofxt0 İΣ́")), max_size=40))
def test_word_encoding_equals_the_tokenizer(text):
    assert np.frombuffer(WordEncoder.of(PATH).encode(text), "<u4").tolist() == ids_of(text)


def test_special_tokens_and_cache_generations(prose, monkeypatch):
    import rentscope.llm.encode as E
    texts = ["a <|endoftext|>b", "x<|startoftext|><|startoftext|>y", "<|endof", prose(1, 300), prose(2, 300), prose(1, 300)]
    monkeypatch.setattr(E, "CACHE_WORDS", 20)
    enc = WordEncoder(PATH)
    for t in texts * 2:
        assert np.frombuffer(enc.encode(t), "<u4").tolist() == ids_of(t)


def best_fit_decreasing(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def check_plan(counts, capacity, **kw):
    plan = K.plan_sequences(dict(counts), capacity, **kw)
    used, fill = {}, {}
    for length, rank, n, seq, off in plan.rows:
        for k in range(n):
            assert used.setdefault((length, rank + k), (seq + k, off)) == (seq + k, off)
            fill.setdefault(seq + k, []).append((off, length))
    assert len(used) == sum(counts.values()) and all(0 <= r < counts[n] for n, r in used)
    for parts in fill.values():
        at = 0
        for off, length in sorted(parts):
            assert off == at
            at += length
        assert at <= capacity
    assert len(fill) == plan.sequences
    return plan.sequences


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20), st.integers(1, 12))
def test_plan_places_every_piece_once(counts, groups):
    n = check_plan(counts, 64, groups=groups)
    assert n >= math.ceil(sum(k * v for k, v in counts.items()) / 64)


def test_plan_is_close_to_the_bound():
    rng = random.Random(4)
    counts = {}
    for _ in range(20000):
        n = min(4096, int(rng.lognormvariate(6.3, 0.9)) + 1)
        counts[n] = counts.get(n, 0) + 1
    bound = math.ceil(sum(k * v for k, v in counts.items()) / 4096)
    assert check_plan(counts, 4096) <= 1.002 * bound + 1
    assert check_plan({}, 4096) == 0
    assert check_plan({4096: 3, 1: 5000}, 4096) == 3 + 2


def test_linear_groups_have_equal_cardinality():
    groups = K.linear_groups({10: 7, 9: 5, 8: 3, 7: 9}, 4)
    assert [sum(s[2] for s in g[1]) for g in groups] in ([6, 6, 6, 6], [12, 6, 6], [6, 12, 6])
    assert all(s[0] <= size for size, segs in groups for s in segs)


def test_packed_documents(spark, make_docs, prose):
    texts = [None, "", "a", prose(1, 30), prose(1, 30), prose(2, 900), " ".join(["word"] * 150), "<|endoftext|> é"] + [prose(k, 3 * k) for k in range(10, 40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    docs = make_docs(rows)
    capacity = 128
    got = K.pack(docs.repartition(3), PATH, capacity=capacity, with_ids=True).collect()
    want = []
    for i, t in rows:
        ids = ids_of(t or "") + [1]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), part))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, list(r.ids)) for r in got) == sorted(want)
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= capacity
    assert len(seqs) <= best_fit_decreasing([w[3] for w in want], capacity) + 1
    assert K.pack(docs.limit(0), PATH).count() == 0


def test_length_histogram_and_suffix_sums(spark, make_docs, prose):
    rows = [(0, None), (1, ""), (2, "a"), (2, "a"), (3, prose(1, 700))] + [(k, prose(k, k * 13)) for k in range(5, 30)]
    lens = sorted(len(ids_of(t or "")) for _, t in rows)
    hist = C.length_histogram(make_docs(rows).withColumn("n_tokens", C.F.lit("x")), PATH)
    sums = C.suffix_sums(hist).cache()
    got = {r.n_tokens: r for r in sums.collect()}
    assert sorted(got) == sorted(set(lens))
    for n, r in got.items():
        above = [x for x in lens if x >= n]
        assert (r.n_docs, r.docs_at_least, r.tokens_at_least) == (lens.count(n), len(above), sum(above))
        assert (r.total_docs, r.total_tokens, r.tokens_truncated) == (len(lens), sum(lens), sum(min(x, n) for x in lens))
        assert abs(r.share_at_most - sum(x <= n for x in lens) / len(lens)) < 1e-12
    limits = [0, 1, 10, 100, 10**6]
    assert {r.context_limit: r.tokens_truncated for r in C.truncated_totals(sums, limits).collect()} == {k: sum(min(x, k) for x in lens) for k in limits}
    assert [r.n_tokens for r in C.quantiles(sums, [0.5, 1.0]).collect()] == [lens[math.ceil(len(lens) / 2) - 1], lens[-1]]
    empty = C.suffix_sums(C.length_histogram(make_docs([]), PATH))
    assert empty.count() == 0 and C.truncated_totals(empty, [5]).first().tokens_truncated == 0
