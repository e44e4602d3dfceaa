import math
import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st

from rentscope.llm import pack_spf as K

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return K.ByteEncoder.of(PATH).tok.encode(text, add_special_tokens=False).ids


def test_encoding_of_every_character():
    enc = K.ByteEncoder.of(PATH)
    for begin in range(0, 0x110000, 64):
        chars = [chr(c) for c in range(begin, begin + 64) if not 0xD800 <= c <= 0xDFFF]
        text = "".join(f"a{c}b {c}{c} 1{c}2 {c}" for c in chars)
        assert enc.encode(text) == ids_of(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aAé \n\t\r  's've<|>endofxt09İ́")), max_size=60))
def test_encoding_equals_the_tokenizer(text):
    assert K.ByteEncoder.of(PATH).encode(text) == ids_of(text)


def test_special_tokens_and_long_runs():
    for text in ("a <|endoftext|>b", "<|endoftext|><|endoftext|>", "<|endof", "a" * 5000 + " " * 5000, "é" * 3000):
        assert K.ByteEncoder.of(PATH).encode(text) == ids_of(text)


def pieces_of(counts, capacity):
    """Every piece (length, rank, start, part, sequence, offset) of a plan."""
    plan = K.plan_packs(dict(counts), capacity)
    out = [(n, rank + k, start, part, seq + k, off) for rows in plan.levels for n, rank, count, start, part, seq, off in rows
           for k in range(count)]
    return out, plan.sequences


def check_plan(counts, capacity):
    pieces, sequences = pieces_of(counts, capacity)
    cover, fill = {}, {}
    for n, rank, start, part, seq, off in pieces:
        cover.setdefault((n, rank), []).append((start, part))
        fill.setdefault(seq, []).append((off, part))
    assert set(cover) == {(n, k) for n, c in counts.items() for k in range(c)}
    for spans, whole in [(v, k[0]) for k, v in cover.items()] + [(v, None) for v in fill.values()]:
        at = 0
        for begin, part in sorted(spans):
            assert begin == at and part > 0
            at += part
        assert at == whole if whole else at == capacity or at & (at - 1) == 0
    assert len(fill) == sequences
    return pieces, sequences


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=20))
def test_plan_has_no_padding(counts):
    _, sequences = check_plan(counts, 64)
    total = sum(n * c for n, c in counts.items())
    assert sequences == total // 64 + bin(total % 64).count("1")


def test_plan_places_longest_first_into_the_shortest_pack():
    # 5 opens a pack; the first 3 takes its room, the others share the next pack; 2 goes there
    pieces, _ = check_plan({5: 1, 3: 3, 2: 1}, 8)
    assert sorted(pieces) == [(2, 0, 0, 2, 1, 6), (3, 0, 0, 3, 0, 5), (3, 1, 0, 3, 1, 0), (3, 2, 0, 3, 1, 3), (5, 0, 0, 5, 0, 0)]
    # no pack has room for the last 5: its first ids fill the shortest one
    pieces, _ = check_plan({6: 1, 5: 2}, 8)
    assert sorted(pieces) == [(5, 0, 0, 5, 1, 0), (5, 1, 0, 3, 1, 5), (5, 1, 3, 2, 0, 6), (6, 0, 0, 6, 0, 0)]


def test_plan_size_and_cuts():
    rng = random.Random(4)
    counts = {}
    for _ in range(20_000):
        n = min(2048, int(rng.lognormvariate(6.0, 0.9)) + 1)
        counts[n] = counts.get(n, 0) + 1
    pieces, _ = check_plan(counts, 2048)
    assert len(pieces) <= 1.05 * 20_000        # few are cut
    many = K.plan_packs({n: c * 10 ** 9 for n, c in counts.items()})
    assert sum(map(len, many.levels)) < 100_000
    assert K.plan_packs({}).sequences == 0


def test_packed_documents(spark, make_docs, prose):
    texts = [None, "", "a", prose(1, 30), prose(1, 30), prose(2, 900), " ".join(["word"] * 150), "<|endoftext|> é"] + [prose(k, 3 * k) for k in range(10, 40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    docs = make_docs(rows).withColumnsRenamed({"lang": "length", "source": "task", "n_chars": "rank"})
    capacity = 128
    got = K.pack(docs.repartition(3), PATH, capacity=capacity, with_ids=True).collect()
    whole = {}
    for i, t in rows:
        whole.setdefault(i, []).append([*ids_of(t or ""), 1])
    cover, seqs = {}, {}
    for r in got:
        ids = whole[r.doc_id][0]
        assert list(r.ids) == ids[r.start:r.start + r.length] and r.doc_tokens == len(ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        cover[r.doc_id] = cover.get(r.doc_id, 0) + r.length
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert cover == {i: sum(map(len, v)) for i, v in whole.items()}
    total = sum(cover.values())
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at == capacity or at & (at - 1) == 0
    assert len(seqs) == total // capacity + bin(total % capacity).count("1")
    assert K.pack(docs.limit(0), PATH).count() == 0


def test_pieces_of_a_document_cover_it_once(spark, make_docs, prose):
    docs = make_docs([(k, prose(k, 500 + k)) for k in range(40)])
    spans = {}
    for r in K.pack(docs, PATH, capacity=256).collect():
        spans.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
    for parts in spans.values():
        at = 0
        for start, n, total in sorted(parts):
            assert start == at
            at += n
        assert at == total


def test_shuffled_ranks_give_the_same_sequences(spark, make_docs, prose, monkeypatch):
    docs = make_docs([(k, prose(k, 40 + 7 * k)) for k in range(30)]).repartition(4, "doc_id")
    first = sorted(map(tuple, K.pack(docs, PATH, capacity=256).collect()))
    monkeypatch.setattr(K, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, K.pack(docs, PATH, capacity=256).collect())) == first
    assert math.ceil(sum(r[2] for r in first) / 256) <= len({r[5] for r in first})
