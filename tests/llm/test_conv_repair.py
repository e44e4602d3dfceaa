import hashlib
import itertools
import math
import random
import zlib
from functools import cache

import pytest

from rentscope.llm import catalog
from rentscope.llm import conv_repair as C

WHITE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}


def cheapest(rows):
    """Brute force over (place, state): least (cost, audit) and its rows; rows are (role, text, must_go, cut)."""
    @cache
    def best(i, q, inserted=0):
        found = [(0, "", ())] if i == len(rows) and q in (0, 3) else []
        asked = "a" if q == 2 else "u"
        if inserted < 2:
            c, a, out = best(i, NEXT[q, asked], inserted + 1)
            found.append((c + 2, "I" + a, (("user" if asked == "u" else "assistant", ""), *out)))
        if i < len(rows):
            role, text, must_go, cut = rows[i]
            c, a, out = best(i + 1, q)
            found.append((c + 3, "D" + a, out))
            if not must_go:
                if (q, role[:1]) in NEXT:
                    c, a, out = best(i + 1, NEXT[q, role[:1]])
                    found.append((c + cut, "K" + a, ((role, text), *out)))
                c, a, out = best(i + 1, NEXT[q, asked])
                found.append((c + 2 + cut, "R" + a, (("user" if asked == "u" else "assistant", text), *out)))
        return min(found, default=(math.inf, "", ()))
    for i in range(len(rows), -1, -1):
        for q in range(4):
            best(i, q)
    return best(0, 0)


def brute_force(table):
    out = {}
    for conv in {r[0] for r in table}:
        rows = []
        for _, turn, role, text in (r for r in table if r[0] == conv):
            name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(name.encode()) % 20
            if kind == 0:
                continue
            text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
            role = "user" if kind == 4 else role
            rows += [(turn, role, text)] * (2 if kind == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
        facts, seen, n = [], set(), dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for _, role, text in rows:
            shown = text.rstrip(WHITE)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else None
            seen.add((role, text))
            if fault:
                n[fault] += 1
            facts.append((role, text, fault in ("blank", "duplicate"), int(fault == "truncated")))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        cost, audit, kept = cheapest(facts) if rows else (0, "", ())
        text = "\n".join(f"{r}:{t}" for r, t in kept)
        out[conv] = (gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def rows_of(df):
    return {r[0]: tuple(r[1:]) for r in df.collect()}


def conversations(seed, n_convs, longest, null=0.05):
    rng = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", "ask", "unit"]
    texts = ["Hi.", "No", "", " \n", "Yes!", "é?\t", "a ", "Why?  ", "x" * 40 + "."]
    out = []
    for conv in range(n_convs):
        for turn in range(rng.randint(1, longest)):
            t = rng.choice(texts) if rng.random() < 0.6 else f"{rng.random()}" + rng.choice([".", ""])
            out.append((None if conv == 0 else conv, None if rng.random() < null else turn + rng.choice([0, 0, 0, 1, 5]),
                        None if rng.random() < null else rng.choice(roles) if rng.random() < 0.5 else ["user", "assistant"][turn % 2],
                        None if rng.random() < null else t))
    return out


@pytest.mark.parametrize("bits,longest", [(12, 12), (2, 40), (0, 15)])
def test_equals_brute_force(spark, bits, longest):
    # small blocks cut conversations into many segments
    table = conversations(bits, 60, longest)
    df = spark.createDataFrame(table, SCHEMA).repartition(5)
    got = rows_of(C.repair_conversations(df.selectExpr("*", "1 as conv", "2 as at", "'x' as _other"), block_bits=bits))
    want = brute_force(table)
    assert got == want


def test_defined_cases(spark):
    one = [(7, 0, "user", "Hi."), (7, 1, "assistant", "Hello."), (8, None, None, None), (9, 4, "user", "Same."),
           (9, 4, "user", "Same."), (9, 4, "user", "Same."), (10, -3, "system", "Only."), (11, 0, "assistant", "x")]
    got = rows_of(C.repair_conversations(spark.createDataFrame(one, SCHEMA)))
    assert got == brute_force(one)
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    row = C.repair_conversations(spark.createDataFrame([(dropped, 0, "user", "Hi.")], SCHEMA)).first()
    assert tuple(row)[1:] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert C.repair_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.repair(spark.createDataFrame([], "conv string, turn int, role string, text string")).count() == 0


def test_one_conversation_over_many_partitions(spark):
    rng = random.Random(3)
    table = [(1, t, rng.choice(["user", "assistant", "system"]), rng.choice(["A.", "B", f"{t}."])) for t in range(30_000)]
    df = C.damage(spark.createDataFrame(table, SCHEMA))
    ordered = C.ordered_rows(df)
    assert ordered.selectExpr("at >> 33 as p").groupBy("p").count().count() > 2
    row = C.repair(df).first()
    # a plain forward pass in this process gives the same cost
    facts, seen = [], set()
    for r in sorted(df.collect(), key=lambda r: (r.turn, r.role, hashlib.sha256(r.text.encode()).hexdigest())):
        must_go = not r.text or (r.role, r.text) in seen
        seen.add((r.role, r.text))
        facts.append((r.role[:1], must_go, int(r.text[-1:] not in ".!?")))
    cost = [0, math.inf, math.inf, math.inf]

    def insert(c):
        for _ in range(2):
            c = [c[0], c[1], min(c[2], c[0] + 2, c[1] + 2, c[3] + 2), min(c[3], c[2] + 2)]
        return c
    for first, must_go, cut in facts:
        cost = insert(cost)
        new = [c + 3 for c in cost]
        if not must_go:
            for q, c in enumerate(cost):
                asked = "a" if q == 2 else "u"
                new[NEXT[q, asked]] = min(new[NEXT[q, asked]], c + 2 + cut)
                if (q, first) in NEXT:
                    new[NEXT[q, first]] = min(new[NEXT[q, first]], c + cut)
        cost = new
    cost = insert(cost)
    assert row.cost == min(cost[0], cost[3])
    assert len(row.audit) - row.audit.count("I") == len(facts)
    spent = {"D": 3, "I": 2, "R": 2, "K": 0}
    edits = [e for e in row.audit if e != "I"]
    assert sum(spent[e] for e in row.audit) + sum(f[2] for e, f in zip(edits, facts) if e != "D" and not f[1]) == row.cost


def test_query_equals_brute_force(spark):
    table = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(catalog.queries()["op13_conversation_repair"](spark, "/root/testdata/sf0.01")) == brute_force(table)
