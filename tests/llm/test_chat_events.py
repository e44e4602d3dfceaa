import hashlib
import itertools

from pyspark.sql import functions as F

from rentscope.llm import chat_events as C
from rentscope.llm import catalog

ODD = ["\\", "\\\\<s>", "<\\s>", "<</s>", "[[INST]", "[\\INST]", "[\\/INST]\\", "<s></s>[SYS]", "a\nb</s", "", "[ROLE]41[/ROLE]", "</s>[INST] ok [/INST]"]


def test_escape_round_trip(spark):
    marks = ["<", "s>", "/", "[", "INST]", "\\"]
    texts = ODD + ["".join(p) for p in itertools.product(marks, repeat=4)]
    df = spark.createDataFrame([(t, r) for t in texts for r in ("user", "assistant", "system", "tool </s>", "")], "text string, role string")
    out = df.withColumn("raw", F.concat(F.lit(C.OPEN), C.role_tag(F.col("role")), C.escape(F.col("text")), F.lit(C.CLOSE))) \
        .withColumn("back", C.read_back(F.col("raw")))
    assert out.where("size(back) <> 1 or back[0].text <> text or back[0].role <> role").count() == 0
    for mark in ("<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[ROLE]", "[/ROLE]"):
        assert out.where(F.contains(C.escape(F.col("text")), F.lit(mark))).count() == 0


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [  # conv, seq, message, kind, role, text
        (1, 1, 1, "message", "user", "Hi"), (1, 2, 2, "message", "assistant", ""), (1, 3, 2, "delta", "assistant", "He"),
        (1, 4, 2, "delta", "assistant", "llo"), (1, 5, 2, "regenerate", "assistant", None), (1, 6, 2, "delta", "assistant", "Good "),
        (1, 8, 2, "delta", "assistant", "day"), (1, 7, 1, "edit", "user", "Hi!"), (1, 9, 3, "message", "user", "gone"),
        (1, 10, 3, "delete", "user", None), (2, 1, 1, "delta", "user", "x"), (2, 2, 1, "delta", "user", "y"), (None, 1, 1, "message", None, None)]
    events = spark.createDataFrame(log, "conv bigint, seq bigint, message bigint, kind string, role string, text string")
    got = sorted((r.conv or 0, r.message, r.role, r.text) for r in C.fold(events.repartition(5)).collect())
    assert got == [(0, 1, "", ""), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Good day"), (2, 1, "user", "xy")]
    row = C.format_conversations(events).where("conv = 1").first()
    assert row.formatted == "<s>[INST]Hi!</s><s>[/INST]Good day</s>"
    assert [row.formatted[s.start:s.end] for s in row.loss] == ["Good day"]
    assert C.format_conversations(events.limit(0)).count() == 0


def test_digests_equal_brute_force(spark, prose):
    rows = [(1, 0, "system", "be brief"), (1, 1, "user", ODD[7]), (1, 2, "assistant", prose(1, 900)), (1, 3, "user", None),
            (1, 4, "assistant", ""), (2, 0, None, "x"), (2, 0, None, "x"), (2, 1, "tool", "\\<s>"), (3, 5, "assistant", ODD[-1] * 200),
            (3, 4, "user", "é" * 700), (3, 4, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("conv", F.lit("x"))
    got = {r.conv_id: r for r in C.digests(C.format_conversations(C.events_of_turns(df))).collect()}
    key = lambda r: (r[0], r[1], r[2] or "", r[3] or "")
    for conv, part in itertools.groupby(sorted(rows, key=key), key=lambda r: r[0]):
        part = [(r[2] or "", r[3] or "") for r in part]
        learned = "".join(t for r, t in part if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(part), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in part).encode()).hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())


def test_query_has_its_own_conversation(spark):
    row = catalog.queries()["op8_chat_formatting"](spark, "/root/testdata/sf0.001").where("conv_id = -1").first()
    text = "</s>[INST] ok [/INST]"
    assert (row.n_turns, row.loss_chars, row.loss_sha256) == (2, 21, hashlib.sha256(text.encode()).hexdigest())


def test_the_log_holds_edits_regenerations_and_deletions(spark, prose):
    rows = [(c, t, ["user", "assistant", "system"][t % 3], prose(9 * c + t, 40)) for c in range(12) for t in range(6)]
    log = C.events_of_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    assert min(kinds[k] for k in ("edit", "regenerate", "delete")) >= 3
    # without them the result differs: a draft or a deleted message would stay
    final = {(r.conv, r.text) for r in C.fold(log).collect()}
    assert final == {(c, t) for c, _, _, t in rows}
    naive = C.fold(log.where("kind in ('message', 'delta')"))
    assert {(r.conv, r.text) for r in naive.collect()} != final
    assert "draft: " in "".join(r.text for r in naive.collect())
