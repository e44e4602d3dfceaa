import re
import textwrap

from pyspark.sql import functions as F

from rentscope.llm.line_rules import apply_rules


def base(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in win:
        seen[w] = seen.get(w, 0) + 1
    hit = {p for i, w in enumerate(win) if seen[w] > 1 for p in (i, i + 1, i + 2)}
    full = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(hit),
            n < 50 or 100 * len(hit) > 50 * n)


def test_base_figures_equal_brute_force(spark, make_docs, prose):
    long = prose(1, 4000)
    texts = [None, "", " ", "\n\n", "a b c", "a b c a b c", "x " * 200, "a\tb\x0bc\x0cd\re f", "one\none\n \n \none",
             "é ü|ß # $ &", prose(2, 120), prose(2, 120) + "\n" + prose(2, 120), long + "\n" + long, long, long,
             " a b", "a  b\n\nc d  a  b\nc"]
    docs = make_docs(list(enumerate(texts)))
    got = {r["doc_id"]: r for r in apply_rules(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), t


def test_verdicts(spark, make_docs, prose):
    good = prose(3, 200)
    words = prose(4, 200).replace(".", "").replace("\n", " ").split()
    texts = {1: good, 2: " | ".join(words), 3: " ".join(w + "***" for w in words), 4: " ".join(w.upper() + "!!" for w in words),
             5: " ".join(words), 6: good + "\nRead more", 7: None, 8: good}
    got = {r["doc_id"]: r for r in apply_rules(make_docs(list(texts.items()))).collect()}
    assert [i for i in sorted(got) if got[i].kept] == [1, 6, 8]
    assert got[6].clean_text == good and got[6].n_lines_removed == 1
    assert got[1].clean_text == good and got[1].lost_share == 0
    assert got[7].clean_text == "" and got[7].n_words == 0


def test_empty_repeated_and_clashing_columns(spark, make_docs, prose):
    docs = make_docs([(1, prose(5, 80)), (1, prose(5, 80))]).withColumn("kept", F.lit("old")).withColumn("n_words", F.lit(None).cast("string"))
    rows = apply_rules(docs).collect()
    assert len(rows) == 2 and rows[0] == rows[1] and rows[0].kept is True and rows[0].n_words == 80
    assert apply_rules(docs.limit(0)).count() == 0


def test_hard_wrapped_prose_and_other_scripts(spark, make_docs, prose):
    paragraphs = []
    for k in range(6):  # sentences far longer than a line
        paragraphs.append(" ".join(prose(20 + k, 90).replace(".", ",").lower().split()).rstrip(",") + ".")
    texts = {}
    for width in (90, 100, 120):
        texts[width] = "\n\n".join(textwrap.fill(p, width) for p in paragraphs)
        texts[width + 1] = "\n".join(textwrap.fill(p, width) for p in paragraphs)
    junk = " ".join(prose(30, 60).replace(".", "").split())
    texts[1] = prose(31, 200) + "\n" + junk                    # one line a paragraph: a long line without an end goes
    marks = "\u0964\u061f\u3002\uff01\uff1f\u06d4\u0589\u1362"
    for k, mark in enumerate(marks):
        texts[200 + k] = "\n".join(" ".join(["\u0915\u0939\u0928\u093e%d%d" % (i, j) for j in range(20)]) + mark for i in range(4))
    got = {r["doc_id"]: r for r in apply_rules(make_docs(list(texts.items()))).collect()}
    for k, r in got.items():
        assert r.kept, k
        assert (r.n_lines_removed == 1 and junk not in r.clean_text) if k == 1 else r.clean_text == texts[k], k


def test_list_items_and_headings_need_no_sentence_end(spark, make_docs):
    words = "market garden river stone harbour window letter morning"
    marks = ["- ", "* ", "\u2022 ", "1. ", "12) ", "(a) ", "## ", "+ ", "\u2013 "]
    items = [f"{m}item {k} of the {words} and the {words} in the list of things {k}" for k, m in enumerate(marks * 3)]
    plain = [f"item {k} of the {words} and the {words} in the list of things {k}" for k in range(27)]
    got = {r.doc_id: r for r in apply_rules(make_docs([(1, "\n".join(items)), (2, "\n".join(plain))])).collect()}
    assert got[1].n_lines_removed == 0 and got[1].lost_share == 0
    assert got[2].lost_share > 0.9


def test_columns_of_any_name_are_carried(spark):
    clash = ["__w", "__l", "__all", "__j", "__kept", "__full", "row", "words", "lines", "full", "judged", "stay", "whole", "left"]
    df = spark.createDataFrame([("A few words.", *range(len(clash)))], "text string, " + ", ".join(f"`{c}` int" for c in clash))
    row = apply_rules(df).first()
    assert [row[c] for c in clash] == list(range(len(clash))) and row.text == "A few words." and row.n_words == 3
