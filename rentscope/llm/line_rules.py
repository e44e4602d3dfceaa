"""Quality rules: line-first cleaning, in built-in Spark functions only.

Every line is judged by itself (punctuation, navigation, boilerplate, symbol
noise, shouting, repetition); only the end of a sentence may stand on another
line where the text is hard-wrapped (see ``wrap_width``).  List items and
headings need no end of a sentence.  Failing lines go; a
document that loses more than ``max_loss`` of its characters, or fails the base
figures, is rejected.
The job is one map over the rows: no shuffle, so hot sources and groups of
copies cost nothing extra.

Defined cases: null text counts as empty; an empty text has no words, fails
the base rule (fewer than 50 words) and cleans to ``''``; repeated rows and
equal texts are judged alike; an extra column of any name is carried through
unless it has the name of an output column, which replaces it; an empty table
gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, words_of

# Characters counted as symbols.
SYMBOLS = "[#*$%&|<>]"
# The end of a sentence inside or at the end of a line.
SENTENCE_END = ("[.!?\\u2026](?:[\"'\\u201d\\u2019\\u00bb)\\]]|[\\x20\\x09-\\x0D]|$)"
                # sentence marks of other scripts, which need no space after them
                "|[\\u0589\\u061E\\u061F\\u06D4\\u0700-\\u0702\\u0964\\u0965\\u104A\\u104B\\u1362\\u1367\\u1368\\u166E"
                "\\u1735\\u1736\\u17D4\\u17D5\\u1803\\u1809\\u0F0D\\u0F0E\\u1AA8-\\u1AAB\\u1B5A\\u1B5B\\u1C3B\\u1C3C\\u1C7E\\u1C7F"
                "\\u3002\\uFE12\\uFE52\\uFE56\\uFE57\\uFF01\\uFF0E\\uFF1F\\uFF61\\uA4FF\\uA60E\\uA60F\\uA6F3\\uA6F7\\uA8CE\\uA8CF]"
                # Thai and Lao write no mark at a sentence's end
                "|[\\u0E01-\\u0E2E\\u0E81-\\u0EAE]")
# The beginning of a list item or of a heading.
ITEM = "^[\\x20\\t]*(?:[-*+\u2022\u2023\u2013\u2014\u25aa\u25cf\u00b7]|\\(?[0-9]{1,3}[.)]|\\(?[A-Za-z][.)]|#{1,6})[\\x20\\t]+[^\\x20\\t]"
# Longest word that counts when a line is tested for being full; least share of full lines.
WRAP_WORD, WRAP_SHARE = 20, 3
# The line break before a blank line.
BEFORE_BLANK = "\\n(?=[\\x20\\x09\\x0B-\\x0D]*(?:\\n|\\z))"
# Separators of menus and breadcrumbs.
NAV_SEPARATORS = ["|", "\u00bb", "\u203a", "\u2192", "\u2022", "\u00b7"]
# Phrases of page furniture.
BOILERPLATE = ("(?i)\\b(?:accept (?:all )?cookies|cookie policy|enable javascript|javascript is (?:disabled|required)"
               "|lorem ipsum|privacy policy|terms of (?:use|service)|all rights reserved|sign up now|log ?in to"
               "|click here|read more|share this|subscribe (?:now|to our)|back to top|skip to content)\\b")


@dataclass(frozen=True)
class LineRules:
    """Production parameters of the rules."""

    min_words: int = 50           # base: fewer words fail
    max_repeat_percent: int = 50  # base: more words inside repeated 3-word windows fail
    long_line: int = 80           # characters from which a line must hold the end of a sentence
    min_separators: int = 3       # menu line: so many separators at least,
    nav_share: float = 0.03       # ... and so many per character
    symbol_share: float = 0.05    # noisy line: symbols per character
    shout_share: float = 0.4      # shouting line: upper-case letters per character,
    shout_chars: int = 20         # ... from this length on
    furniture_chars: int = 200    # boilerplate phrases condemn lines up to this length
    max_loss: float = 0.4         # share of its characters a document may lose


def repeated_window_words(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more in ``words``.

    Windows are compared by 64-bit hash within one text.  Sorted (hash,
    position) pairs put equal windows side by side; the flagged positions are
    then swept left to right, each adding the words not yet covered."""

    def hashes(w: Column) -> Column:
        h = F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
        return F.slice(h, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0)))

    def flagged(p: Column) -> Column:
        hit = F.transform(p, lambda x, i: F.when(
            (F.get(p, i - 1)["h"] == x["h"]) | (F.get(p, i + 1)["h"] == x["h"]), x["i"]))
        return F.sort_array(F.filter(hit, lambda x: x.isNotNull()))

    def swept(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        start = F.struct(F.lit(0).alias("total"), F.lit(-3).alias("prev"))
        return F.aggregate(
            let(pairs, flagged), start,
            lambda a, x: F.struct((a["total"] + F.least(F.lit(3), x - a["prev"])).alias("total"), x.alias("prev")),
            lambda a: a["total"])

    # without any repeated hash there is nothing to sweep
    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(swept(h))

    return let(let(words, hashes), counted).cast("long")


def wrap_width(lines: Column) -> Column:
    """Width at which lines are hard-wrapped, or null: two or more, and a third of those that another
    line follows, are so full that the next line's first word had no room."""
    def measured(ls: Column) -> Column:
        both = F.transform(ls, lambda x, i: F.struct(
            _full_length(ls, i).alias("n"), F.length(x).alias("own"),
            F.rlike(F.trim(x), F.lit("[\\x20\\x09]")).alias("spaced")))
        return F.filter(both, lambda x: x["n"] > 0)

    def told(m: Column) -> Column:
        # an address without a space cannot be broken and says nothing of the width
        width = F.coalesce(F.array_max(F.transform(F.filter(m, lambda x: x["spaced"]), lambda x: x["own"])),
                           F.array_max(F.transform(m, lambda x: x["own"])))
        return let(width, lambda w: let(
            F.size(F.filter(m, lambda x: x["n"] > w)),
            lambda full: F.when((full >= 2) & (WRAP_SHARE * full >= F.size(m)), w)))

    return let(let(lines, measured), told)


def _full_length(lines: Column, i: Column) -> Column:
    """Length of line ``i`` with the first word of the next one; 0 unless both hold text."""
    word = F.length(F.regexp_extract(F.coalesce(F.get(lines, i + 1), F.lit("")),
                                     "^[\\x20\\x09]*([^\\x20\\x09-\\x0D]{1,%d})" % WRAP_WORD, 1))
    n = F.length(F.coalesce(F.get(lines, i), F.lit("")))
    return F.when((word > 0) & (n > 0), n + 1 + word).otherwise(F.lit(0))


def line_fails(line: Column, n_symbols: Column, continued: Column, rules: LineRules = LineRules()) -> Column:
    """True for a line that any rule rejects (``n_symbols`` of it counted before); ``continued`` tells
    that the sentence of a wrapped line ends on another one."""
    n = F.length(line)
    bare = line
    for mark in NAV_SEPARATORS:
        bare = F.replace(bare, F.lit(mark), F.lit(""))
    separators = n - F.length(bare)
    return ((n_symbols > rules.symbol_share * n)
            | ((separators >= rules.min_separators) & (separators >= rules.nav_share * n))
            | ((n >= rules.long_line) & ~continued & ~F.rlike(line, F.lit(SENTENCE_END)) & ~F.rlike(line, F.lit(ITEM)))
            | ((n <= rules.furniture_chars) & F.rlike(line, F.lit(BOILERPLATE)))
            | ((n >= rules.shout_chars) & (F.regexp_count(line, F.lit("\\p{Lu}")) > rules.shout_share * n)))


def _judged(line: Column, continued: Column, rules: LineRules) -> Column:
    counted = F.struct(line.alias("line"), F.regexp_count(line, F.lit(SYMBOLS)).alias("n_symbols"))
    return let(counted, lambda c: F.struct(
        c["line"].alias("line"), c["n_symbols"].alias("n_symbols"),
        line_fails(c["line"], c["n_symbols"], continued, rules).alias("fails")))


def _judged_lines(src: Column, lines: Column, rules: LineRules) -> Column:
    """The text's lines, judged; the end of a wrapped line's sentence is looked for up to the blank lines."""
    def open_line(x: Column) -> Column:
        return (F.length(x) >= rules.long_line) & ~F.rlike(x, F.lit(SENTENCE_END))

    def run(piece: Column, whole: Column) -> Column:
        ls = F.split(piece, "\n")
        width = F.when(F.exists(ls, open_line) & F.rlike(piece, F.lit(SENTENCE_END)), F.least(whole, wrap_width(ls)))
        # a full line goes on below, and the line after a full one ends it
        return let(width, lambda w: F.transform(ls, lambda x, i: _judged(
            x, F.coalesce((F.length(x) <= w) & ((_full_length(ls, i) > w) | (_full_length(ls, i - 1) > w)),
                          F.lit(False)), rules)))

    def runs(whole: Column) -> Column:
        return F.flatten(F.transform(F.split(src, BEFORE_BLANK), lambda p: run(p, whole)))

    # most texts hold no long line without an end: their lines are not searched again
    plain = F.transform(lines, lambda x: _judged(x, F.lit(True), rules))
    return F.when(F.exists(lines, open_line), let(wrap_width(lines), runs)).otherwise(plain)


def _chars(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0), lambda a, x: a + F.length(x["line"]))


def apply_rules(df: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """All columns of ``df`` plus the base figures, ``clean_text`` (lines kept,
    in order), ``n_lines_removed``, ``lost_share`` and ``kept``."""
    out = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "clean_text",
           "n_lines_removed", "lost_share", "kept")
    # the row travels as one value, so that no column of it meets a name used here
    carried = [c for c in df.columns if c not in out]
    row = F.struct(*[F.col(f"`{c}`") for c in carried]) if carried else F.lit(None).cast("int")
    src = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    a = df.select(row.alias("row"), words_of(src).alias("words"), F.split(src, "\n").alias("lines"))
    a = a.withColumn("full", F.filter("lines", lambda x: F.rlike(x, F.lit("[^\\x20\\x09-\\x0D]"))))
    a = a.withColumn("judged", _judged_lines(F.array_join("lines", "\n"), F.col("lines"), rules))
    a = a.withColumn("stay", F.filter("judged", lambda x: ~x["fails"]))
    a = a.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.aggregate("judged", F.lit(0), lambda t, x: t + x["n_symbols"]).cast("long").alias("n_symbols"),
        (F.size("full") - F.size(F.array_distinct("full"))).cast("long").alias("n_dup_lines"),
        repeated_window_words(F.col("words")).alias("n_repeat_words"),
        F.array_join(F.transform("stay", lambda x: x["line"]), "\n").alias("clean_text"),
        (F.size("judged") - F.size("stay")).cast("long").alias("n_lines_removed"),
        _chars(F.col("judged")).alias("whole"), _chars(F.col("stay")).alias("left"))
    base_failed = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    lost = F.when(F.col("whole") > 0, 1 - F.col("left") / F.col("whole")).otherwise(F.lit(0.0))
    a = a.withColumns({"base_failed": base_failed, "lost_share": lost})
    a = a.withColumn("kept", ~F.col("base_failed") & (F.col("lost_share") <= rules.max_loss))
    return a.select(*[F.col(f"row.`{c}`") for c in carried], *out)
