"""Chat formatting: event-sourced reconstruction, in built-in functions only.

A log row is an event of a message: ``message`` (its first text), ``delta``
(text added), ``edit`` (text replaced), ``regenerate`` (text discarded, deltas
follow) or ``delete``.  Events are grouped by conversation and message; the
last event that replaces the text opens the final version, and the texts from
there on, in sequence order, are joined.  Messages are then ordered within the
conversation and rendered.

A first grouping by (conversation, message) spreads a long conversation over
the cluster; only final messages meet by conversation, as a conversation's
output is one row.

Template: a turn is ``<s>``, a role tag, the text, ``</s>``.  The role tags are
``[INST]`` (user), ``[/INST]`` (assistant), ``[SYS]`` (system) and
``[ROLE]hex of the name[/ROLE]`` (any other).  Inside texts a backslash is
doubled and every control string gets a backslash behind its first character,
so none can be read as a mark, and ``unescape`` restores the text.

Defined cases: null texts and roles count as empty; events of equal sequence
are ordered by their text; a message of repeated rows keeps each; events of a
message without an opening one start from empty text; an empty text keeps its
turn; extra columns are ignored; a null conversation id is a conversation of
its own; an empty log gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The template's marks.
OPEN, CLOSE = "<s>", "</s>"
USER, ASSISTANT, SYSTEM = "[INST]", "[/INST]", "[SYS]"
ROLE_OPEN, ROLE_CLOSE = "[ROLE]", "[/ROLE]"
REPLACING = ("message", "edit", "regenerate", "delete")
DELTA_CHARS = 512   # streamed pieces that plain rows are cut into


def escape(text: Column) -> Column:
    """Text with its backslashes doubled and its control strings broken up."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    angled = F.regexp_replace(doubled, "<(/?s>)", "<\\\\$1")
    return F.regexp_replace(angled, "\\[(/?INST\\]|SYS\\]|/?ROLE\\])", "[\\\\$1")


def unescape(text: Column) -> Column:
    angled = F.regexp_replace(text, "<\\\\(/?s>)", "<$1")
    squared = F.regexp_replace(angled, "\\[\\\\(/?INST\\]|SYS\\]|/?ROLE\\])", "[$1")
    return F.replace(squared, F.lit("\\\\"), F.lit("\\"))


def role_tag(role: Column) -> Column:
    return F.when(role == "user", USER).when(role == "assistant", ASSISTANT).when(role == "system", SYSTEM) \
        .otherwise(F.concat(F.lit(ROLE_OPEN), F.hex(F.encode(role, "utf-8")), F.lit(ROLE_CLOSE)))


def events_of_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text", delta_chars: int = DELTA_CHARS) -> DataFrame:
    """Event log (conv, seq, message, kind, role, text) of finished turns, as
    a chat service would have recorded them.

    An assistant's text streams in as deltas; every third such message is a
    second try, after a draft that was regenerated.  Any other text comes at once;
    every third is the edit of a first version.  One in seven is a message begun
    and deleted besides.  Folding gives the turns back.

    Rows are numbered by (turn, role, text) within the conversation, so that
    repeated turns stay apart; the number is the message and orders its events."""
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")) \
        .withColumn("message", F.row_number().over(order).cast("bigint"))
    event = "array<struct<k:int,kind:string,text:string>>"
    pieces = F.floor((F.length("text") + delta_chars - 1) / delta_chars).cast("int")
    number = F.pmod(F.xxhash64("conv", "message"), F.lit(21))

    def one(k: int, kind: str, what: Column) -> Column:
        return F.struct(F.lit(k).alias("k"), F.lit(kind).alias("kind"), what.alias("text"))

    draft = F.concat(F.lit("draft: "), F.reverse(F.substring("text", 1, 40)))
    nothing = F.array().cast(event)
    deltas = F.when(pieces > 0, F.transform(F.sequence(F.lit(1), F.greatest(pieces, F.lit(1))), lambda i: F.struct(
        (i + 8).alias("k"), F.lit("delta").alias("kind"),
        F.substring(F.col("text"), (i - 1) * delta_chars + 1, F.lit(delta_chars)).alias("text")))).otherwise(nothing)
    opening = F.array(one(0, "message", F.lit("")))
    retried = F.array(one(0, "message", F.lit("")), one(1, "delta", draft), one(2, "delta", F.lit(" ...")),
                      one(3, "regenerate", F.lit(None).cast("string")))
    streamed = F.concat(F.when(number % 3 == 0, retried).otherwise(opening), deltas)
    whole = F.when(number % 3 == 0, F.array(one(0, "message", draft), one(1, "edit", F.col("text")))) \
        .otherwise(F.array(one(0, "message", F.col("text"))))
    events = F.when(F.col("role") == "assistant", streamed).otherwise(whole)
    # a message of its own, behind all others of its conversation
    gone = F.when(number % 7 == 0, F.array(one(0, "message", draft), one(1, "delta", F.lit(" ...")), one(2, "delete", F.lit("")))) \
        .otherwise(nothing)
    told = rows.select("conv", "message", "role", F.explode(events).alias("e")) \
        .unionByName(rows.select("conv", (F.col("message") + (1 << 30)).alias("message"), "role", F.explode(gone).alias("e")))
    return told.select("conv", (F.shiftleft("message", 32) + F.col("e.k")).alias("seq"), "message", "e.kind", "role", "e.text")


def fold(events: DataFrame) -> DataFrame:
    """Final messages (conv, message, role, text) of an event log."""
    last = F.max(F.when(F.col("kind").isin(*REPLACING), F.struct("seq", "kind"))).alias("last")
    parts = F.collect_list(F.struct("seq", F.coalesce("text", F.lit("")).alias("text"))).alias("parts")
    role = F.max_by(F.coalesce("role", F.lit("")), "seq").alias("role")
    grouped = events.groupBy("conv", "message").agg(last, parts, role)
    # a regeneration opens an empty text; its own row carries none
    final = F.filter(F.sort_array("parts"), lambda x: F.col("last").isNull() | (x["seq"] >= F.col("last.seq")))
    return grouped.where(F.col("last").isNull() | (F.col("last.kind") != "delete")) \
        .select("conv", "message", "role", F.array_join(F.transform(final, lambda x: x["text"]), "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv, formatted, loss): the conversation's text, and the character
    ranges [start, end) of the assistant's escaped texts in it."""
    turns = messages.select("conv", "message", F.concat(F.lit(OPEN), role_tag(F.col("role"))).alias("head"),
                            escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("learn")) \
        .groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("message", "head", "body", "learn"))).alias("turns"))
    spans = "array<struct<start:bigint,end:bigint>>"
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(spans).alias("out"))

    def step(a: Column, x: Column) -> Column:
        begin = a["at"] + F.length(x["head"])
        end = begin + F.length(x["body"])
        return F.struct((end + len(CLOSE)).alias("at"), F.when(x["learn"], F.concat(a["out"], F.array(
            F.struct(begin.alias("start"), end.alias("end"))))).otherwise(a["out"]).alias("out"))

    return turns.select(
        "conv",
        F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate("turns", start, step, lambda a: a["out"]).alias("loss"))


def format_conversations(events: DataFrame) -> DataFrame:
    """(conv, formatted, loss) from an event log."""
    return render(fold(events))


def read_back(formatted: Column) -> Column:
    """Turns array<struct<role, text>> parsed from a formatted conversation."""
    def one(x: Column) -> Column:
        body = F.substring(x, len(OPEN) + 1, F.length(x))
        other = F.startswith(body, F.lit(ROLE_OPEN))
        named = F.regexp_extract(body, "^\\[ROLE\\]([0-9A-F]*)\\[/ROLE\\]", 1)
        tag = F.when(F.startswith(body, F.lit(USER)), F.lit(len(USER))) \
            .when(F.startswith(body, F.lit(ASSISTANT)), F.lit(len(ASSISTANT))) \
            .when(F.startswith(body, F.lit(SYSTEM)), F.lit(len(SYSTEM))) \
            .otherwise(F.length(named) + len(ROLE_OPEN) + len(ROLE_CLOSE))
        role = F.when(other, F.decode(F.unhex(named), "utf-8")).when(F.startswith(body, F.lit(USER)), F.lit("user")) \
            .when(F.startswith(body, F.lit(ASSISTANT)), F.lit("assistant")).otherwise(F.lit("system"))
        return F.struct(role.alias("role"), unescape(F.substring(body, tag + 1, F.length(body))).alias("text"))

    pieces = F.split(formatted, CLOSE)
    return F.transform(F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0))), one)


def digests(formatted: DataFrame) -> DataFrame:
    """Contract figures of formatted conversations, all read back from the output."""
    turns = read_back(F.col("formatted"))
    log = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda x: unescape(
        F.substring(F.col("formatted"), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")))), "")
    return formatted.withColumn("turns", turns).select(
        F.col("conv").alias("conv_id"), F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(log, 256).alias("turns_sha256"), F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"), F.length("formatted").cast("bigint").alias("formatted_chars"))
