"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent
turns of one role are merged into a block by array functions, and the blocks
are concatenated:

    ### user: text<next>text</turn>### assistant: text</turn>

Texts and roles are escaped so that no marker can occur inside them:
backslash, ``<``, ``#`` and ``:`` become ``\\b``, ``\\l``, ``\\h``, ``\\c``.
An escaped text holds backslashes only as the first character of such a pair,
so the pairs can be undone one kind after another, the backslash last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, SEP, NEXT, CLOSE = "### ", ": ", "<next>", "</turn>"
_PAIRS = [("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c")]
LOSS_ROLE = "assistant"
RUN = 128  # elements of a run of a running sum


def escape(text: Column) -> Column:
    for plain, code in _PAIRS:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(_PAIRS):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, also where ``body`` uses it
    inside a lambda (a plain column may be computed again per element)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _sums_before(values: Column) -> Column:
    """For every element of an array of longs the sum of those before it, in
    runs of RUN elements: no accumulator grows with the array's square."""
    zero, none = F.lit(0).cast("long"), F.array().cast("array<bigint>")
    kind = "struct<sum:bigint,all:array<bigint>>"

    def scan(xs: Column) -> Column:
        return F.aggregate(xs, F.struct(zero.alias("sum"), none.alias("all")).cast(kind), lambda acc, x: F.struct(
            (acc["sum"] + x).alias("sum"), F.concat(acc["all"], F.array(acc["sum"])).alias("all")).cast(kind))

    def join(xs: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(xs) - 1) / F.lit(RUN)).cast("int")),
                          lambda k: scan(F.slice(xs, k * RUN + 1, F.lit(RUN))))
        return _let(cut, lambda cs: _let(
            scan(F.transform(cs, lambda c: c["sum"]))["all"],
            lambda starts: F.flatten(F.transform(cs, lambda c, k: F.transform(
                c["all"], lambda s: s + F.get(starts, k))))))

    return F.when(F.size(values) == 0, none).otherwise(_let(values, join))


def format_chats(rows: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)`` to ``(conv_id, formatted, loss)``, one
    row per conversation.

    ``loss`` is the loss mask: an array of (start, chars) in code points of
    ``formatted``, one entry per turn of the assistant, covering its text and
    no marker. Turns come by turn number (null first), then role and text, so
    ties and repeated rows have one order and all stay. A null text or role
    is an empty one, a null ``conv_id`` is one conversation, other columns
    are ignored. One conversation is one value of one row, so its turns meet
    in one task; what is gathered for it is the result itself.
    """
    one = rows.select("conv_id", F.struct(
        F.col("turn").alias("turn"), F.coalesce(escape(F.col("role")), F.lit("")).alias("role"),
        F.coalesce(escape(F.col("text")), F.lit("")).alias("text")).alias("t"))
    got = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # Where a block begins, and after the last one the end.
    at = F.filter(F.sequence(F.lit(0), F.size("turns")), lambda i: (i == 0) | (i == F.size("turns")) | (
        F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    got = got.withColumn("at", at)
    got = got.withColumn("blocks", F.transform(
        F.slice("at", F.lit(1), F.size("at") - 1),
        lambda start, k: F.slice("turns", start + 1, F.get("at", k + 1) - start)))
    got = got.withColumn("blocks", F.transform("blocks", lambda b: F.struct(
        F.get(b, F.lit(0))["role"].alias("role"), F.transform(b, lambda t: t["text"]).alias("texts"))))
    formatted = F.array_join(F.transform("blocks", lambda b: F.concat(
        F.lit(OPEN), b["role"], F.lit(SEP), F.array_join(b["texts"], NEXT), F.lit(CLOSE))), "")
    # Lengths of every text and of the marks before and after it, in turn order.
    parts = F.flatten(F.transform("blocks", lambda b: F.transform(b["texts"], lambda t, i: F.struct(
        F.when(i == 0, F.length(b["role"]) + len(OPEN + SEP)).otherwise(len(NEXT)).cast("long").alias("mark"),
        F.length(t).cast("long").alias("chars"),
        F.when(i == F.size(b["texts"]) - 1, len(CLOSE)).otherwise(0).cast("long").alias("end"),
        (b["role"] == LOSS_ROLE).alias("loss")))))
    loss = _let(parts, lambda ps: _let(
        _sums_before(F.transform(ps, lambda p: p["mark"] + p["chars"] + p["end"])),
        lambda at: F.transform(
            F.filter(F.transform(ps, lambda p, i: F.struct(
                (F.get(at, i) + p["mark"]).alias("start"), p["chars"].alias("chars"), p["loss"].alias("loss"))),
                lambda p: p["loss"]),
            lambda p: F.struct(p["start"].alias("start"), p["chars"].alias("chars")))))
    return got.select("conv_id", formatted.alias("formatted"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The array of (role, text) that a formatted text was made from."""
    blocks = F.split(formatted, CLOSE)
    return F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), lambda b: F.transform(
        F.split(F.substring_index(b, SEP, -1), NEXT), lambda t: F.struct(
            unescape(F.replace(F.substring_index(b, SEP, 1), F.lit(OPEN), F.lit(""))).alias("role"),
            unescape(t).alias("text")))))


def masked_text(formatted: Column, loss: Column) -> Column:
    """The text under the loss mask, unescaped, nothing between. Spans are cut
    from the text at four bytes a character, so a span is found at once."""
    return unescape(F.array_join(_let(F.encode(formatted, "UTF-32"), lambda wide: F.transform(loss, lambda s: F.decode(
        F.substr(wide, (s["start"] * 4 + 1).cast("int"), (s["chars"] * 4).cast("int")), "UTF-32"))), ""))


def digests(rows: DataFrame) -> DataFrame:
    """The contract's columns, read back from the formatted text and mask."""
    got = format_chats(rows).select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("turns"),
        masked_text(F.col("formatted"), F.col("loss")).alias("masked"))
    every = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return got.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
        "formatted_chars")
