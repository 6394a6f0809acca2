"""Chat formatting by multi-party perspective rotation, with DataFrame functions only.

Every participant of a conversation gets its own rendering: their messages are
the assistant's, everyone else's those of users with a name, system messages
stay what they are.  ``mask`` has the character spans (start, length) to train
on: the assistant's message bodies with the mark that ends them.

Long conversations are rendered in parts of ``PART_TURNS`` consecutive turn
numbers.  A part is all that one task has to hold, however long its
conversation is; no window runs over a conversation.  Turn numbers that repeat
may overfill a part; one with more than ``MOST`` different messages is dealt
into several (``sub``) along the order of its messages: consecutive turn
numbers share one while they fit, and a turn number with more than ``MOST``
messages of its own is cut into ranges of role and text.  The texts of a part,
joined by ``sub``, are the text of the whole part.

Defined results: identical rows are one message, delivered again; messages of
one turn come by role and text; a null turn is a part of its own (null); a
null role is the participant ``unknown``, a null text an empty message, a null
``conv_id`` a conversation like any other; conversations of system messages
only have no participant and so no rendering; marks in texts and names are
broken up (``< |``), so that no message can forge a turn; other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from saleswh.llm.tables import written

#: Turn numbers of a part, and different messages beyond which it is dealt into several.
PART_TURNS, MOST = 64, 256
#: Characters of a text that divide the messages of one turn number and role among tasks; they are sorted by all of it.
PREFIX = 256
TURN = ["conv_id", "part", "turn"]
SYSTEM = "system"
END = "<|end|>"


def _plain(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def messages(turns: DataFrame) -> DataFrame:
    """(conv_id, part, turn, role, text): every message once."""
    rows = turns.select("conv_id", F.floor(F.col("turn") / PART_TURNS).cast("long").alias("part"), "turn",
                        F.coalesce(F.col("role"), F.lit("unknown")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    return rows.distinct()


def _same_turn(a: DataFrame, b: DataFrame) -> Column:
    conv, part, turn = (a[c].eqNullSafe(b[f"_{c}"]) for c in TURN)
    return conv & part & turn


def _dealt(rows: DataFrame) -> DataFrame:
    """(_conv_id, _part, _turn, _n, _first): messages and first ``sub`` of each turn number of the overfull parts."""
    turns = rows.groupBy(*TURN).agg(F.count(F.lit(1)).alias("n"))
    full = turns.groupBy("conv_id", "part").agg(F.sum("n").alias("all"), F.sort_array(F.collect_list(F.struct("turn", "n"))).alias("turns")) \
        .where(F.col("all") > MOST)

    def step(seen: Column, t: Column) -> Column:
        fits = seen["held"] + t["n"] <= MOST
        first = F.when(fits | (seen["held"] == 0), seen["sub"]).otherwise(seen["sub"] + 1)
        held = F.when(fits, seen["held"] + t["n"]).otherwise(F.least(t["n"], F.lit(MOST).cast("long")))
        entry = F.struct(t["turn"].alias("_turn"), t["n"].alias("_n"), first.alias("_first"))
        return F.struct((first + F.ceil(t["n"] / MOST) - 1).alias("sub"), held.alias("held"), F.concat(seen["turns"], F.array(entry)).alias("turns"))

    none = F.struct(F.lit(0).cast("long").alias("sub"), F.lit(0).cast("long").alias("held"),
                    F.array().cast("array<struct<_turn:bigint,_n:bigint,_first:bigint>>").alias("turns"))
    return full.select(F.col("conv_id").alias("_conv_id"), F.col("part").alias("_part"), F.inline(F.aggregate("turns", none, step, lambda seen: seen["turns"])))


def _ranges(rows: DataFrame) -> DataFrame:
    """``rows`` with ``_range``, the place of a message among those of its turn number by role and text, in steps of ``MOST``.

    The rows are sorted over all tasks and written once; places are counted
    from the rows of a turn number in each task, not by a window over them.
    """
    placed = rows.repartitionByRange(*TURN, "role", F.substring("text", 1, PREFIX)).sortWithinPartitions(*TURN, "role", "text") \
        .withColumn("_place", F.monotonically_increasing_id()).withColumn("_task", F.shiftright("_place", 33))
    placed = written(placed, "chat-turns-sorted")
    sizes = placed.groupBy(*TURN, "_task").agg(F.count(F.lit(1)).alias("size"), F.min("_place").alias("least"))
    before = F.sum("size").over(Window.partitionBy(*TURN).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(*(F.col(c).alias(f"_{c}") for c in TURN), F.col("_task").alias("_of"), (F.coalesce(before, F.lit(0)) - F.col("least")).alias("_shift"))
    joined = placed.join(starts, _same_turn(placed, starts) & (placed["_task"] == starts["_of"]))
    return joined.select(*rows.columns, F.floor((F.col("_place") + F.col("_shift")) / MOST).alias("_range"))


def parts(rows: DataFrame) -> DataFrame:
    """(conv_id, part, sub, messages): the sorted messages of each part."""
    dealt = written(_dealt(rows), "chat-turns")
    known = rows.join(dealt, _same_turn(rows, dealt), "left").select(*rows.columns, "_n", "_first")
    ranged = known.where(F.coalesce(F.col("_n"), F.lit(0)) <= MOST).withColumn("_range", F.lit(0).cast("long"))
    if not dealt.where(F.col("_n") > MOST).isEmpty():
        ranged = ranged.unionByName(_ranges(known.where(F.col("_n") > MOST)))
    sub = F.coalesce(F.col("_first") + F.col("_range"), F.lit(0)).cast("long")
    return ranged.groupBy("conv_id", "part", sub.alias("sub")) \
        .agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))


def rotated(turns: DataFrame) -> DataFrame:
    """conv_id, participant, part, sub, n_messages, ``text`` and ``mask`` for every participant and part."""
    rows = messages(turns)
    who = rows.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("_conv"), F.col("role").alias("participant")).distinct()
    cast = parts(rows)
    views = cast.join(who, cast["conv_id"].eqNullSafe(who["_conv"]))

    def segment(m: Column) -> Column:
        mine = m["role"] == F.col("participant")
        head = F.when(m["role"] == SYSTEM, F.lit("<|system|>")).when(mine, F.lit("<|assistant|>")) \
            .otherwise(F.concat(F.lit("<|user name="), _plain(m["role"]), F.lit("|>")))
        return F.struct(F.concat(head, F.lit("\n")).alias("head"), F.concat(_plain(m["text"]), F.lit(END)).alias("body"), mine.alias("mine"))

    views = views.withColumn("segments", F.transform("messages", segment))
    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(seen: Column, s: Column) -> Column:
        start, size = seen["at"] + F.length(s["head"]), F.length(s["body"]).cast("long")
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct((start + size + 1).alias("at"), F.when(s["mine"], F.concat(seen["spans"], span)).otherwise(seen["spans"]).alias("spans"))

    text = F.array_join(F.transform("segments", lambda s: F.concat(s["head"], s["body"], F.lit("\n"))), "")
    return views.select("conv_id", "participant", "part", "sub", F.size("messages").cast("long").alias("n_messages"),
                        text.alias("text"), F.aggregate("segments", none, step, lambda seen: seen["spans"]).alias("mask"))
