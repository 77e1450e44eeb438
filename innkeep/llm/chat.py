"""Chat examples by prefix-target expansion, and reading them back."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from innkeep.llm.common import maybe_broadcast, packed
from innkeep.session import stored

#: A turn is ``### role:``, its text and ``</turn>`` on lines of their own.  Inside texts
#: and roles these get a backslash before them, so that they only mark turns.
CONTROL, ESCAPED = r"(### |</turn)", r"\\(### |</turn)"
END = "\n</turn>\n"
#: Bytes of a conversation formatted in one row, and of a part of a longer one.
MOST_BYTES, PART_BYTES = 1 << 20, 1 << 18
#: What a turn's marks and row count for in these.
TURN_BYTES = 64
#: Bytes of long conversations in one sorted partition.
RANGE_BYTES = 64 << 20


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1")


def header(role: Column) -> Column:
    """The line that opens a turn.  A line end in a role is written as a backslash and l."""
    line = F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\l"))
    return F.concat(F.lit("### "), escape(line), F.lit(":\n"))


def read_turns(text: Column) -> Column:
    """``array<struct<role, text>>``: the turns of formatted text, unescaped."""

    def turn(written: Column) -> Column:
        line = F.substring_index(written, "\n", 1)
        role = unescape(F.substring(line, F.lit(5), F.length(line) - 5))
        role = F.replace(F.replace(role, F.lit("\\l"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))
        body = F.substring(written, F.length(line) + 2, F.length(written))
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    ended = F.split(text, END, -1)
    return F.transform(F.slice(ended, F.lit(1), F.size(ended) - 1), turn)


def _ordered(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``conv_id, t``: what orders a turn, then its role and text."""
    role_, text_ = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    order = F.col(turn).isNull().alias("no_turn"), F.col(turn).cast("long").alias("turn"), role_.alias("role"), F.md5(text_).alias("hash")
    return conversations.select(F.col(conv).alias("conv_id"), F.struct(*order, text_.alias("text")).alias("t"))


def _short_examples(turns: DataFrame, target: str) -> DataFrame:
    """Every example of conversations that fit in a row, as one part."""
    whole = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    written = whole.select(
        "conv_id",
        F.transform("turns", lambda t: F.concat(header(t["role"]), escape(t["text"]), F.lit(END))).alias("written"),
        F.transform("turns", lambda t: F.length(header(t["role"]))).alias("heads"),
        F.transform("turns", lambda t: t["role"] == target).alias("replies"),
    )
    last = F.size("written") - 1
    at = F.filter(F.sequence(F.lit(0), last), lambda i: F.get("replies", i) | (i == last))
    each = written.select("*", last.alias("last_turn"), F.explode(at).alias("at"))
    text = F.array_join(F.slice("written", F.lit(1), F.col("at") + 1), "")
    own = F.length(F.get("written", F.col("at")))
    reply = F.get("replies", F.col("at"))
    end = F.length("text")
    return each.select("*", text.alias("text"), reply.alias("trainable"), own.alias("own")).select(
        "conv_id",
        F.col("at").cast("long").alias("example"),
        F.lit(0).cast("long").alias("part"),
        "text",
        F.when(F.col("trainable"), end - F.col("own") + F.get("heads", F.col("at"))).cast("long").alias("loss_start"),
        F.when(F.col("trainable"), end - len(END)).cast("long").alias("loss_end"),
        "trainable",
        (F.col("at") == F.col("last_turn")).alias("last"),
    )


def _long_examples(turns: DataFrame, size: int, target: str, part_bytes: int) -> DataFrame:
    """The same for long conversations, in parts of about ``part_bytes``.

    Turns are sorted into ranges, which split a conversation; a range numbers its own
    turns and cuts them into parts.  An example is all parts before its target's, and the
    target's own part up to it: whole parts are joined to the examples that need them."""
    ranges = max(1, math.ceil(size / RANGE_BYTES))
    keys = ["conv_id", "t.no_turn", "t.turn", "t.role", "t.hash"]
    salted = turns.withColumn("salt", F.xxhash64(F.monotonically_increasing_id()))  # parts equal turns
    row = F.struct(F.monotonically_increasing_id().alias("place"), F.spark_partition_id().alias("range"))
    sorted_ = salted.repartitionByRange(ranges, *keys, "salt").sortWithinPartitions(*keys, "salt")
    written = F.concat(header(F.col("t.role")), escape(F.col("t.text")), F.lit(END))
    placed = sorted_.select(
        "conv_id", row.alias("at"), (F.col("t.role") == target).alias("reply"), F.length(header(F.col("t.role"))).alias("head"), written.alias("written")
    )
    placed = packed(placed.select("conv_id", "at.*", "reply", "head", "written"), "chat-turns")
    inside = Window.partitionBy("conv_id", "range").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.octet_length("written") + TURN_BYTES).over(inside), F.lit(0))
    cut = placed.withColumn("cut", F.floor(before / part_bytes))
    part = cut.groupBy("conv_id", "range", "cut").agg(F.array_sort(F.collect_list(F.struct("place", "reply", "head", "written"))).alias("own"))
    part = packed(part, "chat-parts")
    # one narrow row per part numbers the parts and the turns before them
    heads = part.select("conv_id", "range", "cut", F.size("own").cast("long").alias("turns"))
    order = Window.partitionBy("conv_id").orderBy("range", "cut")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    numbered = heads.select(
        F.col("conv_id").alias("conv"),
        F.col("range").alias("r"),
        F.col("cut").alias("c"),
        (F.row_number().over(order).cast("long") - 1).alias("part"),
        F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("before"),
        F.lead("turns").over(order).isNull().alias("end"),
    )
    numbered = stored(numbered, "chat-part-numbers")
    mine = part.join(numbered, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("range") == F.col("r")) & (F.col("cut") == F.col("c")))
    mine = packed(mine.select("conv_id", "part", "before", "end", "own"), "chat-numbered-parts")

    last = F.size("own") - 1
    final = F.col("end") & (F.col("i") == F.col("last_turn"))
    each = mine.select("conv_id", "part", "before", "end", "own", last.alias("last_turn"), F.posexplode("own").alias("i", "turn"))
    each = each.where(F.col("turn.reply") | final)
    text = F.array_join(F.transform(F.slice("own", F.lit(1), F.col("i") + 1), lambda t: t["written"]), "")
    example = (F.col("before") + F.col("i")).alias("example")
    target_part = each.select("conv_id", example, "part", text.alias("text"), "turn", final.alias("last"))
    end = F.length("text")
    closing = target_part.select(
        "conv_id",
        "example",
        "part",
        "text",
        F.when(F.col("turn.reply"), end - F.length("turn.written") + F.col("turn.head")).cast("long").alias("loss_start"),
        F.when(F.col("turn.reply"), end - len(END)).cast("long").alias("loss_end"),
        F.col("turn.reply").alias("trainable"),
        "last",
    )
    needs = each.where(F.col("part") > 0).select(F.col("conv_id").alias("conv"), example, F.col("turn.reply").alias("trainable"), final.alias("last"), "part")
    needs = needs.withColumn("needed", F.explode(F.expr("sequence(0L, part - 1)"))).drop("part")
    texts = mine.select("conv_id", "part", F.array_join(F.transform("own", lambda t: t["written"]), "").alias("text"))
    leading = texts.join(needs, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("part") == F.col("needed")))
    none = F.lit(None).cast("long")
    return closing.unionByName(
        leading.select("conv_id", "example", "part", "text", none.alias("loss_start"), none.alias("loss_end"), "trainable", "last")
    )


def _split_by_length(turns: DataFrame, most: int) -> tuple[DataFrame, DataFrame, int]:
    """Turns of conversations up to ``most`` bytes, of longer ones, and these ones' bytes."""
    sizes = turns.groupBy("conv_id").agg(F.sum(F.octet_length("t.text") + TURN_BYTES).alias("size"))
    long = stored(sizes.where(F.col("size") > most).select(F.col("conv_id").alias("conv"), "size"), "long-conversations")
    count, size = long.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    ids = maybe_broadcast(long.select("conv"), count)
    same = F.col("conv_id").eqNullSafe(F.col("conv"))
    return turns.join(ids, same, "left_anti"), turns.join(ids, same, "left_semi"), size


def examples(
    conversations: DataFrame,
    target: str = "assistant",
    most: int = MOST_BYTES,
    part_bytes: int = PART_BYTES,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """``conv_id, example, part, text, loss_start, loss_end, trainable, last``.

    Every turn of the role ``target`` becomes an example of its own: all turns before it,
    then the reply, and the loss covers the reply's text only (code points from
    ``loss_start`` to ``loss_end`` of ``text``).  What follows the last reply, or a
    conversation without one, is an example without loss (not ``trainable``), so that
    no turn is lost.  ``example`` is the number of the turn it ends with; ``last`` marks
    the one that holds the whole conversation.  ``read_turns`` reads a text back.

    Conversations up to ``most`` bytes are one row each while they are formatted, and
    their examples one part.  Longer ones come in parts of about ``part_bytes``, to be read one after
    the other, and are sorted, cut and joined by many tasks, so that no
    conversation needs to fit in one.

    Turns are ordered by number, those without one last, then by role and the md5 of the
    text; equal rows are turns of their own.  Null roles and texts are empty; rows
    without conversation id are one conversation.  An empty table gives no rows; other
    columns don't matter."""
    short, long, size = _split_by_length(_ordered(conversations, conv, turn, role, text), most)
    out = _short_examples(short, target)
    return out.unionByName(_long_examples(long, size, target, part_bytes)) if size else out


def _readable(formatted: DataFrame) -> DataFrame:
    """What a digest needs of each part: its length, the text under the mask, and of a
    conversation's last example the turns."""
    under = F.substring("text", F.col("loss_start").cast("int") + 1, (F.col("loss_end") - F.col("loss_start")).cast("int"))
    return formatted.select(
        "conv_id",
        "example",
        "part",
        F.length("text").cast("long").alias("chars"),
        unescape(under).alias("loss"),
        F.when(F.col("last"), read_turns(F.col("text"))).alias("turns"),
    )


def _short_digest(formatted: DataFrame) -> DataFrame:
    read = _readable(formatted).groupBy("conv_id")
    whole = read.agg(
        F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("example", "loss")))).alias("losses"),
        F.max_by("turns", "example").alias("turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def _hash_stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from its parts in order, holding one part at a time."""
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    now, state = None, None

    def done() -> pa.RecordBatch:
        turns, said, chars, lost, total = state
        row = (now[0], turns, said.hexdigest(), chars, lost.hexdigest(), total)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names)

    for batch in batches:
        for i in range(batch.num_rows):
            conv, chars, loss, turns = (batch.column(c)[i].as_py() for c in ("conv_id", "chars", "loss", "turns"))
            if now != (conv,):
                if now:
                    yield done()
                now, state = (conv,), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            state[4] += chars
            if loss is not None:
                state[2] += len(loss)
                state[3].update(loss.encode())
            for t in turns or ():
                state[0] += 1
                state[1].update(f"{t['role']}\n{t['text']}\n".encode())
    if now:
        yield done()


def _long_digest(formatted: DataFrame) -> DataFrame:
    """A hash runs over a text from end to end, so one task reads a conversation's
    replies and turns; it holds one part of them at a time."""
    read = _readable(formatted)
    chars = read.groupBy("conv_id").agg(F.sum("chars").alias("total")).withColumnRenamed("conv_id", "conv")
    said = read.where(F.col("loss").isNotNull() | F.col("turns").isNotNull())
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    ordered = said.repartition("conv_id").sortWithinPartitions("conv_id", "example", "part")
    hashed = ordered.mapInArrow(_hash_stream, schema)
    return hashed.join(chars, F.col("conv_id").eqNullSafe(F.col("conv"))).drop("conv", "formatted_chars").withColumnRenamed("total", "formatted_chars")


def chat_digest(conversations: DataFrame, target: str = "assistant", most: int = MOST_BYTES, part_bytes: int = PART_BYTES) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``: what
    the examples of each conversation give when they are read back.

    Turns come from the example that holds them all, as role, line end, text, line end;
    losses from all examples in order; ``formatted_chars`` counts all their code points.
    See ``examples`` for nulls, ties, repeated rows and long conversations."""
    short, long, size = _split_by_length(_ordered(conversations, "conv_id", "turn", "role", "text"), most)
    out = _short_digest(_short_examples(short, target))
    return out.unionByName(_long_digest(_long_examples(long, size, target, part_bytes))) if size else out
