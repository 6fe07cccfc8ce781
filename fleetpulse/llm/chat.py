r"""Chat formatting in windows of a token budget, by DataFrame functions alone.

The turns of a conversation, in order, take up a line of tokens: prefix sums give each
turn its start on it. The line is cut into cells as long as a window has room for new
turns, and a turn belongs to the cell it starts in. A cell whose turns fit is one span;
else its last turn, the only one that can reach over the cell's end, is a span of its
own. Every span is a window; before its turns it repeats the conversation's system turn
and the whole turns that start within ``HISTORY`` tokens before it. The loss mask covers
the text of assistant turns and leaves out repeated ones, so each is a target just once.

Prefix sums are taken in two steps, within ranges of equal size over (conversation,
turn) and then over the sums of the ranges, and cells are grouped by conversation and
cell. So nothing but ids and numbers is sorted, and a conversation that holds a third of
all turns is spread like any other.

The template writes a turn as ``<turn>role\ntext</turn>\n``. Inside roles and texts a
backslash becomes two, the ``<`` of a control string ``\l`` and a line break in a role
``\n``: escaped text holds no control string, and ``read_turns`` undoes it.

Tokens are counted by a regular expression (``TOKEN``) on the formatted turn, which any
expression can replace.

Defined cases: a NULL text or role is the empty one; turns with equal numbers come by
role and the digest of their text, a NULL number first; rows that repeat are turns of
their own; a NULL conversation id is one conversation; an empty table gives no windows;
a turn longer than a window is a window of its own, whole, over the budget (``n_tokens``
tells); a system turn over half the budget leaves ``LEAST_ROOM`` of it for others.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.shared import keep, partitions, table

BUDGET = 1024
HISTORY = 128
# The least share of the budget that new turns have, whatever the system turn takes.
LEAST_ROOM = 0.25
OPEN, CLOSE = "<turn>", "</turn>"
END = CLOSE + "\n"
SYSTEM, TARGET = "system", "assistant"
TOKEN = r"[A-Za-z]{1,6}|[0-9]{1,3}|[^A-Za-z0-9\x00-\x20]{1,2}|\n"


def count_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN)).cast("long")


@dataclass(frozen=True)
class Budget:
    """``tokens`` a window may hold and how many of them repeated turns may take."""

    tokens: int = BUDGET
    history: int = HISTORY
    count: Callable[[Column], Column] = count_tokens

    def room(self, system: Column) -> Column:
        """What a window has for new turns beside its system turn and history."""
        least = max(int(self.tokens * LEAST_ROOM), self.history, 1)
        return F.greatest(F.lit(least), F.lit(self.tokens - self.history) - system)


def escaped(text: Column) -> Column:
    """``text`` without control strings; ``unescaped`` gives it back."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (OPEN, CLOSE):
        doubled = F.replace(doubled, F.lit(control), F.lit("\\l" + control[1:]))
    return doubled


def unescaped(text: Column) -> Column:
    # Between double backslashes no other backslash is doubled, so what is left there
    # can be put back by plain replacement.
    parts = F.transform(
        F.split(text, r"\\\\"),
        lambda part: F.replace(
            F.replace(part, F.lit("\\l"), F.lit("<")), F.lit("\\n"), F.lit("\n")
        ),
    )
    return F.array_join(parts, "\\")


def rendered_turns(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row per turn, kept: its place in order, ``rendered`` and ``tokens``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    head = F.concat(F.lit(OPEN), F.replace(escaped(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    rows = conversations.select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.length(head).alias("n_head"),
        F.concat(head, escaped(text), F.lit(END)).alias("rendered"),
    )
    return keep(rows.withColumn("tokens", F.greatest(F.lit(1), budget.count(F.col("rendered")))), "turns")


def placed_turns(turns: DataFrame) -> DataFrame:
    """``row_no``, ``conv_id``, ``role``, ``tokens`` and ``start``, kept.

    ``start`` is the sum of the tokens of the conversation's turns before.
    """
    order = ["turn", "role", "digest", "row_no"]
    ranges = (
        turns.select("conv_id", *order, "tokens")
        .repartitionByRange(partitions(turns.sparkSession), "conv_id", *order)
        .withColumn("block", F.spark_partition_id())
    )
    ranges = keep(ranges, "ranges")
    before = Window.partitionBy("block", "conv_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = ranges.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    blocks = ranges.groupBy("conv_id", "block").agg(F.sum("tokens").alias("tokens"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        F.col("conv_id").alias("of_conv"),
        F.col("block").alias("of_block"),
        F.sum("tokens").over(earlier).alias("offset"),
    ).where("offset IS NOT NULL")  # only conversations that reach over a range's end have any
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("block") == F.col("of_block"))
    start = F.col("before") + F.coalesce("offset", F.lit(0))
    placed = own.join(keep(offsets, "offsets"), same, "left")
    return keep(placed.select("row_no", "conv_id", "role", "tokens", start.alias("start")), "places")


def spans(placed: DataFrame, budget: Budget = Budget()) -> tuple[DataFrame, DataFrame]:
    """The turns with their cell, and the windows, both kept.

    Turns: as given, with ``room``, ``cell`` and, of the conversation's first system
    turn, ``system_row`` and ``system_start``. Windows: ``of_conv``, ``of_cell`` and the
    places on the token line where their new turns begin (``first``) and end (``last``).
    """
    systems = placed.where(F.col("role") == SYSTEM).groupBy("conv_id").agg(
        F.min(F.struct("start", "row_no", "tokens")).alias("system")
    )
    systems = keep(systems.withColumnRenamed("conv_id", "of_conv"), "systems")
    room = budget.room(F.coalesce("system.tokens", F.lit(0)))
    turns = placed.join(systems, F.col("conv_id").eqNullSafe(F.col("of_conv")), "left").select(
        "row_no", "conv_id", "tokens", "start", room.alias("room"),
        F.floor(F.col("start") / room).cast("long").alias("cell"),
        F.col("system.row_no").alias("system_row"), F.col("system.start").alias("system_start"),
    )
    turns = keep(turns, "cells")
    cells = turns.groupBy("conv_id", "cell", "room", "system_row", "system_start").agg(
        F.min("start").alias("first"), F.max(F.struct("start", "tokens")).alias("last")
    )
    end = F.col("last.start") + F.col("last.tokens")
    whole = (end - F.col("first") <= F.col("room")) | (F.col("first") == F.col("last.start"))
    one = F.struct(F.col("first").alias("first"), end.alias("last"))
    front = F.struct(F.col("first").alias("first"), F.col("last.start").alias("last"))
    back = F.struct(F.col("last.start").alias("first"), end.alias("last"))
    windows = cells.select(
        F.col("conv_id").alias("of_conv"),
        F.col("cell").alias("of_cell"),
        F.col("system_row").alias("of_system"),
        F.col("system_start").alias("from_system"),
        F.explode(F.when(whole, F.array(one)).otherwise(F.array(front, back))).alias("span"),
    ).select("of_conv", "of_cell", "of_system", "from_system", "span.first", "span.last")
    return turns, keep(windows, "spans")


def window_members(turns: DataFrame, windows: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """``conv_id``, ``first`` (which names the window), ``row_no``, ``start``, ``repeated``."""
    reach = F.floor((F.col("start") + budget.history) / F.col("room"))
    reached = turns.select(
        "row_no", "start", "conv_id", F.explode(F.sequence("cell", reach)).alias("cell")
    )
    same = F.col("conv_id").eqNullSafe(F.col("of_conv")) & (F.col("cell") == F.col("of_cell"))
    new = (F.col("start") >= F.col("first")) & (F.col("start") < F.col("last"))
    near = (F.col("start") < F.col("first")) & (F.col("start") >= F.col("first") - budget.history)
    direct = reached.join(windows, same).where(new | near).select(
        "conv_id", "first", "row_no", "start", near.alias("repeated")
    )
    system = windows.where(F.col("from_system") < F.col("first") - budget.history).select(
        F.col("of_conv").alias("conv_id"), "first", F.col("of_system").alias("row_no"),
        F.col("from_system").alias("start"), F.lit(True).alias("repeated"),
    )
    return direct.unionByName(system)


def format_windows(conversations: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """One row per window.

    ``conv_id``; ``first``, its place, which also orders a conversation's windows;
    ``text``; ``n_repeated``, the turns at its head that other windows have as new ones;
    ``loss``, the targets as (``start``, ``length``) in code points of ``text``;
    ``n_tokens``.
    """
    turns = rendered_turns(conversations, budget)
    placed, windows = spans(placed_turns(turns), budget)
    members = window_members(placed, windows, budget)
    rows = members.join(turns.select("row_no", "role", "n_head", "rendered", "tokens"), "row_no")
    before = Window.partitionBy("conv_id", "first").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum(F.length("rendered")).over(before), F.lit(0))
    inside = F.length("rendered") - F.col("n_head") - len(END)
    target = (F.col("role") == TARGET) & ~F.col("repeated")
    loss = F.when(target, F.struct((offset + F.col("n_head")).alias("start"), inside.cast("long").alias("length")))
    grouped = rows.withColumn("loss", loss).groupBy("conv_id", "first").agg(
        F.array_sort(F.collect_list(F.struct("start", "rendered"))).alias("turns"),
        F.count_if("repeated").alias("n_repeated"),
        F.array_sort(F.collect_list("loss")).alias("loss"),
        F.sum("tokens").alias("n_tokens"),
    )
    text = F.array_join(F.transform("turns", lambda turn: turn["rendered"]), "")
    return grouped.select("conv_id", "first", text.alias("text"), "n_repeated", "loss", "n_tokens")


def read_turns(text: Column) -> Column:
    """The turns of a formatted text, as structs of ``role`` and ``text``."""
    pieces = F.split(text, END)
    written = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing follows the last end

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        return F.struct(
            unescaped(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"),
            unescaped(F.substr(piece, F.length(head) + 2)).alias("text"),
        )

    return F.transform(written, turn)


def read_targets(text: Column, loss: Column) -> Column:
    """The texts under the loss mask, in order."""
    return F.transform(
        loss,
        lambda span: unescaped(
            F.substr(text, (span["start"] + 1).cast("int"), span["length"].cast("int"))
        ),
    )


def op12_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    r"""The conversations and one more, formatted, and read back from the windows.

    A conversation's digests run over all its text, so the query, unlike the operator,
    brings a conversation's new turns together.
    """
    tricky = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(TARGET).alias("role"),
        F.lit(tricky).alias("text"),
    )
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    windows = keep(format_windows(rows.unionByName(extra)), "windows")
    found = read_turns(F.col("text"))
    fresh = F.slice(found, F.col("n_repeated").cast("int") + 1, F.size(found))
    lines = F.transform(fresh, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    read = windows.select(
        "conv_id",
        "first",
        F.size(fresh).alias("n_turns"),
        F.array_join(lines, "").alias("turns"),
        F.array_join(read_targets(F.col("text"), F.col("loss")), "").alias("targets"),
        F.length("text").alias("n_chars"),
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n_turns").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("first", "turns", "targets"))).alias("parts"),
        F.sum("n_chars").alias("formatted_chars"),
    )
    targets = F.array_join(F.col("parts.targets"), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join(F.col("parts.turns"), ""), 256).alias("turns_sha256"),
        F.length(targets).cast("long").alias("loss_chars"),
        F.sha2(targets, 256).alias("loss_sha256"),
        "formatted_chars",
    )


# Prefix sums, cells and repeated turns as above, in plain window functions.
SQL = rf"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    e AS (
      SELECT *, '{OPEN}' || replace(replace(replace(replace(role, '\', '\\'),
          '{OPEN}', '\l{OPEN[1:]}'), '{CLOSE}', '\l{CLOSE[1:]}'), chr(10), '\n') || chr(10)
        || replace(replace(replace(text, '\', '\\'), '{OPEN}', '\l{OPEN[1:]}'),
          '{CLOSE}', '\l{CLOSE[1:]}') || '{CLOSE}' || chr(10) AS rendered
      FROM c),
    t AS (
      SELECT *, greatest(1, len(regexp_extract_all(rendered, '{TOKEN}'))) AS tokens,
        row_number() OVER (
          PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS n FROM e),
    p AS (
      SELECT *, coalesce(sum(tokens) OVER (
        PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
        AS s FROM t),
    y AS (
      SELECT conv_id, min(s) AS ys, arg_min(tokens, s) AS yt FROM p
      WHERE role = '{SYSTEM}' GROUP BY 1),
    r AS (
      SELECT p.*, ys, greatest({max(int(BUDGET * LEAST_ROOM), HISTORY)},
        {BUDGET - HISTORY} - coalesce(yt, 0)) AS room
      FROM p LEFT JOIN y ON p.conv_id IS NOT DISTINCT FROM y.conv_id),
    g AS (SELECT *, CAST(s // room AS BIGINT) AS cell FROM r),
    q AS (
      SELECT conv_id, cell, any_value(ys) AS ys, any_value(room) AS room, min(s) AS a,
        max(s) AS b, max(s + tokens) AS z FROM g GROUP BY 1, 2),
    w AS (
      SELECT conv_id, ys, a AS first, CASE WHEN z - a <= room OR a = b THEN z ELSE b END AS last
      FROM q
      UNION ALL SELECT conv_id, ys, b, z FROM q WHERE z - a > room AND a < b),
    m AS (
      SELECT g.conv_id, sum(length(rendered)) AS n
      FROM w JOIN g ON w.conv_id IS NOT DISTINCT FROM g.conv_id
        AND g.s >= least(first - {HISTORY}, first) AND g.s < last
        OR w.conv_id IS NOT DISTINCT FROM g.conv_id AND g.s = w.ys AND w.ys < first - {HISTORY}
      GROUP BY 1)
    SELECT t.conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY t.n)) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (role = '{TARGET}'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY t.n) FILTER (role = '{TARGET}'), ''))
        AS loss_sha256,
      CAST(any_value(m.n) AS BIGINT) AS formatted_chars
    FROM t JOIN m ON t.conv_id IS NOT DISTINCT FROM m.conv_id GROUP BY 1
"""
