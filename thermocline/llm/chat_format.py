"""Chat formatting into budgeted windows of whole turns, in DataFrame functions only.

A turn is written as ``<s>[INST] role [/INST] text</s>``. In roles and texts, a backslash is doubled
and the strings ``<s>``, ``</s>``, ``[INST]`` and ``[/INST]`` get a backslash after their first
character, so that they occur as marks only; removing each escaping backslash gives the text
back.

A conversation's turns are cut into windows of at most ``budget`` tokens, along the prefix sums of
the turns' tokens: a window takes turns as long as they fit. It begins with the conversation's
first turn if that is a system turn (retained in every window), then repeats the last turns of
the window before, as many as fit into ``history`` tokens and HISTORY_TURNS; only turns that were
not written before are targets. The loss mask is a list of spans (start, length in code points)
that cover the escaped texts of the assistant's targets, so every assistant text is learned once.

Places and windows need no gathered conversation: turns are numbered by ``operators.ordered``,
prefix sums run inside segments of SEGMENT turns, where the windows are chosen, and a window never
reaches over a segment's end. One window is one row. A turn's size in tokens is estimated by
``token_estimate`` unless the caller gives a column expression.

Defined results: null roles and texts are empty; turns are ordered by turn, nulls first, then by
role, by a hash of the text and by their number in the table, and all rows count, repeated ones too; a
null conv_id is a conversation of its own; a turn that is larger than the room of a window stands alone
in it, whole and without history; a first system turn of more than half of the budget is an ordinary turn;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermocline.operators.ordered import with_successor
from thermocline.session import materialize

OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST] ", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
BUDGET, HISTORY, HISTORY_TURNS = 512, 96, 4
#: Turns whose windows are chosen together.
SEGMENT = 1024
#: Pieces that count as one token: up to six letters or three digits, with a space before, or any other character.
TOKEN = r" ?\p{L}{1,6}| ?\p{N}{1,3}|[^\p{L}\p{N}]"
#: Tokens of a turn's marks.
MARKS = 8


def escaped(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROLS:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def token_estimate(text: Column) -> Column:
    return F.regexp_count(text, F.lit(TOKEN))


def formatted_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE), escaped(text), F.lit(CLOSE))


CONV = ["conv", "no_conv"]


def numbered_turns(conversations: DataFrame, tokens: Column | None = None) -> DataFrame:
    """conv, no_conv, row, pos (from 1), is_last, role, text and tokens of every turn."""
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    own = {"conv": F.coalesce(F.col("conv_id").cast("long"), F.lit(0)), "no_conv": F.col("conv_id").isNull(), "row": F.monotonically_increasing_id()}
    turns = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    size = (token_estimate(F.col("text")) if tokens is None else tokens) + MARKS
    turns = materialize(turns.withColumns(own | {"tokens": size.cast("long"), "by_text": F.xxhash64("text")}).drop("conv_id"), "chat-turns")
    narrow = turns.select(*CONV, "turn", "role", "by_text", "row")
    placed = with_successor(narrow, CONV, ["turn", "role", "by_text", "row"], ["row"], names={"row": "next_row"}, position_col="pos")
    placed = placed.select("row", "pos", F.col("next_row").isNull().alias("is_last"))
    return materialize(turns.drop("turn", "by_text").join(placed, "row"), "chat-places")


def _window_starts(sizes: Column, room: Column) -> Column:
    """For each turn of an array of prefix sums, the index at which its window starts: a new one where the turn
    does not fit into ``room`` any more."""
    step = lambda acc, x: F.struct(
        F.concat(acc["starts"], F.array(F.when(x["after"] - acc["base"] > room, x["at"]).otherwise(acc["start"]))).alias("starts"),
        F.when(x["after"] - acc["base"] > room, x["at"]).otherwise(acc["start"]).alias("start"),
        F.when(x["after"] - acc["base"] > room, x["after"] - x["tokens"]).otherwise(acc["base"]).alias("base"),
    )
    first = F.struct(F.array().cast("array<long>").alias("starts"), F.lit(1).cast("long").alias("start"), F.lit(0).cast("long").alias("base"))
    return F.aggregate(sizes, first, step, lambda acc: acc["starts"])


def spans(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT) -> DataFrame:
    """conv, no_conv, row, pos, seg, at (its place there), start (its window's first place), top (the last one), again (whether
    the next window repeats it), oversized and retained of each turn, but for system turns that are retained in the windows."""
    system = (F.col("pos") == 1) & (F.col("role") == "system") & (2 * F.col("tokens") <= budget)
    marked = turns.select(*CONV, "row", "pos", "is_last", "tokens", system.alias("system"))
    first = marked.where("system AND NOT is_last").select(*CONV, F.col("tokens").alias("system_tokens"))
    rest = marked.where("NOT system OR is_last").withColumn("seg", F.floor(F.col("pos") / segment))
    in_order = Window.partitionBy(*CONV, "seg").orderBy("pos")  # at most ``segment`` turns
    rest = rest.withColumns({"at": F.row_number().over(in_order).cast("long"), "after": F.sum("tokens").over(in_order)})
    chosen = rest.groupBy(*CONV, "seg").agg(F.array_sort(F.collect_list(F.struct("at", "after", "tokens", "pos", "row", "is_last"))).alias("turns"))
    chosen = chosen.join(first, CONV, "left").withColumn("room", F.lit(budget - history) - F.coalesce("system_tokens", F.lit(0)))
    chosen = chosen.withColumn("starts", _window_starts(F.col("turns"), F.col("room")))
    each = chosen.select(*CONV, "seg", "room", F.col("system_tokens").isNotNull().alias("retained"), F.explode(F.arrays_zip("turns", "starts")).alias("t"))
    each = each.select(*CONV, "seg", "room", "retained", "t.turns.*", F.col("t.starts").alias("start"))
    back = Window.partitionBy(*CONV, "seg", "start").orderBy(F.col("pos").desc())
    whole = Window.partitionBy(*CONV, "seg", "start")
    each = each.withColumns({"tail": F.sum("tokens").over(back), "nth": F.row_number().over(back), "size": F.sum("tokens").over(whole), "closes": F.max("is_last").over(whole), "top": F.max("at").over(whole)})
    again = (F.col("tail") <= history) & (F.col("nth") <= HISTORY_TURNS) & ~F.col("closes")
    return each.withColumns({"again": again, "oversized": F.col("size") > F.col("room")})


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None, segment: int = SEGMENT) -> DataFrame:
    """conv_id, seg, start, formatted, n_turns, n_repeated (turns at its beginning that an earlier window has), tokens and
    loss (spans) of each window; seg and start order a conversation's windows."""
    turns = numbered_turns(conversations, tokens)
    placed = materialize(spans(turns, budget, history, segment), "chat-spans")
    keys = [*CONV, "seg", "start"]
    windows = placed.groupBy(*keys).agg(F.max("top").alias("top"), F.first("oversized").alias("oversized"), F.first("retained").alias("retained"), F.min("pos").alias("low"))
    windows = materialize(windows, "chat-windows")
    after = F.when(F.col("at_end"), F.col("seg") + 1).otherwise(F.col("seg"))
    # the window after: the next start in the segment, or the next segment's first one
    ends = placed.groupBy(*CONV, "seg").agg(F.max("at").alias("last_at"))
    repeated = placed.where("again").join(ends, [*CONV, "seg"]).withColumn("at_end", F.col("top") == F.col("last_at"))
    repeated = repeated.select(*CONV, "row", "pos", after.alias("seg"), F.when(F.col("at_end"), F.lit(1)).otherwise(F.col("top") + 1).cast("long").alias("start"), F.lit(1).alias("kind"), F.lit(False).alias("fresh"))
    repeated = repeated.join(windows.where("NOT oversized").select(*keys), keys, "left_semi")
    own = placed.select(*CONV, "row", "pos", "seg", "start", F.lit(2).alias("kind"), F.lit(True).alias("fresh"))
    written = turns.select("row", "role", "tokens", formatted_turn(F.col("role"), F.col("text")).alias("turn"), F.length(escaped(F.col("role"))).alias("role_length"))
    parts = own.unionByName(repeated).join(written, "row")
    # the retained system turn of a conversation goes to each of its windows: at most half of the budget each
    system = turns.where("pos = 1 AND role = 'system'").select(*CONV, "row", "pos").join(written, "row")
    heads = windows.where("retained").select(*keys, (F.col("low") == 2).alias("fresh")).join(system, CONV).withColumn("kind", F.lit(0))
    parts = parts.unionByName(heads.select(*parts.columns))
    rows = parts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("kind", "pos", "fresh", "role", "turn", "role_length", "tokens"))).alias("turns"))
    # (length so far, spans so far): a window holds a bounded number of turns
    learned = lambda x: (x["kind"] == 2) & (x["role"] == "assistant")
    head = lambda x: x["role_length"] + len(OPEN) + len(MIDDLE)
    span = lambda acc, x: F.struct((acc["length"] + head(x)).alias("start"), (F.length(x["turn"]) - head(x) - len(CLOSE)).alias("length"))
    add = lambda acc, x: F.struct(
        (acc["length"] + F.length(x["turn"])).alias("length"), F.when(learned(x), F.concat(acc["loss"], F.array(span(acc, x)))).otherwise(acc["loss"]).alias("loss")
    )
    none = F.struct(F.lit(0).alias("length"), F.array().cast("array<struct<start:int,length:int>>").alias("loss"))
    return rows.select(
        F.when(~F.col("no_conv"), F.col("conv")).alias("conv_id"), "seg", "start",
        F.array_join(F.transform("turns", lambda x: x["turn"]), "").alias("formatted"),
        F.size("turns").alias("n_turns"), F.size(F.filter("turns", lambda x: ~x["fresh"])).alias("n_repeated"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("tokens"),
        F.aggregate("turns", none, add, lambda acc: acc["loss"]).alias("loss"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """conv_id, seg, start, n_new, turns_text (role, newline, text, newline for each turn that no earlier window has),
    loss_text (what lies under the loss mask) and chars of each window, read from its text and spans."""
    # behind the last mark stands the empty string
    parts = F.slice(F.split("formatted", CLOSE), F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))
    whole = lambda p: F.substr(p, F.lit(len(OPEN) + 1))
    role = lambda p: F.substring_index(whole(p), MIDDLE, 1)
    text = lambda p: F.substr(whole(p), F.length(role(p)) + len(MIDDLE) + 1)
    said = lambda p: F.concat(unescaped(role(p)), F.lit("\n"), unescaped(text(p)), F.lit("\n"))
    learned = lambda x: unescaped(F.substr(F.col("formatted"), x["start"] + 1, x["length"]))
    return windows.select(
        "conv_id", "seg", "start",
        (F.col("n_turns") - F.col("n_repeated")).alias("n_new"),
        F.array_join(F.transform(parts, said), "").alias("turns_text"),
        F.array_join(F.transform("loss", learned), "").alias("loss_text"),
        F.length("formatted").alias("chars"),
    )


def conversation_digests(windows: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from the windows. A digest
    of a whole conversation needs its text in one row, for this report only."""
    read = read_back(windows)
    in_order = F.array_sort(F.collect_list(F.struct("seg", "start", "turns_text", "loss_text")))
    joined = lambda c: F.sha2(F.array_join(F.transform("windows", lambda x: x[c]), ""), 256)
    whole = read.groupBy("conv_id").agg(
        F.sum("n_new").alias("n_turns"), F.sum(F.length("loss_text")).alias("loss_chars"), F.sum("chars").alias("formatted_chars"), in_order.alias("windows")
    )
    return whole.select(
        "conv_id", F.col("n_turns").cast("long").alias("n_turns"), joined("turns_text").alias("turns_sha256"),
        F.col("loss_chars").cast("long").alias("loss_chars"), joined("loss_text").alias("loss_sha256"), F.col("formatted_chars").cast("long").alias("formatted_chars"),
    )


def with_control_strings(conversations: DataFrame) -> DataFrame:
    """The query's table: ``conversations`` and conversation -7, whose two turns hold the template's own marks."""
    text = F.lit("</s>[INST] ok [/INST]").alias("text")
    role = F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role")
    more = conversations.sparkSession.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role, text)
    return conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(more)
