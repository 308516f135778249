"""Chat formatting in budgeted windows, in DataFrame functions throughout.

A conversation's turns are written in a template; prefix sums of their tokens choose the spans of whole turns that fit a
budget. Every window opens with the system turn and, from the second on, with the last turns of the window before as
history; both are out of the loss mask there, so each target counts once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerforge.operators.tables import lookup_join
from offerforge.session import written

BUDGET = 1024
HISTORY_TURNS = 2
HISTORY_TOKENS = 256
TARGET_ROLE = "assistant"
SYSTEM_ROLE = "system"
#: A window never spans two blocks of so many turns, so a conversation of any length stays in rows of bounded size.
BLOCK_TURNS = 256
#: What an element of a block is: the system turn or a turn of the block before, repeated there, or a turn of its own.
SYSTEM, TAIL, OWN = 0, 1, 2

OPEN, HEAD_END, CLOSE = "<turn ", ">\n", "\n</turn>\n"


def escaped(text: Column) -> Column:
    """No control string is left: ``&`` and the ``<`` of ``<turn`` and ``</turn`` become references."""
    return F.regexp_replace(F.replace(text, F.lit("&"), F.lit("&amp;")), "<(?=/?turn)", "&lt;")


def unescaped(text: Column) -> Column:
    for reference, sign in (("&gt;", ">"), ("&lt;", "<"), ("&amp;", "&")):
        text = F.replace(text, F.lit(reference), F.lit(sign))
    return text


def word_pieces(text: Column) -> Column:
    """Tokens by rule: up to four letters, one digit, one other sign."""
    return F.regexp_count(text, F.lit(r"\p{L}{1,4}|\p{N}|[^\p{L}\p{N}\s]"))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, although lambda bodies use it at every step."""
    return F.transform(F.array(value), body)[0]


def format_windows(conversations: DataFrame, budget: int = BUDGET, history_turns: int = HISTORY_TURNS,
                   history_tokens: int = HISTORY_TOKENS, tokens=word_pieces, conversation: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text") -> DataFrame:
    """One row for each window: conv_id, block, window, text, repeated, turns, tokens, over_budget, loss_spans.

    ``repeated`` of the ``turns`` at the start of ``text`` (the system turn and the history) have been there before.
    ``loss_spans`` are (start, length) in code points of ``text``: the escaped texts of new assistant turns. A window takes
    turns as long as system turn, history and turns fit ``budget``. The history is the longest run of at most
    ``history_turns`` turns before the window within ``history_tokens`` with which its first turn still fits. A turn too
    long for that stands alone with the system turn, and ``over_budget`` says so if even they do not fit: nothing is cut.
    The system turn is the conversation's first if its role is ``system``.

    Turns count by their rank, whatever their numbers. A conversation of more than ``BLOCK_TURNS`` turns is cut into blocks;
    a block knows the system turn and the last turns of the one before, so that its first window has history too. Null roles
    and texts count as empty. A null conversation is one of its own, null turn numbers come first. Rows with one turn number
    stand in the order of role and text; repeated rows are turns of their own. Empty texts are turns. Other columns are left
    behind. No rows give no rows.
    """
    if not 0 <= history_turns < BLOCK_TURNS:
        raise ValueError(f"history_turns must be from 0 to {BLOCK_TURNS - 1}")
    turns = conversations.select(
        F.col(conversation).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(OPEN), F.replace(escaped(F.col("role")), F.lit(">"), F.lit("&gt;")), F.lit(HEAD_END))
    turns = turns.withColumns({"head": head, "body": escaped(F.col("text"))})
    turns = turns.withColumn("n", tokens(F.concat("head", "body", F.lit(CLOSE))).cast("long"))
    held = _blocks(turns, history_turns)
    own = F.filter("all", lambda t: t["kind"] > SYSTEM)
    leads = (F.col("block") == 0) & (F.col("all")[0]["role"] == SYSTEM_ROLE) | (F.col("all")[0]["kind"] == SYSTEM)
    held = held.withColumns({
        "system": F.when(leads, F.col("all")[0]),
        "all": F.when(leads & (F.col("block") == 0), F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0)))).otherwise(own)})
    held = held.withColumns({
        "tail": F.size(F.filter("all", lambda t: t["kind"] == TAIL)),
        "sums": F.aggregate("all", F.array(F.lit(0).cast("long")), lambda a, t: F.concat(a, F.array(F.element_at(a, -1) + t["n"]))),
        "extra": F.coalesce(F.col("system.n"), F.lit(0).cast("long")),
    })
    spans = _let(F.col("sums"), lambda sums: F.aggregate(
        F.sequence(F.col("tail") + 1, F.size("all")),
        F.array().cast("array<struct<start:int,stop:int,history:int>>"),
        lambda done, k: _let(F.try_element_at(done, F.lit(-1)), lambda last: F.when(
            F.size(done).__gt__(0) & (sums[k] - sums[last["start"] - 1 - last["history"]] + F.col("extra") <= budget),
            F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(
                last["start"].alias("start"), k.alias("stop"), last["history"].alias("history")))),
        ).otherwise(F.concat(done, F.array(F.struct(
            k.alias("start"), k.alias("stop"), F.size(F.filter(
                F.sequence(F.lit(1), F.lit(history_turns)),
                lambda h: (h < k) & (sums[k - 1] - sums[k - 1 - h] <= history_tokens)
                & (sums[k] - sums[k - 1 - h] + F.col("extra") <= budget))).alias("history")))))),
    ))
    spans = F.when(F.size("all") > 0, spans).otherwise(
        F.array(F.struct(F.lit(1).alias("start"), F.lit(0).alias("stop"), F.lit(0).alias("history"))))
    windows = held.select("*", F.posexplode(spans).alias("window", "span"))
    systems = F.when(F.col("system").isNotNull(), F.array("system")).otherwise(F.array().cast(held.schema["all"].dataType))
    windows = windows.select(
        "conv_id", "block", "window", "extra", "sums", "span",
        F.concat(systems, F.slice("all", F.col("span.start") - F.col("span.history"),
                                  F.col("span.stop") - F.col("span.start") + 1 + F.col("span.history"))).alias("part"),
        (F.col("span.history") + F.when(
            F.col("system").isNotNull() & ((F.col("window") > 0) | (F.col("block") > 0)), 1).otherwise(0)).alias("repeated"))
    written = lambda t: F.concat(t["head"], t["body"], F.lit(CLOSE))
    places = F.aggregate("part", F.array(F.lit(0)), lambda a, t: F.concat(a, F.array(
        F.element_at(a, -1) + F.length(t["head"]) + F.length(t["body"]) + len(CLOSE))))
    loss = _let(places, lambda at: F.filter(F.transform("part", lambda t, k: F.when(
        (k >= F.col("repeated")) & (t["role"] == TARGET_ROLE),
        F.struct((at[k] + F.length(t["head"])).alias("start"), F.length(t["body"]).alias("length")))), lambda s: s.isNotNull()))
    used = F.col("sums")[F.col("span.stop")] - F.col("sums")[F.col("span.start") - 1 - F.col("span.history")] + F.col("extra")
    return windows.select(
        "conv_id", "block", F.col("window").cast("long").alias("window"),
        F.array_join(F.transform("part", written), "").alias("text"), "repeated", F.size("part").alias("turns"),
        used.alias("tokens"), (used > budget).alias("over_budget"), loss.alias("loss_spans"))


def _blocks(turns: DataFrame, history_turns: int) -> DataFrame:
    """conv_id, block, all: the turns of a block in order, each with its ``kind``.

    Most conversations fit one block and are gathered as they are. Those that do not are ranked first: inside ranges of turn
    numbers, whose sizes give the ranks before them, so that no conversation is ordered as a whole.
    """
    what = ("turn", "role", "text", "head", "body", "n")
    # told apart by hash: a short conversation taken for a long one is handled alike
    turns = turns.withColumns({"conv": F.xxhash64("conv_id"), "range": F.floor(F.col("turn") / BLOCK_TURNS)})
    ranges = written(turns.groupBy("conv_id", "conv", "range").agg(F.count("*").alias("rows")))
    long = ranges.groupBy("conv").agg(F.sum("rows").alias("rows")).where(F.col("rows") > BLOCK_TURNS)
    long = written(long.select("conv", F.lit(True).alias("long")))
    turns = lookup_join(turns, long, ["conv"])
    rows = turns.where("long IS NULL").select(
        "conv_id", F.lit(0).cast("long").alias("block"), F.lit(OWN).alias("kind"), F.lit(0).cast("long").alias("rank"), *what)
    if not long.isEmpty():
        before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        starts = lookup_join(ranges, long, ["conv"]).where("long").select(
            "conv_id", "range", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
        inside = Window.partitionBy("conv_id", "range").orderBy("turn", "role", "text")
        ranked = turns.where("long").withColumn("place", F.row_number().over(inside) - 1).alias("t").join(
            starts.alias("s"), F.expr("t.conv_id <=> s.conv_id AND t.range <=> s.range"))
        ranked = written(ranked.select("t.conv_id", *what, (F.col("place") + F.col("start")).alias("rank")))
        block = F.floor(F.col("rank") / BLOCK_TURNS)
        mine = ranked.select("conv_id", block.alias("block"), F.lit(OWN).alias("kind"), "rank", *what)
        lasts = F.col("rank") % BLOCK_TURNS >= BLOCK_TURNS - history_turns
        tails = ranked.where(lasts).select("conv_id", (block + 1).alias("block"), F.lit(TAIL).alias("kind"), "rank", *what)
        sizes = ranked.groupBy("conv_id").agg(F.max(block).alias("blocks"))
        systems = ranked.where((F.col("rank") == 0) & (F.col("role") == SYSTEM_ROLE)).alias("s").join(
            sizes.alias("z"), F.expr("s.conv_id <=> z.conv_id")).where("blocks > 0").select(
            "s.conv_id", F.explode(F.sequence(F.lit(1).cast("long"), "blocks")).alias("block"), F.lit(SYSTEM).alias("kind"), "rank", *what)
        for part in (mine, tails, systems):
            rows = rows.unionByName(part)
    held = rows.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("kind", "rank", *what))).alias("all"))
    return held.where(F.element_at("all", -1)["kind"] == OWN)  # the last block hands its turns to none


def read_turns(text: Column, repeated: Column) -> Column:
    """Array of (role, text) of a window's new turns, read back from its text."""
    parts = F.split(text, CLOSE)
    parts = _let(parts, lambda p: F.slice(p, repeated + 1, F.greatest(F.size(p) - 1 - repeated, F.lit(0))))
    return F.transform(parts, lambda p: _let(F.instr(p, HEAD_END), lambda at: F.struct(
        unescaped(F.substring(p, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)).alias("role"),
        unescaped(F.substring(p, at + len(HEAD_END), F.length(p))).alias("text"))))


def loss_text(text: Column, spans: Column) -> Column:
    """All text under the mask of one window, in order, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))), "")
