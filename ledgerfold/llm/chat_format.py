"""Chat formatting in budgeted windows of whole turns.

Prefix sums of the turns' tokens choose the windows: a window holds the turns that start in
one stretch of the conversation's tokens, so no turn is cut and every window is found without
looking at the one before. It repeats the system turn and a limited history, and its
loss mask covers the assistant turns that are new in it, so each is a target once.

    room    = budget - history_tokens - tokens of the system turn, a quarter of the budget at least
    stretch = room / 2; a turn longer than a stretch gets a window of its own

Turns of a stretch that fit in it end before the next one does, so a window without an overlong turn stays
within the budget. Tokens are estimated: 4 for the markers and 1 for every 4 characters.

A conversation of any length is dealt out in chunks of CHUNK turn numbers, and sums start anew at each:
a chunk is sorted by one task, spilling to disk, and no more than a window is gathered in a value. The chunks
behind the first get copies of the system turn and of the last turns of the chunk before.

Format: `<|im_start|>role\\ntext<|im_end|>\\n` for each turn. Inside texts a
backslash goes between `<` and `|` (one more if there are some), so no text holds a marker and removing one
backslash restores it; in roles `%`, `<` before `|` and line ends become `%25`, `%3C` and `%0A`.

Defined results: the rows of a conversation run by turn (null first), then role, then text; a null text or role is
an empty one; a null conv_id is a conversation; repeated rows are turns of their own; the system turn is the first row if
its role is `system`, later ones are ordinary turns; no rows give no windows; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerfold.llm.common import or_empty

BUDGET = 2048
HISTORY_TOKENS = 256
HISTORY_TURNS = 4
CHUNK = 256
START, END = "<|im_start|>", "<|im_end|>\n"


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    no_percent = F.replace(role, F.lit("%"), F.lit("%25"))
    return F.replace(F.replace(no_percent, F.lit("\n"), F.lit("%0A")), F.lit("<|"), F.lit("%3C|"))


def unescape_role(role: Column) -> Column:
    lines = F.replace(F.replace(role, F.lit("%3C|"), F.lit("<|")), F.lit("%0A"), F.lit("\n"))
    return F.replace(lines, F.lit("%25"), F.lit("%"))


def _head(role: Column) -> Column:
    return F.concat(F.lit(START), escape_role(role), F.lit("\n"))


def _segment(turn: Column) -> Column:
    return F.concat(_head(turn["role"]), escape_text(turn["text"]), F.lit(END))


def _joined(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _segment), "")


def _with_copies(turns: DataFrame) -> DataFrame:
    """Turns by chunk, with the copies that the chunks behind the first need: 0 system, 1 history, 2 the turns."""
    in_chunks = turns.withColumn("kind", F.lit(2))
    tails = turns.where(F.pmod("turn", F.lit(CHUNK)) >= CHUNK - HISTORY_TURNS).select(
        "conv_id", "turn", "role", "text", (F.col("chunk") + 1).alias("chunk"), F.lit(1).alias("kind")
    )
    firsts = turns.groupBy("conv_id").agg(
        F.min(F.struct("turn", "role")).alias("first"), F.min("chunk").alias("first_chunk")
    )
    chunks = turns.select(F.col("conv_id").alias("chunk_conv"), F.col("chunk").alias("to_chunk")).distinct()
    behind = firsts.join(
        chunks, F.col("conv_id").eqNullSafe(F.col("chunk_conv")) & (F.col("to_chunk") > F.col("first_chunk"))
    ).select("conv_id", "first", F.col("to_chunk").alias("chunk"))
    texts = turns.where("role = 'system'").groupBy("conv_id", "turn").agg(F.min("text").alias("text"))
    texts = texts.select(F.col("conv_id").alias("sys_conv"), F.col("turn").alias("sys_turn"), "text")
    # Every chunk behind the first gets a copy; its text is null where there is no system turn.
    system = behind.join(
        texts,
        F.col("conv_id").eqNullSafe(F.col("sys_conv"))
        & F.col("sys_turn").eqNullSafe(F.col("first.turn"))
        & (F.col("first.role") == "system"),
        "left",
    ).select(
        "conv_id",
        F.col("first.turn").alias("turn"),
        F.lit("system").alias("role"),
        "text",
        "chunk",
        F.lit(0).alias("kind"),
    )
    return in_chunks.unionByName(tails).unionByName(system)


def chat_windows(
    conversations: DataFrame, budget: int = BUDGET, history_tokens: int = HISTORY_TOKENS
) -> DataFrame:
    """A row for each window, in order of (chunk, window) within conv_id.

    formatted: its text; fresh_start: where in it the new turns begin (code points, from 0); n_turns: how many
    are new; loss_spans: (start, end) of the targets, end exclusive; tokens: of all its turns.
    """
    turns = conversations.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        or_empty(F.col("role")).alias("role"),
        or_empty(F.col("text")).alias("text"),
    ).withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 60))))
    everything = _with_copies(turns).withColumn("tokens", 4 + F.ceil(F.length("text") / 4))

    order = Window.partitionBy("conv_id", "chunk").orderBy(
        F.col("kind") > 0, F.col("turn").asc_nulls_first(), "role", "text", "kind"
    )
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    # At a conversation's start the system turn is the first row; in other chunks it is the copy.
    placed = (
        everything.withColumn("at", F.row_number().over(order))
        .withColumn(
            "is_system",
            (F.col("kind") == 0) | (F.col("kind") == 2) & (F.col("at") == 1) & (F.col("role") == "system"),
        )
        .withColumn("as_turn", F.struct("role", "text", "tokens"))
        .withColumn(
            "sys", F.max(F.when(F.col("is_system") & F.col("text").isNotNull(), F.col("as_turn"))).over(whole)
        )
        .withColumn(
            "start",
            F.coalesce(F.sum(F.when(F.col("kind") == 2, F.col("tokens")).otherwise(0)).over(before), F.lit(0)),
        )
        .withColumn(
            "recent",
            F.collect_list(F.when(~F.col("is_system"), F.col("as_turn"))).over(order.rowsBetween(-HISTORY_TURNS, -1)),
        )
    )
    room = F.greatest(
        F.lit(budget - history_tokens) - F.coalesce(F.col("sys.tokens"), F.lit(0)), F.lit(budget // 4)
    )
    stretch = F.floor(room / 2)
    windows = (
        placed.where("kind = 2")
        .withColumn("window", 2 * F.floor(F.col("start") / stretch) + F.when(F.col("tokens") > stretch, 1).otherwise(0))
        .groupBy("conv_id", "chunk", "window")
        .agg(
            F.array_sort(F.collect_list(F.struct("at", "role", "text", "tokens", "is_system"))).alias("turns"),
            F.min_by("recent", "at").alias("recent"),
            F.first("sys").alias("sys"),
        )
    )
    turn_type = "array<struct<role:string,text:string,tokens:bigint>>"
    history = F.expr(
        "filter(recent, (t, i) -> aggregate(slice(recent, i + 1, size(recent)), 0L, (a, u) -> a + u.tokens)"
        f" <= {history_tokens})"
    )
    holds_system = F.exists("turns", lambda t: t["is_system"])
    carried = F.concat(
        F.when(F.col("sys").isNull() | holds_system, F.array()).otherwise(F.array("sys")).cast(turn_type), F.col("history")
    )
    starts = F.expr(
        "transform(turns, (t, i) -> fresh_start + coalesce(aggregate(slice(lengths, 1, i), 0L, (a, n) -> a + n), 0L))"
    )
    return (
        windows.withColumn("history", history.cast(turn_type))
        .withColumn("carried", carried)
        .withColumn("carried_text", _joined(F.col("carried")))
        .withColumn("fresh_start", F.length("carried_text").cast("long"))
        .withColumn("lengths", F.transform("turns", lambda t: F.length(_segment(t)).cast("long")))
        .withColumn("starts", starts)
        .withColumn(
            "spans",
            F.transform(
                "turns",
                lambda t, i: F.when(
                    t["role"] == "assistant",
                    F.struct(
                        (F.get("starts", i) + F.length(_head(t["role"]))).alias("start"),
                        (F.get("starts", i) + F.get("lengths", i) - len(END)).alias("end"),
                    ),
                ),
            ),
        )
        .select(
            "conv_id",
            "chunk",
            "window",
            F.size("turns").cast("long").alias("n_turns"),
            "fresh_start",
            F.concat("carried_text", _joined(F.col("turns"))).alias("formatted"),
            F.array_compact("spans").alias("loss_spans"),
            F.expr("aggregate(turns, 0L, (a, t) -> a + t.tokens) + aggregate(carried, 0L, (a, t) -> a + t.tokens)").alias("tokens"),
        )
    )


def read_back(windows: DataFrame) -> DataFrame:
    """The new turns and the targets of each window, from its text and mask alone.

    turns: array of (role, text); targets: the texts under the mask.
    """
    fresh = F.expr("substring(formatted, cast(fresh_start AS int) + 1)")
    pieces = F.filter(F.split(fresh, r"<\|im_end\|>\n"), lambda p: p != "")
    bodies = F.transform(pieces, lambda p: F.substr(p, F.lit(len(START) + 1)))
    turns = F.transform(
        bodies,
        lambda b: F.struct(
            unescape_role(F.substring_index(b, "\n", 1)).alias("role"),
            unescape_text(F.substr(b, F.instr(b, "\n") + 1)).alias("text"),
        ),
    )
    targets = F.transform(
        "loss_spans",
        lambda s: unescape_text(
            F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))
        ),
    )
    return windows.withColumn("turns", turns).withColumn("targets", targets)


def conversation_digests(windows: DataFrame) -> DataFrame:
    """Per conversation: counts and digests of what reading back gives.

    A digest needs the whole conversation in one value; the windows themselves never do.
    """
    told = read_back(windows).select(
        "conv_id",
        F.size("turns").cast("long").alias("n"),
        F.length("formatted").cast("long").alias("chars"),
        F.struct(
            "chunk",
            "window",
            F.array_join(
                F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
            ).alias("said"),
            F.array_join("targets", "").alias("learnt"),
        ).alias("part"),
    )
    whole = told.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
        F.array_sort(F.collect_list("part")).alias("parts"),
    )
    said = F.array_join(F.transform("parts", lambda p: p["said"]), "")
    learnt = F.array_join(F.transform("parts", lambda p: p["learnt"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt, 256).alias("loss_sha256"),
        "formatted_chars",
    )
