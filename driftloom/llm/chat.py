"""Chat formatting from event logs: events become messages, messages become one rendered text per conversation.

Events (conv_id, turn, seq, kind, role, text) are folded in the order of seq:

* `message` opens a message in its turn; a turn may hold several,
* `delta` appends its text to the last message of its turn,
* `edit` replaces the text of that message,
* `regenerate` clears its turn and drops every later turn that was opened before it.

Deltas and edits before any message of their turn are ignored. Events with equal seq are taken in the order of kind rank
(message, delta, edit, regenerate), role, text. Null text and null role are empty; events with a null conv_id form one
conversation of their own; a null turn comes first, a null seq before all others, an unknown kind is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, END = "<|turn|>", "<|end|>"
# Control strings that no text may bring into the output: those of this template and of common other ones.
# A control string is one of the first characters and one of the rests, which hold no first character: matches never overlap.
CONTROL = r"(<|\[)(\\*)(\|[a-z_]+\|>|/?s>|/?INST\]|/?SYS>>)"
ESCAPED = r"(<|\[)\\(\\*)(\|[a-z_]+\|>|/?s>|/?INST\]|/?SYS>>)"
KINDS = ("message", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    """One backslash goes between the first character of a control string and the rest; existing ones are kept."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def _role_out(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%")))


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turns): the final messages of each conversation in order, as structs of role and text.

    First each turn is folded on its own, so that long logs are spread over tasks by (conversation, turn): its events are
    numbered in order, the last regeneration and the last edit of a message say from where on its parts count, and these are
    joined once. Then the final messages of a conversation meet. The work grows with the events, also within one message.
    Repeated events count each; an empty table gives none.
    """
    rank = F.coalesce(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.lit(0))
    rows = events.select(
        "conv_id",
        "turn",
        F.col("seq").cast("bigint").alias("seq"),
        rank.alias("rank"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turn = Window.partitionBy("conv_id", "turn")
    in_order = turn.orderBy("seq", "rank", "role", "text")

    def last(kind: int, value: str) -> Column:
        return F.max(F.when(F.col("rank") == kind, F.col(value)))

    rows = rows.withColumn("nth", F.row_number().over(in_order)).select(
        "*",
        # running number of the message that an event belongs to; 0 before the first
        F.count(F.when(F.col("rank") == 1, 1)).over(in_order.rowsBetween(Window.unboundedPreceding, 0)).alias("message"),
        last(1, "seq").over(turn).alias("opened"),
        last(4, "seq").over(turn).alias("cut"),
        last(4, "nth").over(turn).alias("cleared"),
    )
    # messages that were opened before the last regeneration are gone, and so is what came after it without a new one
    gone = (F.col("message") == 0) | F.coalesce(F.col("nth") <= F.col("cleared"), F.lit(False))
    part = F.when(~gone & F.col("rank").between(1, 3), F.struct("nth", "text"))
    messages = rows.groupBy("conv_id", "turn", "message").agg(
        F.max("opened").alias("opened"),
        F.max("cut").alias("cut"),
        F.max(F.when(~gone & (F.col("rank") == 1), F.col("role"))).alias("role"),
        F.coalesce(F.max(F.when(~gone & (F.col("rank") == 3), F.col("nth"))), F.lit(0)).alias("edited"),
        F.sort_array(F.collect_list(part)).alias("parts"),
    )
    text = F.array_join(F.transform(F.filter("parts", lambda p: p["nth"] >= F.col("edited")), lambda p: p["text"]), "")
    # the latest cut of all turns so far decides whether a turn still stands; a message outlives the cut of its own turn
    so_far = F.max("cut").over(Window.partitionBy("conv_id").orderBy("turn"))
    stands = F.col("role").isNotNull() & (so_far.isNull() | (F.col("opened") > so_far))
    final = messages.select("conv_id", "turn", "message", "role", text.alias("text"), stands.alias("stands"))
    kept = F.sort_array(F.collect_list(F.when(F.col("stands"), F.struct("turn", "message", "role", "text"))))
    said = F.transform(kept, lambda m: F.struct(m["role"].alias("role"), m["text"].alias("text")))
    return final.groupBy("conv_id").agg(said.alias("turns"))


def render(conversations: DataFrame, learn: str = "assistant") -> DataFrame:
    """(conv_id, formatted, spans) of folded conversations.

    formatted: `<|turn|>role` newline, escaped text, `<|end|>` newline for each message. spans has a struct per message:
    chars (code points of the whole rendered message), loss_from and loss_chars (the code points of it that count for
    the loss, relative to its start; 0 characters unless the role is `learn`). A conversation without messages gives the empty
    text; repeated rows are rendered each, an empty table gives none.
    """
    parts = F.transform(
        "turns",
        lambda m: F.struct(
            F.concat(F.lit(TURN), _role_out(m["role"]), F.lit("\n")).alias("head"),
            escape(m["text"]).alias("body"),
            (m["role"] == learn).alias("learn"),
        ),
    )
    rows = conversations.select("conv_id", parts.alias("parts"))
    tail = END + "\n"
    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(tail))), "")
    span = F.transform(
        "parts",
        lambda p: F.struct(
            (F.char_length(p["head"]) + F.char_length(p["body"]) + len(tail)).alias("chars"),
            F.char_length(p["head"]).alias("loss_from"),
            F.when(p["learn"], F.char_length(p["body"])).otherwise(0).alias("loss_chars"),
        ),
    )
    return rows.select("conv_id", text.alias("formatted"), span.alias("spans"))


def parse(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted, turns, losses) read back from `formatted` and `spans`.

    turns: structs of role and text; losses: the unescaped text under each loss span, of messages that have one. Both are
    empty for the empty text; repeated rows are read each, an empty table gives none.
    """
    # a rendered message begins at every <|turn|>, since texts and roles hold none
    pieces = F.slice(F.split("formatted", r"<\|turn\|>"), F.lit(2), F.lit(2**31 - 1))
    rows = rendered.select("conv_id", "formatted", "spans", pieces.alias("pieces"))
    tail = len(END) + 1

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, "\n", 1)
        body = piece.substr(F.char_length(role) + 2, F.char_length(piece) - F.char_length(role) - 1 - tail)
        return F.struct(_role_in(role).alias("role"), unescape(body).alias("text"))

    masked = F.filter(F.arrays_zip("pieces", "spans"), lambda z: z["spans"]["loss_chars"] > 0)
    losses = F.transform(
        masked,
        lambda z: unescape(z["pieces"].substr(z["spans"]["loss_from"] + 1 - len(TURN), z["spans"]["loss_chars"])),
    )
    return rows.select("conv_id", "formatted", F.transform("pieces", turn).alias("turns"), losses.alias("losses"))
