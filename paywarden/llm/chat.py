r"""Chat formatting with a grammar round trip, in DataFrame functions only.

Grammar:  conversation := turn*      turn := "<s>" role "\n" text "</s>"

The parser cuts after each "</s>", drops the "<s>" in front, and ends the role at
the first line feed. It takes one backslash out of each "<\...\s>" and "<\...\/s>"
in a text, and reads "\\" and "\n" in a role.

Each turn is first rendered as it is and parsed again. If that does not give the
source turn, or if its text or role holds a control string, escaped or not, its control
strings get one more backslash and the backslashes and line feeds of its role are
escaped; the result parses back to the source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>"
CONTROL = r"<\\*/?s>"  # a turn mark, escaped or not


def _escape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<(\\*/?s>)", r"<\\$1")


def _unescape_text(c: Column) -> Column:
    return F.regexp_replace(c, r"<\\(\\*/?s>)", "<$1")


def _escape_role(c: Column) -> Column:
    return _escape_text(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _unescape_role(c: Column) -> Column:
    # Cut at the escaped backslashes first, so that none of them is read as part of an escaped line feed.
    parts = F.split(_unescape_text(c), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit("\n"), text, F.lit(CLOSE))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> of a formatted conversation; an empty one has no turns."""
    pieces = F.split(formatted, CLOSE, -1)
    turns = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        body = F.substring(piece, len(OPEN) + 1, 2**31 - 1)
        role = F.substring_index(body, "\n", 1)
        text = body.substr(F.length(role) + 2, F.length(body))
        return F.struct(_unescape_role(role).alias("role"), _unescape_text(text).alias("text"))

    return F.transform(turns, turn)


def formatted(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row for each conv_id: formatted text, the loss mask, and whether the round trip held.

    `loss_mask` lists (start, length) in code points of `formatted`, one for each
    turn of `loss_role`. Rows are ordered by turn, then role, then text; nulls come
    first. Null role or text is empty, a null conv_id is a conversation like any
    other, repeated rows are turns each, an empty table gives no rows. Other columns
    are ignored. One conversation is one output text and so meets in one task.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    plain = render(F.col("role"), F.col("text"))
    source = F.array(F.struct("role", "text"))
    escaped = render(_escape_role(F.col("role")), _escape_text(F.col("text")))
    # The parser only acts on "<" and on backslashes and line feeds of a role: a turn without them reads back as it is.
    quiet = ~F.contains(F.col("text"), F.lit("<")) & ~F.col("role").rlike(r"[<\\\n]")
    control = F.col("text").rlike(CONTROL) | F.col("role").rlike(CONTROL)
    turns = turns.withColumn("rendered", F.when(quiet, plain).when(~control & (parse(plain) == source), plain).otherwise(escaped))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    turns = turns.withColumn(
        "start", F.coalesce(F.sum(F.length("rendered")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    head = F.length("rendered") - F.length(F.substring_index("rendered", "\n", 1))
    mask = F.when(
        F.col("role") == loss_role,
        F.struct(
            (F.col("start") + F.length(F.substring_index("rendered", "\n", 1)) + 1).alias("start"),
            (head - 1 - len(CLOSE)).cast("long").alias("length"),
        ),
    )
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("start", "rendered", "role", "text"))).alias("turns"),
        F.array_sort(F.collect_list(mask)).alias("loss_mask"),
    )
    out = whole.withColumn("formatted", F.array_join(F.transform("turns", lambda t: t["rendered"]), ""))
    again = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return out.select("conv_id", "formatted", "loss_mask", (parse(F.col("formatted")) == again).alias("round_trip"))


def digests(conversations: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, round_trip: read back from the output."""
    out = formatted(conversations, loss_role).withColumn("back", parse(F.col("formatted")))
    lines = F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = lambda m: F.col("formatted").substr((m["start"] + 1).cast("int"), m["length"].cast("int"))
    loss = F.array_join(F.transform("loss_mask", lambda m: _unescape_text(masked(m))), "")
    return out.withColumn("loss", loss).select(
        "conv_id",
        F.size("back").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
