"""Chat formatting: a finite-state machine over roles and a declarative template.

A template gives each role what stands before and after its text and whether its text counts for the loss. All its control
strings start with ``[`` or ``<``. Texts are escaped so that they hold neither character: ``\\`` becomes ``\\0``, ``[``
``\\1`` and ``<`` ``\\2``; no control string can then start inside a text, and decoding is exact.

The machine starts in ``start``; each role moves it along ``MOVES``; a role without a move from the present state leads to
``error``, which no role leaves. A conversation is valid if it ends in a state of ``ENDS``.

Nulls: a null text is an empty text, a null role the role with the empty name; unknown roles are formatted with their name and
never count for the loss. Rows of a conversation with the same turn are ordered by role, then text; repeated rows are turns of
their own. The null conversation id is a conversation. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# role: text before, text after, loss on the text
TEMPLATE = {
    "system": ("<<SYS>>\n", "\n<</SYS>>\n", False),
    "user": ("[INST] ", " [/INST]", False),
    "assistant": ("<s>", "</s>", True),
}
# any other role; its escaped name stands between the first two strings
OTHER = ("[ROLE]", "[/ROLE]", "[/TURN]")
MOVES = {
    ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
    ("user", "assistant"): "assistant", ("assistant", "user"): "user",
}
ENDS = ("assistant",)
ESCAPES = (("\\", "\\0"), ("[", "\\1"), ("<", "\\2"))


def escape(text: Column) -> Column:
    for raw, coded in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for raw, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(raw))
    return text


def _quote(literal: str) -> str:
    return "\\Q" + literal + "\\E"


def segments(role: Column, text: Column, template: dict[str, tuple[str, str, bool]] = TEMPLATE) -> Column:
    """Segments of one turn, each ``(text, loss)``: what stands before, the escaped text, what stands after."""
    piece = lambda s, loss: F.struct(s.alias("text"), F.lit(loss).alias("loss"))
    body = escape(text)
    result = F.array(
        piece(F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1])), False), piece(body, False), piece(F.lit(OTHER[2]), False)
    )
    for name, (before, after, loss) in template.items():
        result = F.when(role == name, F.array(piece(F.lit(before), False), piece(body, loss), piece(F.lit(after), False))).otherwise(result)
    return result


def final_state(roles: Column, moves: dict[tuple[str, str], str] = MOVES) -> Column:
    """The state in which the machine ends after a list of roles."""
    table = F.create_map(*[F.lit(x) for (state, role), to in moves.items() for x in (f"{state}>{role}", to)])
    return F.aggregate(roles, F.lit("start"), lambda s, r: F.coalesce(F.try_element_at(table, F.concat(s, F.lit(">"), r)), F.lit("error")))


def format_chats(turns: DataFrame, template: dict[str, tuple[str, str, bool]] = TEMPLATE, moves: dict[tuple[str, str], str] = MOVES) -> DataFrame:
    """Rows by turn (``conv_id, turn, role, text``) to one row per conversation.

    ``conv_id, n_turns, state`` (the machine's last), ``valid, segments`` (text and loss flag) and ``formatted``
    (the segments' texts joined). The turns of one conversation meet in one row, as its single formatted string must.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (
        turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select(
            "conv_id", F.size("turns").cast("long").alias("n_turns"), final_state(F.col("turns.role"), moves).alias("state"),
            F.flatten(F.transform("turns", lambda t: segments(t["role"], t["text"], template))).alias("segments"),
        )
        .withColumn("valid", F.col("state").isin(*ENDS))
        .withColumn("formatted", F.array_join(F.col("segments.text"), ""))
    )


def parse_chats(chats: DataFrame, template: dict[str, tuple[str, str, bool]] = TEMPLATE) -> DataFrame:
    """Add what can be read back from the output: ``turns`` (role and text, from ``formatted``) and ``loss_texts`` (from ``segments``)."""
    known = "|".join(
        f"({_quote(before)})([^\\[<]*){_quote(after)}" for before, after, _ in template.values()
    )
    pattern = known + f"|{_quote(OTHER[0])}([^\\[<]*){_quote(OTHER[1])}([^\\[<]*){_quote(OTHER[2])}"
    found = F.arrays_zip(*[F.regexp_extract_all("formatted", F.lit(pattern), F.lit(i)).alias(f"g{i}") for i in range(1, 2 * len(template) + 3)])
    last = 2 * len(template) + 1

    def turn(g: Column) -> Column:
        role, text = unescape(g[f"g{last}"]), g[f"g{last + 1}"]
        for i, name in enumerate(template):
            mine = g[f"g{2 * i + 1}"] != ""
            role, text = F.when(mine, F.lit(name)).otherwise(role), F.when(mine, g[f"g{2 * i + 2}"]).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    return chats.withColumn("turns", F.transform(found, turn)).withColumn(
        "loss_texts", F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    )


def digest(chats: DataFrame) -> DataFrame:
    """The digest columns of formatted conversations, all read back from the output."""
    read = parse_chats(chats)
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
    )
