"""Chat transcripts as text with a loss mask, in Spark expressions only.

A conversation becomes runs of adjacent turns with one role::

    ### role: first text<next>second text</turn>

each followed by a line feed. Inside texts and roles ``\\`` is doubled and ``##``,
``</turn>``, ``<next>`` (and ``: `` in roles) get a backslash inside, so no marker can
occur there, and dropping the escapes restores every text.

The mask lists one entry per text: markup characters before it, its own characters
(escaped, in code points) and whether they carry loss. Together with the closing
markup the entries cover the formatted text without gaps.

Defined results: a NULL text or role is empty. Turns are ordered by (turn, role, text),
NULL turns first, so ties and repeated rows have one order. Rows without a
conversation id form one conversation with a NULL id. An empty table gives no rows.
A conversation is one string of the output, so the turns of one conversation meet in
one aggregation buffer by definition; everything per conversation is linear in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The markers of the template.
OPEN, AFTER_ROLE, NEXT, CLOSE = "### ", ": ", "<next>", "</turn>\n"


def escaped(text: Column) -> Column:
    for plain, safe in (
        ("\\", "\\\\"),
        ("##", "#\\#"),
        ("</turn>", "<\\/turn>"),
        ("<next>", "<\\next>"),
    ):
        text = F.replace(text, F.lit(plain), F.lit(safe))
    return text


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(": "), F.lit(":\\ "))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: id, formatted, mask array<struct<markup, chars, loss>>."""
    rows = turns.select(
        F.col(id_col).alias("id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        ).alias("item"),
    )
    sorted_turns = rows.groupBy("id").agg(F.sort_array(F.collect_list("item")).alias("turns"))
    turn_list = F.col("turns")

    def role_at(index: Column) -> Column:
        return F.get(turn_list, index)["role"]

    starts = F.filter(
        F.sequence(F.lit(0), F.size(turn_list) - 1),
        lambda i: (i == 0) | (role_at(i) != role_at(i - 1)),
    )
    with_starts = sorted_turns.withColumn("starts", starts)

    def run(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(F.col("starts"), k + 1), F.size(turn_list))
        return F.struct(
            role_at(start).alias("role"),
            F.transform(
                F.slice(turn_list, start + 1, end - start), lambda t: escaped(t["text"])
            ).alias("texts"),
        )

    runs = with_starts.select("id", F.transform("starts", run).alias("runs"))

    def rendered(r: Column) -> Column:
        return F.concat(
            F.lit(OPEN),
            escaped_role(r["role"]),
            F.lit(AFTER_ROLE),
            F.array_join(r["texts"], NEXT),
            F.lit(CLOSE),
        )

    def masked(r: Column, k: Column) -> Column:
        head = len(OPEN) + F.char_length(escaped_role(r["role"])) + len(AFTER_ROLE)
        first = F.when(k == 0, head).otherwise(head + len(CLOSE))
        return F.transform(
            r["texts"],
            lambda text, i: F.struct(
                F.when(i == 0, first).otherwise(len(NEXT)).cast("long").alias("markup"),
                F.char_length(text).cast("long").alias("chars"),
                r["role"].isin(*loss_roles).alias("loss"),
            ),
        )

    return runs.select(
        F.col("id").alias(id_col),
        F.array_join(F.transform("runs", rendered), "").alias("formatted"),
        F.flatten(F.transform("runs", masked)).alias("mask"),
    )


def read_chats(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Undo :func:`format_chats`: id, turns array<struct<role, text, loss>>, formatted_chars.

    Works from the formatted text and the mask alone. Raises if the mask does not fit
    the text.
    """
    parts = F.split("formatted", "</turn>\n", -1)

    def run(piece: Column) -> Column:
        halves = F.split(piece, ": ", 2)
        role = unescaped(F.substring(halves[0], len(OPEN) + 1, 2**31 - 1))
        return F.transform(
            F.split(halves[1], "<next>", -1),
            lambda text: F.struct(role.alias("role"), text.alias("text")),
        )

    read = formatted.select(
        F.col(id_col).alias("id"),
        F.flatten(F.transform(F.slice(parts, 1, F.size(parts) - 1), run)).alias("turns"),
        "mask",
        F.char_length("formatted").alias("chars"),
    )
    covered = F.aggregate(
        "mask", F.lit(len(CLOSE)).cast("long"), lambda sum_, m: sum_ + m["markup"] + m["chars"]
    )
    fits = (
        (F.size("turns") == F.size("mask"))
        & (covered == F.col("chars"))
        & F.forall(
            F.arrays_zip("turns", "mask"),
            lambda x: F.char_length(x["turns"]["text"]) == x["mask"]["chars"],
        )
    )
    turns = F.zip_with(
        "turns",
        "mask",
        lambda t, m: F.struct(
            t["role"].alias("role"), unescaped(t["text"]).alias("text"), m["loss"].alias("loss")
        ),
    )
    return read.select(
        F.col("id").alias(id_col),
        F.when(fits, turns)
        .otherwise(F.raise_error(F.lit("the mask does not fit the formatted text")))
        .alias("turns"),
        F.col("chars").cast("long").alias("formatted_chars"),
    )
