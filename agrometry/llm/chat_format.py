"""Training examples from conversations: every assistant turn with all turns before it as context.

A turn is written ``<s>[role]text</s>`` and a line end.  Inside roles and texts the signs that control strings are made
of, and the escape sign, become two-character sequences, so no text can open or close a turn, and reading gives back
exactly what was written.  Of an example, only the last reply is under the loss mask; its place is a pair of character
positions.  Turns after the last assistant turn (or all, without one) make an example without a target, so nothing of
a conversation is lost.

Turns are ordered by number, then role and text; repeated rows are turns of their own; null texts and roles are empty;
a null conv_id is a conversation too; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<s>", "</s>\n"
#: What stands for the escape sign and the signs of control strings; the escape sign comes first.
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c"))


def escaped(text: Column) -> Column:
    for sign, code in ESCAPES:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for sign, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def _head(role: Column) -> Column:
    return F.concat(F.lit(f"{OPEN}["), escaped(role), F.lit("]"))


def examples(conversations: DataFrame, reply: str = "assistant") -> DataFrame:
    """Rows (conv_id, turns, text, loss_begin, loss_end): examples with ``turns`` turns, the target's characters last.

    Without a target the positions are null.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce(F.col("role"), F.lit("")).alias("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")
    )
    talks = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("talk"))
    written = talks.select(
        "conv_id",
        F.transform("talk", lambda t: F.concat(_head(t["role"]), escaped(t["text"]), F.lit(CLOSE))).alias("written"),
        F.transform(
            F.filter(F.transform("talk", lambda t, i: F.struct((i + 1).alias("turns"), t["role"].alias("role"), F.lit(True).alias("target"))), lambda t: t["role"] == reply),
            lambda t: F.struct(t["turns"].alias("turns"), F.length(_head(t["role"])).alias("head"), t["target"].alias("target")),
        ).alias("targets"),
        F.size("talk").alias("total"),
    )
    rest = F.array(F.struct(F.col("total").alias("turns"), F.lit(0).alias("head"), F.lit(False).alias("target")))
    open_end = F.coalesce(F.try_element_at("targets", F.lit(-1))["turns"] < F.col("total"), F.lit(True))
    wanted = F.when(open_end, F.concat("targets", rest)).otherwise(F.col("targets"))
    each = written.select("conv_id", "written", F.explode(wanted).alias("goal"))
    text = F.array_join(F.slice("written", F.lit(1), F.col("goal.turns")), "")
    last = F.element_at("written", F.col("goal.turns"))
    each = each.select("conv_id", F.col("goal.turns").alias("turns"), "goal", text.alias("text"), F.length(last).alias("last"))
    begin = F.length("text") - F.col("last") + F.col("goal.head")
    return each.select(
        "conv_id",
        "turns",
        "text",
        F.when(F.col("goal.target"), begin).alias("loss_begin"),
        F.when(F.col("goal.target"), F.length("text") - F.lit(len(CLOSE))).alias("loss_end"),
    )


def read_turns(text: Column) -> Column:
    """The turns of an example, as an array of (role, text)."""
    pieces = F.filter(F.split(text, CLOSE, -1), lambda p: F.length(p) > 0)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "]", 1)
        begin = F.length(head) + F.lit(2)
        return F.struct(
            unescaped(F.substring(head, len(OPEN) + 2, 1 << 30)).alias("role"),
            unescaped(F.substr(piece, begin)).alias("text"),
        )

    return F.transform(pieces, turn)


def read_loss(text: Column, begin: Column, end: Column) -> Column:
    return unescaped(F.substr(text, begin + 1, end - begin))


def digest(found: DataFrame) -> DataFrame:
    """One row for each conversation, from its examples."""
    loss = F.when(F.col("loss_begin").isNotNull(), read_loss(F.col("text"), F.col("loss_begin"), F.col("loss_end")))
    whole = found.select("conv_id", "turns", "text", loss.alias("loss")).groupBy("conv_id").agg(
        F.max_by("text", "turns").alias("text"),
        F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("turns", "loss")))).alias("losses"),
        F.sum(F.length("text")).alias("formatted_chars"),
    )
    turns = read_turns(F.col("text"))
    said = F.array_join(F.transform("losses", lambda x: x["loss"]), "")
    whole = whole.select("conv_id", turns.alias("turns"), said.alias("said"), F.col("formatted_chars").cast("bigint").alias("formatted_chars"))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return whole.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.encode(spoken, "UTF-8"), 256).alias("turns_sha256"),
        F.length("said").cast("bigint").alias("loss_chars"),
        F.sha2(F.encode("said", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: The same digest for DuckDB; the template's cost of a turn is 3 + 1 + 1 + 5 characters and one for each escaped sign.
SQL = """
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER ordered AS place, count(*) OVER (PARTITION BY conv_id) AS total,
        sum(10 + length(role) + length(text) + length(regexp_replace(role || text, '[^\\\\<\\[\\]]', '', 'g'))) OVER ordered AS upto
    FROM said
    WINDOW ordered AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
    coalesce(length(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant')), 0) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(CASE WHEN role = 'assistant' OR place = total THEN upto ELSE 0 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""
