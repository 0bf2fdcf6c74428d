"""Chat formatting: each assistant turn becomes an example with all turns before it as context."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The template's control strings.
OPEN = "<|im_start|>"
CLOSE = "<|im_end|>\n"
LINE = "<|nl|>"


def escape(text: Column) -> Column:
    """One more backslash in every ``<\\...|``: no control string is left, and ``unescape`` undoes it."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def _header(role: Column) -> Column:
    return F.concat(F.lit(OPEN), F.replace(escape(role), F.lit("\n"), F.lit(LINE)), F.lit("\n"))


def format_examples(conversations: DataFrame, trainable: str = "assistant") -> DataFrame:
    """(conv_id, example, text, loss_start, loss_end, whole) from rows (conv_id, turn, role, text).

    Rows of a conversation are ordered by turn, ties by role and text, nulls first; repeated rows stay; a null role or
    text is empty; a null conv_id is a conversation of its own; other columns are not used.  Every turn of the
    trainable role gives an example, numbered from 0: the turns before it, then itself; [loss_start, loss_end) are the
    code points of its text, the only trainable ones.  If turns follow the last of these, or there is none, one
    more row holds the whole conversation with nothing trainable, so that no turn is lost.  ``whole`` marks the row
    with all turns.  An example is one value, so a conversation has to fit in a task, as its longest example does.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    c = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    parts = F.transform("turns", lambda t: F.concat(_header(t["role"]), escape(t["text"]), F.lit(CLOSE)))
    places = F.filter(F.transform("turns", lambda t, i: F.when(t["role"] == trainable, i + 1)), lambda i: i.isNotNull())
    n = F.size("turns")
    c = c.select("conv_id", "turns", parts.alias("parts"), places.alias("places"))
    last = F.coalesce(F.array_max("places"), F.lit(0))
    c = c.withColumn("places", F.when(last < n, F.concat("places", F.array(F.lit(0)))).otherwise(F.col("places")))
    c = c.select("conv_id", "turns", "parts", F.posexplode("places").alias("example", "at"))
    before = F.array_join(F.slice("parts", F.lit(1), F.greatest(F.col("at") - 1, F.lit(0))), "")
    target = F.get("turns", F.col("at") - 1)
    c = c.select("conv_id", "example", "at", n.alias("n"), "turns", "parts", before.alias("context"), _header(target["role"]).alias("head"), escape(target["text"]).alias("reply"))
    plain = F.col("at") == 0
    start = F.when(plain, 0).otherwise(F.length("context") + F.length("head"))
    return c.select(
        "conv_id",
        "example",
        F.when(plain, F.array_join("parts", "")).otherwise(F.concat("context", "head", "reply", F.lit(CLOSE))).alias("text"),
        start.cast("bigint").alias("loss_start"),
        (start + F.when(plain, 0).otherwise(F.length("reply"))).cast("bigint").alias("loss_end"),
        (plain | (F.col("at") == F.col("n"))).alias("whole"),
    )


def parse_turns(text: Column) -> Column:
    """The (role, text) turns of a formatted text."""
    pieces = F.filter(F.split(text, r"<\|im_end\|>\n"), lambda p: p != "")
    def turn(p):
        body = F.substring(p, F.lit(len(OPEN) + 1), F.length(p))
        cut = F.instr(body, "\n")
        role = F.substring(body, F.lit(1), cut - 1)
        return F.struct(unescape(F.replace(role, F.lit(LINE), F.lit("\n"))).alias("role"), unescape(F.substring(body, cut + 1, F.length(body))).alias("text"))
    return F.transform(pieces, turn)


def trained_text(text: Column, start: Column, end: Column) -> Column:
    """What the loss mask of an example covers, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), (end - start).cast("int")))
