"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example: all turns before it are the context, only that reply (and its end mark) is
trainable. Turns that follow the last assistant turn form a last example without a target, so that nothing is lost.

A turn reads <|im_start|>role\\ntext<|im_end|>\\n. In roles and texts & < [ are written &amp; &lt; &#91; (in roles also line feeds, &#10;): no
control string of this or of another template (they begin with < or [) can then stand in a text, and reading undoes it exactly.

Turns are ordered by turn number, nulls first, equal ones by role and text; null roles and texts are empty; rows with a null conv_id form
one conversation. All turns of one conversation meet in one row, as each of its examples holds all that precede its reply.
Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import let

START, END = "<|im_start|>", "<|im_end|>\n"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&#91;"))


def escape(text: Column) -> Column:
    out = F.coalesce(text, F.lit(""))
    for plain, coded in ESCAPES:
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def format_turn(role: Column, text: Column) -> Column:
    name = F.replace(escape(role), F.lit("\n"), F.lit("&#10;"))
    return F.concat(F.lit(START), name, F.lit("\n"), escape(text), F.lit(END))


def expand(turns: DataFrame) -> DataFrame:
    """turns: conv_id, turn, role, text. A row for each example: conv_id, target (position of the reply's turn from 0; null in the
    last example without a target), n_targets, is_last, context, reply (what the loss covers, with its end mark)."""
    own = turns.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    by = own.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    by = by.select("conv_id", F.transform("t", lambda x: format_turn(x["role"], x["text"])).alias("s"), F.transform("t", lambda x: x["role"] == "assistant").alias("a"))
    n = F.size("s")
    places = F.filter(F.sequence(F.lit(0), n - 1), lambda i: F.get(F.col("a"), i))
    ends = F.when(F.get(F.col("a"), n - 1), places).otherwise(F.concat(places, F.array(n)))
    rows = by.select("conv_id", "s", F.size(places).alias("n_targets"), n.alias("n"), F.explode(ends).alias("i"))
    head = F.lit(f"{START}assistant\n")
    is_target = F.col("i") < F.col("n")
    context = F.concat(F.array_join(F.slice("s", F.lit(1), F.col("i")), ""), F.when(is_target, head).otherwise(F.lit("")))
    reply = F.when(is_target, F.substr(F.get("s", F.col("i")), F.lit(len(START) + len("assistant\n") + 1))).otherwise(F.lit(""))
    return rows.select("conv_id", F.when(is_target, F.col("i")).alias("target"), "n_targets", (F.col("i") >= F.col("n") - 1).alias("is_last"), context.alias("context"), reply.alias("reply"))


def read_turns(formatted: Column) -> Column:
    """Array of role, text, read from a formatted string."""
    parts = F.slice(F.split(formatted, r"<\|im_start\|>", -1), 2, 2_000_000_000)

    def turn(x: Column) -> Column:
        at = F.locate("\n", x)
        role = unescape(F.replace(F.substr(x, F.lit(1), at - 1), F.lit("&#10;"), F.lit("\n")))
        return F.struct(role.alias("role"), unescape(F.substr(x, at + 1, F.length(x) - at - len(END))).alias("text"))

    return F.transform(parts, turn)


def digest(examples: DataFrame) -> DataFrame:
    """What can be read back from the examples of a conversation. The last one holds all its turns."""
    said = unescape(F.substr("reply", F.lit(1), F.length("reply") - len(END)))
    turns = F.when(F.col("is_last"), read_turns(F.concat("context", "reply")))
    rows = examples.select("conv_id", "target", turns.alias("turns"), F.when(F.col("target").isNotNull(), said).alias("said"), (F.length("context") + F.length("reply")).alias("chars"))
    by = rows.groupBy("conv_id").agg(F.sum("chars").alias("formatted_chars"), F.max("turns").alias("turns"), F.sort_array(F.collect_list(F.when(F.col("target").isNotNull(), F.struct("target", "said")))).alias("said"))
    text = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = let(F.array_join(F.transform("said", lambda x: x["said"]), ""), lambda x: F.struct(F.length(x).cast("long").alias("n"), F.sha2(x, 256).alias("h")))
    out = by.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), loss.alias("loss"), F.col("formatted_chars").cast("long"))
    return out.select("conv_id", "n_turns", "turns_sha256", F.col("loss.n").alias("loss_chars"), F.col("loss.h").alias("loss_sha256"), "formatted_chars")
