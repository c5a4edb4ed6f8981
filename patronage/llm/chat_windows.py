"""Chat formatting into budgeted windows, in DataFrame functions only.

Turns become template text; prefix sums of their token estimates deal them into
turn-aligned windows. The estimate is a quarter of the UTF-8 bytes, rounded up,
and ``MARKS`` tokens for the template. With B the budget, Y the system turn's
tokens and H the history's, B - Y - H tokens are left for new turns: a grid of
three quarters of them over the prefix sums sets the borders, the last quarter
takes what the last turn of a window runs over. A turn of over a quarter gets a
window of its own. So a window exceeds the budget only where a single turn is
longer than what is left. Every window after the first opens with the system
turn and with those last turns before it that lie within H tokens; these
repeats are masked from the loss, so each assistant text is learnt once.

Prefix sums run in two levels (blocks of turns, then turns of a block), so a
very long conversation is not one task's sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.session import materialize

#: Tokens: a window's budget, its repeated history at most, a turn's marks.
BUDGET, HISTORY, MARKS = 1024, 192, 4
#: Turn numbers in a block of the prefix sums.
BLOCK = 256
OPEN, SHUT, CLOSE = "<|turn:", "|>\n", "<|end|>\n"


def escape(c: Column) -> Column:
    """Texts in which no control string is left."""
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    return F.replace(F.replace(c, F.lit("<|"), F.lit("&lt;|")), F.lit("|>"), F.lit("|&gt;"))


def unescape(c: Column) -> Column:
    c = F.replace(F.replace(c, F.lit("|&gt;"), F.lit("|>")), F.lit("&lt;|"), F.lit("<|"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def tokens(text: Column) -> Column:
    """Estimated tokens of a turn."""
    return (F.ceil(F.octet_length(text) / 4) + MARKS).cast("bigint")


def placed(turns: DataFrame) -> DataFrame:
    """The turns with pos (order in the conversation), n (tokens) and s, the
    tokens before them. Ties of turn go by role and text."""
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("n", tokens(F.col("text"))) \
        .withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-1 << 60)))
    whole = rows.groupBy("conv_id", "block").agg(F.sum("n").alias("m"), F.count("*").alias("k"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select("conv_id", "block", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("s0"),
                         F.coalesce(F.sum("k").over(before), F.lit(0)).alias("p0"))
    inner = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    rows = rows.withColumns({
        "sn": F.sum("n").over(inner.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"),
        "pn": F.row_number().over(inner) - 1})
    out = rows.join(whole.withColumnRenamed("conv_id", "c2").withColumnRenamed("block", "b2"),
                    F.col("conv_id").eqNullSafe(F.col("c2")) & (F.col("block") == F.col("b2")))
    return out.select("conv_id", (F.col("p0") + F.col("pn")).cast("bigint").alias("pos"), "role", "text", "n",
                      (F.col("s0") + F.col("sn")).alias("s"))


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """One row for each window: conv_id, start (tokens before its first new
    turn), n_tokens, n_repeated (leading turns that are repeats), formatted, and
    loss, the (start, length) spans in code points of what is learnt.

    Null texts and roles count as empty, null conv_ids are one conversation, a
    null turn comes first; repeated rows are turns of their own; an empty table
    gives no windows; other columns are not read.
    """
    rows = materialize(placed(turns))
    system = rows.where("role = 'system' and pos = 0").select(
        F.col("conv_id").alias("cs"), F.struct("role", "text", "n").alias("system"))
    rows = rows.join(system, F.col("conv_id").eqNullSafe(F.col("cs")), "left") \
        .withColumn("left", F.greatest(F.lit(4), F.lit(budget - history) - F.coalesce("system.n", F.lit(0)))) \
        .withColumn("long", (F.col("n") > F.expr("left div 4")).cast("bigint"))
    # Each long turn is a window of its own: turns of a cell are told apart by the long ones up to them.
    run = Window.partitionBy("conv_id", "cell").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("cell", F.expr("s div (left - left div 4)")).withColumn("k", F.sum("long").over(run))
    key = ["conv_id", "cell", "k", "long"]
    group = Window.partitionBy(*key)
    rows = rows.withColumns({"start": F.min("s").over(group), "end": F.max(F.col("s") + F.col("n")).over(group)})
    turn = F.struct(F.col("pos"), F.lit(False).alias("again"), "role", "text", "n")
    again = F.struct(F.col("pos"), F.lit(True).alias("again"), "role", "text", "n")
    new = rows.select("conv_id", "start", turn.alias("t"), F.when(F.col("start") > 0, F.col("system")).alias("system"))
    old = rows.where(f"s >= end - {int(history)} and not (pos = 0 and role = 'system')") \
        .select("conv_id", F.col("end").alias("start"), again.alias("t"),
                F.lit(None).cast(rows.schema["system"].dataType).alias("system"))
    made = new.unionByName(old).groupBy("conv_id", "start").agg(
        F.sort_array(F.collect_list("t")).alias("ts"), F.max("system").alias("system")) \
        .where(F.exists("ts", lambda t: ~t["again"]))
    first = F.transform(F.filter(F.array("system"), lambda x: x.isNotNull()),
                        lambda x: F.struct(F.lit(-1).cast("bigint").alias("pos"), F.lit(True).alias("again"),
                                           x["role"].alias("role"), x["text"].alias("text"), x["n"].alias("n")))
    made = made.withColumn("ts", F.concat(first, "ts"))
    made = made.withColumn("parts", F.transform("ts", lambda t: F.struct(
        F.concat(F.lit(OPEN), escape(t["role"]), F.lit(SHUT)).alias("head"), escape(t["text"]).alias("body"),
        ((t["role"] == "assistant") & ~t["again"]).alias("learn"))))
    shut = len(CLOSE)
    # The end of each part is a running sum over the window's turns (a bounded list).
    ends = F.aggregate("parts", F.struct(F.array().cast("array<bigint>").alias("a"), F.lit(0).cast("bigint").alias("z")),
                       lambda acc, p: F.struct(
                           F.concat(acc["a"], F.array(acc["z"] + F.char_length(p["head"]))).alias("a"),
                           (acc["z"] + F.char_length(p["head"]) + F.char_length(p["body"]) + shut).alias("z")),
                       lambda acc: acc["a"])
    made = made.withColumn("at", ends)
    spans = F.filter(F.zip_with("parts", "at", lambda p, a: F.struct(
        a.alias("start"), F.char_length(p["body"]).cast("bigint").alias("length"), p["learn"].alias("learn"))),
        lambda x: x["learn"])
    return made.select(
        "conv_id", "start", F.aggregate("ts", F.lit(0).cast("bigint"), lambda a, t: a + t["n"]).alias("n_tokens"),
        F.size(F.filter("ts", lambda t: t["again"])).alias("n_repeated"),
        F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.transform(spans, lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length"))).alias("loss"))


def read_back(made: DataFrame) -> DataFrame:
    """Per conversation, from the windows alone: n_turns, the digest of its
    turns, characters and digest of what is learnt, formatted_chars.

    A digest needs the conversation's text in one value; everything before this
    is spread by window.
    """
    body = F.expr(f"substring(formatted, 1, char_length(formatted) - {len(CLOSE)})")
    parts = F.split(body, r"<\|end\|>\n")
    turns = F.transform(F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - F.col("n_repeated")), lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), SHUT, 1)).alias("role"),
        unescape(F.substr(p, F.lit(len(OPEN) + len(SHUT) + 1)
                          + F.char_length(F.substring_index(F.substr(p, F.lit(len(OPEN) + 1)), SHUT, 1)))).alias("text")))
    learnt = F.transform("loss", lambda x: unescape(
        F.substr("formatted", (x["start"] + 1).cast("int"), x["length"].cast("int"))))
    rows = made.select("conv_id", "start", F.char_length("formatted").cast("bigint").alias("chars"),
                       turns.alias("turns"), learnt.alias("learnt"))
    rows = rows.select(
        "conv_id", "chars", F.size("turns").alias("k"), F.struct("start", F.array_join(F.transform(
            "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("x")).alias("said"),
        F.struct("start", F.array_join("learnt", "").alias("x")).alias("learnt"))
    joined = rows.groupBy("conv_id").agg(
        F.sum("k").cast("bigint").alias("n_turns"), F.sum("chars").cast("bigint").alias("formatted_chars"),
        *[F.array_join(F.transform(F.sort_array(F.collect_list(c)), lambda x: x["x"]), "").alias(c)
          for c in ("said", "learnt")])
    return joined.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"),
                         F.char_length("learnt").cast("bigint").alias("loss_chars"),
                         F.sha2("learnt", 256).alias("loss_sha256"), "formatted_chars")
