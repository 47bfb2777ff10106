"""Chat formatting by prefix-target expansion.

Every assistant turn is an example of its own: all turns before it are its
context, and only its own text is trainable.  The formatted turns of a
conversation are one stream, and an example's context is the stream up to the
example's own turn; so an example is stored as that length with the formatted
reply, and a conversation of n turns takes room for n turns, not for n squared.
``with_context`` writes the contexts out, and ``report`` reads the loss from them.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.session import materialize

#: Marks of the template (fixed values).
START, END = "<|im_start|>", "<|im_end|>"
TARGET_ROLE = "assistant"
#: Rows of a conversation that are joined to one text before the texts of a conversation are.
CHUNK = 1_000


def escape(column):
    """No '<|' is left: '<', n backslashes and '|' get one backslash more."""
    return F.regexp_replace(column, r"<(\\*)\|", r"<\\$1|")


def unescape(column):
    return F.regexp_replace(column, r"<\\(\\*)\|", r"<$1|")


def escape_role(column):
    """Roles stand on the mark's own line: line feeds, '<' and '%' are percent-coded."""
    for raw, coded in (("%", "%25"), ("<", "%3C"), ("\n", "%0A")):
        column = F.replace(column, F.lit(raw), F.lit(coded))
    return column


def unescape_role(column):
    for raw, coded in (("\n", "%0A"), ("<", "%3C"), ("%", "%25")):
        column = F.replace(column, F.lit(coded), F.lit(raw))
    return column


def _before(rows, size):
    """Number of rows and ``size`` before each row within its conversation.

    Sums per partition first, then over the partitions of a conversation, so
    that a long conversation stays spread.
    """
    within = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    zero = lambda column: F.coalesce(column, F.lit(0)).cast("long")
    totals = rows.groupBy("conv_id", "part").agg(F.count("*").alias("n"), F.sum(size).alias("s"))
    bases = totals.select("conv_id", "part", zero(F.sum("n").over(over)).alias("n_base"), zero(F.sum("s").over(over)).alias("s_base"))
    counted = rows.withColumns({"n_before": zero(F.count("*").over(within)), "s_before": zero(F.sum(size).over(within))})
    same = (counted.conv_id.eqNullSafe(bases.conv_id)) & (counted.part == bases.part)
    return counted.join(bases, same).select(
        counted.conv_id, "turn", "role", "text", "formatted", (F.col("n_before") + F.col("n_base")).alias("ordinal"),
        (F.col("s_before") + F.col("s_base")).alias("start"))


def format_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, ordinal, formatted, start, is_target, text_from) of every turn.

    formatted: the turn in the template; ordinal: its number from 0; start:
    code points before it in its conversation's stream; text_from: code points
    of the turn before its text.  Turns go by (turn, role, text), nulls first;
    repeated rows are turns of their own.  A null role or text is empty; rows
    without conv_id are one conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    made = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    made = made.withColumn("formatted", F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"), escape(F.col("text")), F.lit(END + "\n")))
    # Dealt by order, not by conversation: a long one spans several partitions.
    dealt = made.repartitionByRange("conv_id", "turn", "role", "text").withColumn("part", F.spark_partition_id())
    placed = _before(materialize(dealt, "chat-turns"), F.length("formatted"))
    head = F.length(F.lit(START)) + F.length(escape_role(F.col("role"))) + 1
    return placed.select("conv_id", "ordinal", "formatted", "start", (F.col("role") == TARGET_ROLE).alias("is_target"), head.cast("long").alias("text_from"))


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, context_chars, reply, loss_start, loss_end) of every assistant turn.

    The example's text is the first ``context_chars`` code points of its
    conversation's stream, then ``reply``; the loss mask covers [loss_start,
    loss_end) of it, the reply's text without its marks.
    """
    tail = F.length(F.lit(END + "\n"))
    return turns.where("is_target").select(
        "conv_id", F.col("ordinal").alias("example"), F.col("start").alias("context_chars"), F.col("formatted").alias("reply"),
        (F.col("start") + F.col("text_from")).alias("loss_start"), (F.col("start") + F.length("formatted") - tail).alias("loss_end"))


def parse_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, ordinal, role, text) read back from the formatted turns alone."""
    body = F.expr(f"substring(formatted, {len(START) + 1}, length(formatted) - {len(START) + len(END) + 1})")
    role = F.substring_index(body, "\n", 1)
    text = F.substr(body, F.length(role) + 2)
    return turns.select("conv_id", "ordinal", unescape_role(role).alias("role"), unescape(text).alias("text"))


def loss_texts(expanded: DataFrame) -> DataFrame:
    """(conv_id, example, text) under the loss masks of written-out examples (``with_context``), unescaped."""
    masked = F.expr("substring(concat(context, reply), cast(loss_start + 1 as int), cast(loss_end - loss_start as int))")
    return expanded.select("conv_id", "example", unescape(masked).alias("text"))


def with_context(found: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, example, context, reply, loss_start, loss_end) with written-out contexts.

    The text of a conversation is joined once and every example takes a prefix
    of it; use it where conversations are short, as the output holds a turn
    once per later reply.
    """
    stream = _joined(turns.select("conv_id", "ordinal", F.col("formatted").alias("piece")), "stream")
    same = found.conv_id.eqNullSafe(stream.conv_id)
    return found.join(stream, same).select(found.conv_id, "example", F.expr("substring(stream, 1, cast(context_chars as int))").alias("context"), "reply", "loss_start", "loss_end")


def _joined(pieces, name):
    """The pieces of a conversation in order as one text: chunks first, then the chunks."""
    text = lambda at: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "piece"))), lambda x: x["piece"]), "")
    chunks = pieces.groupBy("conv_id", F.expr(f"ordinal div {CHUNK}").alias("chunk")).agg(text("ordinal").alias("piece"))
    return chunks.groupBy("conv_id").agg(text("chunk").alias(name))


def report(conversations: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars), read back from the output.

    A digest of a whole conversation needs its text in one value; the text is
    joined in chunks, so the last step takes one row per ``CHUNK`` turns.
    formatted_chars counts the conversation's stream once.  The loss is read
    from every example with its context before its reply; such a text lives in
    its task only, none is kept.
    """
    turns = materialize(format_turns(conversations), "chat-formatted")
    back = parse_turns(turns)
    whole = back.select("conv_id", "ordinal", F.concat("role", F.lit("\n"), "text", F.lit("\n")).alias("piece"), F.lit("").alias("loss"), F.lit(1).alias("n"))
    under = loss_texts(with_context(examples(turns), turns))
    loss = under.select("conv_id", F.col("example").alias("ordinal"), F.lit("").alias("piece"), F.col("text").alias("loss"), F.lit(0).alias("n"))
    rows = whole.unionByName(loss)
    ordered = lambda field, at: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(at, "n", field))), lambda x: x[field]), "")
    chunks = rows.groupBy("conv_id", F.expr(f"ordinal div {CHUNK}").alias("chunk")).agg(
        ordered("piece", "ordinal").alias("piece"), ordered("loss", "ordinal").alias("loss"), F.sum("n").alias("n"))
    joined = chunks.groupBy("conv_id").agg(ordered("piece", "chunk").alias("piece"), ordered("loss", "chunk").alias("loss"), F.sum("n").cast("long").alias("n_turns"))
    sizes = turns.groupBy(F.col("conv_id").alias("own")).agg(F.max(F.col("start") + F.length("formatted")).alias("formatted_chars"))
    return joined.join(sizes, joined.conv_id.eqNullSafe(sizes.own)).select(
        "conv_id", "n_turns", F.sha2("piece", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
