"""Chat formatting from event logs, with DataFrame operations only.

A conversation is what its log of events comes to: messages, streamed deltas, edits and regenerations. The log is dealt by
conversation, sorted by sequence and folded into final messages, which a template renders. Control strings inside texts
are escaped; reading the rendered text back gives roles and texts as they were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
#: Roles whose texts are trained on.
LOSS_ROLES = ("assistant",)


def escaped(text: Column) -> Column:
    r"""``\`` becomes ``\\`` and ``<|`` becomes ``<\|``, so that ``<|`` never stands in a text."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"\\([\\|])", "$1")


def _role_out(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))  # a role is one line


def _role_in(role: Column) -> Column:
    line = F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n")  # an n after an odd number of backslashes
    return unescaped(line)


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, start, role, text): the final messages of ``events`` (conv_id, seq, kind, message, role, text).

    Kinds: ``message`` sets a message's text; ``delta`` appends to it; ``edit`` sets it anew; ``regenerate`` sets it anew and
    drops the messages that began after it and before this event. ``message`` names the message in its conversation; a
    null one stands alone. Events of one sequence number go by kind, role and text. A null text is empty, other kinds are
    ignored. ``start`` is the first sequence number; a message's role is that of its first event that has one.
    """
    kind = F.lower("kind")
    log = events.select("conv_id", "seq", kind.alias("kind"), "message", "role", F.coalesce("text", F.lit("")).alias("text")).where(kind.isin("message", "delta", "edit", "regenerate"))
    log = log.repartition("conv_id")  # all that follows works inside these partitions
    named = log.where(F.col("message").isNotNull())
    alone = log.where(F.col("message").isNull()).select("conv_id", F.col("seq").alias("start"), "role", "text")
    per_message = Window.partitionBy("conv_id", "message")
    sets = F.when(F.col("kind") != "delta", F.col("seq"))
    named = named.withColumn("start", F.min("seq").over(per_message)).withColumn("from", F.max(sets).over(per_message))
    later = Window.partitionBy("conv_id").orderBy(F.col("seq").desc())
    named = named.withColumn("cut", F.min(F.when(F.col("kind") == "regenerate", F.col("start"))).over(later))
    first_cut = F.min_by("cut", "seq")
    order = F.struct("seq", F.when(F.col("kind") == "delta", 1).otherwise(0).alias("d"), "kind", "role", "text")
    live = F.col("from").isNull() | (F.col("seq") >= F.col("from"))
    messages = named.groupBy("conv_id", "message", "start").agg(F.min_by("role", F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("role"), F.array_sort(F.collect_list(F.when(live, order))).alias("parts"), first_cut.alias("cut"))
    # of several events that set the text in one sequence number, the last stands
    last_set = F.coalesce(F.array_max(F.transform("parts", lambda p, i: F.when(p["d"] == 0, i))), F.lit(0))
    parts = F.expr("slice(parts, last_set + 1, size(parts))")
    messages = messages.withColumn("last_set", last_set).withColumn("parts", parts)
    messages = messages.where("cut is null or cut >= start").select("conv_id", "start", "role", F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    return messages.unionByName(alone)


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted): a text for each conversation of ``messages`` (conv_id, start, role, text), in order of start, role and text; nulls first."""
    turn = F.struct("start", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    one = lambda t: F.concat(F.lit(START), _role_out(t["role"]), F.lit("\n"), escaped(t["text"]), F.lit(END + "\n"))
    return messages.groupBy("conv_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(turn)), one), "").alias("formatted"))


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns``: array of (role, text, start, length), read from ``formatted`` alone.

    ``start`` and ``length`` give where the escaped text stands in ``formatted``, in code points: the loss mask's spans.
    """
    bodies = F.split(F.col("formatted"), r"<\|im_end\|>\n")
    bodies = F.slice(bodies, 1, F.greatest(F.size(bodies) - 1, F.lit(0)))
    head = lambda b: F.instr(b, F.lit("\n"))
    turn = lambda b: F.struct(
        _role_in(F.substring(b, F.lit(len(START) + 1), head(b) - len(START) - 1)).alias("role"),
        unescaped(F.substring(b, head(b) + 1, F.length(b))).alias("text"),
        head(b).alias("start"),
        (F.length(b) - head(b)).alias("length"),
    )
    return chats.withColumn("turns", F.transform(bodies, turn))


def digests(chats: DataFrame, loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of each rendered conversation, read back from it."""
    rows = read_back(chats)
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("turns", lambda t: t["role"].isin(*loss_roles)), lambda t: t["text"]), "")
    rows = rows.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(every, 256).alias("turns_sha256"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    return rows.select("conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


def as_events(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) as a log: each is a message of its own, also where turns are repeated."""
    nth = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    name = F.concat_ws(":", F.coalesce(F.col("turn").cast("string"), F.lit("null")), nth)
    rows = conversations.select("conv_id", "turn", "role", "text").repartition("conv_id")
    return rows.select("conv_id", F.col("turn").cast("long").alias("seq"), F.lit("message").alias("kind"), name.alias("message"), "role", "text")


def format_chats(events: DataFrame) -> DataFrame:
    """(conv_id, formatted) of a log of events; conversations without a message are not there. A conversation is one row, so it must fit in a task."""
    return rendered(fold(events))
