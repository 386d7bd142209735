"""Chat formatting from event logs, in column expressions only.

A log row is ``(conversation, seq, message, kind, role, text)``. Kinds: ``open`` begins a
message of a role, ``delta`` appends to it, ``edit`` replaces its text, ``regenerate``
discards what has streamed so far, ``delete`` removes the message. Folding a message
means: find its last event that resets it, and join the text from there on in order of
``seq``. A conversation is rendered from its messages in order of their first event.

Template: ``### Label:`` and a line feed, the text, ``</turn>`` and a line feed. The
labels of known roles are their names in title case; any other role is ``@`` and its name.
Inside texts a backslash becomes two, ``###`` becomes backslash-h and ``</turn>``
becomes backslash-t, so neither control string can come from a text and all is
reversible. ``loss`` has, per turn, where in the turn the text under the loss mask
begins and how many characters it has; only assistant texts are under it.

Defined cases: a NULL or empty text is empty; a NULL role reads back as the empty role; a
NULL conversation is one of its own; messages without an ``open`` have the empty role;
rows that tie in ``seq`` are ordered by kind and text; an empty log gives an empty result.
A conversation, as one string, must fit in a cell (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KNOWN_ROLES = ("system", "user", "assistant", "tool")
RESETS = ("open", "edit", "regenerate", "delete")
HEAD, END = "### ", "</turn>\n"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    headless = F.replace(doubled, F.lit("###"), F.lit("\\h"))
    return F.replace(headless, F.lit("</turn>"), F.lit("\\t"))


def unescape(text: Column) -> Column:
    """Between doubled backslashes, a single one always begins an escape."""

    def plain(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\h"), F.lit("###")), F.lit("\\t"), F.lit("</turn>"))

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def _label(role: Column) -> Column:
    other = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.when(role.isin(*KNOWN_ROLES), F.initcap(role)).otherwise(F.concat(F.lit("@"), other))


def _role(label: Column) -> Column:
    other = F.array_join(
        F.transform(F.split(F.substring(label, 2, 1 << 30), r"\\\\"), lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\"
    )
    return F.when(label.startswith("@"), other).otherwise(F.lower(label))


def fold(log: DataFrame) -> DataFrame:
    """Final messages: conversation, ``position`` (their first seq), role and text."""
    reset = F.max(F.when(F.col("kind").isin(*RESETS), F.struct("seq", "kind")))
    opened = F.max(F.when(F.col("kind") == "open", F.struct("seq", "role")))
    parts = F.sort_array(F.collect_list(F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))))
    folded = log.groupBy("conversation", "message").agg(
        F.min("seq").alias("position"), opened["role"].alias("role"), reset.alias("reset"), parts.alias("parts")
    )
    kept = F.filter("parts", lambda p: F.col("reset").isNull() | (p["seq"] >= F.col("reset.seq")))
    return folded.where(F.col("reset").isNull() | (F.col("reset.kind") != "delete")).select(
        "conversation",
        "position",
        F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda p: p["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """Per conversation ``formatted`` and ``loss``."""
    turns = messages.groupBy("conversation").agg(
        F.sort_array(F.collect_list(F.struct("position", "role", "text"))).alias("turns")
    )
    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(HEAD), _label(t["role"]), F.lit(":\n")).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == "assistant").alias("learned"),
        ),
    )
    return turns.select("conversation", pieces.alias("pieces")).select(
        "conversation",
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
        F.transform(
            "pieces",
            lambda p: F.struct(
                F.char_length(p["head"]).alias("start"),
                F.when(p["learned"], F.char_length(p["body"])).otherwise(0).alias("chars"),
            ),
        ).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation ``turns`` (role and text) and ``loss_text``, from the output alone."""
    cut = F.split("formatted", END)
    segments = F.slice(cut, 1, F.size(cut) - 1)
    read = formatted.select("conversation", "formatted", F.arrays_zip(segments.alias("segment"), "loss").alias("found"))
    return read.select(
        "conversation",
        "formatted",
        F.transform(
            "found",
            lambda f: F.struct(
                _role(F.regexp_extract(f["segment"], r"\A### ([^\n]*):\n", 1)).alias("role"),
                unescape(F.regexp_extract(f["segment"], r"(?s)\A### [^\n]*:\n(.*)\z", 1)).alias("text"),
            ),
        ).alias("turns"),
        F.array_join(
            F.transform("found", lambda f: unescape(F.substring(f["segment"], f["loss"]["start"] + 1, f["loss"]["chars"]))), ""
        ).alias("loss_text"),
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What the output reads back as, in short."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(formatted).select(
        F.col("conversation").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def log_of(conversations: DataFrame) -> DataFrame:
    """The table as the log it would have come from: texts streamed in two deltas, every
    assistant text after a discarded draft, every user text corrected by an edit."""
    same_turn = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "copy", F.row_number().over(same_turn)
    )
    half = F.floor(F.char_length("text") / 2).cast("int")
    first, second = F.substring("text", F.lit(1), half), F.substring("text", half + 1, F.char_length("text"))
    none = F.lit(None).cast("string")

    def events(*found: tuple[str, Column]) -> Column:
        steps = [("open", none), *found]
        return F.array(*[F.struct(F.lit(n).alias("step"), F.lit(k).alias("kind"), t.alias("said")) for n, (k, t) in enumerate(steps)])

    streamed = (
        F.when(
            F.col("role") == "assistant",
            events(("delta", second), ("delta", first), ("regenerate", none), ("delta", first), ("delta", second)),
        )
        .when(F.col("role") == "user", events(("delta", first), ("edit", first), ("delta", second)))
        .otherwise(events(("delta", first), ("delta", second)))
    )
    return rows.select("conv_id", "turn", "copy", "role", F.inline(streamed)).select(
        F.col("conv_id").alias("conversation"),
        F.struct("turn", "copy", "step").alias("seq"),
        F.struct("turn", "copy").alias("message"),
        "kind",
        F.when(F.col("kind") == "open", F.col("role")).alias("role"),
        F.col("said").alias("text"),
    )
