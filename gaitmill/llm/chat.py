"""Conversations rebuilt from an event log and rendered for training.

The log has one row per event: ``message`` opens a message, ``delta`` adds streamed text
to it, ``edit`` replaces its text, ``regenerate`` empties it so that later deltas build
it anew. Events of a conversation are in the order of their sequence number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BETWEEN, CLOSE = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: What a text must not say unescaped: the template's marks and those of other ones.
CONTROL = (
    OPEN, BETWEEN, CLOSE, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]",
    "<<SYS>>", "<</SYS>>",
)
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    r"""Doubles backslashes, then puts one behind the first character of each control
    string. In the result no control string occurs and a single backslash is always
    such a mark, so ``unescape`` gives back every text."""
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    rests = "|".join(_quoted(c[1:]) for c in CONTROL)
    return F.regexp_replace(doubled, rf"([<\[])(?={rests})", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def _quoted(text: str) -> str:
    return "".join(f"\\{c}" if c in "[]|/<>" else c for c in text)


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: ``conv_id``, ``msg``, ``seq`` of its opening, ``role``, ``text``.

    Input columns: ``conv_id``, ``seq``, ``msg`` (id within the conversation), ``kind``,
    ``role`` (of the ``message`` event), ``text``. A message's text is what its last
    message, edit or regenerate event and the deltas after it say, in order; null texts
    are empty. Events of equal number are taken in the order of kind (message, edit,
    regenerate, delta) and text. Events of a message that was never opened, with an
    unknown kind or with no sequence number have no place in the result. Null
    conversations and message ids are values like any other. Empty in, empty out.
    """
    rank = F.coalesce(
        *[F.when(F.col("kind") == k, F.lit(i)) for i, k in enumerate((*RESETS, "delta"))]
    )
    log = events.select(
        "conv_id",
        "msg",
        F.col("role").alias("role"),
        F.struct(
            F.col("seq").alias("seq"),
            rank.alias("rank"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("event"),
    ).where(F.col("event.rank").isNotNull() & F.col("event.seq").isNotNull())
    opens = F.col("event.rank") == 0
    resets = F.col("event.rank") < len(RESETS)
    folded = log.groupBy("conv_id", "msg").agg(
        F.min(F.when(opens, F.struct("event.seq", "role", "event.text"))).alias("opened"),
        F.max(F.when(resets, F.col("event"))).alias("last"),
        F.sort_array(F.collect_list("event")).alias("events"),
    )
    since = F.filter("events", lambda e: e >= F.col("last"))
    # A regenerate event empties the message; its own text does not count.
    said = F.transform(
        since, lambda e: F.when(e["rank"] == RESETS.index("regenerate"), F.lit("")).otherwise(e["text"])
    )
    return folded.where("opened is not null").select(
        "conv_id",
        "msg",
        F.col("opened.seq").alias("seq"),
        F.col("opened.role").alias("role"),
        F.array_join(said, "").alias("text"),
    )


def render(messages: DataFrame, trained: str = "assistant") -> DataFrame:
    """``conv_id``, ``formatted`` and ``loss_mask``, one flag per turn.

    ``messages`` has ``conv_id``, ``seq``, ``role``, ``text``; turns are in the order of
    ``seq``, then role, text and ``msg``. A turn is its role and text, escaped, between
    the template's marks; null roles and texts are empty. The flag is set where the text
    of a turn is to be learned. A conversation is one row of the result, so it has to
    fit one: 2 GB of text.
    """
    turn = F.struct(
        F.col("seq").alias("seq"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.col("msg").alias("msg"),
    )
    gathered = messages.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    body = F.transform(
        "turns",
        lambda t: F.concat(
            F.lit(OPEN), escape(t["role"]), F.lit(BETWEEN), escape(t["text"]), F.lit(CLOSE)
        ),
    )
    return gathered.select(
        "conv_id",
        F.array_join(body, "").alias("formatted"),
        F.transform("turns", lambda t: t["role"] == trained).alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``turns`` (role, text, loss), parsed from the rendered string and mask."""
    parts = F.split(F.col("formatted"), _quoted(CLOSE), -1)
    bodies = F.slice(parts, 1, F.size(parts) - 1)
    fields = F.transform(bodies, lambda b: F.split(F.substring(b, len(OPEN) + 1, 2**31 - 1), _quoted(BETWEEN), -1))
    return formatted.withColumn(
        "turns",
        F.zip_with(
            fields,
            F.col("loss_mask"),
            lambda f, m: F.struct(
                unescape(f[0]).alias("role"), unescape(f[1]).alias("text"), m.alias("loss")
            ),
        ),
    )
