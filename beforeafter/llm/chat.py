"""Chat formatting from an event log.

A conversation is a log of events, ordered by ``seq``:

* ``message``: a whole message;
* ``delta``: text streamed onto the message named by ``message``;
* ``edit``: that message's text is replaced;
* ``regenerate``: that message starts anew, empty.

Folding: a message's text is what came since its last ``message``, ``edit`` or
``regenerate`` event.  A message stands where its first event stood.  An edit or a
regeneration takes back the conversation to its message: messages that were begun
after that message and before the event are dropped.

Rendering: one piece per turn, ``<s>[role]text</s>`` and a newline.  Inside roles
and texts the characters that control strings begin with are escaped, so no
control string can occur in them, and unescaping gives the text back.  The loss
mask is the span of an assistant's text in its piece.  A conversation's formatted
text is its pieces in order; pieces stay rows, so no conversation has to fit into
one value.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beforeafter.llm.common import arrow_rows, ship_package, stage

#: The template: what opens a turn, ends its role, ends the turn.
OPEN, ROLE_END, CLOSE = "<s>[", "]", "</s>\n"
#: Escapes, the escape character first.
ESCAPES = [("\\", "\\\\"), ("<", "\\l"), ("[", "\\o"), ("]", "\\c")]
RESETS = ("message", "edit", "regenerate")


def escape(text: Column) -> Column:
    """Text without control strings (JVM side)."""
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    if "\\" not in text:
        return text
    plain = {coded[1]: p for p, coded in ESCAPES}
    parts = text.split("\\")
    out, k = [parts[0]], 1
    while k < len(parts):
        if parts[k]:
            out.append(plain[parts[k][0]] + parts[k][1:])
            k += 1
        else:  # an escaped backslash: the next part is plain
            out.append("\\" + parts[k + 1])
            k += 2
    return "".join(out)


def events_of(conversations: DataFrame) -> DataFrame:
    """Event log of a table with one row per turn: every row a ``message`` event
    without an id (``fold_events`` gives it one of its own)."""
    return conversations.select(
        "conv_id",
        F.col("turn").alias("seq"),
        F.lit("message").alias("kind"),
        F.lit(None).cast("string").alias("message"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )


def own_id(seq: Column, role: Column, text: Column) -> Column:
    """Id of a message event that names no message: a digest of its seq, role and
    text, so that a rerun task gives the same id again."""
    role = F.coalesce(F.concat(F.char_length(role).cast("string"), F.lit(":"), role), F.lit("-"))
    return F.sha2(F.concat(F.coalesce(seq.cast("string"), F.lit("-")), F.lit("/"), role, F.lit("/"), text), 256)


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, at (seq of the first event), role, text.

    ``events`` has conv_id, seq, kind, message, role, text; further columns are
    ignored.  Of one message's events with the same seq, deltas come last; otherwise
    kind and text decide.  Unknown kinds are ignored.  A message event without a
    message id is a message of its own; its repeats fold together and stand as often
    as they came.  Other events without an id are ignored.  The role is that of the
    first event that has one.  Null texts are empty, a null seq comes first, a null
    conv_id is a conversation.  No events, no messages.

    Events move once, to their conversation, and every step after keeps that place:
    versions and texts are built per message (a task holds the pieces of one
    message's last version, which are its text), and a running maximum along each
    conversation drops what was taken back; rows are sorted and spilled, not held.
    """
    named = F.col("message").isNotNull()
    events = events.select(
        "conv_id", "seq", "kind", "message", "role", F.coalesce("text", F.lit("")).alias("text")
    ).where(F.col("kind").isin(*RESETS, "delta") & (named | (F.col("kind") == "message")))
    events = events.repartition("conv_id").withColumn("named", named)
    events = events.withColumn("message", F.coalesce("message", own_id(F.col("seq"), F.col("role"), F.col("text"))))
    key = ["conv_id", "named", "message"]
    late = F.col("kind") == "delta"  # at one seq, deltas follow what starts the message
    by_order = Window.partitionBy(*key).orderBy("seq", late, "kind", "text").rowsBetween(Window.unboundedPreceding, 0)
    versions = events.withColumn("version", F.sum(F.col("kind").isin(*RESETS).cast("int")).over(by_order))
    versions = versions.withColumn("last", F.max("version").over(Window.partitionBy(*key)))
    said = F.struct("seq", late.alias("late"), "kind", "text")
    shown = (F.col("version") == F.col("last")) & (F.col("kind") != "regenerate")
    built = versions.groupBy(*key).agg(
        F.min("seq").alias("at"),
        F.max(F.when(F.col("kind").isin("edit", "regenerate"), F.col("seq"))).alias("until"),
        F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "kind", "role"))).alias("first"),
        F.sort_array(F.collect_list(F.when(shown, said))).alias("parts"),
        F.when(F.col("named"), F.lit(1)).otherwise(F.count(F.lit(1))).alias("times"),
    )
    built = built.select(
        "conv_id", "at", "until", F.col("first.role").alias("role"), F.array_join("parts.text", "").alias("text"), "times"
    )
    # a message begun at p is gone if some event at q took back a message begun before p, p < q
    earlier = Window.partitionBy("conv_id").orderBy("at").rangeBetween(Window.unboundedPreceding, -1)
    kept = built.withColumn("undone", F.max("until").over(earlier)).where(
        ~F.coalesce(F.col("undone") > F.col("at"), F.lit(False))
    )
    repeats = F.explode(F.sequence(F.lit(1), F.col("times"))).alias("copy")
    return kept.select("conv_id", "at", "role", "text", repeats).drop("copy")


def render(turns: DataFrame) -> DataFrame:
    """One piece per turn: conv_id, at, role, text, piece, loss_from, loss_to.

    The loss span counts code points of the piece and is empty (0, 0) for roles
    other than assistant.  A null role is rendered as an empty one.
    """
    head = F.concat(F.lit(OPEN), escape(F.coalesce("role", F.lit(""))), F.lit(ROLE_END))
    body = escape(F.col("text"))
    learned = F.coalesce(F.col("role") == "assistant", F.lit(False))
    start = F.when(learned, F.char_length(head)).otherwise(0)
    return turns.select(
        "conv_id",
        "at",
        "role",
        "text",
        F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        start.alias("loss_from"),
        (start + F.when(learned, F.char_length(body)).otherwise(0)).alias("loss_to"),
    )


def format_events(events: DataFrame) -> DataFrame:
    """Fold an event log and render it: rows of ``render``; the pieces of a
    conversation in the order of at, role, text are its formatted text.  No rows in,
    no rows out; a null conv_id is a conversation."""
    return render(fold_events(events))


def parse_piece(piece: str) -> tuple[str, str]:
    """Role and text read back from a piece."""
    if not (piece.startswith(OPEN) and piece.endswith(CLOSE)):
        raise ValueError("not a turn")
    end = piece.index(ROLE_END, len(OPEN))
    return unescape(piece[len(OPEN) : end]), unescape(piece[end + len(ROLE_END) : len(piece) - len(CLOSE)])


def digests(pieces: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted pieces: conv_id, n_turns,
    turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Conversations are sorted inside their partition and read as a stream: hashes
    grow turn by turn, so a conversation of any length costs the memory of a batch.
    A digest over all turns in order needs one task to see them all, so the longest
    conversation bounds the time.
    """
    ship_package(pieces.sparkSession)
    schema = T.StructType(
        [
            T.StructField("conv_id", pieces.schema["conv_id"].dataType),
            T.StructField("n_turns", T.LongType()),
            T.StructField("turns_sha256", T.StringType()),
            T.StructField("loss_chars", T.LongType()),
            T.StructField("loss_sha256", T.StringType()),
            T.StructField("formatted_chars", T.LongType()),
        ]
    )

    def read(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        conv: object = None
        state: list | None = None

        def done():
            n, turns, chars, loss, total = state
            return (conv, n, turns.hexdigest(), chars, loss.hexdigest(), total)

        for batch in batches:
            out = []
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts, ends = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for c, piece, a, b in zip(ids, texts, starts, ends):
                if state is None or c != conv:
                    if state is not None:
                        out.append(done())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_piece(piece)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                learned = unescape(piece[a:b])
                state[2] += len(learned)
                state[3].update(learned.encode())
                state[4] += len(piece)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*out), arrow)], schema=arrow)
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(done(), arrow)], schema=arrow)

    ordered = (
        pieces.repartition("conv_id")
        .sortWithinPartitions("conv_id", "at", "role", "text")
        .select("conv_id", "piece", "loss_from", "loss_to")
    )
    with arrow_rows(pieces.sparkSession, 1000):
        return stage(ordered.mapInArrow(read, schema), "chat-digests")
