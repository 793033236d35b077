"""Chat formatting by event-sourced reconstruction.

A log of events is partitioned by conversation, sorted by sequence and folded into
the final messages, which are then rendered. Kinds of events:

``message``     opens a message with a role and a text; known already, it is set anew
``delta``       appends streamed text to a message, opening it if needed
``edit``        replaces the text of a message
``regenerate``  empties a message; later deltas stream its new text

Messages stand in the order in which they were opened. The rendered form of one is
``<s>role``, a new line, its text, ``</s>``. Inside roles and texts ``<`` and the
backslash are written as ``\\l`` and ``\\\\`` (in roles the new line as ``\\n``), so
control strings never come from content and can be read back.

A conversation is rendered to one value, so its events are held by one task; those
of other conversations are not.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks of the template.
OPEN, CLOSE = "<s>", "</s>"
#: Fixed value: the role whose texts are trained on.
LEARNED = "assistant"

_UNESCAPED = {"\\\\": "\\", "\\l": "<", "\\n": "\n"}


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("<", "\\l")


def unescape(text: str) -> str:
    return re.sub(r"\\.", lambda m: _UNESCAPED[m[0]], text)


def fold(events: Iterator[tuple]) -> list[tuple[str, str]]:
    """(role, text) of the final messages; events are (message id, kind, role, text) in order.

    Null kinds count as deltas, null texts as empty; a null role leaves the role.
    """
    messages: dict = {}
    for name, kind, role, text in events:
        message = messages.setdefault(name, [role or "", []])
        if kind in ("message", "edit", "regenerate"):
            message[1] = []
        elif kind not in (None, "delta"):
            raise ValueError(f"unknown kind of event: {kind}")
        if kind != "regenerate":
            message[1].append(text or "")
        if role is not None:
            message[0] = role
    return [(role, "".join(parts)) for role, parts in messages.values()]


def render(messages: list[tuple[str, str]]) -> tuple[str, list[dict]]:
    """The formatted conversation and the spans under the loss mask, in code points."""
    parts, spans, at = [], [], 0
    for role, text in messages:
        head, body = OPEN + escape(role).replace("\n", "\\n") + "\n", escape(text)
        if role == LEARNED:
            spans.append({"start": at + len(head), "end": at + len(head) + len(body)})
        parts += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the messages of a formatted conversation."""
    found = []
    for turn in formatted.split(CLOSE)[:-1]:
        role, text = turn.removeprefix(OPEN).split("\n", 1)
        found.append((unescape(role), unescape(text)))
    return found


def format_events(events: DataFrame) -> DataFrame:
    """``(conv_id, formatted, loss)`` from ``(conv_id, seq, message_id, part, kind, role, text)``.

    Events are taken by ``seq``, then ``message_id``, then ``part``, nulls first.
    Events of a null ``conv_id`` make a conversation of their own. An empty log
    gives no conversations; other columns are not looked at.
    """
    kind = events.schema["conv_id"].dataType.simpleString()
    order = ["conv_id", "seq", "message_id", "part"]
    log = events.select(*order, "kind", "role", "text").repartition("conv_id").sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, done = None, [], []
        begun = False
        for batch in batches:
            for conv, _, name, _, what, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if begun and conv != now:
                    done.append((now, *render(fold(held))))
                    held = []
                now, begun = conv, True
                held.append((name, what, role, text))
            if done:
                yield out(done)
                done = []
        if begun:
            yield out([(now, *render(fold(held)))])

    ids = events.schema["conv_id"].dataType
    spans = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def out(rows: list[tuple]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_type

        conv, formatted, loss = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(conv, to_arrow_type(ids)), pa.array(formatted, pa.string()), pa.array(loss, spans)], names=["conv_id", "formatted", "loss"]
        )

    return log.mapInArrow(run, f"conv_id {kind}, formatted string, loss array<struct<start:long,end:long>>")


def turns_as_events(turns: DataFrame) -> DataFrame:
    """The event log of a table ``(conv_id, turn, role, text)``: each turn opened, then streamed to its end.

    Repeated rows are messages of their own, as is a text said again at another turn;
    turns of one number stand in the order of role and text.
    """
    text = F.coalesce("text", F.lit(""))
    once = turns.groupBy("conv_id", "turn", "role", text.alias("text")).agg(F.count("*").alias("n"))
    numbered = once.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    half = F.floor(F.length("text") / 2).cast("int")
    parts = F.array(
        F.struct(F.lit(0).alias("part"), F.lit("message").alias("kind"), F.substring("text", F.lit(1), half).alias("text")),
        F.struct(F.lit(1).alias("part"), F.lit("delta").alias("kind"), F.substring("text", half + 1, F.length("text")).alias("text")),
    )
    name = F.struct(F.col("turn"), F.col("role"), F.hash("text").alias("text_hash"), F.xxhash64("text").alias("text_key"), F.col("copy"))
    return numbered.select("conv_id", F.col("turn").alias("seq"), F.to_json(name).alias("message_id"), "role", F.explode(parts).alias("p")).select(
        "conv_id", "seq", "message_id", "p.part", "p.kind", "role", "p.text"
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What is read back from ``(conv_id, formatted, loss)``: counts and digests of turns and loss texts."""
    ids = formatted.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                text = text.as_py()
                turns = parse(text)
                loss = [unescape(text[s["start"] : s["end"]]) for s in spans.as_py()]
                whole = hashlib.sha256()
                for turn in turns:
                    whole.update("".join(f"{x}\n" for x in turn).encode())
                rows.append((len(turns), whole.hexdigest(), sum(map(len, loss)), hashlib.sha256("".join(loss).encode()).hexdigest(), len(text)))
            names = ["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            columns = [pa.array(x) for x in zip(*rows, strict=True)] if rows else [pa.array([], t) for t in (pa.int64(), pa.string()) * 2 + (pa.int64(),)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["conv_id", *names])

    return formatted.mapInArrow(
        run, f"conv_id {ids}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
