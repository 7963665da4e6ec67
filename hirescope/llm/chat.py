r"""Chat formatting from an event log.

A conversation is what its log says happened.  An event has ``conv_id``,
``message`` (the message's place in the conversation), ``seq`` (the order of
events; ``step`` orders events of one ``seq``), ``kind``, ``role``, ``text``:

* ``start``, ``edit``, ``regenerate`` set a message: its role (null: the one it
  had) and the beginning of its text, in place of what stood there, and drop
  every message after it that was set earlier;
* ``delta`` appends to the message's text; before any start it is ignored;
* any other kind is ignored.

So a message counts if no message before it was set later than it was: one
running maximum along the conversation.  The log is dealt by conversation and
by ``width`` places in it, sorted by place and sequence, and folded in one
streaming pass, so no conversation has to fit in memory and a very long one is
folded and rendered by many tasks.  What a later stretch must know of the
earlier ones (when their messages were last set) is one number, which goes
ahead as a marker row of the stretch.

Rendered, a turn is ``### role: text</turn>`` and a line feed.  A backslash
goes before each backslash, ``###`` and ``</turn>`` in a text, and before each
backslash and colon in a role, so no text can look like a turn and the output
can be read back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

from hirescope.llm.common import materialise, ship_package

SETS = ("start", "edit", "regenerate")
LOSS_ROLES = ("assistant",)
_TEXT_CONTROLS = re.compile(r"\\|###|</turn>")
_ROLE_CONTROLS = re.compile(r"[\\:]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(r"### ((?:[^\\:]|\\.)*+): ((?:[^\\<]|\\.|<(?!/turn>))*+)</turn>\n", re.DOTALL)

_SPAN = StructType([StructField("start", LongType()), StructField("end", LongType())])
PARTS = StructType([
    StructField("conv_id", LongType()), StructField("split", BooleanType()), StructField("stretch", LongType()),
    StructField("part", LongType()), StructField("n_turns", LongType()), StructField("text", StringType()),
    StructField("loss", ArrayType(_SPAN))])
DIGESTS = StructType([
    StructField("conv_id", LongType()), StructField("n_turns", LongType()), StructField("turns_sha256", StringType()),
    StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()),
    StructField("formatted_chars", LongType())])


def render_turn(role: str | None, text: str | None) -> tuple[str, int, int]:
    """A turn as output text, and the span of the message's text in it."""
    head = "### " + _ROLE_CONTROLS.sub(r"\\\g<0>", role or "") + ": "
    body = _TEXT_CONTROLS.sub(r"\\\g<0>", text or "")
    return head + body + "</turn>\n", len(head), len(head) + len(body)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def read_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and text of each turn of an output text."""
    at = 0
    while at < len(text):
        m = _TURN.match(text, at)
        if m is None:
            raise ValueError("not an output of this template")
        yield unescape(m[1]), unescape(m[2])
        at = m.end()


def _sends(rows: Iterable[tuple], schema: StructType, text: int) -> Iterator[pa.RecordBatch]:
    """Batches of rows, of about four million characters of field ``text`` each."""
    kinds = to_arrow_schema(schema)
    out, chars = [], 0

    def send() -> pa.RecordBatch:
        cols = list(zip(*out)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(cols, kinds)], names=schema.names)

    for row in rows:
        out.append(row)
        chars += len(row[text] or "")
        if len(out) >= 1000 or chars >= 4 << 20:
            yield send()
            out, chars = [], 0
    yield send()


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, 256).columns))


def fold(events: Iterable[tuple]) -> Iterator[tuple[tuple, list[tuple[str | None, str]]]]:
    """Live messages of sorted rows ``(conv_id, stretch, split, marker, place,
    seq, step, kind, role, text)``: (key, [(role, text)]) with one message at
    a time, and an empty list at the beginning of every stretch."""
    key = place = None
    top = last = None            # when any message, this message was last set
    role, pieces = None, []

    def ended() -> list[tuple[str | None, str]]:
        return [(role, "".join(pieces))] if last is not None and (top is None or last >= top) else []

    for *k, marker, at, seq, step, kind, who, text in events:
        if k != key or at != place:
            if live := ended():
                yield key, live
            if last is not None:
                top = last if top is None else max(top, last)
            if k != key:
                key, top = k, None
                yield key, []
            place, last, role, pieces = at, None, None, []
        if marker:
            top = None if seq is None else (seq, step)
        elif kind in SETS:
            last, role, pieces = (seq, step), who if who is not None else role, [text or ""]
        elif kind == "delta" and last is not None:
            pieces.append(text or "")
    if live := ended():
        yield key, live


def conversations(events: DataFrame, width: int = 4096, part_chars: int = 1 << 20,
                  loss_roles: tuple[str, ...] = LOSS_ROLES) -> DataFrame:
    """Fold and render a log: rows ``conv_id, split, stretch, part, n_turns, text, loss``.

    A conversation's output is the ``text`` of its rows in the order of
    ``stretch, part``; most have one row, and ``split`` says that there is more
    than one stretch.  Rows are cut between turns, after ``part_chars`` code
    points.  ``loss`` are spans of ``text``: the texts of messages whose role
    is one of ``loss_roles``, as escaped there.

    ``events`` may have columns ``tie`` and ``copy`` that part messages of one
    place.  Null ids are a conversation, a null place comes before all others,
    null sequences before all others, null texts are empty, a null role is
    an empty one; other columns are not read.  A conversation without messages gives one row of no text.
    """
    ship_package(events.sparkSession)
    have = set(events.columns)
    least = F.lit(-1 << 62)

    def number(name: str, null: Column) -> Column:
        return F.coalesce(F.col(name).cast("long"), null) if name in have else F.lit(0).cast("long")

    log = events.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.floor(number("message", F.lit(-1)) / width).alias("stretch"),
        F.struct(number("message", F.lit(-1)).alias("message"), number("tie", F.lit(0)).alias("tie"),
                 number("copy", F.lit(0)).alias("copy")).alias("place"),
        number("seq", least).alias("seq"), number("step", least).alias("step"), "kind", "role", "text")

    # When messages were last set, by stretch; of conversations of several stretches only.
    each = Window.partitionBy("conv_id")
    last = (log.groupBy("conv_id", "stretch")
            .agg(F.max(F.when(F.col("kind").isin(*SETS), F.struct("seq", "step"))).alias("last"))
            .select("*", F.count("*").over(each).alias("stretches"),
                    F.max("last").over(each.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)).alias("top"))
            .where("stretches > 1"))
    none = F.lit(None)
    markers = last.select("conv_id", "stretch", F.lit(0).alias("order"), none.cast(log.schema["place"].dataType).alias("place"),
                          "top.seq", "top.step", none.cast("string").alias("kind"), none.cast("string").alias("role"),
                          none.cast("string").alias("text"))
    rows = (log.select("conv_id", "stretch", F.lit(1).alias("order"), "place", "seq", "step", "kind", "role", "text")
            .unionByName(markers).repartition("conv_id", "stretch")
            .sortWithinPartitions("conv_id", "stretch", "order", "place", "seq", "step")
            .select("conv_id", "stretch", "order", "place.message", "place.tie", "place.copy", "seq", "step", "kind", "role", "text"))

    def sorted_events(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        key, split = None, False
        for conv, stretch, order, message, tie, copy, *rest in _rows(batches):
            if key != (conv, stretch):
                key, split = (conv, stretch), order == 0
            yield conv, stretch, split, order == 0, (message, tie, copy), *rest

    def rendered(events: Iterable[tuple]) -> Iterator[tuple]:
        key, part, n, pieces, spans, size = None, 0, 0, [], [], 0
        for k, live in fold(events):
            if not live:
                if key is not None and (n or not part):
                    yield *key, part, n, "".join(pieces), spans
                key, part, n, pieces, spans, size = (k[0], k[2], k[1]), 0, 0, [], [], 0
            for role, text in live:
                turn, start, end = render_turn(role, text)
                if role in loss_roles:
                    spans.append({"start": size + start, "end": size + end})
                pieces.append(turn)
                n, size = n + 1, size + len(turn)
                if size >= part_chars:
                    yield *key, part, n, "".join(pieces), spans
                    part, n, pieces, spans, size = part + 1, 0, [], [], 0
        if key is not None and (n or not part):
            yield *key, part, n, "".join(pieces), spans

    return rows.mapInArrow(lambda batches: _sends(rendered(sorted_events(batches)), PARTS, 5), PARTS)


def _digest(rows: Iterable[tuple], whole: bool) -> Iterator[tuple]:
    """A row of digests per conversation, before the columns of its parts;
    parts of split conversations pass as they are unless ``whole``."""
    key, n, chars, size, turns, loss = None, 0, 0, 0, None, None
    parts, made = (None,) * len(PARTS), (None,) * len(DIGESTS)
    for row in rows:
        conv, split, _, _, _, text, spans = row
        if split and not whole:
            yield *made, *row
            continue
        if turns is None or conv != key:
            if turns is not None:
                yield key, n, turns.hexdigest(), chars, loss.hexdigest(), size, *parts
            key, n, chars, size, turns, loss = conv, 0, 0, 0, hashlib.sha256(), hashlib.sha256()
        for role, said in read_turns(text):
            turns.update(f"{role}\n{said}\n".encode())
            n += 1
        for span in spans:
            masked = unescape(text[span["start"]:span["end"]])
            loss.update(masked.encode())
            chars += len(masked)
        size += len(text)
    if turns is not None:
        yield key, n, turns.hexdigest(), chars, loss.hexdigest(), size, *parts


def digests(parts: DataFrame) -> DataFrame:
    """``conv_id`` and the digests of what can be read back from the output:
    ``n_turns``; ``turns_sha256`` of role, line feed, text, line feed per turn;
    ``loss_chars`` and ``loss_sha256`` of all text under the mask, unescaped;
    ``formatted_chars``.  One row per conversation.

    Conversations of one stretch are read where they were rendered.  The rows
    of others are written, sorted and read as a stream: a digest is a chain,
    so one task reads a conversation, but only rendered text, a part at a time.
    """
    ship_package(parts.sparkSession)
    both = StructType([*DIGESTS, *[StructField(f"part_{f.name}", f.dataType) for f in PARTS]])

    def step(df: DataFrame, whole: bool) -> DataFrame:
        return df.mapInArrow(lambda batches: _sends(_digest(_rows(batches), whole), both, len(DIGESTS) + 5), both)

    first = materialise(step(parts.select(PARTS.names), False))
    rest = (first.where("part_split").select([F.col(f"part_{c}").alias(c) for c in PARTS.names])
            .repartition("conv_id").sortWithinPartitions("conv_id", "stretch", "part"))
    return (first.where("part_split is null").select(DIGESTS.names)
            .unionByName(step(rest, True).select(DIGESTS.names)))


def as_events(turns: DataFrame, delta_chars: int = 1024, draft_chars: int = 16) -> DataFrame:
    """The log of a chat that ended as ``turns`` (``conv_id, turn, role, text``):
    assistant messages begin, are regenerated and streamed in pieces; all others are
    begun and edited.  Rows of one turn are messages of their own, in the
    order of a hash of role and text; equal rows stay as many as they are."""
    text, role = F.coalesce(F.col("text").cast("string"), F.lit("")), F.coalesce(F.col("role").cast("string"), F.lit(""))
    draft = F.left("text", F.lit(draft_chars))
    # At most 64 pieces a text: a piece is found by counting from the text's beginning.
    size = F.greatest(F.lit(delta_chars), F.ceil(F.char_length("text") / 64).cast("int"))

    def event(step: Column, kind: str, said: Column) -> Column:
        return F.struct(step.cast("long").alias("step"), F.lit(kind).alias("kind"), said.alias("text"))

    pieces = F.transform(F.sequence(F.lit(0), F.floor((F.char_length("text") - 1) / F.col("size")).cast("int")),
                         lambda i: event(i + 3, "delta", F.substring(F.col("text"), i * F.col("size") + 1, F.col("size"))))
    streamed = F.concat(F.array(event(F.lit(0), "start", F.lit("")), event(F.lit(1), "delta", draft),
                                event(F.lit(2), "regenerate", F.lit(""))),
                        F.when(F.col("text") == "", F.array().cast("array<struct<step:bigint,kind:string,text:string>>")).otherwise(pieces))
    edited = F.array(event(F.lit(0), "start", draft), event(F.lit(1), "edit", F.col("text")))
    return (turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("message"),
                         role.alias("role"), text.alias("text"))
            .select("*", F.xxhash64("role", "text").alias("tie"), F.monotonically_increasing_id().alias("copy"),
                    size.alias("size"))
            .select("conv_id", "message", "tie", "copy", F.col("message").alias("seq"), "role",
                    F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(edited)).alias("e"))
            .select("conv_id", "message", "tie", "copy", "seq", "e.step", "e.kind", "role", "e.text"))
