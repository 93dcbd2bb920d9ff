"""Chat formatting by columnar byte assembly.

A conversation is the text of its turns in order: ``[INST]text[/INST]`` for a user, ``<s>text</s>`` for an assistant,
``[ROLE=role]text[/ROLE]`` for any other role.  Inside texts a backslash is doubled and every control string gets a
backslash after its first character, so none is left and the text can be read back.

Turns are dealt and sorted by conversation.  Per batch the lengths of all segments (header, text, footer) and their
cumulative offsets are worked out in numpy, and headers and contents are copied into one buffer, which becomes the Arrow
column.  The loss mask lists the spans of the assistants' texts, in characters.

A conversation of up to PART_BYTES is one row, part 0.  The turns of a longer one are dealt over tasks by their order and
make a row for about every PART_BYTES: parts above 0, which in ascending order (with gaps) give the conversation; turns
are whole, and the loss mask counts from the beginning of its part.

Null texts are empty, null roles are the empty role, null turns come first, rows without conv_id are one conversation
without id; equal rows are turns of their own; ties in turn are ordered by role and text.  Extra columns are ignored;
an empty table has no conversations.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CONTROL = ("[INST]", "[/INST]", "<s>", "</s>", "[ROLE=", "[/ROLE]")
FORMATTED = "conv_id long, part long, n_turns long, formatted string, loss array<struct<start:int,length:int>>"
PART_BYTES = 1 << 20  # of roles and texts; more make a conversation a long one
TURN_BYTES = 16  # what a turn counts besides
SLICE = 1 << 20  # bytes copied by one set of index arrays
LONG_SEGMENT = 1 << 14
DEALT_CHARS = 64
TURN = re.compile(r"\[INST\](.*?)\[/INST\]|<s>(.*?)</s>|\[ROLE=((?:[^\\\]]|\\.)*)\](.*?)\[/ROLE\]", re.S)


def escaped(texts: pa.Array) -> pa.Array:
    out = pc.replace_substring(texts, "\\", "\\\\")
    for control in CONTROL:
        out = pc.replace_substring(out, control, control[0] + "\\" + control[1:])
    return out


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def headers(roles: pa.Array) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the text of each turn."""
    user, assistant = pc.equal(roles, "user"), pc.equal(roles, "assistant")
    name = pc.replace_substring(pc.replace_substring(roles, "\\", "\\\\"), "]", "\\]")
    other = pc.binary_join_element_wise("[ROLE=", name, "]", "")
    before = pc.if_else(user, "[INST]", pc.if_else(assistant, "<s>", other))
    return before, pc.if_else(user, "[/INST]", pc.if_else(assistant, "</s>", "[/ROLE]"))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), offsets[:-1], np.diff(offsets)


def placed(buffer: np.ndarray, begin: np.ndarray, data: np.ndarray, source: np.ndarray, size: np.ndarray) -> None:
    """Copy the segments to where they begin: long ones one by one, the others by index arrays of at most SLICE bytes."""
    for k in np.flatnonzero(size > LONG_SEGMENT):
        buffer[begin[k]:begin[k] + size[k]] = data[source[k]:source[k] + size[k]]
    few = np.flatnonzero((size > 0) & (size <= LONG_SEGMENT))
    if not len(few):
        return
    slices = np.cumsum(size[few]) // SLICE
    for some in np.split(few, np.flatnonzero(np.diff(slices)) + 1):
        n = size[some]
        steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        buffer[np.repeat(begin[some], n) + steps] = data[np.repeat(source[some], n) + steps]


def assemble(roles: pa.Array, texts: pa.Array, first: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The formatted conversations (or parts), which begin at the turns ``first``, and their loss masks."""
    body = escaped(texts.cast(pa.large_string()))
    before, after = headers(roles)
    segments = [_bytes(c) for c in (before, body, after)]
    n = len(texts)
    sizes = np.stack([s[2] for s in segments], 1).reshape(-1)
    ends = np.cumsum(sizes)
    begin = (ends - sizes).reshape(n, 3)
    buffer = np.empty(int(ends[-1]) if n else 0, np.uint8)
    for k, (data, source, size) in enumerate(segments):
        placed(buffer, begin[:, k], data, source, size)
    bounds = np.append(begin[first, 0], len(buffer))
    strings = pa.Array.from_buffers(pa.large_string(), len(first), [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(buffer)])
    # The same lengths in characters.
    length, head, foot = (pc.utf8_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (body, before, after))
    turn = head + length + foot
    at = np.cumsum(turn) - turn
    conversation = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    marked = np.flatnonzero(pc.equal(roles, "assistant").to_numpy(zero_copy_only=False))
    start = at[marked] + head[marked] - at[first][conversation[marked]]
    spans = pa.StructArray.from_arrays([pa.array(start, pa.int32()), pa.array(length[marked], pa.int32())], names=["start", "length"])
    offsets = np.searchsorted(conversation[marked], np.arange(len(first) + 1))
    return strings.cast(pa.string()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, part, n_turns, formatted, loss."""
    limit = PART_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() + 1 << 32
        held: list[pa.RecordBatch] = []  # the turns of a part that may go on in the next batch
        total, part = 0, 0  # bytes of the conversation so far in this task, part of its last turn

        def done(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
            ids, roles, texts, long, number = (c.combine_chunks() for c in pa.Table.from_batches(batches).combine_chunks().columns)
            numbers = number.to_numpy()
            first = np.flatnonzero(np.append(True, changed(ids) | (numbers[1:] != numbers[:-1])))
            strings, loss = assemble(roles, texts, first)
            turns_ = np.diff(np.append(first, len(ids)))
            parts = np.where(long.to_numpy(zero_copy_only=False), task + numbers, 0)[first]
            return pa.RecordBatch.from_arrays([ids.take(pa.array(first)), pa.array(parts), pa.array(turns_), strings, loss], names=["conv_id", "part", "n_turns", "formatted", "loss"])

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, roles, texts = (batch.column(c) for c in range(3))
            size = sum(pc.binary_length(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (roles, texts)) + TURN_BYTES
            new = np.append(not (held and same(held[-1].column(0)[-1], ids[0])), changed(ids))
            below = np.cumsum(size) - size
            below -= np.maximum.accumulate(np.where(new, below, -total))
            number = below // limit
            starts = np.flatnonzero(new | (np.append(part, number[:-1]) != number))
            total, part = int(below[-1] + size[-1]), int(number[-1])
            batch = pa.RecordBatch.from_arrays([*batch.columns, pa.array(number)], names=["conv_id", "role", "text", "long", "number"])
            # Whole parts are assembled together as long as they are not much over the bytes of one part.
            if len(starts):
                group = (np.cumsum(size) - size)[starts] // limit
                cuts = [int(starts[0]), *starts[1:][group[1:] != group[:-1]].tolist()]
                if cuts[-1] != starts[-1]:
                    cuts.append(int(starts[-1]))
                if held or cuts[0]:
                    yield done([*held, batch.slice(0, cuts[0])])
                    held = []
                for a, b in zip(cuts, cuts[1:]):
                    yield done([batch.slice(a, b - a)])
                batch = batch.slice(cuts[-1])
            held.append(batch)
        if held:
            yield done(held)

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), "turn")
    size = (F.octet_length("role") + F.octet_length("text")).cast("long") + TURN_BYTES
    long = rows.groupBy("conv_id").agg(F.sum(size).alias("bytes")).filter(F.col("bytes") > limit)
    long = F.broadcast(long.select(F.col("conv_id").alias("long_id"), F.lit(True).alias("long")))  # at most one id for each PART_BYTES of input
    rows = rows.join(long, F.col("conv_id").eqNullSafe(F.col("long_id")), "left").withColumn("long", F.coalesce("long", F.lit(False)))
    # A short conversation is in one range; a long one is dealt out by what its turns are ordered by.
    within = F.substring("text", 1, DEALT_CHARS)
    salt = F.when(F.char_length("text") <= DEALT_CHARS, F.monotonically_increasing_id())  # equal rows have no order
    keys = [F.when(F.col("long"), k).alias(f"key{i}") for i, k in enumerate((F.col("turn"), F.col("role"), within, salt))]
    rows = rows.select("conv_id", "role", "text", "long", "turn", *keys)
    rows = rows.repartitionByRange("conv_id", *(f"key{i}" for i in range(len(keys))))
    rows = rows.sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text", "long")
    return rows.mapInArrow(run, FORMATTED)


def same(a: pa.Scalar, b: pa.Scalar) -> bool:
    return a.as_py() == b.as_py()


def changed(ids: pa.Array) -> np.ndarray:
    """Where an id differs from the one before; null is an id like others."""
    values, null = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
    return (values[1:] != values[:-1]) | (null[1:] != null[:-1])


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns (role, text) of a formatted conversation."""
    out, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("text between turns")
        at = m.end()
        if m[1] is not None:
            out.append(("user", unescaped(m[1])))
        elif m[2] is not None:
            out.append(("assistant", unescaped(m[2])))
        else:
            out.append((unescaped(m[3]), unescaped(m[4])))
    if at != len(formatted):
        raise ValueError("text after the turns")
    return out


READ = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
READ_KINDS = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
PIECES = "conv_id long, part long, n_turns long, said binary, learned binary, loss_chars long, formatted_chars long"
PIECE_KINDS = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64())


def arrow_rows(rows: list[tuple], kinds: tuple, schema: str) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in schema.split(", ")])


def read_back(formatted: DataFrame) -> DataFrame:
    """From formatted conversations: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.  Parts are
    parsed where they are; only their digests are continued from part to part."""
    def parsed(batch: pa.RecordBatch) -> Iterator[tuple]:
        for r in range(batch.num_rows):
            conv, part, text, loss = (batch.column(c)[r].as_py() for c in range(4))
            turns = parse(text)
            learned = "".join(unescaped(text[s["start"]:s["start"] + s["length"]]) for s in loss)
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            yield conv, part, len(turns), whole.encode(), learned.encode(), len(learned), len(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(conv, n, hashlib.sha256(said).hexdigest(), loss, hashlib.sha256(learned).hexdigest(), chars)
                    for conv, _, n, said, learned, loss, chars in parsed(batch)]
            yield arrow_rows(rows, READ_KINDS, READ)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in parsed(batch):
                yield arrow_rows([row], PIECE_KINDS, PIECES)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            for r in range(batch.num_rows):
                conv, n, loss, chars = (batch.column(c)[r].as_py() for c in (0, 2, 5, 6))
                if last is None or conv != last[0]:
                    if last is not None:
                        yield arrow_rows([(last[0], last[1], said.hexdigest(), last[2], learned.hexdigest(), last[3])], READ_KINDS, READ)
                    last, said, learned = [conv, 0, 0, 0], hashlib.sha256(), hashlib.sha256()
                for k, more in enumerate((n, loss, chars), 1):
                    last[k] += more
                said.update(batch.column(3)[r].as_buffer())
                learned.update(batch.column(4)[r].as_buffer())
        if last is not None:
            yield arrow_rows([(last[0], last[1], said.hexdigest(), last[2], learned.hexdigest(), last[3])], READ_KINDS, READ)

    formatted = formatted.select("conv_id", "part", "formatted", "loss")
    parts = formatted.filter("part > 0").mapInArrow(pieces, PIECES)
    parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return formatted.filter("part = 0").mapInArrow(run, READ).unionByName(parts.mapInArrow(digest, READ))
