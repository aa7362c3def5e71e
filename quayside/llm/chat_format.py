"""Chat formatting by columnar byte assembly.

A turn becomes ``<s>[INST]role[/INST]text</s>``. Control strings inside roles and texts are
escaped by a backslash after their first character (and one more where backslashes already stand there), so that the
output parses back without loss.

Assembly is columnar: for a block of turns the lengths of all headers, contents and
footers are known, a cumulative sum gives each segment's place in one preallocated
output buffer, and numpy scatter indices copy whole columns of segments into it. The buffer becomes
an Arrow string column by its offsets, without a Python string per turn.

The table is ranged by (conversation, turn), so a conversation that holds a third of all rows is
dealt over many tasks. A conversation is one row unless a task's border or ``PART`` bytes cut it;
its parts then carry rising ``part`` numbers and ``whole`` is false.

Defined results: null roles and texts count as empty, null ids and turns as themselves (first). Rows that repeat a turn
are all kept, by turn, role, text. An empty table gives an empty result. Other input columns are ignored.
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

HEAD, MIDDLE, TAIL = b"<s>[INST]", b"[/INST]", b"</s>"
CONTROL = r"(s>|/s>|INST\]|/INST\])"
LOSS_ROLE = "assistant"
PART = 4 << 20
ROWS = 4096

FORMATTED = (
    "conv_id {kind}, part long, whole boolean, text string, n_turns long, "
    "loss array<struct<start:int,end:int>>"
)  # loss: byte ranges of the part's text

_ESCAPED = re.compile(r"([<\[])\\(\\*)" + CONTROL)


def escape(column: pa.Array) -> pa.Array:
    """Columnar escape of control strings."""
    return pc.replace_substring_regex(column, pattern=r"([<\[])(\\*)" + CONTROL, replacement=r"\1\\\2\3")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1\2\3", text)


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, data) of a string column without nulls."""
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return offsets, np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.empty(0, np.uint8)


def _copy(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Scatter the segments of a column to the places ``at``."""
    lengths = np.diff(offsets)
    source = np.arange(offsets[0], offsets[-1])
    out[source + np.repeat(at - offsets[:-1], lengths)] = data[offsets[0] : offsets[-1]]


def _fill(out: np.ndarray, at: np.ndarray, literal: bytes) -> None:
    if len(at):
        out[at[:, None] + np.arange(len(literal))] = np.frombuffer(literal, np.uint8)


def assemble(roles: pa.Array, texts: pa.Array, groups: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Formatted strings and loss ranges, one per group. ``groups``: first turn of each group, rising, ending with the number of turns."""
    n = len(texts)
    loss = np.asarray(pc.equal(roles, LOSS_ROLE).to_numpy(zero_copy_only=False), bool)
    role_at, role_data = _bytes_of(escape(roles))
    text_at, text_data = _bytes_of(escape(texts))
    role_len, text_len = np.diff(role_at), np.diff(text_at)
    turn_len = len(HEAD) + role_len + len(MIDDLE) + text_len + len(TAIL)
    start = np.concatenate([[0], np.cumsum(turn_len)])
    role_to = start[:-1] + len(HEAD)
    middle_to = role_to + role_len
    text_to = middle_to + len(MIDDLE)
    out = np.empty(int(start[-1]), np.uint8)
    _fill(out, start[:-1], HEAD)
    _copy(out, role_to, role_data, role_at)
    _fill(out, middle_to, MIDDLE)
    _copy(out, text_to, text_data, text_at)
    _fill(out, text_to + text_len, TAIL)
    bounds = start[groups].astype(np.int32)
    formatted = pa.Array.from_buffers(pa.string(), len(groups) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(out)])
    group = np.searchsorted(groups, np.arange(n), side="right") - 1
    begin = (text_to - start[groups[group]])[loss]
    ranges = pa.StructArray.from_arrays(
        [pa.array(begin.astype(np.int32)), pa.array((begin + text_len[loss]).astype(np.int32))], ["start", "end"]
    )
    per_group = np.concatenate([[0], np.cumsum(np.bincount(group[loss], minlength=len(groups) - 1))])
    return formatted, pa.ListArray.from_arrays(pa.array(per_group.astype(np.int32)), ranges)


def format_chats(chats: DataFrame) -> DataFrame:
    """``chats(conv_id, turn, role, text)`` formatted: see ``FORMATTED``."""
    kind = dict(chats.dtypes)["conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 32
        part, first, split = 0, True, False  # split: the held conversation has given a part already
        held: pa.Table | None = None

        def emit(rows: pa.Table, open_first: bool, open_last: bool) -> pa.RecordBatch:
            nonlocal part
            ids = rows.column("conv_id").combine_chunks()
            new = _changes(ids)
            groups = np.r_[np.flatnonzero(new), len(ids)]
            text, loss = assemble(rows.column("role").combine_chunks(), rows.column("text").combine_chunks(), groups)
            whole = np.ones(len(groups) - 1, bool)
            whole[0] &= not open_first
            whole[-1] &= not open_last
            numbers = base + part + np.arange(len(whole))
            part += len(whole)
            return pa.RecordBatch.from_arrays(
                [ids.take(pa.array(groups[:-1])), pa.array(numbers), pa.array(whole), text, pa.array(np.diff(groups)), loss],
                ["conv_id", "part", "whole", "text", "n_turns", "loss"],
            )

        for batch in batches:
            for rows in _blocks(batch):
                rows = pa.Table.from_batches([rows])
                if held is not None:
                    rows = pa.concat_tables([held, rows])
                last = int(np.flatnonzero(_changes(rows.column("conv_id").combine_chunks()))[-1])
                done, held = rows.slice(0, last), rows.slice(last)
                if len(done):
                    yield emit(done, first or split, False)
                    first = split = False
                if held.nbytes > PART:
                    yield emit(held, True, True)
                    held, split = None, True
                    first = False
        if held is not None and len(held):
            yield emit(held, True, True)

    rows = chats.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = ("conv_id", "turn", "role", "text")
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.drop("turn").mapInArrow(run, FORMATTED.format(kind=kind))


def _changes(ids: pa.Array) -> np.ndarray:
    """Where a value differs from the one before (null equals null)."""
    codes = ids.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
    return np.r_[True, codes[1:] != codes[:-1]]


def _blocks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of at most ``ROWS`` rows and, single rows aside, ``PART`` bytes of text."""
    lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        stop = min(at + ROWS, max(at + 1, int(np.searchsorted(total, before + PART))))
        yield batch.slice(at, stop - at)
        at = stop


_TURN = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)


def read_back(formatted: DataFrame) -> DataFrame:
    """Per conversation, parsed from the formatted parts alone: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars."""
    kind = dict(formatted.dtypes)["conv_id"]
    schema = f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def closed(rows: list) -> pa.RecordBatch:
            done = [(k, s[0], s[1].hexdigest(), s[2], s[3].hexdigest(), s[4]) for k, s in rows]
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in done], id_type), *(pa.array([r[i] for r in done]) for i in range(1, 6))], columns
            )

        id_type = None
        for batch in batches:
            id_type = batch.schema.field("conv_id").type
            for at in range(0, batch.num_rows, 256):
                rows, ready = batch.slice(at, 256).to_pylist(), []
                for row in rows:
                    if state is None or row["conv_id"] != key:
                        if state is not None:
                            ready.append((key, state))
                        key, state = row["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                    state[4] += len(row["text"])
                    for role, text in _TURN.findall(row["text"]):
                        state[0] += 1
                        state[1].update(f"{unescape(role)}\n{unescape(text)}\n".encode("utf-8", "surrogatepass"))
                    raw = row["text"].encode("utf-8", "surrogatepass")
                    for span in row["loss"]:
                        under = unescape(raw[span["start"] : span["end"]].decode("utf-8", "surrogatepass"))
                        state[2] += len(under)
                        state[3].update(under.encode("utf-8", "surrogatepass"))
                if ready:
                    yield closed(ready)
        if state is not None:
            yield closed([(key, state)])

    # whole conversations need no meeting; parts of cut ones meet in order and stream through one running digest
    parts = formatted.filter("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return formatted.filter("whole").mapInArrow(run, schema).union(parts.mapInArrow(run, schema))
