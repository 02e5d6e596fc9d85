"""Chat formatting: turns to training text with a loss mask, assembled column by column."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BEGIN, END = "<|turn|>", "<|end|>\n"
LEARNED = "assistant"
BLOCK_BYTES = 2 << 20

# The openings of control strings here and in other common templates. A backslash goes
# after the first character, and one more where backslashes stand already, so it can be undone.
CONTROL = r"(<|\[)(\\*)(\||/?s>|/?INST\])"
UNCONTROL = r"(<|\[)\\(\\*)(\||/?s>|/?INST\])"
_UNESCAPE = re.compile(UNCONTROL)
_TURN = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(END), re.S)

_FORMATTED = (
    "conv_id long, formatted string, learned array<struct<start: bigint, end: bigint>>"
)
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])


def escape(text: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(text, CONTROL, r"\1\\\2\3")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1\2\3", text)


def escape_role(role: pa.Array) -> pa.Array:
    role = pc.replace_substring(escape(role), "%", "%25")
    return pc.replace_substring(role, "\n", "%0A")


def unescape_role(role: str) -> str:
    return unescape(role.replace("%0A", "\n").replace("%25", "%"))


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, places, values = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _scatter(out: np.ndarray, at: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> None:
    """Copy segment i of ``data`` to ``out[at[i]:]`` for all i at once."""
    out[np.repeat(at - offsets[:-1], np.diff(offsets)) + np.arange(len(data))] = data


def assemble(conv: pa.Array, role: pa.Array, text: pa.Array) -> pa.RecordBatch:
    """One row per run of equal ``conv``: the turns of a conversation, in order, as one text.

    Segment lengths give every segment's place; headers and contents are then copied there by index
    into one buffer, which becomes the Arrow column as it is.
    """
    learned = pc.equal(role.fill_null(""), LEARNED).to_numpy(zero_copy_only=False)
    roles, role_at = _bytes(escape_role(role.fill_null("")))
    texts, text_at = _bytes(escape(text.fill_null("")))
    begin, end = np.frombuffer(BEGIN.encode(), np.uint8), np.frombuffer(END.encode(), np.uint8)
    n = len(conv)
    head = len(begin) + np.diff(role_at) + 1
    length = head + np.diff(text_at) + len(end)
    at = np.concatenate(([0], np.cumsum(length)))
    out = np.empty(at[-1], np.uint8)
    fixed = lambda piece: (np.tile(piece, n), np.arange(n + 1) * len(piece))
    _scatter(out, at[:-1], *fixed(begin))
    _scatter(out, at[:-1] + len(begin), roles, role_at)
    out[at[:-1] + head - 1] = ord("\n")
    _scatter(out, at[:-1] + head, texts, text_at)
    _scatter(out, at[1:] - len(end), *fixed(end))

    first = _firsts(conv)
    place = at[np.append(first, n)]
    owner = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    start = (at[:-1] + head - place[owner])[learned]
    stop = start + np.diff(text_at)[learned]
    counts = np.bincount(owner[learned], minlength=len(first))
    formatted = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(place.astype(np.int64)), pa.py_buffer(out))
    spans = pa.ListArray.from_arrays(
        pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()),
        pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(stop, pa.int64())], fields=list(_SPAN)),
    )
    return pa.RecordBatch.from_arrays(
        [conv.take(pa.array(first)), formatted.cast(pa.string()), spans], names=["conv_id", "formatted", "learned"]
    )


def _firsts(conv: pa.Array) -> np.ndarray:
    """Rows at which a new conversation begins; nulls are one conversation."""
    value = conv.fill_null(0).to_numpy(zero_copy_only=False)
    null = conv.is_null().to_numpy(zero_copy_only=False)
    new = np.ones(len(conv), bool)
    new[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
    return np.flatnonzero(new)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        rows = pa.concat_tables([held, part]) if held is not None else part
        rows = rows.combine_chunks()
        # The last conversation may go on in the next batch.
        last = int(_firsts(rows.column("conv_id").combine_chunks())[-1])
        yield from _blocks(rows.slice(0, last))
        held = rows.slice(last)
    if held is not None:
        yield from _blocks(held)


def _blocks(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """Whole conversations of about ``BLOCK_BYTES`` at a time."""
    if not rows.num_rows:
        return
    conv, role, text = (rows.column(c).combine_chunks() for c in ("conv_id", "role", "text"))
    first = np.append(_firsts(conv), rows.num_rows)
    upto = np.concatenate(([0], np.cumsum(pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False))))
    at = 0
    while at < len(first) - 1:
        to = int(np.searchsorted(upto[first], upto[first[at]] + BLOCK_BYTES, "right")) - 1
        to = min(max(to, at + 1), len(first) - 1)
        here = slice(int(first[at]), int(first[to]))
        yield assemble(conv[here], role[here], text[here])
        at = to


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, learned`` for every conversation of ``turns`` (conv_id, turn, role, text).

    ``learned`` are the byte spans of ``formatted`` that the loss covers: the texts of assistant turns.
    Turns are in order of ``turn``, nulls first; equal ones in order of role and text. A null text or
    role is an empty one, a null conv_id is a conversation of its own, repeated rows are repeated turns.
    A conversation is one value and is assembled in one task. An empty table gives an empty result.
    """
    spread = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text").repartition("conv_id")
    ordered = spread.sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(_format, _FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Role and text of every turn, as they were before formatting."""
    return [(unescape_role(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = {name: [] for name in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for formatted, learned in zip(batch.column("formatted"), batch.column("learned")):
            formatted = formatted.as_py()
            raw = formatted.encode()
            turns = parse(formatted)
            loss = "".join(unescape(raw[s["start"] : s["end"]].decode()) for s in learned.as_py())
            rows["n_turns"].append(len(turns))
            rows["turns_sha256"].append(_sha("".join(f"{role}\n{text}\n" for role, text in turns)))
            rows["loss_chars"].append(len(loss))
            rows["loss_sha256"].append(_sha(loss))
            rows["formatted_chars"].append(len(formatted))
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), *[pa.array(v) for v in rows.values()]], names=["conv_id", *rows]
        )


def digests(formatted: DataFrame) -> DataFrame:
    """What reading the formatted conversations back gives."""
    return formatted.mapInArrow(
        _read_back,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
