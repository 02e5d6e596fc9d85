"""Packing token sequences into windows of a fixed length, online and in bounded space."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .tokens import Encoder, choice, texts_of

CAPACITY = 2048
OPEN_WINDOWS = 64
# Partitions whose leftover windows one merging task takes.
MERGED = 16

_PIECE = "struct<doc_id: bigint, start: bigint, length: bigint, doc_tokens: bigint, offset: bigint, ids: binary>"
_WINDOW = f"window long, used int, open boolean, pieces array<{_PIECE}>"
_ARROW_PIECE = pa.struct(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "doc_tokens", "offset")]
    + [("ids", pa.binary())]
)
_ARROW_WINDOW = pa.schema(
    [("window", pa.int64()), ("used", pa.int32()), ("open", pa.bool_()), ("pieces", pa.list_(_ARROW_PIECE))]
)


class Packer:
    """A fixed number of open windows, best fit first.

    A piece goes to the open window it leaves least room in. If none has room, the fullest is
    emitted when all are in use, and the piece opens a new one. A full window is emitted at once.
    """

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.free: list[int] = []  # sorted, with the windows in the same order
        self.windows: list[list] = []

    def put(self, size: int, pieces: list) -> list[tuple[int, list]]:
        """Place ``pieces`` of ``size`` tokens together; what is emitted for it, as (used, pieces)."""
        out = []
        if size == self.capacity:
            return [(size, pieces)]
        at = bisect_left(self.free, size)
        if at < len(self.free):
            free, window = self.free.pop(at), self.windows.pop(at)
        else:
            if len(self.free) == self.most_open:
                out.append((self.capacity - self.free.pop(0), self.windows.pop(0)))
            free, window = self.capacity, []
        base = self.capacity - free
        window.extend({**p, "offset": p["offset"] + base} for p in pieces) if base else window.extend(pieces)
        free -= size
        if not free:
            out.append((self.capacity, window))
        else:
            at = bisect_left(self.free, free)
            self.free.insert(at, free)
            self.windows.insert(at, window)
        return out

    def rest(self) -> list[tuple[int, list]]:
        return [(self.capacity - free, window) for free, window in zip(self.free, self.windows)]


class _Output:
    def __init__(self, round_: int):
        self.next = round_ << 56 | TaskContext.get().partitionId() << 32
        self.rows: list[dict] = []

    def add(self, windows, still_open: bool) -> None:
        for used, pieces in windows:
            self.rows.append({"window": self.next, "used": used, "open": still_open, "pieces": pieces})
            self.next += 1

    def batches(self, least: int = 1) -> Iterator[pa.RecordBatch]:
        if len(self.rows) >= least:
            yield pa.RecordBatch.from_pylist(self.rows, _ARROW_WINDOW)
            self.rows = []


def _pack(batches, encoder: dict, end_id: int, capacity: int, most_open: int):
    encoder, packer, out = Encoder(**encoder), Packer(capacity, most_open), _Output(0)
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
            ids = np.append(encoder.ids(text), np.uint32(end_id)).astype("<u4")
            for start in range(0, len(ids), capacity):
                part = ids[start : start + capacity].tobytes()
                piece = {
                    "doc_id": doc_id, "start": start, "length": len(part) // 4, "doc_tokens": len(ids),
                    "offset": 0, "ids": part,
                }
                out.add(packer.put(len(part) // 4, [piece]), False)
            yield from out.batches(1000)
    out.add(packer.rest(), True)
    yield from out.batches()


def _merge(batches, capacity: int, most_open: int, round_: int, last: bool):
    packer, out = Packer(capacity, most_open), _Output(round_)
    for batch in batches:
        rows = sorted(batch.to_pylist(), key=lambda r: -r["used"])
        for row in rows:
            out.add(packer.put(row["used"], row["pieces"]), False)
            yield from out.batches(1000)
    out.add(packer.rest(), not last)
    yield from out.batches()


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    ranks: tuple[str, str] | None = None,
    end_id: int = 1,
    capacity: int = CAPACITY,
    open_windows: int = OPEN_WINDOWS,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    sequence_tokens and, if wanted, the ids (little-endian unsigned 32 bit). The ids travel with their windows
    in either case, and ``ids_crc32`` is taken from the packed ones.

    A document is its token ids and ``end_id``. It is cut only where it is longer than a window. Each task
    packs its documents with a fixed number of open windows; what it leaves open at its end goes to a
    merging task with the windows of other tasks, and so on until one task of at most
    ``MERGED * open_windows`` windows is left, whatever the size of the input.

    A null text is an empty one and makes a piece of ``end_id`` alone. Null and repeated ids are rows
    like others; other columns are ignored. An empty table gives an empty result.
    """
    run = partial(
        _pack, encoder=choice(tokenizer, ranks), end_id=end_id, capacity=capacity,
        most_open=open_windows,
    )
    packed = staged(docs.select("doc_id", "text").mapInArrow(run, _WINDOW), "packed")
    done = [packed.where("not open")]
    left, round_ = packed.where("open"), 1
    while True:
        tasks = -(-left.count() // (MERGED * open_windows))
        merge = partial(_merge, capacity=capacity, most_open=open_windows, round_=round_, last=tasks <= 1)
        dealt = left.coalesce(1) if tasks <= 1 else left.repartition(tasks)
        merged = staged(dealt.mapInArrow(merge, _WINDOW), "packed")
        done.append(merged.where("not open"))
        if tasks <= 1:
            break
        left, round_ = merged.where("open"), round_ + 1
    windows = done[0]
    for more in done[1:]:
        windows = windows.unionByName(more)
    columns = {c: F.col(f"p.{c}") for c in ("doc_id", "start", "length")}
    columns |= {"ids_crc32": F.crc32("p.ids"), "doc_tokens": F.col("p.doc_tokens"), "offset": F.col("p.offset")}
    columns |= {"ids": F.col("p.ids")} if with_ids else {}
    return windows.select("window", "used", F.explode("pieces").alias("p")).select(
        *[column.alias(c) for c, column in columns.items()],
        F.col("window").alias("sequence_id"),
        F.col("used").cast("long").alias("sequence_tokens"),
    )
