"""A reproducible shuffle into shards: a keyed permutation of global row numbers."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import staged
from .order import numbered
from .words import mixed

ROUNDS = 6
# Copies of a row that travel as one until they are numbered.
COPIES_PER_ROW = 1000


class Permutation:
    """A bijection of 0 … n-1 by a Feistel network over the next even number of bits.

    Values that land outside are encrypted again until they land inside (cycle walking), which takes
    four tries at most on average, because the domain is less than four times ``n`` (or four).
    """

    def __init__(self, n: int, seed: int = 0, rounds: int = ROUNDS):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        keys = np.arange(1, rounds + 1, dtype=np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)
        self.keys = mixed(keys)

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in self.keys:
            left, right = right, left ^ (mixed(right + key) & self.mask)
        return left << np.uint64(self.half) | right

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for key in self.keys[::-1]:
            left, right = right ^ (mixed(left + key) & self.mask), left
        return left << np.uint64(self.half) | right

    def _walk(self, numbers, step) -> np.ndarray:
        out = step(np.asarray(numbers, np.uint64))
        while (outside := out >= self.n).any():
            out[outside] = step(out[outside])
        return out.astype(np.int64)

    def forward(self, numbers) -> np.ndarray:
        return self._walk(numbers, self._once)

    def inverse(self, places) -> np.ndarray:
        return self._walk(places, self._back)


def locate(number, n: int, shards: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of global row numbers, computed without looking at any table."""
    place = Permutation(n, seed).forward(np.atleast_1d(number))
    return place % shards, place // shards


def row_at(shard, slot, n: int, shards: int, seed: int = 0) -> np.ndarray:
    """The global row number at a slot of a shard."""
    return Permutation(n, seed).inverse(np.atleast_1d(slot) * shards + np.atleast_1d(shard))


def _placed(batches: Iterator[pa.RecordBatch], n: int, shards: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shard, slot = locate(batch.column("row_number").to_numpy(), n, shards, seed)
        columns = [*batch.columns, pa.array(shard, pa.int32()), pa.array(slot)]
        yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "shard", "slot"])


def shard_rows(df: DataFrame, order: list[str], shards: int, seed: int = 0) -> DataFrame:
    """Every row of ``df`` with ``row_number``, ``shard`` and ``slot``.

    Rows are numbered in ``order`` (then by all other columns, so that ties are settled), the number is
    permuted, and the permuted number dealt to shards in turn: shard sizes differ by one row at most,
    slots have no gaps, and the same rows give the same shards whatever the partitioning. Rows that
    are equal in all columns are numbered as a group and then unfolded, so they need not meet in one
    task. Nulls sort first. An empty table stays empty. ``df`` must not have columns named
    ``row_number``, ``shard`` or ``slot``.
    """
    columns = df.columns
    clash = {"row_number", "shard", "slot"} & set(columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are results")
    rows = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies"))
    chunks = rows.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1, F.lit(COPIES_PER_ROW).cast("long")))
    ).withColumn("_many", F.least(F.lit(COPIES_PER_ROW), F.col("_copies") - F.col("_chunk")))
    by = [*order, *[c for c in columns if c not in order], "_chunk"]
    first = numbered(chunks.drop("_copies"), *by, weight="_many", name="_first")
    unfolded = staged(
        first.withColumn("_i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_many") - 1))).select(
            *columns, (F.col("_first") + F.col("_i")).alias("row_number")
        ),
        "sharded",
    )
    n = unfolded.count()
    added = [T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    schema = T.StructType([*unfolded.schema, *added])
    return unfolded.mapInArrow(partial(_placed, n=n, shards=shards, seed=seed), schema)


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder per shard, rows in slot order within each file."""
    by_shard = sharded.hint("rebalance", "shard").sortWithinPartitions("shard", "slot")
    by_shard.write.mode("overwrite").partitionBy("shard").parquet(path)


def measured(docs: DataFrame) -> DataFrame:
    """What sharding needs of each document: its id, size, checksum and a digest that settles ties."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64("text").alias("digest"),
    )


def shard_documents(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """``rows`` law over documents: doc_id, size, text_crc32, law, shard, slot, grown_shard (null).

    A null text has size 16 and the checksum of no bytes; null and repeated ids are rows like others.
    """
    placed = shard_rows(measured(docs), ["doc_id", "text_crc32", "digest", "size"], shards, seed)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
