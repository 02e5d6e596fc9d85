"""Exact nearest neighbours by a block matrix join over int8 tiles with error bounds."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import staged

QUERY_ROWS = 512
CANDIDATE_ROWS = 2048
# Blocks that meet in one cell of the grid at most.
GROUPED = 8

_BLOCK = "block long, dim int, rows int, ids binary, vectors binary, codes binary, scales binary, errors binary"
_RESULT = "query_id long, vec_id long, score double, copy long"


def quantised(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes of unit vectors, the scale of each row, and the length of what the codes miss."""
    scales = np.abs(vectors).max(axis=1) / 127.0
    codes = np.rint(vectors / scales[:, None]).astype(np.int8)
    errors = np.sqrt(((vectors - codes * scales[:, None]) ** 2).sum(axis=1))
    return codes, scales, errors


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest component first, so that no square overflows or vanishes.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def cosines(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Cosine of each pair of rows in double precision."""
    dot = (one * other).sum(axis=1)
    norms = np.sqrt((one * one).sum(axis=1)) * np.sqrt((other * other).sum(axis=1))
    plain = dot / norms
    odd = ~np.isfinite(plain) | (norms < 1e-290)
    if odd.any():
        plain[odd] = (unit(one[odd]) * unit(other[odd])).sum(axis=1)
    return plain


def _usable(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    for vec_id, vector in zip(batch.column("vec_id").to_pylist(), batch.column("embedding")):
        if vec_id is None or not vector.is_valid:
            continue
        values = vector.values
        if not len(values) or values.null_count:
            continue
        found = values.to_numpy(zero_copy_only=False).astype(np.float64)
        if np.isfinite(found).all() and found.any():
            yield vec_id, found


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    open_: dict[int, tuple[list[int], list[np.ndarray]]] = {}
    number = TaskContext.get().partitionId() << 32

    def emit(dim: int) -> pa.RecordBatch:
        nonlocal number
        ids, vectors = open_.pop(dim)
        stacked = np.stack(vectors)
        codes, scales, errors = quantised(unit(stacked))
        row = {
            "block": number, "dim": dim, "rows": len(ids), "ids": np.array(ids, np.int64).tobytes(),
            "vectors": stacked.tobytes(), "codes": codes.tobytes(), "scales": scales.tobytes(),
            "errors": errors.tobytes(),
        }
        number += 1
        types = [pa.int64(), pa.int32(), pa.int32()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row.values(), types)], names=list(row))

    for batch in batches:
        for vec_id, vector in _usable(batch):
            ids, vectors = open_.setdefault(len(vector), ([], []))
            ids.append(vec_id)
            vectors.append(vector)
            if len(ids) == size:
                yield emit(len(vector))
    for dim in sorted(open_):
        yield emit(dim)


class _Block:
    def __init__(self, row: dict):
        n, dim = row["rows"], row["dim"]
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.vectors = np.frombuffer(row["vectors"]).reshape(n, dim)
        # Products of int8 codes are whole numbers; the float type holds their sums exactly.
        exact = np.float32 if dim < (1 << 24) // (127 * 127) else np.float64
        self.codes = np.frombuffer(row["codes"], np.int8).reshape(n, dim).astype(exact)
        self.scales = np.frombuffer(row["scales"])
        self.errors = np.frombuffer(row["errors"])


class _Best:
    """The ``k`` best candidates of every query of a block, each query a small sorted heap."""

    def __init__(self, queries: _Block, k: int):
        n = len(queries.ids)
        self.queries, self.k = queries, k
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def offer(self, tile: _Block) -> None:
        q, k = self.queries, self.k
        near = (q.codes @ tile.codes.T).astype(np.float64) * q.scales[:, None] * tile.scales[None, :]
        # |x.y - x'.y'| <= |x - x'| |y| + |x'| |y - y'|, with |y| = 1 and |x'| <= 1 + |x - x'|.
        slack = q.errors[:, None] + (1 + q.errors[:, None]) * tile.errors[None, :] + 1e-9
        near[q.ids[:, None] == tile.ids[None, :]] = -np.inf
        upper, lower = near + slack, near - slack
        if len(tile.ids) > k:
            floor = np.partition(lower, len(tile.ids) - k, axis=1)[:, len(tile.ids) - k]
        else:
            floor = np.full(len(q.ids), -np.inf)
        floor = np.maximum(floor, self.scores[:, -1])
        rows, columns = np.nonzero((upper >= floor[:, None]) & np.isfinite(near))
        for at in range(0, len(rows), 1 << 15):
            self._merge(rows[at : at + (1 << 15)], columns[at : at + (1 << 15)], tile)

    def _merge(self, rows: np.ndarray, columns: np.ndarray, tile: _Block) -> None:
        scores = cosines(self.queries.vectors[rows], tile.vectors[columns])
        ids = tile.ids[columns]
        better = (scores > self.scores[rows, -1]) | ((scores == self.scores[rows, -1]) & (ids < self.ids[rows, -1]))
        rows, scores, ids = rows[better], scores[better], ids[better]
        touched = np.unique(rows)
        all_rows = np.concatenate((np.repeat(touched, self.k), rows))
        all_scores = np.concatenate((self.scores[touched].ravel(), scores))
        all_ids = np.concatenate((self.ids[touched].ravel(), ids))
        order = np.lexsort((all_ids, -all_scores, all_rows))
        all_rows = all_rows[order]
        first = np.searchsorted(all_rows, touched)
        keep = order[(first[:, None] + np.arange(self.k)[None, :])]
        self.scores[touched], self.ids[touched] = all_scores[keep], all_ids[keep]

    def batch(self) -> pa.RecordBatch:
        rows, columns = np.nonzero(np.isfinite(self.scores))
        return pa.RecordBatch.from_arrays(
            [pa.array(self.queries.ids[rows]), pa.array(self.ids[rows, columns]),
             pa.array(self.scores[rows, columns]), pa.array(rows.astype(np.int64) + self.queries.offset)],
            names=["query_id", "vec_id", "score", "copy"],
        )


def _search(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Tiles sorted by grid cell and query block: one heap block is open at a time."""
    best, at = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
            key = (row["cell"], row["q_block"], row["dim"])
            if key != at:
                if best is not None:
                    yield best.batch()
                queries = _Block({n: row[n if n == "dim" else f"q_{n}"] for n in ("dim", *_PARTS)})
                # Tells rows with equal ids apart when the heaps are merged.
                queries.offset = row["q_block"] << 10
                best, at = _Best(queries, k), key
            best.offer(_Block({n: row[n] for n in ("dim", *_PARTS)}))
    if best is not None:
        yield best.batch()


_PARTS = ("rows", "ids", "vectors", "codes", "scales", "errors")


def nearest(queries: DataFrame, candidates: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest cosines, ties to the smaller vec_id.

    Both frames have (vec_id, embedding). Rows are packed into blocks; a grid of groups of query blocks and
    groups of candidate blocks says which blocks meet, so each task holds two blocks and one set of
    heaps, and no key has more rows than a cell of the grid. A tile of int8 products, with a bound on the
    quantisation error of every pair, leaves the pairs that may be among the best; those are computed
    from the original vectors in double precision. The result is exact.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, nor does a
    null vec_id; vectors of different lengths are not compared. A query is not compared with rows of
    its own vec_id; repeated candidates count each, a repeated query is answered once per row. A query
    without candidates has no rows.
    """

    def blocks(df: DataFrame, size: int, name: str) -> DataFrame:
        rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        return staged(rows.mapInArrow(partial(_blocks, size=size), _BLOCK), name)

    asked, held = blocks(queries, QUERY_ROWS, "query-blocks"), blocks(candidates, CANDIDATE_ROWS, "vector-blocks")
    across = max(1, -(-asked.count() // GROUPED))
    down = max(1, -(-held.count() // GROUPED))
    number = lambda n: F.pmod(F.xxhash64("block"), F.lit(n))
    left = held.withColumn("_down", number(down)).withColumn("_across", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = asked.select(*[F.col(c).alias(f"q_{c}" if c != "dim" else c) for c in asked.columns], number(across).alias("_across"))
    right = right.withColumn("_down", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    grid = left.withColumn("cell", F.col("_down") * across + F.col("_across")).drop("_down", "_across")
    ask = right.withColumn("cell", F.col("_down") * across + F.col("_across")).drop("_down", "_across")
    tiles = grid.join(ask, ["cell", "dim"]).sortWithinPartitions("cell", "q_block", "dim")
    columns = ["cell", "dim", "q_block", *_PARTS, *[f"q_{p}" for p in _PARTS]]
    found = tiles.select(*columns).mapInArrow(partial(_search, k=k), _RESULT)
    order = W.partitionBy("query_id", "copy").orderBy(F.desc("score"), F.asc("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
