"""Tokens per document in flat token files: ids one after the other, an end-of-document id after each
document, no index."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import shared_folder, staged
from .tokens import Encoder, choice, texts_of

END_ID = 50256
BLOCK_BYTES = 4 << 20


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write(batches, folder: str, encoder: dict, end_id: int, dtype: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(**encoder, plain_specials=True)
    name = f"tokens-{TaskContext.get().partitionId():06d}.bin"
    system, root = _open(folder)
    # A repeated task writes its own file and puts it in place of the first one's.
    final, own = posixpath.join(root, name), posixpath.join(root, f".{name}-{uuid.uuid4().hex}")
    end, ordinal, size = np.array([end_id], dtype), 0, 0
    with system.open_output_stream(own) as out:
        for batch in batches:
            for text in texts_of(batch.column("text")):
                ids = encoder.ids(text).astype(dtype)
                out.write(ids.tobytes())
                out.write(end.tobytes())
                size += ids.nbytes + end.nbytes
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n), pa.array(np.arange(ordinal, ordinal + n)), batch.column("doc_id"),
                 pa.nulls(n, pa.int64())],
                names=["file", "ordinal", "doc_id", "bytes"],
            )
            ordinal += n
    system.move(own, final)
    yield pa.RecordBatch.from_arrays(
        [pa.array([name]), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([size])],
        names=["file", "ordinal", "doc_id", "bytes"],
    )


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    ranks: tuple[str, str] | None = None,
    end_id: int = END_ID,
    dtype: str = "<u2",
) -> tuple[DataFrame, DataFrame]:
    """Write a token file per partition to ``folder``, which all executors reach through an Arrow
    file system. Returns the files (file, bytes) and which document each file holds where
    (file, ordinal, doc_id). A null text is an empty document."""
    system, root = _open(folder)
    system.create_dir(root, recursive=True)
    run = partial(_write, folder=folder, encoder=choice(tokenizer, ranks), end_id=end_id, dtype=dtype)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "file string, ordinal long, doc_id long, bytes long"
    )
    rows = staged(rows, "token-files")
    files = rows.where("ordinal is null").select("file", "bytes")
    return files, rows.where("ordinal is not null").select("file", "ordinal", "doc_id")


def _scan(batches, folder: str, end_id: int, dtype: str) -> Iterator[pa.RecordBatch]:
    system, root = _open(folder)
    for batch in batches:
        for file, block, start, length in zip(*[c.to_pylist() for c in batch.columns]):
            with system.open_input_file(posixpath.join(root, file)) as source:
                ids = np.frombuffer(source.read_at(length, start), dtype)
            ends = np.flatnonzero(ids == end_id)
            # The first length is of a document that may have begun in an earlier block.
            lengths = np.diff(ends, prepend=-1) - 1
            tail = len(ids) - (ends[-1] + 1 if len(ends) else 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file]), pa.array([block]), pa.array([int(tail)]), pa.array([lengths.tolist()], pa.list_(pa.int64()))],
                names=["file", "block", "tail", "lengths"],
            )


def count_tokens(
    spark: SparkSession,
    files: DataFrame,
    folder: str,
    end_id: int = END_ID,
    dtype: str = "<u2",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``file, ordinal, n_tokens, closed`` of every document in ``files`` (file, bytes).

    Files are read in blocks, many to a file. Each block finds its end ids at once; how many documents
    and how many tokens of an open document come before a block is a running sum over the blocks of its
    file. Two end ids in a row are an empty document. Tokens after the last end id are a document with
    ``closed`` false. Files may be empty; the separators are not counted as tokens.
    """
    width = np.dtype(dtype).itemsize
    if block_bytes % width:
        raise ValueError("a block must hold whole ids")
    starts = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(block_bytes).cast("long"))
    blocks = files.where("bytes > 0").select("file", "bytes", F.posexplode(starts).alias("block", "start"))
    blocks = blocks.select(
        "file",
        F.col("block").cast("long").alias("block"),
        "start",
        F.least(F.lit(block_bytes).cast("long"), F.col("bytes") - F.col("start")).alias("length"),
    )
    dealt = blocks.repartition(max(spark.sparkContext.defaultParallelism, 2))
    found = staged(
        dealt.mapInArrow(
            partial(_scan, folder=folder, end_id=end_id, dtype=dtype),
            "file string, block long, tail long, lengths array<bigint>",
        ),
        "token-blocks",
    )
    counts = found.select("file", "block", "tail", F.size("lengths").cast("long").alias("ends"))
    in_file = W.partitionBy("file").orderBy("block")
    # A block with an end id begins a run; the blocks without one after it lengthen the open document.
    runs = counts.withColumn("_run", F.sum(F.when(F.col("ends") > 0, 1).otherwise(0)).over(in_file))
    open_ = F.sum("tail").over(W.partitionBy("file", "_run").orderBy("block"))
    placed = (
        runs.withColumn("_open", open_)
        .withColumn("_carry", F.coalesce(F.lag("_open").over(in_file), F.lit(0)))
        .withColumn("_before", F.sum("ends").over(in_file) - F.col("ends"))
        .withColumn("_final", F.lead("block").over(in_file).isNull() & (F.col("_open") > 0))
    )
    whole = found.select("file", "block", "lengths").join(placed, ["file", "block"])
    closed = whole.select("file", "_before", "_carry", F.posexplode("lengths").alias("_i", "_n")).select(
        "file",
        (F.col("_before") + F.col("_i")).alias("ordinal"),
        (F.col("_n") + F.when(F.col("_i") == 0, F.col("_carry")).otherwise(0)).alias("n_tokens"),
        F.lit(True).alias("closed"),
    )
    unclosed = placed.where("_final").select(
        "file", (F.col("_before") + F.col("ends")).alias("ordinal"), F.col("_open").alias("n_tokens"),
        F.lit(False).alias("closed"),
    )
    return closed.unionByName(unclosed)


def document_token_counts(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_tokens, file and ordinal of every document, by way of token files.

    The documents are tokenised to flat files in the shared folder, and the counts are read back from
    the files alone. Null texts count 0; null and repeated ids are rows like others.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex[:12]}"
    files, held = write_token_files(docs, folder, **options)
    counts = count_tokens(spark, files, folder, options.get("end_id", END_ID), options.get("dtype", "<u2"))
    return held.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal")
