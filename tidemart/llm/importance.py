"""Importance resampling towards a target distribution of hashed word n-grams."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged
from .order import numbered
from .words import plain_words

ORDER = 1
BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 10
SEED = 2024
# Different features that a task counts before it adds them to its buckets.
HELD = 1 << 18

_SCORED = "_row long, doc_id long, n_words long, n_features long, weight long, score long"


def _features(text: bytes, order: int) -> Iterator[tuple[int, list[int]]]:
    """Lists of the checksums of all runs of 1 to ``order`` words, with the number of new words in each.

    The checksum of a run goes on from that of the run without its last word, so no n-gram is spelled out.
    """
    tail: list[bytes] = []
    for words in plain_words(text):
        found = list(map(crc32, words))
        # Runs that begin in the words carried over end among the new ones.
        joined = [*tail, *words]
        spaced = [b" " + w for w in joined] if order > 1 else []
        runs = [*map(crc32, tail), *found]
        for size in range(2, order + 1):
            runs = list(map(crc32, spaced[size - 1 :], runs))
            known = max(0, len(tail) - size + 1)
            found += runs[known:]
        tail = joined[1 - order :] if order > 1 else []
        yield len(words), found


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, Iterator[bytes]]]:
    for batch in batches:
        texts = batch.column("text").cast(pa.large_binary())
        yield batch, (t.as_py() or b"" for t in texts)


def _counted(batches: Iterator[pa.RecordBatch], order: int, buckets: int) -> Iterator[pa.RecordBatch]:
    total, held = np.zeros(buckets, np.int64), Counter()

    def empty_held() -> None:
        places = np.fromiter(held.keys(), np.int64, len(held)) % buckets
        np.add.at(total, places, np.fromiter(held.values(), np.int64, len(held)))
        held.clear()

    for _, texts in _texts(batches):
        for text in texts:
            for _, found in _features(text, order):
                held.update(found)
                if len(held) > HELD:
                    empty_held()
    empty_held()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> DataFrame:
    """``bucket, n``: how many features of all texts (column text) fall into each bucket. Tasks hand on their
    sums, at most one row a bucket each."""
    counted = texts.select("text").mapInArrow(partial(_counted, order=order, buckets=buckets), "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """By bucket, a thousand times the logarithm of how much more frequent it is in the target, rounded down.

    Both sides (bucket, n) are smoothed by one feature a bucket. The table of ``buckets`` numbers is what the
    driver holds of the corpus.
    """
    both = raw.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).union(
        target.select("bucket", F.lit(0).cast("long"), F.col("n"))
    )
    s, t = [0] * buckets, [0] * buckets
    for row in both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect():
        s[row.bucket], t[row.bucket] = row.s, row.t
    all_s, all_t = float(sum(s) + buckets), float(sum(t) + buckets)
    ratio = [(b + 1.0) * all_s / ((a + 1.0) * all_t) for a, b in zip(s, t)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """A draw of the Gumbel distribution that doc_id and seed decide, in thousandths, rounded down."""
    name = f"{seed}:{'' if doc_id is None else doc_id}"
    h = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _weighed(batches: Iterator[pa.RecordBatch], order: int, gain: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    for batch, texts in _texts(batches):
        ids = batch.column("doc_id").to_pylist()
        rows = []
        for doc_id, text in zip(ids, texts):
            n_words = n_features = weight = 0
            for words, found in _features(text, order):
                n_words += words
                n_features += len(found)
                weight += int(gain[np.array(found, np.int64) % len(gain)].sum())
            rows.append((n_words, n_features, weight, weight + noise(doc_id, seed)))
        columns = zip(*rows) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column("_row"), batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in columns]],
            names=["_row", "doc_id", "n_words", "n_features", "weight", "score"],
        )


def _drawn(
    rows: DataFrame, target: DataFrame, order: int, buckets: int, least_words: int, percent: int, seed: int
) -> DataFrame:
    """Rows (_row, doc_id, text) with their counts, weight, score and rank."""
    gain = gains(bucket_counts(rows, order, buckets), bucket_counts(target, order, buckets), buckets)
    scored = staged(rows.mapInArrow(partial(_weighed, order=order, gain=gain, seed=seed), _SCORED), "importance")
    places = scored.withColumns(
        {"_out": F.col("n_words") < least_words, "_down": -F.col("score"), "_no_id": F.col("doc_id").isNull()}
    )
    n = places.where(~F.col("_out")).count()
    # Rows settle ties of equal documents, so any group of them can be cut.
    ranked = numbered(places, "_out", "_down", "_no_id", "doc_id", "_row", name="_before")
    drawn = ~F.col("_out") & (F.col("_before") < percent * n // 100)
    return ranked.withColumn("rank", F.when(drawn, F.col("_before") + 1).cast("long"))


def _rows(docs: DataFrame, *more: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("doc_id"), "text", *more
    )


def resampled(
    docs: DataFrame,
    target: DataFrame,
    order: int = ORDER,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words`` of every document (doc_id, text).

    Features are all runs of 1 to ``order`` words, hashed into ``buckets``. A document's weight adds, for each
    feature, how much more frequent its bucket is in the texts of ``target`` than in ``docs``; its score
    adds noise that its id and ``seed`` decide. Of the documents with ``least_words`` or more, the ``percent`` of
    the highest scores are drawn and ranked, ties to the smaller doc_id, then to the earlier row; the
    rank of all others is null. Counts, weights and ranks cover all rows.

    A null or empty text has no features and weight 0; an empty target leaves every gain to the smoothing.
    Repeated rows count and are drawn each; a null doc_id shares one noise and comes last in ties. Texts of
    any length are read in blocks. Other columns are not looked at; an empty table gives an empty result.
    """
    rows = _rows(docs.select("doc_id", "text"))
    found = _drawn(rows, target.select("text"), order, buckets, least_words, percent, seed)
    return found.select("doc_id", "n_features", "weight", "score", "rank", "n_words")


def drawn_documents(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The documents that :func:`resampled` draws, with all their columns. ``docs`` is written once with row
    numbers, which a second scan might deal anew."""
    settings = {
        "order": ORDER, "buckets": BUCKETS, "least_words": LEAST_WORDS, "percent": PERCENT, "seed": SEED, **options,
    }
    kept = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_all"))
    kept = staged(kept.withColumn("_row", F.monotonically_increasing_id()), "importance-docs")
    rows = kept.select("_row", F.col("_all.doc_id").cast("long").alias("doc_id"), "_all.text")
    found = _drawn(rows, target.select("text"), **settings).where("rank is not null").select("_row")
    return kept.join(found, "_row", "left_semi").select("_all.*")
