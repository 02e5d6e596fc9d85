"""Near-duplicate documents by an exact Jaccard join on word n-grams."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch, staged
from .links import between, linked_components, with_hubs
from .words import mixed, shingle_sets

WORDS = 5
PERCENT = 80
# Counters of the frequency sketch and the rows it travels in: 8 MB, however large the corpus.
SKETCH_BITS = 21
SKETCH_ROWS = 64
# Cells of the suffix filter.
CELLS = 32
# Words of 64 bits in the parity bitmap of a set.
MARK_WORDS = 8

_SIGNATURES = "doc_id long, row long, row_key long, n long, node long, check long, mark array<long>, part int, counts binary"


def needed(n: int, percent: int) -> int:
    """How many of its ``n`` shingles a set shares at least with any set it links to."""
    return -(-percent * n // 100)


def _index(sets: np.ndarray) -> np.ndarray:
    return (sets >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def fingerprint(found: np.ndarray, seed: int) -> np.int64:
    """A 64-bit hash of a set; ``seed`` chooses another one."""
    return mixed(found ^ np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)).sum(dtype=np.uint64).astype(np.int64)


def _signatures(batches: Iterator[pa.RecordBatch], words: int, seed: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("doc_id", pa.int64()), ("row", pa.int64()), ("row_key", pa.int64()), ("n", pa.int64()), ("node", pa.int64()),
         ("check", pa.int64()), ("mark", pa.list_(pa.int64())), ("part", pa.int32()), ("counts", pa.binary())]
    )
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)
    for batch in batches:
        n, node, check = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
        marks = np.zeros((batch.num_rows, MARK_WORDS), np.int64)
        gathered, held = [], 0
        for row, found in shingle_sets(batch.column("text"), words):
            n[row] = len(found)
            node[row] = fingerprint(found, seed)
            marks[row] = parity_bitmap(found)
            check[row] = (found * (found | np.uint64(1))).sum(dtype=np.uint64).astype(np.int64)
            gathered.append(_index(found))
            held += len(found)
            if held > 1 << 19:
                sketch += np.bincount(np.concatenate(gathered), minlength=len(sketch)).astype(np.uint32)
                gathered, held = [], 0
        if held:
            sketch += np.bincount(np.concatenate(gathered), minlength=len(sketch)).astype(np.uint32)
        none = pa.nulls(batch.num_rows)
        ends = np.arange(0, marks.size + 1, MARK_WORDS, dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("row"), batch.column("row_key"), pa.array(n), pa.array(node), pa.array(check),
             pa.ListArray.from_arrays(ends, marks.ravel()), none.cast(pa.int32()), none.cast(pa.binary())],
            schema=schema,
        )
    parts = [i for i, part in enumerate(np.split(sketch, SKETCH_ROWS)) if part.any()]
    if parts:
        packed = [zlib.compress(part.tobytes(), 1) for part in np.split(sketch, SKETCH_ROWS)]
        none = pa.nulls(len(parts), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none] * 6 + [pa.nulls(len(parts), pa.list_(pa.int64())), pa.array(parts, pa.int32()), pa.array([packed[i] for i in parts], pa.binary())],
            schema=schema,
        )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column("part").to_pylist(), batch.column("counts").to_pylist()):
            counted = np.frombuffer(zlib.decompress(counts), np.uint32).astype(np.uint64)
            total[part] = total[part] + counted if part in total else counted
    most = np.uint64(2**32 - 1)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()),
         pa.array([np.minimum(c, most).astype(np.uint32).tobytes() for c in total.values()], pa.binary())],
        names=["part", "counts"],
    )


def _prefixes(batches: Iterator[pa.RecordBatch], sketch, words: int, percent: int, seed: int) -> Iterator[pa.RecordBatch]:
    """Prefix shingles, rarest first. Copies of a set met before in this task are left out."""
    frequency, seen = sketch.value, set()
    for batch in batches:
        tokens, nodes, infos = [], [], []
        for _, found in shingle_sets(batch.column("text"), words):
            if not len(found):
                continue
            node = fingerprint(found, seed)
            if int(node) in seen:
                continue
            seen.add(int(node))
            n = len(found)
            length = n - needed(n, percent) + 1
            order = np.lexsort((found, frequency[_index(found)]))[:length]
            tokens.append(found[order].astype(np.int64))
            nodes.append(np.full(length, node))
            infos.append(np.arange(length, dtype=np.int64) + (n << 32))
        if tokens:
            columns = [np.concatenate(c) for c in (tokens, nodes, infos)]
            for at in range(0, len(columns[0]), 1 << 18):
                part = [pa.array(c[at : at + (1 << 18)]) for c in columns]
                yield pa.RecordBatch.from_arrays(part, names=["key", "node", "info"])


def parity_bitmap(found: np.ndarray) -> np.ndarray:
    """Bit i says whether an odd number of the hashes fall into cell i.

    A member of one set only changes one bit, so the bitmaps of two sets differ in no more bits than the
    sets differ in members.
    """
    cells = 64 * MARK_WORDS
    counts = np.bincount((found & np.uint64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64)


def _cells(found: np.ndarray) -> np.ndarray:
    return np.bincount((found >> np.uint64(59)).astype(np.int64), minlength=CELLS)


def linked(one: np.ndarray, other: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the similarity.

    The suffix filter comes first: hashes are spread evenly, so each set falls into cells of its
    order, and members of different cells differ. If the cell sizes alone differ by more than the
    similarity allows, the sets need not be merged.
    """
    both = len(one) + len(other)
    overlap = -(-percent * both // (100 + percent))
    if np.abs(_cells(one) - _cells(other)).sum() > both - 2 * overlap:
        return False
    merged = np.concatenate((one, other))
    merged.sort(kind="stable")
    return int((merged[1:] == merged[:-1]).sum()) >= overlap


def _verified(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """The pairs (a, b) whose two ``texts`` link; which text is whose makes no difference."""
    for batch in batches:
        sets = (found for _, found in shingle_sets(batch.column("texts").flatten(), words))
        keep = [linked(one, next(sets), percent) for one in sets]
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _may_link(percent: int):
    """Length and positional filter for two postings of one shingle; an info holds the size of the set
    (upper half) and the place of the shingle in it.

    The shorter set needs the shingle within its shorter, indexed prefix only: if two sets link,
    the rarest shingle they share lies there. What both have before the shingle and what both have
    after it bound their overlap.
    """

    def condition(one: Column, other: Column) -> Column:
        n, pos = F.shiftright(one, 32), one.bitwiseAND(F.lit(2**32 - 1))
        m, at = F.shiftright(other, 32), other.bitwiseAND(F.lit(2**32 - 1))
        indexed = lambda size: size - F.ceil(F.lit(2 * percent) * size / F.lit(100 + percent)) + 1
        shorter = F.when(n < m, pos < indexed(n)).when(n > m, at < indexed(m)).otherwise(
            F.least(pos, at) < indexed(n)
        )
        shared = F.least(pos, at) + 1 + F.least(n - pos - 1, m - at - 1)
        return (
            (100 * F.least(n, m) >= percent * F.greatest(n, m))
            & shorter
            & ((100 + percent) * shared >= percent * (n + m))
        )

    return condition


def _allowed(both: Column, mark_a: Column, mark_b: Column, percent: int) -> Column:
    """The suffix filter on parity bitmaps: sets of ``both`` members together that link differ in no more members
    than their sizes allow, and their bitmaps in no more bits. Long sets fill the bitmap and pass."""
    differ = sum(F.bit_count(mark_a[i].bitwiseXOR(mark_b[i])) for i in range(MARK_WORDS))
    return differ <= both - 2 * F.ceil(F.lit(percent) * both / F.lit(100 + percent))


def _near(percent: int):
    """The filter on bitmaps before a pair is made."""

    def condition(one: Column, other: Column) -> Column:
        both = F.shiftright(one["info"], 32) + F.shiftright(other["info"], 32)
        return _allowed(both, one["mark"], other["mark"], percent)

    return condition


def collide(nodes: DataFrame) -> bool:
    """Whether a fingerprint stands for two different sets."""
    return not nodes.where("c1 <> c2").isEmpty()


def _classes(docs: DataFrame, row: Column, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Every row (doc_id, row, n, node), and the component of every node. ``row`` is a row's number, which is
    taken in one scan only."""
    with scratch() as tables:
        rows, named = _signed_and_named(docs, row, words, percent)
        tables.remove(rows)
        tables.remove(named)
    return rows.where("part is null").select("doc_id", "row", "n", "node"), named


def _signed_and_named(docs: DataFrame, row: Column, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The tables behind :func:`_classes`: rows with their sets' fingerprints, among parts of the sketch, and the
    component of every node."""
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("doc_id", "text").alias("row_key"),
        row.alias("row"),
    )
    # Different sets with one fingerprint would be one node: then all get other fingerprints. Among 4 billion sets
    # that happens to every third choice.
    for seed in count():
        rows = staged(keyed.mapInArrow(partial(_signatures, words=words, seed=seed), _SIGNATURES), "ngram-rows")
        signed = rows.where("part is null").select("doc_id", "row", "row_key", "n", "node", "check", "mark")
        nodes = staged(
            signed.where("n > 0")
            .groupBy("node")
            .agg(
                F.min("doc_id").alias("lowest"),
                F.min("row_key").alias("row_key"),
                F.min("n").alias("n"),
                F.first("mark").alias("mark"),
                F.min("check").alias("c1"),
                F.max("check").alias("c2"),
            ),
            "ngram-nodes",
        )
        if not collide(nodes):
            break
    parts = rows.where("part is not null").select("part", "counts")
    # At most SKETCH_ROWS rows of a fixed size.
    added = parts.repartition("part").mapInArrow(_added, "part int, counts binary").collect()
    table = np.zeros((SKETCH_ROWS, (1 << SKETCH_BITS) // SKETCH_ROWS), np.uint32)
    for row in added:
        table[row.part] = np.frombuffer(row.counts, np.uint32)
    sketch = spark.sparkContext.broadcast(table.ravel())

    prefixes = docs.select("text").mapInArrow(
        partial(_prefixes, sketch=sketch, words=words, percent=percent, seed=seed), "key long, node long, info long"
    )
    shared = staged(
        with_hubs(prefixes), "ngram-shared"
    )
    wanted = staged(
        shared.select("node").distinct().join(nodes.select("node", "row_key", "n", "mark"), "node"), "ngram-wanted"
    )
    texts: list[DataFrame] = []

    def verify(pairs: DataFrame) -> DataFrame:
        a = wanted.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("mark").alias("ma"))
        b = wanted.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("mark").alias("mb"))
        allowed = _allowed(F.col("na") + F.col("nb"), F.col("ma"), F.col("mb"), percent)
        # Texts take many times the space of bitmaps, so they come only to pairs whose bitmaps allow it, each text
        # from one shuffle of the table at most, and sets are made where they are compared.
        pairs = staged(pairs.join(a, "a").join(b, "b").where(allowed).select("a", "b"), "ngram-near")
        sides = pairs.select("a", "b", F.explode(F.array("a", "b")).alias("node"))
        if not texts:
            # The first pairs are those with the ends of keys; later ones are of nodes between the ends.
            nodes = sides.select("node").union(between(shared).select("node")).distinct()
            needed = staged(wanted.join(nodes, "node", "left_semi").select("row_key", "node"), "ngram-needed")
            # Merged at every size, as what is needed grows with the input: repeated rows then lie together. Texts are
            # kept, which take less space than their sets.
            found = keyed.select("row_key", "text").join(needed.hint("merge"), "row_key")
            found = found.dropDuplicates(["row_key", "node"])
            texts.append(staged(found.select("node", "text"), "ngram-texts"))
        sides = sides.join(texts[0], "node")
        both = sides.groupBy("a", "b").agg(F.collect_list("text").alias("texts"))
        return both.mapInArrow(partial(_verified, words=words, percent=percent), "a long, b long")

    found = linked_components(
        shared, verify, _may_link(percent), "ngram", wanted.select("node", "mark"), _near(percent)
    )
    named = staged(
        nodes.select("node", "lowest")
        .join(found, "node", "left")
        .select("node", "lowest", F.coalesce("component", "node").alias("component")),
        "ngram-named",
    )
    return rows, named


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs`` (doc_id, text, ...).

    Two documents link when ``100 * intersection >= percent * union`` of their distinct word
    n-grams; a component is named by the smallest doc_id reachable over links. No link between
    different sets is missed, the result is exact up to equal 64-bit hashes of different n-grams.

    How: documents with equal sets are one node from the start. A sketch of fixed size counts all
    n-grams; each set is ordered rarest first by it and only its prefix is posted, for two sets that
    link share an n-gram of both prefixes. The order may be any that all sets agree on, so collisions in
    the sketch cost time at most. Pairs that share a prefix n-gram pass length and positional filters,
    are made distinct, pass the suffix filter on bitmaps of fixed size, fetch their texts, pass it on the sets and are
    verified once. In large groups the bitmaps also work before pairs are made.

    Nulls: a null or wordless text has no n-grams and links with nothing. A null doc_id takes part
    under its text, but names no component (a component of only such rows gets null). Repeated rows
    each get a row. Other columns are ignored. An empty table gives an empty result.
    """
    signed, named = _classes(docs, F.monotonically_increasing_id(), words, percent)
    lowest = staged(named.groupBy("component").agg(F.min("lowest").alias("component_id")), "ngram-lowest")
    ids = staged(named.join(lowest, "component").select("node", "component_id"), "ngram-ids")
    return signed.join(ids, "node", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def one_per_component(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component the one with the smallest doc_id, the
    first in the table if that repeats, one without an id only if no other has one. Rows without words
    stay, null texts among them; an empty table stays empty; all columns are kept, whatever their names. ``docs``
    is read once, and written with its row numbers, for another scan may number its rows anew."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    numbered = staged(docs.select(whole, F.monotonically_increasing_id().alias("_row")), "ngram-docs")
    texts = numbered.select("_doc.doc_id", "_doc.text", "_row")
    signed, named = _classes(texts, F.col("_row"), words, percent)
    rows = signed.where("n > 0").join(named.select("node", "component"), "node")
    rank = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row")
    first = rows.groupBy("component").agg(F.min(rank).alias("first")).select(F.col("first.row").alias("_row"))
    stay = staged(first.union(signed.where("n = 0").select(F.col("row").alias("_row"))), "ngram-stay")
    return numbered.join(stay, "_row", "left_semi").select("_doc.*")
