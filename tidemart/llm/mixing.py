"""Mixing sources to target weights by hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import staged
from .order import numbered

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
WORD = r"[^\x20\x09-\x0D]+"
# Bits of the hash per histogram, and how many histograms before hashes are told apart one by one.
BITS = 12
LEVELS = 3


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def measured(docs: DataFrame, seed: int = 0) -> DataFrame:
    """``docs`` with ``_size`` (words) and ``_hash``, the place of a row in the order of its source.

    The hash is of id and text, so equal rows share it. It is 60 bits of a digest that any engine can take, in the
    upper bits of the number.
    """
    name = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    digest = F.conv(F.substring(F.sha2(name, 256), 1, 15), 16, 10).cast("long")
    return docs.withColumns({"_size": word_count("text"), "_hash": F.shiftleft(digest, 4)})


def targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """``sizes`` (source, source_size; a written table) with each source's ``target``.

    Weights go round over the sources by code point, null last. ``share`` of all sizes is dealt by
    weight, no source gets above ``most`` times its size, and what it does not get is dealt to the
    others again. That ends at one level: every source gets the level times its weight or its limit.
    The level rises round by round from scalar sums until no other source reaches its limit.
    """
    ordered = sizes.withColumn("_last", F.col("source").isNull())
    ranked = numbered(ordered, "_last", "source", name="_rank").withColumn(
        "_weight",
        F.element_at(
            F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int")
        ),
    )
    ranked = staged(ranked.select("source", "source_size", "_weight"), "mixing-weights")
    limit = F.col("source_size") * F.lit(float(most))
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        full = limit <= F.col("_weight") * F.lit(level)
        capped, weight = ranked.agg(
            F.sum(F.when(full, limit)), F.sum(F.when(~full, F.col("_weight")))
        ).first()
        if not weight:
            break
        raised = (min(share, most) * total - (capped or 0.0)) / weight
        if raised <= level:
            break
        level = raised
    target = F.when(limit <= F.col("_weight") * level, limit).otherwise(F.col("_weight") * level)
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _bits(level: int) -> Column:
    """The first ``level`` groups of bits of the hash."""
    return F.shiftrightunsigned("_hash", 64 - BITS * level)


def thresholds(sized: DataFrame, goals: DataFrame) -> DataFrame:
    """For each source the hash up to which its documents are taken once more.

    ``sized`` is a written table of source, _size, _hash; ``goals`` comes from :func:`targets`. What is
    left of a target after whole passes over the source is a budget. A histogram of the words by hash
    bucket shows the bucket in which the budget ends, and only that bucket is looked at again, with the
    next bits of the hash. In the end ``_bound`` is the hash at the boundary and ``_rest`` what of the budget is
    left for its rows (more than one only for equal rows).
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    found = staged(
        goals.withColumn("_passes", passes.cast("long"))
        .withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size"))
        .withColumn("_prefix", F.lit(0).cast("long")),
        "mixing-budget",
    )
    for level in range(1, LEVELS + 2):
        exact = level > LEVELS
        bucket = F.col("_hash") if exact else _bits(level)
        inside = sized
        if level > 1:
            state = found.select(F.col("source").alias("_source"), F.col("_prefix").alias("_before"))
            here = F.col("source").eqNullSafe(F.col("_source")) & (_bits(level - 1) == F.col("_before"))
            inside = sized.join(state, here).drop("_source", "_before")
        # Unsigned order: whole hashes are compared with their sign bit flipped.
        sums = inside.groupBy("source", bucket.alias("_bucket")).agg(F.sum("_size").alias("_sum"))
        place = F.col("_bucket").bitwiseXOR(F.lit(-(2**63))) if exact else F.col("_bucket")
        order = W.partitionBy("source").orderBy(place)
        sums = sums.withColumn("_upto", F.sum("_sum").over(order)).withColumnRenamed("source", "_source")
        at = (
            F.col("source").eqNullSafe(F.col("_source"))
            & (F.col("_upto") - F.col("_sum") <= F.col("_rest"))
            & (F.col("_rest") < F.col("_upto"))
        )
        found = staged(
            found.join(sums, at, "left")
            .select(
                "source", "source_size", "target", "_passes",
                (F.col("_rest") - F.coalesce(F.col("_upto") - F.col("_sum"), F.lit(0))).alias("_rest"),
                F.col("_bucket").alias("_prefix"),
            ),
            "mixing-boundary",
        )
    return found.withColumnRenamed("_prefix", "_bound")


def taken_of(sized: DataFrame, bounds: DataFrame, whole: bool = False) -> DataFrame:
    """``sized`` with source_size, target and ``taken``, the words the mix takes of each row.

    Rows before the boundary are taken once more than the whole passes. Rows at the boundary, which is one row
    unless rows are equal, come one after the other: what is left is taken word by word, or with ``whole`` row by
    row, a row if half of it fits.
    """
    bounds = bounds.withColumnRenamed("source", "_source")
    joined = sized.join(bounds, F.col("source").eqNullSafe(F.col("_source")), "left")
    at = F.coalesce(F.col("_hash") == F.col("_bound"), F.lit(False))
    flip = F.lit(-(2**63))
    before = F.col("_hash").bitwiseXOR(flip) < F.col("_bound").bitwiseXOR(flip)

    tied = staged(joined.where(at).withColumn("_tie", F.monotonically_increasing_id()), "mixing-ties")
    placed = staged(numbered(tied, "source", "_tie", weight="_size", name="_ahead"), "mixing-ties")
    first = placed.groupBy(F.col("source").alias("_tied")).agg(F.min("_ahead").alias("_first"))
    placed = placed.join(first, F.col("source").eqNullSafe(F.col("_tied")))
    left = F.col("_rest") - (F.col("_ahead") - F.col("_first"))
    extra = F.greatest(F.lit(0).cast("long"), F.least(F.floor(left), F.col("_size")))
    if whole:
        extra = F.when(2 * left >= F.col("_size"), F.col("_size")).otherwise(0)

    def with_taken(rows: DataFrame, extra: Column) -> DataFrame:
        taken = F.coalesce(F.col("_passes") * F.col("_size") + extra, F.lit(0)).cast("long")
        return rows.select(*sized.columns, "source_size", "target", taken.alias("taken"))

    return with_taken(joined.where(~at), F.when(before, F.col("_size")).otherwise(0)).unionByName(
        with_taken(placed, extra)
    )


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: int = 0,
) -> tuple[DataFrame, DataFrame]:
    """The measured rows (doc_id, source, _size, _hash; a written table) and their thresholds."""
    sized = staged(measured(docs, seed).select("doc_id", "source", "_size", "_hash"), "mixing-sized")
    sizes = staged(sized.groupBy("source").agg(F.sum("_size").alias("source_size")), "mixing-sizes")
    return sized, thresholds(sized, targets(sizes, weights, share, most))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken, source`` for every row of ``docs``.

    The same rows give the same mix at any partitioning: what is taken depends on a hash of id and
    text. A source's taken words differ from its target by less than one word. A null or empty text has no
    words, a text of any length is counted whole; a null source is a source; of rows that are equal in id and text
    and lie at the boundary, some are taken once more than the others; a source without words has target 0. An
    empty table gives an empty result, other columns are ignored. A document may be taken in part (``taken``
    below its size) or repeated (above it).
    """
    sized, bounds = plan_mix(docs, **options)
    return taken_of(sized, bounds).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", "taken", "source"
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as the mix takes it, in whole documents.

    A source's words differ from its target by half of one document at most. Documents without words, null texts
    among them, cost nothing and stay as they are. Of equal rows at the boundary as many are taken as fit; a null
    source is a source; an empty table stays empty; all columns are kept, whatever their names.
    """
    seed = options.get("seed", 0)
    bounds = plan_mix(docs, **options)[1]
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", "source", "text")
    rows = taken_of(measured(wrapped, seed), bounds, whole=True)
    times = F.when(F.col("_size") == 0, 1).otherwise((F.col("taken") / F.col("_size")).cast("int"))
    copies = F.explode(F.array_repeat(F.lit(1), times))
    return rows.withColumn("_copy", copies).select("_row.*")
