"""The first rows of an order, without sorting the whole input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Size of the sketch of a day's numbers, and the share of the day's rows by which its ranks may be off: three
# times what the sketch promises for nine days of ten.
SKETCH = 10_000
SLACK = 0.002
# Ranks at which a sketch is asked.
STEPS = 1_000
SMALLEST, LARGEST = -(2**63), 2**63 - 1
NO_DAY = -(2**31)
SPREAD = 1 << 20


def first_rows(
    df: DataFrame, n: int, day: Column, number: Column, ties: Sequence[str]
) -> DataFrame:
    """The first ``n`` rows ordered by ``day``, then ``number`` (a long), then ``ties``; nulls come first.

    One pass over the two columns counts the rows of every day and sketches their numbers. That tells the day on
    which the cap falls, and two numbers of it between which the cap lies; a second pass over the two columns
    counts the day's rows below either, and takes the end of the day instead of a number that lies on the wrong
    side. One row then filters the only pass over all columns, and of the rows that are kept, those between the two
    numbers are ranked. Rows of one day and number should fit into a task.
    """
    if n < 0:
        raise ValueError("the row cap must not be negative")
    if n == 0:
        return df.limit(0)
    placed = df.withColumns(
        {
            "_day": F.coalesce(F.unix_date(day), F.lit(NO_DAY)),
            "_number": F.coalesce(number, F.lit(SMALLEST)).cast("long"),
        }
    )
    days = placed.groupBy("_day").agg(
        F.count(F.lit(1)).alias("_rows"), F.kll_sketch_agg_bigint("_number", SKETCH).alias("_sketch")
    )
    # A row per calendar day.
    earlier = W.orderBy("_day").rowsBetween(W.unboundedPreceding, -1)
    days = days.withColumn("_left", F.lit(n) - F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    last = days.where("_left > 0").agg(F.max_by(F.struct("_day", "_rows", "_left", "_sketch"), "_day").alias("_last"))

    steps = F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)])
    grid = F.kll_sketch_get_quantile_bigint(F.col("_last._sketch"), steps)
    rank = F.col("_last._left") / F.col("_last._rows")

    def step(at: Column) -> Column:
        return F.get(grid, F.least(F.lit(STEPS), F.greatest(F.lit(0), at)).cast("int"))

    low, high = F.floor((rank - SLACK) * STEPS), F.ceil((rank + SLACK) * STEPS)
    near = last.where("_last is not null").select(
        F.col("_last._day").alias("_cut"), F.col("_last._left").alias("_left"), step(low).alias("_low"), step(high).alias("_high")
    )
    # The sketch draws numbers by chance: all that follows takes them from this one row.
    here = placed.select("_day", "_number").join(F.broadcast(near), F.col("_day") == F.col("_cut"))
    counted = here.agg(
        *[F.first(name).alias(name) for name in ("_cut", "_left", "_low", "_high")],
        F.count_if(F.col("_number") < F.col("_low")).alias("_below"),
        F.count_if(F.col("_number") <= F.col("_high")).alias("_upto"),
    )
    too_high = F.col("_below") >= F.col("_left")
    cap = counted.where("_cut is not null").select(
        "_cut",
        F.when(too_high, SMALLEST).otherwise(F.col("_low")).alias("_low"),
        F.when(F.col("_upto") < F.col("_left"), LARGEST).otherwise(F.col("_high")).alias("_high"),
        (F.col("_left") - F.when(too_high, 0).otherwise(F.col("_below"))).alias("_left"),
    )
    on_the_day = F.col("_day") == F.col("_cut")
    reached = (F.col("_day") < F.col("_cut")) | (on_the_day & (F.col("_number") <= F.col("_high")))
    kept = placed.join(F.broadcast(cap), reached).withColumn("_edge", on_the_day & (F.col("_number") >= F.col("_low")))
    # Only rows at the edge are ranked; the others are spread, as their place does not matter.
    lot = F.when(F.col("_edge"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("_number", "_day"), F.lit(SPREAD)))
    in_order = W.partitionBy("_lot").orderBy("_number", *ties)
    ranked = kept.withColumn("_lot", lot).withColumn("_place", F.row_number().over(in_order))
    return ranked.where(~F.col("_edge") | (F.col("_place") <= F.col("_left"))).select(*df.columns)
