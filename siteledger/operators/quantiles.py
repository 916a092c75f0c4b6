"""Exact interpolated group percentiles without gathering a group anywhere.

The built-in exact ``percentile`` keeps every distinct value of a group in one
task.  Here a quantile sketch first brackets the wanted ranks: its rank error is at
most 1/SKETCH of the group, so two bounds a little further apart hold them,
whatever the values are.  One aggregate then counts the values below the bracket and makes a
histogram of those inside (hashed by value, so one group spreads over all tasks and one
repeated value combines map-side); only that histogram is ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SKETCH = 10_000


def group_percentile(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                     p: float = 0.5) -> DataFrame:
    """Interpolated percentile (as ``percentile_cont``) of several measures per group.

    NULLs are ignored; output has ``keys`` plus one double column per measure.  ``df`` is read twice, so
    it should be cheap to derive.  A rank outside its bracket, which the sketch's bound rules out, is an error.
    """
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value"))
                      for m in measures])
    group = [*keys, "measure"]
    values = df.select(*keys, F.inline(pairs)).filter(F.col("value").isNotNull())
    reach = 3.0 / SKETCH
    bounds = F.percentile_approx("value", F.array(F.lit(max(0.0, p - reach)), F.lit(min(1.0, p + reach))), SKETCH)
    # Up to SKETCH rows one rank is more than the reach, so such a group is its own bracket.
    few = F.col("total") <= SKETCH
    bracket = values.groupBy(*group).agg(
        bounds.alias("b"), F.min("value").alias("least"), F.max("value").alias("most"),
        F.count(F.lit(1)).alias("total")).select(
        *[F.col(k).alias(f"_k_{k}") for k in group], "total",
        (F.col("least") if p <= reach else F.when(few, F.col("least")).otherwise(F.col("b")[0])).alias("low_value"),
        (F.col("most") if p >= 1 - reach else F.when(few, F.col("most")).otherwise(F.col("b")[1])).alias("high_value"))
    same = None
    for k in group:
        hit = F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        same = hit if same is None else same & hit
    # The values below the bracket are one slot, NULL, which is ordered before the others.
    slot = F.when(F.col("value") >= F.col("low_value"), F.col("value"))
    hist = values.join(bracket, same).filter(F.col("value") <= F.col("high_value")) \
        .groupBy(*group, "total", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    last = F.sum("n").over(Window.partitionBy(*group, "total").orderBy(F.col("slot").asc_nulls_first()))
    spot = (F.col("total") - 1) * F.lit(float(p))
    # Dealt by the keys alone, so that the window and the last aggregate share one shuffle of the few rows left.
    dealt = hist.repartition(*keys) if keys else hist
    near = dealt.select(*group, "total", "slot", "n", last.alias("last"), spot.alias("spot")) \
        .withColumn("first", F.col("last") - F.col("n"))
    low, high = F.floor("spot"), F.ceil("spot")

    def at(rank: Column) -> Column:
        return F.max(F.when((rank >= F.col("first")) & (rank < F.col("last")), F.col("slot")))

    ends = near.groupBy(*group, "total", "spot").agg(at(low).alias("v_low"), at(high).alias("v_high"))
    found = F.col("v_low") + (F.col("v_high") - F.col("v_low")) * (F.col("spot") - low)
    value = F.coalesce(found, F.raise_error(F.lit("a rank lies outside its bracket")).cast("double"))
    return ends.groupBy(*keys).agg(*[
        F.max(F.when(F.col("measure") == m, value)).alias(m) for m in measures])
