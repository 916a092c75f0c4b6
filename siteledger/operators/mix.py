"""Product and time-of-day mix: quadrants, top sellers, band shares, code eras."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import pct, ratio
from ..sources.landing import pin
from .conform import in_era
from .metrics import sum_where
from .quantiles import group_percentile


def fold_labels(label: str, folds: Mapping[str, str]) -> Column:
    """Fold groups too small for a benchmark into a neighbour."""
    column = F.col(label)
    for small, into in folds.items():
        column = F.when(F.col(label) == small, into).otherwise(column)
    return column


def quadrants(sold: DataFrame, group: Sequence[str], item: str, units: str, price: str,
              unit_cost: str) -> DataFrame:
    """Place items against their group's median units and median margin.

    ``sold`` has one row per group and item.  An item without a cost takes its
    group's median cost ratio and is flagged.  At the median counts as high.  ``sold`` is read
    several times, so it should be written.  Runs a job.
    """
    base = sold.withColumn("_ratio", ratio(unit_cost, price))
    # One row for each group, which every step below reads: written once.
    ratios = pin(group_percentile(base, group, ["_ratio", units]), "group-medians")[0] \
        .withColumnsRenamed({"_ratio": "_med_ratio", units: "_med_units"})
    list_price = F.col(price).cast("double")
    cost = F.coalesce(F.col(unit_cost).cast("double"), F.col("_med_ratio") * list_price)
    costed = sold.join(ratios, list(group)).select(
        *group, item, units, ((list_price - cost) * F.col(units).cast("double")).alias("_margin"),
        F.col(unit_cost).isNull().alias("cost_imputed"), "_med_units")
    medians = group_percentile(costed, group, ["_margin"]) \
        .withColumnRenamed("_margin", "_med_margin")
    popular = F.col(units).cast("double") >= F.col("_med_units")
    rich = F.col("_margin") >= F.col("_med_margin")
    return costed.join(medians, list(group)).select(
        *group, item, units, F.round("_margin", 0).alias("margin"),
        F.when(popular & rich, "star").when(popular, "plowhorse")
        .when(rich, "puzzle").otherwise("dog").alias("quadrant"),
        "cost_imputed")


def top_per_group(rows: DataFrame, group: Sequence[str], item: str, value: str, n: int,
                  out: str = "units") -> DataFrame:
    """The n best items per group by summed value; ties go to the smaller item.

    The ``rank <= n`` filter becomes a per-task limit ahead of the shuffle.
    """
    sums = rows.groupBy(*group, item).agg(F.sum(value).alias(out))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(
        F.col(out).desc_nulls_last(), F.col(item).asc_nulls_last()))
    return sums.withColumn("rn", rank).filter(F.col("rn") <= n) \
        .select(*group, "rn", item, out)


def band_grid(rows: DataFrame, unit: Sequence[str], band: str, value: str) -> DataFrame:
    return rows.groupBy(*unit, band).agg(F.sum(value).alias("net_sales"))


def band_shares(grid: DataFrame, unit: str, band: str, order: Sequence[str],
                value: str = "net_sales") -> DataFrame:
    """Share of each band in its unit's total, with the bands' own sort position."""
    total = F.sum(value).over(Window.partitionBy(unit))
    position = F.array_position(F.array(*[F.lit(b) for b in order]), F.col(band))
    return grid.select(
        unit, band,
        F.when(position > 0, position).otherwise(len(order) + 1).cast("int").alias("band_order"),
        pct(value, total, 1).alias("share_pct"),
        F.round(F.col(value).cast("double"), 0).alias(value))


def below_peers(grid: DataFrame, unit: str, peer_group: str, band: str, factor: float,
                value: str = "net_sales") -> DataFrame:
    """Bands whose share is under ``factor`` x the mean share of the unit's peers.

    Peers are the other units of the same group that have the band.  Their mean
    is (sum - own) / (n - 1) from one aggregate per band, so units are never
    paired up; a unit without peers gives no row.
    """
    share = pct(value, F.sum(value).over(Window.partitionBy(unit)), None)
    shares = grid.select(unit, peer_group, band, share.alias("share"))
    sums = shares.groupBy(peer_group, band).agg(
        F.sum("share").alias("_sum"), F.count("share").alias("_n"))
    mean = (F.col("_sum") - F.col("share")) / F.nullif(F.col("_n") - 1, F.lit(0))
    return shares.join(sums, [peer_group, band]).withColumn("peer_avg", mean) \
        .filter(F.col("share") < F.lit(float(factor)) * F.col("peer_avg")) \
        .select(unit, band, F.round("share", 1).alias("share_pct"),
                F.round("peer_avg", 1).alias("peer_avg_pct"))


def era_band(rows: DataFrame, eras: DataFrame, entity: str, day: str, value: str,
             where: Column, label: str) -> DataFrame:
    """One band per code era: value per open day and share of the era's total."""
    return in_era(rows, eras, entity, day).groupBy(label).agg(
        F.round(sum_where(value, where).cast("double") / F.count_distinct(F.col(day)), 0)
        .alias("band_net_per_day"),
        pct(sum_where(value, where), F.sum(value), 1).alias("band_share_pct"))


def era_totals(rows: DataFrame, eras: DataFrame, entity: str, day: str, value: str,
               labels: Sequence[str]) -> DataFrame:
    """Each code era of an entity: total, open days and value per open day."""
    return in_era(rows, eras, entity, day).groupBy(*labels).agg(
        F.round(F.sum(value).cast("double") / F.count_distinct(F.col(day)), 0)
        .alias("net_per_open_day"),
        F.round(F.sum(value).cast("double"), 0).alias("net_total"),
        F.count_distinct(F.col(day)).alias("open_days"))
