"""Conforming names and codes to shared dimensions, with code history.

Dimension sides are joined by plain equi-joins without a broadcast hint: Spark
broadcasts a side whose measured size is under
``spark.sql.autoBroadcastJoinThreshold`` (also at run time under AQE) and
otherwise shuffles, where AQE splits a skewed key.  A dimension that is neither
small nor evenly used can be joined with ``salts`` > 1: its rows are repeated
that often and the rows of each key spread over as many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import normal_key

OPEN_END = "9999-12-31"  # fixed value: stands in for a missing end of validity


def alias_map(aliases: DataFrame, alias: str, item_id: str) -> DataFrame:
    """Distinct on the normalised alias, so case-only variants cannot fan a join out."""
    return aliases.select(normal_key(alias).alias("alias_norm"), F.col(item_id)).distinct()


def salted_join(df: DataFrame, dim: DataFrame, on: str, how: str = "inner",
                salts: int = 1) -> DataFrame:
    """Equi-join a dimension (unique on ``on``), spreading each key over ``salts`` tasks.

    The salt is a hash of the row, so a retried task places rows as before.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join keeps or drops left rows only")
    if salts <= 1:
        return df.join(dim, on, how)
    left = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast("int"))
    right = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [on, "_salt"], how).drop("_salt")


def heavy_values(df: DataFrame, column: str, counters: int = 100) -> list:
    """Values that may hold more than 1/counters of the rows, ``counters`` at most, by a Misra-Gries sketch.  Runs a job."""
    found = df.stat.freqItems([column], 1.0 / counters).first()[0]
    return sorted(v for v in found if v is not None)


def skew_join(df: DataFrame, dim: DataFrame, on: str, how: str = "inner", salts: int = 32,
              heavy: Sequence | None = None) -> DataFrame:
    """Equi-join a dimension (unique on ``on``) where a few keys hold a large part of the rows.

    Only the heavy keys are salted: their rows are dealt over ``salts`` tasks by their place in the input, equal
    rows too, and only their few dimension rows are repeated.  All other rows meet as in any join.  ``heavy`` is what
    ``heavy_values`` found (it is asked if not given); a wrong or missing key costs time, never a row.
    """
    if how not in ("inner", "left"):
        raise ValueError("a salted join keeps or drops left rows only")
    keys = heavy_values(df, on) if heavy is None else list(heavy)
    if not keys:
        return df.join(dim, on, how)
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).cast("int")
    many = F.array(*[F.lit(i) for i in range(salts)])
    left = df.withColumn("_salt", F.when(F.col(on).isin(keys), place).otherwise(0))
    right = dim.withColumn("_salt", F.explode(F.when(F.col(on).isin(keys), many).otherwise(F.array(F.lit(0)))))
    return left.join(right, [on, "_salt"], how).drop("_salt")


def resolve_alias(df: DataFrame, name: str, aliases: DataFrame, alias: str = "alias",
                  item_id: str = "item_id", how: str = "inner", salts: int = 1) -> DataFrame:
    """Attach the canonical id of a free-text name; unmapped rows drop unless ``how='left'``."""
    known = alias_map(aliases, alias, item_id)
    keyed = df.withColumn("alias_norm", normal_key(name))
    return salted_join(keyed, known, "alias_norm", how, salts).drop("alias_norm")


def unmapped_names(df: DataFrame, name: str, aliases: DataFrame,
                   alias: str = "alias") -> DataFrame:
    """Distinct raw names no alias covers (distinct first, so the join sees few rows)."""
    known = aliases.select(normal_key(alias).alias("_key")).distinct()
    names = df.select(name).distinct()
    return names.join(known, normal_key(names[name]) == known["_key"], "left_anti")


def ambiguous_aliases(aliases: DataFrame, alias: str = "alias",
                      item_id: str = "item_id") -> DataFrame:
    """Normalised aliases that claim more than one item."""
    return aliases.groupBy(normal_key(alias).alias("alias_norm")) \
        .agg(F.count_distinct(F.col(item_id)).alias("items")).filter("items > 1")


def conform_code(df: DataFrame, bridge: DataFrame, code: str, entity: str,
                 how: str = "inner", salts: int = 1) -> DataFrame:
    """Replace nothing, add the canonical entity id of a source code."""
    return salted_join(df, bridge.select(code, entity), code, how, salts)


def lookup_id(df: DataFrame, dim: DataFrame, name: str, key: str,
              how: str = "inner", salts: int = 1) -> DataFrame:
    """Surrogate key by natural name."""
    return salted_join(df, dim.select(name, key), name, how, salts)


def era_history(places: DataFrame, bridge: DataFrame, code: str = "location_code",
                entity: str = "location_id", opened: str = "open_date",
                closed: str = "closed_date", attributes: Sequence[str] = ()) -> DataFrame:
    """One row per code era; ``valid_to`` NULL means still open."""
    return conform_code(places, bridge, code, entity).select(
        entity, code, *attributes, F.col(opened).alias("valid_from"),
        F.col(closed).alias("valid_to"))


def current_dimension(places: DataFrame, bridge: DataFrame, code: str = "location_code",
                      entity: str = "location_id", opened: str = "open_date",
                      closed: str = "closed_date") -> DataFrame:
    """The open era of each entity, with the first open date across its eras."""
    eras = conform_code(places, bridge, code, entity)
    first = eras.groupBy(entity).agg(F.min(opened).alias("_first"))
    current = eras.filter(F.col(closed).isNull()).join(first, entity)
    return current.withColumn(opened, F.col("_first")).drop("_first", closed)


def in_era(df: DataFrame, eras: DataFrame, entity: str, day: str,
           valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Attach the era a day falls in; both ends are inside, a missing end is open.

    The entity is an equi-join key, so this never plans a nested loop.
    """
    inside = (df[entity] == eras[entity]) & (df[day] >= eras[valid_from]) \
        & (df[day] <= F.coalesce(eras[valid_to], F.lit(OPEN_END).cast("date")))
    return df.join(eras, inside).drop(eras[entity])


def overlapping_eras(eras: DataFrame, entity: str = "location_id",
                     valid_from: str = "valid_from", valid_to: str = "valid_to") -> DataFrame:
    """Eras that start before an earlier era of the same entity has ended.

    The running maximum of earlier ends finds an overlap with any earlier era
    without pairing the eras up.
    """
    end = F.coalesce(F.col(valid_to), F.lit(OPEN_END).cast("date"))
    before = Window.partitionBy(entity).orderBy(valid_from, end) \
        .rowsBetween(Window.unboundedPreceding, -1)
    return eras.withColumn("latest_end_before", F.max(end).over(before)) \
        .filter(F.col(valid_from) <= F.col("latest_end_before"))
