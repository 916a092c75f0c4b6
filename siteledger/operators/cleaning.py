"""Row-level cleaning: typing, dedup of re-sent rows, collapsing label variants."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.landing import pin
from .conform import heavy_values
from .positions import positions


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Strict typed projection: ANSI casts, so a bad value fails the job."""
    return df.select(*[F.col(c).cast(types[c]).alias(c) if c in types else F.col(c)
                       for c in df.columns])


def cast_lenient(df: DataFrame, types: Mapping[str, str],
                 bad: str = "bad_columns") -> DataFrame:
    """Typed projection that keeps going: failed values become NULL.

    ``bad`` lists the columns of the row that held a value no cast accepts.
    """
    failed = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
        for c, t in types.items()]))
    typed = [F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c)
             for c in df.columns]
    return df.select(*typed, failed.alias(bad))


def reject_rows(df: DataFrame, types: Mapping[str, str], bad: str = "bad_columns") -> DataFrame:
    """The untouched source rows a lenient cast would lose values from."""
    failed = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c))
        for c, t in types.items()]))
    return df.withColumn(bad, failed).filter(F.size(bad) > 0)


def _newest_first(df: DataFrame, keys: Sequence[str], newest: Sequence[str],
                  tie_break: Sequence[str] | None) -> list[Column]:
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in keys and c not in newest]
    return [F.col(c).desc_nulls_last() for c in (*newest, *tie_break)]


def _numbers_first(df: DataFrame, keys: Sequence[str]) -> list[str]:
    """The keys in an order that sorts fast: the first one's leading bytes decide most comparisons, and numbers differ there."""
    kinds = dict(df.dtypes)
    order = ("bigint", "int", "smallint", "tinyint", "date")
    return sorted(keys, key=lambda c: order.index(kinds[c]) if kinds.get(c) in order else len(order))


def keep_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str],
                tie_break: Sequence[str] | None = None) -> DataFrame:
    """One row per business key, the newest export.

    ``tie_break`` defaults to every other column, which makes the choice a total
    order: the same rows win on every run and after any task is retried.  The
    ``rank <= 1`` filter lets Spark cut each map task to one row per key before
    the shuffle, so a key with very many copies costs one row per task.
    """
    order = _newest_first(df, keys, newest, tie_break)
    rank = F.row_number().over(Window.partitionBy(*_numbers_first(df, keys)).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank <= 1").drop("_rank")


def rank_exports(df: DataFrame, keys: Sequence[str], newest: Sequence[str],
                 tie_break: Sequence[str] | None = None, out: str = "export_seq") -> DataFrame:
    """Number the exports of each business key, 1 = newest.

    Only for looking at the copies themselves.  Anything that needs just the
    newest row uses ``keep_latest``; totals over the copies use
    ``copies_and_latest``.

    The rows are written once (runs jobs); a sketch and a count name the keys that hold more than a hundredth of them.  Their
    ranks come from one sort spread over all tasks, whatever the size of a key, those of all others from a window.
    Copies equal in every column are told apart by their place in the input, so they do not have to share a
    task either.
    """
    order = [*_newest_first(df, keys, newest, tie_break), F.col("_input_place")]
    hashed = F.xxhash64(*keys)
    placed, n_rows = pin(df.withColumn("_input_place", F.monotonically_increasing_id()), "exports")
    hashes = placed.select(hashed.alias("_key"))
    found = heavy_values(hashes, "_key")
    heavy = [r["_key"] for r in hashes.filter(F.col("_key").isin(found)).groupBy("_key").count()
             .filter(F.col("count") * 100 > n_rows).collect()] if found else []
    others = placed.filter(~hashed.isin(heavy)) if heavy else placed
    rank = F.row_number().over(Window.partitionBy(*_numbers_first(df, keys)).orderBy(*order))
    ranked = others.withColumn(out, rank)
    if heavy:
        ranked = ranked.unionByName(positions(placed.filter(hashed.isin(heavy)), order, keys, out)
                                    .withColumn(out, F.col(out).cast("int")))
    return ranked.drop("_input_place")


def copies_and_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str],
                      tie_break: Sequence[str], totals: Mapping[str, Column],
                      copies: str = "copies") -> DataFrame:
    """Per business key: number of copies, totals over all copies, and the newest row.

    A plain aggregate with map-side combining, so however many copies one key
    has, each map task sends one row for it.  The newest row comes back as the
    columns ``newest`` + ``tie_break``.
    """
    payload = [*newest, *tie_break]
    picked = F.max(F.struct(*[F.col(c) for c in payload])).alias("_newest")
    sums = [F.sum(v).alias(name) for name, v in totals.items()]
    grouped = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(copies), *sums, picked)
    return grouped.select(*keys, copies, *totals, "_newest.*")


def collapse(df: DataFrame, keys: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Sum measures to their grain after the label columns were normalised."""
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
