"""Tables of date windows: totals and row pairs for any number of windows, by equi-joins alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Days are counted from 1970-01-01 and shifted to be positive, so that 2**20 days to either side are covered.
SHIFT, LEVELS = 1 << 20, 21
BLOCKS = "array<struct<_level: int, _block: int>>"


def _number(day: str) -> Column:
    return F.unix_date(F.col(day).cast("date")) + SHIFT


def cover(first: str, last: str) -> Column:
    """The fewest aligned blocks of 1, 2, 4, ... days that make up a date range, as (_level, _block) structs.

    At each level a left end that is a right half, and a right end that is a left half, are blocks of their own; what
    lies between goes on at the next level.  Empty for a range without dates or that ends before it starts.
    """
    none = F.array().cast(BLOCKS)
    start = F.struct(_number(first).alias("lo"), (_number(last) + 1).alias("hi"), none.alias("taken"))

    def step(acc: Column, level: Column) -> Column:
        lo, hi = acc["lo"], acc["hi"]
        left, right = (lo < hi) & (lo % 2 == 1), (lo < hi) & (hi % 2 == 1)

        def block(wanted: Column, number: Column) -> Column:
            return F.when(wanted, F.array(F.struct(level.alias("_level"), number.alias("_block"))).cast(BLOCKS)) \
                .otherwise(none)

        return F.struct(F.shiftright(lo + left.cast("int"), 1).alias("lo"),
                        F.shiftright(hi - right.cast("int"), 1).alias("hi"),
                        F.concat(acc["taken"], block(left, lo), block(right, hi - 1)).alias("taken"))

    blocks = F.aggregate(F.sequence(F.lit(0), F.lit(LEVELS)), start, step, lambda acc: acc["taken"])
    return F.when(F.col(first).cast("date") <= F.col(last).cast("date"), blocks).otherwise(none)


def _blocks_of(rows: DataFrame, day: str, levels: Column) -> DataFrame:
    """Each row once for each level, with the block that its day lies in."""
    return rows.withColumn("_level", F.explode(levels)).withColumn("_block", F.expr(f"shiftright({day}, _level)"))


def window_totals(rows: DataFrame, day: str, measures: Mapping[str, Column | str], windows: DataFrame,
                  first: str, last: str, keys: Sequence[str] = ()) -> DataFrame:
    """Sums of the ``rows`` inside each row of ``windows`` (of the same ``keys``), NULL where there are none.

    Windows may overlap, repeat, and be of any number and length.  Rows are summed to days, days to aligned blocks of
    1, 2, 4, ... days, and a window is put together from its few blocks, two at most for each doubling of
    its length.  So sums meet windows by an equi-join that has no false candidates; no row meets a window, and a day or
    key with a large part of the rows is one sum before anything is joined.
    """
    sums = {m: F.col(c) if isinstance(c, str) else c for m, c in measures.items()}
    daily = rows.filter(F.col(day).isNotNull()).groupBy(*keys, _number(day).alias("_day")) \
        .agg(*[F.sum(c).alias(m) for m, c in sums.items()])
    blocks = _blocks_of(daily, "_day", F.sequence(F.lit(0), F.lit(LEVELS))) \
        .groupBy(*keys, "_level", "_block").agg(*[F.sum(m).alias(m) for m in sums])
    once = windows.groupBy(*windows.columns).agg(F.count(F.lit(1)).alias("_copies"))
    pieces = once.select("*", F.inline_outer(cover(first, last)))
    totals = pieces.join(blocks, [*keys, "_level", "_block"], "left") \
        .groupBy(*windows.columns, "_copies").agg(*[F.sum(m).alias(m) for m in sums])
    return totals.select(*windows.columns, *sums, F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy")) \
        .drop("_copy")


def in_windows(rows: DataFrame, day: str, windows: DataFrame, first: str, last: str, keys: Sequence[str] = (),
               salts: int = 1) -> DataFrame:
    """Each row with each window that holds its day (of the same ``keys``): the range join as an equi-join.

    Windows are cut into aligned blocks and a row meets them by level and block, so a pair is made exactly once and none
    is thrown away.  Rows repeat for the levels that the windows have, LEVELS at most.  With ``salts``, rows of one
    block are spread over so many tasks, equal rows too.  Runs a job (finds the levels).
    """
    pieces = windows.select("*", F.inline(cover(first, last)))
    levels = [r["_level"] for r in pieces.select("_level").distinct().collect()]
    known = F.array(*[F.lit(x) for x in sorted(levels)]).cast("array<int>")
    spread = rows.withColumn("_salt", (F.monotonically_increasing_id() % salts).cast("int"))
    tagged = _blocks_of(spread.withColumn("_day", _number(day)), "_day", known)
    copies = pieces.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return tagged.join(copies, [*keys, "_level", "_block", "_salt"]).drop("_level", "_block", "_salt", "_day")
