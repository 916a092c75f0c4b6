"""A blocked Bloom filter of bounded size as a DataFrame, built and asked by functions of Spark alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import keep

WORDS, WORD_BITS = 8, 32


def _bits(key: Column) -> list[Column]:
    """For each word of a block the one bit that this key sets, as in a split-block filter."""
    mix = [F.xxhash64(key, F.lit(i)) for i in range(2)]
    places = [F.shiftright(mix[i // 4], 12 * (i % 4)).bitwiseAND(WORD_BITS - 1) for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("bigint"), p.cast("int")) for p in places]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit("block")), F.lit(blocks)).cast("int")


def build_filter(listed: DataFrame, key: str, n_listed: int, bits_per_key: int = 16,
                 most_blocks: int = 1 << 18) -> tuple[DataFrame, int]:
    """(block, w0..w7) and the number of blocks.

    The size follows the list but never exceeds ``most_blocks`` rows of 36 bytes; beyond that
    the filter only passes more false hits, which the exact join removes.
    """
    blocks = max(1, min(most_blocks, -(-n_listed * bits_per_key // (WORDS * WORD_BITS))))
    bits = _bits(F.col(key))
    filled = listed.select(_block(F.col(key), blocks).alias("block"),
                           *[b.alias(f"w{i}") for i, b in enumerate(bits)])
    return filled.groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), blocks


def possible(rows: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with boolean ``_maybe``: false only for keys that are certainly not listed."""
    # The bits are columns of their own, so that the generated code has each of them once.
    asked = rows.select("*", _block(F.col(key), blocks).alias("_block"),
                        *[b.alias(f"_b{i}") for i, b in enumerate(_bits(F.col(key)))])
    joined = asked.join(F.broadcast(bloom), F.col("_block") == F.col("block"), "left")
    missed = reduce(Column.bitwiseOR, [F.col(f"_b{i}") - F.col(f"_b{i}").bitwiseAND(F.col(f"w{i}"))
                                       for i in range(WORDS)])
    return joined.withColumn("_maybe", F.coalesce(missed == 0, F.lit(False))).select(*rows.columns, "_maybe")


def listed_or_not(rows: DataFrame, key: str, listed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` may be in the written table ``listed`` (a superset), and those where it is surely not.

    What is sure needs no join, and so none of its columns are shuffled.
    """
    bloom, blocks = build_filter(listed, key, listed.count())
    tested = possible(rows, key, keep(bloom, "bloom"), blocks)
    return tested.where("_maybe").drop("_maybe"), tested.where("not _maybe").drop("_maybe")
