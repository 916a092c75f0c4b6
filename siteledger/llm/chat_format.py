"""Chat formatting: logged snapshots of a conversation collapse into the longest one, which is rendered.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import keep

# Turns rendered into one row; longer conversations go on in further parts.
TURNS_PER_PART = 512
OPEN, BETWEEN, CLOSE = "<|", "|>\n", "<|end|>\n"


def _sum_type(value: Column) -> Column:
    return value.cast("decimal(38,0)")


def _turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    given = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return given.withColumns({f"h{k}": F.xxhash64(F.lit(k), "role", F.length("role"), "text") for k in (1, 2)})


def prefixes(turns: DataFrame) -> DataFrame:
    """conv_id, turn, h1, h2, place (from 1), n (turns of the conversation), p1, p2 (hash of the turns up to this one).

    A prefix hash is the sum over its turns of a hash of place and turn, two of 64 bits, so it rolls on by
    addition and a running sum can be put together from pieces.  Turns are sorted by conversation and turn over
    all tasks, so that one conversation may span many; the written order fixes the pieces.  A window
    only ever covers one conversation within one sorted partition, or one row for each such piece.
    """
    slim = turns.select("conv_id", "turn", "h1", "h2").distinct()
    ordered = keep(slim.orderBy("conv_id", "turn", "h1", "h2").withColumn("m", F.monotonically_increasing_id()), "turns") \
        .withColumn("piece", F.shiftright("m", 33))
    pieces = ordered.groupBy("conv_id", "piece").agg(F.count("*").alias("size"), F.min("m").alias("first"))
    along = Window.partitionBy("conv_id").orderBy("piece")
    offsets = pieces.select("conv_id", "piece", (F.sum("size").over(along) - F.col("size") - F.col("first") + 1).alias("shift"),
                            F.sum("size").over(Window.partitionBy("conv_id")).alias("n"))
    placed = ordered.join(offsets, ["conv_id", "piece"]).withColumn("place", F.col("m") + F.col("shift"))
    own = Window.partitionBy("conv_id", "piece").orderBy("m")
    local = placed.withColumns({f"s{k}": F.sum(_sum_type(F.xxhash64("place", f"h{k}"))).over(own) for k in (1, 2)})
    sums = placed.groupBy("conv_id", "piece").agg(*[F.sum(_sum_type(F.xxhash64("place", f"h{k}"))).alias(f"t{k}") for k in (1, 2)])
    earlier = sums.select("conv_id", "piece", *[(F.sum(f"t{k}").over(along) - F.col(f"t{k}")).alias(f"e{k}") for k in (1, 2)])
    return local.join(earlier, ["conv_id", "piece"]).select(
        "conv_id", "turn", "h1", "h2", "place", "n", *[(F.col(f"s{k}") + F.col(f"e{k}")).alias(f"p{k}") for k in (1, 2)])


def maximal(rolled: DataFrame) -> DataFrame:
    """conv_id and n_equal (conversations of the same turns) of the conversations that are no proper prefix of another.

    Equal conversations are first put down to the one of smallest id, by an aggregate that combines before the
    shuffle; then an anti-join with the distinct proper prefixes of these removes the snapshots.
    """
    whole = rolled.where("place = n").groupBy("n", "p1", "p2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"))
    shorter = rolled.where("place < n").select(F.col("place").alias("n"), "p1", "p2").distinct()
    return whole.join(shorter, ["n", "p1", "p2"], "left_anti").select("conv_id", "n_equal")


def render(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """conv_id, part, n_turns, n_equal, rendered: the maximal conversations as chat text.

    A conversation goes if its turns are the first turns of a longer one, or equal those of one with a smaller id.
    Turns follow ``turn`` (null first), ties the hash of role and text.  Each is ``<|role|>``, a line break, its
    text and ``<|end|>`` with a line break.  A conversation of more than ``turns_per_part`` turns is
    several rows, so no group is gathered that grows with the data.

    Null roles and texts count as empty.  Turns without conv_id belong to no conversation and are left out.  Equal
    rows count once.  No rows give no rows; other columns are not looked at.  Runs jobs.
    """
    turns = _turns(conversations, conv_id, turn, role, text)
    rolled = keep(prefixes(turns), "prefixes")
    kept = keep(maximal(rolled), "maximal")
    places = rolled.select("conv_id", "turn", "h1", "h2", "place").join(kept, "conv_id") \
        .withColumnsRenamed({"conv_id": "c", "turn": "t", "h1": "g1", "h2": "g2"})
    same = (F.col("conv_id") == F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) \
        & (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2"))
    shown = F.concat(F.lit(OPEN), "role", F.lit(BETWEEN), "text", F.lit(CLOSE))
    parts = turns.join(places, same).groupBy(
        "conv_id", F.floor((F.col("place") - 1) / turns_per_part).cast("int").alias("part"), "n_equal") \
        .agg(F.sort_array(F.collect_set(F.struct("place", shown.alias("shown")))).alias("turns"))
    return parts.select("conv_id", "part", F.size("turns").alias("n_turns"), "n_equal",
                        F.array_join(F.col("turns.shown"), "").alias("rendered"))
