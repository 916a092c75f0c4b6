"""Exact dedup by a heavy-hitter split; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .bloom import listed_or_not
from .common import keep

# The white space that does not count when texts are compared.
SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), SPACE, "")


def digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, digest, size): SHA-256 of the normalised text and its original code points."""
    return docs.select(F.col(doc_id).alias("doc_id"),
                       F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("digest"),
                       F.length(F.coalesce(F.col(text), F.lit(""))).alias("size"))


def winners(rows: DataFrame) -> DataFrame:
    """Per digest the row that stays (longest, then smallest id) and the group's size."""
    best = F.max(F.struct(F.col("size"), (-F.col("doc_id").cast("decimal(20,0)")).alias("neg"),
                          F.col("doc_id")))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("group_size")) \
        .select("digest", F.col("best.doc_id").alias("keep_id"), "group_size")


def _split(rows: DataFrame, counters: int) -> tuple[DataFrame, DataFrame]:
    """Verified winners of the frequent digests, and the rows of all other digests."""
    frequent = rows.stat.freqItems(["digest"], 1.0 / counters) \
        .select(F.explode("digest_freqItems").alias("digest"))
    frequent = keep(frequent, "frequent")
    heavy = keep(winners(rows.join(F.broadcast(frequent), "digest", "left_semi")), "heavy")
    return heavy, rows.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")


def find_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                counters: int = 1000) -> DataFrame:
    """Every row with the row that stands for its text: doc_id, digest, keep_id, group_size.

    1. Digests, ids and sizes are written once to the shared folder; texts are read no more.
    2. ``freqItems`` is the Misra-Gries summary (Karp, Shenker, Papadimitriou): at most
       ``counters`` counters per task, merged pairwise; each digest above rows/counters
       is among them.
    3. The true winners of these candidates come from one aggregate.  They number at most
       ``counters``, so they are broadcast, and their rows are settled on the map side.
    4. All other digests are shuffled as usual; none of them holds more than 1/counters
       of the rows, and the aggregate combines copies before the shuffle.

    Null text counts as empty; empty texts are one group.  A null id loses to any other id of
    the same size.  Repeated rows each count in ``group_size`` and name the same winner.
    No rows give no rows; other columns of ``docs`` are not looked at.  Runs jobs.
    """
    rows = keep(digests(docs, doc_id, text), "digests")
    heavy, rest = _split(rows, counters)
    columns = ["doc_id", "digest", "keep_id", "group_size"]
    settled = rows.join(F.broadcast(heavy), "digest").select(columns)
    return settled.unionAll(rest.join(winners(rest), "digest").select(columns))


def drop_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                counters: int = 1000) -> DataFrame:
    """The documents that stay, with all their columns unchanged.

    Copies of a frequent text go on the map side, before any text is shuffled; the others by an
    anti-join with the rows that lose, which only rows that may be among them take part in.  Rows repeated with the same id and text are one
    document, of which one row stays.  Otherwise as ``find_copies``.
    """
    rows = keep(digests(docs, doc_id, text), "digests")
    heavy, rest = _split(rows, counters)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    losers = keep(rest.join(winners(rest), "digest").where(~stays).select(
        F.xxhash64("digest", "doc_id").alias("h"), F.col("digest").alias("_digest"), F.col("doc_id").alias("_lost"))
        .distinct(), "losers")
    named = heavy.select(F.col("digest").alias("_digest"), F.col("keep_id").alias("_stays"),
                         F.lit(True).alias("_heavy"))
    # The row travels as one struct, so no column of it can clash with the names used here.
    marked = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("own_id"),
                         F.unhex(F.sha2(normalised(F.col(text)), 256)).alias("_digest"))
    light = marked.join(F.broadcast(named), "_digest", "left").where(
        F.col("_heavy").isNull() | F.col("own_id").eqNullSafe(F.col("_stays"))) \
        .select("row", "own_id", F.col("_digest").alias("own"), F.xxhash64("_digest", "own_id").alias("h"))
    maybe, sure = listed_or_not(light, "h", losers)
    kept = maybe.join(losers.drop("h"), (F.col("own") == F.col("_digest")) & F.col("own_id").eqNullSafe(F.col("_lost")),
                      "left_anti").unionAll(sure)
    repeats = keep(rows.groupBy("doc_id", "digest").count().where("count > 1")
                   .select(F.col("doc_id").alias("_again"), F.col("digest").alias("_digest")), "repeats")
    if repeats.isEmpty():
        return kept.select("row.*")
    same = (F.col("own") == F.col("_digest")) & F.col("own_id").eqNullSafe(F.col("_again"))
    once = kept.join(repeats, same, "left_anti")
    first = kept.join(repeats, same, "left_semi").dropDuplicates(["own_id", "own"])
    return once.unionAll(first).select("row.*")
