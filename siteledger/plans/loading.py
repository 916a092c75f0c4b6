"""Landing, layering and fingerprinting on the bound tables.

These queries write copies of whole tables into the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import sources
from ..functions import month_start, parse_dates
from ..operators.cleaning import cast_columns
from ..operators.declared import Declared, check_all
from ..session import shared_dir
from . import bindings as b
from .analyses import plain
from .conforming import ORDER_TYPES, order_text

ORDER_COLUMNS = ("order_key", "order_date", "order_value", "priority")
CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_mktsegment")


def folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}"


def _order_csv(spark: SparkSession, sf_dir: str, name: str) -> str:
    path = folder(spark, name)
    order_text(spark, sf_dir).select(*ORDER_COLUMNS).write.mode("overwrite") \
        .option("header", True).csv(path)
    return path


def s1_read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sources.read_raw(spark, _order_csv(spark, sf_dir, "s1/orders"), ORDER_COLUMNS)
    typed = cast_columns(raw, ORDER_TYPES)
    return plain(typed.select("order_key", parse_dates("order_date").alias("order_date"),
                              "order_value"))


def s2_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = folder(spark, "s2/customers")
    b.table(spark, sf_dir, "customer").select(*CUSTOMER_COLUMNS).write.mode("overwrite") \
        .option("header", True).csv(customers)
    feeds = {"orders": (_order_csv(spark, sf_dir, "s2/orders"), ORDER_COLUMNS),
             "customers": (customers, CUSTOMER_COLUMNS)}
    return sources.land_all(spark, feeds, folder(spark, "s2/raw"))


def s3_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = sources.publish(b.headers(spark, sf_dir), "staging", "tickets")
    return plain(spark.table(view).groupBy("area").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("order_value").alias("value")))


def s4_sample_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.headers(spark, sf_dir).select("ticket", "day", "unit", "order_value")
    return plain(sources.sample_extract(rows, ["day", "ticket"]))


def s5_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Amounts as decimals and times as dates, whose text is the same in every engine."""
    lines = b.table(spark, sf_dir, "lineitem")
    amounts = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}
    return sources.fingerprint(lines.select(*[
        F.col(c).cast("decimal(18,4)") if c in amounts else F.col(c).cast("date") if c == "l_shipdate" else c
        for c in lines.columns]))


def s5_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Against a manifest of the originals: same rows reshuffled pass, one changed row does not."""
    orders, supplier = b.table(spark, sf_dir, "orders"), b.table(spark, sf_dir, "supplier")
    stored = sources.manifest({"orders": orders, "suppliers": supplier, "gone": supplier})
    bumped = F.when(F.col("s_suppkey") == 0, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal"))
    return sources.verify({"orders": orders.repartition("o_custkey"),
                           "suppliers": supplier.withColumn("s_acctbal", bumped),
                           "extra": supplier}, stored)


def s6_write_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = folder(spark, "s6/tickets")
    fact = b.headers(spark, sf_dir).withColumn("month_start", month_start("day"))
    sources.write_fact(fact, path, "month_start", ["unit", "day", "ticket"])
    stored = spark.read.parquet(path).filter("month_start >= date'1999-01-01'")
    return plain(stored.groupBy("month_start").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("order_value").alias("value")))


def s3_publish_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart as a table, replaced once: the second load is written and audited before the first one goes."""
    heads = b.headers(spark, sf_dir)

    def audit(tables: Mapping[str, DataFrame]) -> DataFrame:
        return check_all(tables, {"tickets": Declared(keys=[["ticket"]], not_null=["unit", "day"])})

    sources.publish(heads.filter("area = 'ASIA'"), "published", "tickets", kind="table", audit=audit)
    table = sources.publish(heads, "published", "tickets", kind="table", audit=audit)
    return plain(spark.table(table).groupBy("area").agg(
        F.count(F.lit(1)).alias("tickets"), F.sum("order_value").alias("value")))


def s3_replace_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables replaced together; the second attempt breaks its audit and changes nothing."""
    target = folder(spark, "s3/marts")
    heads, lines = b.headers(spark, sf_dir), b.line_items(spark, sf_dir)

    def audit(tables: Mapping[str, DataFrame]) -> DataFrame:
        return check_all(tables, {"tickets": Declared(keys=[["ticket"]]), "lines": Declared(
            references={"ticket": ("tickets", "ticket")})})

    sources.replace_all({"tickets": heads, "lines": lines}, target, audit)
    try:
        sources.replace_all({"tickets": heads.filter("area = 'ASIA'"), "lines": lines}, target, audit)
        refused = False
    except sources.AuditError:
        refused = True
    counts = [sources.read_current(spark, target, name).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(name).alias("table"), "n_rows", F.lit(refused).alias("second_refused")) for name in ("tickets", "lines")]
    return counts[0].unionByName(counts[1])


def s5_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A correction of the last day's tickets is found by area and month from digests alone."""
    by = ["area", "month_start"]
    heads = b.headers(spark, sf_dir).withColumn("month_start", month_start("day"))
    stored = sources.partition_digests(heads, by)
    last = heads.agg(F.max("day")).scalar()
    fixed = F.when(F.col("day") == last, F.col("order_value") + 1).otherwise(F.col("order_value")).cast("decimal(14,2)")
    now = sources.partition_digests(heads.withColumn("order_value", fixed), by)
    return sources.changed(sources.tree_digest(now, by), sources.tree_digest(stored, by), by)


def s6_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines interleaved by date and item, with a Bloom filter on the item: read by either one alone."""
    path = folder(spark, "s6/lines")
    lines = b.line_items(spark, sf_dir).select("ticket", "line", "part", "shipped", "qty")
    sources.write_clustered(lines, path, ["shipped", "part"], files=16, bloom=["part"])
    stored = spark.read.parquet(path)
    reads = {"date": stored.filter("shipped between date'1997-03-01' and date'1997-03-31'"),
             "item": stored.filter("part = 17"), "all": stored}
    parts = [rows.agg(F.count(F.lit(1)).alias("n_lines"), F.sum("qty").alias("qty"))
             .select(F.lit(name).alias("access"), "n_lines", "qty") for name, rows in reads.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def s6_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the catalog knows of the ticket fact's columns; distinct counts are estimates, so only their nearness is told."""
    columns = ["unit", "day", "ticket", "order_value", "late_value"]
    late = F.when(F.col("day") >= F.lit("2000-01-01").cast("date"), F.col("order_value"))
    fact = b.headers(spark, sf_dir).withColumn("late_value", late).withColumn("month_start", month_start("day"))
    table = "s6_statistics_tickets"
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    sources.write_fact(fact, folder(spark, "s6/statistics"), "month_start", ["unit", "day"], table=table,
                       column_statistics=columns)
    exact = spark.table(table).agg(*[F.count_distinct(c).alias(c) for c in columns]) \
        .unpivot([], columns, "column", "exact")
    known = sources.column_statistics(spark, table, columns)
    near = F.abs(F.col("n_distinct") - F.col("exact")) <= 0.15 * F.col("exact")
    return known.join(exact, "column").select("column", "nulls", "least", "greatest", "histogram", near.alias("near"))


LOADING = {f.__name__: f for f in (
    s1_read_raw, s2_land, s3_publish, s4_sample_extract, s5_fingerprint, s5_verify,
    s6_write_fact, s3_publish_table, s3_replace_all, s5_partitions, s6_clustered, s6_statistics)}
