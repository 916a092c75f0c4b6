"""Order-line tables seen as a multi-location sales group.

unit = nation, area = region, ticket = order, item = part.  Repeated
(order, line number) keys are re-sent exports of one line.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import month_start, signed_net, to_local_ntz
from ..operators.cleaning import copies_and_latest, keep_latest
from ..operators.metrics import ticket_rollup, within
from ..sources import pin, write_fact

MONEY = "decimal(12,2)"
RATE = "decimal(4,2)"
NET = "decimal(18,4)"

# Session setting that names the catalog schema with the published facts (see ``publish_mart``).
MART_SETTING = "spark.siteledger.mart"
# Table property of a published fact: the folder of the tables it was derived from.
SOURCE_PROPERTY = "siteledger.source"
# Facts that questions asked together read instead of the source tables (see ``shared_facts``).
_SHARED: ContextVar[Mapping[str, DataFrame] | None] = ContextVar("shared facts", default=None)

LINE_KEY = ("l_orderkey", "l_linenumber")
NEWEST = ("l_shipdate",)
# Every other column the plans read, so that ties leave identical rows only.
TIE_BREAK = ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def state_of(flag: str = "l_returnflag", qty: str = "l_quantity") -> Column:
    """Line state: small returned lines are refunds, small A lines voids, the next size comps."""
    return F.when((F.col(flag) == "R") & (F.col(qty) <= 5), "refund") \
        .when((F.col(flag) == "A") & (F.col(qty) <= 5), "void") \
        .when((F.col(flag) == "A") & (F.col(qty) <= 10), "comp").otherwise("sale")


def _measures(rows: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Typed measures on deduplicated lines, and ``more`` columns.  A refund carries its sign in quantity and gross."""
    sign = F.when(F.col("state") == "refund", -1).otherwise(1)
    value = F.col("l_extendedprice").cast(MONEY)
    base = rows.withColumn("state", state_of()).withColumn("sign", sign) \
        .withColumn("list_value", value) \
        .withColumn("discount", (value * F.col("l_discount").cast(RATE)).cast(NET))
    return base.select(
        F.col("l_orderkey").alias("ticket"), F.col("l_linenumber").alias("line"),
        F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supplier"), "state",
        (F.col("sign") * F.col("l_quantity").cast("int")).alias("qty"),
        "list_value", (F.col("sign") * F.col("list_value")).cast(MONEY).alias("gross"),
        "discount",
        signed_net("state", "sign", "list_value", "discount", NET).alias("net"),
        (value * F.col("l_tax").cast(RATE)).cast(NET).alias("labor"),
        F.col("l_shipdate").cast("date").alias("shipped"), *more)


def line_items(spark: SparkSession, sf_dir: str, tickets: DataFrame | None = None) -> DataFrame:
    """Deduplicated lines without header attributes, of all tickets or of ``tickets`` only.

    The ticket is part of a line's key, so lines of other tickets can go before copies are ranked.  (Attributes
    that copies may differ in, such as the part, can only be filtered on afterwards.)
    """
    raw = table(spark, sf_dir, "lineitem")
    if tickets is not None:
        raw = raw.join(tickets.select(F.col("ticket").alias("l_orderkey")), "l_orderkey", "left_semi")
    return _measures(_newest(raw))


def _newest(raw: DataFrame) -> DataFrame:
    return keep_latest(raw.select(*LINE_KEY, *NEWEST, *TIE_BREAK), LINE_KEY, NEWEST, TIE_BREAK)


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("unit_id"), F.col("n_name").alias("unit"),
        F.col("r_name").alias("area"))


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticket headers with their unit; joined before the lines, which are the larger side."""
    if (shared := _SHARED.get()) is not None:
        return shared["headers"]
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    place = customer.join(units(spark, sf_dir), F.col("c_nationkey") == F.col("unit_id"))
    orders = table(spark, sf_dir, "orders")
    return orders.join(place, orders["o_custkey"] == place["c_custkey"]).select(
        F.col("o_orderkey").alias("ticket"), F.col("o_orderdate").cast("date").alias("day"),
        "unit_id", "unit", "area", F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("decimal(14,2)").alias("order_value"))


def published(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    """A fact that is shared or published, or None when the session names no mart; an error if it was made from other tables."""
    if (shared := _SHARED.get()) is not None:
        return shared[name]
    mart = spark.conf.get(MART_SETTING, None)
    if not mart:
        return None
    found = spark.sql(f"SHOW TBLPROPERTIES {mart}.{name} ('{SOURCE_PROPERTY}')").first()["value"]
    if found != sf_dir.rstrip("/"):
        raise ValueError(f"{mart}.{name} was published from {found}, not from {sf_dir}")
    return spark.table(f"{mart}.{name}")


Span = tuple[str, str]


def _restricted(rows: DataFrame, span: Span | None, unit: str | None) -> DataFrame:
    if unit is not None:
        rows = rows.filter(F.col("unit") == unit)
    return within(rows, "day", span) if span else rows


def _raw_tickets(spark: SparkSession, sf_dir: str, span: Span | None, unit: str | None
                 ) -> tuple[DataFrame, DataFrame]:
    """Headers of a date range or unit and their deduplicated lines."""
    heads = _restricted(headers(spark, sf_dir), span, unit)
    return heads, line_items(spark, sf_dir, heads if span or unit is not None else None)


def sales(spark: SparkSession, sf_dir: str, span: Span | None = None, unit: str | None = None) -> DataFrame:
    """The conformed sales fact at line grain, published or derived, of a date range or one unit if given."""
    fact = published(spark, sf_dir, "sales")
    if fact is not None:
        return _restricted(fact, span, unit)
    heads, lines = _raw_tickets(spark, sf_dir, span, unit)
    return lines.join(heads, "ticket")


def lines_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated lines for questions that need no header attribute."""
    if (shared := _SHARED.get()) is not None:
        return shared["lines"]
    fact = published(spark, sf_dir, "sales")
    return line_items(spark, sf_dir) if fact is None else fact


TICKET_LEVEL = ("ticket", "day", "unit_id", "unit", "area")


def _amounts() -> dict[str, Column]:
    gross = F.col("gross")
    return {"net": F.col("net"), "comp_gross": F.when(F.col("state") == "comp", gross),
            "sale_gross": F.when(F.col("state") == "sale", gross), "labor": F.col("labor")}


def ticket_sales(spark: SparkSession, sf_dir: str, span: Span | None = None, unit: str | None = None) -> DataFrame:
    """One row per ticket with its unit, day and summed measures, of a date range or one unit if given.

    Lines are summed to tickets before the header join; unused sums are pruned.
    """
    fact = published(spark, sf_dir, "tickets")
    if fact is not None:
        return _restricted(fact, span, unit)
    heads, lines = _raw_tickets(spark, sf_dir, span, unit)
    return ticket_rollup(lines, ["ticket"], _amounts()).join(heads, "ticket")


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item master; every 29th part has no cost on file."""
    price = F.col("p_retailprice").cast(MONEY)
    cost = (price * (F.lit(20) + F.col("p_size") % 10 * 2) / F.lit(100)).cast("decimal(12,4)")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part"), F.col("p_name").alias("item_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"), price.alias("price"),
        F.when(F.col("p_partkey") % 29 != 0, cost).alias("unit_cost"))


def purchases_of(rows: DataFrame) -> Column:
    """Purchase cost of a line: quantity x list price, scaled to a plausible cost share."""
    return (F.abs("qty") * F.col("price") * F.lit("0.6").cast("decimal(2,1)")).cast(NET)


def ticket_costs(spark: SparkSession, sf_dir: str, span: Span | None = None, unit: str | None = None) -> DataFrame:
    """One row per ticket with net, labor and purchases, of a date range or one unit if given."""
    shared = _SHARED.get()
    fact = published(spark, sf_dir, "tickets") if shared is None else None
    if fact is not None:
        return _restricted(fact, span, unit)
    if shared is None:
        heads, lines = _raw_tickets(spark, sf_dir, span, unit)
    else:
        lines = _restricted(shared["sales"], span, unit)
    lines = lines.join(parts(spark, sf_dir).select("part", "price"), "part")
    rolled = ticket_rollup(lines.withColumn("purchases", purchases_of(lines)), ["ticket"] if shared is None else list(TICKET_LEVEL), {
        "net": F.col("net"), "labor": F.col("labor"), "purchases": F.col("purchases")})
    return rolled.join(heads, "ticket") if shared is None else rolled


def unit_days(spark: SparkSession, sf_dir: str, category: str) -> DataFrame:
    """Everything that reports need by area, unit and day: amounts, tickets with a sale, those with a category's sale.

    One derivation of the lines; its rows are units x days, whatever the number of tickets.
    """
    fact = published(spark, sf_dir, "sales")
    lines = line_items(spark, sf_dir) if fact is None else fact
    items = parts(spark, sf_dir).select("part", "price", (F.col("category") == category).alias("hit"))
    priced = lines.join(items, "part")
    sale = F.col("state") == "sale"
    rolled = ticket_rollup(priced, ["ticket"], {"net": F.col("net"), "labor": F.col("labor"), "purchases": purchases_of(priced)},
                           {"has_sale": sale, "attached": F.col("hit") & sale})
    # Left, so that a ticket without lines still counts with its order value.
    return headers(spark, sf_dir).join(rolled, "ticket", "left").groupBy("area", "unit", "day").agg(
        *[F.sum(c).alias(c) for c in ("net", "labor", "purchases", "order_value")],
        F.count_if("has_sale").alias("sale_tickets"), F.count_if(F.col("has_sale") & F.col("attached")).alias("attached_tickets"))


def invoice_lines(spark: SparkSession, sf_dir: str, span: Span | None = None) -> DataFrame:
    """Purchases at line grain: one invoice line per sales line, dated by the ticket."""
    lines = sales(spark, sf_dir, span).join(parts(spark, sf_dir), "part")
    return lines.withColumn("purchases", purchases_of(lines))


def copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line key: copies, value of all copies and of the newest one, its net."""
    raw = table(spark, sf_dir, "lineitem").select(*LINE_KEY, *NEWEST, *TIE_BREAK)
    value = F.col("l_extendedprice").cast(MONEY)
    discount = (value * F.col("l_discount").cast(RATE)).cast(NET)
    would_be = F.when(state_of() == "sale", (value - discount).cast(NET))
    sign = F.when(state_of() == "refund", -1).otherwise(1)
    grouped = copies_and_latest(raw, LINE_KEY, NEWEST, TIE_BREAK, {"all_value": would_be})
    keyed = grouped.select(
        F.col("l_orderkey").alias("ticket"), "copies", "all_value", would_be.alias("kept_value"),
        signed_net(state_of(), sign, value, discount, NET).alias("net"))
    return keyed.join(headers(spark, sf_dir), "ticket")


def books(spark: SparkSession, sf_dir: str, span: Span | None = None) -> tuple[DataFrame, DataFrame]:
    """Book A: net per unit-day.  Book B: A with planted differences.  Both of a date range if given.

    Book B may enter a day on the next one, so the tickets of the day before a range are read too.
    By (day number + unit) modulo 60: 0 is not booked; 1 is booked on the next
    day and leaves a zero; 10, 20 and 30 are off by +3, -50 and +75.
    """
    wider = None if span is None else (str(date.fromisoformat(span[0]) - timedelta(days=1)), span[1])
    book_a = ticket_sales(spark, sf_dir, wider).groupBy("unit_id", "unit", "day") \
        .agg(F.sum("net").alias("net"))
    case = (F.datediff("day", F.lit("1995-01-01").cast("date")) + F.col("unit_id")) % 60
    amount = "decimal(38,4)"

    def entry(day: Column, value: Column) -> Column:
        return F.struct(day.alias("day"), value.cast(amount).alias("booked"))

    nudge = F.when(case == 10, 3).when(case == 20, -50).when(case == 30, 75).otherwise(0)
    booked = F.array(entry(F.col("day"), F.col("net") + nudge))
    late = F.array(entry(F.col("day"), F.lit(0)), entry(F.date_add("day", 1), F.col("net")))
    # Dropped days are an empty list rather than a filter, which would be pushed
    # below the aggregate and keep both books from sharing it.
    entries = F.when(case == 0, F.slice(booked, 1, 0)).when(case == 1, late).otherwise(booked)
    book_b = book_a.select("unit", F.inline(entries)).groupBy("unit", "day") \
        .agg(F.sum("booked").alias("booked"))
    book_a = book_a.select("unit", "day", "net")
    return (book_a, book_b) if span is None else (within(book_a, "day", span), within(book_b, "day", span))


ERA_SPLIT = "1998-01-01"
ERA_LAST_DAY = "1997-12-31"
FIRST_DAY = "1995-01-01"


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per location code; every fifth nation was re-coded and has two."""
    nation = units(spark, sf_dir)
    start, split, last = (F.lit(d).cast("date") for d in (FIRST_DAY, ERA_SPLIT, ERA_LAST_DAY))
    code = F.concat(F.lit("L"), F.col("unit_id"))
    never = F.lit(None).cast("date")

    def era(suffix: str, opened: Column, closed: Column, fmt: str) -> Column:
        return F.struct(F.concat(code, F.lit(suffix)).alias("location_code"),
                        F.lit(fmt).alias("service_format"), opened.alias("open_date"),
                        closed.alias("closed_date"))

    eras = F.when(F.col("unit_id") % 5 == 0, F.array(
        era("A", start, last, "full_service"), era("B", split, never, "counter_service"))) \
        .otherwise(F.array(era("", start, never, "full_service")))
    return nation.select("unit_id", "unit", "area", F.inline(eras))


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select("location_code", F.col("unit_id").alias("location_id"))


def unit_eras(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places(spark, sf_dir).select(
        "unit", "location_code", "service_format", F.col("open_date").alias("valid_from"),
        F.col("closed_date").alias("valid_to"))


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order value by unit and month."""
    return headers(spark, sf_dir).groupBy("unit", month_start("day").alias("month_start")) \
        .agg(F.sum("order_value").alias("value"))


def plan_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly plan, only from 1996 on, so early months have no plan row."""
    monthly = monthly_orders(spark, sf_dir).filter(F.col("month_start") >= F.lit("1996-01-01"))
    labor = F.lit("0.040").cast("decimal(5,3)") + F.lit("0.005").cast("decimal(5,3)") \
        * (F.month("month_start") % 4)
    return monthly.select(
        "unit", "month_start", F.col("value").alias("plan_net"),
        (F.col("value") * F.lit("0.3").cast("decimal(2,1)")).cast("decimal(20,4)").alias("plan_purchases"),
        (F.col("value") * labor).cast("decimal(20,4)").alias("plan_labor"))


def raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the name as keyed in: upper-cased, padded or plain."""
    name = F.when(F.col("part") % 3 == 0, F.upper("item_name")) \
        .when(F.col("part") % 3 == 1, F.concat(F.lit(" "), F.col("item_name"), F.lit("  "))) \
        .otherwise(F.col("item_name"))
    return parts(spark, sf_dir).select("part", "item_name", name.alias("keyed_name"))


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alias map: every name but the ``anvil`` ones, in two casings that normalise alike."""
    names = parts(spark, sf_dir).groupBy("item_name").agg(F.min("part").alias("item_id")) \
        .filter(~F.col("item_name").endswith("anvil"))
    spellings = F.array(F.col("item_name"), F.upper("item_name"))
    return names.select(F.explode(spellings).alias("alias"), "item_id", "item_name")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their time as exported text (UTC, trailing Z) and as local wall time."""
    text = F.concat(F.replace(F.col("ts").cast("timestamp_ntz").cast("string"), F.lit(" "), F.lit("T")),
                    F.lit("Z"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", "ts", F.col("event_type").alias("unit"), F.col("value").cast(MONEY).alias("value"),
        text.alias("closed_at"))
    return rows.withColumn("local_ts", to_local_ntz("closed_at", "America/New_York"))


def shared_facts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Headers, deduplicated lines, sales (lines with a header) and tickets, derived once and written for ``sharing``.  Runs jobs.

    Lines are written as exported, with the columns of their header; what follows from these is worked out by who reads it.
    """
    heads = pin(headers(spark, sf_dir), "shared-headers")[0]
    attributes = [c for c in heads.columns if c != "ticket"]
    marked = heads.withColumnRenamed("ticket", "l_orderkey").withColumn("headed", F.lit(True))
    written = pin(_newest(table(spark, sf_dir, "lineitem")).join(marked, "l_orderkey", "left"), "shared-lines")[0]
    sales = _measures(written.filter("headed"), attributes)
    tickets = pin(ticket_rollup(sales, list(TICKET_LEVEL), _amounts()), "shared-tickets")[0]
    return {"headers": heads, "lines": _measures(written), "sales": sales, "tickets": tickets}


@contextmanager
def sharing(facts: Mapping[str, DataFrame] | None) -> Iterator[None]:
    """Questions asked inside, in this thread, read these facts; with None, the source tables."""
    token = _SHARED.set(facts)
    try:
        yield
    finally:
        _SHARED.reset(token)


def publish_mart(spark: SparkSession, sf_dir: str, schema: str, folder: str, buckets: int | None = None) -> str:
    """Derive the sales facts once and register them; later queries read them.

    With ``buckets`` both are also hashed by ticket, so that rolling lines up to tickets and joining tickets needs
    no shuffle; without, they are clustered by unit, so that a unit prunes row groups.

    ``sales`` has lines, ``tickets`` their sums.  Both are partitioned by month
    and clustered inside, so a date range prunes partitions and a unit prunes
    row groups.  Returns the value for ``spark.siteledger.mart``.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    fact = line_items(spark, sf_dir).join(headers(spark, sf_dir), "ticket") \
        .withColumn("month_start", month_start("day"))
    write_fact(fact, f"{folder}/sales", "month_start", ["unit", "day", "ticket", "line"],
               table=f"{schema}.sales", buckets=buckets, bucket_cols=["ticket"])
    lines = spark.table(f"{schema}.sales").join(parts(spark, sf_dir).select("part", "price"), "part")
    gross = F.col("gross")
    tickets = ticket_rollup(
        lines.withColumn("purchases", purchases_of(lines)), [*TICKET_LEVEL, "month_start"], {
            "net": F.col("net"),
            "comp_gross": F.when(F.col("state") == "comp", gross),
            "sale_gross": F.when(F.col("state") == "sale", gross),
            "labor": F.col("labor"), "purchases": F.col("purchases")})
    write_fact(tickets, f"{folder}/tickets", "month_start", ["unit", "day", "ticket"],
               table=f"{schema}.tickets", buckets=buckets, bucket_cols=["ticket"])
    for name in ("sales", "tickets"):
        spark.sql(f"ALTER TABLE {schema}.{name} SET TBLPROPERTIES ('{SOURCE_PROPERTY}' = '{sf_dir.rstrip('/')}')")
    return schema
