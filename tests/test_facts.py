"""Several facts together: stacking, windows, declared checks, layout, versions, digests, the question guard."""

import datetime as dt
import os
import random
import re
import tempfile
import time
from decimal import Decimal as D

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import values
from siteledger import sources
from siteledger.operators import conform, guard, windows
from siteledger.operators.declared import Declared, check_all
from siteledger.operators.drill import Fact, drill_across, stack
from siteledger.operators.quantiles import group_percentile

DAY = dt.date


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="facts-")


# ---- drill across ----

@pytest.fixture
def three_facts(rows):
    net = rows("u string, d date, v decimal(9,2)", ("a", DAY(2025, 1, 5), D(10)), ("a", DAY(2025, 1, 20), D(5)),
               ("a", DAY(2025, 5, 1), D(7)), ("b", DAY(2025, 2, 1), D(1)))
    bought = rows("u string, day date, cost decimal(9,2)", ("a", DAY(2025, 3, 31), D(4)), ("c", DAY(2025, 2, 3), D(2)))
    wages = rows("u string, paid date, w decimal(9,2)", ("a", DAY(2025, 1, 12), D(1)), ("a", None, D(100)))
    return [Fact(net, "d", {"net": "v"}), Fact(bought, "day", {"cost": "cost"}), Fact(wages, "paid", {"labor": "w"})]


def test_every_period_is_there_and_nothing_fans_out(three_facts):
    got = drill_across(three_facts, ["u"])
    assert [(u, m.month, int(n), int(c), int(w)) for u, m, n, c, w in values(got)] == [
        ("a", 1, 15, 0, 1), ("a", 2, 0, 0, 0), ("a", 3, 0, 4, 0), ("a", 4, 0, 0, 0), ("a", 5, 7, 0, 0),
        ("b", 2, 1, 0, 0), ("c", 2, 0, 2, 0)]
    assert got.dtypes[2:] == [("net", "decimal(19,2)"), ("cost", "decimal(19,2)"), ("labor", "decimal(19,2)")]
    assert drill_across(three_facts, ["u"], dense=False).count() == 5


@pytest.mark.parametrize("grain,step", [("week", 7), ("day", 1)])
def test_other_grains_step_by_the_calendar(three_facts, grain, step):
    days = [r[0] for r in drill_across(three_facts, ["u"], grain).filter("u = 'a'").orderBy(f"{grain}_start")
            .select(f"{grain}_start").collect()]
    assert {(b - a).days for a, b in zip(days, days[1:])} == {step}


def test_a_stack_is_one_shuffle(three_facts):
    plan = drill_across(three_facts, ["u"], dense=False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError):
        stack([three_facts[0], three_facts[0]], ["u"])


# ---- windows ----

def test_a_cover_is_exact_and_small(rows):
    rng = random.Random(4)
    spans = [(a := DAY(1960, 1, 1) + dt.timedelta(rng.randint(0, 30000)), a + dt.timedelta(rng.randint(-2, 3000)))
             for _ in range(200)]
    for first, last, blocks in rows("f date, l date", *spans).select("f", "l", windows.cover("f", "l")).collect():
        days = sorted(d for level, block in blocks for d in range(block << level, (block + 1) << level))
        start = (first - DAY(1970, 1, 1)).days + windows.SHIFT
        assert days == list(range(start, start + max(0, (last - first).days + 1)))
        assert len(blocks) <= 2 * max(1, len(days)).bit_length()


def test_ten_thousand_windows_equal_brute_force(spark, rows):
    rng = random.Random(7)
    facts = [("hot" if i % 3 else f"k{i % 5}", DAY(2024, 1, 1) + dt.timedelta(rng.randint(0, 700)), i % 17) for i in range(3000)]
    spans = [("hot" if i % 2 else f"k{i % 7}", DAY(2024, 1, 1) + dt.timedelta(a := rng.randint(-20, 720)),
              DAY(2024, 1, 1) + dt.timedelta(a + rng.choice([-1, 0, 1, 30, 400]))) for i in range(10_000)]
    spans += [spans[0]] * 3 + [("hot", None, DAY(2024, 5, 1)), (None, DAY(2024, 1, 1), DAY(2024, 5, 1))]
    got = windows.window_totals(rows("k string, d date, v int", *facts), "d", {"v": "v", "n": F.lit(1)},
                                rows("k string, f date, l date", *spans), "f", "l", ["k"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    days = {}
    for k, d, v in facts:
        days.setdefault(k, []).append((d, v))
    want = []
    for k, f, l in spans:
        hits = [v for d, v in days.get(k, []) if f and f <= d <= l]
        want.append((k, f, l, sum(hits) if hits else None, len(hits) or None))
    assert values(got) == sorted(want, key=lambda t: tuple((v is not None, str(v)) for v in t))


@pytest.mark.parametrize("salts", [1, 5])
def test_rows_meet_their_windows_once(rows, salts):
    rng = random.Random(9)
    facts = [(i, "a" if i % 4 else "b", DAY(2024, 1, 1) + dt.timedelta(rng.randint(0, 90))) for i in range(300)]
    spans = [(w, "a" if w % 2 else "b", DAY(2024, 1, 1) + dt.timedelta(s := rng.randint(0, 80)),
              DAY(2024, 1, 1) + dt.timedelta(s + rng.randint(0, 40))) for w in range(40)]
    got = windows.in_windows(rows("i int, k string, d date", *facts), "d", rows("w int, k string, f date, l date", *spans),
                             "f", "l", ["k"], salts)
    assert values(got, "i", "w") == sorted(((i, w) for i, k, d in facts for w, j, f, l in spans if j == k and f <= d <= l),
                                           key=str)


# ---- declared checks ----

def test_declared_checks_count_like_the_single_ones(rows):
    tables = {"dim": rows("id int, name string", (1, "x"), (2, "x"), (3, None)),
              "fact": rows("k int, d string, dim smallint, v int", (1, "a", 1, 5), (1, "a", 9, None), (2, None, 9, -1),
                           (2, None, None, 0))}
    declared = {"dim": Declared(keys=[["id"]], unique=["name"], not_null=["name"]),
                "fact": Declared(keys=[["k", "d"], ["k"]], accepted={"d": ["b"]}, references={"dim": ("dim", "id")},
                                 true={"v counts": "v >= 0"})}
    got = dict(values(check_all(tables, declared)))
    assert got == {"grain dim": 0, "unique dim.name": 1, "not_null dim.name": 1, "grain fact": 2, "grain fact 2": 2,
                   "accepted fact.d": 2, "reference fact.dim": 2, "v counts": 1}
    with pytest.raises(ValueError):
        check_all(tables, {"fact": Declared(references={"dim": ("gone", "id")})})
    assert {v for _, v in values(check_all({k: t.limit(0) for k, t in tables.items()}, declared))} == {0}


def test_declared_checks_scan_each_table_once(spark, rows, folder):
    rows("id int", (1,), (2,)).write.parquet(f"{folder}/dim")
    rows("k int, dim int", (1, 1), (1, 3)).write.parquet(f"{folder}/fact")
    tables = {n: spark.read.parquet(f"{folder}/{n}") for n in ("dim", "fact")}
    found = check_all(tables, {"dim": Declared(keys=[["id"]], not_null=["id"]), "fact": Declared(
        keys=[["k"]], not_null=["k", "dim"], references={"dim": ("dim", "id")}, true={"positive": "dim > 0"})})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    assert dict(values(found))["reference fact.dim"] == 1


def test_declared_keys_are_compared_as_numbers_where_they_are(rows):
    tables = {"day": rows("d string, n bigint, v string", ("2001-01-01", 1, "1"), ("2001-01-02", 2, "02"), (None, None, None))
              .selectExpr("cast(d as date) as d", "n", "v"),
              "fact": rows("d string, k smallint, m int, w string", ("2001-01-01", 1, 2, "x"), ("2001-01-03", 1, None, "x"), (None, None, 7, None),
                           (None, None, 7, None)).selectExpr("cast(d as date) as d", "k", "m", "w")}
    rules = {f"rule {i}": f"m <> {i}" for i in range(70)}
    declared = {"day": Declared(keys=[["d", "n"]], unique=["d"]), "fact": Declared(
        keys=[["d", "k", "m"], ["w", "k"]], unique=["k"], references={"d": ("day", "d"), "k": ("day", "n"), "m": ("day", "v")}, true=rules)}
    found = check_all(tables, declared)
    got = dict(values(found))
    assert {n: v for n, v in got.items() if v} == {
        "grain fact": 1, "grain fact 2": 2, "unique fact.k": 1, "reference fact.d": 1, "reference fact.m": 3, "rule 2": 1, "rule 7": 2}
    assert len(got) == 8 + 70
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"cast\([kdn]#\d+ as string\)", plan) and re.search(r"cast\(m#\d+ as string\)", plan)


# ---- layout ----

def test_a_bucketed_fact_rolls_up_without_a_shuffle(spark, folder):
    from siteledger.plans import bindings
    from siteledger.plans.registry import QUERIES
    sf_dir = "/root/testdata/sf0.001"
    schema = bindings.publish_mart(spark, sf_dir, "bucketmart", folder, buckets=4)
    spark.conf.set(bindings.MART_SETTING, schema)
    try:
        for name in ("a07d_attach_rate", "q09_average_ticket", "q12_flagged_tickets", "q20_attach_half_year"):
            plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(ticket" not in plan, name
        lines, tickets = (spark.table(f"{schema}.{n}") for n in ("sales", "tickets"))
        joined = lines.hint("merge").join(tickets.select("ticket", F.col("net").alias("whole")), "ticket").groupBy("ticket").count()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == tickets.count()
    finally:
        spark.conf.unset(bindings.MART_SETTING)
    with pytest.raises(ValueError):
        sources.write_fact(lines, f"{folder}/x", "month_start", ["unit"], buckets=4)


def touched(path, column, low, high):
    """Files and row groups whose statistics overlap a range."""
    files = groups = total_files = 0
    for name in sorted(n for n in os.listdir(path) if n.endswith(".parquet")):
        meta = pq.ParquetFile(os.path.join(path, name)).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hits = sum(s.min <= high and s.max >= low for s in stats)
        total_files, files, groups = total_files + 1, files + bool(hits), groups + hits
    return files, groups, total_files


def test_clustering_by_two_columns_prunes_for_either(spark, folder):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet").select(
        "l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    sources.write_clustered(lines, f"{folder}/z", ["day", "l_partkey"], files=64, bloom=["l_partkey"], row_group_bytes=8192)
    sources.write_fact(lines.withColumn("p", F.lit(0)), f"{folder}/plain", "p", ["day"])
    days = lines.agg(F.min("day"), F.max("day")).first()
    low, high = days[0], days[0] + (days[1] - days[0]) / 16
    most = lines.agg(F.max("l_partkey")).first()[0]
    for column, ends in (("day", (low, high)), ("l_partkey", (most // 2, most // 2))):
        files, _, of = touched(f"{folder}/z", column, *ends)
        assert of == 64 and 0 < files <= 24, (column, files)
    plain = f"{folder}/plain/p=0"
    files, _, of = touched(plain, "l_partkey", most // 2, most // 2)
    assert files == of
    assert values(spark.read.parquet(f"{folder}/z")) == values(lines)
    with pytest.raises(ValueError):
        sources.write_clustered(lines.withColumn("s", F.lit("x")), f"{folder}/y", ["s"], files=2)


def test_column_statistics_change_the_join_order(spark, rows, folder):
    big = spark.range(4000).select((F.col("id") % 40).alias("a"), (F.col("id") % 1000).alias("b"), F.lit("m").alias("m"))
    one = spark.range(40).select(F.col("id").alias("a"), F.lit("m").alias("m"))
    two = spark.range(1000).select(F.col("id").alias("b"), (F.col("id") % 500).alias("tag"), F.lit("m").alias("m"))
    settings = ["spark.sql.cbo.enabled", "spark.sql.cbo.joinReorder.enabled"]
    for s in settings:
        spark.conf.set(s, "true")
    try:
        orders = []
        for stats in ((), ("a", "b", "tag")):
            kind = "with" if stats else "without"
            for name, df in (("big", big), ("one", one), ("two", two)):
                sources.write_fact(df, f"{folder}/{kind}/{name}", "m", [df.columns[0]], table=f"{kind}_{name}")
                if stats:
                    sources.analyze_columns(spark, f"{kind}_{name}", [c for c in stats if c in df.columns], histograms=False)
            query = spark.sql(f"""SELECT count(*) FROM {kind}_big g JOIN {kind}_one o ON g.a = o.a
                                  JOIN {kind}_two t ON g.b = t.b WHERE t.tag = 3""")
            plan = query._jdf.queryExecution().optimizedPlan().toString()
            orders.append(re.findall(r"Join Inner, \((\w)#", plan))
            assert query.first()[0] == 8
        known = sources.column_statistics(spark, "with_two", ["b", "tag"])
        assert values(known, "column", "nulls", "least", "greatest", "histogram") == [("b", 0, "0", "999", False), ("tag", 0, "0", "499", False)]
        assert orders == [["b", "a"], ["a", "b"]]
    finally:
        for s in settings:
            spark.conf.unset(s)


# ---- versions ----

def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_a_bad_second_feed_leaves_every_old_table(spark, folder):
    columns = ["k", "v"]
    good = {n: (write(f"{folder}/{n}.csv", "k,v\n1,a\n"), columns) for n in ("one", "two")}
    sources.land_all(spark, good, f"{folder}/raw")
    bad = {"one": (write(f"{folder}/one2.csv", "k,v\n1,a\n2,b\n"), columns),
           "two": (write(f"{folder}/two2.csv", "k,v\n1\n"), columns)}
    with pytest.raises(Exception):
        sources.land_all(spark, bad, f"{folder}/raw")
    assert {n: spark.read.parquet(f"{folder}/raw/{n}").count() for n in good} == {"one": 1, "two": 1}
    bad["two"] = good["two"]
    assert values(sources.land_all(spark, bad, f"{folder}/raw")) == [("one", 2), ("two", 1)]
    assert spark.read.parquet(f"{folder}/raw/one").count() == 2
    assert not [n for n in os.listdir(f"{folder}/raw") if n.startswith(("_staged", "_replaced")) and os.listdir(f"{folder}/raw/{n}")]


def test_versions_swap_together_or_not_at_all(spark, rows, folder):
    target = f"{folder}/marts"

    def audit(tables):
        return check_all(tables, {"b": Declared(references={"k": ("a", "k")})})

    def tables(n):
        return {"a": rows("k int", *[(i,) for i in range(n)]), "b": rows("k int", (n - 1,))}

    with pytest.raises(ValueError, match="nothing has been published"):
        sources.read_current(spark, target, "a")
    sources.replace_all(tables(2), target, audit)
    first, old = sources.current_version(spark, target), sources.read_current(spark, target, "a")
    with pytest.raises(sources.AuditError, match="reference b.k: 1"):
        sources.replace_all({**tables(5), "b": rows("k int", (99,))}, target, audit)
    with pytest.raises(Exception):
        sources.replace_all({"a": rows("k int", (1,)), "b": rows("k int", (1,)).select(F.raise_error(F.lit("bad")).alias("k"))}, target)
    assert sources.current_version(spark, target) == first
    assert sources.publish_all(tables(3), "versioned", target, audit).count() == 2
    assert spark.table("versioned.a").count() == 3 and old.count() == 2
    sources.publish_all(tables(4), "versioned", target)
    assert spark.table("versioned.a").count() == 4
    assert len([n for n in os.listdir(target) if n != "_log"]) == 2


def test_a_table_is_replaced_only_after_its_audit(spark, rows):
    def audit(found):
        return check_all(found, {"t": Declared(not_null=["k"])})

    for n in (1, 2):
        sources.publish(rows("k int", *[(i,) for i in range(n)]), "auditmart", "t", kind="table", audit=audit)
        assert spark.table("auditmart.t").count() == n
    with pytest.raises(sources.AuditError):
        sources.publish(rows("k int", (None,)), "auditmart", "t", kind="table", audit=audit)
    assert spark.table("auditmart.t").count() == 2
    assert [r.tableName for r in spark.sql("SHOW TABLES IN auditmart").collect() if not r.isTemporary] == ["t"]


# ---- digests ----

def test_a_changed_partition_is_named_and_only_it_is_read(spark, rows, folder):
    by = ["y", "m"]
    df = rows("y int, m int, v string", *[(2020 + i % 3, i % 4, f"v{i}") for i in range(200)], (2020, None, "null month"))
    tree = sources.tree_digest(sources.partition_digests(df, by), by)
    top = tree.filter("level = 0").first()
    whole = sources.fingerprint(df).first()
    assert (top.n_rows, f"{top.d1}-{top.d2}") == (whole.n_rows, whole.digest)
    other = df.withColumn("v", F.when(F.col("v") == "v7", "w7").otherwise(F.col("v"))) \
        .filter("not (y <=> 2020 and m is null)").unionByName(rows("y int, m int, v string", (1999, 1, "x")))
    now = sources.tree_digest(sources.partition_digests(other.repartition(7), by), by)
    assert values(sources.changed(now, tree, by)) == sorted([
        (2021, 3, "contents differ"), (2020, None, "missing"), (1999, 1, "added")], key=lambda t: tuple((v is not None, str(v)) for v in t))
    assert not sources.changed(tree, tree, by).take(1)

    path = f"{folder}/t"
    df.write.partitionBy(*by).parquet(path)
    nothing = sources.partition_digests(spark.read.parquet(path), by).withColumn("files", F.lit(None).cast("decimal(38,0)")).limit(0)
    first = sources.verify_partitions(spark.read.parquet(path), by, nothing)
    stored = spark.createDataFrame(first.collect(), first.schema)
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        spark.createDataFrame([("z", 2021, 3)], "v string, y int, m int").write.mode("overwrite").partitionBy(*by).parquet(path)
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    current = spark.read.parquet(path)
    again = sources.verify_partitions(current, by, stored)
    assert values(again.drop("files")) == values(sources.partition_digests(current, by))
    assert values(sources.changed(sources.tree_digest(again, by), sources.tree_digest(stored, by), by)) == [(2021, 3, "contents differ")]
    # What was stored is not recomputed: a wrong stored digest of an unchanged partition stays.
    wrong = stored.withColumn("n_rows", F.lit(-1).cast("bigint"))
    assert sorted(r.n_rows for r in sources.verify_partitions(current, by, wrong).collect()) == [-1] * (stored.count() - 1) + [1]


# ---- guard, skew, percentiles ----

def test_failing_and_endless_questions_are_rows(spark, rows):
    def endless():
        slow = F.udf(lambda x: time.sleep(600) or x, "long")
        return spark.range(8).repartition(8).select(slow("id").alias("x")).filter("x >= 0")

    def hangs():
        time.sleep(30)

    started = time.monotonic()
    got = guard.run_questions(spark, {
        "good": lambda: spark.range(3), "none": lambda: spark.range(0), "endless": endless, "hangs": hangs,
        "fails": lambda: spark.range(3).select(F.raise_error(F.lit("boom"))), "unknown": lambda: spark.table("no_such_table"),
        "last": lambda: spark.range(1)}, seconds=6, at_once=2).collect()
    assert [(r.question, r.status) for r in got] == [
        ("good", "rows"), ("none", "empty"), ("endless", "timeout"), ("hangs", "timeout"), ("fails", "error"),
        ("unknown", "error"), ("last", "rows")]
    assert time.monotonic() - started < 60
    assert "no_such_table" in got[5].detail


def test_a_hot_part_spreads_over_tasks(spark, rows):
    facts = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int").alias("part"),
                                       F.lit(1).alias("one"))
    dim = spark.range(4000).select(F.col("id").cast("int").alias("part"), F.concat(F.lit("p"), "id").alias("name"))
    assert 7 in conform.heavy_values(facts, "part")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for how in ("inner", "left"):
            joined = conform.skew_join(facts, dim, "part", how)
            assert joined.columns == ["part", "one", "name"]
            assert values(joined.groupBy("part", "name").count()) == values(facts.join(dim, "part", how).groupBy("part", "name").count())
        sizes = [r["count"] for r in joined.filter("part = 7").groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert len(sizes) >= 12 and max(sizes) < 0.25 * sum(sizes)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert conform.skew_join(facts.limit(0), dim, "part").count() == 0
    with pytest.raises(ValueError):
        conform.skew_join(facts, dim, "part", "right")


@pytest.mark.parametrize("p", [0.0, 0.1, 0.5, 1.0])
def test_percentiles_of_large_groups_are_exact(spark, monkeypatch, p):
    from siteledger.operators import quantiles
    monkeypatch.setattr(quantiles, "SKETCH", 100)
    df = spark.range(20_000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 == 0, 1.0).otherwise(
        F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double")).alias("v"), F.lit(2).alias("w"))
    want = df.groupBy("g").agg(F.expr(f"percentile(v, {p})").alias("v"), F.expr(f"percentile(w, {p})").alias("w"))
    assert values(group_percentile(df, ["g"], ["v", "w"], p)) == values(want)
