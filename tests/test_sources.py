import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import values
from siteledger import sources
from siteledger.sources import RAW_FEEDS


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="sources-")


COLUMNS = RAW_FEEDS["ap_vendors"]


def test_text_only_with_quotes_and_blanks(spark, folder):
    path = write(folder, "v.csv", 'vendor_id,vendor_name,vendor_category\n01,"A, ""B"" Co",\n2,x,y\n')
    df = sources.read_raw(spark, path, COLUMNS)
    assert set(t for _, t in df.dtypes) == {"string"}
    assert values(df) == [("01", 'A, "B" Co', None), ("2", "x", "y")]


@pytest.mark.parametrize("text", [
    "vendor_name,vendor_id,vendor_category\na,1,x\n",
    "vendor_id,vendor_name,vendor_category\n1,a\n",
])
def test_moved_columns_and_short_rows_fail(spark, folder, text):
    with pytest.raises(Exception):
        sources.read_raw(spark, write(folder, "v.csv", text), COLUMNS).collect()


def test_land_is_repeatable_and_counts(spark, folder):
    path = write(folder, "v.csv", "vendor_id,vendor_name,vendor_category\n1,a,x\n2,b,y\n")
    target = os.path.join(folder, "raw")
    for _ in range(2):
        assert values(sources.land_all(spark, {"vendors": (path, COLUMNS)}, target)) == [("vendors", 2)]
    assert spark.read.parquet(f"{target}/vendors").count() == 2


def test_missing_input_leaves_the_previous_load(spark, folder):
    path = write(folder, "v.csv", "vendor_id,vendor_name,vendor_category\n1,a,x\n")
    target = os.path.join(folder, "raw")
    sources.land_all(spark, {"vendors": (path, COLUMNS)}, target)
    empty = write(folder, "w.csv", "vendor_id,vendor_name,vendor_category\n")
    with pytest.raises(Exception):
        sources.land_all(spark, {"vendors": (empty, COLUMNS), "gone": (f"{folder}/none.csv", COLUMNS)}, target)
    assert spark.read.parquet(f"{target}/vendors").count() == 1


def test_layers(spark, rows):
    df = rows("k int", (1,), (2,))
    assert sources.publish(df, "staging", "numbers") == "staging__numbers"
    assert spark.table("staging__numbers").count() == 2
    for _ in range(2):
        assert sources.publish(df, "testmarts", "numbers", kind="table") == "testmarts.numbers"
    assert spark.table("testmarts.numbers").count() == 2
    with pytest.raises(ValueError):
        sources.publish(df, "staging", "numbers", kind="cube")


def test_sample_and_fact_layout(spark, rows, folder):
    df = rows("m string, k int", *[("m%d" % (i % 3), i) for i in range(60)])
    assert [r.k for r in sources.sample_extract(df, [F.desc("k")], 2).collect()] == [59, 58]
    path = f"{folder}/fact"
    sources.write_fact(df, path, "m", ["k"])
    assert sorted(d for d in os.listdir(path) if d.startswith("m=")) == ["m=m0", "m=m1", "m=m2"]
    assert values(spark.read.parquet(path), "m", "k") == values(df, "m", "k")
    sources.write_fact(df, f"{folder}/fact2", "m", ["k"], table="fact_numbers")
    stats = spark.sql("DESCRIBE EXTENDED fact_numbers").filter("col_name = 'Statistics'").first()
    assert "60 rows" in stats.data_type


def test_fingerprint_ignores_order_and_sees_changes(rows):
    df = rows("a int, b string", *[(i % 7, str(i)) for i in range(50)])
    same = df.orderBy(F.desc("b")).repartition(6)
    assert values(sources.fingerprint(df)) == values(sources.fingerprint(same))
    stored = sources.manifest({"t": df})
    assert not sources.verify({"t": same}, stored).take(1)
    twice = df.unionByName(df.limit(1))
    assert values(sources.verify({"t": twice, "u": df}, stored)) == [("t", "contents differ"), ("u", "not in manifest")]
    assert values(sources.fingerprint(df.limit(0))) == [(0, "0-0")]


def test_pin_writes_into_the_session_folder(spark, rows):
    from siteledger.session import shared_dir
    pinned, n = sources.pin(rows("a int", (1,), (2,)), "numbers")
    assert n == 2 and values(pinned) == [(1,), (2,)]
    assert shared_dir(spark) in pinned.inputFiles()[0]


def test_fingerprint_sees_where_a_null_is(spark):
    def digest(schema, *data):
        return sources.fingerprint(spark.createDataFrame(list(data), schema)).first().digest
    seen = {digest("a int, b int", (None, 1)), digest("a int, b int", (1, None)), digest("a int", (1,)),
            digest("a string, b string", ("1:1", None)), digest("a string, b string", ("", "1"))}
    assert len(seen) == 5
    one, other = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(1,)], "a bigint")
    assert values(sources.verify({"t": other}, sources.manifest({"t": one}))) == [("t", "schema differs")]


def test_a_session_off_local_mode_needs_a_shared_folder(spark, monkeypatch):
    from siteledger import session

    class Elsewhere:
        conf = type("C", (), {"get": staticmethod(lambda *a: None)})
        sparkContext = type("S", (), {"master": "spark://host:7077"})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Elsewhere)
