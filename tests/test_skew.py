"""One customer, nation, year and card hold a third and more of all rows."""

import io
import contextlib
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import oracle
from conftest import SMALL
from tillflow import workload
from tillflow.catalog import ORACLES, QUERIES
from tillflow.operators.keyed import last_write
from tillflow.plans.rows import transactions
from tillflow.schema import HOT

ORDERS, CUSTOMERS = 30_000, 2_000


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """Tables in many files; two orders of three belong to customer 0."""
    root = str(tmp_path_factory.mktemp("skewed"))
    keys = spark.range(0, ORDERS, 1, 24).withColumnRenamed("id", "o_orderkey")
    keys.select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 < 2, 0).otherwise(F.col("o_orderkey") % CUSTOMERS).cast("bigint").alias("o_custkey"),
        ((F.col("o_orderkey") * 37 % 100000) / 100).alias("o_totalprice"),
        F.expr("timestamp_ntz'1997-01-01' + make_dt_interval(cast(o_orderkey % 900 as int))").alias("o_orderdate"),
    ).write.parquet(f"{root}/orders.parquet")
    spark.range(0, CUSTOMERS, 1, 8).select(
        F.col("id").alias("c_custkey"), F.format_string("Customer#%09d", "id").alias("c_name"),
        (F.col("id") % 5).cast("int").alias("c_nationkey"), F.lit("BUILDING").alias("c_mktsegment"),
    ).write.parquet(f"{root}/customer.parquet")
    spark.range(5).select(F.col("id").cast("int").alias("n_nationkey"),
                          F.format_string("NATION_%d", "id").alias("n_name")).write.parquet(f"{root}/nation.parquet")
    return root


def expected():
    for o in range(ORDERS):
        customer = 0 if o % 3 < 2 else o % CUSTOMERS
        yield o, f"Customer#{customer:09d}", f"NATION_{customer % 5}", \
            datetime(1997, 1, 1) + timedelta(days=o % 900), (o * 37 % 100000) / 100


@pytest.fixture(scope="module")
def copies(tmp_path_factory):
    """Tables of which a third are copies of two orders."""
    root = tmp_path_factory.mktemp("copies")
    for name in oracle.TABLES:
        if name != "orders":
            (root / f"{name}.parquet").symlink_to(f"{SMALL}/{name}.parquet")
    duckdb.execute(f"""COPY (
        SELECT * FROM '{SMALL}/orders.parquet' UNION ALL
        SELECT o.* FROM '{SMALL}/orders.parquet' o, range(400) WHERE o_orderkey IN (7, 13)
    ) TO '{root}/orders.parquet'""")
    return str(root)


@pytest.mark.parametrize("name", [
    "archive_rows", "surviving_rows", "last_write_per_key", "main_hot_table", "main_archive", "main_card_sales",
    "variant_sinks_agree", "quarantine_counts", "serving_top100_country"])
def test_copies(spark, copies, name):
    assert oracle.assert_equal(QUERIES[name](spark, copies), oracle.connect(copies), ORACLES[name]) > 0


@pytest.fixture
def no_broadcast(confs):
    """Joins as at scale: no side fits a broadcast, small skew thresholds."""
    confs(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
          spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
          spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
          spark__sql__adaptive__skewJoin__skewedPartitionFactor="2")


def test_hot_customer_is_split_in_the_join(spark, skewed, no_broadcast):
    df = workload.order_topic(spark, skewed)
    assert len(df.collect()) == ORDERS
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    final = out.getvalue().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final


@pytest.mark.parametrize("name", ["agg_year_count", "agg_year_count_shared", "stream_agg_year_count"])
def test_totals(spark, skewed, no_broadcast, name):
    got = {r.tran_year: r.tran_year_count for r in QUERIES[name](spark, skewed).collect()}
    want = Counter()
    for o, _, _, date, _ in expected():
        users = o % 4 if name.endswith("shared") else 1
        for pos in range(users):
            want[(date + timedelta(days=200 * pos)).year] += 1
    assert got == want


def test_last_write_of_a_hot_key(spark, skewed, no_broadcast):
    rows = transactions(workload.order_topic(spark, skewed), HOT, mode="passthrough")
    got = {r.user_id: (r.tran_date, r.tran_amount) for r in last_write(rows, "user_id").collect()}
    last = defaultdict(lambda: (-1, -1, datetime.min, 0.0))
    for o, name, _, date, amount in expected():
        last[name] = max(last[name], (o % 8, o // 8, date, amount))
    assert got == {name: (f"{d:%Y-%m-%d %H:%M:%S}", a) for name, (_, _, d, a) in last.items()}


def test_every_order_is_archived(spark, skewed, no_broadcast):
    got = QUERIES["archive_roundtrip"](spark, skewed).groupBy("nationality").count().collect()
    assert {r[0]: r[1] for r in got} == Counter(nation for _, _, nation, _, _ in expected())
