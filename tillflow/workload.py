"""Messages built from the driver's tables: the input of queries, tests and bench.

A message is made from one order row and the customer and nation it belongs to,
so nothing is ever grouped to build it. Joins carry no hints: Catalyst broadcasts
a side whose size statistics allow it, and AQE splits a skewed customer key
because nothing downstream depends on the join's partitioning.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillflow.operators.messages import DEFAULT_CARDS, DEFAULT_PRODUCT
from tillflow.plans.publish import payload
from tillflow.schema import TOPIC
from tillflow.session import shared_dir
from tillflow.sources.epochs import Folder
from tillflow.sources.topics import topic_files

# Fixed value: the topic's name.
TOPIC_NAME = "commerce"
PARTITIONS = 8
DAY = 86400


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order with its customer's name, segment and nation."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("o_epoch"))
    customer = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey))


def _of_sales(build: Callable[[DataFrame], DataFrame]) -> Callable[..., DataFrame]:
    """A topic made from the rows of ``sales``, all of them or those handed over."""
    @wraps(build)
    def topic(spark: SparkSession, sf_dir: str, rows: DataFrame | None = None) -> DataFrame:
        return build(sales(spark, sf_dir) if rows is None else rows)
    return topic


def _tagged(tag: str) -> Column:
    return F.concat(F.lit(f"{tag}-"), F.col("c_custkey").cast("string")).alias(tag)


def _whole_user(number: int) -> Column:
    """The same with every leaf filled, no two of them alike."""
    user = _user(number)["user"]
    return F.struct(F.struct(
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("gender"),
        F.struct(user["name"]["title"].alias("title"), _tagged("first"), user["name"]["last"].alias("last")).alias("name"),
        F.struct(
            _tagged("street"), user["location"]["city"].alias("city"),
            F.concat(F.lit("state-"), F.col("c_nationkey").cast("string")).alias("state"),
            user["location"]["zip"].alias("zip"),
        ).alias("location"),
        _tagged("email"), user["username"].alias("username"), _tagged("password"), _tagged("salt"), _tagged("md5"),
        _tagged("sha1"), _tagged("sha256"), user["registered"].alias("registered"),
        (F.col("o_epoch") - 9000 * DAY).alias("dob"), _tagged("phone"), _tagged("cell"), _tagged("PPS"),
        F.struct(_tagged("large"), _tagged("medium"), _tagged("thumbnail")).alias("picture"),
    ).alias("user"))


def _user(number: int) -> Column:
    """User ``number`` of a message; those after the first get a suffixed name."""
    name = F.col("c_name") if number == 0 else F.concat("c_name", F.lit(f"-{number}"))
    return F.struct(F.struct(
        F.struct(F.lit("Customer").alias("title"), F.col("c_mktsegment").alias("last")).alias("name"),
        F.struct(
            F.col("n_name").alias("city"),
            F.lpad((F.col("c_custkey") % 100000).cast("string"), 5, "0").alias("zip"),
        ).alias("location"),
        name.alias("username"),
        (F.col("o_epoch") + number * 200 * DAY).alias("registered"),
    ).alias("user"))


def _detail(**changed: Column) -> Column:
    leaves = {
        "tran_card_type": F.array(*map(F.lit, DEFAULT_CARDS)),
        "product_id": F.lit(DEFAULT_PRODUCT),
        "tran_amount": F.col("o_totalprice"),
        **changed,
    }
    return F.struct(*(value.alias(name) for name, value in leaves.items()))


def _envelope(results: Column, detail: Column) -> list[Column]:
    return [results.alias("results"), F.col("n_name").alias("nationality"),
            F.col("o_orderkey").cast("string").alias("seed"), F.lit("1.1").alias("version"),
            detail.alias("tran_detail")]


def _as_topic(messages: DataFrame, value: Column) -> DataFrame:
    """Topic rows; an order key fixes the partition and the offset."""
    return messages.select(
        F.col("o_custkey").cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(TOPIC_NAME).alias("topic"),
        (F.col("o_orderkey") % PARTITIONS).cast("int").alias("partition"),
        F.expr(f"o_orderkey div {PARTITIONS}").alias("offset"),
        F.timestamp_seconds("o_epoch").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def _json(columns: list[Column]) -> Column:
    return F.to_json(F.struct(*columns))


@_of_sales
def order_topic(rows: DataFrame) -> DataFrame:
    """One message per order, with one user."""
    return _as_topic(rows, _json(_envelope(F.array(_user(0)), _detail())))


@_of_sales
def party_topic(rows: DataFrame) -> DataFrame:
    """One message per order, with ``o_orderkey % 4`` whole users (none, too)."""
    users = F.slice(F.array(*map(_whole_user, range(3))), F.lit(1), (F.col("o_orderkey") % 4).cast("int"))
    return _as_topic(rows, _json(_envelope(users, _detail())))


def crowd_topic(spark: SparkSession, sf_dir: str, users: int = 10) -> DataFrame:
    """Messages of ten users, packed by position in the input: whatever the data,
    no group grows beyond that. Which users meet is up to the input's order."""
    rows = sales(spark, sf_dir).select("*", _user(0).alias("who"), F.monotonically_increasing_id().alias("row"))
    packed = rows.groupBy(F.expr(f"row div {users}").alias("o_orderkey")).agg(
        F.collect_list("who").alias("who"),
        *(F.max(c).alias(c) for c in ("o_custkey", "n_name", "o_totalprice", "o_epoch")))
    return _as_topic(packed, _json(_envelope(F.col("who"), _detail())))


@_of_sales
def partial_topic(rows: DataFrame) -> DataFrame:
    """One message per order; by ``o_orderkey % 4`` it lacks nothing, the cards,
    product and amount, or the whole transaction detail."""
    case = F.col("o_orderkey") % 4
    detail = _detail(
        tran_card_type=F.when(case != 1, F.array(*map(F.lit, DEFAULT_CARDS[:2]))),
        product_id=F.when(case != 2, F.concat(F.lit("PID-"), F.col("o_orderkey").cast("string"))),
        tran_amount=F.when(case != 2, F.col("o_totalprice")))
    return _as_topic(rows,
                     _json(_envelope(F.array(_user(0)), F.when(case != 3, detail))))


@_of_sales
def damaged_topic(rows: DataFrame) -> DataFrame:
    """One message per order, damaged in one of seven ways by ``o_orderkey % 8``; the
    sound part has a field that the schema does not know."""
    known = _json(_envelope(F.array(_user(0)), _detail()))
    sound = F.concat(F.lit('{"extra":{"note":"'), F.col("o_orderkey").cast("string"), F.lit('"},'), F.substr(known, F.lit(2)))
    case = F.col("o_orderkey") % 8
    value = (
        F.when(case == 0, F.left(sound, F.length(sound) - 1))
         .when(case == 1, _json([F.array().alias("results"), F.col("n_name").alias("nationality")]))
         .when(case == 2, _json([F.col("n_name").alias("nationality")]))
         .when(case == 3, F.regexp_replace(sound, r'"registered":(\d+)', r'"registered":"x$1"'))
         .when(case == 4, F.lit(None).cast("string"))
         .when(case == 5, F.lit('{"results":[{"user":null},{}]}'))
         .when(case == 6, F.concat(F.lit("["), sound, F.lit("]")))
         .otherwise(sound))
    return _as_topic(rows, value)


# What stands before a message's detail in ``verbatim_topic``: numbers that no type holds,
# odd white space, and texts and objects that look like the detail.
VERBATIM = ('{ "n" : 1e400, "big":123456789012345678901234567890123456789012, "d":1.10,"decoy" : {"tran_detail":null,'
            '"product_id" : null}, "s":"\\"tran_detail\\":{ é","seed":"')
VERBATIM_DETAILS = (
    "", ', "tran_detail" : null', ',"tran_detail":{ }', ', "tran_detail" :\t{"product_id": null , "x":0.10}',
    ',"tran_detail":{"tran_amount":1.10,"product_id":"P","tran_card_type":[ ]}', ',"tran_detail":"text"',
    ',"tran_detail":{"tran_amount":1E5}', ',"tran_detail":{"tran_card_type":null,"own":{"tran_amount":null},"tran_amount":null}')


@_of_sales
def verbatim_topic(rows: DataFrame) -> DataFrame:
    """One message per order, written by hand; by ``o_orderkey % 8`` its detail is one of
    ``VERBATIM_DETAILS``."""
    detail = F.get(F.array(*map(F.lit, VERBATIM_DETAILS)), (F.col("o_orderkey") % 8).cast("int"))
    value = F.concat(F.lit(VERBATIM), F.col("o_orderkey").cast("string"), F.lit('"'), detail, F.lit(" } "))
    return _as_topic(rows, value)


@_of_sales
def holed_topic(rows: DataFrame) -> DataFrame:
    """``order_topic`` without some of its offsets, alone and in a row."""
    lost = (F.col("offset") % 50 == 7) | (F.col("offset") % 400).between(120, 180) | (F.col("offset") % 61 == F.col("partition"))
    return order_topic.__wrapped__(rows).where(~lost)


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as published records."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    return payload(events, key=F.col("user_id").cast("string"))


_staged: dict[tuple, tuple[str, int]] = {}

# A staged topic comes in this many deliveries, one after the other by offset; a
# micro-batch takes one.
DELIVERIES = 3
# A file of a staged topic holds about so many messages: it is read, parsed and kept by
# one task, and an enriched row is ten times as large as its message in the file.
MESSAGES_PER_FILE = 100_000


def _stage(spark: SparkSession, sf_dir: str, build, times: int = 1) -> tuple[str, int]:
    place = (spark.sparkContext.applicationId, sf_dir, build.__name__, times)
    if place not in _staged:
        path = shared_dir(spark, build.__name__)
        orders, last = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)), F.max("o_orderkey")).first()
        files = -(-orders // (DELIVERIES * MESSAGES_PER_FILE)) or 1
        offsets = (last or 0) // PARTITIONS + 1
        folder, due = Folder(spark, path), 0
        for number in [*range(DELIVERIES)] * times:
            # Dealt as orders, which are smaller than the messages made from them.
            rows = sales(spark, sf_dir).where(F.expr(f"(o_orderkey div {PARTITIONS}) * {DELIVERIES} div {offsets} = {number}"))
            delivery = build(spark, sf_dir, rows.repartition(files, "o_orderkey"))
            delivery.write.mode("append").option("compression", "zstd").parquet(path)
            due += files
            # A part without rows has left no file, and the next delivery must not take its place.
            for _ in range(due - sum(name.startswith("part-") for name in folder.names())):
                spark.createDataFrame([], delivery.schema).coalesce(1).write.mode("append").parquet(path)
        _staged[place] = path, files
    return _staged[place]


def stage(spark: SparkSession, sf_dir: str, build=order_topic) -> str:
    """The topic as files in the shared folder, written once per application, of
    about ``MESSAGES_PER_FILE`` each."""
    return _stage(spark, sf_dir, build)[0]


def staged_stream(spark: SparkSession, sf_dir: str, build=order_topic, times: int = 1) -> DataFrame:
    """The staged topic as a stream, a delivery to a micro-batch: the source takes files
    in the order of their time, and every delivery has as many. ``times`` delivers the
    whole topic again."""
    path, files = _stage(spark, sf_dir, build, times)
    return topic_files(spark, path, maxFilesPerTrigger=str(files))
