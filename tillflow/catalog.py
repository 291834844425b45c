"""Every operator as a query over the driver's tables, with its oracle SQL.

The survey ids that a query covers stand in the comment above it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillflow import workload
from tillflow.functions import date_text, year_of_epoch, year_of_text
from tillflow.operators import messages as msg
from tillflow.operators import serving, totals
from tillflow.operators.enrich import enrich, hot_rows
from tillflow.operators.keyed import last_write
from tillflow.plans import pipelines, publish
from tillflow.plans.history import HISTORY_VIEW, compact, open_history, vacuum
from tillflow.plans.rows import ALL, audited_transactions, transactions
from tillflow.schema import FLAT, HOT, HOT_KEY, TOPIC
from tillflow.session import child, shared_dir
from tillflow.sources import stored
from tillflow.sources.epochs import read_epochs
from tillflow.sources.topics import once, text_files
from tillflow.streaming import sinks
from tillflow.streaming.run import AVAILABLE_NOW, drain

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(child(spark), sf_dir)
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


# --- oracle building blocks -------------------------------------------------

SALES = """sales AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
         CAST(epoch(o_orderdate) AS BIGINT) AS o_epoch,
         c_custkey, c_name, c_mktsegment, c_nationkey, n_name,
         CAST(o_orderkey % 8 AS INTEGER) AS part, o_orderkey // 8 AS pos_offset,
         'commerce:' || (o_orderkey % 8) || ':' || (o_orderkey // 8) AS message_id,
         (o_orderkey // 8) * 3 // (SELECT max(o_orderkey) // 8 + 1 FROM orders) AS delivery
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""

# One row per user: a message's first user is the customer, later ones carry a suffix.
_ROW = """SELECT *, message_id || ':' || pos AS record_id, md5(message_id || ':' || pos) AS digest,
         CASE WHEN pos = 0 THEN c_name ELSE c_name || '-' || pos END AS username,
         o_epoch + pos * 200 * 86400 AS registered
  FROM"""
ORDER_ROWS = f"""{SALES}, users AS (
  {_ROW} (SELECT *, 0 AS pos FROM sales))"""
PARTY_ROWS = f"""{SALES}, users AS (
  {_ROW} (SELECT *, unnest(range(o_orderkey % 4))::INTEGER AS pos FROM sales))"""


def _draw(slot: int) -> str:
    return f"CAST('0x' || substr(digest, {8 * slot + 1}, 8) AS BIGINT)"


_AMOUNT = (f"CAST(round(CAST(o_totalprice AS DECIMAL(24,6)) * CAST(CAST({_draw(3)} % 10000 AS DECIMAL(9,0))"
           " * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(5,4)), 2) AS DOUBLE)")
_DATE = "strftime(make_timestamp(registered * 1000000), '%Y-%m-%d %H:%M:%S')"
_YEAR = "CAST(year(make_timestamp(registered * 1000000)) AS INTEGER)"
_ZIP = "lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0')"

ENRICHED = f""", enriched AS (
  SELECT *, username || ({_draw(1)} % 1001) AS user_id,
         ['Visa', 'MasterCard', 'Maestro'][{_draw(0)} % 3 + 1] AS tran_card_type,
         'PID-001' || ({_draw(2)} % 101) AS product_id, {_AMOUNT} AS tran_amount,
         {_DATE} AS tran_date, {_YEAR} AS tran_year, n_name AS nationality FROM users)"""
ORDERS_ENRICHED = f"WITH {ORDER_ROWS}{ENRICHED}"
PARTIES_ENRICHED = f"WITH {PARTY_ROWS}{ENRICHED}"

_THIN = {c: "CAST(NULL AS VARCHAR)" for c in (
    "gender", "first_name", "street", "state", "email", "password", "salt", "md5", "sha1", "sha256", "phone", "cell", "PPS",
    "large", "medium", "thumbnail")} | {"dob": "CAST(NULL AS BIGINT)"}
# What the whole users of a message hold; every leaf has values of its own.
_WHOLE = {
    "gender": "CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END", "first_name": "'first-' || c_custkey",
    "street": "'street-' || c_custkey", "state": "'state-' || c_nationkey", "email": "'email-' || c_custkey",
    "password": "'password-' || c_custkey", "salt": "'salt-' || c_custkey", "md5": "'md5-' || c_custkey",
    "sha1": "'sha1-' || c_custkey", "sha256": "'sha256-' || c_custkey", "phone": "'phone-' || c_custkey",
    "cell": "'cell-' || c_custkey", "PPS": "'PPS-' || c_custkey", "large": "'large-' || c_custkey",
    "medium": "'medium-' || c_custkey", "thumbnail": "'thumbnail-' || c_custkey", "dob": "o_epoch - 777600000",
}


def _hot_sql(leaves: dict[str, str]) -> str:
    return f"""user_id, {leaves["first_name"]} AS first_name, c_mktsegment AS last_name,
  {leaves["gender"]} AS gender, n_name AS city, {leaves["state"]} AS state, {_ZIP} AS zip,
  {leaves["email"]} AS email, nationality, tran_card_type, tran_date, product_id, tran_amount"""


def _flat_sql(leaves: dict[str, str], user_id: str, card: str, product: str, amount: str) -> str:
    return f"""'Customer' AS title, c_mktsegment AS last_name, n_name AS city, {_ZIP} AS zip, {user_id} AS user_id,
  registered, n_name AS nationality, CAST(o_orderkey AS VARCHAR) AS seed, '1.1' AS version, {card} AS tran_card_type,
  {product} AS product_id, {amount} AS tran_amount, """ + ", ".join(f'{sql} AS "{c}"' for c, sql in leaves.items())


_HOT, _WHOLE_HOT = _hot_sql(_THIN), _hot_sql(_WHOLE)
_FLAT_RAW = _flat_sql(_WHOLE, "username", "'Visa,MasterCard,Maestro'", "'PID-001'", "o_totalprice")
_ENRICHED_COLUMNS = ("user_id", "tran_card_type", "product_id", "tran_amount")
_ARCHIVE = _flat_sql(_THIN, *_ENRICHED_COLUMNS) + ", tran_date, tran_year"
_WHOLE_ARCHIVE = _flat_sql(_WHOLE, *_ENRICHED_COLUMNS) + ", tran_date, tran_year"

_SUM = "CAST(sum(CAST({0} AS DECIMAL(24,6))) AS DOUBLE)"
_VALUE_SQL = {
    "tran_year_count": "count(tran_amount)",
    "tran_country_count": "count(nationality)",
    "tran_card_type_count": "count(tran_card_type)",
    "tran_card_type_total_sales": _SUM.format("tran_amount"),
    "tran_year_country_total_sales": _SUM.format("tran_amount"),
}


def _total_sql(collection: str, base: str) -> str:
    keys, value = totals.COLLECTIONS[collection]
    names = ", ".join(keys)
    return f"{base} SELECT {names}, {_VALUE_SQL[value]} AS {value} FROM enriched GROUP BY {names}"


# The text of an order message.
_MESSAGE_JSON = f"""'{{"results":[{{"user":{{"name":{{"title":"Customer","last":"' || c_mktsegment
  || '"}},"location":{{"city":"' || n_name || '","zip":"' || {_ZIP} || '"}},"username":"' || c_name
  || '","registered":' || o_epoch || '}}}}],"nationality":"' || n_name || '","seed":"' || o_orderkey
  || '","version":"1.1","tran_detail":{{"tran_card_type":["Visa","MasterCard","Maestro"],"product_id":"PID-001","tran_amount":'
  || o_totalprice || '}}}}'"""


# --- sources, decode, parse, shape ------------------------------------------

_RAW_SQL = f"""WITH {SALES} SELECT CAST(o_custkey AS VARCHAR) AS key_text, 'commerce' AS topic,
  part AS partition, pos_offset AS "offset", CAST(0 AS INTEGER) AS "timestampType",
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS timestamp_text,
  CAST(strlen({_MESSAGE_JSON}) AS INTEGER) AS value_bytes, md5({_MESSAGE_JSON}) AS value_md5 FROM sales"""


def _raw_columns(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("key").cast("string").alias("key_text"), "topic", "partition", "offset", "timestampType",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp_text"),
        F.octet_length("value").alias("value_bytes"), F.md5("value").alias("value_md5"))


# SRC-4: topic columns, undecoded (keys and payloads shown as text and digest).
@query("raw_passthrough", _RAW_SQL)
def raw_passthrough(spark, sf_dir):
    return _raw_columns(workload.order_topic(spark, sf_dir))


# SRC-1, SRC-4, STR-1, STR-3: the same through a stream of topic files.
@query("stream_raw_passthrough", _RAW_SQL)
def stream_raw_passthrough(spark, sf_dir):
    root = shared_dir(spark, "raw")
    layout = pipelines.Layout(root)
    drain(pipelines.raw_pipeline(workload.staged_stream(spark, sf_dir), layout,
                                 sinks.epoch_files(f"{root}/raw"), AVAILABLE_NOW))
    return _raw_columns(read_epochs(spark, f"{root}/raw", TOPIC))


# SRC-3: offsets that a stream never got, from the intervals of its micro-batches
@query("offset_gaps", f"""WITH {SALES}, kept AS (
  SELECT DISTINCT part, pos_offset FROM sales
  WHERE NOT (pos_offset % 50 = 7 OR pos_offset % 400 BETWEEN 120 AND 180 OR pos_offset % 61 = part)),
  next AS (SELECT part, pos_offset, lead(pos_offset) OVER (PARTITION BY part ORDER BY pos_offset) AS following FROM kept)
  SELECT 'commerce' AS topic, part AS partition, pos_offset + 1 AS "first", following - 1 AS "last",
    following - pos_offset - 1 AS offsets FROM next WHERE following > pos_offset + 1""")
def offset_gaps(spark, sf_dir):
    layout = pipelines.Layout(shared_dir(spark, "offsets"))
    drain([pipelines.start_offsets(workload.staged_stream(spark, sf_dir, workload.holed_topic, times=2), layout, AVAILABLE_NOW)])
    return stored.read_gaps(spark, layout.offsets)


# PRJ-1..3, PRJ-6, SCL-1
@query("decode_parse", f"""WITH {SALES} SELECT message_id, part AS partition, pos_offset AS "offset",
  n_name AS nationality, CAST(o_orderkey AS VARCHAR) AS seed, '1.1' AS version,
  CAST(1 AS INTEGER) AS users, c_name AS first_username, 'PID-001' AS product_id,
  o_totalprice AS tran_amount FROM sales""")
def decode_parse(spark, sf_dir):
    return msg.expand(msg.parse(msg.decode(workload.order_topic(spark, sf_dir)))).select(
        "message_id", "partition", "offset", "nationality", "seed", "version",
        F.size("results").alias("users"), F.col("results")[0]["user"]["username"].alias("first_username"),
        "tran_detail.product_id", "tran_detail.tran_amount")


# PRJ-2 on a second payload
@query("json_props", "SELECT event_id, CAST(props::JSON->>'k' AS INTEGER) AS k FROM events")
def json_props(spark, sf_dir):
    events = workload.table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k INT").alias("p")).select("event_id", "p.k")


# PRJ-4, PRJ-5: messages without users give no row
@query("explode_users", f"""WITH {PARTY_ROWS}
  SELECT message_id, pos, username, registered, n_name AS nationality FROM users""")
def explode_users(spark, sf_dir):
    messages = msg.expand(msg.parse(msg.decode(workload.party_topic(spark, sf_dir)),
                                    ("user_id", "registered", "nationality")))
    return msg.explode_users(messages).select(
        "message_id", "pos", "user.username", "user.registered", "nationality")


# PRJ-6..8
@query("flatten_29", f"WITH {PARTY_ROWS} SELECT record_id, {_FLAT_RAW} FROM users")
def flatten_29(spark, sf_dir):
    messages = msg.expand(msg.parse(msg.decode(workload.party_topic(spark, sf_dir)), FLAT))
    return (msg.flatten(msg.explode_users(messages)).select("record_id", *FLAT)
            .withColumn("tran_card_type", F.array_join("tran_card_type", ",")))


_CASE = "o_orderkey % 4"
_FILLED = f"""CASE WHEN {_CASE} IN (1, 3) THEN 'Visa,MasterCard,Maestro' ELSE 'Visa,MasterCard' END AS cards,
  CASE WHEN {_CASE} IN (2, 3) THEN 'PID-001' ELSE 'PID-' || o_orderkey END AS product_id,
  CASE WHEN {_CASE} IN (2, 3) THEN 150.5::DOUBLE ELSE o_totalprice END AS tran_amount"""


# PRJ-11
@query("default_fill", f"WITH {SALES} SELECT message_id, {_FILLED} FROM sales")
def default_fill(spark, sf_dir):
    messages = msg.expand(msg.parse(msg.decode(workload.partial_topic(spark, sf_dir)),
                                    ("tran_card_type", "product_id", "tran_amount")))
    return msg.fill_defaults(messages).select(
        "message_id", F.array_join("tran_detail.tran_card_type", ",").alias("cards"),
        "tran_detail.product_id", "tran_detail.tran_amount")


# PRJ-11, SNK-6: completed messages, published and parsed again
@query("completed_messages", f"WITH {SALES} SELECT CAST(o_orderkey AS VARCHAR) AS seed, {_FILLED} FROM sales")
def completed_messages(spark, sf_dir):
    published = publish.completed_messages(msg.decode(workload.partial_topic(spark, sf_dir)))
    again = published.select(F.from_json("value", msg.message_schema()).alias("m")).select("m.*")
    return again.select("seed", F.array_join("tran_detail.tran_card_type", ",").alias("cards"),
                        "tran_detail.product_id", "tran_detail.tran_amount")


# PRJ-11, SNK-6, STR-4: the same through a stream, from topic to topic
@query("stream_publish", f"WITH {SALES} SELECT CAST(o_orderkey AS VARCHAR) AS seed, {_FILLED} FROM sales")
def stream_publish(spark, sf_dir):
    layout = pipelines.Layout(shared_dir(spark, "publish"))
    published = f"{layout.root}/published"
    raw = workload.staged_stream(spark, sf_dir, workload.partial_topic)
    drain(pipelines.publish_pipeline(raw, layout, "text", AVAILABLE_NOW, path=published))
    again = text_files(spark, published, workload.TOPIC_NAME, streaming=False)
    return msg.expand(msg.parse(msg.decode(again))).select(
        "seed", F.array_join("tran_detail.tran_card_type", ",").alias("cards"),
        "tran_detail.product_id", "tran_detail.tran_amount")


# SNK-6, FLT-1: every damaged message is published whole or set aside; the mistyped
# field and the unknown one go along
@query("publish_damaged", f"""WITH {SALES} SELECT outcome, count(*) AS messages,
  count(*) FILTER (o_orderkey % 8 IN (3, 7)) AS extra, count(*) FILTER (o_orderkey % 8 = 3) AS mistyped
  FROM (SELECT o_orderkey, CASE o_orderkey % 8 WHEN 0 THEN 'malformed' WHEN 4 THEN 'null payload' WHEN 6 THEN 'no object'
    ELSE 'published' END AS outcome FROM sales) GROUP BY outcome""")
def publish_damaged(spark, sf_dir):
    layout = pipelines.Layout(shared_dir(spark, "publish-damaged"))
    published = f"{layout.root}/published"
    raw = workload.staged_stream(spark, sf_dir, workload.damaged_topic)
    drain(pipelines.publish_pipeline(raw, layout, "text", AVAILABLE_NOW, path=published))
    passed = spark.read.schema("value string").text(published).select(F.lit("published").alias("outcome"), "value")
    aside = stored.read_quarantine(spark, layout.quarantine).select(F.col("reject_reason").alias("outcome"), F.lit(None).alias("value"))
    complete = F.get_json_object("value", "$.tran_detail.product_id").isNotNull()
    return passed.where(complete).union(aside).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("messages"), F.count(F.get_json_object("value", "$.extra.note")).alias("extra"),
        F.count_if(F.col("value").contains('"registered":"x')).alias("mistyped"))


_CARDS = '"tran_card_type":["Visa","MasterCard","Maestro"]'
_FILL = f'{_CARDS},"product_id":"PID-001","tran_amount":150.5'
# What becomes of ``workload.VERBATIM_DETAILS``, in their order.
_PATCHED = (
    f' ,"tran_detail":{{{_FILL}}}', f', "tran_detail" : {{{_FILL}}} ', f',"tran_detail":{{{_FILL} }} ',
    f', "tran_detail" :\t{{{_CARDS},"tran_amount":150.5,"product_id": "PID-001" , "x":0.10}} ',
    workload.VERBATIM_DETAILS[4] + " ", workload.VERBATIM_DETAILS[5] + " ", f',"tran_detail":{{{_CARDS},"product_id":"PID-001","tran_amount":1E5}} ',
    f',"tran_detail":{{"product_id":"PID-001",{_CARDS},"own":{{"tran_amount":null}},"tran_amount":150.5}} ')


# SNK-6, PRJ-11: published messages, byte for byte, under their own keys
@query("publish_exact", f"""WITH {SALES} SELECT CAST(o_custkey AS VARCHAR) AS key_text, md5(value) AS value_md5,
  CAST(strlen(value) AS INTEGER) AS value_bytes FROM (SELECT o_custkey, '{workload.VERBATIM}' || o_orderkey || '"' ||
  ([{", ".join(f"'{d}'" for d in _PATCHED)}])[o_orderkey % 8 + 1] || '}} ' AS value FROM sales)""")
def publish_exact(spark, sf_dir):
    layout = pipelines.Layout(shared_dir(spark, "publish-exact"))
    published = f"{layout.root}/published"
    raw = workload.staged_stream(spark, sf_dir, workload.verbatim_topic)
    drain(pipelines.publish_pipeline(raw, layout, "parquet", AVAILABLE_NOW, path=published))
    return spark.read.schema("key binary, value string").parquet(published).select(
        F.col("key").cast("string").alias("key_text"), F.md5(F.col("value").cast("binary")).alias("value_md5"),
        F.octet_length("value").alias("value_bytes"))


_REASON = """CASE o_orderkey % 8 WHEN 0 THEN 'malformed' WHEN 1 THEN 'empty results'
  WHEN 2 THEN 'no results' WHEN 3 THEN 'mistyped field' WHEN 4 THEN 'null payload'
  WHEN 6 THEN 'malformed' END"""


# FLT-1
@query("quarantine_counts", f"""WITH {SALES} SELECT reject_reason, count(*) AS messages
  FROM (SELECT {_REASON} AS reject_reason FROM sales) WHERE reject_reason IS NOT NULL GROUP BY reject_reason""")
def quarantine_counts(spark, sf_dir):
    rows = audited_transactions(workload.damaged_topic(spark, sf_dir))
    return (sinks.rejected_messages(rows).groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("messages")))


# FLT-1, PRJ-5: what survives damage; NULL users are rows, a mistyped field is NULL
@query("surviving_rows", f"""WITH {SALES} SELECT message_id,
  CAST(sum(CASE WHEN o_orderkey % 8 = 5 THEN 2 ELSE 1 END) AS BIGINT) AS users,
  count(*) FILTER (o_orderkey % 8 <> 5) AS named, count(*) FILTER (o_orderkey % 8 = 7) AS dated
  FROM sales WHERE o_orderkey % 8 IN (3, 5, 7) GROUP BY message_id""")
def surviving_rows(spark, sf_dir):
    messages = msg.expand(msg.parse(msg.decode(workload.damaged_topic(spark, sf_dir)), FLAT))
    return (msg.explode_users(messages).groupBy("message_id")
            .agg(F.count(F.lit(1)).alias("users"), F.count("user.username").alias("named"),
                 F.count("user.registered").alias("dated")))


# PRJ-13: the columns and types of the archive rows, as rows of a table
_COLUMNS = """gender title first_name last_name street city state zip email user_id password salt md5 sha1 sha256 registered
  dob phone cell PPS large medium thumbnail nationality seed version tran_card_type product_id tran_amount tran_date
  tran_year""".split()


@query("schema_print", f"""WITH {SALES} SELECT column_name, CASE
  WHEN column_name IN ('registered', 'dob') THEN 'bigint' WHEN column_name = 'tran_amount' THEN 'double'
  WHEN column_name = 'tran_year' THEN 'int' ELSE 'string' END AS column_type,
  (SELECT count(*) FROM sales) AS rows FROM (SELECT unnest({_COLUMNS}) AS column_name)""")
def schema_print(spark, sf_dir):
    rows = transactions(workload.order_topic(spark, sf_dir)).select(*ALL)
    rows.printSchema()
    kinds = [F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("column_type")) for c, t in rows.dtypes]
    return (rows.agg(F.count(F.lit(1)).alias("rows"))
            .select(F.explode(F.array(*kinds)).alias("c"), "rows").select("c.*", "rows"))


# --- scalars and enrichment -------------------------------------------------

# SCL-6..8, PRJ-9: three routes to the date and the year
@query("derive_date_year", f"""WITH {PARTY_ROWS} SELECT record_id, {_DATE} AS tran_date,
  {_YEAR} AS tran_year, {_YEAR} AS year_from_text FROM users""")
def derive_date_year(spark, sf_dir):
    flat = _flat(spark, sf_dir, ("registered",))
    return flat.select("record_id", date_text(F.col("registered")).alias("tran_date"),
                       year_of_epoch(F.col("registered")).alias("tran_year"),
                       year_of_text(date_text(F.col("registered"))).alias("year_from_text"))


def _flat(spark: SparkSession, sf_dir: str, columns: tuple[str, ...]) -> DataFrame:
    messages = msg.expand(msg.parse(msg.decode(workload.party_topic(spark, sf_dir)), columns))
    return msg.flatten(msg.explode_users(messages), columns)


# ENR-1, UDF-1
@query("enrich_card", f"{PARTIES_ENRICHED} SELECT record_id, tran_card_type FROM enriched")
def enrich_card(spark, sf_dir):
    return enrich(_flat(spark, sf_dir, ("tran_card_type",))).select("record_id", "tran_card_type")


# ENR-2, SCL-2
@query("enrich_user_id", f"{PARTIES_ENRICHED} SELECT record_id, user_id FROM enriched")
def enrich_user_id(spark, sf_dir):
    return enrich(_flat(spark, sf_dir, ("user_id",))).select("record_id", "user_id")


# ENR-3, SCL-2
@query("enrich_product_id", f"{PARTIES_ENRICHED} SELECT record_id, product_id FROM enriched")
def enrich_product_id(spark, sf_dir):
    return enrich(_flat(spark, sf_dir, ("product_id",))).select("record_id", "product_id")


# ENR-4, SCL-3..5
@query("enrich_amount", f"{PARTIES_ENRICHED} SELECT record_id, tran_amount FROM enriched")
def enrich_amount(spark, sf_dir):
    return enrich(_flat(spark, sf_dir, ("tran_amount",))).select("record_id", "tran_amount")


# ENR-1..4 with the values of the message
@query("enrich_passthrough", f"""WITH {PARTY_ROWS} SELECT record_id, username AS user_id,
  'Visa' AS tran_card_type, 'PID-001' AS product_id, o_totalprice AS tran_amount FROM users""")
def enrich_passthrough(spark, sf_dir):
    columns = ("user_id", "tran_card_type", "product_id", "tran_amount")
    return enrich(_flat(spark, sf_dir, columns), mode="passthrough").select("record_id", *columns)


# SCL-1..6, PRJ-7..9: the whole archive row
@query("archive_rows", f"{PARTIES_ENRICHED} SELECT record_id, {_WHOLE_ARCHIVE} FROM enriched")
def archive_rows(spark, sf_dir):
    rows = transactions(workload.party_topic(spark, sf_dir))
    return rows.select("record_id", *ALL)


# PRJ-10
@query("hot_projection", f"{PARTIES_ENRICHED} SELECT {_WHOLE_HOT} FROM enriched")
def hot_projection(spark, sf_dir):
    return hot_rows(transactions(workload.party_topic(spark, sf_dir), HOT))


# --- aggregates -------------------------------------------------------------

_SHORT = {
    "year_count": "year_wise_total_sales_count",
    "country_count": "country_wise_total_sales_count",
    "card_count": "card_type_wise_total_sales_count",
    "card_sales": "card_type_wise_total_sales",
    "year_country_sales": "year_country_wise_total_sales",
}


def _register_totals(short: str, collection: str) -> None:
    # AGG-1..5
    @query(f"agg_{short}", _total_sql(collection, ORDERS_ENRICHED))
    def batch(spark, sf_dir):
        rows = transactions(workload.order_topic(spark, sf_dir), totals.needed([collection]))
        return totals.total(rows, collection)

    # AGG-1..5 on messages of several users, out of the shared aggregate
    @query(f"agg_{short}_shared", _total_sql(collection, PARTIES_ENRICHED))
    def shared(spark, sf_dir):
        rows = transactions(workload.party_topic(spark, sf_dir), totals.needed())
        return totals.pick(totals.all_totals(rows), collection)

    # STR-1, STR-2, STR-6, SNK-3, SNK-5, SNK-7: running totals in micro-batches,
    # appended as snapshots, read back as the current total of every key
    @query(f"stream_agg_{short}", _total_sql(collection, ORDERS_ENRICHED))
    def stream(spark, sf_dir):
        root = shared_dir(spark, collection)
        raw = workload.staged_stream(spark, sf_dir)
        layout = pipelines.Layout(root)
        drain([pipelines.start_collection(raw, layout, collection, trigger=AVAILABLE_NOW)])
        return serving.latest_totals(
            stored.read_collection(spark, layout.collection(collection), collection), collection)

    # STR-7, SNK-3, SNK-7, AGG-6, AGG-7: the same out of the main pipeline
    @query(f"main_{short}", _total_sql(collection, PARTIES_ENRICHED))
    def main(spark, sf_dir):
        path = _main_run(spark, sf_dir).collection(collection)
        return serving.latest_totals(stored.read_collection(spark, path, collection), collection)


# SRC-1, SNK-6, STR-6: a topic delivered twice, its doubles dropped, in every total …
@query("stream_once_sales", _total_sql(_SHORT["year_country_sales"], ORDERS_ENRICHED))
def stream_once_sales(spark, sf_dir):
    name = _SHORT["year_country_sales"]
    layout = pipelines.Layout(shared_dir(spark, "once"))
    raw = once(workload.staged_stream(spark, sf_dir, times=2))
    drain([pipelines.start_collection(raw, layout, name, trigger=AVAILABLE_NOW)])
    return serving.latest_totals(stored.read_collection(spark, layout.collection(name), name), name)


# … and in the archive
@query("stream_once_archive", f"{ORDERS_ENRICHED} SELECT {_ARCHIVE} FROM enriched")
def stream_once_archive(spark, sf_dir):
    layout = pipelines.Layout(shared_dir(spark, "once"))
    drain([pipelines.start_archive(once(workload.staged_stream(spark, sf_dir, times=2)), layout, AVAILABLE_NOW)])
    return stored.read_archive(spark, layout.archive)


_runs: dict[tuple[str, str], pipelines.Layout] = {}


def _main_run(spark: SparkSession, sf_dir: str) -> pipelines.Layout:
    """The main pipeline over the staged party topic, run once per application."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _runs:
        layout = pipelines.Layout(shared_dir(spark, "main"))
        raw = workload.staged_stream(spark, sf_dir, workload.party_topic)
        drain(pipelines.main_pipeline(raw, layout, trigger=AVAILABLE_NOW))
        _runs[place] = layout
    return _runs[place]


for _short, _collection in _SHORT.items():
    _register_totals(_short, _collection)


# --- sinks and what is read back --------------------------------------------

# SNK-1, SRC-6, STR-4, STR-5, STR-7
@query("main_archive", f"{PARTIES_ENRICHED} SELECT {_WHOLE_ARCHIVE} FROM enriched")
def main_archive(spark, sf_dir):
    return stored.read_archive(spark, _main_run(spark, sf_dir).archive)


# SNK-1, STR-4: Spark's own file sink
@query("archive_roundtrip", f"{ORDERS_ENRICHED} SELECT {_ARCHIVE} FROM enriched")
def archive_roundtrip(spark, sf_dir):
    layout = pipelines.Layout(shared_dir(spark, "archive"))
    drain([pipelines.start_archive(workload.staged_stream(spark, sf_dir), layout, AVAILABLE_NOW)])
    return stored.read_archive(spark, layout.archive)


# The last write: of a later micro-batch, in it of a later source position.
_LAST = """row_number() OVER (PARTITION BY user_id
  ORDER BY {batch} part DESC, pos_offset DESC, pos DESC) AS place"""
_LAST_WRITE = _LAST.format(batch="delivery DESC,")


# SNK-2, SNK-5: the keyed table of the main pipeline
@query("main_hot_table", f"""{PARTIES_ENRICHED} SELECT {_WHOLE_HOT}
  FROM (SELECT *, {_LAST_WRITE} FROM enriched) WHERE place = 1""")
def main_hot_table(spark, sf_dir):
    return stored.read_hot_table(spark, _main_run(spark, sf_dir).hot)


_PLAIN_HOT = f"""{ORDERS_ENRICHED}, plain AS (SELECT * REPLACE (
  username AS user_id, 'Visa' AS tran_card_type, 'PID-001' AS product_id, o_totalprice AS tran_amount)
  FROM enriched)
  SELECT {_HOT} FROM (SELECT *, {{last}} FROM plain) WHERE place = 1"""


# SNK-2: many writes per key, in several micro-batches (the message's own user name)
@query("keyed_upsert", _PLAIN_HOT.format(last=_LAST_WRITE))
def keyed_upsert(spark, sf_dir):
    layout = pipelines.Layout(shared_dir(spark, "keyed"))
    raw = workload.staged_stream(spark, sf_dir)
    drain([pipelines.start_hot(raw, layout, trigger=AVAILABLE_NOW, mode="passthrough")])
    return stored.read_hot_table(spark, layout.hot)


# SNK-2 in batch form
@query("last_write_per_key", _PLAIN_HOT.format(last=_LAST.format(batch="")))
def last_write_per_key(spark, sf_dir):
    rows = transactions(workload.order_topic(spark, sf_dir), HOT, mode="passthrough")
    return last_write(rows, HOT_KEY).select(*HOT)


# FLT-1, SNK-2: what each pipeline sets aside, NULL keys included
_ASIDE = f"""WITH {SALES} SELECT reject_reason, count(*) AS records FROM (
  SELECT {_REASON} AS reject_reason FROM sales
  UNION ALL SELECT 'null key' FROM sales, range(2) WHERE o_orderkey % 8 = 5)
  WHERE reject_reason IS NOT NULL GROUP BY reject_reason"""


def _set_aside(spark: SparkSession, layout: pipelines.Layout) -> DataFrame:
    rows = stored.read_quarantine(spark, layout.quarantine).union(stored.read_quarantine(spark, layout.null_keys))
    return rows.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("records"))


def _damaged_run(spark: SparkSession, sf_dir: str, pipeline: Callable, **options) -> pipelines.Layout:
    layout = pipelines.Layout(shared_dir(spark, "damaged"))
    raw = workload.staged_stream(spark, sf_dir, workload.damaged_topic)
    drain(pipeline(raw, layout, trigger=AVAILABLE_NOW, **options))
    return layout


@query("stream_quarantine", _ASIDE)
def stream_quarantine(spark, sf_dir):
    return _set_aside(spark, _damaged_run(spark, sf_dir, pipelines.main_pipeline))


@query("separate_quarantine", _ASIDE)
def separate_quarantine(spark, sf_dir):
    return _set_aside(spark, _damaged_run(spark, sf_dir, pipelines.separate_pipeline))


@query("variant_quarantine", _ASIDE)
def variant_quarantine(spark, sf_dir):
    return _set_aside(spark, _damaged_run(spark, sf_dir, pipelines.keyed_pipeline, console=False))


# The same after upkeep
@query("compacted_quarantine", _ASIDE)
def compacted_quarantine(spark, sf_dir):
    layout = _damaged_run(spark, sf_dir, pipelines.main_pipeline)
    compact(spark, layout)
    vacuum(spark, layout)
    return _set_aside(spark, layout)


# STR-7, STR-8: the variant without aggregates; its archive and keyed table agree
@query("variant_sinks_agree", f"""{ORDERS_ENRICHED} SELECT count(*) AS hot_rows,
  count(*) AS found_in_archive FROM (SELECT DISTINCT user_id FROM enriched)""")
def variant_sinks_agree(spark, sf_dir):
    layout = pipelines.Layout(shared_dir(spark, "variant"))
    raw = workload.staged_stream(spark, sf_dir)
    drain(pipelines.keyed_pipeline(raw, layout, trigger=AVAILABLE_NOW, console=False))
    hot = stored.read_hot_table(spark, layout.hot)
    archived = stored.read_archive(spark, layout.archive).select(*HOT).distinct()
    same = [hot[c].eqNullSafe(archived[c]) for c in HOT if c != HOT_KEY]
    matched = hot.join(archived, [hot[HOT_KEY] == archived[HOT_KEY], *same], "left")
    return matched.agg(F.count(hot[HOT_KEY]).alias("hot_rows"),
                       F.count(archived[HOT_KEY]).alias("found_in_archive"))


# SNK-4, STR-3: the hot rows that the console shows of each micro-batch, and whether it
# says that there are more
@query("console_smoke", f"""{ORDERS_ENRICHED} SELECT delivery AS batch_id, least(count(*), 20) AS printed,
  count(*) > 20 AS cut FROM enriched GROUP BY delivery""")
def console_smoke(spark, sf_dir):
    layout, printed = pipelines.Layout(shared_dir(spark, "console")), []
    raw = workload.staged_stream(spark, sf_dir)
    drain(pipelines.keyed_pipeline(raw, layout, trigger=AVAILABLE_NOW, console=sinks.console(out=printed.append)))
    screens = []
    for text in printed:
        lines = text.splitlines()
        rows = [line for line in lines if line.startswith("|")]
        assert rows[0].strip("|").replace(" ", "").split("|") == list(HOT)
        screens.append((int(lines[1].removeprefix("Batch: ")), len(rows) - 1, "only showing" in text))
    return spark.createDataFrame(screens, "batch_id bigint, printed bigint, cut boolean")


# --- history and serving ----------------------------------------------------

# SRC-6: SQL over the archive; the year prunes directories
@query("history_sql", f"""{PARTIES_ENRICHED} SELECT nationality, tran_card_type, count(*) AS sales,
  {_SUM.format("tran_amount")} AS amount FROM enriched
  WHERE tran_year BETWEEN 1996 AND 1998 GROUP BY nationality, tran_card_type""")
def history_sql(spark, sf_dir):
    open_history(spark, _main_run(spark, sf_dir).archive)
    return spark.sql(f"""
        SELECT nationality, tran_card_type, count(*) AS sales,
               CAST(sum(CAST(tran_amount AS DECIMAL(24,6))) AS DOUBLE) AS amount
        FROM {HISTORY_VIEW} WHERE tran_year BETWEEN 1996 AND 1998
        GROUP BY nationality, tran_card_type""")


# SNK-1..3 upkeep: a compacted pipeline answers as before
@query("compacted_hot_table", f"""{PARTIES_ENRICHED} SELECT {_WHOLE_HOT}
  FROM (SELECT *, {_LAST_WRITE} FROM enriched) WHERE place = 1""")
def compacted_hot_table(spark, sf_dir):
    return stored.read_hot_table(spark, _compacted(spark, sf_dir).hot)


@query("compacted_year_country_sales", _total_sql(_SHORT["year_country_sales"], PARTIES_ENRICHED))
def compacted_year_country_sales(spark, sf_dir):
    name = _SHORT["year_country_sales"]
    path = _compacted(spark, sf_dir).collection(name)
    return serving.latest_totals(stored.read_collection(spark, path, name), name)


# SRC-8 after upkeep: every snapshot document is still there
@query("compacted_documents", f"""{PARTIES_ENRICHED} SELECT count(*) AS documents
  FROM (SELECT DISTINCT delivery, tran_year FROM enriched)""")
def compacted_documents(spark, sf_dir):
    name = _SHORT["year_count"]
    path = _compacted(spark, sf_dir).collection(name)
    return serving.count_documents(stored.read_collection(spark, path, name))


# SNK-2: one key, from its bucket of the base
@query("hot_key_lookup", f"""{PARTIES_ENRICHED} SELECT {_WHOLE_HOT}
  FROM (SELECT *, {_LAST_WRITE} FROM enriched) WHERE place = 1 AND user_id = (SELECT min(user_id) FROM enriched)""")
def hot_key_lookup(spark, sf_dir):
    path = _compacted(spark, sf_dir).hot
    key = stored.read_hot_table(spark, path).agg(F.min(HOT_KEY)).first()[0]
    return stored.read_hot_key(spark, path, key)


@query("compacted_archive", f"{PARTIES_ENRICHED} SELECT {_WHOLE_ARCHIVE} FROM enriched")
def compacted_archive(spark, sf_dir):
    return stored.read_archive(spark, _compacted(spark, sf_dir).archive)


def _compacted(spark: SparkSession, sf_dir: str) -> pipelines.Layout:
    """A main pipeline of its own, folded after its run; the epochs folded are gone."""
    place = (spark.sparkContext.applicationId, f"{sf_dir} compacted")
    if place not in _runs:
        layout = pipelines.Layout(shared_dir(spark, "compacted"))
        drain(pipelines.main_pipeline(workload.staged_stream(spark, sf_dir, workload.party_topic), layout, trigger=AVAILABLE_NOW))
        compact(spark, layout)
        vacuum(spark, layout)
        _runs[place] = layout
    return _runs[place]


# A changelog whose batches the oracle can name: a batch is a remainder of o_orderkey,
# and has a snapshot of every key it touches, holding its running total. There are
# enough batches for more than a hundred documents.
_BATCHES = {"year_wise_total_sales_count": 20, "country_wise_total_sales_count": 5}


def _snapshots(spark: SparkSession, sf_dir: str, collection: str) -> DataFrame:
    keys, value = totals.COLLECTIONS[collection]
    rows = transactions(workload.order_topic(spark, sf_dir), (*totals.needed([collection]), "seed"))
    batch = (F.col("seed").cast("bigint") % _BATCHES[collection]).alias("batch_id")
    counted = rows.groupBy(*keys, batch).agg(totals._VALUES[value]().alias("added"))
    # At most one row per key and batch is left here.
    running = Window.partitionBy(*keys).orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return counted.select(*keys, F.sum("added").over(running).alias(value), "batch_id")


def _snapshots_sql(collection: str) -> str:
    keys, value = totals.COLLECTIONS[collection]
    names = ", ".join(keys)
    return f"""{ORDERS_ENRICHED}, counted AS (
      SELECT {names}, o_orderkey % {_BATCHES[collection]} AS batch_id, {_VALUE_SQL[value]} AS added
      FROM enriched GROUP BY {names}, o_orderkey % {_BATCHES[collection]}), snapshots AS (
      SELECT {names}, CAST(sum(added) OVER (PARTITION BY {names} ORDER BY batch_id) AS BIGINT) AS {value},
             batch_id FROM counted)"""


def _register_serving(short: str, collection: str) -> None:
    (key,), value = totals.COLLECTIONS[collection]

    # AGG-6, AGG-7, SRC-5
    @query(f"serving_latest_{short}",
           f"{_snapshots_sql(collection)} SELECT {key}, arg_max({value}, batch_id) AS {value} FROM snapshots GROUP BY {key}")
    def latest(spark, sf_dir):
        return serving.latest_totals(_snapshots(spark, sf_dir, collection), collection)

    # AGG-6p, AGG-7p, TOP-1
    @query(f"serving_top100_{short}",
           f"""{_snapshots_sql(collection)} SELECT {key}, CAST(sum({value}) AS BIGINT) AS {value} FROM (
           SELECT * FROM snapshots ORDER BY batch_id DESC, {key} LIMIT 100)
           WHERE {key} IS NOT NULL GROUP BY {key}""")
    def top100(spark, sf_dir):
        return serving.dashboard_rollup(_snapshots(spark, sf_dir, collection), collection)


_YEAR_DOCS = _SHORT["year_count"]
_COUNTRY_DOCS = _SHORT["country_count"]
_register_serving("year", _YEAR_DOCS)
_register_serving("country", _COUNTRY_DOCS)


# TOP-1
@query("latest_documents", f"""{_snapshots_sql(_COUNTRY_DOCS)} SELECT * FROM snapshots
  ORDER BY batch_id DESC, nationality LIMIT 100""")
def latest_documents(spark, sf_dir):
    return serving.last_documents(_snapshots(spark, sf_dir, _COUNTRY_DOCS), _COUNTRY_DOCS)


# SNK-8, PRJ-12
@query("records_export", f"""{_snapshots_sql(_COUNTRY_DOCS)}
  SELECT '{{"nationality":"' || nationality || '","tran_country_count":' || max(tran_country_count) || '}}' AS record
  FROM snapshots GROUP BY nationality""")
def records_export(spark, sf_dir):
    return serving.as_records(
        serving.latest_totals(_snapshots(spark, sf_dir, _COUNTRY_DOCS), _COUNTRY_DOCS))


# PRJ-12
@query("display_columns", f"{ORDERS_ENRICHED} SELECT {', '.join(sorted(HOT))} FROM (SELECT {_HOT} FROM enriched)")
def display_columns(spark, sf_dir):
    return serving.display_columns(hot_rows(transactions(workload.order_topic(spark, sf_dir), HOT)))


# SRC-8
@query("changelog_count", f"{_snapshots_sql(_YEAR_DOCS)} SELECT count(*) AS documents FROM snapshots")
def changelog_count(spark, sf_dir):
    return serving.count_documents(_snapshots(spark, sf_dir, _YEAR_DOCS))


# SRC-7, TOP-2
@query("changelog_sample", f"""{_snapshots_sql(_YEAR_DOCS)} SELECT * FROM snapshots
  ORDER BY batch_id, tran_year LIMIT 2""")
def changelog_sample(spark, sf_dir):
    return serving.sample_documents(_snapshots(spark, sf_dir, _YEAR_DOCS), _YEAR_DOCS, 2)


# SNK-6
@query("publish_payload", """SELECT CAST(user_id AS VARCHAR) AS key, '{"event_id":' || event_id
  || ',"user_id":' || user_id || ',"event_type":"' || event_type || '","value":' || value || '}' AS value FROM events""")
def publish_payload(spark, sf_dir):
    return workload.event_payloads(spark, sf_dir)
