"""Decode, parse, explode, flatten, default fill, quarantine on edge messages."""

import json
import re

import pytest
from pyspark.sql import functions as F

from edges import EDGES
from tillflow.operators import messages as msg
from tillflow.operators.messages import DEFAULT_CARDS
from tillflow.plans import publish
from tillflow.plans.rows import ALL, audited_transactions, transactions
from tillflow.schema import ARCHIVE, FLAT, HOT, MESSAGE, TOPIC, message_schema
from tillflow.sources.topics import text_files
from tillflow.streaming.sinks import rejected_messages

COLUMNS = ("gender", "zip", "registered", "user_id")


def topic(spark, payloads):
    rows = [(None, None if p is None else p.encode(), "t", 0, i, None, 0) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, TOPIC)


@pytest.fixture(scope="module")
def edges(spark):
    return topic(spark, [payload for payload, _, _ in EDGES.values()]).cache()


def by_case(rows, *columns):
    out = {name: [] for name in EDGES}
    names = list(EDGES)
    for row in rows.orderBy("offset", "pos").collect():
        out[names[row.offset]].append(tuple(row[c] for c in columns))
    return out


@pytest.mark.parametrize("columns", [FLAT, COLUMNS], ids=["whole schema", "narrow schema"])
def test_rows_of_edge_messages(edges, columns):
    parsed = msg.expand(msg.parse(msg.decode(edges), columns))
    rows = msg.flatten(msg.explode_users(parsed), columns)
    assert by_case(rows, *COLUMNS) == {name: rows for name, (_, _, rows) in EDGES.items()}


def test_reject_reasons(edges):
    got = {int(r.message_id.split(":")[2]): r.reject_reason
           for r in rejected_messages(audited_transactions(edges)).collect()}
    want = {i: reason for i, (_, reason, _) in enumerate(EDGES.values()) if reason}
    assert got == want


def test_rejected_message_keeps_its_payload_once(edges):
    rows = rejected_messages(audited_transactions(edges)).collect()
    payloads = [payload for payload, reason, _ in EDGES.values() if reason]
    assert sorted(r.value or "" for r in rows) == sorted(p or "" for p in payloads)


def test_audited_rows_are_the_plain_rows(edges):
    plain = transactions(edges).select(*ALL)
    audited = audited_transactions(edges).where(F.col("pos").isNotNull()).select(*ALL)
    assert plain.exceptAll(audited).count() == 0 and audited.exceptAll(plain).count() == 0


def test_any_subset_of_columns_gives_the_same_values(edges):
    whole = {r.record_id: r for r in transactions(edges).collect()}
    for columns in [("tran_year",), ("nationality",), ("tran_amount", "tran_year"), HOT, ("seed", "tran_card_type")]:
        part = transactions(edges, columns).collect()
        assert len(part) == len(whole)
        assert all(r[c] == whole[r.record_id][c] for r in part for c in columns)


def test_dates_beyond_the_calendar_are_null_and_do_not_fail(edges):
    got = by_case(transactions(edges, ("tran_date", "tran_year")), "tran_date", "tran_year")
    assert got["ok"][0] == ("2011-03-13 07:06:40", 2011)
    assert got["int overflow"] == [("2100-01-01 00:00:00", 2100)]
    assert got["milliseconds"] == got["far future"] == [(None, None)]


def test_empty_card_list_and_huge_amount_survive(edges):
    (card, amount), = by_case(transactions(edges, ("tran_card_type", "tran_amount")),
                              "tran_card_type", "tran_amount")["no cards"]
    assert card is None and 0 <= amount < 1e300


def test_default_fill_is_per_leaf(spark):
    raw = topic(spark, ['{"results":[]}', '{"tran_detail":{"product_id":"X"}}',
                        '{"tran_detail":{"tran_card_type":[],"tran_amount":null}}'])
    filled = msg.fill_defaults(msg.expand(msg.parse(msg.decode(raw)))).orderBy("offset")
    cards = list(DEFAULT_CARDS)
    assert [tuple(r) for r in filled.select("tran_detail.*").collect()] == [
        (cards, "PID-001", 150.5), (cards, "X", 150.5), ([], "PID-001", 150.5)]


def test_every_json_object_is_published_and_the_rest_set_aside(edges):
    decoded = msg.decode(edges)
    out = [json.loads(r.value) for r in publish.completed_messages(decoded).collect()]
    aside = {int(r.message_id.split(":")[2]): (r.reject_reason, r.value) for r in publish.refused_messages(decoded).collect()}
    refused = {"malformed": "malformed", "null payload": "null payload", "top-level array": "no object"}
    assert aside == {i: (refused[name], EDGES[name][0]) for i, name in enumerate(EDGES) if name in refused}
    assert len(out) == len(EDGES) - len(aside)
    assert all({"tran_card_type", "product_id", "tran_amount"} <= set(m["tran_detail"]) for m in out)


DETAIL = {"tran_card_type": list(DEFAULT_CARDS), "product_id": "PID-001", "tran_amount": 150.5}


@pytest.mark.parametrize("given, want", [
    ({"a": {"b": [1, None, {"c": "é\"\\"}]}, "n": None}, {"a": {"b": [1, None, {"c": "é\"\\"}]}, "n": None, "tran_detail": DETAIL}),
    ({"tran_detail": None, "x": 1.5}, {"tran_detail": DETAIL, "x": 1.5}),
    ({"tran_detail": {"product_id": None, "tran_amount": "12", "own": {"k": None}, "tran_card_type": []}},
     {"tran_detail": {"product_id": "PID-001", "tran_amount": "12", "own": {"k": None}, "tran_card_type": []}}),
    ({"results": [{"user": {"registered": "1300000000", "odd": True}}]},
     {"results": [{"user": {"registered": "1300000000", "odd": True}}], "tran_detail": DETAIL}),
    ({"tran_detail": "text"}, {"tran_detail": "text"}), ({}, {"tran_detail": DETAIL})])
def test_completing_changes_nothing_else(spark, given, want):
    (row,) = publish.completed_messages(msg.decode(topic(spark, [json.dumps(given)]))).collect()
    assert json.loads(row.value) == want


ALL_LEAVES = '"tran_card_type":["Visa","MasterCard","Maestro"],"product_id":"PID-001","tran_amount":150.5'
CARDS = '"tran_card_type":["Visa","MasterCard","Maestro"]'


@pytest.mark.parametrize("given, want", [
    ("{}", f'{{"tran_detail":{{{ALL_LEAVES}}}}}'), (" { } \n", f' {{ "tran_detail":{{{ALL_LEAVES}}}}} \n'),
    ('{"a":1e400,"b":0.1234567890123456789012345678901234567890,"c":1.10,"d":123456789012345678901234567890}',
     f'{{"a":1e400,"b":0.1234567890123456789012345678901234567890,"c":1.10,"d":123456789012345678901234567890,"tran_detail":{{{ALL_LEAVES}}}}}'),
    ('{"z":-0.0,"a":"\\u00e9\\/ $1 \\\\","m":{ } }\t', f'{{"z":-0.0,"a":"\\u00e9\\/ $1 \\\\","m":{{ }} ,"tran_detail":{{{ALL_LEAVES}}}}}\t'),
    ('{"tran_detail"\n:\tnull,"b":[1 , 2]}', f'{{"tran_detail"\n:\t{{{ALL_LEAVES}}},"b":[1 , 2]}}'),
    ('{"a":{"tran_detail":null},"t":"\\"tran_detail\\":null","tran_detail":null}',
     f'{{"a":{{"tran_detail":null}},"t":"\\"tran_detail\\":null","tran_detail":{{{ALL_LEAVES}}}}}'),
    ('{"a":{"tran_detail":{"product_id":1}},"tran_detail":{ "product_id":7.0}}',
     f'{{"a":{{"tran_detail":{{"product_id":1}}}},"tran_detail":{{{CARDS},"tran_amount":150.5, "product_id":7.0}}}}'),
    ('{"product_id":null,"tran_detail":{"product_id" : null,"x":{"product_id":null},"tran_amount":2,"tran_card_type":[]},"product":null}',
     '{"product_id":null,"tran_detail":{"product_id" : "PID-001","x":{"product_id":null},"tran_amount":2,"tran_card_type":[]},"product":null}'),
    ('{"tran_detail":{"x":"{\\"product_id\\":null}","product_id":null,"tran_amount":null,"tran_card_type":null}}',
     f'{{"tran_detail":{{"x":"{{\\"product_id\\":null}}","product_id":"PID-001","tran_amount":150.5,{CARDS}}}}}'),
    ('{"tran_detail":[1.50]}', '{"tran_detail":[1.50]}'), ('{"tran_detail":{"tran_amount":1e0,"product_id":"","tran_card_type":0}}',) * 2])
def test_completing_keeps_every_other_byte(spark, given, want):
    (row,) = publish.completed_messages(msg.decode(topic(spark, [given]))).collect()
    assert row.value == want
    assert not {"tran_card_type", "product_id", "tran_amount"} - set(json.loads(want)["tran_detail"]) or given == want


def test_what_cannot_be_patched_is_refused_and_complete_escapes_pass(spark):
    escaped = '{"tran\\u005fdetail":%s}'
    texts = [escaped % "null", escaped % '{"tran_amount":1}', escaped % '{"tran_amount":1,"product_id":2,"tran_card_type":[]}',
             '{"a":1,"a":2}', '{"tran_detail":{"tran_amount":1,"tran_amount":2}}']
    decoded = msg.decode(topic(spark, texts))
    assert [r.value for r in publish.completed_messages(decoded).collect()] == [texts[2]]
    reasons = {r.value: r.reject_reason for r in publish.refused_messages(decoded).collect()}
    assert reasons == {texts[0]: "escaped name", texts[1]: "escaped name", texts[3]: "malformed", texts[4]: "malformed"}


def test_keys_go_along(spark):
    decoded = msg.decode(topic(spark, ['{"a":1}']).withColumn("key", F.lit("k").cast("binary")))
    (row,) = publish.completed_messages(decoded).collect()
    assert bytes(row.key) == b"k"


def test_identity_without_positions_is_the_payload(spark, tmp_path):
    payload = '{"results":[{"user":{"username":"a"}}]}'
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "m.json").write_text(f"{payload}\n{payload}\n")
    rows = transactions(text_files(spark, str(tmp_path / "in"), "t", streaming=False), ("user_id",)).collect()
    assert len(rows) == 2 and len({(r.record_id, r.user_id) for r in rows}) == 1


def test_schema_lists(spark):
    assert len(FLAT) == 29 and len(ARCHIVE) == 30 and len(HOT) == 13
    assert message_schema(FLAT) == MESSAGE
    assert message_schema(["tran_year", "nationality"]).simpleString() == (
        "struct<results:array<struct<user:struct<registered:bigint>>>,nationality:string>")
    assert message_schema(["nationality"]).simpleString() == (
        "struct<results:array<struct<user:struct<gender:string>>>,nationality:string>")


def test_a_message_is_completed_once(spark):
    """a filter on what is computed took a copy of the computation along."""
    decoded = msg.decode(topic(spark, ['{"a":1}']))
    steps = 2 + len(publish._DEFAULTS)
    for rows in (publish.completed_messages(decoded), publish.refused_messages(decoded)):
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_extract_all(") <= steps


def test_only_what_is_put_in_is_parsed_again(spark):
    plan = publish.completed(msg.decode(topic(spark, ['{"a":1}'])))._jdf.queryExecution().optimizedPlan().toString()
    # The message, and the tries of each step.
    assert len(re.findall(r"parse_?json\(", plan, re.I)) <= 1 + 2 + len(publish._DEFAULTS)


def test_nested_details_are_left_alone(spark):
    text = '{"tran_detail":{"tran_detail":{"product_id":null},"product_id":%s,"tran_amount":1,"tran_card_type":0}}'
    (row,) = publish.completed_messages(msg.decode(topic(spark, [text % "null"]))).collect()
    assert row.value == text % '"PID-001"'
