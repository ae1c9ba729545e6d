"""Parsing and normalizing records, down to the malformed ones."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from quillstream.functions import records as R
from quillstream.operators import records
from quillstream.plans import jobs
from quillstream.schema import RECORD

PRETTY = """{
  "id": 1,
  "type": "comment", "by": "a",
  "time": 1160418111,
  "kids": [2, 3],
  "text": "Hi <p>there.", "parent": 9, "extra": 5
}"""

VALUES = {
    "1": PRETTY,
    "2": "null",
    "3": "{bad",
    "4": '{"id":3000000000,"type":"story","score":null,"text":"x"}',
    "5": '{"id":"7","text":5,"type":"job"}',
    "6": None,
    "7": '{"id":8,"deleted":true,"type":"comment"}',
    "8": '[{"id":9}]',
    "9": '{"id":10,"type":"poll","title":"t","parts":[11,12],"descendants":0}',
}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [
        (bytearray(k.encode()), v and bytearray(v.encode()), "items", 0, int(k), None)
        for k, v in VALUES.items()
    ]
    return spark.createDataFrame(rows, RECORD)


@pytest.fixture(scope="module")
def parsed(raw):
    return {r.key: r.asDict() for r in records.parse_items(raw).collect()}


def test_parse(parsed):
    one = parsed["1"]
    assert (one["id"], one["by"], one["kids"], one["parent"]) == (1, "a", [2, 3], 9)
    assert "extra" not in one
    assert parsed["4"]["id"] == 3_000_000_000
    assert parsed["5"]["id"] is None and parsed["5"]["text"] == "5" and parsed["5"]["type"] == "job"
    assert parsed["7"]["deleted"] is True and parsed["7"]["text"] is None
    assert parsed["9"]["parts"] == [11, 12] and parsed["9"]["descendants"] == 0


@pytest.mark.parametrize("key", ["2", "3", "6", "8"])
def test_ghosts_are_all_null(parsed, key):
    assert all(v is None for name, v in parsed[key].items() if name != "key")


@pytest.mark.parametrize("fill", ["", "."])
def test_normalize(raw, fill):
    rows = {r.key: r for r in records.normalize_items(records.parse_items(raw), fill).collect()}
    assert rows["1"].time == dt.datetime(2006, 10, 9, 18, 21, 51)
    assert rows["4"].score == 0
    for key in ("2", "3", "6", "8"):
        assert (rows[key].text, rows[key].title, rows[key].type) == (fill, fill, fill)
        assert rows[key].score == 0 and rows[key].time is None
    assert rows["7"].text == fill


def test_drop_ghosts(raw):
    kept = records.drop_ghosts(records.parse_items(raw))
    assert sorted(r.key for r in kept.collect()) == ["1", "4", "7", "9"]


def test_absurd_epoch_does_not_fail(spark):
    rows = spark.createDataFrame([(9_000_000_000_000_000_000,)], "time bigint")
    assert rows.select(R.epoch_timestamp(F.col("time")).isNotNull().alias("ok")).first().ok


def test_json_field_and_compact(raw):
    ids = {r.key: r.id for r in records.json_field(raw).collect()}
    assert ids["1"] == "1" and ids["5"] == "7" and ids["2"] is None and ids["3"] is None
    compact = {r.key: r.value for r in records.compact_json(raw).collect()}
    assert json.loads(compact["1"]) == json.loads(PRETTY)
    assert "\n" not in compact["1"]
    assert [compact[k] for k in "2368"] == [None] * 4


def test_compact_keeps_order_numbers_and_repeated_keys(spark):
    written = ['{ "b" : 1.50, "a" : 1e3,\n "b": "x  \\" y", "c.d": [1, 2] }', '[1]', '{"a": ', '{"a": "\\\\" }']
    rows = spark.createDataFrame([(str(k), v) for k, v in enumerate(written)], "key string, value string")
    compact = {r.key: r.value for r in records.compact_json(rows).collect()}
    assert compact == {"0": '{"b":1.50,"a":1e3,"b":"x  \\" y","c.d":[1,2]}', "1": None, "2": None, "3": '{"a":"\\\\"}'}


def test_encode_leaves_nulls_out(spark):
    rows = spark.createDataFrame([(1, None, [2, None])], "id bigint, text string, kids array<bigint>")
    encoded = records.encode_records(rows).first()
    assert (encoded.key, encoded.value) == ("1", '{"id":1,"kids":[2,null]}')
    assert records.json_envelope(rows).first().value == encoded.value


def test_unused_fields_are_not_parsed(raw):
    """Only id and text reach the parser when only they are wanted."""
    wanted = jobs.prepare(raw)
    plan = wanted._jdf.queryExecution().optimizedPlan().toString()
    assert "StructField(text,StringType,true)" in plan and "StructField(url" not in plan
