"""Fields that the schema does not declare stay with the event and are counted."""

from pyspark.sql import functions as F

from footfall.operators.quality import field_presence
from footfall.schema import EVENT_COLUMNS
from footfall.sources.events import read_events, read_events_whole, with_field
from tests.test_streaming import same

LINES = """
{"user_id":"u1","timestamp":"2025-04-01T00:00:00","event_type":"purchase","total_amount":10.5,"coupon":"A","geo":{"lat":1.5}}
{"user_id":"u2","quantity":"abc","coupon":null,"beta":true}
{"user_id":"u3","coupon":7,"beta":false,"list":[1,2],"geo":"text"}

not json
[1, 2]
{"broken":
"""


def lines(spark, tmp_path, text=LINES):
    path = tmp_path / "lines.json"
    path.write_text(text)
    return str(path)


def test_declared_columns_are_those_of_the_scan(spark, tmp_path):
    path = lines(spark, tmp_path)
    whole = read_events_whole(spark, path)
    plain = read_events(spark, path, keep_corrupt=True)
    assert whole.columns == [*plain.columns, "line"]
    objects = lambda frame: frame.filter("user_id IS NOT NULL").drop("line")
    assert same(objects(plain), objects(whole))
    assert whole.filter("line IS NULL").count() == 2  # broken lines keep their text, as in the scan
    assert whole.filter("line IS NULL AND _corrupt_record IS NOT NULL").count() == 2


def test_fields_become_columns(spark, tmp_path):
    events = read_events_whole(spark, lines(spark, tmp_path))
    events = with_field(events, "coupon")
    events = with_field(events, "beta", "boolean")
    events = with_field(events, "latitude", "double", "$.geo.lat")
    found = {r.user_id: (r.coupon, r.beta, r.latitude) for r in events.filter("user_id IS NOT NULL").collect()}
    assert found == {"u1": ("A", None, 1.5), "u2": (None, True, None), "u3": ("7", False, None)}


def test_presence(spark, tmp_path):
    found = {r.field: (r.declared, r.lines, r.types) for r in field_presence(read_events_whole(spark, lines(spark, tmp_path))).collect()}
    assert found["coupon"] == (False, 3, "string,number,null")
    assert found["geo"] == (False, 2, "string,object")
    assert found["beta"] == (False, 2, "boolean")
    assert found["list"] == (False, 1, "array")
    assert found["user_id"] == (True, 3, "string")
    assert found["total_amount"] == (True, 1, "number")
    assert found["order_id"] == (True, 0, "")
    assert set(EVENT_COLUMNS) <= set(found)
    share = field_presence(read_events_whole(spark, lines(spark, tmp_path))).filter("field = 'coupon'").first().share
    assert share == 3 / 6


def test_no_lines(spark, tmp_path):
    empty = read_events_whole(spark, lines(spark, tmp_path, "\n"))
    rows = field_presence(empty).collect()
    assert {r.field for r in rows} == set(EVENT_COLUMNS) and {r.share for r in rows} == {0.0}


def test_one_scan(spark, tmp_path):
    plan = read_events_whole(spark, lines(spark, tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    wanted = read_events_whole(spark, lines(spark, tmp_path)).select("user_id", F.col("event_type"))
    assert "parse_json" not in wanted._jdf.queryExecution().executedPlan().toString()  # not asked for
