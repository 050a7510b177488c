"""Column functions, one fact per row."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tierline.functions import json as J, stamps, text


def _one(spark, value, expression, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(expression(F.col("v"))).first()[0]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("north-rhine  McDONALD", "North-rhine  Mcdonald"),
        ("  berlin ", "Berlin"),
        ("\ta\n", "\ta\n"),
        ("", ""),
        (None, "Not Informed"),
    ],
)
def test_place(spark, value, expected):
    assert _one(spark, value, text.place) == expected


def test_place_blank_as_missing(spark):
    assert _one(spark, "  ", lambda v: text.place(v, True)) == "Not Informed"
    assert _one(spark, " x ", lambda v: text.place(v, True)) == "X"


def test_title_keeps_null(spark):
    assert _one(spark, None, text.title) is None
    assert _one(spark, " brewPUB ", text.title) == "Brewpub"


@pytest.mark.parametrize("value, expected", [("+1 (555) 123-x", "1555123"), (None, None), ("", ""), ("٣4", "4")])
def test_digits(spark, value, expected):
    assert _one(spark, value, text.digits) == expected


@pytest.mark.parametrize(
    "value, expected", [("n/a", None), ("", None), (" 1.5 ", 1.5), ("-12.50", -12.5), (None, None), ("1e3", 1000.0)]
)
def test_number(spark, value, expected):
    assert _one(spark, value, text.number) == expected


def test_url(spark):
    assert _one(spark, " HTTP://A.Example.COM ", text.url) == "http://a.example.com"


@pytest.mark.parametrize(
    "parts, expected",
    [(("a", "", "c"), "a  c"), ((None, None, None), ""), (("a", None, "c"), "a c")],
)
def test_joined(spark, parts, expected):
    df = spark.createDataFrame([parts], "a string, b string, c string")
    assert df.select(text.joined(*(F.col(c) for c in "abc"))).first()[0] == expected


@pytest.mark.parametrize(
    "payload, missing",
    [
        ('{"id":"1","city":null}', []),
        ('{"id":"1"}', ["city"]),
        ('{"ID":"1","city":"x"}', ["id"]),
        ("{bad", None),
        ("[1]", None),
        (None, None),
        ("", None),
        ("null", None),
        ('"id"', None),
        (' {"id":{"city":1},"city":[{}]}\n', []),
        ('{"id":1,"city":2} junk', None),
        ('{"id":1,"city":2}] junk', None),
        ('{"id":1,"city":2}],[{"id":"2"}', None),
        ('{"id":1,"city":2},{"id":"2"}', None),
        ('{"id":1,"city":2}}', None),
        ('{"id":1},"city":{}', None),
    ],
)
def test_required_keys_are_about_presence(spark, payload, missing):
    assert _one(spark, payload, lambda v: J.missing_keys(v, ["id", "city"])) == missing
    assert _one(spark, payload, lambda v: J.has_keys(v, ["id", "city"])) is (missing == [])


@pytest.mark.parametrize(
    "payload, expected",
    [('{"id":"a"}', "a"), ('{"id":7}', "7"), ('{"id":null}', None), ('{"id":"a","id":"b"}', "b"), ("{bad", None)],
)
def test_record_id(spark, payload, expected):
    assert _one(spark, payload, J.record_id) == expected
    assert _one(spark, payload, lambda v: J.findings(v, ["id"])["id"]) == expected


def test_a_record_is_parsed_once(spark):
    from tierline.operators import records

    found = records.examined(spark.createDataFrame([("{}",)], "payload string"))
    assert found._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


LONG = "x" * 200_000
BIG = "12345678901234567890123456789012345678901234567890"


@pytest.mark.parametrize(
    "left, right, distinct",
    [
        ('{"x":1}', '{ "x": 1 }', False),
        ('{"a":1,"b":[1,{"c":2,"d":3}]}', '{"b":[1,{"d":3,"c":2}],"a":1}', False),
        ('{"x":1}', '{"x":1.0}', False),
        ('{"x":1.50}', '{"x":1.5}', False),
        ('{"x":1}', '{"x":2}', True),
        ('{"x":1}', '{"x":"1"}', True),
        ('{"x":null}', "{}", True),
        ('{"x":[1,2]}', '{"x":[2,1]}', True),
        ('{"x":1,"x":2}', '{"x":2}', False),
        ('{"x":"\\u00e9"}', '{"x":"é"}', False),
        ("{bad", "{bad", False),
        ("{bad", "{ bad", True),
        (None, None, False),
        (None, "{}", True),
        (f'{{"t":"{LONG}a"}}', f'{{ "t":"{LONG}b"}}', True),
        (f'{{"t":"{LONG}"}}', f'{{ "t":"{LONG}"}}', False),
        (f'{{"x":{BIG}1}}', f'{{"x":{BIG}2}}', True),
        ('{"a":"Suite 3E2","b":1}', '{"b":1,"a":"Suite 3E2"}', False),
        ('{"a":"\\"Infinity\\\\","b":"7E7"}', '{"b":"7E7","a":"\\"Infinity\\\\"}', False),
        ('{"a":1e300,"b":"x"}', '{"b":"x","a":1e300}', False),
        ('{"a":1e300}', '{"a":1.0000000000000000000000000000001e300}', True),
        ('{"a":[1e2,-0,0.10]}', '{"a":[100, 0.0, 1e-1]}', False),
        ('{"a":100}', '{"a":100.0}', False),
        ('{"a":1E2}', '{"a":100.0}', False),
        ('{"a":0.001e+5}', '{"a":1e2}', False),
        ('{"a":-1e2}', '{"a":1e2}', True),
        ('{"a":1e2}', '{"a":"1e2"}', True),
        ('{"a":1e2,"b":"x1e2"}', '{"b":"x1e2","a":100}', False),
        ('{"a":1e2,"b":"x1e2"}', '{"b":"x100","a":100}', True),
        (f'{{"a":{"9" * 60}}}', f'{{"a":{"9" * 60}.0, "a":{"9" * 60}.00}}', False),
        (f'{{"a":0.{"0" * 60}1}}', '{"a":1e-61}', False),
        ('{"a":1e2} x', '{"a":100}', True),
        ('{"a":01e2}', '{"a":1e2}', True),
        ('{"a":1e}', '{"a":1}', True),
        ('{"a":1e99999999999999999999999999999999999999999}', '{"a":1e99999999999999999999999999999999999999999, "a":1e99999999999999999999999999999999999999999}', False),
        ('{"a":1}] x', '{"a":1}] y', True),
        ('{"a":1}],[{"id":"2"}', '{"a":1}', True),
        ('1e1', '10', False),
        ('{"a":1} x', '{"a":1}', True),
        ('{"a":1}{"b":2}', '{"a":1}', True),
    ],
)
def test_json_distinct(spark, left, right, distinct):
    df = spark.createDataFrame([(left, right)], "a string, b string")
    assert df.select(J.json_distinct(F.col("a"), F.col("b"))).first()[0] is distinct


def test_stamp_ignores_session_zone(spark):
    moment = datetime(2024, 7, 1, 9, 0, 0, 123456)
    other = moment.replace(tzinfo=timezone(timedelta(hours=2)))
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            row = spark.range(1).select(F.unix_micros(stamps.stamp(moment)), F.unix_micros(stamps.stamp(other)))
            assert row.first()[0] == 1719824400123456
            assert row.first()[1] == 1719824400123456 - 2 * 3600 * 1_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_run_id(spark):
    moment = datetime(2024, 3, 5, 9, 7, 59)
    assert stamps.run_id(moment) == "20240305_0907"
    assert spark.range(1).select(stamps.run_id_of(stamps.stamp(moment))).first()[0] == "20240305_0907"
