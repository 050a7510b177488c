from datetime import date, datetime

from tierline.llm.url_filter import filter_captures, validity_intervals

ENTRIES = "list string, kind string, entry string, day date, listed boolean"


def d(day, month=1):
    return date(2024, month, day)


def test_intervals(spark):
    rows = [
        ("l", "domain", "A.org", d(1), True), ("l", "domain", "a.org", d(1), False), ("l", "domain", "a.org", d(3), True), ("l", "domain", "a.org", d(5), False),
        ("l", "domain", "a.org", d(6), False), ("l", "domain", "a.org", d(9), True), ("l", "domain", "b.org", d(2), False), (None, "domain", "c.org", d(2), True), ("l", "domain", "c.org", None, True),
    ]
    out = sorted(tuple(r) for r in validity_intervals(spark.createDataFrame(rows, ENTRIES)).collect())
    assert out == [("l", "domain", "a.org", d(1), d(5)), ("l", "domain", "a.org", d(9), None)]


def test_captures_as_of(spark):
    entries = spark.createDataFrame(
        [
            ("bad", "domain", "a.org", d(10), True), ("bad", "domain", "a.org", d(20, 3), False), ("worse", "domain", "x.a.org", d(1, 2), True),
            ("dirs", "prefix", "b.org/en/old", d(1), True), ("old", "domain", "c.org", date(2010, 1, 1), True),
        ],
        ENTRIES,
    )
    cases = [
        ("http://a.org/", datetime(2024, 1, 9, 23), ""), ("http://a.org/", datetime(2024, 1, 10), "bad"), ("https://u:p@X.A.org.:80/p?q#f", datetime(2024, 2, 1), "bad,worse"),
        ("http://x.a.org", datetime(2024, 3, 20), "worse"), ("http://aa.org", datetime(2024, 2, 1), ""), ("http://b.org/en/old/page", datetime(2024, 2, 1), "dirs"),
        ("http://b.org/EN/old", datetime(2024, 2, 1), "dirs"), ("http://b.org/en/older", datetime(2024, 2, 1), ""), ("http://w.c.org/", datetime(2024, 5, 1), "old"),
        (None, datetime(2024, 2, 1), ""), ("http://a.org/", None, ""), ("", datetime(2024, 2, 1), ""), ("http://a.org/" + "x/" * 3000, datetime(2024, 2, 1), "bad"),
    ]
    rows = [(i, u, t, "k") for i, (u, t, _) in enumerate(cases * 2)]
    out = filter_captures(spark.createDataFrame(rows, "id long, url string, fetched_at timestamp_ntz, lists string"), entries)
    got = {r["id"]: (",".join(r["lists"]), r["blocked"]) for r in out.collect()}
    assert got == {i: (w, bool(w)) for i, (_, _, w) in enumerate(cases * 2)}
    first = {r["id"]: r["first_entry"] for r in out.collect()}
    assert first[2]["entry"] == "a.org" and first[0] is None


def test_empty_tables(spark):
    entries = spark.createDataFrame([("l", "domain", "a.org", d(1), True)], ENTRIES)
    captures = spark.createDataFrame([("http://a.org/", datetime(2024, 2, 1))], "url string, fetched_at timestamp")
    assert filter_captures(captures.where("false"), entries).count() == 0
    assert [r["blocked"] for r in filter_captures(captures, entries.where("false")).collect()] == [False]
