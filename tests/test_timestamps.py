from datetime import UTC, datetime, timedelta
from zoneinfo import ZoneInfo

import pytest

from millrace.operators import timestamps as ts

KYIV = ZoneInfo("Europe/Kyiv")

CASES = {
    "28.12.2019": ("2019-12-27T22:00:00.000000Z", "2019-12-28"),
    "2020/01/29": ("2020-01-28T22:00:00.000000Z", "2020-01-29"),
    "20120103": ("2012-01-02T22:00:00.000000Z", "2012-01-03"),
    "10.05.17": ("2017-05-09T21:00:00.000000Z", "2017-05-10"),
    "1144875600000": ("2006-04-12T21:00:00.000000Z", "2006-04-13"),
    "10 березня 2020 року": ("2020-03-09T22:00:00.000000Z", "2020-03-10"),
    "01 бер. 2019": ("2019-02-28T22:00:00.000000Z", "2019-03-01"),
    "Jan 10, 2014": ("2014-01-09T22:00:00.000000Z", "2014-01-10"),
    "2006-04-09T17:26:13-04:00": ("2006-04-09T21:26:13.000000Z", "2006-04-10"),
    "20080330T005325Z": ("2008-03-30T00:53:25.000000Z", "2008-03-30"),
    "2008-03-30T00:14:18.906055999Z": ("2008-03-30T00:14:18.906055Z", "2008-03-30"),
    "2008-10-26 03:13:10.689728": ("2008-10-26T00:13:10.689728Z", "2008-10-26"),
    "2008-03-30T03:07:41": ("2008-03-30T01:07:41.000000Z", "2008-03-30"),
    "2008-10-26 03:13:48 EET": ("2008-10-26T01:13:48.000000Z", "2008-10-26"),
    "01.04.2025 12:00:28 AM": ("2025-03-31T21:00:28.000000Z", "2025-04-01"),
    "01.04.2025 12:00:28 PM": ("2025-04-01T09:00:28.000000Z", "2025-04-01"),
    "Sat, 01 May 2021 15:57:06 +0300": ("2021-05-01T12:57:06.000000Z", "2021-05-01"),
    "1206835908": ("2008-03-30T00:11:48.000000Z", "2008-03-30"),
    "2022-11-22 00:06:23 Europe/Kyiv": ("2022-11-21T22:06:23.000000Z", "2022-11-22"),
}
BAD = ["", "   ", None, "н/д", "-", "31.02.2021 09:15", "0000-00-00 00:00:00", "99.99.9999", "невідомо", "13:45", "2020-01-01 25:00:00", "2020-1/2", "x" * 100_000, "2020-05-05 10:00:00 Mars/Base", "01.01.2020 13:00:00 PM"]


def frame(spark, values):
    return spark.createDataFrame([(k, v, "s") for k, v in enumerate(values)], "k long, v string, source string")


def test_forms(spark):
    rows = ts.normalize(ts.normalize(frame(spark, list(CASES)), "v", "i"), "v", "d", "date").collect()
    assert {r.v: (r.i, r.d) for r in rows} == CASES


def test_unusable_is_null(spark):
    assert [r.i for r in ts.normalize(frame(spark, BAD), "v", "i").collect()] == [None] * len(BAD)


def test_local_times_against_zoneinfo(spark):
    start = datetime(2007, 3, 25, 0, 0)
    times = [start + timedelta(minutes=37 * k) for k in range(0, 420_000, 97)]
    texts = [t.strftime("%Y-%m-%d %H:%M:%S") for t in times]
    wanted = [t.replace(tzinfo=KYIV, fold=0).astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ") for t in times]
    got = [r.i for r in ts.normalize(frame(spark, texts), "v", "i").orderBy("k").collect()]
    assert got == wanted


@pytest.mark.parametrize(("policy", "wanted"), [({"overlap": "later"}, "2008-10-26T01:13:10"), ({"overlap": "null"}, None)])
def test_overlap_policy(spark, policy, wanted):
    got = ts.normalize(frame(spark, ["2008-10-26 03:13:10"]), "v", "i", **policy).first().i
    assert (got and got[:19]) == wanted


def test_gap_policy(spark):
    read = lambda gap: ts.normalize(frame(spark, ["2008-03-30 03:07:41"]), "v", "i", gap=gap).first().i
    assert (read("before")[:19], read("after")[:19], read("null")) == ("2008-03-30T01:07:41", "2008-03-30T00:07:41", None)
    with pytest.raises(ValueError):
        ts.normalize(frame(spark, []), "v", "i", gap="x")


def test_zone_by_source_and_other_columns(spark):
    rows = spark.createDataFrame([("2020-01-01 00:00:00", "w", 1), ("2020-01-01 00:00:00", None, 2)], "v string, source string, i int")
    got = ts.normalize(rows, "v", "i", source="source", zones={"w": "Europe/London"}).collect()
    assert {r.source: r.i[:13] for r in got} == {"w": "2020-01-01T00", None: "2019-12-31T22"}
    assert ts.normalize(rows.limit(0), "v", "i").count() == 0


def test_session_zone_does_not_matter(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert ts.normalize(frame(spark, ["28.12.2019"]), "v", "i").first().i == "2019-12-27T22:00:00.000000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_found_leaves_the_one_form_out(spark):
    rows = frame(spark, ["2020-01-01", "01.01.2020", None, "2020-02-30"])
    assert [(r.row_key, r.norm_value) for r in ts.unusual(rows, "k", "v", "date", "f").collect()] == [("1", "2020-01-01")]
