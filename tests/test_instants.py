import pytest

from ledgerfold.operators.instants import normalise_instants

CASES = [
    ("Sun, 06 Nov 1994 08:49:37 GMT", None, "1994-11-06T08:49:37Z"), ("Sunday, 06-Nov-94 08:49:37 GMT", None, "1994-11-06T08:49:37Z"), ("Sun Nov  6 08:49:37 UTC 1994", None, "1994-11-06T08:49:37Z"),
    ("2025-09-02T10:26:29+0530", None, "2025-09-02T04:56:29Z"), ("2025-09-01t06:10:07z", None, "2025-09-01T06:10:07Z"), ("2025-09-03T04:58:07,266Z", None, "2025-09-03T04:58:07Z"), ("20250913T045500Z", None, "2025-09-13T04:55:00Z"),
    ("1757830412", None, "2025-09-14T06:13:32Z"), ("1758260612799", None, "2025-09-19T05:43:32Z"), ("  2025-09-07 05:36:34 UTC ", None, "2025-09-07T05:36:34Z"), ("2025-10-11 10:40:23−04:00", None, "2025-10-11T14:40:23Z"),
    ("September 3, 2025 12:45:41 AM UTC+00:00", None, "2025-09-03T00:45:41Z"), ("September 3, 2025 12:45:41 PM UTC-07:00", None, "2025-09-03T19:45:41Z"), ("2025-09-07T02:20:21[America/New_York]", None, "2025-09-07T06:20:21Z"), ("2025-09-30T05:52:55[UTC]", "Asia/Kolkata", "2025-09-30T05:52:55Z"),
    ("2025-11-02 01:36:53 America/Los_Angeles", None, "2025-11-02T08:36:53Z"), ("2025/09/04 22:12", "America/Los_Angeles", "2025-09-05T05:12:00Z"), ("2025-10-26 02:30:00", "Europe/Berlin", "2025-10-26T00:30:00Z"), ("8 Sep 2025 08:22:25", "no/zone", "2025-09-08T08:22:25Z"), ("2025-01-01 00:00:00", "UTC", "2025-01-01T00:00:00Z"),
    ("Wed, 3 Sep 2025 08:05:53 CEST", None, "2025-09-03T06:05:53Z"), ("2024-02-29T11:15:40Z", None, "2024-02-29T11:15:40Z"), ("2100-02-29T11:15:40Z", None, None), ("31 Nov 2025 08:00:00 GMT", None, None), ("2026-05-12T25:61:00Z", None, None), ("0000-00-00T00:00:00Z", None, None),
    ("2025-13-04 10:00:00Z", None, None), ("2025-01-01T00:00:00+99:00", None, None), ("2025-01-01T10:00:00[Nowhere/Else]", None, None), ("see v1", None, None), ("", None, None), (None, None, None), ("x" * 200_000, None, None), ("13:00 PM", None, None), ("1969-12-31T23:59:59Z", None, "1969-12-31T23:59:59Z"),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_notations(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, v, z, "kept") for i, (v, z, _) in enumerate(CASES)], "i int, value string, zone string, __instant_p string")
        got = {r["i"]: r["utc"] for r in normalise_instants(df, "value", local_zone="zone").collect()}
        assert {c[0]: got[i] for i, c in enumerate(CASES)} == {c[0]: c[2] for c in CASES}
        assert normalise_instants(df, "value", local_zone="zone").columns[-2:] == ["__instant_p", "utc"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_empty_and_filtered(spark):
    df = spark.createDataFrame([], "value string")
    assert normalise_instants(df, "value").filter("utc is not null").count() == 0
