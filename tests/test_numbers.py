import pytest
from pyspark.sql import functions as F

from tidemark.functions.numeric import measure
from tidemark.functions.time import to_wall_clock


def test_exact_measures_raise_rather_than_drop(spark):
    values = ["1.0", "0.004", "x", None, "NaN"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert [r.m and float(r.m) for r in df.select(measure("v", "decimal(18,2)").alias("m")).collect()] == [1.0, 0.0, None, None, None]
    for large in (1e17, float("inf")):
        wide = spark.createDataFrame([(large,), (1.0,)], "v double")
        with pytest.raises(Exception, match="out of range"):
            wide.select(F.sum(measure("v", "decimal(18,2)"))).collect()
        assert wide.select(F.sum(measure("v"))).first()[0] == large


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_wall_clock_does_not_depend_on_the_session_zone(spark, zone):
    texts = ["2024-03-10 02:30:00", "2024-03-10T02:30:00Z", "2024-03-10 02:30:00+01:00", "2024-03-10 02:30:00 UTC", "2024-03-10", "1969-12-31T23:59:59.25-05:00", "bad"]
    want = ["2024-03-10 02:30:00", "2024-03-10 02:30:00", "2024-03-10 01:30:00", "2024-03-10 02:30:00", "2024-03-10 00:00:00", "1970-01-01 04:59:59.25", None]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        assert [r.w for r in df.select(to_wall_clock("t").cast("string").alias("w")).collect()] == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
