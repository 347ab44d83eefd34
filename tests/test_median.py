"""Grouped medians: equal to the plain aggregate whatever the values and the group sizes."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from lakelayer.operators.stats import grouped_median, grouped_medians, ordered_bits

INF, NAN = float("inf"), float("nan")
GROUPS = {
    "inf": [1.0, 2.0, 3.0, 4.0, INF],
    "minus": [-INF, 1.0, 2.0, 3.0, 4.0],
    "both": [-INF, INF, INF, -INF, 0.0, 5.0],
    "nan": [NAN, NAN, 1.0, NAN],
    "middle nan": [1.0, NAN],
    "zeros": [-0.0, 0.0, -0.0, -0.0],
    "null": [None, None],
    "some null": [None, 7.5, None, 9.5],
    "tiny": [5e-324, 1e-310, -5e-324, 2.0**-1022],
    "huge": [1.7976931348623157e308, 1.7976931348623157e308, -1.7976931348623157e308],
    "close": [1.0, math.nextafter(1.0, 2), math.nextafter(1.0, 0), 2.0, math.nextafter(2.0, 0)],
    "many": [((i * 7919) % 1009) / 8 - 50 for i in range(1500)],
    None: [3.0, 1.0, 2.0],
}


def key(v):
    return "nan" if v is not None and math.isnan(v) else v


def test_ordered_bits_sort_like_the_numbers(spark):
    values = sorted({v for vs in GROUPS.values() for v in vs if v is not None and not math.isnan(v)} | {2.0**e * s for e in range(-1074, 1024, 7) for s in (1, -1)})
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("x")).collect()
    for r in got:
        bits = struct.unpack("<q", struct.pack("<d", abs(r.v)))[0]
        assert r.x == (bits if r.v >= 0 else -bits), r
    nan, inf = (spark.createDataFrame([(v,) for v in (NAN, INF)], "v double").select(ordered_bits(F.col("v"))).collect())
    assert nan[0] > inf[0]


@pytest.mark.parametrize("small", [1, 3, 1_000_000])
def test_medians_equal_the_plain_aggregate(spark, small):
    rows = [(g, v, None if v is None else -v) for g, vs in GROUPS.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, lat double, lng double").repartition(4)
    want = {r.g: (key(r.lat), key(r.lng)) for r in df.groupBy("g").agg(F.median("lat").alias("lat"), F.median("lng").alias("lng")).collect()}
    got = grouped_medians(df, ["g"], {"lat": "lat", "lng": "lng"}, small_group_rows=small).collect()
    assert {r.g: (key(r.lat), key(r.lng)) for r in got} == want and len(got) == len(GROUPS)


def test_two_group_columns_and_clashing_names(spark):
    df = spark.createDataFrame([(i % 2, None if i % 3 else i % 5, float(i)) for i in range(60)], "_c int, b int, v double")
    got = grouped_median(df, ["b"], "v", "m", small_group_rows=2).collect()
    assert {r.b: r.m for r in got} == {r.b: r.m for r in df.groupBy("b").agg(F.median("v").alias("m")).collect()}
