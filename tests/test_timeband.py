"""Time bands at and around the cut-offs, against branches written out case by case."""

from datetime import date, datetime
from itertools import product

import pytest
from pyspark.sql import functions as F

from quayledger.functions import timeband as tb

EDGES = [0, 1, 25199, 25200, 28799, 28800, 57599, 57600, 57601, 61199, 61200, 61201, 80000, 86399]
H16, H17, DAY = 57600, 61200, 86400
SPANS = [(d, s, e) for d, s, e in product(["Mon", "Sun", "PH"], EDGES, EDGES)]


@pytest.fixture(scope="module")
def spans(spark):
    rows = [(d, s, e) for d, s, e in SPANS if e >= s or e <= 28799]
    return spark.createDataFrame(rows, "day string, s int, e int")


def salt_case(day, s, e):
    stop = e + DAY if e < s and e <= 28799 else e
    if day == "Mon":
        normal = min(stop, H17) - s if s < H17 else 0
        late = min(stop, DAY) - max(s, H17) if min(stop, DAY) > H17 else 0
        return normal, late, max(0, stop - DAY)
    early = min(stop, H16) - s if s < H16 else 0
    return 0, early, stop - max(s, H16) if stop > H16 else 0


def test_salt_bands_match_the_cases_and_sum_to_the_span(spans):
    bands = tb.salt_bands(F.col("day"), F.col("s"), F.col("e"))
    for r in spans.select("day", "s", "e", *[b.alias(f"b{i}") for i, b in enumerate(bands)]).collect():
        assert (r.b0, r.b1, r.b2) == salt_case(r.day, r.s, r.e), r
        length = r.e - r.s + (DAY if r.e < r.s else 0)
        assert r.b0 + r.b1 + r.b2 == length, r


def forklift_case(day, s, e):
    total, at_150, at_200 = (e - s) // 60, 0, 0
    if day == "Mon":
        if e > H17:
            at_150 = (e - max(s, H17)) // 60
    else:
        if s < H16 and e < H16:
            at_150 = (e - s) // 60
        elif s < H16 < e:
            at_150 = (H16 - s) // 60
        if e > H16:
            at_200 = (e - max(s, H16)) // 60
    return total - at_150 - at_200, at_150, at_200


def test_forklift_bands_match_the_cases(spans):
    bands = tb.forklift_bands(F.col("day"), F.col("s"), F.col("e"))
    same_day = spans.filter("e >= s")
    for r in same_day.select("day", "s", "e", *[b.alias(f"b{i}") for i, b in enumerate(bands)]).collect():
        assert (r.b0, r.b1, r.b2) == forklift_case(r.day, r.s, r.e), r


def test_salt_forklift_keeps_its_two_habits(spark):
    rows = [("Sun", 50000, H16), ("Sun", 50000, 3600), ("Mon", 50000, 3600), ("Sun", 50000, 60000)]
    df = spark.createDataFrame(rows, "day string, s int, e int")
    bands = tb.salt_forklift_bands(F.col("day"), F.col("s"), F.col("e"))
    out = [tuple(r) for r in df.select(*bands).collect()]
    assert out[0] == (7600, 0, 0)  # ends on the cut-off: all normal
    assert out[1] == (7600, 7600, DAY - H16 + 3600)  # overnight: counted twice
    assert out[2] == (H17 - 50000, DAY - H17, 3600)
    assert out[3] == (0, 7600, 2400)


def test_labels_at_the_edges(spark):
    rows = [(d, t) for d in ["Mon", "Sun"] for t in EDGES]
    df = spark.createDataFrame(rows, "day string, t int")
    out = df.select(
        "day",
        "t",
        tb.label_by_cutoff(F.col("day"), F.col("t")).alias("cut"),
        tb.label_by_clock(F.col("day"), F.col("t")).alias("clock"),
    ).collect()
    for r in out:
        special = r.day == "Sun"
        cut = "overtime 200%" if special and r.t > H16 else (
            "overtime 150%" if special or r.t > H17 else "normal hours"
        )
        if r.t < 25200:
            clock = "overtime 150%"
        elif special:
            clock = "overtime 200%" if r.t >= H16 else "overtime 150%"
        else:
            clock = "overtime 150%" if r.t > H17 else "normal hours"
        assert (r.cut, r.clock) == (cut, clock), r


def test_hhmm(spark):
    df = spark.createDataFrame([(0,), (59,), (60,), (3599,), (86399,), (360000,)], "s long")
    out = [r[0] for r in df.select(tb.hhmm(F.col("s"))).collect()]
    assert out == ["00:00", "00:00", "00:01", "00:59", "23:59", "100:00"]


def test_valid_span(spark):
    df = spark.createDataFrame([(10, 20), (80000, 28799), (80000, 28800)], "s int, e int")
    assert [r[0] for r in df.select(tb.valid_span(F.col("s"), F.col("e"))).collect()] == [True, True, False]


def test_moment(spark):
    df = spark.createDataFrame([(date(2025, 11, 3), 61201), (None, 5)], "d date, s int")
    out = [r[0] for r in df.select(tb.moment(F.col("d"), F.col("s"))).collect()]
    assert out == [datetime(2025, 11, 3, 17, 0, 1), None]
