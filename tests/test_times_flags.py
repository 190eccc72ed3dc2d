import datetime as dt

from conftest import one
from pyspark.sql import functions as F
from tessera.functions import flags as FL
from tessera.functions import times as TM


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_law_a_formats(spark):
    df = frame(spark, ["2024-01-05 13:04:05", "2024-01-05 13:04:05.123", "05/01/24 01:04:05 PM",
                       "05/01/24 12:04:05 AM", "5/1/24 01:04:05 PM", "bad", None])
    got = one(df.select(TM.parse_any("v", TM.LAW_A_FORMATS).alias("t")), "t")
    assert got == [dt.datetime(2024, 1, 5, 13, 4, 5), dt.datetime(2024, 1, 5, 13, 4, 5, 123000),
                   dt.datetime(2024, 1, 5, 13, 4, 5), dt.datetime(2024, 1, 5, 0, 4, 5), None, None, None]


def test_times_that_a_zone_skips_and_impossible_ones(spark):
    df = frame(spark, ["2024-03-10 02:30:00", "10/03/24 02:30:00 AM", "31/02/24 01:00:00 AM", "10/03/24 13:00:00 PM",
                       "10/03/24 12:59:59 PM", "2024-13-01 00:00:00", " 2024-03-10 02:30:00.5"])
    out = df.select(TM.parse_any("v").alias("t"))
    want = [dt.datetime(2024, 3, 10, 2, 30), dt.datetime(2024, 3, 10, 2, 30), None, None,
            dt.datetime(2024, 3, 10, 12, 59, 59), None, dt.datetime(2024, 3, 10, 2, 30, 0, 500000)]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert one(out, "t") == want
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_day_first_nine_digit_fraction_kept_to_micros(spark):
    df = frame(spark, ["05/01/24 01:04:05,123456789 PM", "2024-01-05 13:04:05", "2024-01-05 13:04:05.5"])
    got = one(df.select(TM.parse_any("v", TM.DAY_FIRST_FORMATS).alias("t")), "t")
    assert got == [dt.datetime(2024, 1, 5, 13, 4, 5, 123456), dt.datetime(2024, 1, 5, 13, 4, 5),
                   dt.datetime(2024, 1, 5, 13, 4, 5, 500000)]


def test_every_text_that_sparks_own_formats_take(spark):
    day = ["10/03/24 02:30:00 pm", "10/03/24 02:30:00 Pm", "10/03/24 12:00:00 am", "10/03/24 02:30:60 AM",
           "10/03/24 02:30:00 AM\n"]
    fraction = ["10/03/24 02:30:00,123456789 am", "10/03/24 02:30:00,123 Am", "10/03/24 02:30:00,1 PM",
                "10/03/24 02:30:00, PM", "10/03/24 02:30:59,1234567891 PM"]
    iso = ["2024", " 2024 ", "2024-03", "2024-3-1", "+2024-01-01", "2024-03-10 02:30:60", "bad", ""]
    half_past = dt.datetime(2024, 3, 10, 14, 30)
    want = [half_past, half_past, dt.datetime(2024, 3, 10), None, None,
            dt.datetime(2024, 3, 10, 2, 30, 0, 123456), dt.datetime(2024, 3, 10, 2, 30, 0, 123000),
            dt.datetime(2024, 3, 10, 14, 30, 0, 100000), None, None,
            dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1), dt.datetime(2024, 3, 1), dt.datetime(2024, 3, 1),
            dt.datetime(2024, 1, 1), None, None, None]
    df = frame(spark, day + fraction + iso)
    assert one(df.select(TM.parse_any("v", TM.DAY_FIRST_FORMATS).alias("t")), "t") == want
    for formats in (TM.LAW_A_FORMATS, TM.FORM_FORMATS):  # these have no fraction of a day-first text
        assert one(df.select(TM.parse_any("v", formats).alias("t")), "t") == want[:5] + [None] * 5 + want[10:]
    zoned = frame(spark, ["2024-03-10 02:30:00 America/New_York"])  # a zone's slash is no day-first text
    assert one(zoned.select(TM.parse_any("v").alias("t")), "t") == [dt.datetime(2024, 3, 10, 7, 30)]


def test_offsets_are_those_of_sparks_default_parser_in_utc(spark):
    texts = ["2024-03-10T02:30:00+05:00", "2024-03-10 02:30:00Z", "2024-03-10 02:30:00.123456-03:30", "2024-03-10T02:30:00 UTC",
             "2024-03-10 02:30:00 PST", "2024-03-10 02:30:00GMT+1", "2024-03-10 02:30+14:00", "1969-01-01 00:00:00.000001+01:00",
             "2024-03-10 02:30:00+25:00", "2024-03-10 02:30:00 Nowhere/City", "2024-03-10", "2024-03-10 02:30"]
    df = frame(spark, texts)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        want = one(df.select(F.try_to_timestamp("v").cast("timestamp_ntz").alias("t")), "t")
        assert want[0] == dt.datetime(2024, 3, 9, 21, 30) and want[8:10] == [None, None]
        for zone in ("UTC", "America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for expr in (TM.parse_any("v"), TM.parse_any("v", TM.DAY_FIRST_FORMATS), TM.as_timestamp("v")):
                assert one(df.select(expr.alias("t")), "t") == want
        kolkata = one(df.select(TM.as_timestamp("v", "Asia/Kolkata").alias("t")), "t")
        assert kolkata[0] == dt.datetime(2024, 3, 10, 3, 0) and kolkata[10:] == want[10:]  # a text without a zone stays
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        for formats in (TM.LAW_A_FORMATS, TM.FORM_FORMATS, TM.DAY_FIRST_FORMATS):
            own = F.coalesce(*[F.try_to_timestamp("v", F.lit(f)) if f else F.try_to_timestamp("v") for f in formats])
            assert df.where(~TM.parse_any("v", formats).eqNullSafe(own.cast("timestamp_ntz"))).count() == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_result_type_is_wall_clock(spark):
    df = frame(spark, ["2024-03-10 02:30:00"]).select(TM.parse_any("v").alias("t"))
    assert dict(df.dtypes)["t"] == "timestamp_ntz"


def test_plain_cast(spark):
    df = frame(spark, ["2024-01-05 13:04:05.5", "05/01/24 01:04:05 PM", None])
    assert one(df.select(TM.as_timestamp("v").alias("t")), "t") == [
        dt.datetime(2024, 1, 5, 13, 4, 5, 500000), None, None]


def test_flags(spark):
    df = frame(spark, ["0", "1", "2", "1.0", " 1 ", "x", "", None, "0.0", " 0 "])
    out = df.select(FL.safe_int("v").alias("i"), FL.law_a_flag("v").alias("a"), FL.law_b_flag("v").alias("b"))
    assert [tuple(r) for r in out.collect()] == [
        (0, 0, 0), (1, 1, 1), (2, 1, 2), (1, 1, 1), (1, 1, 1), (None, 1, None), (None, 1, None),
        (None, 1, None), (0, 0, 0), (0, 0, 0)]
