"""Scalar functions on hand-made edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from listenhouse import functions as fn
from listenhouse.plans.dims import dim_datetime, dim_datetime_sql, sunday_week
from listenhouse.sources.calendar import calendar_hours


def one(spark, column, schema="s string", row=("x",)):
    return spark.createDataFrame([row], schema).select(column).first()[0]


@pytest.mark.parametrize("damaged, repaired", [
    ("BjÃ¶rk", "Björk"),
    ("Bj\\303\\266rk", "Björk"),
    ("\\u00c3\\u00b6", "ö"),
    ("\\xc3\\xb6", "ö"),
    ('"q"', "q"), ('""', ""), ('""a"b""', 'a"b'),
    ("Björk", "Björk"), ("日本", "日本"), ("a\\", "a\\"),
    ("AC\\/DC", "AC\\/DC"), ("C:\\dir", "C:\\dir"),
    ("tab\\there", "tab\there"), ("back\\\\slash", "back\\slash"),
    ('Dvořák \\n "live"', 'Dvořák \\n "live"'), ("ař\\tb", "ař\\tb"), ('"日本"', '"日本"'), ('"\\x4"', '"\\x4"'), ("\\N{DASH}", "\\N{DASH}"),
    (None, None), ("", ""), ("plain", "plain"), ("\\400", "\\400"),
    ("\\U0000006F", "o"),
])
def test_repair_text(spark, damaged, repaired):
    assert one(spark, fn.repair_text("s"), row=(damaged,)) == repaired


@pytest.mark.filterwarnings("ignore::DeprecationWarning")
def test_repair_equals_codec_chain(spark):
    """Wherever the codec chain accepts a text, the native repair agrees; what it rejects comes back."""
    rng = random.Random(3)
    alphabet = list("ab\"'\\nrtx0123467uÃ¶©é \n") + ["\\303\\266", "\\xc3", "\\u00e9", "日"]
    texts, expected = [], []
    while len(texts) < 800:
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 9)))
        try:
            chain = text.encode("latin1").decode("unicode-escape").encode("latin1").decode("utf-8")
        except UnicodeError:
            texts.append((len(texts), text))
            expected.append(text)
            continue
        texts.append((len(texts), text))
        expected.append(chain.strip('"'))
    rows = spark.createDataFrame(texts, "i int, s string").repartition(4)
    got = dict(rows.select("i", fn.repair_text("s")).collect())
    assert {i: e for i, e in enumerate(expected) if got[i] != e} == {}


def test_epoch_millis(spark):
    ts = one(spark, fn.from_epoch_millis("m").cast("string"), "m bigint", (1640995200123,))
    assert ts == "2022-01-01 00:00:00.123"


def test_gap_is_difference_of_whole_seconds(spark):
    start = F.lit("2024-01-01 00:00:00.900").cast("timestamp_ntz")
    end = F.lit("2024-01-01 00:00:02.100").cast("timestamp_ntz")
    assert one(spark, fn.gap_seconds(start, end)) == 2


@pytest.mark.parametrize("dtype", ["timestamp", "timestamp_ntz"])
def test_hour_start_keeps_the_type(spark, dtype):
    df = spark.range(1).select(F.lit("2024-02-29 23:59:59.999999").cast(dtype).alias("ts"))
    out = df.select(fn.hour_start("ts").alias("h"))
    assert out.dtypes == [("h", dtype)]
    assert str(out.first()[0]) == "2024-02-29 23:00:00"


def test_keys_tell_null_positions_apart(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None)], "x string, y string, z string"
    )
    md5 = {r[0] for r in df.select(fn.surrogate_key(["x", "y", "z"])).collect()}
    hashed = {r[0] for r in df.select(fn.surrogate_key(["x", "y", "z"], "hash")).collect()}
    assert len(md5) == 2 and len(hashed) == 1


def test_key_algorithms(spark):
    row = spark.createDataFrame([("song", "artist")], "song string, artist string").select(
        fn.song_key().alias("m"), fn.song_key("hash").alias("h"), fn.song_key("xxhash64").alias("x"),
        F.hash(F.lit("song_artist")).cast("bigint").alias("h2"), F.md5(F.lit("song-artist")).alias("m2"),
    ).first()
    assert row.m == row.m2 and row.h == row.h2 and isinstance(row.x, int)
    with pytest.raises(ValueError):
        fn.surrogate_key(["a"], "crc")


def test_filled_location_key(spark):
    schema = "city string, zip string, state string, lon double, lat double"
    got = one(spark, fn.filled_location_key(), schema, ("c", None, "s", 1.5, None))
    want = one(spark, F.hash(F.lit("c_Unknown_s_1.5_0")).cast("bigint"))
    assert got == want


def test_default_calendar(spark):
    hours = calendar_hours(spark)
    assert hours.count() == 43_848
    assert str(hours.agg(F.max("datetime")).first()[0]) == "2024-12-31 23:00:00"
    row = dim_datetime(hours).where("datetime = timestamp_ntz'2022-01-01 05:00:00'").first()
    assert (row.Week, row.WeekNameShort, row.DayOfWeek) == (52, "w52", 7)
    assert (row.QuarterNameLong, row.QuarterNameShort, row.QuarterNumberString) == (
        "1st quarter", "Q1", "01")
    assert (row.DateKey, row.DateSK) == (2022010105, 20220101)
    other = dim_datetime_sql(hours).where("datetime = timestamp_ntz'2022-01-02 00:00:00'").first()
    assert (other.Week, other.QuarterNameLong, other.QuarterNumberString) == (1, "Q1", "1")


def test_sunday_weeks(spark):
    days = spark.sql("SELECT explode(sequence(date'2019-12-25', date'2025-01-10')) AS d")
    for row in days.select("d", sunday_week("d").alias("w")).collect():
        assert row.w == int(row.d.strftime("%U"))


def test_exact_key_tells_parts_apart(spark):
    rows = spark.createDataFrame([("A-B", "C"), ("A", "B-C"), ("", None), (None, "")], "a string, b string")
    keys = [r[0] for r in rows.select(fn.surrogate_key(["a", "b"], "exact")).collect()]
    assert len(set(keys)) == 4
