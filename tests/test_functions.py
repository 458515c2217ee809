"""Tiles and time keys against plain Python."""

import random
from datetime import datetime, timezone

from pyspark.sql import functions as F

from ridelabel.functions import tiles
from ridelabel.functions.timekeys import bucket, local_second_of_day


def bisect_geohash(lat, lon, chars=12):
    alphabet = "0123456789bcdefghjkmnpqrstuvwxyz"
    box = [[-180.0, 180.0], [-90.0, 90.0]]
    text, axis = "", 0
    for _ in range(chars):
        value = 0
        for _ in range(5):
            low, high = box[axis]
            middle = (low + high) / 2
            upper = (lon, lat)[axis] >= middle
            value = value * 2 + upper
            box[axis] = [middle, high] if upper else [low, middle]
            axis = 1 - axis
        text += alphabet[value]
    return text, sum(box[1]) / 2, sum(box[0]) / 2


def positions():
    rng = random.Random(7)
    rows = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(1500)]
    for bits in (17, 20, 30):  # cell edges, and one step below and above them
        for _ in range(300):
            lat = rng.randrange(1, 1 << bits) * (180.0 / (1 << bits)) - 90.0
            lon = rng.randrange(1, 1 << bits) * (360.0 / (1 << bits)) - 180.0
            import math
            rows += [(lat, lon), (math.nextafter(lat, -100), math.nextafter(lon, -200)),
                     (math.nextafter(lat, 100), math.nextafter(lon, 200))]
    return rows + [(90.0, 180.0), (-90.0, -180.0), (0.0, 0.0)]


def test_tiles_equal_bisection(spark):
    rows = positions()
    df = spark.createDataFrame(rows, "lat DOUBLE, lon DOUBLE")
    lat, lon = F.col("lat"), F.col("lon")
    got = df.select("lat", "lon", tiles.tile(lat, lon, 12).alias("g12"), tiles.tile(lat, lon, 7).alias("g7"),
                    tiles.tile_id(lat, lon, 8).alias("t8")).withColumn(
        "back", tiles.text_tile(F.left("g12", F.lit(8)))).collect()
    for r in got:
        want, _, _ = bisect_geohash(r.lat, r.lon)
        assert r.g12 == want and r.g7 == want[:7] and r.t8 == r.back


def test_centres_of_any_length(spark):
    rng = random.Random(3)
    rows = []
    for chars in range(1, 13):
        for _ in range(40):
            rows.append(bisect_geohash(rng.uniform(-90, 90), rng.uniform(-180, 180), chars))
    df = spark.createDataFrame(rows, "g STRING, lat DOUBLE, lon DOUBLE")
    for r in df.withColumn("c", tiles.tile_center(F.col("g"))).collect():
        assert (r.c.lat, r.c.lon) == (r.lat, r.lon)


def test_common_prefix_of_two_cells(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(300):
        lat, lon, step = rng.uniform(-80, 80), rng.uniform(-170, 170), 10 ** rng.uniform(-8, 1)
        rows.append((lat, lon, lat + step, lon + step))
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    x, y = tiles.cell(F.col("a"), F.col("b")), tiles.cell(F.col("c"), F.col("d"))
    got = df.select("*", x.alias("x"), y.alias("y")).withColumn("n", tiles.common_chars(F.col("x"), F.col("y")))
    for r in got.withColumn("p", tiles.prefix_text(F.col("x"), F.col("n"))).collect():
        g, h = bisect_geohash(r.a, r.b)[0], bisect_geohash(r.c, r.d)[0]
        n = next((i for i in range(12) if g[i] != h[i]), 12)
        assert (r.n, r.p) == (n, g[:n])


def test_local_time_over_a_clock_change_and_midnight(spark):
    rows = [
        ("2024-03-31 00:59:59", 7199), ("2024-03-31 01:00:00", 10800),   # clocks go forward
        ("2024-10-27 00:59:59", 10799), ("2024-10-27 01:00:00", 7200),   # and back
        ("2024-01-15 23:00:00", 0), ("2024-01-15 22:59:59", 86399),
    ]
    data = [(datetime.fromisoformat(t).replace(tzinfo=timezone.utc), s) for t, s in rows]
    df = spark.createDataFrame(data, "t TIMESTAMP, want INT")
    zone = "Europe/Berlin"
    for r in df.select("want", local_second_of_day(F.col("t"), zone).alias("s"),
                       bucket(F.col("t"), zone, 5).alias("b")).collect():
        assert r.s == r.want and r.b == r.want // 300
