import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from skyflow.operators import places as p
from skyflow.plans import joins


def brute_force(lat, lon, spots):
    def haversine(spot):
        dlat, dlon = math.radians(lat - spot[1]) / 2, math.radians(lon - spot[2]) / 2
        return math.sin(dlat) ** 2 + math.cos(math.radians(lat)) * math.cos(math.radians(spot[1])) * math.sin(dlon) ** 2

    return min(spots, key=lambda spot: (haversine(spot), spot[0]))[3]


def countries(spark, spots, points):
    places = spark.createDataFrame(spots, "id BIGINT, lat DOUBLE, lon DOUBLE, country STRING")
    index = p.build_place_index(places)
    df = spark.createDataFrame([(i, *point) for i, point in enumerate(points)], "i INT, lat DOUBLE, lon DOUBLE")
    found = p.country_from_position(df, "lat", "lon", index)
    return [r.country_code for r in found.orderBy("i").collect()]


def test_nearest_place_is_exact(spark):
    rng = random.Random(7)
    spots = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180), f"N{i % 40}") for i in range(150)]
    # A third of the places within one cell.
    spots += [(200 + i, rng.uniform(48, 49), rng.uniform(2, 3), f"N{i % 40}") for i in range(75)]
    points = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(600)]
    points += [(rng.uniform(47, 50), rng.uniform(1, 4)) for _ in range(200)]
    points += [(90.0, 0.0), (-90.0, 77.0), (10.0, 180.0), (10.0, -180.0), (45.0, 45.0), (0.0, 0.0)]
    assert countries(spark, spots, points) == [brute_force(*point, spots) for point in points]


def test_clustered_places(spark):
    """All places in one small box: cells far away keep few of them, and the answers stay exact."""
    rng = random.Random(8)
    spots = [(i, rng.uniform(48, 49), rng.uniform(2, 3), f"N{i % 40}") for i in range(1000)]
    points = [(math.degrees(math.asin(rng.uniform(-1, 1))), rng.uniform(-180, 180)) for _ in range(300)]
    points += [(rng.uniform(47, 50), rng.uniform(1, 4)) for _ in range(300)]
    assert countries(spark, spots, points) == [brute_force(*point, spots) for point in points]
    index = p.build_place_index(spark.createDataFrame(spots, "id BIGINT, lat DOUBLE, lon DOUBLE, country STRING"))
    leaves = index.table.select("lookup_key", "first", "last", F.size("candidates").alias("n")).collect()
    print(len(leaves), index.levels, max(r.n for r in leaves), sum(r.n for r in leaves))
    assert sum(r.n for r in leaves) < 100 * len(spots) and sum(r.n for r in leaves) < 4 * len(leaves)
    assert max(r.n for r in leaves) <= p.STALLED_CANDIDATES
    # The square degree is one key's worth of cells many times over, so keys there are cut further.
    assert index.levels and max(Counter(r.lookup_key for r in leaves).values()) <= p.LEAVES_PER_KEY


def covered(index):
    """Number of finest cells in all leaves of keys that are looked up; every cell must be in one."""
    return sum(r["last"] - r["first"] + 1 for r in index.table.select("first", "last").collect())


def test_leaves_cover_the_globe_once(spark):
    rng = random.Random(9)
    spots = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180), f"N{i % 40}") for i in range(60)]
    spots += [(100 + i, rng.uniform(10, 10.2), rng.uniform(20, 20.2), f"N{i % 40}") for i in range(200)]
    index = p.build_place_index(spark.createDataFrame(spots, "id BIGINT, lat DOUBLE, lon DOUBLE, country STRING"))
    assert covered(index) == 2**45


def test_one_key_per_position(spark):
    """Positions are neither multiplied nor shuffled, and the index is built once for equal places."""
    spots = spark.createDataFrame([(1, 0.0, 0.0, "A"), (2, 10.0, 10.0, "B")], "id BIGINT, lat DOUBLE, lon DOUBLE, country STRING")
    index = p.build_place_index(spots)
    folder = index.table.inputFiles()[0].rsplit("/", 2)[0]
    assert p.build_place_index(spots.repartition(3)).table.inputFiles()[0].rsplit("/", 2)[0] == folder
    assert p.build_place_index(spots.filter("id = 1")).table.inputFiles()[0].rsplit("/", 2)[0] != folder
    df = spark.range(10).select(F.col("id").cast("double").alias("lat"), F.col("id").cast("double").alias("lon"))
    plan = p.country_from_position(df, "lat", "lon", index)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("BroadcastHashJoin") == 1 and "hashpartitioning" not in plan


def test_large_index_is_shuffled_and_gives_the_same(spark, monkeypatch):
    rng = random.Random(10)
    spots = [(i, rng.uniform(10, 12), rng.uniform(20, 22), f"N{i % 40}") for i in range(120)]
    points = [(rng.uniform(9, 13), rng.uniform(19, 23)) for _ in range(300)] + [(None, 1.0)]
    small = countries(spark, spots, points)
    monkeypatch.setattr(joins, "broadcast_limit", lambda df: 0)
    assert countries(spark, spots, points) == small == [*(brute_force(*point, spots) for point in points[:-1]), "Unknown"]


def test_multiplied_candidates_are_never_sent_to_the_driver(spark, monkeypatch):
    """A cell's split multiplies rows that the optimizer takes for few; only the winners of few cells may be broadcast."""
    rng = random.Random(11)
    spots = [(i, rng.uniform(-80, 80), rng.uniform(-180, 180), f"N{i % 40}") for i in range(300)]
    built = []
    kept = p._pruned

    def watched(pairs, cells):
        made = kept(pairs, cells)
        built.append((cells, made._jdf.queryExecution().executedPlan().toString()))
        return made

    monkeypatch.setattr(p, "_pruned", watched)
    monkeypatch.setattr(p, "BROADCAST_CELLS", 32)
    points = [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(300)]
    assert countries(spark, spots, points) == [brute_force(*point, spots) for point in points]
    assert built[0][0] == 32 and "BuildRight" in built[0][1] and len(built) > 1
    assert all("SortMergeJoin" in plan and "BroadcastHashJoin" not in plan for _, plan in built[1:])


def test_no_places(spark):
    assert countries(spark, [(1, None, None, "A")], [(0.0, 0.0), (None, 1.0)]) == ["Unknown", "Unknown"]


def test_places_close_together(spark):
    spots = [(i, 10.0 + i * 1e-9, 20.0, f"N{i}") for i in range(12)]
    assert countries(spark, spots, [(9.0, 20.0), (11.0, 20.0)]) == ["N0", "N11"]


def test_date_line(spark):
    assert countries(spark, [(1, 0.0, -179.9, "FJ"), (2, 0.0, 178.0, "NZ")], [(0.0, 179.9)]) == ["FJ"]


def test_unusable_coordinates(spark):
    points = [(None, 1.0), (1.0, None), (math.nan, 1.0), (1.0, math.nan), (math.inf, 1.0), (1.0, -math.inf), (1.0, 1.0)]
    assert countries(spark, [(1, 0.0, 0.0, None)], points) == ["Unknown"] * 7


def test_equal_distance_takes_the_smaller_id(spark):
    assert countries(spark, [(2, 0.0, 1.0, "B"), (1, 0.0, -1.0, "A")], [(0.0, 0.0)]) == ["A"]


def airports(spark):
    return spark.createDataFrame([(1, "A000", "NA", "Country 0"), (2, "A000", "NB", "Country 1")], "id INT, icao_code STRING, country_iso2 STRING, country_name STRING")


def test_airport_country(spark):
    df = spark.createDataFrame([(None,), ("xxxx",), ("a000",)], "code STRING")
    assert [r.country_code for r in p.country_from_airport(df, "code", airports(spark)).collect()] == ["Unknown Code", "Unknown Code", "NA"]


def test_country_name(spark):
    df = spark.createDataFrame([("NB",), ("ZZ",), (None,)], "code STRING")
    assert [r.country_name for r in p.country_name(df, "code", airports(spark)).collect()] == ["Country 1", "Unknown", "Unknown"]


def test_large_lookup_is_split_and_gives_the_same(spark, rows):
    facts = spark.range(1000).select(F.when(F.col("id") % 3 == 0, "HOT").when(F.col("id") % 3 == 1, F.concat(F.lit("K"), F.col("id") % 50)).alias("k"), "id")
    table = spark.range(60).select(F.when(F.col("id") == 0, "HOT").otherwise(F.concat(F.lit("K"), "id")).alias("lookup_key"), F.col("id").alias("v"))
    small = joins.lookup_join(facts, F.col("k"), table, {"v": "v"})
    large = joins.lookup_join(facts, F.col("k"), table, {"v": "v"}, max_bytes=0)
    assert "_part" in large._jdf.queryExecution().toString()
    assert rows(small) == rows(large) and small.count() == 1000
