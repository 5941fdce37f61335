"""Countries of airports and of positions."""

from __future__ import annotations

import hashlib
import math
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyflow.functions.geo import (
    grid_column,
    grid_row,
    interleaved,
    is_position,
    squared_chord,
    unit_vector,
)
from skyflow.plans import joins, staging
from skyflow.plans.joins import lookup_join, unique_lookup
from skyflow.plans.staging import staged

UNKNOWN_AIRPORT = "Unknown Code"
UNKNOWN = "Unknown"

# Cells of the place search in degrees, from coarse to fine. Each is a quarter of the one before, and
# all are exact in binary, so a cell always lies inside one cell of the coarser grid.
COARSEST = 45.0
FACTOR = 4
#: A cell with more candidates of different countries is split, until it measures a few metres.
MOST_CANDIDATES = 8
FINEST_LEVEL = 10
FINEST = COARSEST / FACTOR**FINEST_LEVEL
#: Splits of a cell without places that may leave it more than this share of its candidates.
MOST_STALLED, STALLED_SHARE = 3, 0.75
#: Candidates up to which such a cell is done; with more it is split as often again.
STALLED_CANDIDATES = 64
#: Room for rounding when a place is compared with a nearer one, in squared chords.
SLACK = 1e-14
#: Levels of the cells whose numbers are keys, and leaves up to which a key is not cut further.
KEY_LEVELS = (2, 4, 6, 8)
LEAVES_PER_KEY = 64
#: Cells up to which their nearest places are sent to every executor; with more they are joined by a shuffle.
BROADCAST_CELLS = 8192
#: Stored size up to which an index is sent to every executor. Its nested rows take about ten times as much on the driver.
INDEX_BYTES = 16 * 1024 * 1024
#: Copies of a larger index, over which the positions of a key are split.
INDEX_SPREAD = 8
#: Part of a lookup key for each level; above every cell number.
KEY_STEP = 1 << 50


def country_from_airport(df: DataFrame, column: str, airports: DataFrame, order: str = "id") -> DataFrame:
    """``country_code`` of the airport in ``column``; unknown or missing codes give ``Unknown Code``.

    ``airports`` has ``icao_code`` and ``country_iso2``; of rows that share a code the one
    with the smallest ``order`` counts.
    """
    lookup = unique_lookup(airports, F.upper("icao_code"), ["country_iso2"], order)
    found = lookup_join(df, F.upper(F.col(column)), lookup, {"country_iso2": "country_code"})
    return found.withColumn("country_code", F.coalesce("country_code", F.lit(UNKNOWN_AIRPORT)))


def country_name(df: DataFrame, code: str, airports: DataFrame) -> DataFrame:
    """``country_name`` of an ISO-2 code in ``code``; a miss gives ``Unknown``."""
    lookup = unique_lookup(airports, F.col("country_iso2"), ["country_name"], "country_name")
    found = lookup_join(df, F.col(code), lookup, {"country_name": "country_name"})
    return found.withColumn("country_name", F.coalesce("country_name", F.lit(UNKNOWN)))


def _vector(prefix: str) -> tuple:
    return tuple(F.col(f"{prefix}{axis}") for axis in "xyz")


def _with_vector(df: DataFrame, lat, lon, prefix: str) -> DataFrame:
    return df.withColumns({f"{prefix}{axis}": value for axis, value in zip("xyz", unit_vector(lat, lon))})


def _key(code, level: int):
    """Lookup key of a finest cell: the number of the cell of ``level`` around it, told apart from other levels."""
    return F.shiftright(code, 4 * (FINEST_LEVEL - level)) + F.lit(level * KEY_STEP).cast("long")


def distinct_places(places: DataFrame) -> DataFrame:
    """Places with usable coordinates and their unit vectors, of each position the smallest ``id``.

    ``places`` has ``id, lat, lon, country``.
    """
    known = places.filter(is_position(F.col("lat"), F.col("lon")))
    spots = known.groupBy("lat", "lon").agg(F.min_by(F.struct("id", "country"), "id").alias("s"))
    return _with_vector(spots.select("lat", "lon", "s.*"), F.col("lat"), F.col("lon"), "v")


def _winners(pairs: DataFrame) -> DataFrame:
    """Per cell its bounds and the places nearest to its middle, corners and edges.

    The size of the cells is a column, so the code made for one level serves all.
    """
    bounds = {
        "south": F.radians(F.col("row") * F.col("size") - 90),
        "north": F.radians((F.col("row") + 1) * F.col("size") - 90),
        "west": F.radians(F.col("column") * F.col("size") - 180),
        "east": F.radians((F.col("column") + 1) * F.col("size") - 180),
    }
    cells = pairs.withColumns(bounds)
    lats = [F.col("south"), (F.col("south") + F.col("north")) / 2, F.col("north")]
    lons = [F.col("west"), (F.col("west") + F.col("east")) / 2, F.col("east")]
    place = F.struct("id", "px", "py", "pz")
    # The place whose direction is closest to a point's has the largest product with it.
    nearest = [
        F.max_by(place, F.cos(lat) * (F.cos(lon) * F.col("px") + F.sin(lon) * F.col("py")) + F.sin(lat) * F.col("pz"))
        for lat in lats
        for lon in lons
    ]
    first = [F.first(name).alias(name) for name in bounds]
    return cells.groupBy("row", "column").agg(F.array_distinct(F.array(*nearest)).alias("winners"), *first)


def _everywhere_nearer(winner):
    """Whether every point of the cell is nearer to ``winner`` than to the place of the row.

    That is the case if the product of the point with the difference ``d`` of the two vectors is
    positive. Along a parallel the product is least at an end, or opposite to the direction of
    ``d`` if that meridian crosses the cell; along a meridian of a cell it is least at an end.
    """
    dx, dy, dz = (winner[f"p{axis}"] - F.col(f"p{axis}") for axis in "xyz")
    towards, length = F.atan2(dy, dx), F.sqrt(dx * dx + dy * dy)
    turn = F.lit(2 * math.pi)
    away = F.pmod(towards + F.lit(math.pi) - F.col("west"), turn) <= F.col("east") - F.col("west")
    ends = F.least(F.cos(F.col("west") - towards), F.cos(F.col("east") - towards))
    least = F.when(away, F.lit(-1.0)).otherwise(ends) * length
    side = lambda lat: F.cos(lat) * least + F.sin(lat) * dz
    return (side(F.col("south")) > SLACK) & (side(F.col("north")) > SLACK)


def _pruned(pairs: DataFrame, cells: int) -> DataFrame:
    """Candidates of so many ``cells`` without those that one of the cell's winners beats everywhere in the cell.

    The join is named because the optimizer does not count the rows a cell's split makes and would send them all to the
    driver. The winners of few cells are sent to every executor, so that of the many candidates such cells have, only those
    that are left are shuffled.
    """
    bounded = pairs.join(_winners(pairs).hint("broadcast" if cells <= BROADCAST_CELLS else "merge"), ["row", "column"])
    return bounded.filter(~F.exists("winners", _everywhere_nearer)).select(*pairs.columns)


@dataclass(frozen=True)
class PlaceIndex:
    """A linear quadtree: leaves as ranges of finest cells in the order of a space-filling curve.

    ``table`` has a row per leaf and key: ``lookup_key``, the range ``first`` to ``last`` of numbers of finest cells, and
    ``candidates``, an array of ``id, x, y, z, country`` with the places that are nearest to some point of
    the leaf. A leaf whose candidates share a country keeps one of them. A position has one number and one key, and is in one
    leaf of that key. Keys are cells of the first of ``KEY_LEVELS``; those with more than ``LEAVES_PER_KEY`` leaves are
    in ``crowded`` (level, lookup_key) and cut into cells of the next. ``levels`` are the levels in ``crowded``.
    """

    table: DataFrame
    crowded: DataFrame
    levels: tuple[int, ...]


def place_leaves(spots: DataFrame, scratch: str, most: int = MOST_CANDIDATES) -> DataFrame:
    """Leaves (first, last, candidates) of the places from ``distinct_places``; the steps are written below ``scratch``.

    The search starts with all places as candidates of a few coarse cells. In every cell it drops
    the places that cannot be nearest anywhere in the cell, however far away and however close
    together they are. A cell that still has more than ``most`` candidates of different countries
    is split, and its candidates go on to the finer cells; others are done. So dense regions get
    small cells, empty ones keep large ones, and no cell keeps all places. A cell without a place inside that
    ``MOST_STALLED`` splits rid of few candidates is done with up to ``STALLED_CANDIDATES`` too: it lies on the border of
    places so close together that finer cells far from them would not tell them apart. Twice as many splits end
    the search whatever is left, as among places closer together than rounding can tell.
    """
    vector = [F.col(f"v{axis}").alias(f"p{axis}") for axis in "xyz"]
    place = ["id", "country", "lat", "lon", "px", "py", "pz"]
    rows, columns = int(180 / COARSEST), int(360 / COARSEST)
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    tasks, cells = spots.sparkSession.sparkContext.defaultParallelism, rows * columns
    # Few rows, much work for each: without the repartitions a small file would be one task. They come before the rows are multiplied.
    first = spots.select("id", "country", "lat", "lon", *vector).repartition(tasks).withColumn("row", numbers(rows))
    first = first.withColumn("column", numbers(columns)).withColumns(
        {
            "level": F.lit(0),
            "size": F.lit(COARSEST),
            "before": F.lit(None).cast("long"),
            "stalled": F.lit(0),
        }
    )
    pairs, levels = first.select("level", "size", "row", "column", "before", "stalled", *place), []
    own_row = F.least(F.floor((F.col("lat") + 90) / F.col("size")), F.floor(180 / F.col("size")) - 1)
    own_column = F.pmod(F.floor((F.col("lon") + 180) / F.col("size")), F.floor(360 / F.col("size")))
    inside = (own_row == F.col("row")) & (own_column == F.col("column"))
    # A cell's candidates lie together after the pruning; beyond memory a window keeps them on disk.
    cell = Window.partitionBy("row", "column")
    counts = {
        "n": F.count("*").over(cell),
        "places_inside": F.count_if(inside).over(cell),
        "single": F.coalesce(
            (F.min("country").over(cell) == F.max("country").over(cell)) & (F.count_if(F.col("country").isNull()).over(cell) == 0),
            F.lit(False),
        ),
    }
    much_left = F.coalesce(F.col("n") > F.col("before") * STALLED_SHARE, F.lit(False))
    stalled = F.when(much_left & (F.col("places_inside") == 0), F.col("stalled") + 1).otherwise(0)
    ends = (F.col("stalled") >= MOST_STALLED) & (F.col("n") <= STALLED_CANDIDATES)
    ends = ends | (F.col("stalled") >= 2 * MOST_STALLED) | (F.col("level") == FINEST_LEVEL)
    done = F.col("single") | (F.col("n") <= F.lit(most)) | ends
    while True:
        judged = _pruned(pairs, cells).withColumns(counts).withColumn("stalled", stalled).withColumn("done", done)
        kept = staged(judged, "places", f"{scratch}/level-{len(levels)}")
        levels.append(kept.filter("done"))
        split = kept.filter("NOT done").repartition(tasks).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(FACTOR * FACTOR - 1))))
        cells = kept.filter("NOT done").select("row", "column").distinct().count() * FACTOR * FACTOR
        if cells == 0:
            break
        pairs = split.select(
            (F.col("level") + 1).alias("level"),
            (F.col("size") / FACTOR).alias("size"),
            (F.col("row") * FACTOR + F.floor(F.col("part") / FACTOR)).alias("row"),
            (F.col("column") * FACTOR + F.col("part") % FACTOR).alias("column"),
            F.col("n").alias("before"),
            "stalled",
            *place,
        )
    # Finest cells along a side of the cell.
    side = (F.col("size") / F.lit(FINEST)).cast("long")
    number = interleaved(F.col("row") * side, F.col("column") * side)
    ended = reduce(DataFrame.union, levels).withColumns({"first": number, "last": number + side * side - 1})
    entry = F.struct("id", *[F.col(f"p{axis}").alias(axis) for axis in "xyz"], "country")
    one = ended.filter("single").groupBy("first", "last").agg(F.array(F.min_by(entry, "id")).alias("candidates"))
    several = ended.filter("NOT single").groupBy("first", "last").agg(F.collect_list(entry).alias("candidates"))
    return one.union(several)


def _keyed(leaves: DataFrame, level: int) -> DataFrame:
    """A row for every leaf and key of ``level`` that overlap; the leaf's range is cut to the key's."""
    width = 1 << (4 * (FINEST_LEVEL - level))
    cell = lambda place: F.shiftright(place, 4 * (FINEST_LEVEL - level))
    rows = leaves.withColumn("_cell", F.explode(F.sequence(cell("first"), cell("last"))))
    return rows.select(
        (F.col("_cell") + F.lit(level * KEY_STEP).cast("long")).alias("lookup_key"),
        F.greatest("first", F.col("_cell") * width).alias("first"),
        F.least("last", (F.col("_cell") + 1) * width - 1).alias("last"),
        "candidates",
    )


def _write_index(spots: DataFrame, folder: str) -> None:
    """Write the leaves of ``spots`` by key, and the keys that are cut further, below ``folder``."""
    spark, tables, crowded = spots.sparkSession, [], []
    scratch = staging.new_folder(spark, "places")
    left = place_leaves(spots, scratch)
    for level, finer in zip(KEY_LEVELS, [*KEY_LEVELS[1:], None]):
        keyed = staged(_keyed(left, level), "place-keys", f"{scratch}/keys-{level}")
        many = keyed.groupBy("lookup_key").count().filter(F.col("count") > LEAVES_PER_KEY)
        many = staged(many.select(F.lit(level).alias("level"), "lookup_key"), "place-crowded", f"{scratch}/crowded-{level}")
        if finer is None or many.isEmpty():
            tables.append(keyed)
            break
        tables.append(keyed.join(many, "lookup_key", "left_anti"))
        crowded.append(many)
        left = keyed.join(many.select("lookup_key"), "lookup_key", "left_semi")
    empty = spark.createDataFrame([], "level INT, lookup_key BIGINT")
    reduce(DataFrame.union, crowded, empty).coalesce(1).write.parquet(f"{folder}/crowded")
    # Written last: with its marker the index is complete.
    reduce(DataFrame.union, tables).write.parquet(f"{folder}/leaves")
    staging.remove(spark, scratch)


def build_place_index(places: DataFrame) -> PlaceIndex:
    """Index of ``places`` (``id, lat, lon, country``), stored in the shared folder.

    The folder is named after the content of the places, so the same places are indexed once, and every later call takes what
    is there. Calls that build the same index at the same time write to folders of their own, of which one is taken.
    """
    spark = places.sparkSession
    row = [F.col(name) for name in ("id", "lat", "lon", "country")]
    sums = [F.sum(F.xxhash64(*row, F.lit(seed)).cast("decimal(38,0)")) for seed in (1, 2)]
    content = places.agg(F.count("*"), *sums).first()
    settings = [KEY_LEVELS, LEAVES_PER_KEY, MOST_CANDIDATES, STALLED_CANDIDATES, MOST_STALLED, STALLED_SHARE]
    name = f"place-index-{hashlib.sha256(repr([tuple(content), settings]).encode()).hexdigest()[:32]}"
    folder = f"{staging.shared_folder(spark)}/{name}"
    done = staging.committed(spark, f"{folder}/*/leaves")
    if not done:
        _write_index(distinct_places(places), f"{folder}/{uuid.uuid4().hex}")
        done = staging.committed(spark, f"{folder}/*/leaves")
    path = sorted(done)[0][0].rsplit("/", 1)[0]
    crowded = spark.read.parquet(f"{path}/crowded")
    levels = sorted(r["level"] for r in crowded.select("level").distinct().collect())  # of KEY_LEVELS
    return PlaceIndex(spark.read.parquet(f"{path}/leaves"), crowded, tuple(levels))


def country_from_position(df: DataFrame, lat: str, lon: str, index: PlaceIndex) -> DataFrame:
    """``country_code`` of the place nearest to each position, ties to the smallest place id.

    Null, NaN or infinite coordinates give ``Unknown``, as does a place without a country.
    A position is looked up by one key, under which its finest cell lies in the range of one leaf, and compared with that
    leaf's few candidates. Rows are neither multiplied nor aggregated, so it is the same on a stream. Places that
    crowd together add a lookup for every level of keys that are cut further.
    """
    y, x = F.col(lat), F.col(lon)
    usable = is_position(y, x)
    number = F.when(usable, interleaved(grid_row(y, FINEST), grid_column(x, FINEST)))
    found = df.withColumn("_number", number).withColumn("_cell", _key(F.col("_number"), KEY_LEVELS[0]))
    for level in index.levels:
        cut = index.crowded.filter(F.col("level") == level)
        finer = _key(F.col("_number"), KEY_LEVELS[KEY_LEVELS.index(level) + 1])
        found = lookup_join(found, F.col("_cell"), cut, {"level": "_crowded"})
        found = found.withColumn("_cell", F.when(F.col("_crowded").isNull(), F.col("_cell")).otherwise(finer)).drop("_crowded")
    leaf = {"first": "_first", "last": "_last", "candidates": "_candidates"}
    within = F.col("_number").between(F.col("_first"), F.col("_last"))
    most = min(INDEX_BYTES, joins.broadcast_limit(index.table))
    found = lookup_join(found, F.col("_cell"), index.table, leaf, also=within, max_bytes=most, spread=INDEX_SPREAD)
    found = _with_vector(found, F.when(usable, y), F.when(usable, x), "_v")
    here = _vector("_v")
    nearest = F.array_min(
        F.transform(
            "_candidates",
            lambda c: F.struct(
                squared_chord(here, (c["x"], c["y"], c["z"])).alias("d"), c["id"].alias("id"), c["country"].alias("country")
            ),
        )
    )
    # Most cells have one candidate and need no distance.
    only = F.get("_candidates", F.lit(0))
    country = F.when(F.size("_candidates") == 1, only["country"]).otherwise(nearest["country"])
    return found.select(
        *[F.col(f"`{name}`") for name in df.columns],
        F.coalesce(country, F.lit(UNKNOWN)).alias("country_code"),
    )
