"""Stored geocodes, distances and proximity clusters."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldpan.functions.text import normalize_address, normalize_province
from goldpan.operators.dedup import keep_first
from goldpan.scratch import written

RADIUS_KM = 6371.0088


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * RADIUS_KM * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def valid_points(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Rows with both coordinates in range, and their point as text."""
    ok = df.filter(F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))
    return ok.withColumn("geometry", F.concat(F.lit("POINT("), F.col(lon), F.lit(" "), F.col(lat), F.lit(")")))


def apply_geocodes(df: DataFrame, geocodes: DataFrame, address: str, country: str | None = None) -> DataFrame:
    """Adds latitude, longitude, formatted_address, geocoded from stored answers; geocodes: address, country, latitude, longitude, formatted_address."""
    key = lambda a, c: F.lower(F.concat_ws(", ", F.nullif(normalize_address(a), F.lit("")), c))
    stored = keep_first(geocodes.withColumn("_g", key("address", F.col("country"))), ["_g"], [F.col("formatted_address")]).select("_g", "latitude", "longitude", "formatted_address")
    return df.withColumn("_a", key(address, F.col(country) if country else F.lit(None).cast("string"))).join(stored, F.col("_a") == F.col("_g"), "left").withColumn("geocoded", F.col("latitude").isNotNull()).drop("_a", "_g")


def province_of_coordinates(df: DataFrame, stored: DataFrame, digits: int = 3) -> DataFrame:
    """Adds province_inferred: state, else province, region or county of the stored answer for the rounded point."""
    name = F.coalesce("state", "province", "region", "county")
    one = stored.groupBy(F.round("latitude", digits).alias("_y"), F.round("longitude", digits).alias("_x")).agg(F.min(normalize_province(name)).alias("province_inferred"))
    return df.join(one, (F.round("latitude", digits) == F.col("_y")) & (F.round("longitude", digits) == F.col("_x")), "left").drop("_x", "_y")


def province_by_box(df: DataFrame, boxes: DataFrame, *, id_: str = "id", degrees: float = 1.0, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Adds ``box``: the name of the smallest box that holds the point, edges included, the first by name of equal ones; null where there is none.

    boxes: name, south, north, west, east; a box whose west is greater than its east crosses 180 degrees. A range join by cells: a
    box is stored in each cell of ``degrees`` that it touches, a point asks its own cell. A box that touches over a hundred
    cells is stored in cells ten times as wide, and so on, so the number of entries stays that of the boxes times a
    hundred, and a point asks one cell of each size that is in use.
    """
    split = boxes.withColumn("x", F.explode(F.when(F.col("west") <= F.col("east"), F.array(F.struct(F.col("west").alias("w"), F.col("east").alias("e")))).otherwise(
        F.array(F.struct(F.col("west").alias("w"), F.lit(180.0).alias("e")), F.struct(F.lit(-180.0).alias("w"), F.col("east").alias("e"))))))
    wide = F.when(F.col("west") <= F.col("east"), F.col("east") - F.col("west")).otherwise(F.col("east") - F.col("west") + 360)
    split = split.select("name", "south", "north", F.col("x.w").alias("w"), F.col("x.e").alias("e"), (wide * (F.col("north") - F.col("south"))).alias("area"))
    sizes = [degrees * 10**i for i in range(4)]
    cells = lambda size: (F.floor(F.col("north") / size) - F.floor(F.col("south") / size) + 1) * (F.floor(F.col("e") / size) - F.floor(F.col("w") / size) + 1)
    size = F.lit(sizes[-1])
    for s in reversed(sizes[:-1]):
        size = F.when(cells(s) <= 100, F.lit(s)).otherwise(size)
    whole = lambda c: F.floor(c).cast("int")
    stored = split.withColumn("size", size).withColumn("row", F.explode(F.sequence(whole(F.col("south") / F.col("size")), whole(F.col("north") / F.col("size")))))
    stored = stored.withColumn("cell", F.explode(F.sequence(whole(F.col("w") / F.col("size")), whole(F.col("e") / F.col("size")))))
    points = valid_points(df, lat, lon).select(F.col(id_).alias("_id"), F.col(lat).alias("y"), F.col(lon).alias("x")).withColumn("size", F.explode(F.array(*map(F.lit, sizes))))
    asked = points.withColumns({"row": whole(F.col("y") / F.col("size")), "cell": whole(F.col("x") / F.col("size"))})
    inside = asked.join(stored, ["size", "row", "cell"]).filter(F.col("y").between(F.col("south"), F.col("north")) & F.col("x").between(F.col("w"), F.col("e")))
    best = inside.groupBy("_id").agg(F.min(F.struct("area", "name"))["name"].alias("box"))
    return df.join(best, F.col(id_) == F.col("_id"), "left").drop("_id")


def pairs_within(df: DataFrame, km: float, *, id_: str = "id", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """l < r and km of all points within ``km`` of each other, by cells of a grid and their neighbours: no cross product.

    A cell is ``km`` high; its width in degrees is that of the row's end nearer to a pole. Cells wrap round at 180 degrees.
    """
    high = math.degrees(km / RADIUS_KM) * 1.000001
    rows = int(90 // high) + 1

    def cell_columns(row: Column) -> Column:  # cells round the globe in a row, at the latitude nearest to a pole of it and both neighbours
        edge = F.least(F.lit(90.0), (F.abs(row + 0.5) + 1.5) * high)
        width = F.greatest(F.cos(F.radians(edge)), F.lit(1e-9))
        return F.greatest(F.lit(1), F.floor(F.lit(360.0) * width / high)).cast("long")

    p = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(id_).alias("i"), F.col(lat).alias("y"), F.col(lon).alias("x")).withColumn("row", F.floor(F.col("y") / high))
    # Each point is stored once, in the grid of its own row, and asks the rows beside it in theirs.
    home = p.withColumn("n", cell_columns(F.col("row"))).withColumn("cell", F.pmod(F.floor((F.col("x") + 180) / 360 * F.col("n")), F.col("n")))
    ask = p.select("i", "y", "x", F.explode(F.array(F.col("row") - 1, F.col("row"), F.col("row") + 1)).alias("row")).filter(F.abs("row") <= rows + 1)
    ask = ask.withColumn("n", cell_columns(F.col("row"))).withColumn("c", F.floor((F.col("x") + 180) / 360 * F.col("n")))
    ask = ask.withColumn("cell", F.explode(F.array_distinct(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.pmod(F.col("c") + d, F.col("n"))))))
    left = ask.select(F.col("i").alias("l"), F.col("y").alias("ly"), F.col("x").alias("lx"), "row", "cell")
    right = home.select(F.col("i").alias("r"), F.col("y").alias("ry"), F.col("x").alias("rx"), "row", "cell")
    both = left.join(right, ["row", "cell"]).filter("l < r").withColumn("km", haversine_km(F.col("ly"), F.col("lx"), F.col("ry"), F.col("rx")))
    return both.filter(F.col("km") <= km).select("l", "r", "km")



def proximity_clusters(df: DataFrame, km: float = 50.0, *, id_: str = "id", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """id, leader: the lowest id not taken yet takes all that are free within ``km``; -1 without coordinates.

    A point is a leader if no smaller leader is near it, and belongs to the smallest leader near it. Rounds of joins settle this: a
    point without undecided smaller neighbours leads, and what is near a new leader doesn't. Each round is written to
    the shared folder; their number is that of the longest chain of ever larger neighbours that hang on each other.
    """
    edges = written(pairs_within(df, km, id_=id_, lat=lat, lon=lon).select("l", "r"), "near-pairs")
    undecided = written(edges.select(F.col("l").alias("i")).unionByName(edges.select(F.col("r").alias("i"))).distinct(), "undecided")
    leaders = None
    while not undecided.isEmpty():
        waiting = edges.join(undecided.select(F.col("i").alias("l")), "l", "left_semi").select(F.col("r").alias("i")).distinct()
        new = written(undecided.join(waiting, "i", "left_anti"), "leaders")
        taken = edges.join(new.select(F.col("i").alias("l")), "l", "left_semi").select(F.col("r").alias("i")).distinct()
        undecided = written(undecided.join(new, "i", "left_anti").join(taken, "i", "left_anti"), "undecided")
        leaders = new if leaders is None else leaders.unionByName(new)
    alone = F.when(F.col(lat).isNull() | F.col(lon).isNull(), F.lit(-1)).otherwise(F.col(id_))
    if leaders is None:
        return df.select(id_, alone.cast("long").alias("leader"))
    of = edges.join(leaders.select(F.col("i").alias("l")), "l", "left_semi").groupBy("r").agg(F.min("l").alias("m"))
    of = of.join(leaders.select(F.col("i").alias("r")), "r", "left_anti").select(F.col("r").alias("node"), "m")
    return df.join(of, F.col(id_) == F.col("node"), "left").select(id_, F.coalesce("m", alone).cast("long").alias("leader"))
