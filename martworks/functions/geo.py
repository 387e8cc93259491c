"""Great-circle distance and nearest-place search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martworks.operators.joins import growing
from martworks.session import reliable

EARTH_KM = 6371.0
# Up to this many places the search is one expression over literals.
INLINE_PLACES = 64
# Edge lengths (in earth radii) of the search cells. With the last one every
# place of the globe lies in the neighbourhood of every point.
CELL_EDGES = (0.01, 0.05, 0.25, 1.25)
# A place list held in one row has about this many places at most.
LIST_PLACES = 20_000
# Dense places are searched in smaller cells first, with about this many places at most on average, …
PLACES_PER_CELL = 4
# … of an edge halved so often at most (some 6 m), each level larger than the one before by a factor.
_HALVINGS, _GROWTH = 14, 5


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in km between two points given in degrees."""
    dlat = (F.radians(lat2) - F.radians(lat1)) / 2
    dlon = (F.radians(lon2) - F.radians(lon1)) / 2
    h = F.sin(dlat) * F.sin(dlat) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.sin(dlon) * F.sin(dlon)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.when(h > 1, F.lit(1.0)).otherwise(h)))


def unit_vector(lat: Column, lon: Column) -> dict[str, Column]:
    """The point on the unit sphere."""
    la, lo = F.radians(lat), F.radians(lon)
    return {"x": F.cos(la) * F.cos(lo), "y": F.cos(la) * F.sin(lo), "z": F.sin(la)}


def _chord2(ax, ay, az, bx, by, bz) -> Column:
    return (ax - bx) * (ax - bx) + (ay - by) * (ay - by) + (az - bz) * (az - bz)


def _chord2_km(chord2: Column) -> Column:
    half = F.sqrt(chord2) / 2
    return 2 * EARTH_KM * F.asin(F.when(half > 1, F.lit(1.0)).otherwise(half))


def nearest_place(
    points: DataFrame,
    places: DataFrame,
    lat: str = "lat",
    lon: str = "lon",
    inline_limit: int = INLINE_PLACES,
) -> DataFrame:
    """Adds place_id, place and km of the nearest place to every located point.

    `places` has place_id, place, lat, lon. Points without coordinates are
    left out. Ties go to the smaller place_id. No point row is multiplied or
    shuffled for a short list: the list, whose size is checked here, turns into
    literals. A longer list goes through cell lookups (`_nearest_by_cells`).
    """
    located = places.where("lat is not null and lon is not null").select("place_id", "place", "lat", "lon")
    head = located.limit(inline_limit + 1).collect()
    pts = points.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
    if len(head) <= inline_limit:
        return _nearest_inline(pts, located, head, lat, lon)
    return _nearest_by_cells(pts, located, lat, lon)


def _with_vector(df: DataFrame, lat: str, lon: str) -> DataFrame:
    v = unit_vector(F.col(lat), F.col(lon))
    return df.withColumns({"_x": v["x"], "_y": v["y"], "_z": v["z"]})


def _nearest_inline(pts: DataFrame, located: DataFrame, rows: list, lat: str, lon: str) -> DataFrame:
    """The place with the shortest chord, as in `_nearest_by_cells`: the rows do not depend on the length of the list.

    The squared chords form one primitive array per row, in one generated stage.
    The vector and the array are helper columns because both are used several times.
    """
    id_type = located.schema["place_id"].dataType
    ordered = sorted(rows, key=lambda r: r.place_id)
    if not ordered:
        return pts.select("*", F.lit(None).cast(id_type).alias("place_id"),
                          F.lit(None).cast("string").alias("place"), F.lit(None).cast("double").alias("km"))
    chords = []
    for row in ordered:
        v = unit_vector(F.lit(row.lat), F.lit(row.lon))
        chords.append(_chord2(F.col("_x"), F.col("_y"), F.col("_z"), v["x"], v["y"], v["z"]))
    # the first position wins, and the places are in id order
    at = (F.array_position("_near", F.array_min("_near")) - 1).cast("int")
    list_of = lambda field: F.array(*[F.lit(r[field]) for r in ordered])
    # a value is always there; saying so keeps a later join from testing the whole search for null in its filter
    pick = lambda field: F.coalesce(F.get(list_of(field), F.col("_at")), F.lit(ordered[0][field]))
    return _with_vector(pts, lat, lon).withColumn("_near", F.array(*chords)).withColumn("_at", at).select(
        *pts.columns, pick("place_id").cast(id_type).alias("place_id"), pick("place").alias("place"),
        _chord2_km(F.array_min("_near")).alias("km"))


def _cell(axis: Column, edge: float) -> Column:
    return F.floor(axis / edge)


def _finest_edge(vec: DataFrame, count: int) -> float:
    """The largest edge below the coarser ones at which an occupied cube holds a few places on average."""
    ladder = [CELL_EDGES[0] / 2**i for i in range(_HALVINGS)]
    cubes = vec.agg(*[F.approx_count_distinct(F.struct(*[_cell(F.col(f"_{a}"), e) for a in "xyz"])).alias(f"e{i}")
                      for i, e in enumerate(ladder)]).first()
    return next((e for e, n in zip(ladder, cubes) if count <= PLACES_PER_CELL * n), ladder[-1])


def _nearest_by_cells(pts: DataFrame, located: DataFrame, lat: str, lon: str) -> DataFrame:
    """Exact search over cubes of the unit sphere, smallest edge first.

    The smallest edge follows from how dense the places are: an occupied cube holds a
    few. The places of a cube and its 26 neighbours form one list row, which is
    equi-joined to the point's cube. A hit closer than one edge is final, since
    every place that near lies in the neighbourhood; the other points alone go on to
    the next, larger edge, and lists are made only for their cubes. Every level is a
    written table, so one join runs at a time. Of places at one spot the smallest
    id stays. Where a list would still be very long, places are cut into blocks by
    hash, one join per block, which bounds the length of a list row.
    """
    best_type = f"struct<d:double,place_id:{located.schema['place_id'].dataType.simpleString()},place:string>"
    vec = reliable(_with_vector(located, "lat", "lon").groupBy("_x", "_y", "_z").agg(
        F.min(F.struct("place_id", "place")).alias("_p")).select("_x", "_y", "_z", "_p.place_id", "_p.place"))
    count = vec.count()
    fine = _finest_edge(vec, count) if count else CELL_EDGES[0]
    edges = [fine]
    while edges[-1] * _GROWTH < CELL_EDGES[0]:
        edges.append(edges[-1] * _GROWTH)
    edges += [e for e in CELL_EDGES if e > fine]
    rest = _with_vector(pts, lat, lon).withColumn("_best", F.lit(None).cast(best_type))
    done = None
    for i, edge in enumerate(edges):
        out = rest.withColumns({f"_c{axis}": _cell(F.col(f"_{axis}"), edge) for axis in "xyz"})
        by_cell = vec
        for axis in "xyz":
            cell = _cell(F.col(f"_{axis}"), edge)
            by_cell = by_cell.withColumn(f"_c{axis}", F.explode(F.array(cell - 1, cell, cell + 1)))
        cube = ["_cx", "_cy", "_cz"]
        by_cell = reliable(by_cell.join(out.select(*cube).distinct(), cube, "left_semi"))
        longest = by_cell.groupBy(*cube).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        blocks = max(1, -(-longest // LIST_PLACES))
        for block in range(blocks):
            part = by_cell if blocks == 1 else by_cell.where(F.pmod(F.xxhash64("place_id"), F.lit(blocks)) == block)
            lists = part.groupBy(*cube).agg(F.collect_list(F.struct("_x", "_y", "_z", "place_id", "place")).alias("_near"))
            near = F.array_min(F.transform("_near", lambda p: F.struct(
                _chord2(F.col("_x"), F.col("_y"), F.col("_z"), p["_x"], p["_y"], p["_z"]).alias("d"),
                p["place_id"].alias("place_id"), p["place"].alias("place"))))
            # least skips nulls, so a cube without places keeps what was found
            out = out.join(growing(lists), cube, "left").withColumn("_best", F.least(near, "_best")).drop("_near")
            if blocks > 1:
                out = reliable(out)
        out = reliable(out.drop(*cube))
        final = F.lit(True) if i == len(edges) - 1 else F.coalesce(F.col("_best.d") <= F.lit(edge * edge), F.lit(False))
        settled = out.where(final)
        done = settled if done is None else done.unionByName(settled)
        rest = out.where(~final)
        if rest.isEmpty():
            break
    return done.select(*pts.columns, "_best.place_id", "_best.place", _chord2_km(F.col("_best.d")).alias("km"))


def metre_cell(lat: Column, lon: Column, km: float) -> dict[str, Column]:
    """3-D cell of edge `km` (as chord on the unit sphere) of a point.

    Two points at most `km` apart lie in the same or in touching cells, at any
    latitude and across the date line.
    """
    edge = km / EARTH_KM
    v = unit_vector(lat, lon)
    return {axis: _cell(v[axis], edge) for axis in ("x", "y", "z")}
