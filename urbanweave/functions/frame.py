"""UTM projection and extents as Column expressions (Krueger series of order four)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from urbanweave.functions import constants as K

_N = K.WGS84_F / (2.0 - K.WGS84_F)
_A = K.WGS84_A / (1.0 + _N) * (1.0 + _N**2 / 4.0 + _N**4 / 64.0)
_ECC = 2.0 * math.sqrt(_N) / (1.0 + _N)

# Series coefficients in the third flattening.
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def _c(v) -> Column:
    return v if isinstance(v, Column) else F.lit(float(v))


def _xy(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def utm_epsg(lon, lat) -> Column:
    zone = ((_c(lon) + 180.0) / 6.0).cast("int") + 1
    return F.when(_c(lat) < 0, 32700).otherwise(32600) + zone


def _zone_of(epsg) -> tuple[Column, Column]:
    """Central meridian in degrees and false northing of a zone code."""
    epsg = epsg if isinstance(epsg, Column) else F.lit(int(epsg))
    south = epsg > 32700
    zone = epsg - F.when(south, 32700).otherwise(32600)
    return zone * 6.0 - 183.0, F.when(south, K.UTM_FALSE_NORTH_SOUTH_M).otherwise(0.0)


def lonlat_to_utm(lon, lat, epsg) -> Column:
    """Struct of easting ``x`` and northing ``y``."""
    meridian, false_north = _zone_of(epsg)
    phi, lam = F.radians(_c(lat)), F.radians(_c(lon) - meridian)
    t = F.sinh(F.atanh(F.sin(phi)) - _ECC * F.atanh(_ECC * F.sin(phi)))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1.0 + t * t))
    east, north = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        north = north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        east = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    return _xy(K.UTM_FALSE_EAST_M + K.UTM_K0 * _A * east, false_north + K.UTM_K0 * _A * north)


def utm_to_lonlat(east, north, epsg) -> Column:
    """Struct of longitude ``x`` and latitude ``y`` in degrees."""
    meridian, false_north = _zone_of(epsg)
    xi = (_c(north) - false_north) / (K.UTM_K0 * _A)
    eta = (_c(east) - K.UTM_FALSE_EAST_M) / (K.UTM_K0 * _A)
    xi1, eta1 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        xi1 = xi1 - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        eta1 = eta1 - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(xi1) / F.cosh(eta1))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + d * F.sin(2 * j * chi)
    lon = meridian + F.degrees(F.atan2(F.sinh(eta1), F.cos(xi1)))
    return _xy(lon, F.degrees(phi))


def make_origin(lon, lat, height_m=0.0) -> Column:
    return F.struct(
        _c(lon).alias("lon"), _c(lat).alias("lat"), _c(height_m).alias("height_m"), utm_epsg(lon, lat).alias("epsg")
    )


def lonlat_to_local(lon, lat, origin: Column) -> Column:
    """Metres east and north of the origin."""
    here = lonlat_to_utm(lon, lat, origin["epsg"])
    base = lonlat_to_utm(origin["lon"], origin["lat"], origin["epsg"])
    return _xy(here["x"] - base["x"], here["y"] - base["y"])


def local_to_lonlat(x, y, origin: Column) -> Column:
    base = lonlat_to_utm(origin["lon"], origin["lat"], origin["epsg"])
    return utm_to_lonlat(base["x"] + _c(x), base["y"] + _c(y), origin["epsg"])


def _extremes(points: list[Column]) -> Column:
    xs, ys = [p["x"] for p in points], [p["y"] for p in points]
    return F.struct(
        F.least(*xs).alias("west"),
        F.least(*ys).alias("south"),
        F.greatest(*xs).alias("east"),
        F.greatest(*ys).alias("north"),
    )


def extent_from_bbox(west, south, east, north, origin: Column) -> Column:
    """Local extent that holds the four corners of a lon/lat box."""
    return _extremes([lonlat_to_local(lon, lat, origin) for lon in (west, east) for lat in (south, north)])


def raster_bounds_lonlat(left, bottom, right, top, epsg) -> Column:
    """Lon/lat box that holds the four corners of a UTM raster."""
    return _extremes([utm_to_lonlat(x, y, epsg) for x in (left, right) for y in (bottom, top)])


# ---- lon/lat boxes: structs of west, south, east, north


def box(west, south, east, north) -> Column:
    return F.struct(
        _c(west).alias("west"), _c(south).alias("south"), _c(east).alias("east"), _c(north).alias("north")
    )


def box_pad(b: Column, pad) -> Column:
    pad = F.greatest(_c(pad), F.lit(0.0))
    return box(b["west"] - pad, b["south"] - pad, b["east"] + pad, b["north"] + pad)


def box_intersection(a: Column, b: Column) -> Column:
    west, south = F.greatest(a["west"], b["west"]), F.greatest(a["south"], b["south"])
    east, north = F.least(a["east"], b["east"]), F.least(a["north"], b["north"])
    both = a.isNotNull() & b.isNotNull() & (east > west) & (north > south)
    return F.when(both, box(west, south, east, north))


def box_contains(a: Column, b: Column, tol: float = 1e-9) -> Column:
    return (
        (b["west"] >= a["west"] - tol)
        & (b["east"] <= a["east"] + tol)
        & (b["south"] >= a["south"] - tol)
        & (b["north"] <= a["north"] + tol)
    )


def box_area(b: Column) -> Column:
    return F.greatest(F.lit(0.0), b["east"] - b["west"]) * F.greatest(F.lit(0.0), b["north"] - b["south"])


def box_relation(a: Column, b: Column, tol: float = 0.001) -> Column:
    common = box_intersection(a, b)
    shared, area_a, area_b = box_area(common), box_area(a), box_area(b)
    near = (F.abs(shared - area_a) < tol * area_a) & (F.abs(shared - area_b) < tol * area_b)
    return (
        F.when(common.isNull() | (area_a <= 0) | (area_b <= 0), "disjoint")
        .when(near, "equal")
        .when(box_contains(a, b) | box_contains(b, a), "containment")
        .otherwise("partial_overlap")
    )


def box_relation_label(a: Column, b: Column) -> Column:
    """Relation of a map box to a terrain box, telling which one holds the other."""
    relation = box_relation(a, b)
    area_a, area_b = box_area(a), box_area(b)
    inside = F.when(area_a >= area_b, "osm_contains_grid").otherwise("grid_contains_osm")
    outside = F.when(area_b >= area_a, "grid_contains_osm").otherwise("osm_contains_grid")
    return (
        F.when(relation != "containment", relation)
        .when(box_contains(a, b), inside)
        .when(box_contains(b, a), outside)
        .otherwise("containment")
    )


# ---- raster frames


def odd_size(width, height, max_side: int) -> Column:
    """Pixel size with the long side fixed, the aspect kept and the short side odd."""
    wide = _c(width) >= _c(height)
    ratio = F.when(wide, _c(height) / _c(width)).otherwise(_c(width) / _c(height))
    short = F.greatest(F.lit(1), F.bround(ratio * max_side).cast("int"))
    odd = F.when(short % 2 == 1, short).when(short < max_side, short + 1).otherwise(F.greatest(F.lit(1), short - 1))
    return F.struct(
        F.when(wide, F.lit(max_side)).otherwise(odd).alias("nx"), F.when(wide, odd).otherwise(F.lit(max_side)).alias("ny")
    )


def metres_per_pixel(width, height, nx: Column, ny: Column) -> Column:
    return _xy(
        _c(width) / (F.greatest(nx, F.lit(2)) - 1), _c(height) / (F.greatest(ny, F.lit(2)) - 1)
    )


def to_cm(metres: Column) -> Column:
    return metres * 100.0


def yaw_to_quaternion(yaw: Column) -> Column:
    return F.struct(
        F.cos(yaw / 2).alias("w"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.sin(yaw / 2).alias("z")
    )
