"""Distances in metres, as SQL text and as Columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

# Mean earth radius and the WGS-84 ellipsoid.
EARTH_RADIUS_M = 6_371_000.0
WGS84_MAJOR_M = 6_378_137.0
WGS84_FLATTENING = 1 / 298.257223563
WGS84_ECC2 = WGS84_FLATTENING * (2 - WGS84_FLATTENING)

# One degree of latitude is nowhere shorter than this on either model.
MIN_DEGREE_M = 110_500.0


@dataclass(frozen=True)
class Metric:
    """A distance, and coordinates in space whose straight lines rank positions like it.

    Both are SQL over the SQL of latitudes and longitudes in degrees. Over the spans
    between a bus and its stops the ranks agree to well below a millimetre.
    """

    distance: Callable[[str, str, str, str], str]
    place: Callable[[str, str], tuple[str, str, str]]


def _haversine(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    chord = (f"pow(sin(radians({lat_b} - {lat_a}) / 2), 2) + cos(radians({lat_a})) "
             f"* cos(radians({lat_b})) * pow(sin(radians({lon_b} - {lon_a}) / 2), 2)")
    return f"({2 * EARTH_RADIUS_M}D * asin(sqrt({chord})))"


def _geodistance(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> str:
    mid = f"radians(({lat_a} + {lat_b}) / 2)"
    w = f"(1 - {WGS84_ECC2!r}D * pow(sin({mid}), 2))"
    north = f"{1 - WGS84_ECC2!r}D / {w} * radians({lat_b} - {lat_a})"
    # the short way around the globe
    turn = f"(pmod({lon_b} - {lon_a} + 180D, 360D) - 180D)"
    east = f"cos({mid}) * radians({turn})"
    return f"({WGS84_MAJOR_M}D * sqrt((pow({north}, 2) + pow({east}, 2)) / {w}))"


def _place(radius_m: float, ecc2: float) -> Callable[[str, str], tuple[str, str, str]]:
    def place(lat: str, lon: str) -> tuple[str, str, str]:
        normal = f"{radius_m}D / sqrt(1 - {ecc2!r}D * pow(sin(radians({lat})), 2))"
        flat = f"{normal} * cos(radians({lat}))"
        return (f"{flat} * cos(radians({lon}))", f"{flat} * sin(radians({lon}))",
                f"{normal} * {1 - ecc2!r}D * sin(radians({lat}))")
    return place


# Great-circle distance on a sphere.
HAVERSINE = Metric(_haversine, _place(EARTH_RADIUS_M, 0.0))

# Ellipsoidal distance from the radii of curvature at the middle latitude. Within a city
# this is within millimetres of the geodesic.
GEODISTANCE = Metric(_geodistance, _place(WGS84_MAJOR_M, WGS84_ECC2))


def haversine_m(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> Column:
    return F.expr(HAVERSINE.distance(lat_a, lon_a, lat_b, lon_b))


def geodistance_m(lat_a: str, lon_a: str, lat_b: str, lon_b: str) -> Column:
    return F.expr(GEODISTANCE.distance(lat_a, lon_a, lat_b, lon_b))
