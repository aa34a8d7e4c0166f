"""Pixel to projected to geographic coordinates: affine transforms and the transverse Mercator zones of WGS 84."""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# The ellipsoid, and the constants of UTM.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257223563
SCALE, FALSE_EAST, FALSE_NORTH = 0.9996, 500000.0, 10000000.0


def projected(x: Column, y: Column, transform: list[float]) -> tuple[Column, Column]:
    """Easting and northing of a pixel's corner; the rotation terms of the transform are not applied."""
    left, width, _, top, _, height = transform
    return F.lit(left) + x * width, F.lit(top) + y * height


def utm_zone(wkt: str) -> tuple[int, bool] | None:
    """(zone, north) of a projection's WKT, None for a geographic one; others are errors."""
    if m := re.search(r"UTM zone (\d{1,2})\s*([NS])", wkt, re.I):
        return int(m[1]), m[2].upper() == "N"
    if wkt.lstrip().upper().startswith("GEOGCS"):
        return None
    raise ValueError("only geographic and UTM coordinates are known")


def from_utm(east, north, zone: int, northern: bool = True, f=F):
    """(lon, lat) in degrees, by the closed series to the sixth order: exact to millimetres within a zone. Of columns, or of numbers
    and arrays with f=numpy."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    e1 = (1 - math.sqrt(1 - e2)) / (1 + math.sqrt(1 - e2))
    m = (north - (0.0 if northern else FALSE_NORTH)) / SCALE
    mu = m / (SEMI_MAJOR * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    foot = (
        mu + (3 * e1 / 2 - 27 * e1**3 / 32) * f.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * f.sin(4 * mu)
        + 151 * e1**3 / 96 * f.sin(6 * mu) + 1097 * e1**4 / 512 * f.sin(8 * mu)
    )
    sin, cos, tan = f.sin(foot), f.cos(foot), f.tan(foot)
    c, t = ep2 * cos * cos, tan * tan
    root = f.sqrt(1 - e2 * sin * sin)
    n, r = SEMI_MAJOR / root, SEMI_MAJOR * (1 - e2) / (root * root * root)
    d = (east - FALSE_EAST) / (n * SCALE)
    d2 = d * d
    lat = foot - n * tan / r * (
        d2 / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * ep2) * d2 * d2 / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * ep2 - 3 * c * c) * d2 * d2 * d2 / 720
    )
    lon = (d - (1 + 2 * t + c) * d2 * d / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * ep2 + 24 * t * t) * d2 * d2 * d / 120) / cos
    return f.degrees(lon) + (zone * 6 - 183.0), f.degrees(lat)


def to_utm(lon: np.ndarray, lat: np.ndarray, zone: int, northern: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(easting, northing) of degrees, the way back from from_utm."""
    e2 = FLATTENING * (2 - FLATTENING)
    ep2 = e2 / (1 - e2)
    phi = np.radians(lat)
    sin, cos, tan = np.sin(phi), np.cos(phi), np.tan(phi)
    n = SEMI_MAJOR / np.sqrt(1 - e2 * sin * sin)
    t, c = tan * tan, ep2 * cos * cos
    a = np.radians((lon - (zone * 6 - 183.0) + 540.0) % 360.0 - 180.0) * cos
    arc = (
        (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * np.sin(2 * phi)
        + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * np.sin(4 * phi) - 35 * e2**3 / 3072 * np.sin(6 * phi)
    )
    east = SCALE * n * (a + (1 - t + c) * a**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * a**5 / 120)
    north = SCALE * (SEMI_MAJOR * arc + n * tan * (a * a / 2 + (5 - t + 9 * c + 4 * c * c) * a**4 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * a**6 / 720))
    return east + FALSE_EAST, north + (0.0 if northern else FALSE_NORTH)
