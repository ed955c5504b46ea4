"""Lengths of paths given in degrees, after projection to Lambert-93 (EPSG:2154)."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lengths are summed to the micrometre: finer digits are noise of the trigonometry.
METRES = "decimal(24,6)"


# Metres to six digits are exact in it.
KILOMETRES = "decimal(27,9)"

# Definition of EPSG:2154 (GRS 1980 ellipsoid, two standard parallels).
SEMI_MAJOR_AXIS = 6378137.0
INVERSE_FLATTENING = 298.257222101
PARALLEL_1, PARALLEL_2 = 44.0, 49.0
ORIGIN_LATITUDE, ORIGIN_LONGITUDE = 46.5, 3.0
FALSE_EASTING, FALSE_NORTHING = 700000.0, 6600000.0


def _cone() -> tuple[float, float, float, float]:
    """Eccentricity, cone constant, scale and origin radius of the projection."""
    flattening = 1 / INVERSE_FLATTENING
    ecc = math.sqrt(2 * flattening - flattening**2)

    def m(deg: float) -> float:
        phi = math.radians(deg)
        return math.cos(phi) / math.sqrt(1 - (ecc * math.sin(phi)) ** 2)

    def t(deg: float) -> float:
        phi = math.radians(deg)
        es = ecc * math.sin(phi)
        return math.tan(math.pi / 4 - phi / 2) / ((1 - es) / (1 + es)) ** (ecc / 2)

    n = math.log(m(PARALLEL_1) / m(PARALLEL_2)) / math.log(t(PARALLEL_1) / t(PARALLEL_2))
    scale = SEMI_MAJOR_AXIS * m(PARALLEL_1) / (n * t(PARALLEL_1) ** n)
    return ecc, n, scale, scale * t(ORIGIN_LATITUDE) ** n


def lambert93(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres of a longitude and latitude in degrees."""
    ecc, n, scale, origin = _cone()
    phi = F.radians(lat)
    es = F.lit(ecc) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - es) / (1 + es), F.lit(ecc / 2))
    rho = F.lit(scale) * F.pow(t, F.lit(n))
    theta = F.lit(n) * F.radians(lon - F.lit(ORIGIN_LONGITUDE))
    x = F.lit(FALSE_EASTING) + rho * F.sin(theta)
    y = F.lit(FALSE_NORTHING) + F.lit(origin) - rho * F.cos(theta)
    return x, y


def row_length(points: Column) -> Column:
    """Length in km of a path held in its row: an array of structs ``lon, lat``. No
    shuffle. As in ``path_lengths``, steps from or to an incomplete point are left out,
    and a path without any step has no length."""

    def projected(p: Column) -> Column:
        x, y = lambert93(p["lon"], p["lat"])
        return F.struct(x.alias("x"), y.alias("y"))

    def step(a: Column, b: Column) -> Column:
        dx, dy = b["x"] - a["x"], b["y"] - a["y"]
        return F.sqrt(dx * dx + dy * dy).cast(METRES)

    ends = F.transform(points, projected)
    count = F.greatest(F.size(ends) - 1, F.lit(0))
    steps = F.zip_with(F.slice(ends, 1, count), F.slice(ends, 2, count), step)
    none = F.lit(None).cast(METRES)
    metres = F.aggregate(steps, none, lambda s, m: F.coalesce((s + m).cast(METRES), s, m))
    return (metres / 1000).cast(KILOMETRES)


def path_lengths(
    vertices: DataFrame,
    *,
    path: Sequence[str],
    keep: Sequence[str] = (),
    seq: str = "seq",
    lon: str = "lon",
    lat: str = "lat",
    chunk: int = 4096,
) -> DataFrame:
    """Length in km of the stretches of each path, columns ``keep`` and ``distance_km``.

    ``vertices`` has one row per vertex; ``seq`` counts 0, 1, 2, ... along a path.
    A path is cut into stretches of ``chunk`` vertices that share their end vertex, so
    no task ever holds more than one stretch however long the path. The rows add up
    to the length of the path; sum them by any of the kept columns.
    """
    x, y = lambert93(F.col(lon), F.col(lat))
    number = F.floor(F.col(seq) / chunk)
    ends_previous = (F.col(seq) % chunk == 0) & (F.col(seq) > 0)
    stretches = F.when(ends_previous, F.array(number - 1, number)).otherwise(F.array(number))
    columns = list(dict.fromkeys([*path, *keep]))
    points = vertices.select(
        *columns, seq, x.alias("_x"), y.alias("_y"), F.explode(stretches).alias("_stretch")
    )
    along = Window.partitionBy(*path, "_stretch").orderBy(seq)
    dx, dy = F.lead("_x").over(along) - F.col("_x"), F.lead("_y").over(along) - F.col("_y")
    steps = points.select(*columns, "_stretch", F.sqrt(dx * dx + dy * dy).alias("_m"))
    metres = F.sum(F.col("_m").cast(METRES))
    groups = steps.groupBy(*columns, "_stretch")
    return groups.agg((metres / 1000).cast(KILOMETRES).alias("distance_km")).drop("_stretch")
