"""Web-Mercator tiles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_LAT, TILE_SIZE, MAX_ZOOM = 85.05112878, 256, 22
DATA_ZOOM = 12


def _clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def tile_x(lon: Column, zoom: int) -> Column:
    size = float(TILE_SIZE << min(zoom, MAX_ZOOM))
    x = (_clip(lon, -180.0, 180.0) + 180.0) / 360.0
    return F.floor(F.floor(_clip(x * size + 0.5, 0.0, size - 1.0)) / TILE_SIZE).cast("int")


def tile_y(lat: Column, zoom: int) -> Column:
    size = float(TILE_SIZE << min(zoom, MAX_ZOOM))
    s = F.sin(_clip(lat, -MAX_LAT, MAX_LAT) * (3.141592653589793 / 180.0))
    y = F.lit(0.5) - F.log((F.lit(1.0) + s) / (F.lit(1.0) - s)) / (4.0 * 3.141592653589793)
    return F.floor(F.floor(_clip(y * size + 0.5, 0.0, size - 1.0)) / TILE_SIZE).cast("int")


def tile_id(lon: Column, lat: Column, zoom: int = DATA_ZOOM) -> Column:
    """Text z-x-y."""
    return F.concat_ws("-", F.lit(zoom), tile_x(lon, zoom), tile_y(lat, zoom))


def record_tiles(geometry: Column, zoom: int = DATA_ZOOM, last: bool = True) -> Column:
    """The distinct tiles of a polyline's first and, where asked for, last vertex."""
    a, b = geometry[0], F.element_at(geometry, -1)
    tiles = [tile_id(a["lon"], a["lat"], zoom)] + ([tile_id(b["lon"], b["lat"], zoom)] if last else [])
    return F.array_distinct(F.array(*tiles))


def tile_order(z: str, x: str, y: str) -> list[Column]:
    """Sort keys of the total order of tiles: zoom up, x and y down."""
    return [F.col(z).asc(), F.col(x).desc(), F.col(y).desc()]
