"""Web Mercator tile arithmetic as Column expressions (XYZ rows, y grows south)."""

from __future__ import annotations

from collections import namedtuple
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella import constants as C

Box = namedtuple("Box", "minx miny maxx maxy")
TileRange = namedtuple("TileRange", "xmin xmax ymin ymax")


def col(value) -> Column:
    """Accept a Column, a column name or a plain number."""
    if isinstance(value, Column):
        return value
    return F.col(value) if isinstance(value, str) else F.lit(value)


def shl(value, bits) -> Column:
    return F.call_function("shiftleft", col(value).cast("long"), col(bits).cast("int"))


def shr(value, bits) -> Column:
    return F.call_function("shiftright", col(value).cast("long"), col(bits).cast("int"))


def tiles_across(z) -> Column:
    return shl(F.lit(1), z)


def clamp(value, low, high) -> Column:
    return F.least(F.greatest(col(value), col(low)), col(high))


def row_latitude(row, z) -> Column:
    """Latitude of the northern edge of a (possibly fractional) tile row."""
    merc = F.lit(3.141592653589793) * (F.lit(1.0) - F.lit(2.0) * col(row) / tiles_across(z))
    return F.degrees(F.atan(F.sinh(merc)))


def column_longitude(column, z) -> Column:
    return col(column) / tiles_across(z) * 360.0 - 180.0


def tile_bounds(z, x, y, clamp_lat: bool = True) -> Box:
    """Geographic bounds; plan bounds clamp the latitude, shard bounds do not."""
    south, north = row_latitude(col(y) + 1, z), row_latitude(y, z)
    if clamp_lat:
        south = F.greatest(south, F.lit(-C.MERC_LAT))
        north = F.least(north, F.lit(C.MERC_LAT))
    return Box(column_longitude(x, z), south, column_longitude(col(x) + 1, z), north)


def tile_bounds_merc(z, x, y) -> Box:
    """EPSG:3857 bounds in metres."""
    size = F.lit(C.MERC_ORIGIN * 2) / tiles_across(z)
    minx = F.lit(-C.MERC_ORIGIN) + col(x) * size
    maxy = F.lit(C.MERC_ORIGIN) - col(y) * size
    return Box(minx, maxy - size, minx + size, maxy)


def tile_center(z, x, y) -> tuple[Column, Column]:
    return column_longitude(col(x) + 0.5, z), row_latitude(col(y) + 0.5, z)


def lon_to_column(lon, z) -> Column:
    """Fractional tile column of a longitude."""
    return (col(lon) + 180.0) / 360.0 * tiles_across(z)


def lat_to_row(lat, z, limit: float = C.MERC_LAT) -> Column:
    """Fractional tile row of a latitude, clamped to the projection's limit."""
    lat = clamp(lat, -limit, limit)
    merc = F.asinh(F.tan(F.radians(lat))) / 3.141592653589793
    return (F.lit(1.0) - merc) / 2.0 * tiles_across(z)


def _index(value: Column, z) -> Column:
    return clamp(F.floor(value).cast("long"), F.lit(0).cast("long"), tiles_across(z) - 1)


def lonlat_to_tile(lon, lat, z) -> tuple[Column, Column]:
    return _index(lon_to_column(lon, z), z), _index(lat_to_row(lat, z), z)


def tile_range(minx, miny, maxx, maxy, z, mode: str = "corner") -> TileRange:
    """Tile index range of a box.

    ``inset`` swaps reversed corners and steps 1e-9 inside on the east and north
    edge, ``plain`` keeps the +-85.0511 clamp and is empty (xmax < xmin) for a
    reversed box, ``corner`` takes the tiles of the NW and SE corner.
    """
    minx, miny, maxx, maxy = (col(v) for v in (minx, miny, maxx, maxy))
    if mode == "corner":
        x0, y0 = lonlat_to_tile(minx, maxy, z)
        x1, y1 = lonlat_to_tile(maxx, miny, z)
        return TileRange(x0, x1, y0, y1)
    limit = C.MERC_LAT_INSET if mode == "inset" else C.MERC_LAT_PLAIN
    minx, maxx = clamp(minx, -180.0, 180.0), clamp(maxx, -180.0, 180.0)
    miny, maxy = clamp(miny, -limit, limit), clamp(maxy, -limit, limit)
    if mode == "inset":
        west, east = F.least(minx, maxx), F.greatest(minx, maxx)
        south, north = F.least(miny, maxy), F.greatest(miny, maxy)
        eps = 1e-9
        return TileRange(
            _index(lon_to_column(west, z), z),
            _index(lon_to_column(east - eps, z), z),
            _index(lat_to_row(north - eps, z, limit), z),
            _index(lat_to_row(south, z, limit), z),
        )
    if mode != "plain":
        raise ValueError(f"unknown tile range mode {mode!r}")
    empty = (maxx < minx) | (maxy < miny)
    xmin, ymin = _index(lon_to_column(minx, z), z), _index(lat_to_row(maxy, z, limit), z)
    xmax, ymax = _index(lon_to_column(maxx, z), z), _index(lat_to_row(miny, z, limit), z)
    none = F.lit(-1).cast("long")
    return TileRange(
        xmin, F.when(empty, none).otherwise(xmax), ymin, F.when(empty, none).otherwise(ymax)
    )


def ancestor(z, x, y, at) -> tuple[Column, Column]:
    """Column and row of the ancestor tile at zoom ``at`` (at <= z)."""
    depth = col(z) - col(at)
    return shr(x, depth), shr(y, depth)


def sub_position(z, x, y, at) -> tuple[Column, Column]:
    """Offset of a tile inside its ancestor, in tiles of its own zoom."""
    depth = col(z) - col(at)
    ax, ay = ancestor(z, x, y, at)
    return col(x) - shl(ax, depth), col(y) - shl(ay, depth)


def tms_flip(z, y) -> Column:
    return tiles_across(z) - 1 - col(y)


def box_from_point(lon, lat, width_m, height_m) -> Box:
    """Box of a size in metres around a point; null for a non-positive size."""
    width, height = col(width_m), col(height_m)
    ok = (width > 0) & (height > 0)
    dlat = height / 2.0 / C.METRES_PER_DEGREE
    per_degree = F.greatest(F.lit(1e-6), F.cos(F.radians(col(lat))) * C.METRES_PER_DEGREE)
    dlon = width / 2.0 / per_degree
    return Box(
        F.when(ok, F.greatest(F.lit(-180.0), col(lon) - dlon)),
        F.when(ok, F.greatest(F.lit(-90.0), col(lat) - dlat)),
        F.when(ok, F.least(F.lit(180.0), col(lon) + dlon)),
        F.when(ok, F.least(F.lit(90.0), col(lat) + dlat)),
    )


def box_buffer(minx, miny, maxx, maxy, km) -> Box:
    """Grow a box by kilometres, wider in longitude toward the poles."""
    minx, miny, maxx, maxy, km = (col(v) for v in (minx, miny, maxx, maxy, km))
    dlat = km / C.KM_PER_DEGREE
    dlon = dlat / F.greatest(F.cos(F.radians((miny + maxy) / 2.0)), F.lit(0.01))
    grow = km > 0
    return Box(
        F.when(grow, F.greatest(minx - dlon, F.lit(-180.0))).otherwise(minx),
        F.when(grow, F.greatest(miny - dlat, F.lit(-90.0))).otherwise(miny),
        F.when(grow, F.least(maxx + dlon, F.lit(180.0))).otherwise(maxx),
        F.when(grow, F.least(maxy + dlat, F.lit(90.0))).otherwise(maxy),
    )


def box_normalize(minx, miny, maxx, maxy) -> Box:
    minx, miny, maxx, maxy = (col(v) for v in (minx, miny, maxx, maxy))
    return Box(
        F.least(minx, maxx), F.least(miny, maxy), F.greatest(minx, maxx), F.greatest(miny, maxy)
    )


def box_text(minx, miny, maxx, maxy) -> Column:
    return F.format_string("%.6f,%.6f,%.6f,%.6f", *(col(v) for v in (minx, miny, maxx, maxy)))


def boxes_intersect(a: Box, b: Box, buffer_deg=0.0) -> Column:
    """Inclusive overlap, ``b`` grown by a buffer in degrees."""
    buffer = col(buffer_deg)
    return (
        (col(a.maxx) >= col(b.minx) - buffer)
        & (col(a.minx) <= col(b.maxx) + buffer)
        & (col(a.maxy) >= col(b.miny) - buffer)
        & (col(a.miny) <= col(b.maxy) + buffer)
    )


def box_covers(a: Box, b: Box) -> Column:
    return (
        (col(a.minx) <= col(b.minx))
        & (col(a.miny) <= col(b.miny))
        & (col(a.maxx) >= col(b.maxx))
        & (col(a.maxy) >= col(b.maxy))
    )


def box_center(minx, miny, maxx, maxy) -> tuple[Column, Column]:
    return (col(minx) + col(maxx)) * 0.5, (col(miny) + col(maxy)) * 0.5


def zoom_resolution(z) -> Column:
    return F.lit(C.METRES_PER_PIXEL_Z0) / tiles_across(F.greatest(col(z), F.lit(0)))


def gsd_to_zoom(gsd) -> Column:
    """Finest zoom whose pixels are not smaller than the ground sample distance."""
    gsd = col(gsd)
    zoom = F.floor(F.log2(F.lit(C.METRES_PER_PIXEL_Z0) / gsd)).cast("int")
    known = clamp(zoom, 0, C.FINEST_ZOOM)
    return F.when(gsd.isNull() | (gsd <= 0), F.lit(C.FINEST_ZOOM)).otherwise(known)


def quadrant_of_tile(z, x, y, north: int = 62, east: int = 38, south: int = 32) -> Column:
    """Four-way region of the tile centre; the tests apply in this order."""
    lon, lat = tile_center(z, x, y)
    lat_code, lon_code = F.floor(lat * 1.5), F.floor(lon) - 100
    return (
        F.when(lat_code >= north, "north")
        .when(lon_code >= east, "east")
        .when(lon_code <= south, "south")
        .otherwise("west")
    )


def _shard_lookup() -> str:
    """Shard ids of all cells of the shard zoom, row by row."""
    cells = {}
    for i, (x0, y0, x1, y1) in enumerate(C.SHARD_RECTANGLES):
        cells.update({(x, y): f"{i:02d}" for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)})
    across = range(1 << C.SHARD_ZOOM)
    return ",".join(cells[x, y] for y in across for x in across)


SHARD_CELLS = _shard_lookup()


def shard_of_tile(z, x, y) -> Column:
    """Two-digit shard id, null above the shard zoom: one lookup in a constant array."""
    z = col(z)
    depth = F.greatest(z - C.SHARD_ZOOM, F.lit(0))
    cell = shl(shr(y, depth), C.SHARD_ZOOM) + shr(x, depth)
    table = F.split(F.lit(SHARD_CELLS), ",")  # folded by the optimizer
    return F.when(z >= C.SHARD_ZOOM, F.get(table, cell.cast("int")))


def is_land(box: Box, buffer_km: float = C.LAND_BUFFER_KM) -> Column:
    """Box meets a buffered land rectangle or reaches into the polar caps."""
    buffer = max(0.0, buffer_km) / C.KM_PER_DEGREE
    hits = [boxes_intersect(box, Box(*(F.lit(v) for v in land)), buffer) for land in C.LAND_BOXES]
    polar = (col(box.maxy) > C.POLAR_LAT) | (col(box.miny) < -C.POLAR_LAT)
    return reduce(lambda a, b: a | b, hits, polar)
