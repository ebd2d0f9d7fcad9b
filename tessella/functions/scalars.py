"""Text, URL, time and lookup expressions."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessella import constants as C
from tessella.functions.grid import col

INTEGER = r"^\s*[+-]?[0-9]+\s*$"


def to_integer(text) -> Column:
    """Strict integer text to BIGINT, null for anything else."""
    text = col(text)
    return F.when(text.rlike(INTEGER), F.trim(text).try_cast("bigint"))


def to_number(text) -> Column:
    return col(text).try_cast("double")


def to_instant(text) -> Column:
    """ISO instant (``Z`` or offset); null when missing or malformed."""
    return F.try_to_timestamp(F.trim(col(text)))


def shard_id(value) -> Column:
    """Shard id as stored: digits get two places, blank is null, rest is kept."""
    text = F.trim(col(value).cast("string"))
    digits = text.rlike("^[0-9]+$") & (F.length(text) < 2)
    return F.when(text != "", F.when(digits, F.lpad(text, 2, "0")).otherwise(text))


def slug(text) -> Column:
    body = F.regexp_replace(F.lower(col(text)), "[^a-z0-9]+", "_")
    body = F.regexp_replace(body, "^_+|_+$", "")
    return F.when(body == "", "layer").otherwise(body)


def _lookup(value: Column, table: dict, default: Column) -> Column:
    chain = reduce(
        lambda c, kv: c.when(value == kv[0], kv[1]), table.items(), F.when(F.lit(False), "")
    )
    return chain.otherwise(default)


def media_extension(media_type) -> Column:
    value = F.lower(col(media_type))
    tail = F.element_at(F.split(value, "/"), -1)
    return _lookup(value, C.MEDIA_EXTENSIONS, F.when(tail == "", "bin").otherwise(tail))


def media_compression(media_type) -> Column:
    return _lookup(F.lower(col(media_type)), C.MEDIA_COMPRESSION, F.lit("DEFLATE"))


def tile_format(value) -> Column:
    value = F.lower(col(value))
    return F.when(value == "jpeg", "jpg").otherwise(value)


def vector_dataset(value) -> Column:
    """Canonical dataset name of an alias; null for an unknown one."""
    key = F.lower(F.trim(col(value)))
    return _lookup(key, C.VECTOR_DATASETS, F.lit(None).cast("string"))


def qa_mask(flags) -> Column:
    """OR of the bits of an array of flag names; unknown names add nothing."""
    names = F.coalesce(flags, F.array().cast("array<string>"))
    bit = lambda name: _lookup(F.lower(F.trim(name)), C.QA_BITS, F.lit(0)).cast("int")
    return F.aggregate(names, F.lit(0), lambda acc, name: acc.bitwiseOR(bit(name)))


def qa_mask_literal(flags: Iterable[str]) -> int:
    return reduce(lambda acc, name: acc | C.QA_BITS.get(name.strip().lower(), 0), flags, 0)


def strip_query(url) -> Column:
    return F.regexp_replace(col(url), r"[?#].*$", "")


def sign_url(url, token) -> Column:
    """Append an access token to the query, ahead of any fragment."""
    url, token = col(url), F.regexp_replace(col(token), r"^\?", "")
    head = F.regexp_replace(url, "#.*$", "")
    fragment = F.regexp_extract(url, "(#.+)$", 1)
    bare = F.regexp_replace(head, r"\?$", "")
    joiner = F.when(bare.contains("?"), "&").otherwise("?")
    return F.concat(bare, F.when(token == "", "").otherwise(joiner), token, fragment)


def tile_url(template, z, x, y) -> Column:
    url = F.replace(col(template), F.lit("{z}"), col(z).cast("string"))
    url = F.replace(url, F.lit("{x}"), col(x).cast("string"))
    return F.replace(url, F.lit("{y}"), col(y).cast("string"))


def cache_name(url) -> Column:
    """``sha1(url)[:12]_stem.tif`` for a remote raster."""
    path = F.split_part(col(url), F.lit("?"), F.lit(1))
    name = F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]+$", "")
    stem = F.when(stem == "", "cog").otherwise(stem)
    return F.concat(F.substring(F.sha1(col(url).cast("binary")), 1, 12), F.lit("_"), stem, F.lit(".tif"))


def search_key(*parts) -> Column:
    """Deterministic digest of a search; doubles enter with five decimals."""
    return F.sha2(F.concat_ws("|", *(col(p) for p in parts)), 256)


def fixed5(value) -> Column:
    return F.format_string("%.5f", col(value))


def season_name(lat) -> Column:
    return F.when(col(lat) >= 0, C.SEASONS[0][0]).otherwise(C.SEASONS[1][0])


def season_window(lat, year: int, seasons=C.SEASONS):
    """(name, hemisphere, start, end) of the season at a latitude.

    The first season of the hemisphere wins, then the first global one. A window
    that wraps over New Year starts in the year before ``year``.
    """
    def first(hemisphere):
        own = [s for s in seasons if s[1].lower() == hemisphere]
        shared = [s for s in seasons if s[1].lower() == "global"]
        if not (own or shared):
            raise ValueError(f"no season for hemisphere {hemisphere}")
        return (own or shared)[0]

    def dates(season):
        _, _, m0, d0, m1, d1 = season
        start_year = year if (m0, d0) <= (m1, d1) else year - 1
        return f"{start_year:04d}-{m0:02d}-{d0:02d}", f"{year:04d}-{m1:02d}-{d1:02d}"

    north, south = first("north"), first("south")
    pick = lambda a, b: F.when(col(lat) >= 0, F.lit(a)).otherwise(F.lit(b))
    (n0, n1), (s0, s1) = dates(north), dates(south)
    return (
        pick(north[0], south[0]),
        pick(north[1], south[1]),
        pick(n0, s0).cast("date"),
        pick(n1, s1).cast("date"),
    )


def product_parts(product_id, *prefixes: str) -> tuple[Column, Column]:
    """Acquisition date and grid tile of ``<product>_YYYYDDD_hXXvYY`` of any of the products.

    Nulls when malformed.
    """
    text = col(product_id)
    code = F.split_part(text, F.lit("_"), F.lit(3))
    tile = F.lower(F.split_part(text, F.lit("_"), F.lit(4)))
    instant = F.try_to_timestamp(F.when(code.rlike("^[0-9]{7}$"), code), F.lit("yyyyDDD"))
    known = reduce(lambda a, b: a | b, [text.startswith(p) for p in prefixes])
    ok = known & tile.startswith("h") & tile.contains("v")
    return F.when(ok, F.to_date(instant)), F.when(ok & instant.isNotNull(), tile)


def default_layers(product) -> Column:
    value = F.trim(F.coalesce(col(product), F.lit("")))
    new = value.endswith(".002") | value.endswith(".003")
    return F.when(new, F.array(*map(F.lit, C.VIIRS_LAYERS_NEW))).otherwise(
        F.array(*map(F.lit, C.VIIRS_LAYERS_OLD))
    )


def sinusoidal_ring(tile) -> Column:
    """Closed ring of (lon, lat) corners of an ``hXXvYY`` tile; null when invalid."""
    tile = col(tile)
    h = F.regexp_extract(tile, "(?i)^h([0-9]{2})v([0-9]{2})$", 1).try_cast("int")
    v = F.regexp_extract(tile, "(?i)^h([0-9]{2})v([0-9]{2})$", 2).try_cast("int")
    ok = h.between(0, C.SINUSOIDAL_COLS - 1) & v.between(0, C.SINUSOIDAL_ROWS - 1)
    west = h * C.SINUSOIDAL_TILE - C.SINUSOIDAL_TILE * C.SINUSOIDAL_COLS / 2.0
    north = F.lit(C.SINUSOIDAL_TILE * C.SINUSOIDAL_ROWS / 2.0) - v * C.SINUSOIDAL_TILE
    east, south = west + C.SINUSOIDAL_TILE, north - C.SINUSOIDAL_TILE

    def corner(x, y):
        lat = y / C.SINUSOIDAL_RADIUS
        cos = F.cos(lat)
        tiny = F.when(cos >= 0, F.lit(1e-12)).otherwise(F.lit(-1e-12))
        cos = F.when(F.abs(cos) < 1e-12, tiny).otherwise(cos)
        lon = x / (cos * C.SINUSOIDAL_RADIUS)
        return F.struct(F.degrees(lon).alias("lon"), F.degrees(lat).alias("lat"))

    ring = F.array(
        corner(west, north),
        corner(east, north),
        corner(east, south),
        corner(west, south),
        corner(west, north),
    )
    return F.when(ok, ring)


def meta_center(bounds, minzoom, maxzoom) -> tuple[Column, Column, Column]:
    """Centre of bounds and the middle zoom, clamped to the zoom range."""
    minx, miny, maxx, maxy = (col(v) for v in bounds)
    low, high = col(minzoom), col(maxzoom)
    middle = low + F.floor((high - low) / 2.0).cast("int")
    zoom = F.greatest(low, F.least(high, middle))
    return (minx + maxx) / 2.0, (miny + maxy) / 2.0, zoom
