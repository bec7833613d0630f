"""Scalar column builders. Each returns a ``Column``; none is a Python UDF."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

# The standard geohash base-32 alphabet.
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"



def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def is_blank(c) -> Column:
    """True when the string is null or only whitespace."""
    c = _c(c)
    return c.isNull() | (F.trim(c) == "")


def not_blank(c) -> Column:
    c = _c(c)
    return c.isNotNull() & (F.trim(c) != "")


def blank_to_null(c) -> Column:
    c = _c(c)
    return F.when(not_blank(c), c)


def epoch_ms(ts, zoned: bool = False) -> Column:
    """Epoch milliseconds of a timestamp column (floor).

    ``TIMESTAMP_NTZ`` values (the default) are taken as UTC wall-clock
    without consulting the session time zone; with ``zoned=True`` the column
    is a ``TIMESTAMP`` (an absolute instant).
    """
    ts = _c(ts)
    if zoned:
        return F.floor(F.unix_micros(ts) / 1000).cast("long")
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            ts.cast("timestamp_ntz"))


def geohash(lat, lon, precision: int = 6) -> Column:
    """Geohash of (lat, lon) as a pure expression.

    lon/lat are scaled to integer grids of 2^ceil(5p/2) and 2^floor(5p/2)
    cells; the bits are interleaved starting with longitude and read five at
    a time into the base-32 alphabet. Null in, null out.
    """
    lat, lon = _c(lat).cast("double"), _c(lon).cast("double")
    nbits = 5 * precision
    lon_bits, lat_bits = (nbits + 1) // 2, nbits // 2
    lo = F.least(F.floor((lon + 180.0) / 360.0 * float(1 << lon_bits)), F.lit((1 << lon_bits) - 1)).cast("long")
    la = F.least(F.floor((lat + 90.0) / 180.0 * float(1 << lat_bits)), F.lit((1 << lat_bits) - 1)).cast("long")

    def bit(p: int) -> Column:
        src, width = (lo, lon_bits) if p % 2 == 0 else (la, lat_bits)
        return F.shiftright(src, width - 1 - p // 2).bitwiseAND(F.lit(1))

    chars = []
    for i in range(precision):
        idx = None
        for j in range(5):
            term = F.shiftleft(bit(5 * i + j), 4 - j)
            idx = term if idx is None else idx.bitwiseOR(term)
        chars.append(F.substring(F.lit(GEOHASH_ALPHABET), (idx + 1).cast("int"), 1))
    return F.concat(*chars)


def ip_to_long(ip) -> Column:
    """Dotted IPv4 text to its 32-bit value as a long; malformed gives null."""
    parts = F.split(_c(ip), r"\.")
    octets = [F.try_element_at(parts, F.lit(i + 1)).try_cast("long") for i in range(4)]
    val = (octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3])
    ok = (F.size(parts) == 4)
    for o in octets:
        ok = ok & o.between(0, 255)
    return F.when(ok, val)


def long_to_ip(v) -> Column:
    v = _c(v).cast("long")
    return F.concat_ws(".", *[F.shiftright(v, s).bitwiseAND(255).cast("string") for s in (24, 16, 8, 0)])
