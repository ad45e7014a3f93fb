"""Column expressions that the operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Speed of light in m/s (fixed value).
C_LIGHT = 299_792_458.0

#: Observing modes and what they are. Those in ``CAPTURES`` bear their instrument's prefix in the data.
MODES = {
    "NO_CAPTURE": "no_capture",
    "CORR_MODE_CHANGE": "no_capture",
    "CORRELATOR": "correlator",
    "CORR_BF": "correlator,beamformer",
    "VCS": "vcs",
    "BUFFER": "buffer",
    "BEAMFORMER": "beamformer",
}

CAPTURES = ("CORRELATOR", "CORR_BF", "VCS", "BUFFER", "BEAMFORMER")

#: GPS seconds at which each leap second since the GPS epoch took effect.
LEAP_GPS = [
    46828800, 78364801, 109900802, 173059203, 252028804, 315187205, 346723206, 393984007, 425520008,
    457056009, 504489610, 551750411, 599184012, 820108813, 914803214, 1025136015, 1119744016, 1167264017,
]
GPS_EPOCH_UNIX = 315_964_800


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` computed once."""
    return F.get(F.transform(F.array(value), then), 0)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def extension(path: Column) -> Column:
    """Lower-cased, with its dot; empty without one. A leading dot begins a name, not an extension."""
    return F.lower(F.regexp_extract(basename(path), r"^.+(\.[^.]*)$", 1))


def stem(path: Column) -> Column:
    name = basename(path)
    cut = F.regexp_extract(name, r"^(.+)\.[^.]*$", 1)
    return F.when(cut == "", name).otherwise(cut)


def is_integer(value: Column) -> Column:
    return value.try_cast("bigint").isNotNull()


def wrap_angle(angle: Column) -> Column:
    """To [-pi, pi); nulls and NaN stay as they are."""
    return F.pmod(angle + F.pi(), 2 * F.pi()) - F.pi()


def known(value: Column) -> Column:
    """NaN to null: inside the operators a missing number is null."""
    return F.when(~F.isnan(value), value)


def amplitude(re: Column, im: Column) -> Column:
    return F.sqrt(re * re + im * im)


def phase(re: Column, im: Column) -> Column:
    return F.atan2(im, re)


def complex_product(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def complex_quotient(a: tuple[Column, Column], b: tuple[Column, Column]) -> tuple[Column, Column]:
    """Null where the divisor is zero."""
    size = b[0] * b[0] + b[1] * b[1]
    return F.try_divide(a[0] * b[0] + a[1] * b[1], size), F.try_divide(a[1] * b[0] - a[0] * b[1], size)


def slope_to_length(slope: Column) -> Column:
    """Electrical length in metres of a phase slope in radians per Hz."""
    return slope * (C_LIGHT / (2 * 3.141592653589793))


def number_list(text: Column, kind: str = "double") -> Column:
    """Comma-separated numbers as an array; what isn't a number is null."""
    return F.transform(F.split(text, ","), lambda x: F.trim(x).try_cast(kind))


def is_mode(mode: Column, kind: str, prefix: str = "") -> Column:
    """Whether a mode is of a kind, by its exact name; ``prefix`` is the instrument's, with its underscore. False for null."""
    names = [prefix + m if m in CAPTURES else m for m, kinds in MODES.items() if kind in kinds.split(",")]
    return F.coalesce(mode.isin(names), F.lit(False))


def gps_to_unix(gps: Column) -> Column:
    leaps = F.size(F.filter(F.array(*[F.lit(x) for x in LEAP_GPS]), lambda x: x <= gps))
    return gps + GPS_EPOCH_UNIX - leaps


def unix_to_gps(seconds: Column) -> Column:
    """Inverse of ``gps_to_unix``, to the nearest second."""
    raw = F.round(seconds).cast("bigint") - GPS_EPOCH_UNIX
    starts = F.array(*[F.lit(x - i) for i, x in enumerate(LEAP_GPS)])
    return raw + F.size(F.filter(starts, lambda x: x <= raw))


def bucket_of(obs_id: Column, prefix: str) -> Column:
    """The bucket of an observation, and the ledger's partition key: the site's prefix and the id's first five digits."""
    return F.concat(F.lit(prefix), F.substring(obs_id.cast("string"), 1, 5))


#: Seconds of a slot, by which times are joined with windows of time.
SLOT = 512


def slot_of(gps: Column) -> Column:
    return F.floor(gps / SLOT)


def suffixed(df: DataFrame, suffix: str, keep: tuple[str, ...]) -> DataFrame:
    return df.withColumnsRenamed({c: c + suffix for c in df.columns if c not in keep})
