"""Numbers: coercion, scores, distances, text forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
MERCATOR_M = 6_378_137.0
TRUE_WORDS = ("true", "yes", "y", "t", "1", "1.0", "evet", "on")
FALSE_WORDS = ("false", "no", "n", "f", "0", "0.0", "hayir", "hayır", "off")


def to_num(col: Column, default: float | None = None) -> Column:
    """Double of a text, without spaces and thousands separators; ``default`` where there is none."""
    value = F.regexp_replace(col.cast("string"), r"[,\s]", "").try_cast("double")
    return value if default is None else F.coalesce(value, F.lit(float(default)))


def to_flag(col: Column) -> Column:
    """1, 0 or null for words of truth."""
    word = F.lower(F.trim(col.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), 1).when(word.isin(*FALSE_WORDS), 0)


def finite(col: Column) -> Column:
    """Null for infinities and not-a-number."""
    return F.when(~(F.isnan(col) | (F.abs(col) == float("inf"))), col)


def clip(col: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(col, F.lit(low)), F.lit(high))


def sigmoid(x: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-x))


def logit(p: Column, eps: float = 1e-9) -> Column:
    q = clip(p, eps, 1 - eps)
    return F.log(q / (1.0 - q))


def poisson_any(rate: Column) -> Column:
    """Chance of at least one event."""
    return 1.0 - F.exp(-rate)


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_M) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(F.lit(1.0), h)))


def mercator_x(lon: Column) -> Column:
    return MERCATOR_M * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return MERCATOR_M * F.log(F.tan(F.lit(0.7853981633974483) + F.radians(lat) / 2))


def percent_text(share: Column) -> Column:
    """``47%``, halves to even."""
    return F.concat(F.bround(share * 100).cast("int").cast("string"), F.lit("%"))


def title(col: Column) -> Column:
    return F.initcap(F.trim(col))


def quantile_of_label(col: Column) -> Column:
    """The n of a ``Qn ...`` label."""
    return F.regexp_extract(col.cast("string"), r"^\s*[Qq]([0-9]+)", 1).try_cast("int")


def list_number(col: Column) -> Column:
    """The first number of a text such as ``[5.3E-1]``."""
    return F.split(F.regexp_replace(col.cast("string"), r"[\[\]\s]", ""), ",")[0].try_cast("double")


def repair_dashes(col: Column) -> Column:
    """Dashes that were decoded with the wrong character set."""
    return F.replace(F.replace(col, F.lit("â€“"), F.lit("–")), F.lit("â€”"), F.lit("—"))


def synthetic_id(ids: list[Column], ts: Column, lat: Column, lon: Column) -> Column:
    """The first id that is there, else time and place."""
    place = F.concat_ws("_", F.date_format(ts, "yyyyMMddHHmmss"), F.format_string("%.6f", F.round(lat, 6)), F.format_string("%.6f", F.round(lon, 6)))
    return F.coalesce(*[x.cast("string") for x in ids], place)
