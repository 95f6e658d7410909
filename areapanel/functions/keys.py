"""Area keys and hour bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_key(col: Column | str, length: int = 11, side: str = "left", mode: str = "first_run", expected_length: int | None = None) -> Column:
    """Digits of an area code, cut to ``length`` and padded with zeros on the left.

    ``mode``: ``first_run`` takes the first run of digits, ``all_digits`` joins
    all of them (null if fewer than ``length``), ``number`` first undoes a
    decimal or scientific notation, ``pad_only`` does not cut.  ``side`` is the
    side that is kept when there are too many digits.  ``expected_length`` pads
    before the cut, for codes that lost leading zeros.  Null, and text without
    digits, gives null.
    """
    text = F.trim((F.col(col) if isinstance(col, str) else col).cast("string"))
    if mode == "number":
        number = text.try_cast("decimal(38,0)")
        text = F.coalesce(F.when(text.rlike(r"^[0-9.]+([eE]\+?[0-9]+)?$"), F.coalesce(number, text.try_cast("double").try_cast("decimal(38,0)")).cast("string")), text)
    digits = F.regexp_replace(text, r"[^0-9]", "") if mode == "all_digits" else F.regexp_extract(text, r"([0-9]+)", 1)
    digits = F.when(F.length(digits) > 0, digits)
    if mode == "all_digits":
        digits = F.when(F.length(digits) >= length, digits)
    if expected_length:
        digits = F.when(F.length(digits) < expected_length, F.lpad(digits, expected_length, "0")).otherwise(digits)
    if mode != "pad_only":
        digits = F.left(digits, F.lit(length)) if side == "left" else F.right(digits, F.lit(length))
    return F.when(F.length(digits) < length, F.lpad(digits, length, "0")).otherwise(digits)


def hour_key(hour: Column | str, width: int = 3) -> Column:
    """First hour of the bin that holds ``hour``."""
    h = F.col(hour) if isinstance(hour, str) else hour
    return (F.floor(h / width) * width).cast("int")


def hour_label(key: Column | str, width: int = 3, style: str = "24") -> Column:
    """``HH-HH``; the last bin ends in 24 (style ``24``) or 00 (style ``00``)."""
    k = F.col(key) if isinstance(key, str) else key
    end = k + width if style == "24" else (k + width) % 24
    return F.concat_ws("-", F.lpad(k.cast("string"), 2, "0"), F.lpad(end.cast("string"), 2, "0"))


def parse_hour_label(col: Column | str) -> Column:
    """First hour of a label such as ``9 - 12`` or ``21–24``; null if it has none or it is over 23."""
    text = F.translate((F.col(col) if isinstance(col, str) else col).cast("string"), "–—", "--")
    hour = F.regexp_extract(text, r"^\s*([0-9]{1,2})\s*-\s*[0-9]{1,2}\s*$", 1).try_cast("int")
    return F.when(hour <= 23, hour)


def longest_common_length(col: Column | str) -> Column:
    """Aggregate: the most frequent length (the least of those that tie)."""
    return F.mode(F.length(F.col(col) if isinstance(col, str) else col), True)
