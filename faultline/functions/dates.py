"""Date parsing: bad text gives null, never an error.

The shape of the text picks the layout. Trying layouts one after the other would raise and swallow an exception
per row and failed layout inside the JVM; numeric shapes are even turned into ISO text and cast, which needs no
formatter at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from faultline.functions.text import once

_COMPACT = "^[0-9]{8}$"
_COMPACT_TIME = "^[0-9]{8}[T ][0-9:.+Z-]*$"
_ISO = "^[0-9]{4}(-[0-9]{1,2}(-[0-9]{1,2}([T ][0-9:.+Z -]*)?)?)?$"
_YEAR_FIRST = "^([0-9]{4})[/.]([0-9]{1,2})[/.]([0-9]{1,2})$"
_MONTH_FIRST = "^([0-9]{1,2})[/.-]([0-9]{1,2})[/.-]([0-9]{4}|[0-9]{2})$"
# Other shapes and their layouts, once commas are taken out.
_LAYOUTS = [
    ("^[A-Za-z]{3} [0-9]{1,2} [0-9]{4}$", "MMM d yyyy"),
    ("^[A-Za-z]{4,} [0-9]{1,2} [0-9]{4}$", "MMMM d yyyy"),
    ("^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}$", "d MMM yyyy"),
    ("^[0-9]{1,2} [A-Za-z]{4,} [0-9]{4}$", "d MMMM yyyy"),
]


def _compact_to_iso(text: Column) -> Column:
    return F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))


def compact_date(text: Column) -> Column:
    """Strict yyyyMMdd."""
    return F.when(text.rlike(_COMPACT), _compact_to_iso(text).try_cast("date"))


def mixed_date(text: Column) -> Column:
    """Compact or ISO, with or without time; bare year or month; year or month first with slashes, dots or dashes; or with
    the month spelled out. Two-digit years up to 68 belong to this century."""

    def month_first(part: Column) -> Column:
        century = F.when(F.length(part[2]) == 4, "").when(part[2] <= "68", "20").otherwise("19")
        return F.concat(century, part[2], F.lit("-"), part[0], F.lit("-"), part[1]).try_cast("date")

    parts = F.split(text, "[/.-]")
    out = (
        F.when(text.rlike(_COMPACT), _compact_to_iso(text).try_cast("date"))
        .when(text.rlike(_ISO), text.try_cast("date"))
        .when(text.rlike(_COMPACT_TIME), _compact_to_iso(text).try_cast("date"))
        .when(text.rlike(_MONTH_FIRST), once(parts, month_first))
        .when(text.rlike(_YEAR_FIRST), F.array_join(parts, "-").try_cast("date"))
    )
    plain = F.replace(text, F.lit(","), F.lit(""))
    for shape, layout in _LAYOUTS:
        out = out.when(plain.rlike(shape), F.try_to_date(plain, layout))
    return out
